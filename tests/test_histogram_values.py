"""Histograms of values with more than two decimals."""

from __future__ import annotations

import pytest
from areascore.operators import profile


@pytest.mark.parametrize("kind", ["DECIMAL(14,5)", "DOUBLE"])
def test_values_below_a_hundredth(spark, kind):
    import numpy as np

    values = [k * k % 61 * 0.00013 + 0.00004 for k in range(200)]
    frame = spark.createDataFrame([(f"{v:.5f}",) for v in values], "v string").selectExpr(f"CAST(v AS {kind}) AS v")
    got = sorted((r["bin"], r["n"], r["lower_edge"]) for r in profile.histogram(frame, ["v"], bins=7).collect())
    counts, edges = np.histogram([float(r["v"]) for r in frame.collect()], bins=7)
    assert [n for _, n, _ in got] == counts.tolist()
    assert np.allclose([e for _, _, e in got], edges[:-1], atol=1e-6)
