"""Second pass of the set join: pairs across components of an index group."""

from __future__ import annotations

from pyspark.sql import functions as F

from areascore.llm import set_join


def _pairs(spark, rows):
    rest = spark.createDataFrame(rows, "entry long, id long, component long")
    met = set_join._met(rest, lambda frame, name: frame, F.lit(True)).collect()
    asked = {(min(i, j), max(i, j)) for e, i, x in rows for f, j, y in rows if e == f and x != y}
    return [(r.a, r.b) for r in met], asked


def test_stranger_that_shares_many_segments_meets_each_member_once(spark):
    copies = [(e, k, 0) for e in range(40) for k in range(20)]
    met, asked = _pairs(spark, copies + [(e, 100, 100) for e in range(40)])
    assert len(met) == 20 and set(met) == asked


def test_stranger_that_shares_one_segment_meets_only_its_members(spark):
    copies = [(e, 3 * e + k, 0) for e in range(40) for k in range(3)]
    met, asked = _pairs(spark, copies + [(7, 500, 500)])
    assert sorted(met) == sorted(asked) == [(21, 500), (22, 500), (23, 500)]


def test_members_outside_the_largest_component_meet(spark):
    rows = [(e, i, c) for e in range(3) for i, c in ((1, 1), (2, 1), (3, 1), (10, 10), (11, 10), (20, 20))]
    met, asked = _pairs(spark, rows + [(9, 1, 1), (9, 30, 30), (9, 31, 31)])
    assert asked <= set(met)
