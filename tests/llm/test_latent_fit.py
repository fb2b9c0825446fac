"""The latent directions of the benchmark search come from every document."""

from __future__ import annotations

import corpus_pipeline
import numpy as np

from areascore.llm import decontaminate


def test_every_document_is_in_the_fit(spark, monkeypatch):
    rows = [(i, f"w{i} v{i} some words of text {i % 7}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame([(1, "a text that is asked for and nowhere else")], "item_id long, text string")
    fitted = []
    directions = decontaminate.latent_directions

    def seen(rows, idf, *rest):
        fitted.extend((r.text, r.weight) for r in rows.collect())
        return directions(rows, idf, *rest)

    monkeypatch.setattr(decontaminate, "latent_directions", seen)
    # Fewer than there are documents, as on a large table.
    for name in ("FITTED_DOCUMENTS", "DOCUMENTS_WEIGHT"):
        monkeypatch.setattr(decontaminate, name, 10, raising=False)
    decontaminate.mark(docs, asked)
    own = [(t, w) for t, w in fitted if w != decontaminate.ASKED_WEIGHT]
    assert sorted(t for t, _ in own) == sorted(t for _, t in rows)
    assert abs(sum(w * w for _, w in own) - 10) < 1e-9


def test_directions_are_singular_vectors(spark):
    rng = np.random.default_rng(5)
    themes = [[f"t{k}x{n}" for n in range(5)] for k in range(8)]
    texts = [" ".join(rng.choice(themes[k], 40)) for k in range(8) for _ in range(2 * k + 2)]
    rows = spark.createDataFrame([(t, 1.0) for t in texts], "text string, weight double").repartition(2)
    idf = np.ones(decontaminate.FEATURES)
    row, column, value, many = decontaminate._passages(decontaminate.Cut(texts), idf)
    dense = np.zeros((int(many.sum()), decontaminate.FEATURES))
    dense[row, column] = value
    want = np.linalg.svd(dense, full_matrices=False)[2][:8]
    got = decontaminate.latent_directions(rows, idf, 16)
    assert np.allclose(got.T @ got, np.eye(16), atol=1e-6)
    # The eight strongest vectors span what those of the exact decomposition span.
    assert np.linalg.svd(want @ got, compute_uv=False).min() > 0.95


def test_pipeline_stage_fits_on_every_document(spark, monkeypatch, tmp_path):
    rows = [(i, f"w{i} v{i} some words of text {i % 7}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame([(1, "a text that is asked for and nowhere else")], "item_id long, text string")
    asked.write.parquet(f"{tmp_path}/benchmark.parquet")
    fitted = []
    directions = decontaminate.latent_directions
    monkeypatch.setattr(
        decontaminate, "latent_directions", lambda rows, idf: fitted.append(rows.count()) or directions(rows, idf)
    )
    for name in ("FITTED_DOCUMENTS", "DOCUMENTS_WEIGHT"):
        monkeypatch.setattr(decontaminate, name, 10, raising=False)
    assert corpus_pipeline.benchmark_leaks(spark, docs, str(tmp_path)).count() == len(rows)
    assert fitted == [len(rows) + 1]
