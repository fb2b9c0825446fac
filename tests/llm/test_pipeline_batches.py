"""Every stage of the pipeline hands Python workers small batches of texts, and leaves the session as it was."""

from __future__ import annotations

import corpus_pipeline
import pyarrow as pa

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_batches(spark, tmp_path, monkeypatch):
    def sizes(spark, docs, sf_dir):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

        return docs.coalesce(1).mapInArrow(run, "n long")

    spark.range(2500).selectExpr("id AS doc_id", "'a text' AS text").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", sizes)])
    before = spark.conf.get(SETTING)
    found = [r.n for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sum(found) == 2500 and max(found) <= 1000
    assert spark.conf.get(SETTING) == before
