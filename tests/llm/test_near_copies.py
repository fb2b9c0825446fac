"""Near copies of the pipeline: sets of five words in a row, similarity of 0.8 or more."""

from __future__ import annotations

import corpus_pipeline


def test_pair_between_the_thresholds_of_op4_and_the_stage(spark, tmp_path):
    words = [f"w{k}" for k in range(100)]
    changed = lambda *places: " ".join("other" if k in places else w for k, w in enumerate(words))
    rows = [(1, " ".join(words)), (2, changed(30, 60)), (3, changed(20, 40, 60, 80)), (4, "something else")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # Of 96 sets of five words two changed words leave 86 (86/106 is 0.81), four leave 76 (76/116 is 0.66).
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]
