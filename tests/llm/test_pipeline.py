"""The pipeline on a folder of its own: each stage's decision takes effect, clean documents stay."""

from __future__ import annotations

import random

import corpus_pipeline
from areascore.llm.queries import QUERIES


def test_stages(spark, tmp_path):
    rnd = random.Random(3)
    stop = ["the", "of", "and", "to", "in"]
    plain = lambda k: " ".join(rnd.choice(stop) if j % 4 == 0 else f"word{rnd.randrange(500)}" for j in range(k))
    base = [plain(90) for _ in range(12)]
    item = " ".join(f"question{k}" for k in range(25))
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(50, base[3]), (51, base[4].replace(base[4].split()[44], "other", 1)), (52, f"{base[5][:200]} {item} {plain(30)}"), (53, "too short")]
    rows += [(54, plain(60) + " password=abcdef123"), (55, None), (56, "### " * 80)]
    table = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) == {*range(12), 54}
    assert "abcdef123" not in out[54].text and out[54].n_chars == len(out[54].text) and out[54].n_tokens * 4 == len(out[54].ids)


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_join", "decontamination", "secret_scans", "bpe_encoding"]
