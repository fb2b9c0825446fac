"""Tables replaced as a whole, digests of files of any size, drift against earlier loads, the chain from files."""

from __future__ import annotations

import hashlib
import logging
import threading
from dataclasses import replace

import pytest
from conftest import SMALL
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from areascore.catalog import BASINS, MASTER, NO_BOUND, _chain_options, _delivered
from areascore.plans import delivery, ingest
from areascore.plans.layers import INPUTS, raw_inputs
from areascore.quality import audit
from areascore.settings import GOLD_TABLES, SILVER_TABLES, SOURCES
from areascore.sources import containers, tabular
from areascore.sources.versions import Overtaken, VersionedTable

# --- versions ------------------------------------------------------------------------------------


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    old = tabular.load_bronze(spark.range(5), path)
    failing = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") > 900, F.raise_error(F.lit("midway")).cast("long")).otherwise(F.col("id")).alias("id"))
    for mode in ("replace", "append"):
        with pytest.raises(PySparkException, match="midway"):
            tabular.load_bronze(failing, path, mode)
        assert tabular.read_bronze(spark, path).count() == 5
    assert len([f for f in (tmp_path / "t").iterdir() if f.name.startswith("data-")]) == 3
    tabular.load_bronze(spark.range(2), path)
    assert old.count() == 5  # who reads the old version goes on reading it
    VersionedTable(spark, path).prune()
    assert tabular.read_bronze(spark, path).count() == 2
    assert len([f for f in (tmp_path / "t").iterdir() if f.name.startswith("data-")]) == 1


def test_of_two_writers_the_later_decides_anew(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    start = table.current()
    first, second = table.stage(spark.range(1)), table.stage(spark.range(2))
    assert table.commit(start, (first,), {"rows": 1}).number == 1
    with pytest.raises(Overtaken):
        table.commit(start, (second,), {"rows": 2})
    assert table.current().facts == {"rows": 1} and table.read().count() == 1
    asked = []

    def decide(before):
        asked.append(before.facts.get("rows"))
        if len(asked) == 1:  # another writer comes in between
            table.commit(before, (first,), {"rows": 7})
        return {"rows": 2}

    assert table.publish(second, decide).number == 3 and asked == [1, 7]
    assert table.publish(first, lambda before: None).number == 3


def test_many_writers_lose_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    writers = [threading.Thread(target=tabular.load_bronze, args=(spark.range(3), path, "append")) for _ in range(6)]
    for each in writers:
        each.start()
    for each in writers:
        each.join()
    assert tabular.read_bronze(spark, path).count() == 18 and VersionedTable(spark, path).current().number == 6


# --- digests -------------------------------------------------------------------------------------


def test_digests_of_files_of_any_size(spark, tmp_path):
    body = b"".join(b"line %d \xe9\r\n" % k for k in range(50_000)) + b"no end"
    (tmp_path / "small").write_bytes(b"abc\n")
    (tmp_path / "large").write_bytes(body)
    moved = body.replace(b"line 7 ", b"line 8 ", 1).replace(b"line 8 ", b"line 7 ", 2)
    swapped = b"\n".join([*body.split(b"\n")[1::-1], *body.split(b"\n")[2:]])
    for name, other in (("copy", body), ("moved", moved), ("swapped", swapped), ("cut", body[:-1])):
        (tmp_path / name).write_bytes(other)

    def digests(whole=1000):
        rows = containers.file_digests(spark, str(tmp_path), whole).collect()
        return {r["path"].rsplit("/", 1)[-1]: (r["checksum_md5"], r["file_size_bytes"]) for r in rows}

    one = digests()
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "50000")  # other ranges, the same digest
    try:
        assert digests() == one
    finally:
        spark.conf.set(key, before)
    assert one["small"] == (hashlib.md5(b"abc\n").hexdigest(), 4) and one["large"][1] == len(body)
    assert one["copy"] == one["large"] and len({v[0] for n, v in one.items() if n != "copy"}) == 5
    assert digests(10**9)["large"][0] == hashlib.md5(body).hexdigest()
    whole = containers.combined_digest(containers.file_digests(spark, str(tmp_path))).first()
    assert len(whole["checksum_md5"]) == 32 and whole["file_size_bytes"] == sum(v[1] for v in one.values())


# --- drift ---------------------------------------------------------------------------------------


@pytest.fixture
def places(tmp_path):
    return {k: str(tmp_path / k) for k in ("landing", "bronze", "log")}


def test_third_load_with_half_the_rows_warns(spark, tmp_path, places, caplog):
    spec = replace(SOURCES["S01"], min_rows=1, max_rows=NO_BOUND)
    done = []
    for run, n in enumerate((10, 11, 5, 5)):
        path = tmp_path / f"in{run}.csv"
        path.write_text("IRIS;DISP_MED21;DISP_TP6021\n" + "".join(f"{k:09d};1;2\n" for k in range(n)))
        with caplog.at_level(logging.WARNING):
            caplog.clear()
            done.append(ingest.ingest_source(spark, spec, str(path), ["iris"], **places, run_id="r", run_ts=str(run), reuse=True))
        warned = [r.getMessage() for r in caplog.records if "drift" in r.getMessage()]
        assert bool(warned) == (run == 2) and (run != 2 or "54.5455 %" in warned[0])
    assert [d["status"] for d in done] == ["SUCCESS"] * 3 + ["UNCHANGED"]
    assert [d["version"] for d in done] == [1, 2, 3, 3] and done[3]["row_count"] == 5
    log = {r["minio_path"][-1]: r for r in audit.read_loads(spark, places["log"]).collect()}
    assert len(log) == 3 and log["0"]["notes"] is None and log["2"]["notes"] == "row count 11 -> 5: 54.5455 % of drift, limit 20 %"
    body = (tmp_path / "in2.csv").read_bytes()
    assert (log["2"]["checksum_md5"], log["2"]["file_size_bytes"]) == (hashlib.md5(body).hexdigest(), len(body))
    assert tabular.read_bronze(spark, f"{places['bronze']}/raw_filosofi_iris").count() == 5


def test_drift_against_the_log_of_a_table_without_versions(spark, places):
    audit.append_load(spark, places["log"], source_id="S01", source_name="x", file_name="f", minio_path="p", row_count=40)
    assert ingest.logged_rows(spark, places["log"], "S01") == 40
    assert ingest.logged_rows(spark, places["log"], "S02") is None and ingest.logged_rows(spark, places["bronze"], "S01") is None
    assert audit.drift_note("S01", 31, 40) is not None and audit.drift_note("S01", 32, 40) is None
    assert audit.drift_percent(5, 0) is None and audit.drift_percent(5, None) is None


# --- files to gold -------------------------------------------------------------------------------

SPECS = {s: replace(spec, min_rows=1, max_rows=NO_BOUND) for s, spec in SOURCES.items()}


def test_files_to_gold_and_again_after_a_failure(spark, tmp_path):
    files = _delivered(spark, SMALL, faulty="S09")
    del files["S11"]
    root = str(tmp_path)
    loads, done = delivery.run_from_files(spark, files, root, "r1", "1", SPECS, run_log=f"{root}/runs", **_chain_options())
    assert {s for s, r in loads.items() if r["status"] == "FAILED"} == {"S09", "S11"}
    assert "taux" in loads["S09"]["error_message"] and "no files" in loads["S11"]["error_message"]
    assert set(done.tables) == {*SILVER_TABLES, "gold_indicateurs_s"} - {"silver_passoires_energetiques"}
    assert done.skipped[BASINS] == ("raw_passoires_energetiques_iris", "raw_zrr_communes") and done.success_pct is None
    skipped = audit.read_model_runs(spark, f"{root}/runs").where("status = 'SKIPPED'")
    assert {r["model_name"] for r in skipped.collect()} == set(done.skipped)

    loads, done = delivery.run_from_files(spark, _delivered(spark, SMALL), root, "r2", "2", SPECS, **_chain_options())
    status = {s: r["status"] for s, r in loads.items()}
    assert status["S09"] == status["S11"] == "SUCCESS" and not done.skipped and done.success_pct == 100
    assert done.rows[MASTER] == 150 and set(done.tables) == {*SILVER_TABLES, *GOLD_TABLES}
    # The same files again: no source is loaded a second time.
    log = audit.read_loads(spark, f"{root}/ingestion_log")
    assert log.where("status = 'SUCCESS'").groupBy("source_id").count().where("count > 1").isEmpty()


def test_inputs_cover_every_table():
    assert set(INPUTS) == {*SILVER_TABLES, *GOLD_TABLES}
    assert raw_inputs(BASINS) == {spec.table for spec in SOURCES.values()}
    assert raw_inputs("silver_filosofi") == {"raw_filosofi_iris", "raw_internal_bv_iris"}
