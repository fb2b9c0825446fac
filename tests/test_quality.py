"""Rules, contracts, audit log, ingestion and the gates of the chain."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from areascore.plans import ingest
from areascore.plans.chain import gate, register_views
from areascore.quality import audit, contracts, rules
from areascore.quality.rules import Rule
from areascore.settings import SOURCES
from areascore.sources import tabular


@pytest.fixture(scope="module")
def table(spark):
    return spark.sql(
        "SELECT * FROM VALUES ('a', 10), ('b', NULL), ('b', 120), (NULL, 50), ('c', -1), (NULL, 7) AS t(k, x)"
    )


def verdicts(df, *chosen):
    rows = rules.evaluate(df, chosen).orderBy("rule_no").collect()
    return [(r["evaluated"], r["violations"], r["success"]) for r in rows]


def test_each_kind_of_rule(table):
    assert verdicts(
        table,
        Rule("not_null", "k"),
        Rule("unique", "k"),
        Rule("between", "x", 0, 100),
        Rule("between", "x", 0, 100, mostly=0.6),
        Rule("between", "x", 0, 100, where="k = 'a'"),
        Rule("regex", "k", pattern="^[ab]$"),
        Rule("row_count", low=6, high=6),
        Rule("row_count", low=7, high=9),
        Rule("mean", "x", 37, 38),
    ) == [
        (6, 2, False), (4, 2, False), (5, 2, False), (5, 2, True), (1, 0, True), (4, 1, False), (6, 0, True),
        (6, 0, False), (5, 0, True),
    ]


def test_rules_on_an_empty_table(table):
    empty = table.where("false")
    assert verdicts(empty, Rule("not_null", "k"), Rule("unique", "k"), Rule("between", "x", 0, 1)) == [(0, 0, True)] * 3
    assert verdicts(empty, Rule("mean", "x", 0, 1), Rule("row_count", low=1, high=2)) == [(0, 0, False)] * 2


def test_a_crowded_key_counts_every_repeated_row(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert verdicts(df, Rule("unique", "k")) == [(3000, 1000, False)]


def test_two_keys_in_one_pass(table):
    assert verdicts(table, Rule("unique", "k"), Rule("unique", "x")) == [
        *verdicts(table, Rule("unique", "k")), *verdicts(table, Rule("unique", "x")),
    ]


def test_one_failed_rule_of_ten_still_passes(spark):
    def results(passed):
        return spark.range(10).select((F.col("id") < passed).alias("success"))

    assert rules.require_pass(results(9)) == 90.0
    with pytest.raises(rules.QualityError):
        rules.require_pass(results(8))


def test_lettered_departments_fail_only_the_digits_rule(spark):
    master = spark.sql(
        "SELECT iris_code, '1' bv_code, 50 score_esg_0_100, 70 pct_completude, 10 taux_pauvrete_60, "
        "5 taux_chomage_pct FROM VALUES ('2A0040101'), ('010010000') AS t(iris_code)"
    )
    suite = [replace(r, low=1, high=10) if r.kind == "row_count" else r for r in rules.MASTER_SUITE]
    results = rules.evaluate(master, suite)
    assert [r["kind"] for r in results.where("NOT success").collect()] == ["regex"]
    assert rules.require_pass(results) == 90.0


def test_references_and_duplicates(spark, table):
    parent = spark.sql("SELECT * FROM VALUES ('a'), ('b') AS t(k)")
    assert [r["k"] for r in rules.orphans(table, parent, "k").collect()] == ["c"]
    repeated = {r["k"]: r["occurrences"] for r in rules.duplicates(table, "k").collect()}
    assert repeated == {"b": 2, None: 2}
    assert sorted(r["x"] for r in rules.out_of_range(table, "x", 0, 100, "k").collect()) == [-1, 120]


def test_a_gate_names_what_failed(spark):
    table_rules = {"silver_x": (Rule("not_null", "k"),)}
    good, bad = spark.sql("SELECT 1 AS k"), spark.sql("SELECT CAST(NULL AS INT) AS k")
    areas = spark.sql("SELECT 'a' AS iris_code")
    tables = {"silver_filosofi": areas, "silver_referentiel_iris": areas}
    gate({"silver_x": good, **tables}, "silver", table_rules)
    with pytest.raises(rules.QualityError, match="silver_x"):
        gate({"silver_x": bad, **tables}, "silver", table_rules)
    orphan = {"silver_filosofi": spark.sql("SELECT 'z' AS iris_code")}
    with pytest.raises(rules.QualityError, match="silver_filosofi"):
        gate({"silver_x": good, **tables, **orphan}, "silver", table_rules)


def test_contracts_report_everything_at_once(spark):
    spec = replace(SOURCES["S02"], min_rows=2, max_rows=5)
    assert contracts.contract_errors(["iris", "p22_POP"], 3, spec) == []
    found = contracts.contract_errors(["iris"], 6, spec)
    assert len(found) == 2 and "P22_POP" in found[0]
    with pytest.raises(contracts.ContractError, match="too few"):
        contracts.require_contract(["IRIS", "P22_POP"], 1, spec)
    row = contracts.contract_report(spark.range(6).toDF("iris"), spec).first()
    assert (row["missing_columns"], row["too_many_rows"], row["accepted"]) == (1, True, False)


LOG = (
    "SELECT s AS source_id, s AS source_name, '2021' AS millesime, st AS status, n AS row_count, "
    "size AS file_size_bytes, CAST(at AS TIMESTAMP) AS ingested_at FROM VALUES "
    "('A', 'SUCCESS', 100, 1L, '2024-01-01'), ('A', 'SUCCESS', 130, 2L, '2024-01-05'), "
    "('A', 'FAILED', 9, 3L, '2024-01-09'), ('B', 'SUCCESS', 100, 4L, '2024-01-01'), "
    "('B', 'SUCCESS', 120, 5L, '2024-01-01'), ('C', 'SUCCESS', 7, 6L, '2023-12-22'), "
    "('D', 'SUCCESS', 0, 7L, '2023-12-01'), ('D', 'SUCCESS', 5, 8L, '2023-12-05'), "
    "('E', 'SUCCESS', CAST(NULL AS INT), 9L, '2023-12-26') AS t(s, st, n, size, at)"
)


def test_questions_to_the_log(spark):
    log = spark.sql(LOG)
    last = {r["source_id"]: r["row_count"] for r in audit.last_row_count(log).collect()}
    assert last == {"A": 130, "B": 120, "C": 7, "D": 5}
    assert [r["row_count"] for r in audit.last_row_count(log, "A").collect()] == [130]
    drift = {r["source_id"]: (r["delta_pct"], r["verdict"]) for r in audit.row_count_drift(log).collect()}
    assert drift == {"A": (30, "warn"), "B": (20, "ok"), "C": (None, "skipped"), "D": (None, "skipped")}
    age = {r["source_id"]: r["verdict"] for r in audit.freshness(log, "2024-01-09").collect()}
    assert age == {"A": "ok", "B": "ok", "C": "warn", "D": "error", "E": "ok"}
    summary = {r["source_id"]: r for r in audit.summary(log).collect()}
    assert (summary["A"]["nb_runs_total"], summary["A"]["nb_succes"], summary["A"]["nb_echecs"]) == (3, 2, 1)
    assert (summary["A"]["dernier_row_count"], summary["A"]["dernier_row_count_exact"]) == (130, 9)
    newest = audit.recent_loads(log, 3).collect()
    assert [(r["source_id"], r["row_count"]) for r in newest] == [("A", 9), ("A", 130), ("A", 100)]


def test_log_records_are_checked(spark, tmp_path):
    path = str(tmp_path / "log")
    record = {"source_id": "S01", "source_name": "x", "file_name": "f", "minio_path": "p"}
    audit.append_load(spark, path, **record, row_count=3)
    with pytest.raises(ValueError, match="status"):
        audit.append_load(spark, path, **record, status="DONE")
    with pytest.raises(ValueError, match="source_name"):
        audit.append_load(spark, path, **{**record, "source_name": None})
    assert audit.try_append_load(spark, path, **{**record, "file_name": None}) is False
    assert audit.read_loads(spark, path).count() == 1
    with pytest.raises(ValueError):
        audit.append_model_run(spark, path, run_id="r", model_name="m", layer="bronze", status="SUCCESS")


@pytest.fixture
def places(tmp_path):
    return {k: str(tmp_path / k) for k in ("landing", "bronze", "log")}


def test_ingestion_succeeds_and_is_logged(spark, tmp_path, places):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("IRIS;DISP_MED21;DISP_TP6021\n010010000;s;1,5\n")
    spec = replace(SOURCES["S01"], min_rows=1, max_rows=5)
    for run in ("1", "2"):
        done = ingest.ingest_source(
            spark, spec, str(source), ["iris", "disp_med21", "disp_tp6021"], **places, run_id="r", run_ts=run
        )
    assert (done["row_count"], done["detected_format"], len(done["checksum_md5"])) == (1, "csv", 32)
    bronze = tabular.read_bronze(spark, places["bronze"] + "/raw_filosofi_iris").collect()
    assert [tuple(r) for r in bronze] == [("010010000", "s", "1,5")]
    log = audit.read_loads(spark, places["log"]).collect()
    assert [(r["status"], r["row_count"]) for r in log] == [("SUCCESS", 1)] * 2
    assert len({r["checksum_md5"] for r in log}) == 1


def test_a_broken_contract_is_logged_and_leaves_bronze_alone(spark, tmp_path, places):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("IRIS;DISP_MED21;DISP_TP6021\n010010000;s;1,5\n")
    for spec, message in (
        (replace(SOURCES["S01"], min_rows=2), "too few"),
        (replace(SOURCES["S01"], min_rows=1, key_columns=("IRIS", "OTHER")), "OTHER"),
    ):
        with pytest.raises(contracts.ContractError, match=message):
            ingest.ingest_source(spark, spec, str(source), ["iris"], **places, run_id="r", run_ts=message[:3])
    log = audit.read_loads(spark, places["log"]).collect()
    assert [r["status"] for r in log] == ["FAILED", "FAILED"] and all(r["error_message"] for r in log)
    assert not (tmp_path / "bronze").exists()


def test_ingestion_of_archives_layers_and_preambles(spark, tmp_path, places):
    import pandas as pd
    from test_sources import write_zip

    from areascore.sources import packing

    inputs = {}
    for source_id in ("S02", "S09", "S11"):
        inputs[source_id] = tmp_path / source_id
        inputs[source_id].mkdir()
    write_zip(inputs["S02"] / "a.zip", {"t.csv": "IRIS;P22_POP\n010010000;859\n010020000;120\n"})
    layer = pd.DataFrame({"district": ["1"], "nombre": ["2.5"], "taux": ["3"]})
    (inputs["S09"] / "a.gpkg").write_bytes(packing.layer_bytes(layer, SOURCES["S09"].layer))
    (inputs["S11"] / "zones.xls").write_text("Zones\n2021\nCODGEO,LIB\n01001,x\n")
    columns = {"S02": ["iris", "p22_pop"], "S09": list(layer.columns), "S11": ["codgeo", "lib"]}
    formats = {}
    for source_id, folder in inputs.items():
        spec = replace(SOURCES[source_id], min_rows=1, max_rows=9)
        done = ingest.ingest_source(
            spark, spec, str(folder), columns[source_id], **places, run_id="r", run_ts="1"
        )
        formats[source_id] = (done["detected_format"], done["row_count"])
    assert formats == {"S02": ("zip_csv", 2), "S09": ("gpkg", 1), "S11": ("xls", 1)}
    assert tabular.read_bronze(spark, places["bronze"] + "/raw_zrr_communes").first()["codgeo"] == "01001"


def test_catchment_map_in_a_windows_encoding(spark, tmp_path, places):
    source = tmp_path / "map.csv"
    source.write_bytes("IRIS;Code Bassin de Vie;Libelle Bassin de Vie\n1;2;Forêt – œ\n".encode("cp1252"))
    spec = replace(SOURCES["S12"], min_rows=1)
    ingest.ingest_catchment_map(spark, str(source), **places, run_id="r", run_ts="1", spec=spec)
    row = tabular.read_bronze(spark, places["bronze"] + "/raw_internal_bv_iris").first()
    assert row.asDict() == {"code_iris": "1", "code_bv": "2", "lib_bv": "Forêt – œ"}
    with pytest.raises(Exception):
        missing = str(tmp_path / "none.csv")
        ingest.ingest_catchment_map(spark, missing, **places, run_id="r", run_ts="2", spec=spec)
    assert audit.read_loads(spark, places["log"]).where("status = 'FAILED'").count() == 1


def test_views_under_their_own_names(spark):
    register_views({"gold_some_table": spark.sql("SELECT 1 AS x")})
    assert spark.sql("SELECT x FROM gold_some_table").first()["x"] == 1


def test_stamps_are_a_parameter(spark):
    from areascore.plans.chain import stamped

    row = stamped(spark.range(1), datetime(2024, 1, 1)).first()
    assert row["dbt_updated_at"] == datetime(2024, 1, 1)
