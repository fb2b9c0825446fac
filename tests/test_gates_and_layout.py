"""Stored layout, gates with quarantine, several keys in one scan, references in one aggregation."""

from __future__ import annotations

import pytest
from conftest import SMALL, plan_of
from pyspark.sql import functions as F

from areascore.catalog import MASTER, faulty_raw, unbounded
from areascore.operators import keys
from areascore.plans import gold
from areascore.plans.chain import run_chain
from areascore.quality import rules
from areascore.sources.fixtures import raw_table

AREAS = "silver_referentiel_iris"
OPTIONS = {
    "suite": tuple(map(unbounded, rules.MASTER_SUITE)),
    "table_rules": {t: tuple(map(unbounded, rs)) for t, rs in rules.TABLE_RULES.items()},
}


@pytest.fixture
def without_broadcasts(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    yield
    spark.conf.set(key, before)


@pytest.fixture(scope="module")
def quarantined(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("quarantine"))
    return run_chain(spark, lambda n: faulty_raw(spark, SMALL, n), root, quarantine=True, buckets=5, **OPTIONS)


def test_stored_tables_join_where_they_lie(spark, without_broadcasts, tmp_path):
    done = run_chain(spark, lambda n: raw_table(spark, SMALL, n), str(tmp_path), buckets=6, **OPTIONS)
    stars = {
        "environment": gold.environment(done.tables[AREAS], done.tables["silver_rp_logement"], done.tables["silver_passoires_energetiques"]),
        "social": gold.social(done.tables[AREAS], *(done.tables[f"silver_{n}"] for n in ("filosofi", "rp_population", "rp_activite"))),
        "master": gold.area_master_from_pillars(done.tables[AREAS], *(done.tables[f"gold_indicateurs_{p}"] for p in "esg")),
    }
    for name, star in stars.items():
        plan = plan_of(star)
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan, name
    # One file a bucket, whatever the number of tasks.
    assert len([f for f in (tmp_path / "silver" / AREAS).iterdir() if f.name.startswith("part-")]) <= 6


def test_rows_that_break_a_rule_are_split_off_by_the_write(spark, quarantined):
    commune = F.substring("iris_code", 5, 1)
    bad = quarantined.quarantined
    areas = bad[AREAS]
    assert areas.count() == areas.where(commune == "7").count() > 0
    assert {tuple(r["_broken"]) for r in areas.select("_broken").collect()} == {("not_null:bv_code",)}
    housing = bad["silver_rp_logement"]
    assert housing.count() == 2 * housing.select("iris_code").distinct().count() > 0
    good = quarantined.tables
    assert good[AREAS].where("bv_code IS NULL").isEmpty() and "_broken" not in good[AREAS].columns
    assert quarantined.rows[AREAS] == good[AREAS].count() == good[MASTER].count()
    assert quarantined.success_pct == 100 and bad[MASTER].isEmpty()
    assert "PartitionFilters: [" in plan_of(good[AREAS], "formatted") and "_quarantined" in plan_of(good[AREAS], "formatted")


def test_a_gate_names_what_failed_and_what_is_not_built(spark, tmp_path):
    with pytest.raises(rules.QualityError) as stopped:
        run_chain(spark, lambda n: faulty_raw(spark, SMALL, n), str(tmp_path), **OPTIONS)
    assert {f[:3] for f in stopped.value.failed} == {
        (AREAS, "not_null", "bv_code"), ("silver_filosofi", "between", "taux_pauvrete_60"), ("silver_rp_logement", "unique", "iris_code"),
    }
    assert stopped.value.not_built[0] == "gold_indicateurs_e" and len(stopped.value.not_built) == 5
    assert not (tmp_path / "gold").exists()


def test_broken_rules_of_edge_rows(spark):
    rows = spark.createDataFrame([(1, "a", 5.0), (1, "b", None), (2, None, 11.0), (None, "c", 1.0), (None, "d", 0.0)], "k int, t string, v double")
    checks = (rules.Rule("unique", "k"), rules.Rule("not_null", "t"), rules.Rule("between", "v", 0, 10), rules.Rule("regex", "t", pattern="^[ab]$"), rules.Rule("row_count", low=9, high=9))
    got = {(r["k"], r["t"]): r["b"] for r in rows.withColumn("b", rules.broken_rules(rows, checks)).collect()}
    assert got == {
        (1, "a"): ["unique:k"], (1, "b"): ["unique:k"], (2, None): ["not_null:t", "between:v"], (None, "c"): ["regex:t"], (None, "d"): ["regex:t"],
    }
    assert rows.withColumn("b", rules.broken_rules(rows, [])).where("size(b) > 0").isEmpty()


def test_several_unique_keys_share_one_scan(spark, tmp_path):
    spark.range(1000).select(
        F.col("id").alias("a"), (F.col("id") % 400).alias("b"), F.when(F.col("id") > 2, F.lit(1)).alias("c")
    ).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    checks = [rules.Rule("unique", k) for k in "abc"] + [rules.Rule("not_null", "c"), rules.Rule("between", "a", 0, 997), rules.Rule("row_count", low=1000, high=1000)]
    result = rules.evaluate(table, checks)
    assert plan_of(result).count("FileScan") == 1 and plan_of(result).count("Expand") == 1
    got = [(r["kind"], r["evaluated"], r["violations"], r["success"]) for r in result.collect()]
    assert got == [
        ("unique", 1000, 0, True), ("unique", 1000, 1000, False), ("unique", 997, 997, False), ("not_null", 1000, 3, False),
        ("between", 1000, 2, False), ("row_count", 1000, 0, True),
    ]


def test_references_take_one_exchange_by_key(spark, without_broadcasts, tmp_path):
    for name, codes in {"p": ["1", "2", "3", None], "c": ["1", "1", "9", None, "8"], "d": ["7", "2", "7"]}.items():
        spark.createDataFrame([(c,) for c in codes], "k string").write.parquet(str(tmp_path / name))
    tables = {n: spark.read.parquet(str(tmp_path / n)) for n in "pcd"}
    references = [rules.Reference("c", "p", "k"), rules.Reference("d", "p", "k"), rules.Reference("d", "c", "k")]
    found = rules.evaluate_references(tables, references)
    assert plan_of(found).count("Exchange hashpartitioning(key") == 1 and "Join" not in plan_of(found)
    assert [r["violations"] for r in found.collect()] == [2, 2, 3]
    lacking = keys.absent_from(tables["p"], {n: tables[n] for n in "cd"}, "k")
    assert plan_of(lacking).count("Exchange hashpartitioning(key") == 1
    assert sorted(map(tuple, lacking.collect())) == [("c", "2"), ("c", "3"), ("d", "1"), ("d", "3")]
    with pytest.raises(ValueError, match="no reference"):
        rules.evaluate_references(tables, [])
