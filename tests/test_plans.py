"""Tables end to end: against SQL on another engine, invariants, and the shape of physical plans."""

from __future__ import annotations

import re

import duckdb
import pytest
from conftest import SMALL, plan_of
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from areascore import catalog
from areascore.catalog import MASTER, layers, unbounded
from areascore.plans import gold, silver
from areascore.plans.chain import run_chain
from areascore.quality import rules
from areascore.settings import GOLD_TABLES, SILVER_TABLES
from areascore.sources.fixtures import raw_table
from check import TABLES, table

# Queries that build all tables again are left to check.py; their operators are covered here.
SLOW = ("run_", "q_not_null", "q_unique", "q_range", "q_relationships", "q_referential_complete")
CHECKED = [name for name in oracle_sql() if not name.startswith(SLOW)]


@pytest.fixture(scope="module")
def other_engine():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return db


# Queries on the master table that take the lazy plan; the others read stored tables to save time.
LAZY = {"gold_area_final", "gold_governance", "gold_environment", "gold_social", "q_suite", "b6_key_indicators"}


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, other_engine, stored, monkeypatch, name):
    if name not in LAZY:
        monkeypatch.setattr(catalog, "layers", lambda *_args, **_kwargs: stored)
    df = queries()[name](spark, SMALL)
    result = other_engine.execute(oracle_sql()[name])
    wanted = table([c[0] for c in result.description], result.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == wanted


def test_every_query_has_sql():
    # Training-data queries beyond SQL are held against brute force in tests/llm.
    assert set(catalog.QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 150 and len(df.columns) == 58


@pytest.fixture(scope="module")
def stored(spark):
    return layers(spark, SMALL, stored=True)


def test_master_has_every_area_once_and_scores_in_range(stored):
    master, areas = stored.table(MASTER), stored.table("silver_referentiel_iris")
    assert master.count() == areas.count() == master.select("iris_code").distinct().count()
    assert master.where("score_esg_0_100 IS NULL OR score_esg_0_100 NOT BETWEEN 0 AND 100").count() == 0


def test_basins_add_up(stored):
    basins, master = stored.table("gold_esg_bassin_vie_final"), stored.table(MASTER)
    assert basins.agg(F.sum("nb_iris")).first()[0] == master.where("population_totale > 0").count()
    mixed = F.expr("score_social_pondere * 0.5 + score_env_pondere * 0.25 + score_gouvernance_pondere * 0.25")
    assert basins.where(F.abs(mixed - F.col("score_esg_pondere")) > 0.02).count() == 0


def test_stored_and_lazy_tables_are_the_same(spark, stored):
    lazy = layers(spark, SMALL)
    for name in (MASTER, "gold_indicateurs_g"):
        assert lazy.table(name).exceptAll(stored.table(name)).count() == 0


def test_published_columns(stored):
    widths = {"gold_esg_iris_final": 58, "gold_esg_bassin_vie_final": 24, "silver_bpe": 17, "silver_rp_logement": 24}
    for name, width in widths.items():
        assert len(stored.table(name).columns) == width
    assert list(gold.BASIN_OUT) == stored.table("gold_esg_bassin_vie_final").columns


def test_repeated_rows_outside_the_referential_repeat_the_area(spark):
    """Only the referential removes duplicates; elsewhere the uniqueness rule has to notice."""
    areas = silver.referential(raw_table(spark, SMALL, "raw_internal_bv_iris"))
    housing = silver.clean_housing(raw_table(spark, SMALL, "raw_rp_logement_iris"))
    energy = silver.clean_energy(raw_table(spark, SMALL, "raw_passoires_energetiques_iris"))
    twice = gold.environment(areas, housing.union(housing), energy)
    result = rules.evaluate(twice, [rules.Rule("unique", "iris_code")]).first()
    inside = housing.join(areas.select("iris_code"), "iris_code", "left_semi").count()
    assert result["violations"] == 2 * inside > 0 and not result["success"]


def test_chain_writes_tests_and_registers(spark, tmp_path):
    table_rules = {t: tuple(map(unbounded, rs)) for t, rs in rules.TABLE_RULES.items()}
    suite = tuple(map(unbounded, rules.MASTER_SUITE))
    raw = lambda name: raw_table(spark, SMALL, name)
    done = run_chain(spark, raw, str(tmp_path), suite=suite, table_rules=table_rules, as_tables=True)
    assert set(done.tables) == {*SILVER_TABLES, *GOLD_TABLES} and done.success_pct == 100
    assert done.rows[MASTER] == 150 and len(done.tables[MASTER].columns) == 59
    assert done.tables[MASTER].columns[-2:] == ["dbt_updated_at", "version_modele"]
    found = spark.sql("SELECT count(*) FROM gold.gold_esg_iris_final WHERE dbt_updated_at IS NOT NULL")
    assert found.first()[0] == 150
    broken = {**table_rules, "silver_filosofi": (rules.Rule("between", "taux_pauvrete_60", 0, 1),)}
    with pytest.raises(rules.QualityError, match="taux_pauvrete_60"):
        run_chain(spark, raw, str(tmp_path / "second"), suite=suite, table_rules=broken)
    assert not (tmp_path / "second" / "gold").exists()


# --- plans ---------------------------------------------------------------------------------------


@pytest.fixture
def without_broadcasts(spark):
    """Plans as they are when no side is small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    yield
    spark.conf.set(key, before)


def written(spark, tmp_path, df, name):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange (\w+\([\w#, ]*\)|\w+)", plan)


def test_star_shuffles_each_side_once(spark, without_broadcasts, tmp_path, stored):
    areas = stored.table("silver_referentiel_iris")
    sides = ("silver_filosofi", "silver_rp_population", "silver_rp_activite")
    plan = plan_of(gold.social(areas, *(stored.table(s) for s in sides)))
    assert len(exchanges(plan)) == 4 and all(e.startswith("hashpartitioning(iris_code") for e in exchanges(plan))


def test_facilities_aggregate_before_the_shuffle_and_join_without_another(spark, without_broadcasts, tmp_path, stored):
    raw = written(spark, tmp_path, raw_table(spark, SMALL, "raw_bpe_iris"), "facts")
    plan = plan_of(silver.build("silver_bpe", raw, stored.table("silver_referentiel_iris")))
    # One shuffle for the partial sums, one for the referential, none for the join itself.
    assert len(exchanges(plan)) == 2
    fact_side = plan[plan.index("hashpartitioning"):]
    assert fact_side.index("partial_sum") < fact_side.index("FileScan")


def test_scans_read_only_needed_columns(spark, tmp_path):
    raw = written(spark, tmp_path, raw_table(spark, SMALL, "raw_rp_population_iris"), "population")
    plan = plan_of(silver.clean_population(raw).select("iris_code", "population_totale"), "formatted")
    assert "ReadSchema: struct<iris:string,p22_pop:string>" in plan


def test_no_python_in_table_plans(spark, stored):
    for name in ("silver_filosofi", "silver_bpe"):
        plan = plan_of(layers(spark, SMALL).table(name))
        assert "Python" not in plan and "Pandas" not in plan


def test_only_small_results_meet_in_one_task(spark, without_broadcasts, stored):
    """Whole tables are never gathered: a single partition only ever holds aggregates."""
    lines = plan_of(stored.table("gold_esg_bassin_vie_final")).splitlines()
    assert not any("SinglePartition" in line for line in lines)
    suite = plan_of(rules.evaluate(stored.table(MASTER), rules.MASTER_SUITE)).splitlines()
    below = [after for line, after in zip(suite, suite[1:]) if "SinglePartition" in line]
    assert below and all("partial_sum" in line for line in below)


def test_suite_reads_the_master_table_once(spark, stored):
    assert plan_of(rules.evaluate(stored.table(MASTER), rules.MASTER_SUITE)).count("FileScan") == 1
