"""The whole chain: raw tables -> silver -> gate -> gold -> gate -> acceptance suite."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from decimal import Decimal
from itertools import groupby

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from areascore.plans.layers import Layers, level, raw_inputs
from areascore.quality import audit, rules
from areascore.session import compiled_methods, measured_broadcasts
from areascore.settings import GOLD_TABLES, SILVER_TABLES

#: Key that a stored table is laid out by: areas, or catchments where it has no areas.
LAYOUT_KEYS = ("iris_code", "bv_code")
BROKEN, QUARANTINED = "_broken", "_quarantined"
#: Tables that do not depend on one another whose jobs are submitted at once; Spark shares the cluster among them.
AT_ONCE = 4


@dataclass
class ChainResult:
    tables: dict[str, DataFrame]
    rows: dict[str, int]
    test_results: dict[str, DataFrame] = field(default_factory=dict)
    success_pct: float | None = None
    quarantined: dict[str, DataFrame] = field(default_factory=dict)
    skipped: dict[str, tuple[str, ...]] = field(default_factory=dict)


def stamped(df: DataFrame, as_of: datetime | None) -> DataFrame:
    """Add the update time: a given one for repeatable runs, else the time of the query.

    The model version, where a table has one, stays its last column.
    """
    when = F.current_timestamp() if as_of is None else F.lit(as_of)
    names = [c for c in df.columns if c != "version_modele"]
    last = [c for c in df.columns if c == "version_modele"]
    return df.select(*names, when.alias("dbt_updated_at"), *last)


def run_chain(
    spark: SparkSession,
    raw: Callable[[str], DataFrame],
    root: str,
    run_log: str | None = None,
    as_of: datetime | None = None,
    suite: tuple[rules.Rule, ...] = rules.MASTER_SUITE,
    table_rules: Mapping[str, tuple[rules.Rule, ...]] = rules.TABLE_RULES,
    as_tables: bool = False,
    buckets: int | None = None,
    quarantine: bool = False,
    absent: Collection[str] = (),
) -> ChainResult:
    """Build and write every table under ``root``; stop at the first layer whose tests fail.

    Each table is written once, its rows counted on the way, and read back by what depends on it; tables that do not
    depend on one another are written at the same time. Tables are laid
    out in ``buckets`` by their key (by default as many as the cluster has cores), so that the stars of the gold
    layer join stored tables where they lie.
    ``as_tables`` also registers the tables as ``silver.<name>`` and ``gold.<name>``, else they are known to the
    catalog under names of this run only.
    With ``quarantine``, rows that break a rule on rows are split off by the write itself, into a partition of their own
    with the rules they break; the chain goes on with the others, and gates judge those. Else a gate that
    finds a broken rule raises ``QualityError``, which names the failed rules and the tables not built.
    Tables that depend on a raw table in ``absent`` are skipped, all others are built and tested.
    """
    run_id = uuid.uuid4().hex
    counts: dict[str, int] = {}
    n_buckets = buckets or spark.sparkContext.defaultParallelism
    result = ChainResult(tables={}, rows=counts)
    logging = threading.Lock()

    def logged(**record) -> None:
        # Two appends to one folder may not overlap.
        if run_log:
            with logging:
                audit.append_model_run(spark, run_log, **record)

    def write(df: DataFrame, name: str) -> DataFrame:
        started, clock = datetime.now(), time.monotonic()
        layer = name.split("_", 1)[0]
        record = {"run_id": run_id, "model_name": name, "layer": layer, "started_at": started}
        watched = Observation(f"{name}_{run_id}")
        complete = stamped(df, as_of)
        table = f"chain_{run_id}_{name}"
        if as_tables:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
            table = f"{layer}.{name}"
        try:
            _write_bucketed(
                complete, table, f"{root}/{layer}/{name}", n_buckets, watched,
                table_rules.get(name, ()) if quarantine else None,
            )
        except Exception as error:
            logged(**record, status="ERROR", error_message=str(error))
            raise
        counts[name] = watched.get["rows"]
        seconds = Decimal(f"{time.monotonic() - clock:.3f}")
        logged(**record, status="SUCCESS", rows_affected=counts[name], execution_time_s=seconds, finished_at=datetime.now())
        stored = spark.table(table)
        if quarantine:
            result.quarantined[name] = stored.where(QUARANTINED).select(*complete.columns, BROKEN)
            stored = stored.where(f"NOT {QUARANTINED}")
        return stored.select(*complete.columns)

    published = set(SILVER_TABLES) | set(GOLD_TABLES)

    def store(df: DataFrame, name: str) -> DataFrame:
        if name in published:
            return write(df, name)
        path = f"{root}/work/{run_id}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    with compiled_methods(spark), measured_broadcasts(spark):
        return _build(spark, Layers(raw, stored=True, store=store), result, {"run_id": run_id}, logged, set(absent), suite, table_rules)


def _build(
    spark: SparkSession,
    layers: Layers,
    result: ChainResult,
    run: dict,
    logged: Callable[..., None],
    absent: set[str],
    suite: tuple[rules.Rule, ...],
    table_rules: Mapping[str, tuple[rules.Rule, ...]],
) -> ChainResult:
    """All tables layer by layer, each layer tested before the next, and the suite on the master table."""
    for stage_name, names in (("silver", SILVER_TABLES), ("gold", GOLD_TABLES)):
        for name in names:
            missing = sorted(raw_inputs(name) & absent)
            if missing:
                result.skipped[name] = tuple(missing)
                logged(**run, model_name=name, layer=stage_name, status="SKIPPED", error_message=f"without {missing}")
        # What a table is built from stands on a lower level, so that it is there before.
        for _, level_names in groupby(sorted((n for n in names if n not in result.skipped), key=level), level):
            together = list(level_names)
            with ThreadPoolExecutor(AT_ONCE) as pool:
                built = dict(zip(together, pool.map(inheritable_thread_target(spark)(layers.table), together)))
            result.tables |= built
        for facts in (result.tables, result.rows, result.quarantined):
            for name in [n for n in names if n in facts]:
                facts[name] = facts.pop(name)
        tested = gate(result.tables, stage_name, table_rules)
        if tested is not None:
            result.test_results[stage_name] = tested
    if "gold_esg_iris_final" not in result.tables:
        return result
    verdict = rules.evaluate(result.tables["gold_esg_iris_final"], suite)
    result.test_results["suite"] = verdict
    result.success_pct = rules.require_pass(verdict)
    return result


def _write_bucketed(
    df: DataFrame, table: str, path: str, buckets: int, watched: Observation, row_rules: tuple[rules.Rule, ...] | None
) -> None:
    """One file per bucket, in key order; the rows that break ``row_rules`` in files of their own."""
    key = next(k for k in LAYOUT_KEYS if k in df.columns)
    dealt = df.repartition(buckets, key)
    kept = F.count(F.lit(1))
    if row_rules is not None:
        dealt = dealt.withColumn(BROKEN, rules.broken_rules(dealt, row_rules))
        dealt = dealt.withColumn(QUARANTINED, F.size(BROKEN) > 0)
        kept = F.count_if(~F.col(QUARANTINED))
    writer = dealt.observe(watched, kept.alias("rows")).write.mode("overwrite").format("parquet").option("path", path)
    if row_rules is not None:
        writer = writer.partitionBy(QUARANTINED)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def gate(
    tables: dict[str, DataFrame],
    stage_name: str,
    table_rules: Mapping[str, tuple[rules.Rule, ...]] = rules.TABLE_RULES,
) -> DataFrame | None:
    """Test the tables of one layer; raise if any rule or reference is broken. None if no table has a rule."""
    own = {n: t for n, t in tables.items() if n.startswith(stage_name)}
    ruled = {n: t for n, t in own.items() if table_rules.get(n)}
    results = rules.evaluate_tables(ruled, table_rules) if ruled else None
    failed = []
    if results is not None:
        broken = results.where("NOT success").select("table_name", "kind", "column_name", "violations")
        failed = [tuple(r) for r in broken.collect()]
    references = [r for r in rules.REFERENCES if r.child in own and r.parent in tables]
    if references:
        lost = rules.evaluate_references(tables, references).where("violations > 0").collect()
        failed += [(r["table_name"], "reference", r["column_name"], r["violations"]) for r in lost]
    if failed:
        not_built = [n for n in (*SILVER_TABLES, *GOLD_TABLES) if n not in tables]
        raise rules.QualityError(f"{stage_name} tests failed: {failed}", failed, not_built)
    return results


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make the tables available to ``spark.sql`` under their own names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
