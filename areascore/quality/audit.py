"""Ingestion audit log and per-model run log: append-only tables and the questions asked of them."""

from __future__ import annotations

import logging
import uuid
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areascore.functions.numbers import RATIO

logger = logging.getLogger(__name__)

# The states a load or a model run may be in.
LOAD_STATES = ("SUCCESS", "FAILED", "PARTIAL", "RUNNING")
MODEL_STATES = ("SUCCESS", "ERROR", "SKIPPED")
MODEL_LAYERS = ("silver", "gold")

_text, _long, _time = T.StringType(), T.LongType(), T.TimestampType()

LOAD_LOG = T.StructType(
    [
        T.StructField("id", _text, False),
        T.StructField("source_id", _text, False),
        T.StructField("source_name", _text, False),
        T.StructField("source_url", _text),
        T.StructField("millesime", _text),
        T.StructField("file_name", _text, False),
        T.StructField("minio_path", _text, False),
        T.StructField("file_size_bytes", _long),
        T.StructField("row_count", _long),
        T.StructField("checksum_md5", _text),
        T.StructField("ingested_at", _time, False),
        T.StructField("ingested_by", _text),
        T.StructField("pipeline_run_id", _text),
        T.StructField("dag_id", _text),
        T.StructField("task_id", _text),
        T.StructField("status", _text, False),
        T.StructField("error_message", _text),
        T.StructField("notes", _text),
    ]
)
MODEL_LOG = T.StructType(
    [
        T.StructField("id", _text, False),
        T.StructField("run_id", _text, False),
        T.StructField("model_name", _text, False),
        T.StructField("layer", _text, False),
        T.StructField("status", _text, False),
        T.StructField("rows_affected", _long),
        T.StructField("execution_time_s", T.DecimalType(10, 3)),
        T.StructField("started_at", _time, False),
        T.StructField("finished_at", _time),
        T.StructField("error_message", _text),
    ]
)


def _append(spark: SparkSession, path: str, schema: T.StructType, record: dict) -> None:
    unknown = set(record) - set(schema.names)
    if unknown:
        raise ValueError(f"not columns of the log: {sorted(unknown)}")
    absent = [f.name for f in schema if not f.nullable and record.get(f.name) is None]
    if absent:
        raise ValueError(f"required log columns are empty: {absent}")
    row = tuple(record.get(name) for name in schema.names)
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)


def append_load(spark: SparkSession, path: str, **record) -> None:
    """Add one load. Raises on an invalid record."""
    record = {"id": str(uuid.uuid4()), "ingested_at": datetime.now(), "status": "SUCCESS", **record}
    if record["status"] not in LOAD_STATES:
        raise ValueError(f"unknown load status {record['status']}")
    _append(spark, path, LOAD_LOG, record)


def try_append_load(spark: SparkSession, path: str, **record) -> bool:
    """As ``append_load``, but a log that cannot be written must not stop an ingestion."""
    try:
        append_load(spark, path, **record)
        return True
    except Exception as error:  # noqa: BLE001 - whatever it is, the load itself goes on
        logger.error("audit record not written: %s", error)
        return False


def append_model_run(spark: SparkSession, path: str, **record) -> None:
    record = {"id": str(uuid.uuid4()), "started_at": datetime.now(), **record}
    if record.get("status") not in MODEL_STATES or record.get("layer") not in MODEL_LAYERS:
        raise ValueError("unknown model status or layer")
    _append(spark, path, MODEL_LOG, record)


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOAD_LOG).parquet(path)


def read_model_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_LOG).parquet(path)


def _load_order() -> Column:
    """Time of a load with its size as tie-break, as one number.

    A number keeps "the value at the latest load" a hash aggregation; ordering by a structure would make
    every task sort its part of the log first.
    """
    micros = F.unix_micros(F.col("ingested_at").cast("timestamp")).cast("decimal(19,0)")
    size = F.coalesce(F.col("file_size_bytes"), F.lit(0)).cast("decimal(19,0)")
    return micros * F.lit(Decimal(10**18)) + size


def summary(log: DataFrame) -> DataFrame:
    """Loads per source and vintage.

    ``dernier_row_count`` and ``dernier_file_size_bytes`` are maxima, as published;
    ``dernier_row_count_exact`` is the count of the latest load.
    """
    per_vintage = log.groupBy("source_id", "source_name", "millesime").agg(
        F.max("ingested_at").alias("derniere_ingestion"),
        F.count(F.lit(1)).alias("nb_runs_total"),
        F.sum(F.when(F.col("status") == "SUCCESS", 1).otherwise(0)).alias("nb_succes"),
        F.sum(F.when(F.col("status") == "FAILED", 1).otherwise(0)).alias("nb_echecs"),
        F.max("row_count").alias("dernier_row_count"),
        F.max("file_size_bytes").alias("dernier_file_size_bytes"),
        F.max_by("row_count", _load_order()).alias(
            "dernier_row_count_exact"
        ),
    )
    return per_vintage.orderBy("source_id", "millesime")


def counted_successes(log: DataFrame) -> DataFrame:
    return log.where((F.col("status") == "SUCCESS") & F.col("row_count").isNotNull())


def last_row_count(log: DataFrame, source_id: str | None = None) -> DataFrame:
    """Row count of the latest successful load per source."""
    chosen = counted_successes(log)
    if source_id is not None:
        chosen = chosen.where(F.col("source_id") == source_id)
    return chosen.groupBy("source_id").agg(F.max_by("row_count", _load_order()).alias("row_count"))


def row_count_drift(log: DataFrame, limit_pct: int = 20) -> DataFrame:
    """Latest successful load of each source against the one before.

    The two newest loads are kept per source by a ranking with a limit, which Spark applies before the
    shuffle, so a source with most of the log costs no more than the others. Without a previous load, or
    with a previous count of zero, the check is skipped.
    """
    newest = Window.partitionBy("source_id").orderBy(
        F.col("ingested_at").desc(), F.col("file_size_bytes").desc()
    )
    last_two = (
        counted_successes(log)
        .select("source_id", "ingested_at", "file_size_bytes", "row_count")
        .withColumn("_age", F.row_number().over(newest))
        .where("_age <= 2")
    )
    counts = last_two.groupBy("source_id").agg(
        F.max(F.when(F.col("_age") == 1, F.col("row_count"))).cast("bigint").alias("new_count"),
        F.max(F.when(F.col("_age") == 2, F.col("row_count"))).cast("bigint").alias("previous_count"),
    )
    new, previous = F.col("new_count"), F.col("previous_count")
    change = (
        F.abs(new - previous).cast("decimal(20,0)") * 100 / F.nullif(previous, F.lit(0)).cast("decimal(20,0)")
    )
    return counts.withColumn("delta_pct", change.cast(RATIO)).withColumn(
        "verdict",
        F.when(F.col("delta_pct").isNull(), "skipped")
        .when(F.col("delta_pct") > limit_pct, "warn")
        .otherwise("ok"),
    )


def drift_percent(new: int, previous: int | None) -> Decimal | None:
    """Change of a row count in percent of the one before; unknown without one, or after an empty load."""
    if not previous:
        return None
    return (Decimal(abs(new - previous)) * 100 / Decimal(previous)).quantize(Decimal("0.0001"))


def drift_note(source_id: str, new: int, previous: int | None, limit_pct: int = 20) -> str | None:
    """What to say about a load whose row count left the band around the one before; also logged as a warning."""
    drift = drift_percent(new, previous)
    if drift is None or drift <= limit_pct:
        return None
    note = f"row count {previous} -> {new}: {drift} % of drift, limit {limit_pct} %"
    logger.warning("%s: %s", source_id, note)
    return note


def freshness(log: DataFrame, as_of: str, warn_days: int = 14, error_days: int = 30) -> DataFrame:
    """Age in days of the newest load of each source, against two thresholds."""
    age = F.datediff(F.lit(as_of).cast("date"), F.max(F.to_date("ingested_at")))
    return log.groupBy("source_id").agg(age.cast("bigint").alias("age_days")).withColumn(
        "verdict",
        F.when(F.col("age_days") > error_days, "error")
        .when(F.col("age_days") > warn_days, "warn")
        .otherwise("ok"),
    )


def recent_loads(log: DataFrame, n: int = 20) -> DataFrame:
    """The newest loads, newest first."""
    newest_first = (
        F.col("ingested_at").desc(), F.col("source_id"), F.col("file_size_bytes").desc(),
    )
    return log.orderBy(*newest_first).limit(n).select(
        "source_id", "millesime", "row_count", "status", F.to_date("ingested_at").alias("ingested_on")
    )
