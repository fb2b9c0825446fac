"""Ingestion of one landed source: read, normalise, land, check, load, log.

Jobs start at files that are already on a path Spark can read. A run is written once; its row count and
fingerprint are observed during that write. A run that breaks its contract stays in the landing area for
inspection but never reaches the bronze table.

The bronze table remembers what its last load was: rows, digest of the files, run. A load of files with that digest can be
left out as finished; else its row count is compared with the one before as part of the commit, so that of two
loads that overlap the later one is compared with what the earlier one left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from areascore.functions.text import fold_to_ascii
from areascore.quality import audit
from areascore.quality.contracts import ContractError, missing_columns, require_contract
from areascore.settings import SOURCES, SourceSpec
from areascore.sources.containers import (
    combined_digest,
    detect_format,
    file_digests,
    is_container,
    read_containers,
    scan_below_header,
    scan_layer_attributes,
    scan_zip_members,
    table_fingerprint,
)
from areascore.sources.tabular import (
    as_text,
    land,
    landed,
    map_columns,
    normalize_headers,
    scan_delimited,
    scan_encoding_fallback,
)
from areascore.sources.storage import path_exists
from areascore.sources.versions import Version, VersionedTable

MAX_CONTAINER = 2**31 - 1


def source_format(spark: SparkSession, spec: SourceSpec, path: str) -> str:
    """Format of the files of a source, which must be one and the same; every file is judged.

    A file that is too large for a binary cell is judged by its first line: it may be text of any size, but
    a container cannot be opened and stops the load.
    """
    small = spark.read.format("binaryFile").load(path).where(F.col("length") <= MAX_CONTAINER)
    lines = spark.read.text(path).where(F.col("_metadata.file_size") > MAX_CONTAINER)
    heads = (
        lines.where("_metadata.file_block_start = 0")
        .select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("_id"))
        .groupBy("path")
        .agg(F.min_by("value", "_id").cast("binary").alias("content"))
    )
    container = is_container(F.col("content"))
    closed = F.when(container, F.lit("too large to open"))
    large = detect_format(heads.withColumn("content", F.when(~container, F.col("content"))), spec.file_format)
    judged = detect_format(small.select("path", "content"), spec.file_format).select("path", "detected_format")
    large = large.join(heads.select("path", closed.alias("_closed")), "path")
    large = large.select("path", F.coalesce("_closed", "detected_format").alias("detected_format"))
    both = judged.unionAll(large).groupBy("detected_format").agg(F.min("path").alias("path"))
    found = {row["detected_format"]: row["path"] for row in both.collect()}  # one row per format
    if len(found) > 1 or "too large to open" in found:
        raise ValueError(f"{spec.source_id}: files of different formats {dict(sorted(found.items()))}")
    return next(iter(found), spec.file_format)


def read_source(
    spark: SparkSession, spec: SourceSpec, path: str, columns: Sequence[str], detected: str
) -> DataFrame:
    """Text columns of a source, whatever it is wrapped in."""
    if detected == "csv":
        return normalize_headers(scan_delimited(spark, path, spec.separator, spec.encoding, multiline=spec.multiline))
    if detected == "zip_csv":
        files = read_containers(spark, path)
        rows = scan_zip_members(files, columns, spec.separator, spec.encoding, spec.member_pattern)
        return rows.drop("source_file")
    if detected == "gpkg":
        return scan_layer_attributes(read_containers(spark, path), columns, spec.layer).drop("source_file")
    if detected == "xls":
        # Workbooks are expected as text exports: preamble, header, rows.
        files = read_containers(spark, path)
        return scan_below_header(files, spec.key_columns, columns, spec.separator).drop("source_file")
    raise ValueError(f"{spec.source_id}: format {detected} cannot be loaded")


def _land_and_load(
    df: DataFrame, spec: SourceSpec, landing: str, bronze: str, log: str, run_ts: str, delivery: dict
) -> dict:
    """Land a run, hold it to its contract and make it the bronze table; returns what the record says of it."""
    spark = df.sparkSession
    seen = Observation("landed")
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), table_fingerprint(df).alias("md5"))
    land(watched, landing, spec.source_id, spec.vintage, run_ts)
    rows, fingerprint = seen.get["rows"], seen.get["md5"]
    require_contract(df.columns, rows, spec)
    run = landed(spark, landing, df.columns, spec.source_id, run_ts)
    table = VersionedTable(spark, f"{bronze}/{spec.table}")
    folder = table.stage(as_text(run.select(*df.columns)))
    outcome: dict = {}

    def decide(before: Version) -> dict:
        previous = before.facts.get("rows") if before.number else logged_rows(spark, log, spec.source_id)
        outcome.update(notes=audit.drift_note(spec.source_id, rows, previous), previous_rows=previous)
        return {"rows": rows, "fingerprint": fingerprint, "run_ts": run_ts, **delivery}

    version = table.publish(folder, decide)
    return {"row_count": rows, "version": version.number, **outcome}


def logged_rows(spark: SparkSession, log: str, source_id: str) -> int | None:
    """Rows of the last successful load of a source whose bronze table has no version yet, by the audit log."""
    if not path_exists(spark, log):
        return None
    found = audit.last_row_count(audit.read_loads(spark, log), source_id).first()
    return found["row_count"] if found else None


def _logged(
    spark: SparkSession, spec: SourceSpec, path: str, bronze: str, log: str, run_id: str, run_ts: str, reuse: bool,
    job: Callable[[dict], dict],
) -> dict:
    """Run a load and write its audit record, good or bad, after the table is complete.

    The files are hashed first. With ``reuse``, a bronze table that was loaded from the same files stays as it is, and
    nothing is logged.
    """
    record = {
        "source_id": spec.source_id,
        "source_name": fold_to_ascii(spec.label),
        "source_url": path,
        "millesime": spec.vintage,
        "file_name": f"{spec.table}_{spec.vintage}_{run_ts}",
        "minio_path": f"source_id={spec.source_id}/millesime={spec.vintage}/run_ts={run_ts}",
        "pipeline_run_id": run_id,
        "ingested_at": datetime.now(),
    }
    try:
        delivery = combined_digest(file_digests(spark, path)).first().asDict()
        before = VersionedTable(spark, f"{bronze}/{spec.table}").current()
        if reuse and delivery["checksum_md5"] == before.facts.get("checksum_md5"):
            return record | delivery | {"row_count": before.facts["rows"], "version": before.number, "status": "UNCHANGED"}
        loaded = job(delivery)
    except Exception as error:
        audit.try_append_load(spark, log, **record, status="FAILED", error_message=str(error))
        raise
    record |= delivery | {"row_count": loaded["row_count"], "notes": loaded["notes"]}
    audit.try_append_load(spark, log, **record, status="SUCCESS")
    return record | loaded | {"status": "SUCCESS"}


def ingest_source(
    spark: SparkSession,
    spec: SourceSpec,
    path: str,
    columns: Sequence[str],
    landing: str,
    bronze: str,
    log: str,
    run_id: str,
    run_ts: str,
    reuse: bool = False,
) -> dict:
    """Ingest one open-data source; returns what was logged, the version of its table and the detected format."""

    def job(delivery: dict) -> dict:
        detected = source_format(spark, spec, path)
        df = read_source(spark, spec, path, columns, detected)
        absent = missing_columns(df.columns, spec)
        if absent:
            raise ContractError(f"{spec.source_id}: missing columns {absent}")
        return _land_and_load(df, spec, landing, bronze, log, run_ts, delivery) | {"detected_format": detected}

    return _logged(spark, spec, path, bronze, log, run_id, run_ts, reuse, job)


def ingest_catchment_map(
    spark: SparkSession,
    path: str,
    landing: str,
    bronze: str,
    log: str,
    run_id: str,
    run_ts: str,
    spec: SourceSpec = SOURCES["S12"],
    reuse: bool = False,
) -> dict:
    """Ingest the internal catchment map: any of three encodings, delivered column names."""

    def job(delivery: dict) -> dict:
        raw = scan_encoding_fallback(spark, path, spec.separator)
        df = normalize_headers(map_columns(raw))
        return _land_and_load(df, spec, landing, bronze, log, run_ts, delivery) | {"detected_format": "csv"}

    return _logged(spark, spec, path, bronze, log, run_id, run_ts, reuse, job)
