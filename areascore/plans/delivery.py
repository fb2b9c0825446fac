"""From landed files to gold: every source into bronze, then the chain over what arrived."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from areascore.plans.chain import ChainResult, run_chain
from areascore.plans.ingest import ingest_catchment_map, ingest_source
from areascore.settings import SOURCES, SourceSpec
from areascore.sources.tabular import read_bronze

#: Sources whose jobs are submitted at once; Spark shares the cluster among them.
AT_ONCE = 4


@dataclass(frozen=True)
class Delivery:
    """Landed files of one source. ``columns`` are needed where files are opened by a task (archives, layers)."""

    path: str
    columns: Sequence[str] = ()


def ingest_all(
    spark: SparkSession,
    deliveries: Mapping[str, Delivery],
    landing: str,
    bronze: str,
    log: str,
    run_id: str,
    run_ts: str,
    specs: Mapping[str, SourceSpec] = SOURCES,
) -> dict[str, dict]:
    """Load every source that has files; returns its record with ``status`` SUCCESS, UNCHANGED or FAILED.

    Sources do not depend on one another, so each succeeds or fails on its own. One whose files are those of its last
    load is left as it is, so a run that is repeated after a failure repeats only what failed. A source
    without delivery fails.
    """
    places = {"landing": landing, "bronze": bronze, "log": log, "run_id": run_id, "run_ts": run_ts, "reuse": True}

    def load(source_id: str) -> dict:
        spec, delivery = specs[source_id], deliveries.get(source_id)
        if delivery is None:
            return {"source_id": source_id, "status": "FAILED", "error_message": "no files delivered"}
        try:
            if spec.internal:
                return ingest_catchment_map(spark, delivery.path, **places, spec=spec)
            return ingest_source(spark, spec, delivery.path, delivery.columns, **places)
        except Exception as error:  # noqa: BLE001 - the record has it; the other sources go on
            return {"source_id": source_id, "status": "FAILED", "error_message": str(error)}

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return dict(zip(specs, pool.map(inheritable_thread_target(spark)(load), specs)))


def run_from_files(
    spark: SparkSession,
    deliveries: Mapping[str, Delivery],
    root: str,
    run_id: str,
    run_ts: str,
    specs: Mapping[str, SourceSpec] = SOURCES,
    **options,
) -> tuple[dict[str, dict], ChainResult]:
    """Ingest all sources under ``root`` and build every table that does not depend on one that failed.

    ``options`` are those of ``run_chain``.
    """
    bronze, log = f"{root}/bronze", f"{root}/ingestion_log"
    loads = ingest_all(spark, deliveries, f"{root}/landing", bronze, log, run_id, run_ts, specs)
    absent = {specs[s].table for s, record in loads.items() if record["status"] == "FAILED"}
    done = run_chain(spark, lambda table: read_bronze(spark, f"{bronze}/{table}"), f"{root}/warehouse", absent=absent, **options)
    return loads, done
