"""Session settings the plans are tuned for.

Nothing here is required by the operators: they also run on a session built elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

METHOD_SETTING = "spark.sql.codegen.hugeMethodLimit"
#: The JVM never compiles a method of more bytes than this, but interprets it row by row.
LARGEST_COMPILED = "8000"
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of a batch of whole texts.
BATCH_ROWS = "1000"
BROADCAST_SETTING = "spark.sql.autoBroadcastJoinThreshold"
MEASURED_SETTING = "spark.sql.adaptive.autoBroadcastJoinThreshold"
#: Bytes of files up to which a side of a join is broadcast unmeasured.
LARGEST_UNMEASURED = 1 << 18

DEFAULTS = {
    "spark.sql.ansi.enabled": "true",  # bad text and overflow must raise, not turn into NULL
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the call site of every column expression costs more than building the plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "areascore",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Create (or reuse) a session.

    ``shuffle_partitions`` is the *initial* count: AQE merges small partitions at run time, so on a
    cluster choose it for the largest shuffle (about 128-200 MB per partition), not for the average.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS, **extra)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def with_setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the jobs that start while this is open."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def compiled_methods(spark: SparkSession):
    """Plans of many columns run as several short methods while this is open, not as one that is too long to be compiled."""
    return with_setting(spark, METHOD_SETTING, LARGEST_COMPILED)


@contextmanager
def measured_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Sides of joins are broadcast by the size of their rows while this is open, and only tiny ones by that of their files.

    A few bytes of a compressed file can hold a row, and rows take some fifty times as much in the driver that builds
    their hash table. Sides of several MB of files are therefore shuffled first; those measured to be small are still broadcast.
    """
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    measured = spark.conf.get(MEASURED_SETTING, None) or str(limit)
    with with_setting(spark, BROADCAST_SETTING, str(min(limit, LARGEST_UNMEASURED))), with_setting(spark, MEASURED_SETTING, measured):
        yield


def small_batches(spark: SparkSession):
    """Python workers get ``BATCH_ROWS`` rows at a time while this is open: both sides hold a batch of texts per task."""
    return with_setting(spark, BATCH_SETTING, BATCH_ROWS)
