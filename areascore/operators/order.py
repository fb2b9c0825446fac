"""How many rows lie below a value, without a window over a whole column.

A frequency table is summed up in three levels of 21 bits: values, buckets of 2^21 neighbouring keys, buckets of 2^21
such buckets. A window holds one bucket's entries, at most 2^22 of them by construction for keys that are the
values themselves, and the counts before a bucket come from the level above.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEVEL_BITS = 21
#: Parts of one that doubles are told apart by in the upper levels; within a bucket they are ordered exactly.
DOUBLE_PARTS = 1e6
LARGEST = float(2**62)


def ordered_key(value: Column, kind: T.DataType) -> Column:
    """A 64-bit integer that grows with the value; equal keys are allowed, NaN is the largest."""
    if isinstance(kind, T.DecimalType):
        digits = kind.scale if kind.precision <= 18 else max(0, 18 - (kind.precision - kind.scale))
        return F.floor(value * F.lit(10**digits).cast("decimal(19,0)")).cast("bigint")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        scaled = F.greatest(F.least(value.cast("double") * DOUBLE_PARTS, F.lit(LARGEST)), F.lit(-LARGEST))
        return F.when(F.isnan(value), F.lit(2**62)).otherwise(F.floor(scaled))
    return value.cast("bigint")


def rows_below(frequencies: DataFrame, value: str, n: str, by: Sequence[str] = (), key: str | None = None) -> DataFrame:
    """Add ``_below`` and ``_total``: rows with a smaller value, and all rows, of the same ``by``.

    ``frequencies`` has one row per value and ``by``; ``key`` is an ``ordered_key`` of the value, by default the value.
    """
    own = [*by] or ["_all"]
    levels = [frequencies.withColumns({"_all": F.lit(0), "_at": F.col(key or value), "_up": F.shiftright(key or value, LEVEL_BITS)})]
    for _ in range(2):
        above = levels[-1].groupBy(*own, F.col("_up").alias("_at")).agg(F.sum(n).alias(n))
        levels.append(above.withColumn("_up", F.shiftright("_at", LEVEL_BITS)))
    top = levels.pop()
    earlier = Window.partitionBy(*own).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*own).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = top.select(
        *own, F.col("_at").alias("_up"), F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias("_before"),
        F.sum(n).over(whole).alias("_total"),
    )
    while levels:
        level = levels.pop()
        order = "_at" if levels else value
        inside = Window.partitionBy(*own, "_up").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        # Every bucket is known above. A left join says the same as an inner one but adds no NULL filter to
        # one side only, so that both sides read the same shuffled frequencies.
        placed = level.join(known, [*own, "_up"], "left")
        below = F.col("_before") + F.coalesce(F.sum(n).over(inside), F.lit(0))
        if levels:
            known = placed.select(*own, F.col("_at").alias("_up"), below.alias("_before"), "_total")
    return placed.withColumn("_below", below).select(*frequencies.columns, "_below", "_total")
