"""Percentile rank over a whole panel without a single-task sort.

``percent_rank`` depends only on how many rows hold a smaller value. So the panel is first reduced to a
frequency table, the frequencies are summed from the left, and the result is looked up again by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.functions.numbers import RATIO
from areascore.operators.order import rows_below

# A value is hot when it holds at least one part in this many of all rows: at most that many values are.
HOT_PARTS = 4096


def cumulative_frequencies(panel: DataFrame, value: str) -> DataFrame:
    """One row per distinct integer value: its count, the rows below it, and the total.

    The counts are summed up level by level, see ``rows_below``: no window holds more than one bucket.
    """
    frequencies = panel.groupBy(F.col(value).cast("bigint").alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    return rows_below(frequencies, "_value", "_n")


def with_percent_rank(panel: DataFrame, value: str, key: str, output: str) -> DataFrame:
    """Add the percentile rank of an integer column as an exact decimal between 0 and 1.

    The panel is read twice; pass a stored table, not a long plan. Panels have many rows on one value
    (typically zero), so the lookup is split: hot values go through a broadcast, which ``HOT_PARTS``
    bounds, and their rows are spread over the shuffle by ``key`` instead of by value; every other
    value holds too few rows to unbalance the shuffle.
    """
    wide = "decimal(20,0)"
    ranks = cumulative_frequencies(panel, value).select(
        "_value",
        (F.col("_n") * HOT_PARTS >= F.col("_total")).alias("_is_hot"),
        F.when(
            F.col("_total") > 1,
            (F.col("_below").cast(wide) / (F.col("_total") - 1).cast(wide)).cast(RATIO),
        ).otherwise(F.lit(0).cast(RATIO)).alias("_rank"),
    )
    hot = ranks.where("_is_hot").select("_value", F.col("_rank").alias("_hot_rank"))
    cold = ranks.where("NOT _is_hot").select(
        F.lit(False).alias("_settled"),
        F.col("_value").alias("_slot"),
        F.col("_rank").alias("_cold_rank"),
    )
    settled = F.col("_hot_rank").isNotNull()
    marked = (
        panel.withColumn("_value", F.col(value).cast("bigint"))
        .join(F.broadcast(hot), "_value", "left")
        .withColumn("_settled", settled)
        .withColumn("_slot", F.when(settled, F.xxhash64(key)).otherwise(F.col("_value")))
    )
    return (
        marked.join(cold, ["_settled", "_slot"], "left")
        .withColumn(output, F.coalesce("_hot_rank", "_cold_rank"))
        .drop("_value", "_settled", "_slot", "_hot_rank", "_cold_rank")
    )
