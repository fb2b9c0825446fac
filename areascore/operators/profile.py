"""Column profiles, correlation, histogram and medians."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areascore.functions.numbers import mean
from areascore.operators.order import ordered_key, rows_below
from areascore.sources.storage import stage


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per column, one row per column."""
    stats = df.agg(
        *(
            F.struct(
                F.lit(name).alias("feature"),
                F.count(name).alias("count"),
                F.round(mean(F.col(name)), 6).cast("double").alias("mean"),
                F.round(F.stddev_samp(name), 6).alias("std"),
                F.min(name).cast("double").alias("min"),
                F.max(name).cast("double").alias("max"),
            ).alias(name)
            for name in columns
        )
    )
    return stats.select(F.inline(F.array(*columns)))


def correlation(df: DataFrame, left: str, right: str) -> DataFrame:
    """Pearson correlation over rows where both columns are known."""
    pairs = df.select(left, right).dropna(subset=[left, right])
    return pairs.agg(
        F.count(F.lit(1)).alias("pairs"), F.round(F.corr(left, right), 6).alias("correlation")
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency of each known value of each column, written once: what follows reads it several times."""
    long = df.select(*columns).unpivot([], list(columns), "pillar", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("pillar", "value").agg(F.count(F.lit(1)).alias("n"))
    return stage(counts, "value_counts")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width histogram per column between its minimum and maximum, empty bins included.

    The last bin includes the maximum. A column with a single value gets a range one unit wide around it.
    Decimals are placed exactly, up to 38 digits of the value times ``bins``.
    """
    counts = value_counts(df, columns)
    # One row per column, so the broadcast is bounded by the columns that were asked for.
    ranges = counts.groupBy("pillar").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    ranged = counts.join(F.broadcast(ranges), "pillar")
    flat = F.col("low") == F.col("high")
    half = F.lit(Decimal("0.5"))
    ranged = ranged.select(
        "pillar", "value", "n",
        F.when(flat, F.col("low") - half).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + half).otherwise(F.col("high")).alias("high"),
    )
    exact = not isinstance(counts.schema["value"].dataType, (T.FloatType, T.DoubleType))
    position = F.expr(f"((value - low) * {bins}) div (high - low)" if exact else f"floor((value - low) * {bins} / (high - low))")
    filled = ranged.withColumn("bin", F.least(position, F.lit(bins - 1)).cast("int"))
    per_bin = filled.groupBy("pillar", "bin").agg(
        F.sum("n").alias("n"), F.min("low").cast("double").alias("low"), F.max("high").cast("double").alias("high")
    )
    # At most ``bins`` entries per column; bins without values are added from the sequence.
    per_column = per_bin.groupBy("pillar").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    every_bin = per_column.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    edge = F.col("low") + (F.col("high") - F.col("low")) * F.col("bin") / bins
    return every_bin.select(
        "pillar",
        "bin",
        F.coalesce(F.try_element_at("counts", F.col("bin")), F.lit(0)).alias("n"),
        F.round(edge, 6).alias("lower_edge"),
    )


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per column, from the frequency of each value rather than from sorted rows.

    Values are numbered level by level, see ``rows_below``. Integers and decimals of up to 18 digits
    are told apart at every level; so are doubles down to the sixth decimal, and exactly within a bucket.
    """
    values = value_counts(df, columns)
    kind = values.schema["value"].dataType
    counts = values.withColumn("_key", ordered_key(F.col("value"), kind))
    placed = rows_below(counts, "value", "n", by=["pillar"], key="_key")
    covers = lambda place: (F.col("_below") < place) & (place <= F.col("_below") + F.col("n"))
    lower = F.expr("(_total + 1) div 2")
    upper = F.expr("(_total + 2) div 2")
    value = F.col("value").cast("double")
    middle = placed.groupBy("pillar").agg(
        F.max(F.when(covers(lower), value)).alias("_lower"), F.max(F.when(covers(upper), value)).alias("_upper")
    )
    return middle.select("pillar", ((F.col("_lower") + F.col("_upper")) / 2.0).alias("median"))
