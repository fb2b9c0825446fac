"""Keys: validity filter, de-duplication, perimeter and lookups on a unique key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areascore.functions.codes import COMMUNE_CODE_SPACE, commune_code, has_text, is_commune_code

AREA = "iris_code"


def valid_keys(df: DataFrame, key: str) -> DataFrame:
    return df.where(has_text(F.col(key)))


def first_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``, which must be total for a repeatable answer.

    Spark turns the ``= 1`` filter into a group limit that runs before the shuffle, so a key that holds
    a large part of all rows sends one row per map task, not all of them, to its reducer.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where("_rn = 1").drop("_rn")


def within_perimeter(df: DataFrame, referential: DataFrame, key: str = AREA) -> DataFrame:
    """Rows whose key is in the referential. The referential key is unique, so this is a semi join."""
    return df.join(referential.select(key), key, "left_semi")


#: Logarithm of the bits of a key filter: 2^18 rows of two numbers, whatever the number of keys.
FILTER_BITS = 24


def key_bits(keys: DataFrame, key: str = AREA) -> DataFrame:
    """A bit map of the keys' hashes, 64 bits a row: at most 2^(FILTER_BITS - 6) rows, about 4 MB."""
    place = F.shiftrightunsigned(F.xxhash64(key), 64 - FILTER_BITS)
    bit = F.expr("shiftleft(1L, CAST(_place & 63 AS INT))")
    placed = keys.where(F.col(key).isNotNull()).select(place.alias("_place"))
    return placed.groupBy(F.shiftright("_place", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def maybe_known(df: DataFrame, bits: DataFrame, key: str = AREA) -> DataFrame:
    """Rows whose key may be among those of ``key_bits``; for 10^5 keys, six in a thousand strangers stay.

    The broadcast is bounded by the size of the bit map, so rows are dropped where they are scanned, before any aggregation or
    shuffle. A join on the key itself has to follow where strangers matter.
    """
    place = F.shiftrightunsigned(F.xxhash64(key), 64 - FILTER_BITS)
    asked = df.select("*", F.shiftright(place, 6).alias("_word"), (place.bitwiseAND(63)).cast("int").alias("_bit"))
    met = asked.join(F.broadcast(bits), "_word")
    return met.where("shiftrightunsigned(_bits, _bit) & 1 = 1").select(*df.columns)


def outside_of(df: DataFrame, other: DataFrame, key: str = AREA) -> DataFrame:
    """Rows whose key is absent from ``other``."""
    return df.join(other.select(key), key, "left_anti")


def key_counts(sides: Mapping[object, DataFrame]) -> DataFrame:
    """Every known ``key`` of several one-column frames, with its rows in each as ``n0``, ``n1``, ...

    One exchange by key for all of them; rows are counted before it.
    """
    marked = (df.toDF("key").select("key", F.lit(k).alias("_side")) for k, df in enumerate(sides.values()))
    rows = reduce(DataFrame.unionAll, marked).where(F.col("key").isNotNull())
    return rows.groupBy("key").agg(*(F.count_if(F.col("_side") == k).alias(f"n{k}") for k in range(len(sides))))


def absent_from(parent: DataFrame, tables: Mapping[str, DataFrame], key: str = AREA) -> DataFrame:
    """``table_name`` and key for every key of ``parent`` that a table lacks, in one aggregation over all."""
    counts = key_counts({"": parent.select(key), **{n: t.select(key) for n, t in tables.items()}})
    lacking = F.filter(
        F.array(*(F.when(F.col(f"n{k}") == 0, F.lit(n)) for k, n in enumerate(tables, 1))), lambda n: n.isNotNull()
    )
    return counts.where("n0 > 0").select(F.explode(lacking).alias("table_name"), F.col("key").alias(key))


def star(spine: DataFrame, *dimensions: DataFrame, key: str = AREA) -> DataFrame:
    """Left-join every dimension on one key.

    All joins share the key, so each side is shuffled at most once whatever the number of dimensions.
    Sizes are left to Spark: it broadcasts a side only when its measured size is under the threshold.
    """
    for dimension in dimensions:
        spine = spine.join(dimension, key, "left")
    return spine


def flagged_communes(raw: DataFrame, code: str = "codgeo", condition: Column | None = None) -> DataFrame:
    """Distinct valid commune codes with a constant TRUE flag.

    By default every listed commune counts; ``condition`` restricts to a status, where the list has one.
    """
    listed = raw if condition is None else raw.where(condition)
    valid = valid_keys(listed, code).where(is_commune_code(F.col(code)))
    return valid.select(commune_code(F.col(code)).alias("com_code")).distinct().withColumn(
        "est_zrr", F.lit(True)
    )


def flag_by_commune(areas: DataFrame, communes: DataFrame) -> DataFrame:
    """Add ``est_zrr`` to areas from the coarser commune grain; absent communes are FALSE.

    ``communes`` must come from ``flagged_communes``: its codes match the commune pattern, so it holds at
    most ``COMMUNE_CODE_SPACE`` rows of five characters, a few megabytes, whatever the input size. That
    bound is what makes the broadcast safe; it also keeps a commune with very many areas in place.
    """
    assert COMMUNE_CODE_SPACE <= 200_000
    joined = areas.join(F.broadcast(communes), "com_code", "left")
    return joined.withColumn("est_zrr", F.coalesce(F.col("est_zrr"), F.lit(False)))
