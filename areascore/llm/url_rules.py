"""URL filters as a sort-merge range join of reversed-host keys, in DataFrame functions only.

A rule (host, path) fits a url whose host is the rule's or a subdomain of it and whose path starts with the
rule's. Written with reversed labels, host and path of a rule become one key, and the urls below it one
interval of keys. Each url is placed at every node of its host (``com``, ``com.example``, ...; no more nodes
than the rule table has labels), starts and ends of intervals are merged in, and one sorted sweep per node
keeps the stack of open rules: the depth is a running sum of +1 and -1, the top of the stack the last
start at that depth.

Nodes with many urls are dealt over several sweeps, each with its own copy of the node's rules; the list of
such nodes is bounded by the number of shuffle partitions. Equal urls are counted before anything is sorted.

Defined results: a null url, or one without ``://``, has an empty host and path and no rule; where two
rules of equal host and path disagree, ``block`` holds; of two fitting rules the longer text (host and path)
wins, then the longer host; repeated rows stay repeated; an empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

# The order of events at one key: a rule opens before the urls that equal it.
OPEN, URL, CLOSE = 0, 1, 2
RULE_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("host", "path", "verdict")])


def split_url(df: DataFrame, url: str) -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``."""
    at = F.instr(F.col(f"`{url}`"), "://")
    rest = F.when(at > 0, F.substring(F.col(f"`{url}`"), at + 3, F.length(F.col(f"`{url}`"))))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return df.withColumns(
        {
            "host": F.translate(host, string.ascii_uppercase, string.ascii_lowercase),
            "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
        }
    )


def _reversed_labels(host: str):
    return F.reverse(F.split(F.col(host), r"\."))


def judge(
    pages: DataFrame,
    rules: DataFrame,
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Rows (key, host, path, rule, verdict), one per row of ``pages``."""
    spark = pages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = (
        rules.where("host IS NOT NULL AND path IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            F.array_join(_reversed_labels("host"), ".").alias("node"),
            F.encode("path", "UTF-8").alias("at"),
            F.concat("host", "path").alias("rule"),
            "verdict",
            F.size(_reversed_labels("host")).alias("labels"),
        )
    )
    deepest = table.agg(F.coalesce(F.max("labels"), F.lit(1))).scalar()
    urls = (
        split_url(pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url")), "url")
        .groupBy("key", "host", "path")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    labels = urls.withColumn("labels", _reversed_labels("host")).withColumn("deepest", deepest)
    points = labels.select(
        "key",
        "host",
        "path",
        "copies",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.least(F.size("labels"), "deepest")),
                lambda n: F.array_join(F.slice("labels", F.lit(1), n), "."),
            )
        ).alias("node"),
    )
    # A node with over 1/(2 * parts) of the urls is dealt over several sweeps; at most 2 * parts * labels nodes.
    total = urls.agg(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
    crowded = (
        points.groupBy("node")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("salts", F.ceil(F.col("n") * (2 * parts) / total))
        .where("salts > 1")
        .select("node", "salts")
    )
    crowded = F.broadcast(crowded)
    salts = F.coalesce("salts", F.lit(1).cast("long"))
    null = lambda kind: F.lit(None).cast(kind)
    key_type = urls.schema["key"].dataType
    swept = points.join(crowded, "node", "left").select(
        "node",
        F.pmod(F.xxhash64("key", "path"), salts).alias("salt"),
        F.encode("path", "UTF-8").alias("at"),
        F.lit(URL).alias("kind"),
        "key",
        "host",
        "path",
        "copies",
        null("string").alias("rule"),
        null("string").alias("verdict"),
    )
    dealt = table.join(crowded, "node", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
    # No byte of UTF-8 text is FF: the closing key follows every key below the rule.
    events = dealt.withColumn(
        "event",
        F.explode(
            F.array(
                F.struct(F.col("at").alias("at"), F.lit(OPEN).alias("kind")),
                F.struct(F.concat("at", F.unhex(F.lit("FF"))).alias("at"), F.lit(CLOSE).alias("kind")),
            )
        ),
    ).select(
        "node",
        "salt",
        "event.at",
        "event.kind",
        null(key_type).alias("key"),
        null("string").alias("host"),
        null("string").alias("path"),
        null("long").alias("copies"),
        "rule",
        "verdict",
    )
    step = F.when(F.col("kind") == OPEN, 1).when(F.col("kind") == CLOSE, -1).otherwise(0)
    sweep = W.Window.partitionBy("node", "salt").orderBy("at", "kind")
    stack = W.Window.partitionBy("node", "salt", "depth").orderBy("at", "kind")
    so_far = (W.Window.unboundedPreceding, W.Window.currentRow)
    top = F.when(F.col("kind") == OPEN, F.struct(F.length("rule").alias("size"), F.length("node").alias("own"), "rule", "verdict"))
    found = (
        swept.unionByName(events)
        .withColumn("depth", F.sum(step).over(sweep.rowsBetween(*so_far)))
        .withColumn("top", F.when(F.col("depth") > 0, F.last(top, ignorenulls=True).over(stack.rowsBetween(*so_far))))
        .where(F.col("kind") == URL)
        .groupBy("key", "host", "path")
        .agg(F.max("top").alias("top"), F.first("copies").alias("copies"))
    )
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("top.rule").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"),
    )
