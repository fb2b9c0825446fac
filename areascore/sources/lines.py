"""Delimited text taken line by line: whatever stands before the header, and whatever encoding a file is in.

All files are one scan; what is known of a file (its encoding, its header) is a row of a small frame that meets the lines by path,
in the plan. Lines are numbered by the scan: of two scans of the same files, both cut them alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ODD_LINE = "_odd_line"


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file_path``, ``block``, ``row`` (growing within a block) and the undecoded ``line`` of every line with text."""
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    return lines.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"),
    )


def first_lines(lines: DataFrame, n: int) -> DataFrame:
    """The first ``n`` lines of every file with their ``number`` from 0; of each file, as many move."""
    order = Window.partitionBy("file_path").orderBy("row")
    return lines.where("block = 0").withColumn("number", F.row_number().over(order) - 1).where(F.col("number") < n)


def cells(line: Column, names: Sequence[str], sep: str) -> Column:
    """A line as a struct of text cells; of surplus cells or an open quote, the whole line beside them."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, ODD_LINE)])
    options = {"sep": sep, "quote": '"', "escape": '"', "columnNameOfCorruptRecord": ODD_LINE}
    return F.from_csv(line, schema.toDDL(), options)


def table_of(lines: DataFrame, names: Sequence[str], sep: str) -> DataFrame:
    """Rows of the decoded ``line`` column: empty cells are NULL, short rows are filled, lossy ones fail the job."""
    row = lines.where(F.length(F.trim("line")) > 0).select(cells(F.col("line"), names, sep).alias("cells"), "line")
    outside = F.regexp_replace("line", '"([^"]|"")*"', "")
    literal = "\\" + sep if sep in r".|*+?()[]{}^$\\" else sep
    surplus = F.regexp_count(outside, F.lit(literal)) >= len(names)
    lossy = F.col(f"cells.{ODD_LINE}").isNotNull() & (surplus | F.contains(outside, F.lit('"')))
    told = F.concat(F.lit(f"cells beyond the {len(names)} of the header, or an open quote: "), "line")
    kept = row.where(F.when(lossy, F.raise_error(told).cast("boolean")).otherwise(True))
    return kept.select(*(F.col(f"cells.`{n}`").alias(n) for n in names))
