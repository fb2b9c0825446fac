"""Delimited text in, bronze tables and exports out. Bronze columns are strings, all of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areascore.functions.numbers import nullify_tokens
from areascore.functions.text import header_name_column, header_names
from areascore.sources.lines import ODD_LINE, cells, first_lines, numbered_lines, table_of
from areascore.sources.versions import VersionedTable

HEADER_CANDIDATES = 10
MAX_HEADER_CELLS = 256

# What the Windows code page puts where Latin-1 has control characters, by byte.
WINDOWS_1252 = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†", 0x87: "‡", 0x88: "ˆ", 0x89: "‰",
    0x8A: "Š", 0x8B: "‹", 0x8C: "Œ", 0x8E: "Ž", 0x91: "‘", 0x92: "’", 0x93: "“", 0x94: "”", 0x95: "•",
    0x96: "–", 0x97: "—", 0x98: "˜", 0x99: "™", 0x9A: "š", 0x9B: "›", 0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}
# Bytes the Windows code page leaves undefined: a file that has one is Latin-1.
UNDEFINED_1252 = r"[\x81\x8d\x8f\x90\x9d]"
LATIN_1 = "ISO-8859-1"
# Column of rows whose number of cells is not that of the header.
ODD_ROW = "_odd_row"


def all_strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def scan_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ";",
    encoding: str = "UTF-8",
    columns: Sequence[str] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Delimited files with a header, nothing inferred; an empty cell is NULL, quoted or not.

    A short row is filled with NULL. A row with more cells than the header, or with a quote that its line does
    not close, fails the job instead of losing data. Cells with line breaks need ``multiline``, which makes
    a file unsplittable.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", False)
    )
    files = path if isinstance(path, str) else list(path)
    names = list(columns) if columns is not None else reader.csv(files).columns
    if not names:
        return reader.csv(files)
    odd = reader.option("columnNameOfCorruptRecord", ODD_ROW).option("columnPruning", False)
    rows = odd.schema(all_strings([*names, ODD_ROW])).csv(files)
    plain = F.regexp_replace(ODD_ROW, '"([^"]|"")*"', "")
    surplus = F.regexp_count(plain, F.lit(_literal(sep))) >= len(names)
    lossy = F.col(ODD_ROW).isNotNull() & (surplus | F.contains(plain, F.lit('"')))
    # A condition on the odd row alone may not be read from a text file, so a named column is in it too.
    told = F.concat(F.lit(f"cells beyond the {len(names)} of the header, or an open quote: "), ODD_ROW, F.substring(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), 1, 0))
    kept = rows.where(F.when(lossy, F.raise_error(told).cast("boolean")).otherwise(True))
    return kept.select(*(f"`{n}`" for n in names))


def file_encodings(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Encoding of each file: UTF-8 if all of it is valid, else the Windows code page, else Latin-1.

    Checked line by line, so large files are split: no line break is ever part of a multi-byte UTF-8
    character, and the text source hands the bytes of a line through undecoded.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    octets = F.col("value").cast("binary")
    checked = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.expr("is_valid_utf8(value)").alias("valid"),
        F.decode(octets, LATIN_1).rlike(UNDEFINED_1252).alias("undefined"),
    )
    return checked.groupBy("path").agg(
        F.when(F.every("valid"), "utf-8")
        .when(~F.coalesce(F.bool_or("undefined"), F.lit(False)), "cp1252")
        .otherwise("latin-1")
        .alias("encoding")
    )


def _repair_windows(text: Column) -> Column:
    return F.translate(text, "".join(map(chr, WINDOWS_1252)), "".join(WINDOWS_1252.values()))


def scan_encoding_fallback(
    spark: SparkSession, path: str | Sequence[str], sep: str = ";", columns: Sequence[str] | None = None
) -> DataFrame:
    """Delimited files in a mixture of encodings, each read as its own.

    One scan reads the lines of all files undecoded; verdict and header of a file meet them by its path, in the plan. A
    file whose header is not the expected one fails the job. The names, if not given, are those of the first file.
    """
    lines = numbered_lines(spark, path)
    judged = file_encodings(spark, path).withColumnRenamed("path", "file_path")
    heads = first_lines(lines, 1).join(judged, "file_path").select(
        "file_path", F.col("row").alias("head_row"), _decoded("line").alias("head"), "encoding"
    )
    if columns is None:
        first = heads.orderBy("file_path").select("head").first()
        columns = _split_names(spark, first["head"], sep) if first else []
    names = list(columns)
    if not names:
        return spark.createDataFrame([], T.StructType())
    found = F.array(*(cells(F.col("head"), names, sep)[n] for n in names))
    wrong = (found != F.array(*map(F.lit, names))) | cells(F.col("head"), names, sep)[ODD_LINE].isNotNull()
    told = F.concat(F.lit("another header than the expected one in "), "file_path")
    files = heads.where(F.when(wrong, F.raise_error(told).cast("boolean")).otherwise(True)).drop("head")
    body = lines.join(files, "file_path").where((F.col("block") > 0) | (F.col("row") > F.col("head_row")))
    return table_of(body.select(_decoded("line").alias("line")), names, sep)


def _split_names(spark: SparkSession, header: str, sep: str) -> list[str]:
    """Names in a header line, as the delimited reader has them."""
    many = [f"c{k}" for k in range(header.count(sep) + 1)]
    one = spark.range(1).select(cells(F.lit(header), many, sep).alias("c")).select("c.*").drop(ODD_LINE).first()
    return [n for n in one if n is not None]


def _decoded(line: str) -> Column:
    """Undecoded text as its file's ``encoding`` has it."""
    octets = F.col(line).cast("binary")
    plain = F.decode(octets, LATIN_1)
    return (
        F.when(F.col("encoding") == "utf-8", F.col(line))
        .when(F.col("encoding") == "cp1252", F.translate(plain, "".join(map(chr, WINDOWS_1252)), "".join(WINDOWS_1252.values())))
        .otherwise(plain)
    )


def rows_below_header(
    spark: SparkSession, path: str | Sequence[str], keys: Sequence[str], columns: Sequence[str], sep: str = ";"
) -> DataFrame:
    """Rows of files whose header stands below some lines of preamble, in the order of ``columns`` by name.

    The header is found as in ``discover_header``; files without one fail the job. Names may stand in any order, with others
    between, and are compared as ``normalize_headers`` has them.
    """
    lines = numbered_lines(spark, path)
    wanted = F.array(*(F.lit(k) for k in header_names(list(keys))))
    names = F.transform(F.split("line", _literal(sep)), lambda c: header_name_column(F.btrim(c, F.lit('"'))))
    tops = first_lines(lines, HEADER_CANDIDATES).withColumn("names", names)
    fits = F.size(F.array_except(wanted, "names")) == 0
    order = F.when(fits, F.col("number"))
    heads = tops.groupBy("file_path").agg(F.min(order).alias("n"), F.min_by("names", order).alias("names"), F.min_by("row", order).alias("head_row"))
    told = F.concat(F.lit(f"no header with {sorted(header_names(list(keys)))} in the first lines of "), "file_path")
    heads = heads.where(F.when(F.col("n").isNull(), F.raise_error(told).cast("boolean")).otherwise(True))
    body = lines.join(heads, "file_path").where((F.col("block") > 0) | (F.col("row") > F.col("head_row")))
    body = body.where(F.length(F.trim("line")) > 0)
    # Cells are cut once, as many as a header may have; a header's names say which of them is which.
    many = [f"c{k}" for k in range(MAX_HEADER_CELLS)]
    cut = body.select("names", cells(F.col("line"), many, sep).alias("c")).select("names", F.array(*(f"c.{c}" for c in many)).alias("cut"))
    place = lambda c: F.array_position("names", c)
    return cut.select(*(F.when(place(c) > 0, F.try_element_at("cut", place(c).cast("int"))).alias(c) for c in columns))


def discover_header(
    spark: SparkSession, path: str | Sequence[str], keys: Sequence[str], sep: str = ";"
) -> DataFrame:
    """First of the first ten lines of each file whose normalised cells include all key columns.

    The leading lines are in the first block of a file. Within a partition, row ids grow in reading
    order, and the ranking with a limit runs before the shuffle, so of each file ten lines move.
    """
    lines = (
        spark.read.text(path if isinstance(path, str) else list(path))
        .select("value", "_metadata.file_path", "_metadata.file_block_start")
        .where("file_block_start = 0")
        .withColumn("_id", F.monotonically_increasing_id())
    )
    first = Window.partitionBy("file_path").orderBy("_id")
    candidates = lines.withColumn("header_row", F.row_number().over(first) - 1).where(
        f"header_row < {HEADER_CANDIDATES}"
    )
    cells = F.transform(F.split("value", _literal(sep)), lambda c: header_name_column(F.btrim(c, F.lit('"'))))
    wanted = F.array(*(F.lit(k) for k in header_names(list(keys))))
    hits = candidates.withColumn("columns", cells).where(F.size(F.array_except(wanted, "columns")) == 0)
    return hits.groupBy(F.col("file_path").alias("path")).agg(
        F.min("header_row").cast("bigint").alias("header_row"),
        F.min_by("columns", "header_row").alias("columns"),
    )


def _literal(sep: str) -> str:
    return "\\" + sep if sep in r".|*+?()[]{}^$\\" else sep


def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename columns to lower-case ASCII words. Touches the schema only."""
    return df.toDF(*header_names(df.columns))


# Column names of the catchment map as delivered -> expected names.
CATCHMENT_ALIASES = {
    "iris": "code_iris",
    "code_bassin_de_vie": "code_bv",
    "libelle_bassin_de_vie": "lib_bv",
}
CATCHMENT_REQUIRED = ("code_iris", "code_bv")


def map_columns(
    df: DataFrame,
    aliases: Mapping[str, str] = CATCHMENT_ALIASES,
    required: Sequence[str] = CATCHMENT_REQUIRED,
) -> DataFrame:
    """Bring delivered column names to the expected ones and insist on the required columns."""
    plain = df.toDF(*(c.strip().lower().replace(" ", "_") for c in df.columns))
    mapped = plain.withColumnsRenamed({k: v for k, v in aliases.items() if k in plain.columns})
    absent = sorted(set(required) - set(mapped.columns))
    if absent:
        raise ValueError(f"missing columns {absent}; present are {mapped.columns}")
    return mapped


def with_null_tokens(df: DataFrame) -> DataFrame:
    """Turn the published null tokens into NULL, in every column and in one projection."""
    return df.select(*(nullify_tokens(F.col(f"`{c}`")).alias(c) for c in df.columns))


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns))


def load_bronze(df: DataFrame, path: str, if_exists: str = "replace") -> DataFrame:
    """Write a bronze table; ``replace`` is idempotent, ``append`` adds.

    The table changes when all rows are written: a load that fails leaves the old rows, see ``VersionedTable``.
    """
    append = {"replace": False, "append": True}[if_exists]
    table = VersionedTable(df.sparkSession, path)
    return table.read(table.publish(table.stage(as_text(df)), lambda before: before.facts, append))


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return VersionedTable(spark, path).read()


LANDING_KEYS = ("source_id", "millesime", "run_ts")


def land(df: DataFrame, root: str, source_id: str, vintage: str, run_ts: str) -> None:
    """Put one run of one source into the landing area, one directory per source, vintage and run.

    A run that is repeated replaces its own directory and no other.
    """
    stamped = df.withColumns(
        {"source_id": F.lit(source_id), "millesime": F.lit(vintage), "run_ts": F.lit(run_ts)}
    )
    writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*LANDING_KEYS).parquet(root)


def landed(
    spark: SparkSession, root: str, columns: Sequence[str], source_id: str, run_ts: str | None = None
) -> DataFrame:
    """Landed rows of a source, or of one run; other directories are never opened."""
    schema = all_strings([*columns, *LANDING_KEYS])
    rows = spark.read.schema(schema).parquet(root).where(F.col("source_id") == source_id)
    return rows if run_ts is None else rows.where(F.col("run_ts") == run_ts)


def write_delimited(
    df: DataFrame, path: str, sep: str = ";", encoding: str = "UTF-8", mode: str = "overwrite"
) -> None:
    """Delimited files with a header; blanks around values are data and stay."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def export_sorted(df: DataFrame, path: str, key: str) -> None:
    """CSV export in key order: range-partitioned part files that follow one another."""
    write_delimited(df.orderBy(F.col(key).asc_nulls_last()), path, sep=",")
