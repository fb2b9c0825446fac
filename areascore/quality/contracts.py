"""What a landed source must look like before it is accepted."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.settings import SourceSpec


class ContractError(ValueError):
    """A source lacks key columns or has an implausible number of rows."""


def missing_columns(columns: Iterable[str], spec: SourceSpec) -> list[str]:
    present = {c.lower() for c in columns}
    return [c for c in spec.key_columns if c.lower() not in present]


def row_count_errors(rows: int, spec: SourceSpec) -> list[str]:
    if rows < spec.min_rows:
        return [f"too few rows: {rows} < {spec.min_rows}"]
    if rows > spec.max_rows:
        return [f"too many rows: {rows} > {spec.max_rows}"]
    return []


def contract_errors(columns: Iterable[str], rows: int, spec: SourceSpec) -> list[str]:
    """All findings at once, so that one run reports everything there is to repair."""
    absent = [f"missing column: {c}" for c in missing_columns(columns, spec)]
    return absent + row_count_errors(rows, spec)


def require_contract(columns: Iterable[str], rows: int, spec: SourceSpec) -> None:
    errors = contract_errors(columns, rows, spec)
    if errors:
        raise ContractError(f"{spec.source_id}: {'; '.join(errors)}")


def contract_report(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Lazy form of the check: one row with the counts behind the verdict."""
    absent = missing_columns(df.columns, spec)
    rows = F.col("row_count")
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(spec.source_id).alias("source_id"),
        "row_count",
        F.lit(len(absent)).cast("bigint").alias("missing_columns"),
        (rows < spec.min_rows).alias("too_few_rows"),
        (rows > spec.max_rows).alias("too_many_rows"),
        (rows.between(spec.min_rows, spec.max_rows) & F.lit(not absent)).alias("accepted"),
    )
