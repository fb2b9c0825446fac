"""Containers made from rows, one per batch, inside the tasks that hold the rows.

They give the container readers inputs of any size without a file ever passing through one machine.
"""

from __future__ import annotations

import io
import sqlite3
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

CONTAINER_SCHEMA = "path string, content binary"


def _pack(df: DataFrame, suffix: str, build: Callable[[pd.DataFrame], bytes]) -> DataFrame:
    def containers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            if len(batch):
                path = f"part-{task:05d}-{number:05d}{suffix}"
                yield pd.DataFrame({"path": [path], "content": [build(batch)]})

    return df.mapInPandas(containers, CONTAINER_SCHEMA)


def _csv_bytes(rows: pd.DataFrame, sep: str) -> bytes:
    return rows.to_csv(index=False, sep=sep).encode("utf-8")


def _zip_bytes(entries: dict[str, bytes]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in entries.items():
            archive.writestr(name, content)
    return buffer.getvalue()


def pack_csv(df: DataFrame, sep: str = ";", suffix: str = ".csv") -> DataFrame:
    return _pack(df, suffix, lambda rows: _csv_bytes(rows, sep))


def pack_zip(df: DataFrame, sep: str = ";", member: str = "table.csv") -> DataFrame:
    """Archives with a read-me in front of the table."""
    return _pack(
        df, ".zip", lambda rows: _zip_bytes({"readme.md": b"notes", member: _csv_bytes(rows, sep)})
    )


def pack_entries(df: DataFrame, *names: str) -> DataFrame:
    """Archives that hold the rows under each of some entry names."""
    return _pack(df, ".bin", lambda rows: _zip_bytes({n: _csv_bytes(rows, ";") for n in names}))


def pack_with_prefix(df: DataFrame, prefix: bytes) -> DataFrame:
    return _pack(df, ".bin", lambda rows: prefix + _csv_bytes(rows, ";"))


def layer_bytes(rows: pd.DataFrame, layer: str) -> bytes:
    """A GeoPackage with one layer of text attributes and a geometry column."""
    db = sqlite3.connect(":memory:")
    try:
        db.execute("CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT)")
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
        db.execute("INSERT INTO gpkg_contents VALUES (?, 'features')", (layer,))
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom')", (layer,))
        listed = ", ".join(f'"{c}" TEXT' for c in rows.columns)
        db.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY, geom BLOB, {listed})')
        marks = ", ".join("?" for _ in rows.columns)
        names = ", ".join(f'"{c}"' for c in rows.columns)
        db.executemany(
            f'INSERT INTO "{layer}" (geom, {names}) VALUES (x\'4750\', {marks})',
            rows.itertuples(index=False, name=None),
        )
        db.commit()
        return db.serialize()
    finally:
        db.close()


def pack_layer(df: DataFrame, layer: str) -> DataFrame:
    return _pack(df, ".gpkg", lambda rows: layer_bytes(rows, layer))


def lines_with_preamble(df: DataFrame, preamble: list[str], sep: str = ";") -> DataFrame:
    """Text lines: in each partition the preamble and a header come before the rows."""
    names = list(df.columns)

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        started = False
        for batch in batches:
            text = [sep.join("" if v is None else str(v) for v in row) for row in batch.itertuples(index=False)]
            if not started:
                text = [*preamble, sep.join(names), *text]
                started = True
            yield pd.DataFrame({"value": text})

    return df.mapInPandas(lines, "value string")
