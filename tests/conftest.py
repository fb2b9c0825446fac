from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from areascore.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        shuffle_partitions=8,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def text_frame(spark):
    """A frame of text columns from rows of texts."""

    def build(columns, rows):
        schema = ", ".join(f"`{c}` string" for c in columns)
        return spark.createDataFrame(rows, schema)

    return build


def plan_of(df, mode: str = "simple") -> str:
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
