"""Contexts of anchors as they pass by in small batches, against a plain loop."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

from areascore.llm import suffix_dedup

NAMES = ["anchor", "id", "low", "windows", "at", "context", "done"]


class Rows:
    """Stands for a DataFrame: the function given to it runs on the batches at hand."""

    def __init__(self, batches):
        self.batches = batches

    def mapInArrow(self, run, schema):
        return list(run(iter(self.batches)))


def by_loop(rows):
    gone, contexts = [], {}
    for row in rows:
        if row[6]:
            gone.append(row[1:5])
            continue
        firsts = contexts.setdefault(row[0], {})
        first = firsts.setdefault((row[3], row[4], row[5]), row)
        if first[1:3] != row[1:3]:
            gone.append(row[1:5])
    kept = [(anchor, *r[1:5]) for anchor, firsts in contexts.items() if len(firsts) > 1 for r in firsts.values()]
    return sorted(gone), sorted(kept)


@pytest.mark.parametrize("size", [1, 2, 3, 1000])
def test_first_of_each_context(size):
    draw = random.Random(size)
    for _ in range(60):
        rows = [
            (draw.randrange(6), draw.randrange(5), draw.randrange(4), draw.randrange(1, 3), 0, draw.randrange(3), draw.random() < 0.1)
            for _ in range(draw.randrange(40))
        ]
        rows.sort(key=lambda r: (r[0], r[3], r[4], r[5], r[1], r[2]))
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()]
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + size]), types)], names=NAMES)
            for k in range(0, len(rows), size)
        ]
        out = [tuple(r.values()) for b in suffix_dedup._earliest(Rows(batches)) for r in b.to_pylist()]
        gone = sorted(r[1:] for r in out if r[0] is None)
        kept = sorted(r for r in out if r[0] is not None)
        assert (gone, kept) == by_loop(rows)
