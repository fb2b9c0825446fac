"""Removal of lines that many documents share, by a sharded minimal perfect hash over line hashes.

Counts of documents per line hash are summed by Spark; lines of two or more documents are indexed in shards
(``perfect_hash``). Documents do not join lines: each block of documents sends the distinct hashes of its lines to
the shards as packed arrays, a shard's task probes its own arrays and answers with the hashes that are shared
by enough documents, and only texts that lose lines are cut. A line with a third of all occurrences is one hash per
block; shards are dealt by hash, so none is hot.

Defined results: a null or empty text is one empty line; the key of a line is the line without ASCII white space at
its ends, A-Z lower-cased; empty keys never go unless ``min_chars`` is 0. Every row is a document, also when ids
are null or repeated or rows are equal; columns named like the added ones are replaced. Lines are told
apart by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areascore.llm.batches import chunks
from areascore.llm.perfect_hash import Shard, build
from areascore.sources.storage import stage

#: Keys of one shard, about: some 17 bytes each.
SHARD_KEYS = 1 << 16
#: Bytes of text whose lines ask together.
BLOCK_BYTES = 1 << 24
ADDED = {"n_lines": T.LongType(), "n_dropped": T.LongType(), "kept": T.StringType()}
#: Columns a document is found again by; names that no table has.
ROW_KEY = ("__line_dedup_1", "__line_dedup_2")
BYTES, GONE = "__line_dedup_bytes", "__line_dedup_gone"
PARTS = ("sizes", "bits", "prints", "counts")
NONE = np.zeros((0, 2), np.uint64)


def line_keys(text: bytes) -> list[bytes]:
    return [line.strip() for line in text.lower().split(b"\n")]


def _long_enough(key: bytes, least: int) -> bool:
    # Bytes that start a code point; only short keys need the count.
    return len(key) >= 4 * least or sum(b & 0xC0 != 0x80 for b in key) >= least


def line_hashes(text: bytes, min_chars: int) -> np.ndarray:
    """Two 64-bit words for each line, both 0 for lines that are never dropped."""
    digest, short = xxhash.xxh3_128_digest, bytes(16)
    packed = b"".join([digest(k) if _long_enough(k, min_chars) else short for k in line_keys(text)])
    return np.frombuffer(packed, ">u8").astype(np.uint64).reshape(-1, 2)


def distinct(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of an array of word pairs, ascending, and how often each occurs."""
    if not len(pairs):
        return NONE, np.zeros(0, np.int64)
    ordered = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    new = np.ones(len(ordered), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    starts = np.flatnonzero(new)
    return ordered[starts], np.diff(np.r_[starts, len(ordered)])


def _row_key(doc_id: str, text: str) -> list[Column]:
    # Equal texts lose equal lines, so a key need only tell texts apart; ids spread the copies of one text.
    return [F.xxhash64(F.lit(1), doc_id, text).alias(ROW_KEY[0]), F.xxhash64(F.lit(2), text, doc_id).alias(ROW_KEY[1])]


def _hashed(docs: DataFrame, text: str, doc_id: str, min_chars: int) -> DataFrame:
    """For each block of documents: their row keys, and their lines' hashes in a row with where each ends."""
    schema = T.StructType().add("block", "long").add("keys", "binary").add("ends", "binary").add("lines", "binary")
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in chunks(batches, limit=BLOCK_BYTES):
            each = [line_hashes(t or b"", min_chars) for t in batch.column("text").to_pylist()]
            keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in ROW_KEY], axis=1)
            ends = np.cumsum([len(e) for e in each], dtype=np.int64)
            row = [block], [keys.tobytes()], [ends.tobytes()], [np.concatenate(each).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, (pa.int64(), *3 * [pa.binary()]))], names)
            block += 1

    rows = docs.select(*_row_key(doc_id, text), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, schema)


def line_counts(blocks: DataFrame) -> DataFrame:
    """``h1``, ``h2`` and the number ``n`` of documents of every line hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ends, lines in zip(batch.column("ends").to_pylist(), batch.column("lines").to_pylist()):
                pairs, last = np.frombuffer(lines, np.uint64).reshape(-1, 2), np.frombuffer(ends, np.int64)
                owner = np.repeat(np.arange(len(last)), np.diff(last, prepend=0))
                keep = pairs.any(axis=1)
                pairs, owner = pairs[keep], owner[keep]
                order = np.lexsort((pairs[:, 1], pairs[:, 0], owner))
                pairs, owner = pairs[order], owner[order]
                once = np.ones(len(pairs), bool)
                once[1:] = (pairs[1:] != pairs[:-1]).any(axis=1) | (owner[1:] != owner[:-1])
                pairs, n = distinct(pairs[once])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].view(np.int64)), pa.array(n)], ["h1", "h2", "n"]
                )

    return blocks.select("ends", "lines").mapInArrow(run, "h1 long, h2 long, n long").groupBy("h1", "h2").agg(F.sum("n").alias("n"))


def build_index(counts: DataFrame, shards: int) -> DataFrame:
    """One row per shard: its level sizes, bits, fingerprints and counts."""
    schema = T.StructType().add("shard", "long")
    for name in PARTS:
        schema = schema.add(name, "binary")

    def run(key: tuple, group: pa.Table) -> pa.Table:
        h1, h2, n = (group[c].to_numpy() for c in ("h1", "h2", "n"))
        packed = build(h1.view(np.uint64), h2.view(np.uint64), n)
        return pa.table({"shard": [key[0].as_py()], **{name: [part] for name, part in zip(PARTS, packed)}})

    return counts.withColumn("shard", F.pmod("h1", F.lit(shards))).groupBy("shard").applyInArrow(run, schema)


def _questions(blocks: DataFrame, shards: int) -> DataFrame:
    """The distinct hashes of each block's lines, packed per shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lines in zip(batch.column("block").to_pylist(), batch.column("lines").to_pylist()):
                pairs, _ = distinct(np.frombuffer(lines, np.uint64).reshape(-1, 2))
                pairs = pairs[pairs.any(axis=1)]
                shard = np.mod(pairs[:, 0].view(np.int64), shards)
                order = np.argsort(shard, kind="stable")
                pairs, shard = pairs[order], shard[order]
                first = np.flatnonzero(np.diff(shard, prepend=-1))
                asked = [p.tobytes() for p in np.split(pairs, first[1:])] if len(first) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[first]), pa.array([block] * len(first), pa.int64()), pa.array(asked, pa.binary())],
                    ["shard", "block", "asked"],
                )

    return blocks.select("block", "lines").mapInArrow(run, "shard long, block long, asked binary")


def probe(index: DataFrame, questions: DataFrame, shards: int, least: int) -> DataFrame:
    """``block`` and, packed, those of its hashes that ``least`` or more documents have.

    A shard and what is asked of it meet in one task, the shard first, so a task holds one shard and one
    batch of questions however many blocks ask.
    """
    empty = [F.lit(None).cast("binary").alias(n) for n in PARTS]
    index = index.select("shard", F.lit(-1).cast("long").alias("block"), F.lit(None).cast("binary").alias("asked"), *PARTS)
    both = index.unionByName(questions.select("shard", "block", "asked", *empty))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, opened = None, None
        for batch in batches:
            blocks, hits = [], []
            for row in batch.to_pylist():
                if row["asked"] is None:
                    at, opened = row["shard"], Shard(*(row[n] for n in PARTS))
                elif row["shard"] == at:
                    pairs = np.frombuffer(row["asked"], np.uint64).reshape(-1, 2)
                    shared = pairs[opened.counts_of(pairs[:, 0], pairs[:, 1]) >= least]
                    if len(shared):
                        blocks.append(row["block"])
                        hits.append(shared.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(hits, pa.binary())], ["block", "hits"])

    dealt = both.repartition(shards, "shard").sortWithinPartitions("shard", "block")
    return dealt.mapInArrow(run, "block long, hits binary")


def _marks(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Row keys of the documents that lose lines, with the numbers of these lines."""
    schema = T.StructType().add(ROW_KEY[0], "long").add(ROW_KEY[1], "long").add(GONE, "binary")
    per_block = answers.groupBy("block").agg(F.collect_list("hits").alias("hits"))  # at most the block's own hashes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hits = np.frombuffer(b"".join(row["hits"]), np.uint64).reshape(-1, 2)
                lines = np.frombuffer(row["lines"], np.uint64).reshape(-1, 2)
                keys, ends = np.frombuffer(row["keys"], np.int64).reshape(-1, 2), np.frombuffer(row["ends"], np.int64)
                known = set(map(bytes, hits.view("V16").ravel().tolist()))
                # First by one word, by numpy; then both words of what is left.
                maybe = np.flatnonzero(np.isin(lines[:, 0], hits[:, 0]))
                sure = np.array([m for m, v in zip(maybe, lines[maybe].view("V16").ravel().tolist()) if bytes(v) in known], np.int64)
                owner = np.searchsorted(ends, sure, "right")
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                doc = owner[first]
                local = sure - np.where(owner > 0, ends[owner - 1], 0)
                gone = [p.astype("<i8").tobytes() for p in np.split(local, first[1:])] if len(first) else []
                yield pa.RecordBatch.from_arrays([pa.array(keys[doc, 0]), pa.array(keys[doc, 1]), pa.array(gone, pa.binary())], schema.names)

    joined = blocks.join(per_block, "block").select("keys", "ends", "lines", "hits")
    return joined.mapInArrow(run, schema).groupBy(*ROW_KEY).agg(F.first(GONE).alias(GONE))  # equal rows have equal lines


def drop_shared_lines(
    docs: DataFrame, least: int = 10, min_chars: int = 1, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept``, the text without lines that ``least`` documents share.

    Keys of fewer than ``min_chars`` code points are no lines to drop. ``least`` is at least 2.
    """
    if least < 2:
        raise ValueError("a line is shared by two documents at least")
    spark = docs.sparkSession
    docs = docs.drop(*(c for c in ADDED if c not in (text, doc_id)))
    blocks = stage(_hashed(docs, text, doc_id, min_chars), "line_hashes")
    shared = stage(line_counts(blocks).where("n > 1"), "line_counts")
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shared.count() // SHARD_KEYS))
    index = build_index(shared, shards)
    marks = _marks(blocks, probe(index, _questions(blocks, shards), shards, least))
    schema = T.StructType(docs.schema.fields + [T.StructField(n, k) for n, k in ADDED.items()])
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, gone, kept = [], [], []
            for raw, cut in zip(batch.column(BYTES).to_pylist(), batch.column(GONE).to_pylist()):
                raw = raw or b""
                lines.append(raw.count(b"\n") + 1)
                drop = set(np.frombuffer(cut, "<i8").tolist()) if cut else ()
                gone.append(len(drop))
                kept.append(b"\n".join([x for k, x in enumerate(raw.split(b"\n")) if k not in drop]) if drop else raw)
            columns = [batch.column(c) for c in names]
            added = [pa.array(lines, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string(), safe=False)]
            yield pa.RecordBatch.from_arrays([*columns, *added], names=schema.names)

    keyed = docs.withColumns({n: c for n, c in zip(ROW_KEY, _row_key(doc_id, text))})
    cut = keyed.join(marks, [*ROW_KEY], "left").withColumn(BYTES, F.col(text).cast("binary"))
    return cut.select(*names, BYTES, GONE).mapInArrow(run, schema)
