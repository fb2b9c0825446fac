"""Removal of repeated byte strings with suffix arrays over the places that can repeat.

A byte goes if a string of LENGTH bytes that covers it also starts earlier. Each window of LENGTH bytes has an
anchor, its smallest GRAM-byte hash; equal windows have equal anchors at equal places, and all windows of an
anchor lie in one run of bytes, its context. Contexts are told apart by 64 bits of hash beside the 64 of their anchor. Equal ones are
settled without their bytes: within a block of texts at once, else where the rows of an anchor pass by in order; the earliest
stays. Bytes are moved only for contexts whose anchor has others. Each is parted in two, its windows that hold HALF bytes from the
anchor on and the rest, which hold as many up to its end, and dealt by these bytes. A task sorts the suffixes of a block of
parts in two stages: suffixes smaller than their successor are sorted directly, all others are induced by one scan over the
buckets of first bytes; neighbours in this order that share LENGTH bytes form a class, of which the earliest member stays.

More than GROUP parts with the same HALF bytes are not gathered: their windows are dealt by their own digest and compared there.

Defined results: null and empty texts have no bytes; ids are taken as unique (a repeated row is judged like the
row it repeats); a null id sorts first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.llm.batches import chunks
from areascore.llm.minimizers import leftmost_minima
from areascore.llm.words import mixed
from areascore.sources.storage import stage

LENGTH, GRAM = 100, 32
#: Bytes that the windows of a part share: the anchor and half of what else a window holds.
HALF = GRAM + (LENGTH - GRAM) // 2
GROUP = 20_000
BLOCK_BYTES = 1 << 20
ODD = 0x9E3779B97F4A7C15
INVERSE = pow(ODD, -1, 1 << 64)
NO_ID = -(1 << 63)


def two_stage_suffixes(data: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` values (ties in any order).

    ``data`` holds small non-negative integers; the end sorts before everything.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    follows = np.r_[data[1:], -1].astype(np.int32)
    # A suffix is ascending if it is smaller than its successor; in a run of equal values the end decides.
    change = np.flatnonzero(data != follows)
    decides = change[np.searchsorted(change, np.arange(n))]
    ascending = data[decides] < follows[decides]
    direct = _sorted_directly(data, np.flatnonzero(ascending), depth)
    firsts = data[direct]
    size = int(data.max()) + 1
    bounds = np.searchsorted(firsts, np.arange(size + 1))
    waiting: list[list[np.ndarray]] = [[] for _ in range(size)]
    # The last suffix has an empty successor, which is the smallest of all.
    waiting[data[n - 1]].append(np.array([n - 1]))
    out = []
    for value in range(size):
        bucket = waiting[value]
        k = 0
        while k < len(bucket):
            before = bucket[k] - 1
            before = before[before >= 0]
            induced = before[(data[before] == value) & ~ascending[before]]
            if len(induced):
                bucket.append(induced)
            k += 1
        whole = np.concatenate([*bucket, direct[bounds[value] : bounds[value + 1]]])
        out.append(whole)
        before = whole[whole > 0] - 1
        before = before[~ascending[before] & (data[before] > value)]
        values = data[before]
        order = np.argsort(values, kind="stable")
        before, values = before[order], values[order]
        cuts = np.flatnonzero(np.diff(values)) + 1
        for part in np.split(before, cuts):
            if len(part):
                waiting[data[part[0]]].append(part)
    return np.concatenate(out)


def _words(data: np.ndarray, depth: int) -> np.ndarray:
    """Four values from each position on as one integer, positions beyond the end as zeros."""
    padded = np.r_[data.astype(np.uint64) + 1, np.zeros(depth + 8, np.uint64)]
    n = len(data) + depth + 4
    return (padded[:n] << np.uint64(48)) | (padded[1 : n + 1] << np.uint64(32)) | (padded[2 : n + 2] << np.uint64(16)) | padded[3 : n + 3]


def _sorted_directly(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Starts in the order of ``depth`` values: by four values at a time, tied groups only."""
    words = _words(data, depth)
    order = starts[np.argsort(words[starts], kind="stable")]
    group = np.r_[0, np.cumsum(words[order][1:] != words[order][:-1])] if len(order) else order
    for at in range(4, depth, 4):
        count = np.bincount(group) if len(group) else np.zeros(0, np.int64)
        tied = np.flatnonzero(count[group] > 1) if len(group) else group
        if not len(tied):
            break
        key = words[order[tied] + at]
        rank = np.lexsort((key, group[tied]))
        order[tied], key, own = order[tied][rank], key[rank], group[tied][rank]
        # New groups: places where the old group or the key changes.
        full = np.zeros(len(order), bool)
        full[1:] = group[1:] != group[:-1]
        inner = np.zeros(len(tied), bool)
        inner[1:] = (own[1:] == own[:-1]) & (key[1:] != key[:-1])
        full[tied] |= inner
        group = np.cumsum(full)
    return order


def same_as_next(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Whether each suffix shares its first ``depth`` values with the one after it in ``order``."""
    words = _words(data, depth)
    open_ = np.arange(len(order) - 1)
    for at in range(0, depth, 4):
        a, b = words[order[open_] + at], words[order[open_ + 1] + at]
        left = max(0, 4 - (depth - at))
        if left:
            a, b = a >> np.uint64(16 * left), b >> np.uint64(16 * left)
        open_ = open_[a == b]
    out = np.zeros(len(order), bool)
    out[open_] = True
    return out


def _bytes(batch: pa.RecordBatch) -> tuple[list[bytes], list]:
    plain = [t or b"" for t in pc.cast(batch.column("text"), pa.binary()).to_pylist()]
    return plain, batch.column("id").to_pylist()


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window, hash of the context) of the anchors of all texts in a row."""
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < LENGTH:
        return empty.astype(np.uint64), empty, empty, empty, empty.astype(np.uint64)
    gram, span, factor = mixed(data.astype(np.uint64) + np.uint64(1)), 1, ODD
    while span < GRAM:
        gram = gram[:-span] * np.uint64(factor) + gram[span:]
        factor, span = factor * factor % (1 << 64), span * 2
    gram = mixed(gram)
    chosen = leftmost_minima(gram, LENGTH - GRAM + 1)
    start = np.arange(len(chosen))
    stop = np.repeat(ends, np.diff(ends, prepend=0))[: len(chosen)]
    start = start[start + LENGTH <= stop]
    chosen, text = chosen[start], stop[start]
    if not len(start):
        return empty.astype(np.uint64), empty, empty, empty, empty.astype(np.uint64)
    new = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])])
    low, high = start[new], start[np.r_[new[1:], len(start)] - 1]
    # Sums of hashed grams times powers of an odd number; the inverse powers bring a context to the front.
    powers, back = (np.cumprod(np.full(len(gram), f, np.uint64)) for f in (ODD, INVERSE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(gram * powers)])
    return gram[chosen[new]], chosen[new], low, high, mixed((sums[high + LENGTH - GRAM + 1] - sums[low]) * back[low])


PLACE = "anchor long, id long, low int, windows int, at int"


def _same_place(ids: np.ndarray, lows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a row is its first row's place again, as a repeated document has it."""
    return (ids == ids[first]) & (lows == lows[first])


def _anchored(rows: DataFrame) -> DataFrame:
    """Places of anchors; a context that came before in the same block of texts is marked ``done`` and dealt anywhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=BLOCK_BYTES):
            plain, ids = _bytes(batch)
            ends = np.cumsum([len(t) for t in plain])
            hashes, place, low, high, context = anchors(np.frombuffer(b"".join(plain), np.uint8), ends)
            text = np.searchsorted(ends, place, "right")
            begin = (ends - [len(t) for t in plain])[text]
            own, start, windows, at = np.array(ids, np.int64)[text], low - begin, high - low + 1, place - low
            order = np.lexsort((start, own, context, at, windows, hashes))
            hashes, own, start, windows, at, context = (x[order] for x in (hashes, own, start, windows, at, context))
            new = np.ones(len(order), bool)
            new[1:] = np.any([x[1:] != x[:-1] for x in (hashes, windows, at, context)], axis=0)
            first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
            keep = new | ~_same_place(own, start, first)
            spread = mixed(own.astype(np.uint64) * np.uint64(ODD) + start.astype(np.uint64))
            columns = [
                np.where(new, hashes, spread).view(np.int64), own, start.astype(np.int32), windows.astype(np.int32), at.astype(np.int32),
                context.view(np.int64), ~new,
            ]
            names = ["anchor", "id", "low", "windows", "at", "context", "done"]
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], names=names)

    return rows.mapInArrow(run, PLACE + ", context long, done boolean")


def _earliest(found: DataFrame) -> DataFrame:
    """From places in the order of anchor, context, id and low: those whose windows all go, without an anchor, and the
    first of each context of an anchor with several. One row is held back between batches, whatever an anchor has.
    """
    names = ["anchor", "id", "low", "windows", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The first row of the last context, and whether it has been given out.
        held: dict[str, np.ndarray] | None = None
        given = False

        def rows(part: dict[str, np.ndarray], pick: np.ndarray, gone: bool) -> pa.RecordBatch:
            columns = [pa.array(part[n][pick]) for n in names]
            if gone:
                columns[0] = pa.nulls(len(columns[1]), pa.int64())
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            part = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in [*names, "context", "done"]}
            done = part["done"]
            if done.any():
                yield rows(part, np.flatnonzero(done), True)
                part = {n: x[~done] for n, x in part.items()}
            if not len(part["anchor"]):
                continue
            if held is not None:
                part = {n: np.concatenate([held[n], part[n]]) for n in part}
            n = len(part["anchor"])
            fresh, new = np.ones(n, bool), np.ones(n, bool)
            fresh[1:] = part["anchor"][1:] != part["anchor"][:-1]
            new[1:] = np.any([part[c][1:] != part[c][:-1] for c in ("anchor", "windows", "at", "context")], axis=0)
            first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            gone = ~new & ~_same_place(part["id"], part["low"], first)
            yield rows(part, np.flatnonzero(gone), True)
            firsts = np.flatnonzero(new)
            joined = ~fresh[firsts]  # an earlier context of the anchor is known
            joined[0] = given
            several = joined.copy()
            several[:-1] |= joined[1:]
            several[0] &= not given
            yield rows(part, firsts[several], False)
            held, given = {c: x[firsts[-1:]] for c, x in part.items()}, bool(joined[-1])

    return found.mapInArrow(run, PLACE)


def _parts(places: DataFrame) -> DataFrame:
    """(key, id, low, windows, context) from rows (id, text, places of the anchors), each context parted by HALF bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("key", pa.int64()), ("id", pa.int64()), ("low", pa.int32()), ("windows", pa.int32()), ("context", pa.binary())]
        for batch in chunks(batches, limit=1 << 18):
            plain, ids = _bytes(batch)
            columns: list[list] = [[] for _ in kinds]
            for t, i, many in zip(plain, ids, batch.column("places").to_pylist(), strict=True):
                for p in many:
                    at, low, stop = p["low"] + p["at"], p["low"], p["low"] + p["windows"]
                    middle = min(max(at + HALF - LENGTH, low), stop)
                    for side, (a, b, core) in enumerate(((low, middle, at + GRAM - HALF), (middle, stop, at))):
                        if a < b:
                            key = xxhash.xxh3_64_intdigest(t[core : core + HALF], side)
                            row = (key - (key >> 63 << 64), i, a, b - a, t[a : b - 1 + LENGTH])
                            for column, value in zip(columns, row, strict=True):
                                column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])

    return places.mapInArrow(run, "key long, id long, low int, windows int, context binary")


def block_repeats(contexts: list[bytes], windows: np.ndarray, ids: np.ndarray, lows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, window) of every window of a block that equals one with a smaller (id, start)."""
    sizes = np.array([len(c) + 1 for c in contexts])
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join([c + b"\0" for c in contexts]), np.uint8).astype(np.int32) + 1
    data[begins + sizes - 1] = 0
    order = two_stage_suffixes(data, LENGTH)
    owner = np.repeat(np.arange(len(contexts)), sizes)
    offset = np.arange(len(data)) - begins[owner]
    same = same_as_next(data, order, LENGTH)
    group = np.cumsum(np.r_[True, ~same[:-1]])
    # Only full windows count; a class may be mixed with suffixes that are cut off by the end of a context.
    real = offset[order] < windows[owner[order]]
    place, group = order[real], group[real]
    rank = np.lexsort((lows[owner[place]] + offset[place], ids[owner[place]], group))
    place, group = place[rank], group[rank]
    if not len(group):
        return place, place
    new = np.r_[True, group[1:] != group[:-1]]
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    again = ~new & ~_same_place(ids[owner[place]], lows[owner[place]] + offset[place], first)
    return owner[place[again]], offset[place[again]]


def _settled(gathered: DataFrame) -> DataFrame:
    """(id, start): windows that go, from parts in the order of their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def settle() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            ids, lows = table.column("id").to_numpy(), table.column("low").to_numpy()
            owner, offset = block_repeats(table.column("context").to_pylist(), table.column("windows").to_numpy(), ids, lows)
            starts = (lows[owner] + offset).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(ids[owner]), pa.array(starts)], names=["id", "start"])

        last = None
        for batch in batches:
            keys = batch.column("key").to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if size > BLOCK_BYTES and keys[a] != last:
                    yield settle()
                    held, size = [], 0
                part = batch.slice(a, b - a)
                held.append(part)
                size += part.nbytes
                last = keys[a]
        if held:
            yield settle()

    return gathered.mapInArrow(run, "id long, start int")


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_bytes, spans, n_removed, kept_sha256); spans are byte ranges (start, end), ascending."""
    rows = docs.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_ID)).alias("id"), F.col(f"`{text}`").alias("text"))
    order = ["anchor", "windows", "at", "context", "id", "low"]
    places = stage(_earliest(_anchored(rows).repartition("anchor").sortWithinPartitions(*order)), "places")
    # One row per document, at most as long as the document.
    several = places.where("anchor IS NOT NULL").groupBy("id").agg(F.collect_list(F.struct("low", "windows", "at")).alias("places"))
    parts = stage(_parts(rows.join(several, "id")), "parts")
    count = parts.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    some = parts.join(count.where(F.col("c") <= GROUP).select("key"), "key", "left_semi")
    settled = _settled(some.repartition("key").sortWithinPartitions("key"))
    # Crowded keys: windows are dealt by their own digest, counted before the shuffle.
    crowd = parts.join(count.where(F.col("c") > GROUP).select("key"), "key", "left_semi").select(
        "id",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.col("windows") - 1), lambda k: F.sha2(F.substring(F.col("context"), k + 1, F.lit(LENGTH)), 256))).alias("k", "window"),
        "low",
    ).select("id", (F.col("low") + F.col("k")).alias("start"), "window")
    earliest = crowd.groupBy("window").agg(F.min(F.struct("id", "start")).alias("at"))
    crowded = crowd.join(earliest, "window").where(F.struct("id", "start") != F.col("at")).select("id", "start")
    single = settled.unionByName(crowded).withColumn("end", F.col("start") + LENGTH)
    whole = places.where("anchor IS NULL").select("id", F.col("low").alias("start"), (F.col("low") + F.col("windows") - 1 + LENGTH).alias("end"))
    # The windows of an equal context that its earliest copy loses to another context go by the copy itself.
    ranges = single.unionByName(whole).groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    out = _cleaned(rows.join(ranges, "id", "left"))
    return out.withColumnRenamed("id", key).withColumn(key, F.when(F.col(key) != NO_ID, F.col(key)))


def _cleaned(rows: DataFrame) -> DataFrame:
    """(id, n_bytes, spans, n_removed, kept_sha256) from (id, text, ranges)."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            plain, ids = _bytes(batch)
            spans, gone, kept = [], [], []
            for text, ranges in zip(plain, batch.column("ranges").to_pylist(), strict=True):
                merged: list[list[int]] = []
                for a, b in sorted((r["start"], r["end"]) for r in ranges or ()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                done, left = 0, []
                for a, b in merged:
                    left.append(text[done:a])
                    done = b
                left.append(text[done:])
                spans.append([{"start": a, "end": b} for a, b in merged])
                gone.append(sum(b - a for a, b in merged))
                kept.append(hashlib.sha256(b"".join(left)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(t) for t in plain], pa.int64()), pa.array(spans, span), pa.array(gone, pa.int64()), pa.array(kept)],
                names=["id", "n_bytes", "spans", "n_removed", "kept_sha256"],
            )

    return rows.mapInArrow(run, "id long, n_bytes long, spans array<struct<start:int,end:int>>, n_removed long, kept_sha256 string")
