"""Jaccard self-join of word shingle sets by universe partition and the pigeonhole principle.

Sets fall into size bands. For a band, the largest symmetric difference that two linked sets can have is known
(``differences``); the universe is cut by hash into segments whose values add up to more than that, so two
linked sets differ by less than a segment's value in at least one segment. A segment of value 1 is indexed as
it is; one of value 2 is twice as wide and indexed with its one-deletion neighbourhood. ``allocate`` picks
the split of the total into values 1 and 2 by expected cost. Both sides of a pair use the plan of the smaller
set's band. Each document leaves out segments worth ``slack``, the emptiest first, so that segments with nothing or
little in them are hardly ever indexed; the plan holds as much in reserve, so no link is lost (see ``allocate``).

Equal sets are joined by a 128-bit digest; one of them is indexed. Texts are cut into shingles once for sizes,
images and index entries. Members of a segment's group are verified against
the group's first member, which makes as many pairs as members; only groups that then still hold several
components are paired further: the members outside the group's largest component with all members of other
components, under an exact bound from 512-bit images of the
sets. Links are verified on whole sets of 64-bit shingle hashes.

Defined results: a text that is null or without words has an empty set, no links and itself as component; ids
are taken as unique (a repeated row repeats its result); a null id has a null component.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areascore.llm.batches import chunks, texts, worker_store
from areascore.llm.components import components
from areascore.llm.words import ODD, WordHashes, mixed, shingle_sets, split_words
from areascore.sources.storage import stage

BAND_RATIO = 1.25
SLACK = 0.25
IMAGE_WORDS = 8
#: Weight of a needless candidate against one index entry, and the share of shingles that are common.
CANDIDATE_WEIGHT, COMMON = 100.0, 0.25


def least_partner(size: int, percent: int) -> int:
    """Size of the smallest set that can be linked with one of ``size``."""
    return -(-percent * size // 100)


def largest_partner(size: int, percent: int) -> int:
    return 100 * size // percent


def differences(size: int, percent: int) -> int:
    """Largest symmetric difference of a set of up to ``size`` and a linked set that is not smaller."""
    total = size + largest_partner(size, percent)
    return (100 - percent) * total // (100 + percent)


@lru_cache(maxsize=4096)
def bands(largest: int) -> tuple[int, ...]:
    """First size of each band, up to one beyond ``largest``."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(out[-1] * BAND_RATIO)))
    return tuple(out)


@lru_cache(maxsize=4096)
def allocate(low: int, high: int, percent: int) -> tuple[int, int, int]:
    """Segments of value 1, segments of value 2, and slack, for sets of sizes ``low`` to ``high``.

    With values of 1 only, segments that two sets have in common hold as many shingles in both, so both leave
    out the first of them in one order (by count, then place): a reserve of ``slack`` is enough. A segment of
    value 2 may hold one shingle more in one set, so with such segments the reserve is twice as large.
    """
    need = differences(high, percent) + 1
    slack = math.ceil(SLACK * need) if need > 1 else 0
    size = (low + high) / 2

    def cost(double: int) -> float:
        total = need + (2 * slack if double else slack)
        single, unit = total - 2 * double, size / total
        needless = lambda width: CANDIDATE_WEIGHT * COMMON ** max(width, 0.0)
        return single * (1 + needless(unit)) + double * (2 * unit + 1) * (1 + needless(2 * unit - 1))

    double = min(range((need + 2 * slack) // 2 + 1), key=cost)
    return need + (2 * slack if double else slack) - 2 * double, double, slack


def signatures(values: np.ndarray, low: int, high: int, percent: int) -> np.ndarray:
    """Index entries of one set under the plan of a band."""
    single, double, slack = allocate(low, high, percent)
    # The universe is cut into units; a segment of value 2 holds two of them.
    unit = (mixed(values * ODD) % np.uint64(single + 2 * double)).astype(np.int64)
    segment = np.where(unit < single, unit, single + (unit - single) // 2)
    worth = np.r_[np.ones(single, np.int64), np.full(double, 2)]
    count = np.bincount(segment, minlength=single + double)
    sums = np.zeros(single + double, np.uint64)
    np.add.at(sums, segment, mixed(values))
    emptiest = np.argsort(count, kind="stable")
    skipped = emptiest[np.cumsum(worth[emptiest]) <= slack]
    use = np.ones(single + double, bool)
    use[skipped] = False
    plan = np.uint64((low << 20) ^ percent)
    at = np.arange(single + double, dtype=np.uint64)
    key = mixed(mixed(at * ODD + plan))
    whole = mixed(sums[use] + key[use])
    again = use[segment] & (segment >= single)
    if not again.any():
        return whole
    fewer = mixed(sums[segment[again]] - mixed(values[again]) + key[segment[again]])
    return np.unique(np.r_[whole, fewer])


def all_signatures(values: np.ndarray, percent: int) -> np.ndarray:
    """Entries under the plan of the set's own band and of bands that hold smaller partners."""
    size = len(values)
    starts = bands(size)
    out = []
    for k in range(len(starts) - 2, -1, -1):
        low, high = starts[k], starts[k + 1] - 1
        if high < least_partner(size, percent):
            break
        out.append(signatures(values, low, high, percent))
    return np.concatenate(out)


def _sets(batches: Iterator[pa.RecordBatch], shingle: int):
    worker_store("set_join")  # an encoder that the pipeline's last stage left would stand beside the sets
    hashes = WordHashes()
    for batch in chunks(batches, limit=1 << 19):
        values, ends = shingle_sets([split_words(t) for t in texts(batch)], shingle, hashes)
        yield batch.column("id"), np.split(values, ends[:-1])


def _image(values: np.ndarray) -> np.ndarray:
    bits = np.zeros(64 * IMAGE_WORDS, bool)
    bits[(mixed(values + ODD) % np.uint64(64 * IMAGE_WORDS)).astype(np.int64)] = True
    return np.packbits(bits).view("<i8")


def described(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(id, n, digest, image words, entries) of each set; entries is its list of index entries."""

    def run(batches):
        for ids, sets in _sets(batches, shingle):
            images = np.stack([_image(s) for s in sets]) if sets else np.zeros((0, IMAGE_WORDS), np.int64)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            entries = [all_signatures(s, percent) if len(s) else s for s in sets]
            ends = np.cumsum([0, *map(len, entries)]).astype(np.int32)
            flat = np.concatenate(entries).view(np.int64) if entries else np.zeros(0, np.int64)
            columns = [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary())]
            columns += [pa.array(np.ascontiguousarray(images[:, k])) for k in range(IMAGE_WORDS)]
            columns += [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "digest", *(f"b{k}" for k in range(IMAGE_WORDS)), "entries"])

    words = ", ".join(f"b{k} long" for k in range(IMAGE_WORDS))
    return rows.mapInArrow(run, f"id long, n long, digest binary, {words}, entries array<long>")


def packed(rows: DataFrame, shingle: int) -> DataFrame:
    """(id, items): the whole set as ascending 64-bit integers."""

    def run(batches):
        for ids, sets in _sets(batches, shingle):
            yield pa.RecordBatch.from_arrays([ids, pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "items"])

    return rows.mapInArrow(run, "id long, items binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are linked."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("right"))

    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                good.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return joined.mapInArrow(run, "a long, b long")


def _items(rows: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """Whole sets of the documents in ``pairs``, written once."""
    needed = stage(pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).distinct(), "needed")
    return stage(packed(rows.join(needed, "id", "left_semi"), shingle).dropDuplicates(["id"]), "items")


def _met(rest: DataFrame, side: Callable[[DataFrame, str], DataFrame], possible: Column) -> DataFrame:
    """Possible pairs (a, b) of different components (ca, cb) that meet in a group of ``rest``; some repeat.

    The largest component of a group meets only the members outside of it, so a large group of near copies
    with a few strangers makes as many pairs as members for each stranger. Sets that share one segment mostly share
    many: where their groups would make more pairs of two components than these have pairs of members, the
    members are paired once, by component.
    """
    sizes = stage(rest.groupBy("entry", "component").agg(F.count(F.lit(1)).alias("c")), "sizes")
    main = sizes.groupBy("entry").agg(F.max(F.struct("c", "component")).alias("m"))
    main = stage(main.select("entry", F.col("m.component").alias("main"), F.col("m.c").alias("most")), "main")
    of = stage(rest.select("component", "id").distinct(), "of")
    many = of.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    meet = sizes.join(main, "entry").where("component <> main").groupBy("component", "main").agg(F.sum(F.col("c") * F.col("most")).alias("grouped"))
    meet = meet.join(many, "component").join(many.select(F.col("component").alias("main"), F.col("n").alias("n_main")), "main")
    meet = stage(meet.select("component", "main", (F.col("grouped") > F.col("n") * F.col("n_main")).alias("whole")), "meet")

    outside = stage(rest.join(main.select("entry", "main"), "entry").where("component <> main"), "outside")
    whole = meet.where("whole").select(F.col("component").alias("ca"), F.col("main").alias("cb"))
    one = side(whole.join(of.select(F.col("component").alias("ca"), F.col("id").alias("a")), "ca"), "a")
    two = side(of.select(F.col("component").alias("cb"), F.col("id").alias("b")), "b")
    met = [one.join(two, "cb").where(possible)]
    by_group = outside.join(meet.where("NOT whole").select("component", "main"), ["component", "main"], "left_semi")
    one = side(by_group.select("entry", F.col("id").alias("a"), F.col("component").alias("ca"), F.col("main").alias("cb")), "a")
    mains = by_group.select("entry", F.col("main").alias("component")).distinct()
    facing = rest.join(mains, ["entry", "component"], "left_semi")
    two = side(facing.select("entry", F.col("id").alias("b"), F.col("component").alias("cb")), "b")
    met.append(one.join(two, ["entry", "cb"]).where(possible))
    # Members outside the largest component meet one another in their groups.
    one = side(outside.select("entry", F.col("id").alias("a"), F.col("component").alias("ca")), "a")
    two = side(outside.select("entry", F.col("id").alias("b"), F.col("component").alias("cb")), "b")
    met.append(one.join(two, "entry").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & possible))
    ordered = [f(x, y).alias(n) for x, y in (("a", "b"), ("ca", "cb")) for f, n in ((F.least, x), (F.greatest, y))]
    return reduce(DataFrame.unionAll, [m.select(*ordered) for m in met])


def _joined_across(rest, rows, side, possible, pairs, label, shingle: int, percent: int) -> DataFrame:
    """``label`` after links between different components of a group; only the components are joined anew."""
    across = stage(_met(rest, side, possible).distinct().join(pairs, ["a", "b"], "left_anti"), "across")
    if across.isEmpty():
        return label
    more = verified(across.select("a", "b"), _items(rows, across, shingle), percent).join(across, ["a", "b"])
    moved = components(more.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    known = label.unionAll(moved.select("id", F.col("id").alias("component"))).groupBy("id").agg(F.min("component").alias("old"))
    moved = moved.select(F.col("id").alias("old"), F.col("component").alias("new"))
    return known.join(moved, "old", "left").select("id", F.coalesce("new", "old").alias("component"))


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, percent: int = 85) -> DataFrame:
    """Rows (key, n_shingles, component_id), one per row of ``docs``."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    known = stage(described(rows, shingle, percent), "sets")
    equal = known.where("n > 0 AND id IS NOT NULL").groupBy("digest", "n").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    # Only sets that occur again have another representative than themselves.
    again = stage(equal.where("copies > 1").select("digest", "n", "rep"), "equal")
    copies = stage(known.where("n > 0").join(again, ["digest", "n"]).where("id <> rep").select("id", "rep").distinct(), "copies")

    listed = known.where("n > 0 AND id IS NOT NULL").select("id", "entries").join(copies.select("id"), "id", "left_anti")
    entries = listed.select(F.explode("entries").alias("entry"), "id")
    # Counted before the shuffle, so a crowded group sends one row per task; the join back may split it.
    shared = entries.groupBy("entry").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z").select("entry", "a")
    members = stage(entries.join(shared, "entry"), "members")
    pairs = stage(members.where("id <> a").select("a", F.col("id").alias("b")).distinct(), "pairs")

    # A first pass drops pairs that the exact bounds exclude, before any set is fetched.
    image = [f"b{k}" for k in range(IMAGE_WORDS)]
    sizes = known.select("id", "n", *image).dropDuplicates(["id"])

    def side(frame: DataFrame, name: str) -> DataFrame:
        own = sizes.select(F.col("id").alias(name), F.struct("n", *image).alias(f"{name}_set"))
        return frame.join(own, name)

    def possible():
        missing = lambda x, y: sum(F.bit_count(F.col(f"{x}_set.{w}").bitwiseAND(F.bitwise_not(F.col(f"{y}_set.{w}")))) for w in image)
        n_a, n_b = F.col("a_set.n"), F.col("b_set.n")
        both = F.least(n_a - missing("a", "b"), n_b - missing("b", "a"))
        return 100 * both >= percent * (n_a + n_b - both)

    near = stage(side(side(pairs, "b"), "a").where(possible()).select("a", "b"), "near")
    # Sets are fetched for the documents of pairs that pass, read by id; few of them make a broadcast join.
    links = stage(verified(near, _items(rows, near, shingle), percent), "links")
    # Groups left with several components after the first links: pairs across components, under the bound.
    label = stage(components(links.unionAll(copies.select(F.col("id").alias("a"), F.col("rep").alias("b")))), "label")
    labelled = members.select("entry", "id").join(label, "id", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "id"))
    open_ = labelled.groupBy("entry").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("c"))
    # Of a group of two, both are tested already.
    open_ = open_.where("x <> y AND c > 2").select("entry")
    rest = stage(labelled.join(open_, "entry", "left_semi"), "rest")
    if not rest.isEmpty():
        label = _joined_across(rest, rows, side, possible(), pairs, label, shingle, percent)
    return known.select("id", "n").join(label, "id", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )
