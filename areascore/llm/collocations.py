"""Phrases of two to four words that occur together more often than their parts, per language.

Three passes over the texts. The first counts words; the second counts pairs of frequent words, the third phrases of three and four
words whose pairs are all frequent: a phrase cannot be more frequent than a phrase inside it, so none is lost.
What is frequent is known to the tasks as a bit map of fixed size; strangers that share a bit are counted and sorted
out by the sum. Phrases are counted in a ``HatTrie`` per task, which spills whole subtrees as sorted runs; the runs of one
prefix meet in one task and are merged there. The number of prefixes follows the number of words, so a
task holds about ``PREFIX_PHRASES`` phrases, and prefixes take turns in the words of a phrase, so a frequent word is spread.

A word is a hash of 64 bits of its language and itself. Two words of one corpus share one with a chance of n^2 / 2^65.

Defined results: a null text is empty, a null language is ``und``. Every row counts, also equal ones and those
without id; other columns are ignored; no rows give no phrases. Words are cut at blanks and tabs, A-Z lower-cased.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areascore.llm.batches import chunks
from areascore.llm.hat_trie import FAN_BITS, HatTrie, hash_of, prefix_of, summed
from areascore.llm.words import WordHashes, mixed
from areascore.sources.storage import stage

LONGEST = 4
CHUNK = 1 << 23
#: Distinct words a task holds before it hands over their counts.
KEPT_WORDS = 1 << 18
#: Bits of the map of what is frequent: 8 MB, whatever the input.
MAP_BITS = 26
PREFIX_PHRASES = 1 << 18
MAX_PREFIX_LEVELS = 8
#: Characters that end a piece, and what separates words within it.
TABLE = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
WORDS = tuple(f"w{k + 1}" for k in range(LONGEST))
BREAK, NOTHING = np.uint64(0), np.uint64(1)
#: Share of a phrase's occurrences within one longer phrase that makes it part of that, and the scale of scores.
INSIDE_PERCENT, SCALE = 80, 2_000_000


def _by_language(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    found: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        if text:
            found.setdefault(lang, []).append(text)
    return found


def _tokens(many: list[bytes]) -> list[bytes]:
    """Words of texts of one language; a line feed is the end of a piece, empty tokens are nothing."""
    return b"\n".join(many).lower().translate(TABLE).replace(b"\n", b" \n ").split(b" ")


def _word_ids(hashes: np.ndarray, lang: str) -> np.ndarray:
    salt = np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass")))
    return np.maximum(mixed(mixed(hashes ^ mixed(np.array([salt]))[0])), np.uint64(2))


def _sequences(batch: pa.RecordBatch, known: WordHashes) -> Iterator[np.ndarray]:
    """Word ids of each language's texts in a row, 0 between pieces."""
    for lang, many in _by_language(batch).items():
        tokens = _tokens(many)
        known[b""], known[b"\n"] = int(NOTHING), int(BREAK)  # also after the store was emptied
        raw = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        raw = raw[raw != NOTHING]
        yield np.where(raw == BREAK, BREAK, _word_ids(raw, lang))


def _rows(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))


def word_counts(rows: DataFrame) -> DataFrame:
    """``lang``, ``word``, its id ``w1`` and its count ``n``; a row without word has the count of all words."""

    def handed(lang: str, counts: Counter) -> pa.RecordBatch:
        words = list(counts)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        ids = _word_ids(hashes, lang).view(np.int64)
        n = np.fromiter(counts.values(), np.int64, len(words))
        columns = [[lang] * (len(words) + 1), [*words, None], [*ids.tolist(), None], [*n.tolist(), int(n.sum())]]
        kinds = pa.string(), pa.binary(), pa.int64(), pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "word", "w1", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch in chunks(batches, limit=CHUNK):
            for lang, many in _by_language(batch).items():
                counts = held.setdefault(lang, Counter())
                counts.update(_tokens(many))
                del counts[b""], counts[b"\n"]
                if len(counts) > KEPT_WORDS:
                    yield handed(lang, held.pop(lang))
        for lang, counts in held.items():
            yield handed(lang, counts)

    counted = rows.mapInArrow(run, "lang string, word binary, w1 long, n long")
    return counted.groupBy("lang", "word", "w1").agg(F.sum("n").alias("n"))


def frequent_map(hashes: DataFrame, column: str) -> bytes:
    """A bit for each hash, by its highest bits. At most 2^20 rows of two numbers come to the driver."""
    place = F.shiftrightunsigned(column, 64 - MAP_BITS)
    placed = hashes.select(F.shiftright(place, 6).alias("at"), place.alias("place"))
    words = placed.select("at", F.expr("shiftleft(1L, CAST(place & 63 AS INT))").alias("bit"))
    found = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy()
    return out.tobytes()


def _in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - MAP_BITS)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _pairs(ids: np.ndarray) -> np.ndarray:
    return np.stack([ids[:-1], ids[1:]], axis=1)


def _pair_phrases(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    good = (ids != BREAK) & _in_map(bits, ids)
    return _pairs(ids)[good[:-1] & good[1:]]


def _long_phrases(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Phrases of three words, a 0 behind them, and of four."""
    good = (ids[:-1] != BREAK) & (ids[1:] != BREAK)
    good[good] = _in_map(bits, hash_of(_pairs(ids)[good]))
    three = np.flatnonzero(good[:-1] & good[1:])
    four = np.flatnonzero(good[:-2] & good[1:-1] & good[2:])
    out = np.zeros((len(three) + len(four), LONGEST), np.uint64)
    for k in range(3):
        out[: len(three), k] = ids[three + k]
    for k in range(4):
        out[len(three) :, k] = ids[four + k]
    return out


def _counted(rows: DataFrame, phrases, width: int, bits: bytes, levels: int, least: int) -> DataFrame:
    """Frequent phrases: ``w1`` to ``w4`` (0 where shorter), their count ``n`` and a hash of their ids."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, trie, bits = WordHashes(), HatTrie(width), np.frombuffer(shared.value, np.uint64)

        def run_of(path: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            prefix = prefix_of(path, levels)
            first = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
            ends = np.r_[first[1:], len(prefix)]
            packed = [keys[a:b].tobytes() for a, b in zip(first, ends)], [counts[a:b].astype("<u4").tobytes() for a, b in zip(first, ends)]
            return pa.RecordBatch.from_arrays(
                [pa.array(prefix[first].view(np.int64)), *(pa.array(p, pa.binary()) for p in packed)], ["prefix", "phrases", "counts"]
            )

        for batch in chunks(batches, limit=CHUNK):
            for ids in _sequences(batch, known):
                if len(ids) >= LONGEST:
                    for spilled in trie.add(phrases(ids, bits)):
                        yield run_of(*spilled)
        for left in trie.rest():
            yield run_of(*left)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def merged() -> pa.RecordBatch:
            keys = np.frombuffer(b"".join([k for k, _ in held]), np.uint64).reshape(-1, width)
            keys, n = summed(keys, np.frombuffer(b"".join([c for _, c in held]), "<u4").astype(np.int64))
            keys, n = keys[n >= least], n[n >= least]
            ids = [keys[:, k].view(np.int64) if k < width else np.zeros(len(keys), np.int64) for k in range(LONGEST)]
            return pa.RecordBatch.from_arrays([*map(pa.array, ids), pa.array(n), pa.array(hash_of(keys).view(np.int64))], [*WORDS, "n", "hash"])

        for batch in batches:
            for prefix, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("prefix", "phrases", "counts"))):
                if prefix != at and held:
                    yield merged()
                    held = []
                at = prefix
                held.append((keys, counts))
        if held:
            yield merged()

    runs = rows.mapInArrow(count, "prefix long, phrases binary, counts binary")
    dealt = runs.repartition("prefix").sortWithinPartitions("prefix")
    return dealt.mapInArrow(merge, ", ".join(f"{c} long" for c in (*WORDS, "n", "hash")))


def prefix_levels(words: int) -> int:
    levels = 2
    while levels < MAX_PREFIX_LEVELS and words >> (FAN_BITS * levels) > PREFIX_PHRASES:
        levels += 1
    return levels


def _size() -> Column:
    return F.when(F.col("w4") != 0, 4).when(F.col("w3") != 0, 3).when(F.col("w2") != 0, 2).otherwise(1)


def _ids(first: int, stop: int) -> list[Column]:
    """The words ``first`` to ``stop`` of a phrase, then zeros, as the columns of a key."""
    inside = [F.col(WORDS[k]) for k in range(first, stop)]
    return [c.alias(f"p{k + 1}") for k, c in enumerate([*inside, *[F.lit(0).cast("long")] * (LONGEST - len(inside))])]


PART = tuple(f"p{k + 1}" for k in range(LONGEST))


def scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two words or more with ``l``, ``r`` and ``score`` of their weakest cut.

    ``phrases`` holds ``w1`` to ``w4`` and ``n``, single words included.
    """
    cuts = []
    for size in range(2, LONGEST + 1):
        for k in range(1, size):
            for side, ids in (("l", _ids(0, k)), ("r", _ids(k, size))):
                cuts.append(F.struct(F.lit(size).alias("size"), F.lit(f"{side}{k}").alias("part"), *ids))
    candidates = phrases.where("w2 <> 0").withColumn("size", _size())
    asked = candidates.select(*WORDS, F.col("n").alias("a"), F.explode(F.filter(F.array(*cuts), lambda c: c["size"] == F.col("size"))).alias("cut"))
    asked = asked.select(*WORDS, "a", "cut.part", *(f"cut.{p}" for p in PART))
    counts = phrases.select(*(F.col(w).alias(p) for w, p in zip(WORDS, PART)), F.col("n").alias("f"))
    wanted = [f"{side}{k}" for k in range(1, LONGEST) for side in "lr"]
    met = asked.join(counts, list(PART)).groupBy(*WORDS, "a").agg(*(F.max(F.when(F.col("part") == p, F.col("f"))).alias(p) for p in wanted))
    wide = "decimal(20,0)"
    each = [
        F.when(
            F.col(f"l{k}").isNotNull(),
            F.struct(
                F.expr(f"(CAST(a AS {wide}) * {SCALE}) div (CAST(l{k} AS {wide}) + CAST(r{k} AS {wide}))").alias("score"),
                F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"),
            ),
        )
        for k in range(1, LONGEST)
    ]
    weakest = F.array_min(F.filter(F.array(*each), lambda c: c.isNotNull()))
    return met.select(*WORDS, "a", weakest.alias("cut")).select(*WORDS, "a", "cut.l", "cut.r", "cut.score")


def without_parts(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """Candidates that do not mostly occur inside one longer phrase."""
    inner = [
        F.struct(F.lit(size).alias("size"), *_ids(first, first + length))
        for size in range(3, LONGEST + 1)
        for length in range(2, size)
        for first in range(size - length + 1)
    ]
    longer = phrases.where("w3 <> 0").withColumn("size", _size())
    parts = longer.select("n", F.explode(F.filter(F.array(*inner), lambda c: c["size"] == F.col("size"))).alias("part"))
    most = parts.groupBy(*(F.col(f"part.{p}").alias(w) for p, w in zip(PART, WORDS))).agg(F.max("n").alias("_most"))
    kept = candidates.join(stage(most, "inside"), list(WORDS), "left")
    return kept.where(f"_most IS NULL OR _most * 100 < a * {INSIDE_PERCENT}").drop("_most")


def mine(docs: DataFrame, least: int = 30, top: int | None = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``, per language the best ``top`` or all.

    Phrases rank by score, then count, both descending, then by their bytes.
    """
    rows = _rows(docs, text, lang)
    words = stage(word_counts(rows).where(f"word IS NULL OR n >= {least}"), "words")
    totals = words.where("word IS NULL").select("lang", F.col("n").alias("total"))
    known = words.where("word IS NOT NULL")
    levels = prefix_levels(totals.agg(F.sum("total")).first()[0] or 0)
    pairs = stage(_counted(rows, _pair_phrases, 2, frequent_map(known, "w1"), levels, least), "pairs")
    longer = _counted(rows, _long_phrases, LONGEST, frequent_map(pairs, "hash"), levels, least)
    zeros = [F.lit(0).cast("long").alias(w) for w in WORDS[1:]]
    phrases = stage(
        known.select("w1", *zeros, "n").unionByName(pairs.drop("hash")).unionByName(longer.drop("hash")), "phrases"
    )
    ids = known.select(F.col("w1").alias("_id"), F.col("word").cast("string").alias("_word"), F.col("lang").alias("_lang"))
    kept = without_parts(scored(phrases), phrases)
    best = kept.join(ids.select(F.col("_id").alias("w1"), F.col("_lang").alias("lang")), "w1")
    order = F.col("score").desc(), F.col("a").desc()
    if top is not None:  # with all that tie, so that few phrases need their words
        best = best.withColumn("rank", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
        best = stage(best.drop("rank"), "best")
    for k, w in enumerate(WORDS):
        best = best.join(ids.select(F.col("_id").alias(w), F.col("_word").alias(f"_word{k}")), w, "left")
    named = best.withColumn("phrase", F.concat_ws(" ", *(f"_word{k}" for k in range(LONGEST))))
    ranked = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals.withColumnRenamed("total", "n"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
