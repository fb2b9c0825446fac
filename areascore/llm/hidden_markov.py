"""A hidden Markov language model, trained by Baum-Welch over all training documents.

Words are counted over all training documents. The most frequent ones (CLASSES at most) are symbols of their
own, every other word belongs to one more symbol, within which words have add-one probabilities from their
counts; so every text has a proper probability. Texts are read twice, to count words and to write their symbols
(two bytes a token); each Baum-Welch round is one pass over the symbols: tasks run scaled forward and backward
recursions over many documents at once and return expected counts, which are summed up by symbol across
partitions. Scoring runs the scaled forward recursion over whole texts, which is exact.

Words with at least 1/2^20 of all tokens, hence at most 2^20 of them, are sent to the tasks with their counts;
the counts of all other words are joined to the documents that have them.

Words are compared by 64-bit hashes. Defined results: a null or empty text is one end token; without training
texts every word is unknown; repeated rows repeat; a null id counts as training text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areascore.llm.batches import Shared, chunks, texts
from areascore.llm.words import WordHashes, split_words
from areascore.sources.storage import stage

STATES = 8
ROUNDS = 3
CLASSES = 16_384
HEAD_SHARE = 1 << 20
#: No word holds a line end.
END_WORD = b"\n"
COUNTED_WORDS = 300_000
#: Bytes of text, and of symbols, that a task works on at once.
CHUNK, SYMBOL_CHUNK = 6 << 20, 2 << 20
STEP_TOKENS = 1 << 15
#: CLASSES + 1 symbols fit.
SYMBOL = np.dtype("<u2")


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(np.uint64).view(np.int64)


def tokens_of(many: list[str], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts in a row (each text closed by the end token), and where each ends."""
    flat, ends = hashes.flat([[*split_words(t), END_WORD] for t in many])
    return signed(flat), ends


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) over the whole texts of ``rows``; tasks add up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        words, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in chunks(batches, limit=CHUNK):
            flat, _ = tokens_of(texts(batch), hashes)
            words, at = np.unique(np.r_[words, flat], return_inverse=True)
            n = np.bincount(at, np.r_[n, np.ones(len(flat), np.int64)], minlength=len(words)).astype(np.int64)
            if len(words) > COUNTED_WORDS:
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n)], names=["word", "n"])
                words, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n)], names=["word", "n"])

    counted = rows.select("text").mapInArrow(run, "word long, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Head:
    """Frequent words (ascending hashes), their counts and symbols, and totals of the training tokens."""

    words: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    classes: int
    tokens: int
    distinct: int
    rest_tokens: int
    rest_distinct: int

    def find(self, flat: np.ndarray) -> np.ndarray:
        """Place of each token among the frequent words, -1 for others."""
        if not len(self.words):
            return np.full(len(flat), -1)
        at = np.minimum(np.searchsorted(self.words, flat), len(self.words) - 1)
        return np.where(self.words[at] == flat, at, -1)

    def symbol(self, place: np.ndarray) -> np.ndarray:
        out = np.full(len(place), self.classes, np.int32)
        known = place >= 0
        out[known] = self.symbols[place[known]]
        return out


def head_of(vocabulary: DataFrame) -> Head:
    total = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    rows = vocabulary.where(F.col("n") * HEAD_SHARE >= total["n"]).toPandas()  # at most HEAD_SHARE rows
    rows = rows.sort_values(["n", "word"], ascending=[False, True])
    rows["symbol"] = np.minimum(np.arange(len(rows)), CLASSES)
    classes = min(len(rows), CLASSES)
    own = rows.head(classes)
    rows = rows.sort_values("word")
    symbols = np.where(rows["symbol"] < classes, rows["symbol"], classes)
    return Head(
        rows["word"].to_numpy(np.int64),
        rows["n"].to_numpy(np.int64),
        symbols.astype(np.int32),
        classes,
        int(total["n"]),
        int(total["v"]),
        int(total["n"] - own["n"].sum()),
        int(total["v"] - classes),
    )


@dataclass
class Model:
    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray  # symbol, state


class Forward:
    """Scaled recursions over many sequences at once.

    Tokens lie by step, the longest sequence first in each, so that a step reads and writes one slice.
    """

    def __init__(self, model: Model, symbols: np.ndarray, ends: np.ndarray, kind: type = np.float64) -> None:
        self.start, self.moves, self.emits = (m.astype(kind) for m in (model.start, model.moves, model.emits))
        sizes = np.diff(ends, prepend=0)
        self.order = np.argsort(-sizes, kind="stable")
        sizes, begins = sizes[self.order], (ends - sizes)[self.order]
        longest = int(sizes[0]) if len(sizes) else 0
        # How many sequences are longer than t, and where step t begins.
        self.active = np.searchsorted(-sizes, -np.arange(longest), "left")
        self.at = np.concatenate([[0], np.cumsum(self.active)]).astype(np.int64)
        self.nth = np.arange(self.at[-1]) - np.repeat(self.at[:-1], self.active)
        self.symbols = symbols[begins[self.nth] + np.repeat(np.arange(longest), self.active)]
        self.floor = np.finfo(kind).tiny

    def _blocks(self) -> list[tuple[int, int]]:
        """Ranges of steps whose emissions are looked up together."""
        out, low = [], 0
        while low < len(self.active):
            high = max(low + 1, int(np.searchsorted(self.at, self.at[low] + STEP_TOKENS, "right")) - 1)
            out.append((low, high))
            low = high
        return out

    def _forward(self, keep: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Scale of each token and, with ``keep``, the scaled forward rows."""
        kind, states = self.emits.dtype, len(self.start)
        scales = np.empty(len(self.symbols), kind)
        rows = np.empty((len(self.symbols), states), kind) if keep else None
        now, ones = None, np.ones(states, kind)
        for low, high in self._blocks():
            begin = self.at[low]
            emit = self.emits[self.symbols[begin : self.at[high]]]
            for t in range(low, high):
                a, b = self.at[t], self.at[t + 1]
                now = self.start * emit[: b - begin] if t == 0 else (now[: b - a] @ self.moves) * emit[a - begin : b - begin]
                scale = np.maximum(now @ ones, self.floor)
                now /= scale[:, None]
                scales[a:b] = scale
                if keep:
                    rows[a:b] = now
        return scales, rows

    def likelihood(self) -> np.ndarray:
        """log10 probability of each sequence."""
        scales, _ = self._forward(keep=False)
        out = np.empty(len(self.order))
        out[self.order] = np.bincount(self.nth, np.log10(scales), minlength=len(self.order))
        return out

    def expected(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts and moves of all sequences, and the states of each token of ``symbols``."""
        scales, rows = self._forward(keep=True)
        moves = np.zeros(self.moves.shape)
        back = np.ones((len(self.order), len(self.start)), self.emits.dtype)
        turned = np.ascontiguousarray(self.moves.T)
        for low, high in reversed(self._blocks()):
            begin = self.at[low]
            emit = self.emits[self.symbols[begin : self.at[high]]] / scales[begin : self.at[high], None]
            for t in range(high - 1, max(low, 1) - 1, -1):
                a, b = self.at[t], self.at[t + 1]
                carry = back[: b - a] * emit[a - begin : b - begin]
                before = self.at[t - 1]
                moves += rows[before : before + b - a].T @ carry
                rows[a:b] *= back[: b - a]
                back[: b - a] = carry @ turned
        first = rows[: len(self.order)]
        first *= back
        return first.sum(0, dtype=np.float64), moves * self.moves, rows


def initial(head: Head, states: int = STATES, seed: int = 5) -> Model:
    """Word frequencies, each state leaning towards other words; states that tend to stay."""
    rng = np.random.default_rng(seed)
    counts = np.zeros(head.classes + 1)
    inner = head.symbols < head.classes
    counts[head.symbols[inner]] = head.counts[inner]
    counts[head.classes] = head.rest_tokens + 1
    emits = (counts + 1)[:, None] * np.exp(rng.standard_normal((head.classes + 1, states)))
    moves = np.full((states, states), 0.1 / max(1, states - 1)) + np.eye(states) * (0.9 - 0.1 / max(1, states - 1))
    return Model(np.full(states, 1.0 / states), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))


def _sequences(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all rows in a row, and where each row ends."""
    many = batch.column("symbols").to_pylist()
    ends = np.cumsum(np.fromiter(map(len, many), np.int64, len(many))) // SYMBOL.itemsize
    return np.frombuffer(b"".join(many), SYMBOL).astype(np.int32), ends


def improved(rows: DataFrame, classes: int, model: Model) -> Model:
    """One Baum-Welch round over the ``symbols`` of all ``rows``."""
    shared = Shared(rows.sparkSession, model)
    states = len(model.start)
    names = [f"s{k}" for k in range(states)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        total = np.zeros((classes + 2 + states, states))
        for batch in chunks(batches, "symbols", SYMBOL_CHUNK):
            recursion = Forward(own, *_sequences(batch), np.float32)
            start, moves, emitted = recursion.expected()
            for k in range(states):
                total[: classes + 1, k] += np.bincount(recursion.symbols, emitted[:, k], minlength=classes + 1)
            total[classes + 1] += start
            total[classes + 2 :] += moves
        used = np.flatnonzero(total.any(1))
        columns = [pa.array(used), *(pa.array(np.ascontiguousarray(total[used, k])) for k in range(states))]
        yield pa.RecordBatch.from_arrays(columns, names=["row", *names])

    partial = rows.select("symbols").mapInArrow(run, "row long, " + ", ".join(f"{n} double" for n in names))
    summed = partial.groupBy("row").agg(*(F.sum(n).alias(n) for n in names)).toPandas()  # CLASSES + STATES + 2 rows at most
    total = np.zeros((classes + 2 + states, states))
    total[summed["row"].to_numpy(np.int64)] = summed[names].to_numpy()
    emits, start, moves = total[: classes + 1] + 1e-3, total[classes + 1] + 1e-3, total[classes + 2 :] + 1e-3
    return Model(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))


def coded(rows: DataFrame, head, size: int, rest: int) -> DataFrame:
    """Each row of (key, text, training) with its symbols, the sums over its frequent words, and its other words.

    ``head`` is a broadcast; ``row`` is a hash of the text.
    """
    counted = T.ArrayType(T.StructType([T.StructField("word", T.LongType()), T.StructField("n", T.LongType())]))
    pair = pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())]))
    schema = T.StructType(
        [f for f in rows.schema if f.name != "text"]
        + [T.StructField(n, T.LongType()) for n in ("row", "n_tokens", "n_known")]
        + [T.StructField(n, T.DoubleType()) for n in ("base_score", "within")]
        + [T.StructField("symbols", T.BinaryType()), T.StructField("rare", counted)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hashes = head.value, WordHashes()
        inner = known.symbols < known.classes
        base = np.log10((known.counts + 1.0) / size)
        within = np.where(inner, 0.0, np.log10((known.counts + 1.0) / rest))
        for batch in chunks(batches, limit=CHUNK):
            plain = texts(batch)
            flat, ends = tokens_of(plain, hashes)
            place = known.find(flat)
            owner = np.repeat(np.arange(len(plain)), np.diff(ends, prepend=0))
            found = place >= 0
            sums = lambda values: np.bincount(owner[found], values, minlength=len(plain))
            rare: list[list[dict]] = [[] for _ in plain]
            if not found.all():
                cells = np.stack([owner[~found], flat[~found]], 1)
                cells, n = np.unique(cells, axis=0, return_counts=True)
                for (doc, word), times in zip(cells.tolist(), n.tolist(), strict=True):
                    rare[doc].append({"word": word, "n": times})
            row = [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t in plain]
            symbols = known.symbol(place).astype(SYMBOL)
            cut = [symbols[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("training"), pa.array(row, pa.int64()), pa.array(np.diff(ends, prepend=0))]
                + [pa.array(sums(None).astype(np.int64)), pa.array(sums(base[place[found]])), pa.array(sums(within[place[found]]))]
                + [pa.array(cut, pa.binary()), pa.array(rare, pair)],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def likelihoods(rows: DataFrame, model: Model) -> DataFrame:
    """Replace ``symbols`` by ``score``, the exact log10 probability of the sequence."""
    shared = Shared(rows.sparkSession, model)
    kept = [n for n in rows.columns if n != "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "symbols", SYMBOL_CHUNK):
            value = Forward(shared.value, *_sequences(batch)).likelihood()
            columns = [batch.column(n) for n in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(value)], names=[*kept, "score"])

    return rows.mapInArrow(run, T.StructType([rows.schema[n] for n in kept] + [T.StructField("score", T.DoubleType())]))


def score(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Rows (key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.coalesce(training, F.lit(True)).alias("training"))
    learnt = rows.where("training")
    vocabulary = stage(word_counts(learnt), "vocabulary")
    head = Shared(spark, head_of(vocabulary))
    facts = head.value
    size, rest = facts.tokens + facts.distinct + 1, facts.rest_tokens + facts.rest_distinct + 1
    local = stage(coded(rows, head, size, rest), "coded")
    model = initial(facts)
    for _ in range(rounds):
        model = improved(local.where("training"), facts.classes, model)
    # Rows of one key and text are the same document: their rare words are looked up together and shared out.
    local = local.withColumn("row", F.xxhash64("key", "row"))
    asked = local.select("row", F.explode("rare").alias("rare")).select("row", "rare.word", "rare.n")
    counts = asked.join(vocabulary.withColumnRenamed("n", "c"), "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    looked = counts.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1.0) / float(size))).alias("more_base"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1.0) / float(rest))).alias("more_score"),
    )
    scored = likelihoods(local.drop("rare"), model).withColumn("score", F.col("score") + F.col("within"))
    # Copies may differ in the last bits of their scores, by the batch they were in; one of them stands for all.
    sums = [F.min(n).alias(n) for n in ("n_known", "base_score", "score")]
    same = scored.groupBy("row", "key", "training", "n_tokens").agg(*sums, F.count(F.lit(1)).alias("copies"))
    part = lambda name: F.coalesce(F.col(name) / F.col("copies"), F.lit(0.0))
    out = same.join(looked, "row", "left").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select(
        F.col("key").alias(key),
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + part("more_known").cast("long")).alias("n_known"),
        F.lit(facts.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + part("more_base")).alias("base_score"),
        (F.col("score") + part("more_score")).alias("score"),
    )
