"""Benchmark decontamination by latent semantic retrieval, confirmed on words.

Words are hashed into FEATURES columns and weighted by inverse document frequency over all documents. A
randomised SVD of the TF-IDF passages of all benchmark texts and all documents (summed up by the cluster in one
pass) gives RANK latent directions. Every document is then read once, whole: running
sums of projected words give the vector of any window, windows as long as the benchmark texts of a length
class, a third of it apart, are compared with these texts, and those whose cosine reaches a share of what
the text has with itself are candidates. A candidate is confirmed by the longest common subsequence of words
near the window: a near copy has at least COPY of the text's words in order; a paraphrase at least
PARAPHRASE of them and the text's answer, its last sentence, word for word.

The benchmark is broadcast in blocks of at most BLOCK texts, each block one more pass. Defined results: null
and empty texts have no leaks; a benchmark text of fewer than five words must occur whole and in a row, one
without words never matches; repeated rows repeat; other columns are passed through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areascore.llm.batches import Shared, chunks, texts
from areascore.llm.words import ODD, mixed

FEATURES = 1 << 15
INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))
RANK = 32
#: All documents together weigh as much as so many in the fit, which keeps the benchmark's share on large tables.
DOCUMENTS_WEIGHT = 1000
#: Weight of a benchmark passage against one of so many documents.
ASKED_WEIGHT = 10.0
PASSAGE = 64
BLOCK = 5000
CLASS_RATIO = 1.6
WINDOW_STEP = 3
#: Share of a text's cosine with itself that makes a window a candidate.
CANDIDATE = 0.45
COPY, PARAPHRASE = 0.8, 0.6
SEARCH_BYTES = 1 << 18
#: Words whose running sums are held at once.
STRETCH = 1 << 17

LEAK = T.ArrayType(
    T.StructType(
        [T.StructField(n, T.LongType()) for n in ("item_id", "start", "end", "common", "item_words")]
        + [T.StructField("cosine", T.DoubleType()), T.StructField("answer", T.BooleanType())]
    )
)
ARROW_LEAK = pa.list_(
    pa.struct([(n, pa.int64()) for n in ("item_id", "start", "end", "common", "item_words")] + [("cosine", pa.float64()), ("answer", pa.bool_())])
)
PUNCTUATION = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
SENTENCE = re.compile(r"[.!?\n]+")


def plain(text: str) -> bytes:
    """Lower-cased, with a space for each ASCII character that is no letter or digit."""
    return text.lower().encode("utf-8", "surrogatepass").translate(PUNCTUATION)


def words_of(text: str) -> list[bytes]:
    return plain(text).split()


_POWERS = [np.ones(0, np.uint64)] * 2


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ODD and of its inverse, kept as far as usual pieces of text need them."""
    if size > len(_POWERS[0]):
        made = [np.cumprod(np.full(max(size, 2 * SEARCH_BYTES), f, np.uint64)) for f in (ODD, INVERSE)]
        if size > 2 * SEARCH_BYTES:
            return made[0], made[1]
        _POWERS[:] = made
    return _POWERS[0][:size], _POWERS[1][:size]


class Cut:
    """The words of many texts in a row as places in their bytes, with a hash and a column for each."""

    def __init__(self, many: list[str]) -> None:
        parts = [plain(t) for t in many]
        self.data = b" ".join([b"", *parts, b""])
        raw = np.frombuffer(self.data, np.uint8)
        letter = raw != 32
        edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        self.starts, self.stops = edge[::2], edge[1::2]
        self.ends = np.searchsorted(self.starts, np.cumsum([len(p) + 1 for p in parts], dtype=np.int64))
        self.sizes = np.diff(self.ends, prepend=0)
        self.begins = self.ends - self.sizes
        # Sums of bytes times powers of an odd number; the inverse powers bring a word to the front.
        powers, back = _powers(len(raw))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers)])
        self.hashes = mixed((sums[self.stops] - sums[self.starts]) * back[self.starts])
        self.columns = (self.hashes % np.uint64(FEATURES)).astype(np.int32)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def words(self, low: int, high: int) -> list[bytes]:
        return self.data[self.starts[low] : self.stops[high - 1]].split() if high > low else []


def document_frequency(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Distinct words of documents per column, over all rows, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(FEATURES + 1, np.int64), 0
        for batch in chunks(batches, limit=SEARCH_BYTES):
            cut = Cut(texts(batch))
            # The low bits, which are the column, stay; the others tell the texts apart.
            words = np.sort(cut.hashes + cut.owners().astype(np.uint64) * ODD * np.uint64(FEATURES))
            words = words[np.concatenate([words[:1] == words[:1], words[1:] != words[:-1]])]
            seen[:FEATURES] += np.bincount((words % np.uint64(FEATURES)).astype(np.intp), minlength=FEATURES)
            n += batch.num_rows
        seen[FEATURES] = n
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(seen[used])], names=["feature", "n"])

    counted = rows.select("text").mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    out = np.zeros(FEATURES + 1, np.int64)
    for row in counted.collect():  # at most FEATURES + 1 rows
        out[row["feature"]] = row["n"]
    return out[:FEATURES], int(out[FEATURES])


def _passages(cut: Cut, idf: np.ndarray):
    """(passage, column, weight) of passages of PASSAGE words, each of length one, and the number of passages in each text."""
    many = -(-cut.sizes // PASSAGE)
    owner = cut.owners()
    passage = (np.cumsum(many) - many)[owner] + (np.arange(len(owner)) - cut.begins[owner]) // PASSAGE
    cells, count = np.unique(passage * FEATURES + cut.columns, return_counts=True)
    row, column = cells // FEATURES, (cells % FEATURES).astype(np.int32)
    weight = count * idf[column]
    norm = np.sqrt(np.bincount(row, weight**2, minlength=int(many.sum())))
    return row, column, weight / np.maximum(norm[row], 1e-12), many


def _summed(rows: DataFrame, idf: np.ndarray, right: np.ndarray) -> np.ndarray:
    """X'X right over all passages X of ``rows`` (text, weight)."""
    shared = rows.sparkSession.sparkContext.broadcast((idf, np.ascontiguousarray(right.T, np.float64)))
    rank = right.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, sides = shared.value
        total = np.zeros((rank, FEATURES))
        for batch in chunks(batches, limit=SEARCH_BYTES):
            row, column, value, passages = _passages(Cut(texts(batch)), weights)
            n = int(passages.sum())
            if not n:
                continue
            value *= np.repeat(batch.column("weight").to_numpy(), passages)[row]
            column, size = column.astype(np.intp), np.bincount(row, minlength=n)
            first = np.cumsum(size) - size  # cells lie by passage, and none is empty
            for k, side in enumerate(sides):
                image = np.add.reduceat(value * side.take(column, mode="clip"), first)
                total[k] += np.bincount(column, value * np.repeat(image, size), minlength=FEATURES)
        used = np.flatnonzero(total.any(0))
        for at in range(0, len(used), 4096):
            part = used[at : at + 4096]
            columns = [pa.array(part), *(pa.array(one[part]) for one in total)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", *(f"v{k}" for k in range(rank))])

    names = [f"v{k}" for k in range(rank)]
    partial = rows.mapInArrow(run, "row long, " + ", ".join(f"{n} double" for n in names))
    summed = partial.groupBy("row").agg(*(F.sum(n).alias(n) for n in names)).toPandas()  # at most FEATURES rows
    out = np.zeros((FEATURES, rank))
    out[summed["row"].to_numpy(np.int64)] = summed[names].to_numpy()
    return out


def latent_directions(rows: DataFrame, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Leading right singular vectors of the passages, by randomised SVD with one power step.

    One pass: the sums give the space of the vectors, and (by Nystroem's formula) their order within it.
    """
    start = np.random.default_rng(11).standard_normal((FEATURES, rank))
    image = _summed(rows, idf, start)
    basis, _ = np.linalg.qr(image)
    inner = basis.T @ image
    values, turn = np.linalg.eigh(inner @ np.linalg.pinv(start.T @ image, hermitian=True) @ inner.T)
    return basis @ turn[:, np.argsort(-values)]


@dataclass
class Item:
    item_id: int
    words: list[bytes]
    answer: list[bytes]


def item_of(item_id: int, text: str | None) -> Item:
    sentences = [words_of(s) for s in SENTENCE.split(text or "")]
    spoken = [s for s in sentences if s]
    return Item(item_id, words_of(text or ""), spoken[-1] if len(spoken) > 1 else [])


def common_subsequence(masks: dict[bytes, int], size: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence, one machine-integer step per word."""
    full = (1 << size) - 1
    row = full
    for word in words:
        hit = row & masks.get(word, 0)
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def contains(words: list[bytes], part: list[bytes]) -> bool:
    n = len(part)
    return any(words[k] == part[0] and words[k : k + n] == part for k in range(len(words) - n + 1))


class Search:
    """Windows of texts against one block of benchmark texts."""

    def __init__(self, items: list[Item], idf: np.ndarray, directions: np.ndarray) -> None:
        self.items = [i for i in items if i.words]
        self.idf = idf.astype(np.float32)
        self.table = (idf[:, None] * directions).astype(np.float32)
        sizes = np.array([len(i.words) for i in self.items], np.int64)
        self.classes = []
        level = np.floor(np.log(np.maximum(sizes, 1)) / np.log(CLASS_RATIO)).astype(int) if len(sizes) else sizes
        for k in np.unique(level):
            own = np.flatnonzero(level == k)
            cut = Cut([b" ".join(self.items[i].words).decode("utf-8", "surrogatepass") for i in own])
            flat, owner = cut.columns, cut.owners()
            vectors = np.zeros((len(own), self.table.shape[1]), np.float32)
            np.add.at(vectors, owner, self.table[flat])
            norms = np.sqrt(np.bincount(owner, self.idf[flat] ** 2, minlength=len(own)))
            latent = np.linalg.norm(vectors, axis=1)
            self_cosine = latent / np.maximum(norms, 1e-9)
            unit = vectors / np.maximum(latent, 1e-9)[:, None]
            # One bit per column that a word of the text falls into.
            bits = np.zeros((len(own), FEATURES // 8), np.uint8)
            np.bitwise_or.at(bits, (owner, flat >> 3), (1 << (flat & 7)).astype(np.uint8))
            self.classes.append((int(sizes[own].max()), own, unit.T.copy(), self_cosine.astype(np.float32), bits))
        self.sizes = sizes
        self.masks: dict[int, dict[bytes, int]] = {}

    def leaks(self, many: list[str]) -> list[list[dict]]:
        out: list[list[dict]] = [[] for _ in many]
        cut = Cut(many)
        flat, ends, sizes = cut.columns, cut.ends, cut.sizes
        if not len(flat) or not self.items:
            return out
        squares = np.concatenate([[0.0], np.cumsum(self.idf[flat].astype(np.float64) ** 2)])
        used = np.flatnonzero(sizes)
        begins, plans = cut.begins[used], []
        for width, *_ in self.classes:
            step = max(1, width // WINDOW_STEP)
            spare = np.maximum(sizes[used] - width, 0)
            count = -(-spare // step) + 1
            owner = np.repeat(np.arange(len(count)), count)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            start = begins[owner] + np.minimum(nth * step, spare[owner])
            plans.append((used[owner], start, np.minimum(start + width, ends[used][owner])))
        widest = max(width for width, *_ in self.classes)
        found: dict[tuple[int, int], list[tuple[float, int, int]]] = {}
        # Running sums of a stretch of words at a time, which bounds these sums; Cut still holds some 40 bytes a byte of a long text.
        for first in range(0, len(flat), STRETCH):
            rows = self.table[flat[first : first + STRETCH + widest]]
            sums = np.zeros((len(rows) + 1, rows.shape[1]), np.float32)
            np.cumsum(rows, axis=0, out=sums[1:])
            for (width, own, units, self_cosine, bits), (texts_, start, stop) in zip(self.classes, plans, strict=True):
                low, high = np.searchsorted(start, [first, first + STRETCH])
                for at in range(low, high, 16384):
                    part = slice(at, min(at + 16384, high))
                    norm = np.sqrt(np.maximum(squares[stop[part]] - squares[start[part]], 1e-9)).astype(np.float32)
                    cosine = ((sums[stop[part] - first] - sums[start[part] - first]) @ units) / norm[:, None]
                    w, i = np.nonzero(cosine >= CANDIDATE * self_cosine)
                    text, item = texts_[at + w], own[i]
                    place = start[at + w] - cut.begins[text]
                    near = self._near(flat, cut.begins[text], sizes[text], place, width, item, bits, i)
                    fits = zip(text[near].tolist(), item[near].tolist(), cosine[w[near], i[near]].tolist(), place[near].tolist(), strict=True)
                    for t, k, value, p in fits:
                        found.setdefault((t, k), []).append((value, p, width))
        for (text, i), windows in found.items():
            leak = self._confirmed(cut, text, i, windows)
            if leak:
                out[text].append(leak)
        return out

    def _near(self, flat, begin, length, place, width, item, bits, row) -> np.ndarray:
        """Which windows have as many words of their item around them as a paraphrase needs; no common subsequence is longer."""
        size = self.sizes[item]
        margin = size // 4 + 2
        low = begin + np.maximum(0, place - margin)
        high = begin + np.minimum(length, place + np.maximum(width, size) + margin)
        out = np.zeros(len(item), bool)
        span = int((high - low).max()) if len(item) else 1
        block = max(1, (1 << 20) // span)
        for at in range(0, len(item), block):
            cut = slice(at, at + block)
            index = low[cut, None] + np.arange(span)
            column = flat[np.minimum(index, len(flat) - 1)]
            has = bits[row[cut, None], column >> 3] >> (column & 7) & 1
            out[cut] = (has * (index < high[cut, None])).sum(1) >= PARAPHRASE * size[cut]
        return np.flatnonzero(out)

    def _confirmed(self, cut: Cut, text: int, i: int, windows: list[tuple[float, int, int]]) -> dict | None:
        item = self.items[i]
        size = len(item.words)
        if i not in self.masks:
            masks: dict[bytes, int] = {}
            for k, word in enumerate(item.words):
                masks[word] = masks.get(word, 0) | 1 << k
            self.masks[i] = masks
        best, done = None, []
        margin, begin, length = size // 4 + 2, int(cut.begins[text]), int(cut.sizes[text])
        known = self.masks[i].keys()
        # Words that do not occur at all cannot be in the subsequence.
        least = PARAPHRASE * len(known) - (1 - PARAPHRASE) * (size - len(known))
        bounds = [(max(0, place - margin), min(length, place + max(width, size) + margin)) for _, place, width in windows]
        low, high = min(a for a, _ in bounds), max(b for _, b in bounds)
        if len(known & set(cut.words(begin + low, begin + high))) < least:
            return None
        for (cosine, _, _), (low, high) in sorted(zip(windows, bounds, strict=True), reverse=True):
            if any(a <= low and high <= b for a, b in done):
                continue
            done.append((low, high))
            near = cut.words(begin + low, begin + high)
            if len(known & set(near)) < least:
                continue
            if size < 5:
                common = size if contains(near, item.words) else 0
            else:
                common = common_subsequence(self.masks[i], size, near)
            answer = bool(item.answer) and contains(near, item.answer)
            if (common >= COPY * size or (common >= PARAPHRASE * size and answer)) and (best is None or common > best["common"]):
                best = {"item_id": item.item_id, "start": low, "end": high, "common": common, "item_words": size, "cosine": cosine, "answer": answer}
        return best


def mark(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Add ``leaks``: the benchmark texts found in each document, and where (word positions)."""
    docs = docs.drop(*(c for c in docs.columns if c == "leaks"))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    asked = benchmark.select(F.col(f"`{item}`").alias("item"), F.col(f"`{item_text}`").alias("text"))
    seen, n = document_frequency(rows)
    idf = np.log((n + 1.0) / (seen + 1.0)) + 0.05
    # Weights are squared in the sums.
    share = min(1.0, DOCUMENTS_WEIGHT / max(n, 1)) ** 0.5
    directions = latent_directions(
        asked.select("text", F.lit(ASKED_WEIGHT).alias("weight")).unionAll(rows.select("text", F.lit(share).alias("weight"))),
        idf,
    )
    blocks = max(1, -(-asked.count() // BLOCK))
    out = docs.withColumn("leaks", F.array().cast(LEAK))
    for k in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).collect()  # about BLOCK rows
        out = _searched(out, [item_of(r["item"], r["text"]) for r in block if r["item"] is not None], idf, directions, text)
    return out


def _searched(docs: DataFrame, items: list[Item], idf: np.ndarray, directions: np.ndarray, text: str) -> DataFrame:
    shared = Shared(docs.sparkSession, (items, idf, directions.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*shared.value)
        for batch in chunks(batches, text, SEARCH_BYTES):
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            new = search.leaks(texts(batch, text))
            before = columns["leaks"].to_pylist()
            both = [a + sorted(b, key=lambda x: x["item_id"]) for a, b in zip(before, new, strict=True)]
            columns["leaks"] = pa.array(both, ARROW_LEAK)
            yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(run, docs.schema)
