"""Language identification with interpolated Kneser-Ney character models.

Counts come from a bounded sample of labelled documents (``per_language`` documents of each language in
expectation, chosen by a hash of the id; whole texts), so the model's size does not follow the corpus. Per
order, the n-grams of all languages stand in one sorted array of 64-bit hashes with a row of log
probabilities, one per language, lower orders already mixed in; contexts stand in such an array with their
back-off weights. A text gets the language of the lowest cross-entropy per character; ties go to the first
name. Languages are rejected above a cross-entropy that all but 1 in 200 of other sampled documents of that
language stay under.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected; without any
labelled text every document is ``und``; case and everything but letters is ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areascore.llm.batches import Shared, chunks, texts

ORDER = 4
DISCOUNT = 0.75
#: Sampled documents per language, in expectation; one in five of them calibrates, the rest train.
PER_LANGUAGE = 1500
UNKNOWN = "und"
EDGE, BLANK = 1, 32
#: A text of this many letters is fully trusted; scores of shorter ones are flattened.
TRUSTED = 40.0

# Odd multipliers of the hash.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _letters_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def codes_of(many: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row and the text each belongs to.

    Letters are lower-cased, runs of anything else become one blank; each text is led by ORDER - 1 edges and
    a blank, and followed by a blank.
    """
    lower = [t.lower() for t in many]
    lead = "\1" * (ORDER - 1) + " "
    joined = "".join([lead + t.replace("\1", " ") + " " for t in lower])
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.fromiter((len(t) for t in lower), np.int64, len(lower)) + len(lead) + 1
    owner = np.repeat(np.arange(len(lower), dtype=np.int32), sizes)
    codes = np.where(letters[raw] | (raw == EDGE), raw, BLANK)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != BLANK) | (codes[:-1] != BLANK)
    return codes[keep], owner[keep]


def hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` codes that end at each position; the first ones have fewer and are not used."""
    out = np.zeros(len(codes), np.uint64)
    for back in range(order):
        out[back:] += codes[: len(codes) - back].astype(np.uint64) * MULTIPLIERS[back]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


class HashArray:
    """Sorted hashes with a value row each; an index of leading bits shortens the search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], np.ascontiguousarray(values[order], np.float32)
        bits = max(1, int(np.ceil(np.log2(max(2, len(keys)))))) + 1
        self.shift = np.uint64(64 - bits)
        leads = (self.keys >> self.shift).astype(np.int64)
        self.first = np.searchsorted(leads, np.arange((1 << bits) + 1)).astype(np.int32)
        self.deepest = int(np.max(np.diff(self.first))) if len(keys) else 0

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(wanted), -1, np.int32)
        at = self.first[(wanted >> self.shift).astype(np.int64)]
        row = np.minimum(at, len(self.keys) - 1)
        hit = self.keys[row] == wanted
        open_ = np.flatnonzero(~hit)
        for step in range(1, self.deepest):
            if not len(open_):
                break
            more = np.minimum(at[open_] + step, len(self.keys) - 1)
            good = self.keys[more] == wanted[open_]
            row[open_[good]], hit[open_[good]] = more[good], True
            open_ = open_[~good]
        return np.where(hit, row, -1)


@dataclass
class Model:
    languages: list[str]
    grams: list[HashArray]
    backoff: list[HashArray]
    unseen: float
    limits: np.ndarray | None = None

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Natural log of each character's probability given the ones before it, per language."""
        width = len(self.languages)
        out = np.zeros((len(codes), width), np.float32)
        left = np.arange(len(codes))
        keys = [hashes(codes, k) for k in range(1, ORDER + 1)]
        for order in range(ORDER, 0, -1):
            rows = self.grams[order - 1].find(keys[order - 1][left])
            hit = rows >= 0
            out[left[hit]] += self.grams[order - 1].values[rows[hit]]
            left = left[~hit]
            if order == 1:
                out[left] += self.unseen
            elif len(left):
                # The context ends one position earlier.
                rows = self.backoff[order - 2].find(keys[order - 2][left - 1])
                known = rows >= 0
                out[left[known]] += self.backoff[order - 2].values[rows[known]]
        return out

    def cross_entropies(self, many: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text: nats per character in each language, and scored characters."""
        codes, owner = codes_of(many, letters)
        scored = codes != EDGE
        # What precedes the first characters is made of edges, never of another text.
        logs = self.log_probabilities(codes)
        logs[~scored] = 0
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        n = np.add.reduceat(scored.astype(np.int64), starts)
        return -np.add.reduceat(logs.astype(np.float64), starts, axis=0) / n[:, None], n


def kneser_ney(counts: pd.DataFrame) -> Model:
    """A model from rows (lang, c0..c3, n): how often the four codes follow one another."""
    languages = sorted(counts["lang"].unique())
    names = [f"c{k}" for k in range(ORDER)]
    alphabet = len(counts[names[-1]].unique()) + 1
    unseen = float(np.log(1.0 / alphabet))
    grams, backoff = [], []
    lower: dict[str, pd.Series] = {lang: None for lang in languages}
    for order in range(1, ORDER + 1):
        cols = names[ORDER - order :]
        tables, weights = {}, {}
        for lang in languages:
            own = counts[counts["lang"] == lang]
            if order == ORDER:
                number = own.groupby(cols)["n"].sum()
            else:
                # How many different characters precede the n-gram.
                number = own[names[ORDER - order - 1 :]].drop_duplicates().groupby(cols).size()
            frame = number.rename("n").reset_index()
            context = cols[:-1]
            if context:
                sums = frame.groupby(context)["n"].agg(["sum", "count"]).reset_index()
                frame = frame.merge(sums, on=context)
                weights[lang] = pd.Series(
                    np.log(DISCOUNT * sums["count"] / sums["sum"]).to_numpy(),
                    index=pd.MultiIndex.from_frame(sums[context]),
                )
                under = lower[lang].reindex(pd.MultiIndex.from_frame(frame[cols[1:]])).to_numpy()
                rest = DISCOUNT * frame["count"] / frame["sum"] * np.exp(under)
            else:
                frame["sum"], rest = frame["n"].sum(), DISCOUNT * len(frame) / frame["n"].sum() / alphabet
            value = np.log((frame["n"] - DISCOUNT).clip(lower=0) / frame["sum"] + rest)
            tables[lang] = pd.Series(value.to_numpy(), index=pd.MultiIndex.from_frame(frame[cols]))
            if order == 1:
                # The weight of characters that a language has not seen.
                weights[lang] = float(np.log(DISCOUNT * len(frame) / frame["n"].sum() / alphabet))
        table = pd.DataFrame(tables, columns=languages)
        for lang in languages:
            gaps = table[lang].isna()
            if not gaps.any():
                continue
            if order == 1:
                table.loc[gaps, lang] = weights[lang]
                continue
            missing = table.index[gaps].to_frame(index=False)
            weight = weights[lang].reindex(pd.MultiIndex.from_frame(missing[cols[:-1]])).fillna(0.0).to_numpy()
            under = full[lang].reindex(pd.MultiIndex.from_frame(missing[cols[1:]])).to_numpy()  # noqa: F821
            table.loc[gaps, lang] = weight + under
        full = table
        lower = {lang: table[lang] for lang in languages}
        index = table.index.to_frame(index=False).to_numpy(np.uint64)
        grams.append(HashArray(_row_hashes(index), table.to_numpy()))
        if order > 1:
            both = pd.DataFrame({k: weights[k] for k in languages}, columns=languages).fillna(0.0)
            backoff.append(HashArray(_row_hashes(both.index.to_frame(index=False).to_numpy(np.uint64)), both.to_numpy()))
    return Model(languages, grams, backoff, unseen)


def _row_hashes(rows: np.ndarray) -> np.ndarray:
    """Hash of each row of codes, the last code being the newest."""
    order = rows.shape[1]
    if not len(rows):
        return np.zeros(0, np.uint64)
    return hashes(rows.reshape(-1), order)[order - 1 :: order]


def _sampled(df: DataFrame, key: str, lang: str, per_language: int) -> DataFrame:
    share = df.groupBy(lang).agg(F.count(F.lit(1)).alias("_n"))
    share = {r[lang]: min(1.0, per_language / r["_n"]) for r in share.collect()}  # one row per language
    if not share:
        return df.limit(0)
    pick = F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    limit = F.element_at(F.create_map(*(F.lit(x) for item in share.items() for x in item)), F.col(lang))
    return df.where(pick < limit)


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit on a bounded sample of labelled rows; None where there is no text to learn from."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    picked = _sampled(rows, "key", "lang", per_language)
    part = F.pmod(F.xxhash64("key", F.lit(7)), F.lit(5))
    names = [f"c{k}" for k in range(ORDER)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters_table()
        for batch in chunks(batches):
            langs = np.array(batch.column("lang").to_pylist(), object)
            plain = np.array(texts(batch), object)
            for name in set(langs):
                codes, _ = codes_of(list(plain[langs == name]), letters)
                grams = np.stack([codes[k : len(codes) - ORDER + 1 + k] for k in range(ORDER)], 1)
                grams = grams[grams[:, -1] != EDGE]
                if not len(grams):
                    continue
                grams, n = np.unique(grams, axis=0, return_counts=True)
                columns = [pa.array([name] * len(n)), *(pa.array(grams[:, k].astype(np.int32)) for k in range(ORDER))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n)], names=["lang", *names, "n"])

    schema = "lang string, " + ", ".join(f"{n} int" for n in names) + ", n long"
    counted = picked.where(part != 1).select("lang", "text").mapInArrow(count, schema)
    counts = counted.groupBy("lang", *names).agg(F.sum("n").alias("n")).toPandas()
    if counts.empty:
        return None
    model = kneser_ney(counts)
    shared = Shared(labelled.sparkSession, model)

    def calibrate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, known = _letters_table(), {n: k for k, n in enumerate(shared.value.languages)}
        for batch in chunks(batches):
            values, _ = shared.value.cross_entropies(texts(batch), letters)
            langs = batch.column("lang").to_pylist()
            found = [(n, float(v[known[n]])) for n, v in zip(langs, values, strict=True) if n in known]
            yield pa.RecordBatch.from_pylist(
                [{"lang": n, "value": v} for n, v in found], pa.schema([("lang", pa.string()), ("value", pa.float64())])
            )

    held = picked.where(part == 1).select("lang", "text").mapInArrow(calibrate, "lang string, value double")
    limits = {r["lang"]: r["v"] for r in held.groupBy("lang").agg(F.percentile("value", F.lit(0.995)).alias("v")).collect()}
    model.limits = np.array([limits.get(n, np.inf) for n in model.languages])
    return model


def predict(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1), ``cross_entropy`` (nats per character) and ``rejected``."""
    added = [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("cross_entropy", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
    df = df.drop(*(f.name for f in added if f.name != text))
    schema = T.StructType(df.schema.fields + added)
    shared = Shared(df.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, own = _letters_table(), shared.value
        for batch in chunks(batches, text, 1 << 20):
            plain = texts(batch, text)
            size = len(plain)
            spoken = np.fromiter((any(map(str.isalpha, t)) for t in plain), bool, size)
            best, score, value = np.zeros(size, int), np.zeros(size), np.full(size, np.nan)
            rejected = np.ones(size, bool)
            if own and spoken.any():
                rows, n = own.cross_entropies(plain, letters)
                best, value = rows.argmin(1), rows.min(1)
                gain = np.exp(-(rows - value[:, None]) * np.minimum(n, TRUSTED)[:, None])
                score, rejected = 1 / gain.sum(1), value > own.limits[best]
            names = [own.languages[k] if own and s else UNKNOWN for k, s in zip(best, spoken, strict=True)]
            value = np.where(spoken, value, np.nan)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(names, pa.string()),
                    pa.array(np.where(spoken, score, 0.0)),
                    pa.array(value, mask=np.isnan(value)),
                    pa.array(rejected | ~spoken),
                ],
                names=schema.names,
            )

    return df.mapInArrow(run, schema)


def remainder(key: Column, by: int) -> Column:
    """CRC-32 of the key as text, modulo ``by``."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(by))
