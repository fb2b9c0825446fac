"""Secret scans: a keyword automaton finds where a secret can start, anchored patterns test only there.

Kinds with a fixed keyword (assignments, access keys, tokens with an embedded checksum) are tried at the
automaton's hits only, from left to right and without overlap per kind. Long hexadecimal runs have no
keyword; they are found by one pass of their own pattern. Tokens that embed a checksum count only if it is
right. Offsets are code points, ends exclusive. Defined results: a null or empty text has no spans; rows are
independent, so repeated rows repeat; other columns are passed through.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areascore.llm.batches import chunks, texts

# Patterns and least lengths of the base kinds, in order, then of the checked ones.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
KINDS = ("assign", "access", "hex", "checked")
BASE_KINDS = KINDS[:3]
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "checked": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
}
DIGITS = string.digits + string.ascii_uppercase + string.ascii_lowercase

SPAN = T.StructType(
    [T.StructField("start", T.LongType()), T.StructField("kind_order", T.IntegerType()), T.StructField("end", T.LongType())]
)


def checksum(body: str) -> str:
    """CRC-32 of the body in six base-62 digits."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = DIGITS[digit] + out
    return out


def _accepts(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[2]) >= 6
    if kind == "access":
        return match.end() - match.start() >= 20
    return checksum(match[1]) == match[2]


class Scanner:
    PATTERNS = {"assign": ASSIGN, "access": ACCESS, "checked": CHECKED}

    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for word in words:
                self.automaton.add_word(word, (kind, len(word)))
        self.automaton.make_automaton()

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, order of the kind, end), ascending."""
        # One letter of Unicode grows when lower-cased; offsets must not move.
        lower = text.lower() if text.isascii() else text.replace("İ", "i").lower()
        hits: dict[str, list[int]] = {}
        for last, (kind, size) in self.automaton.iter(lower):
            hits.setdefault(kind, []).append(last + 1 - size)
        found = [(m.start(), KINDS.index("hex"), m.end()) for m in HEX.finditer(text)]
        for kind, starts in hits.items():
            free = 0
            for start in sorted(set(starts)):
                if start < free or not (match := self.PATTERNS[kind].match(text, start)):
                    continue
                free = match.end()
                if _accepts(kind, match):
                    found.append((start, KINDS.index(kind), free))
        return sorted(found)


def scan(df: DataFrame, text: str = "text", redact: bool = False, mask: str = "[SECRET]") -> DataFrame:
    """Add ``secret_spans``; with ``redact`` the spans in ``text`` are replaced by ``mask`` (overlaps by one)."""
    added = T.StructField("secret_spans", T.ArrayType(SPAN))
    df = df.drop(*(c for c in df.columns if c == added.name))
    schema = T.StructType([*df.schema.fields, added])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind_order", pa.int32()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in chunks(batches, text):
            plain = texts(batch, text)
            spans = [scanner.spans(t) for t in plain]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            if redact and any(spans):
                nulls = batch.column(text).is_null().to_pylist()
                masked = [None if n else masked_text(t, s, mask) for t, s, n in zip(plain, spans, nulls, strict=True)]
                columns[text] = pa.array(masked, batch.schema.field(text).type)
            rows = [[{"start": a, "kind_order": k, "end": b} for a, k, b in s] for s in spans]
            columns[added.name] = pa.array(rows, kind)
            yield pa.RecordBatch.from_pydict(columns)

    return df.mapInArrow(run, schema)


def masked_text(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    out, done = [], 0
    for start, _, end in spans:
        if start >= done:
            out += [text[done:start], mask]
        done = max(done, end)
    return "".join([*out, text[done:]])


def span_text(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    name = lambda s: F.get(F.array(*map(F.lit, KINDS)), s["kind_order"])
    one = lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
