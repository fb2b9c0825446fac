"""Quality rules: a threshold table compiled into column expressions, without user functions.

Every measure is an integer of the whole text, every rule compares two scaled measures, so verdicts do not
depend on rounding. The work is one chain of projections: no shuffle, memory bounded by one text.

Defined results: a null or empty text has no words and fails ``base``; rows are judged one by one, so
repeated rows give repeated results and an empty table an empty result; other columns are passed through
(a column of the same name as a measure is replaced).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5

# Frequent function words of the supported languages, in the two usual spellings.
STOP_WORDS = (
    "the of and to in is that it for on was with as be by this are or "
    "der die und das den von zu mit sich des auf ist im nicht ein eine dem "
    "de la le et les en un une du que est pour dans qui par sur au "
    "el los las del y se por con para una su es lo"
).split()


@dataclass(frozen=True)
class Rule:
    """Rejects a text of at least ``min_words`` words where ``times * measure > share * other``."""

    name: str
    times: int
    measure: str
    share: int
    other: str
    min_words: int = 0


# The threshold table. ``base`` rules come first; the rest are this engine's own.
BASE_RULES = (
    Rule("short", 10, "one", 1, "n_words"),
    Rule("repeated", 100, "n_repeat_words", 20, "n_words"),
)
RULES = (
    Rule("symbols", 4, "n_symbols", 1, "n_words", 10),
    Rule("stop_words", 1, "n_words", 25, "n_stop_words", 50),
    Rule("duplicate_lines", 2, "n_dup_lines", 1, "n_lines", 10),
    Rule("long_words", 1, "word_chars", 15, "n_words", 10),
    Rule("short_words", 2, "n_words", 1, "word_chars", 10),
)

SPACE = r"[ \t-\r]+"


def _successors(values: str, join) -> Column:
    """``join`` of each element and the one after it (null after the last)."""
    return F.zip_with(values, F.slice(values, 2, F.size(values)), join)


def with_measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the integer measures of each text. Windows are compared by a 64-bit hash of their words."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    trimmed = F.btrim(whole, F.lit(" \t\n\x0b\x0c\r"))
    known = [w for s in STOP_WORDS for w in (s, s.capitalize())]
    rows = F.col("_words")

    def _window(word: Column, at: Column) -> Column:
        return F.xxhash64(word, *(F.get(rows, at + k) for k in range(1, WINDOW)))

    df = df.withColumns(
        {
            "_words": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE)),
            "_lines": F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^ \t-\r]")),
            "n_symbols": F.length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long"),
        }
    )
    df = df.withColumns(
        {
            "n_words": F.size(rows).cast("long"),
            "word_chars": F.length(F.array_join(rows, "")).cast("long"),
            "n_stop_words": F.size(F.filter(rows, lambda w: w.isin(known))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.slice(F.transform(rows, _window), F.lit(1), F.greatest(F.size(rows) - (WINDOW - 1), F.lit(0))),
        }
    )
    # Windows in order of their hash, the low bits replaced by the position: one array of integers to sort.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_bits", F.length(F.bin(F.size("_windows"))))
    shift = lambda name, x: F.call_function(name, x, F.col("_bits"))
    packed = F.transform("_windows", lambda h, i: shift("shiftleft", shift("shiftright", h)).bitwiseOR(i.cast("long")))
    none = F.array().cast("array<bigint>")
    df = df.withColumn("_ordered", F.when(repeats, F.sort_array(packed)).otherwise(none))
    low = shift("shiftleft", F.lit(1).cast("long")) - 1
    df = df.withColumn("_low", low)
    at = lambda x: x.bitwiseAND(F.col("_low")).cast("int")
    same = lambda a, b: F.get("_windows", at(a)) == F.get("_windows", at(b))
    pairs = _successors("_ordered", lambda a, b: F.when(same(a, b), F.array(at(a), at(b))))
    starts = F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))
    df = df.withColumn("_starts", F.sort_array(starts))
    # A repeated window adds the words up to the next repeated one, the whole window at most.
    gap = lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))
    covered = F.aggregate(_successors("_starts", gap), F.lit(0), lambda total, x: total + x)
    df = df.withColumn("n_repeat_words", covered.cast("long"))
    return df.drop("_words", "_lines", "_windows", "_bits", "_ordered", "_low", "_starts")


def violated(rule: Rule) -> Column:
    measure = lambda name: F.lit(1) if name == "one" else F.col(name)
    test = F.lit(rule.times) * measure(rule.measure) > F.lit(rule.share) * measure(rule.other)
    return test & (F.col("n_words") >= rule.min_words)


def apply_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add measures, ``base_failed``, ``failed_rules`` (names in table order) and ``kept``."""
    names = F.concat_ws(",", *(F.when(violated(r), F.lit(r.name)) for r in BASE_RULES + rules))
    base = violated(BASE_RULES[0]) | violated(BASE_RULES[1])
    measured = with_measures(df, text).withColumns({"base_failed": base, "failed_rules": names})
    # The row number, always 0 or more, keeps a filter on ``kept`` above the projection: pushed below it, the
    # filter would hold a copy of every measure for each place that uses it.
    return measured.withColumn("kept", (F.col("failed_rules") == "") & (F.monotonically_increasing_id() >= 0))
