"""ASCII folding and header normalisation.

Folding means: compatibility-decompose, drop what is not ASCII, strip. Decomposition works code point
by code point, and dropping combining marks makes their order irrelevant, so a per-character table
gives the same result as decomposing the whole string. The table comes from the Unicode database of
the Python runtime; the work itself stays in JVM expressions.
"""

from __future__ import annotations

import itertools
import re
import sys
import unicodedata
from functools import lru_cache
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's str.strip removes from ASCII text.
ASCII_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
EMPTY_METADATA = "n-a"


def fold_to_ascii(text: str) -> str:
    """Driver-side folding of one short name."""
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[dict[str, str], dict[str, str]]:
    """Characters that fold to exactly one ASCII character, and those that fold to several."""
    single, several = {}, {}
    for code in chain(range(0x80, 0xD800), range(0xE000, sys.maxunicode + 1)):
        char = chr(code)
        if not unicodedata.decomposition(char):
            continue
        folded = fold_to_ascii(char)
        if len(folded) == 1:
            single[char] = folded
        elif folded:
            several[char] = folded
    return single, several


def _literal_map(pairs: dict[str, str]) -> Column:
    """A constant map, handed over as two joined texts rather than one literal per entry."""
    mark = "\x01"
    keys, values = (F.split(F.lit(mark.join(side)), mark) for side in (pairs, pairs.values()))
    return F.map_from_arrays(keys, values)


def _ascii_only(text: Column) -> Column:
    single, several = _fold_tables()
    one_to_one = F.translate(text, "".join(single), "".join(single.values()))
    # Ligatures, fractions and the like are rare: the per-character lookup runs only where one occurs,
    # and the search for them only over the few characters that are still not ASCII.
    left_over = F.regexp_replace(one_to_one, r"[\x00-\x7F]+", "")
    lookup = _literal_map(several)
    expanded = F.array_join(
        F.transform(F.split(one_to_one, ""), lambda ch: F.coalesce(F.try_element_at(lookup, ch), ch)), ""
    )
    full = F.when(left_over.rlike("[" + "".join(several) + "]"), expanded).otherwise(one_to_one)
    return F.regexp_replace(full, r"[^\x00-\x7F]+", "")


def ascii_fold(text: Column) -> Column:
    """ASCII form of a text column; what folds to nothing becomes ``n-a``."""
    stripped = F.trim(_ascii_only(text), F.lit(ASCII_BLANKS))
    return F.coalesce(F.nullif(stripped, F.lit("")), F.lit(EMPTY_METADATA))


def header_name(raw: str) -> str:
    """Lower-case ASCII words joined by underscores."""
    words = re.findall(r"[a-z0-9]+", fold_to_ascii(raw).lower())
    return "_".join(words) or "col"


def header_names(raw: list[str]) -> list[str]:
    """Normalised names, all different: a name that is taken gets the next free number from 2 on."""
    plain = [header_name(column) for column in raw]
    taken: set[str] = set()
    for at, name in enumerate(plain):
        # Numbers also stay clear of names that occur as such.
        numbered = (f"{name}_{k}" for k in itertools.count(2))
        plain[at] = name if name not in taken else next(n for n in numbered if n not in taken and n not in plain)
        taken.add(plain[at])
    return plain


def header_name_column(raw: Column) -> Column:
    """Column form of ``header_name``, for headers that are themselves data."""
    words = F.regexp_replace(F.lower(_ascii_only(raw)), "[^a-z0-9]+", "_")
    return F.coalesce(F.nullif(F.btrim(words, F.lit("_")), F.lit("")), F.lit("col"))
