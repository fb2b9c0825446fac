"""Text to number, and exact ratios.

Every division is cast to ``RATIO`` before it is used further. Spark, like other engines, gives a
decimal quotient a scale that depends on the operand types; fixing it keeps the later two-digit
rounding independent of how the operands happened to be typed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "secret" or "not available" in the published tables.
SECRET_TOKENS = ("S", "NS", "ND", "NC", "N.D.", "N/A", "")
# The two of them that mark a cell hidden for statistical secrecy.
SECRECY_MARKS = ("S", "ND")
# Texts the optional null-token scan turns into NULL, compared as they are ...
NULL_TOKENS = ("s", "nd", "ND", "S", "nc", "NC", "", " ", "n.d.", "N/A")
# ... and the usual defaults of dataframe CSV readers, which apply on top of them.
READER_NULL_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

RATIO = "decimal(20,10)"
PERCENT = "decimal(14,2)"
# Operand types that leave a quotient of sums at least ten decimal places within 38 digits.
SUM_NUMERATOR = "decimal(30,8)"
SUM_DENOMINATOR = "decimal(28,6)"


def _secret(name: str) -> str:
    tokens = ", ".join(f"'{token}'" for token in SECRET_TOKENS)
    return f"upper(trim(`{name}`)) IN ({tokens})"


def nullify_secret(name: str) -> Column:
    """The text of a column as it is, or NULL where it is a secrecy token."""
    return F.expr(f"CASE WHEN {_secret(name)} THEN NULL ELSE `{name}` END")


def nullify_tokens(text: Column) -> Column:
    return F.when(text.isin(*NULL_TOKENS, *READER_NULL_TOKENS), F.lit(None)).otherwise(text)


def decimal_text(name: str, precision: int = 10, scale: int = 2, strict: bool = True) -> Column:
    """Decimal from a text column with secrecy tokens and a decimal comma.

    Any other unreadable text raises; with ``strict=False`` it becomes NULL, for quarantine queries.
    Written as one SQL expression because census tables have dozens of such columns.
    """
    cast = "cast" if strict else "try_cast"
    number = f"{cast}(replace(trim(`{name}`), ',', '.') AS decimal({precision},{scale}))"
    return F.expr(f"CASE WHEN NOT {_secret(name)} THEN {number} END")


def blank_decimal(text: Column, precision: int = 14, scale: int = 4) -> Column:
    """Decimal where only blank means missing: no secrecy tokens, no decimal comma."""
    return F.nullif(F.trim(text), F.lit("")).cast(f"decimal({precision},{scale})")


def int_or_zero(text: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(text.cast("string")), F.lit("")).cast("int"), F.lit(0))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def ratio(part: Column, whole: Column) -> Column:
    return (part / whole).cast(RATIO)


def percentage(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals; NULL unless ``whole`` is positive."""
    return F.when(whole > 0, F.round(ratio(part, whole) * 100, 2).cast(PERCENT))


def quotient_of_sums(numerator: Column, denominator: Column) -> Column:
    """Exact quotient of two aggregates; NULL when the denominator is zero or NULL."""
    bounded = denominator.cast(SUM_DENOMINATOR)
    return ratio(numerator.cast(SUM_NUMERATOR), F.nullif(bounded, F.lit(0)))


def mean(value: Column) -> Column:
    """Exact decimal mean (``avg`` would keep only four extra digits); skips NULLs."""
    return quotient_of_sums(F.sum(value), F.count(value))


def rounded(value: Column, digits: int) -> Column:
    return F.round(value, digits).cast(f"decimal(20,{digits})")


def rounded_int(value: Column) -> Column:
    """Half-up integer. A bare integer cast would truncate."""
    return F.round(value, 0).cast("bigint")


def weighted_mean(value: Column, weight: Column) -> Column:
    """Weighted mean over rows where ``value`` is known."""
    return quotient_of_sums(
        F.sum(zero_if_null(value) * zero_if_null(weight)),
        F.sum(F.when(value.isNotNull(), zero_if_null(weight)).otherwise(F.lit(0))),
    )


def weighted_mean_with_default(value: Column, default: int, weight: Column) -> Column:
    """Weighted mean in which an unknown value counts as ``default``."""
    return quotient_of_sums(F.sum(F.coalesce(value, F.lit(default)) * weight), F.sum(weight))
