"""Geographic codes and labels. Codes are strings throughout: leading zeros matter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AREA_WIDTH = 9
COMMUNE_WIDTH = 5

# Fixed value: a commune code is a department (01-99, 2A, 2B) followed by three digits.
COMMUNE_PATTERN = r"^(0[1-9]|[1-9][0-9]|2[AB])[0-9]{3}$"
# The pattern admits 99 numbered departments and two lettered ones, 1000 communes each.
COMMUNE_CODE_SPACE = 101 * 1000


def has_text(code: Column) -> Column:
    """True for a key that is neither NULL nor blank."""
    return code.isNotNull() & (F.trim(code) != "")


def area_code(code: Column) -> Column:
    """Nine-character area code, left-padded with zeros; blank becomes NULL."""
    text = F.trim(code.cast("string"))
    return F.when(text != "", F.lpad(text, AREA_WIDTH, "0"))


def department_of(code: Column) -> Column:
    return F.left(area_code(code), F.lit(2))


def commune_of(code: Column) -> Column:
    return F.left(area_code(code), F.lit(COMMUNE_WIDTH))


def commune_code(code: Column) -> Column:
    return F.lpad(F.trim(code.cast("string")), COMMUNE_WIDTH, "0")


def is_commune_code(code: Column) -> Column:
    """Tested on the code as published, before padding: a code that lost its zero is not valid."""
    return F.trim(code).rlike(COMMUNE_PATTERN)


def is_whole_commune(area: Column) -> Column:
    return F.right(area, F.lit(4)) == "0000"


def label(text: Column) -> Column:
    return F.trim(F.coalesce(text, F.lit("")))


def upper_code(text: Column) -> Column:
    return F.upper(F.trim(text.cast("string")))
