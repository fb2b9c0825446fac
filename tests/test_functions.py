"""Column functions on rows that sit at an edge."""

from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from areascore.functions import codes, numbers, scores
from areascore.functions.text import ascii_fold, fold_to_ascii, header_name, header_name_column, header_names
from areascore.plans import silver


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_area_codes(text_frame):
    df = text_frame(["c"], [("75056101",), (" 010010000",), ("  ",), (None,), ("1234567890",), ("2A0040101",)])
    assert column(df, codes.area_code(F.col("c"))) == [
        "075056101", "010010000", None, None, "123456789", "2A0040101",
    ]
    assert column(df, codes.department_of(F.col("c"))) == ["07", "01", None, None, "12", "2A"]
    assert column(df, codes.commune_of(F.col("c")))[0] == "07505"


def test_commune_pattern_looks_at_the_code_as_published(text_frame):
    df = text_frame(["c"], [("01001",), ("1001",), ("2A004",), ("2C004",), ("00123",), (" 99999 ",), ("010011",)])
    assert column(df, codes.is_commune_code(F.col("c"))) == [True, False, True, False, False, True, False]
    assert column(df, codes.commune_code(F.col("c")))[1] == "01001"


def test_numbers_from_text(text_frame):
    texts = ["s", " Nd ", "N.D.", "", None, "12,345", "12.344", " 7 ", "-2,5", "n/a"]
    df = text_frame(["c"], [(t,) for t in texts])
    assert column(df, numbers.decimal_text("c")) == [
        None, None, None, None, None, Decimal("12.35"), Decimal("12.34"), Decimal("7.00"), Decimal("-2.50"), None,
    ]
    assert column(df, numbers.nullify_secret("c"))[5:] == ["12,345", "12.344", " 7 ", "-2,5", None]


@pytest.mark.parametrize("bad", ["abc", "12 345", "123456789012"])
def test_unreadable_numbers_raise_or_are_set_aside(text_frame, bad):
    df = text_frame(["c"], [(bad,)])
    with pytest.raises(PySparkException):
        df.select(numbers.decimal_text("c")).collect()
    assert column(df, numbers.decimal_text("c", strict=False)) == [None]


def test_blank_numbers(text_frame):
    df = text_frame(["c"], [("",), ("  ",), (None,), ("3",)])
    assert column(df, numbers.int_or_zero(F.col("c"))) == [0, 0, 0, 3]
    assert column(df, numbers.blank_decimal(F.col("c"))) == [None, None, None, Decimal("3.0000")]
    with pytest.raises(PySparkException):
        text_frame(["c"], [("s",)]).select(numbers.blank_decimal(F.col("c"))).collect()


def test_rounding_to_integer_is_half_up(spark):
    df = spark.sql("SELECT * FROM VALUES (2.5), (3.49), (-2.5) AS t(x)")
    assert column(df, numbers.rounded_int(F.col("x"))) == [3, 3, -3]


def test_null_token_scan_is_exact(text_frame):
    df = text_frame(["c"], [("s",), (" s",), ("NaN",), ("nd",), ("Nd",), ("",), ("0",)])
    assert column(df, numbers.nullify_tokens(F.col("c"))) == [None, " s", None, None, "Nd", None, "0"]


def test_percentage_guards_its_denominator(spark):
    df = spark.sql(
        "SELECT CAST(a AS DECIMAL(18,6)) a, CAST(b AS DECIMAL(18,6)) b FROM VALUES "
        "(1, 3), (1, 0), (NULL, 4), (1, NULL), (0.12345, 1) AS t(a, b)"
    )
    assert column(df, numbers.percentage(F.col("a"), F.col("b"))) == [
        Decimal("33.33"), None, None, None, Decimal("12.35"),
    ]


def test_weighted_mean_ignores_unknown_values(spark):
    df = spark.sql(
        "SELECT CAST(x AS DECIMAL(10,2)) x, CAST(w AS DECIMAL(18,6)) w FROM VALUES "
        "(10, 1), (NULL, 100), (20, 3) AS t(x, w)"
    )
    x, w = F.col("x"), F.col("w")
    row = df.agg(numbers.weighted_mean(x, w), numbers.weighted_mean_with_default(x, 50, w)).first()
    assert row[0] == Decimal("17.5") and round(row[1], 4) == Decimal("48.7500")
    none = df.where("x IS NULL").agg(numbers.weighted_mean(x, w), numbers.mean(x)).first()
    assert none[0] is None and none[1] is None


UNKNOWN = "CAST(NULL AS DECIMAL(14,2))"


def test_scores_of_unknown_areas_use_the_defaults(spark):
    df = spark.sql(f"SELECT {UNKNOWN} AS x")
    x = F.col("x")
    assert column(df, scores.environment_score(x, x, x, x)) == [Decimal("50.00")]
    assert column(df, scores.social_score(x, x, x)) == [Decimal("61.83")]
    assert column(df, scores.composite_score(x, x, x)) == [Decimal("50.00")]


def test_known_stock_with_unknown_vacancy_scores_zero(spark):
    df = spark.sql(f"SELECT CAST(100 AS DECIMAL(18,6)) AS stock, {UNKNOWN} AS vacant")
    assert column(df, scores.vacancy_component(F.col("vacant"), F.col("stock"))) == [0]


def test_components_are_held_within_their_range(spark):
    df = spark.sql("SELECT CAST(90 AS DECIMAL(14,2)) AS rate, CAST(90000 AS DECIMAL(10,2)) AS income")
    assert column(df, scores.unemployment_component(F.col("rate"))) == [0]
    assert column(df, scores.income_component(F.col("income"))) == [100]
    assert column(df, scores.income_component(F.col("rate"))) == [0]


def test_health_access_steps(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (3L, true), (9L, false), (1L, true), (0L, true), (NULL, true), (NULL, false), "
        "(NULL, NULL) AS t(n, zone)"
    )
    got = column(df, scores.health_access(F.col("n"), F.col("zone")))
    assert [round(float(v), 2) for v in got] == [100, 100, 33.33, 0, 0, 30, 30]


def test_education_access_is_capped(spark):
    df = spark.sql("SELECT * FROM VALUES (1L, NULL), (2L, 3L), (NULL, NULL) AS t(a, b)")
    assert column(df, scores.education_access(F.col("a"), F.col("b"))) == [50, 100, 0]


def test_score_bands_include_their_lower_bound(spark):
    df = spark.sql("SELECT CAST(x AS DECIMAL(9,2)) AS x FROM VALUES (29.99), (30), (54.99), (65), (NULL) AS t(x)")
    assert column(df, scores.score_band(F.col("x"))) == [
        "0-30 Fragile", "30-45 Faible", "45-55 Moyen", "65+ Favorable", "65+ Favorable",
    ]


def test_completeness_counts_known_indicators(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS INT) AS b, 2 AS c")
    assert column(df, scores.completeness(F.col("a"), F.col("b"), F.col("c"))) == [67]


def test_secrecy_flag_needs_both_marks(text_frame):
    df = text_frame(["disp_med21", "disp_tp6021"], [("s", " ND"), ("s", "12"), ("ns", "ns"), (None, "s")])
    assert column(df, silver.secrecy_flag()) == [True, False, False, False]


def test_population_shares_keep_unknown_managers_unknown(text_frame):
    counts = {raw: "10" for raw in silver.POPULATION_COUNTS}
    rows = [
        {**counts, "iris": "1"},
        {**counts, "iris": "2", "c22_pop15p_stat_gsec13_23": "s"},
        {**counts, "iris": "3", "p22_pop": "0", "p22_pop0002": "nd"},
    ]
    names = ["iris", *silver.POPULATION_COUNTS]
    table = silver.clean_population(text_frame(names, [tuple(r[n] for n in names) for r in rows]))
    got = {r["iris_code"]: r for r in table.collect()}
    assert got["000000001"]["part_cadres_pct"] == Decimal("12.50")
    assert got["000000002"]["part_cadres_pct"] is None
    assert got["000000003"]["part_moins_25_ans_pct"] is None


def test_header_names():
    raw = ["Code commune", "Libellé commune", "Value", "value", "  ", "%", "Été  2021!"]
    assert header_names(raw) == ["code_commune", "libelle_commune", "value", "value_2", "col", "col_2", "ete_2021"]


def test_header_names_as_a_column(text_frame):
    raw = ["Code commune", "Libellé", "", None, "  -- ", "œuvre ﬁn"]
    df = text_frame(["c"], [(r,) for r in raw])
    assert column(df, header_name_column(F.col("c"))) == [header_name(r or "") for r in raw]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=200, max_size=200))
def test_folding_equals_decomposing_the_whole_string(spark, texts):
    fixed = ["Île d'été", "ﬁn ½ Ⅳ № …", "ẛ̣ é́", "𝐀𝒃", "한글", "", "  ", "\t x \n", "ß"]
    texts = [t.replace("\x00", "") for t in texts] + fixed
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string").select("i", ascii_fold(F.col("t")).alias("f"))
    got = {r["i"]: r["f"] for r in df.collect()}
    assert got == {i: fold_to_ascii(t).strip() or "n-a" for i, t in rows}


def test_header_names_never_clash():
    assert header_names(["a", "a", "a 2"]) == ["a", "a_3", "a_2"]
