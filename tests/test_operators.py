"""Keys, ranks, profiles: results against the plain definition, on skewed rows as well."""

from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from areascore.operators import keys, order, profile, ranking, sketches
from areascore.plans import silver

PANELS = {
    "mostly zero": "SELECT id, CASE WHEN id % 3 = 0 THEN 0 ELSE id % 40 END AS v FROM range(3000)",
    "all different": "SELECT id, id * 7 AS v FROM range(2000)",
    "several buckets": "SELECT id, (id % 50) * 700000 AS v FROM range(2000)",
    "negative and large": "SELECT id, CASE WHEN id % 2 = 0 THEN -id ELSE id * 3000000000 END AS v FROM range(500)",
    "one value": "SELECT id, 5L AS v FROM range(10)",
    "one row": "SELECT 1L AS id, 9L AS v",
}


@pytest.mark.parametrize("name", PANELS)
@pytest.mark.parametrize("hot_parts", [1, 16, 4096])
def test_percent_rank_equals_the_window_function(spark, monkeypatch, name, hot_parts):
    """With few hot parts most values take the cold way, with many the broadcast one."""
    monkeypatch.setattr(ranking, "HOT_PARTS", hot_parts)
    panel = spark.sql(PANELS[name])
    wanted = panel.withColumn("w", F.percent_rank().over(Window.orderBy("v")).cast("decimal(20,10)"))
    got = ranking.with_percent_rank(panel, "v", key="id", output="r")
    both = got.join(wanted.select("id", "w"), "id")
    assert got.columns == ["id", "v", "r"]
    assert both.count() == panel.count()
    assert both.where("r IS NULL OR abs(r - w) > 0.0000000001").count() == 0


def test_percent_rank_has_no_window_over_all_values(spark):
    panel = spark.range(1000).withColumn("v", F.col("id") % 7)
    plan = plan_of(ranking.with_percent_rank(panel, "v", "id", "r"))
    lines = plan.splitlines()
    for line, below in zip(lines, lines[1:]):
        if "SinglePartition" in line:  # the top level
            assert "_up#" in below and "functions=[sum(_n#" in below
    windows = [line for line in lines if " Window [" in line]
    assert sum("_up#" not in line for line in windows) <= 2 < len(windows)


@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(18,6)", "decimal(30,6)"])
def test_rows_below_against_a_sort(spark, kind):
    import numpy as np

    rnd = np.random.default_rng(3)
    many = np.concatenate([rnd.integers(-(10**12), 10**12, 400), rnd.integers(-5, 5, 400), [0, 2**21, 2**21 - 1, -(2**21), -1, 10**11]])
    rows = [(int(v), "ab"[int(v) % 2]) for v in many]
    frame = spark.createDataFrame(rows, "v long, g string").select((F.col("v") / 1).cast("decimal(24,6)").alias("d"), "v", "g")
    value = F.col("v") if kind == "bigint" else (F.col("d") / 64).cast(kind)
    counts = frame.select(value.alias("v"), "g").groupBy("v", "g").agg(F.count(F.lit(1)).alias("n"))
    keyed = counts.withColumn("k", order.ordered_key(F.col("v"), counts.schema["v"].dataType))
    got = order.rows_below(keyed, "v", "n", by=["g"], key="k").collect()
    assert len(got) == counts.count()
    for group in "ab":
        mine = sorted((r["v"], r["n"], r["_below"], r["_total"]) for r in got if r["g"] == group)
        before = 0
        for _, n, below, total in mine:
            assert (below, total) == (before, sum(m[1] for m in mine))
            before += n


def test_order_of_doubles_beyond_the_parts(spark):
    rows = spark.createDataFrame([(float(v),) for v in ("1e300", "-1e300", "1e-9", "2e-9", "3e-9", "inf", "-inf")], "a double")
    assert profile.medians(rows, ["a"]).first()["median"] == 2e-9
    assert profile.medians(rows.where("a > 1e-12"), ["a"]).first()["median"] == 3e-9


# --- sketches and the perimeter filter -----------------------------------------------------------


def test_distinct_sketches_roll_up_within_their_bound(spark):
    rows = spark.range(200_000).select((F.col("id") % 40).alias("area"), (F.col("id") % 4).alias("basin"), F.pmod(F.xxhash64("id"), F.lit(70_000)).alias("v"))
    stored = sketches.distinct_sketches(rows, ["basin", "area"], "v")
    exact = {r["basin"]: r["n"] for r in rows.groupBy("basin").agg(F.count_distinct("v").alias("n")).collect()}
    merged = sketches.estimates(sketches.merged_sketches(stored, ["basin"])).collect()
    assert len(merged) == 4
    for r in merged:
        assert abs(r["distinct"] - exact[r["basin"]]) <= 3 * sketches.relative_error() * exact[r["basin"]]
    # The union of all says what one sketch of all rows says.
    whole = sketches.estimates(sketches.merged_sketches(stored, [])).first()["distinct"]
    assert abs(whole - rows.select("v").distinct().count()) <= 3 * sketches.relative_error() * whole
    nothing = spark.createDataFrame([(1, None)], "area int, v string")
    assert sketches.estimates(sketches.distinct_sketches(nothing, ["area"], "v")).first()["distinct"] == 0


def test_perimeter_filter_drops_rows_at_the_scan(spark, tmp_path):
    from areascore.plans import silver

    spark.range(300).select(F.format_string("%09d", F.col("id") * 7).alias("iris_code")).write.parquet(str(tmp_path / "areas"))
    spark.range(30_000).select(
        F.format_string("%09d", F.col("id") % 21_000).alias("geo"), F.lit("A206").alias("facility_type"), F.lit("A").alias("facility_dom"), F.lit("1").alias("obs_value")
    ).write.parquet(str(tmp_path / "facts"))
    areas, facts = (spark.read.parquet(str(tmp_path / n)) for n in ("areas", "facts"))
    built = silver.build("silver_bpe", facts, areas, prefilter=True)
    plan = plan_of(built)
    fact_side = plan[plan.index("partial_sum"):]
    assert fact_side.index("BroadcastHashJoin") < fact_side.index("FileScan")
    assert built.exceptAll(silver.build("silver_bpe", facts, areas)).isEmpty() and built.count() == 300
    records = silver.facility_records(facts)
    inside = records.join(areas, "iris_code", "left_semi").count()
    kept = keys.maybe_known(records, keys.key_bits(areas, "iris_code"), "iris_code")
    assert kept.columns == records.columns and inside <= kept.count() <= inside + 30_000 // 1000
    assert keys.maybe_known(records, keys.key_bits(areas.where("false"), "iris_code"), "iris_code").isEmpty()


def test_first_per_key_takes_the_first_in_order_for_a_crowded_key(spark):
    df = spark.sql(
        "SELECT CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 100) END AS k, 10000 - id AS v FROM range(9000)"
    )
    got = keys.first_per_key(df, "k", [F.col("v")])
    wanted = df.groupBy("k").agg(F.min("v").alias("v"))
    assert got.exceptAll(wanted).count() == 0 and got.count() == wanted.count()
    # The limit runs before the shuffle, so the crowded key does not travel.
    assert plan_of(got).count("WindowGroupLimit") == 2


def test_referential_survivor_does_not_depend_on_row_order(text_frame):
    rows = [("1", "b", "9", "x"), (" 1", "a", "9", "x"), ("1", "a", "2", "x"), ("1", "a", None, "x"), (" ", "", "", "")]
    columns = ["code_iris", "lib_iris", "code_bv", "lib_bv"]
    for order in (rows, rows[::-1]):
        got = silver.referential(text_frame(columns, order)).collect()
        assert [(r["iris_code"], r["iris_label"], r["bv_code"]) for r in got] == [("000000001", "a", "2")]


def test_facilities_of_a_crowded_area(spark):
    raw = spark.sql(
        "SELECT CASE WHEN id % 3 = 0 THEN '010010000' ELSE lpad(cast(id AS string), 9, '0') END AS geo, "
        "CASE WHEN id % 2 = 0 THEN 'a206 ' ELSE 'E107' END AS facility_type, "
        "CASE WHEN id % 2 = 0 THEN 'A' ELSE 'E' END AS facility_dom, '2' AS obs_value FROM range(6000)"
    )
    hot = silver.clean_facilities(raw).where("iris_code = '010010000'").first()
    assert hot["nb_equipements_total"] == 4000
    assert hot["nb_medecins_generalistes"] == 2000 and hot["nb_banques_agences"] == 2000
    assert hot["nb_pharmacies"] is None and hot["nb_equip_tourisme"] is None


def test_facilities_without_doctors_have_an_unknown_number(text_frame):
    raw = text_frame(["geo", "facility_type", "facility_dom", "obs_value"], [("1", "B101", "b", ""), ("1", "B201", "B", "3")])
    row = silver.clean_facilities(raw).first()
    assert (row["nb_equipements_total"], row["nb_ecoles_primaires"], row["nb_colleges_lycees"]) == (3, 0, 3)
    assert row["nb_medecins_generalistes"] is None and row["nb_equip_enseignement"] == 3


def test_perimeter_and_star(spark):
    areas = spark.sql("SELECT * FROM VALUES ('a'), ('b') AS t(iris_code)")
    table = spark.sql("SELECT * FROM VALUES ('a', 1), ('a', 2), ('c', 3) AS t(iris_code, x)")
    assert sorted(r["x"] for r in keys.within_perimeter(table, areas).collect()) == [1, 2]
    joined = keys.star(areas, table).collect()
    # Only the areas are unique by construction: a repeated row elsewhere shows up as a repeated area.
    assert sorted((r["iris_code"], r["x"] or 0) for r in joined) == [("a", 1), ("a", 2), ("b", 0)]
    assert [r["iris_code"] for r in keys.outside_of(areas, table).collect()] == ["b"]


def test_commune_flag(text_frame):
    raw = text_frame(["codgeo", "status"], [("01001", "ZRR"), ("01001", "ZRR"), ("1002", "ZRR"), (" ", ""), ("2A004", "out")])
    listed = keys.flagged_communes(raw)
    assert sorted(r["com_code"] for r in listed.collect()) == ["01001", "2A004"]
    only = keys.flagged_communes(raw, condition=F.col("status") == "ZRR")
    assert [r["com_code"] for r in only.collect()] == ["01001"]
    areas = text_frame(["iris_code", "com_code"], [("010010000", "01001"), ("010020000", "01002")])
    flags = {r["iris_code"]: r["est_zrr"] for r in keys.flag_by_commune(areas, listed).collect()}
    assert flags == {"010010000": True, "010020000": False}


@pytest.fixture(scope="module")
def scored(spark):
    return spark.sql(
        "SELECT CAST(id % 101 AS DECIMAL(14,2)) AS a, CAST(7 AS DECIMAL(14,2)) AS b, "
        "CASE WHEN id % 4 > 0 THEN CAST((id * id) % 97 + 0.25 AS DECIMAL(14,2)) END AS c FROM range(1000)"
    )


def test_histogram_and_medians_against_numpy(scored):
    import numpy as np

    rows = [r.asDict() for r in scored.collect()]
    got = profile.histogram(scored, ["a", "b", "c"]).collect()
    medians = {r["pillar"]: r["median"] for r in profile.medians(scored, ["a", "b", "c"]).collect()}
    for name in ("a", "b", "c"):
        values = [float(r[name]) for r in rows if r[name] is not None]
        counts, edges = np.histogram(values, bins=30)
        mine = sorted((r["bin"], r["n"], r["lower_edge"]) for r in got if r["pillar"] == name)
        assert [n for _, n, _ in mine] == counts.tolist()
        assert np.allclose([e for _, _, e in mine], edges[:-1])
        assert medians[name] == float(np.median(values))


def test_profile_and_correlation_against_pandas(scored):
    frame = scored.toPandas().astype(float)
    got = {r["feature"]: r for r in profile.profile(scored, ["a", "c"]).collect()}
    described = frame.describe()
    for name in ("a", "c"):
        assert got[name]["count"] == described[name]["count"]
        for key in ("mean", "std", "min", "max"):
            assert abs(got[name][key] - described[name][key]) < 1e-5
    row = profile.correlation(scored, "a", "c").first()
    both = frame[["a", "c"]].dropna()
    assert row["pairs"] == len(both) and abs(row["correlation"] - both["a"].corr(both["c"])) < 1e-5


def test_sums_stay_exact_for_large_tables(spark):
    """Ten billion people with six-digit incomes still leave ten decimal places to the quotient."""
    from areascore.functions.numbers import weighted_mean

    df = spark.range(1000).select(
        F.lit(Decimal("123456.78")).alias("x"), F.lit(Decimal("10000000.123456")).cast("decimal(18,6)").alias("w")
    )
    assert df.agg(weighted_mean(F.col("x"), F.col("w"))).first()[0] == Decimal("123456.78")


def test_medians_keep_all_decimals(spark):
    values = [k / 1000 + 0.0055 for k in range(5)]
    rows = spark.createDataFrame([(v,) for v in values], "a double")
    assert profile.medians(rows, ["a"]).first()["median"] == values[2]
