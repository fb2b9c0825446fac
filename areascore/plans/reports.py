"""Dashboard and notebook queries over the gold and silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areascore.functions.numbers import mean, rounded, rounded_int
from areascore.functions.scores import score_band
from areascore.operators.keys import star
from areascore.plans.gold import interdecile_ratio

PILLAR_SCORES = ("score_env_0_100", "score_social_0_100", "score_gouvernance_0_100")


def _one_digit(name: str, alias: str) -> Column:
    return rounded(F.col(name), 1).alias(alias)


def basin_name() -> Column:
    """Code and label; unknown when either is."""
    return F.concat(F.col("bv_code"), F.lit(" - "), F.col("bv_label")).alias("bassin_de_vie")


def score_by_basin(basins: DataFrame) -> DataFrame:
    return basins.orderBy(F.col("score_esg_pondere").asc_nulls_last(), "bv_code").select(
        basin_name(),
        _one_digit("score_esg_pondere", "score_esg"),
        _one_digit("score_social_pondere", "score_social"),
        _one_digit("score_env_pondere", "score_env"),
        _one_digit("score_gouvernance_pondere", "score_gouvernance"),
        "nb_iris",
        rounded_int(F.col("population_totale_bv")).alias("population"),
    )


def score_distribution(master: DataFrame) -> DataFrame:
    """Areas per score band, lowest band first."""
    bands = master.groupBy(score_band(F.col("score_esg_0_100")).alias("tranche_score")).agg(
        F.count(F.lit(1)).alias("nb_iris"), F.min("score_esg_0_100").alias("_lowest")
    )
    return bands.orderBy(F.col("_lowest").asc_nulls_last()).drop("_lowest")


def most_fragile(master: DataFrame, n: int = 10) -> DataFrame:
    """The areas with the lowest composite score; ties go by code."""
    lowest_first = (F.col("score_esg_0_100").asc_nulls_last(), F.col("iris_code"))
    return master.orderBy(*lowest_first).limit(n).select(
        "iris_code",
        "iris_label",
        F.col("bv_label").alias("bassin_de_vie"),
        _one_digit("score_esg_0_100", "score_esg"),
        _one_digit("score_social_0_100", "score_social"),
        _one_digit("score_env_0_100", "score_env"),
        _one_digit("score_gouvernance_0_100", "score_gouv"),
        rounded_int(F.col("population_totale")).alias("population"),
    )


def completeness_by_basin(basins: DataFrame) -> DataFrame:
    return basins.orderBy(F.col("completude_moy_pct").asc_nulls_last(), "bv_code").select(
        basin_name(), _one_digit("completude_moy_pct", "completude_pct"), "nb_iris", "nb_iris_incomplets"
    )


def pillars_by_basin(basins: DataFrame) -> DataFrame:
    return basins.orderBy("bv_label").select(
        F.col("bv_label").alias("bassin_de_vie"),
        _one_digit("score_social_pondere", "social"),
        _one_digit("score_env_pondere", "environnement"),
        _one_digit("score_gouvernance_pondere", "gouvernance"),
    )


def key_indicators(master: DataFrame) -> DataFrame:
    return master.agg(
        F.count(F.lit(1)).alias("nb_iris"),
        F.countDistinct("bv_code").alias("nb_bassins_vie"),
        rounded(mean(F.col("score_esg_0_100")), 1).alias("score_esg_moyen"),
        rounded(mean(F.col("pct_completude")), 1).alias("completude_moyenne_pct"),
        rounded(mean(F.col("taux_chomage_pct")), 1).alias("taux_chomage_moyen_pct"),
        rounded_int(F.sum("population_totale")).alias("population_totale"),
    )


def unemployment_and_social_score(master: DataFrame) -> DataFrame:
    known = master.where(F.col("taux_chomage_pct").isNotNull())
    return known.orderBy(F.col("taux_chomage_pct").desc(), "iris_code").select(
        "iris_label", "taux_chomage_pct", "score_social_0_100", F.col("bv_label").alias("bassin_de_vie")
    )


def rural_zone_split(master: DataFrame) -> DataFrame:
    return (
        master.groupBy("est_zrr")
        .agg(
            F.count(F.lit(1)).alias("nb_iris"),
            rounded(mean(F.col("score_esg_0_100")), 1).alias("score_esg_moyen"),
        )
        .select(
            F.when(F.col("est_zrr"), "En ZRR").otherwise("Hors ZRR").alias("zone"),
            "nb_iris",
            "score_esg_moyen",
        )
    )


def master_metrics(master: DataFrame) -> DataFrame:
    return master.agg(
        F.count(F.lit(1)).alias("nb_iris"),
        rounded(mean(F.col("pct_completude")), 1).alias("completude_moy"),
        rounded(mean(F.col("score_esg_0_100")), 1).alias("score_esg_moy"),
    )


FEATURES = (
    "revenu_median_uc", "taux_pauvrete_60", "ratio_interdecile_d9d1", "taux_chomage_pct",
    "taux_activite_pct", "population_totale", "part_moins_25_ans_pct", "part_cadres_pct",
    "part_logements_avant_1971_pct", "part_hlm_pct", "nb_equipements_total", "nb_equip_sante",
)


def feature_table(
    income: DataFrame, activity: DataFrame, population: DataFrame, housing: DataFrame, facilities: DataFrame
) -> DataFrame:
    """One row per area with income data and the indicators a model would use."""
    spine = income.withColumn("ratio_interdecile_d9d1", interdecile_ratio())
    return star(
        spine.select("iris_code", "revenu_median_uc", "taux_pauvrete_60", "ratio_interdecile_d9d1"),
        activity.select("iris_code", "taux_chomage_pct", "taux_activite_pct"),
        population.select("iris_code", "population_totale", "part_moins_25_ans_pct", "part_cadres_pct"),
        housing.select("iris_code", "part_logements_avant_1971_pct", "part_hlm_pct"),
        facilities.select("iris_code", "nb_equipements_total", "nb_equip_sante"),
    ).select("iris_code", *FEATURES)
