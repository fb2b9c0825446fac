"""Gold tables: pillar indicators, the area master table and the catchment roll-up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.functions import scores
from areascore.functions.numbers import (
    mean,
    percentage,
    quotient_of_sums,
    ratio,
    rounded,
    weighted_mean,
    weighted_mean_with_default,
    zero_if_null,
)
from areascore.operators.keys import flag_by_commune, star
from areascore.operators.ranking import with_percent_rank
from areascore.settings import MODEL_VERSION

GEOGRAPHY = (
    "iris_code", "iris_label", "bv_code", "bv_label", "dep_code", "com_code", "is_commune_entiere",
)
# Columns each silver table brings into the star.
HOUSING = (
    "nb_logements_total", "nb_residences_principales", "nb_logements_vacants",
    "part_proprietaires_pct", "part_hlm_pct", "part_logements_avant_1971_pct",
)
ENERGY = (
    "nb_passoires_energetiques_estime", "taux_passoires_energetiques_pct",
    "nb_residences_principales_estime",
)
POPULATION = (
    "population_totale", "part_moins_25_ans_pct", "part_plus_65_ans_pct", "part_cadres_pct",
    "nb_cadres_prof_intel", "nb_ouvriers", "nb_employes",
)
INCOME = (
    "revenu_median_uc", "revenu_q1_uc", "revenu_q3_uc", "revenu_d1_uc", "revenu_d9_uc",
    "taux_pauvrete_60", "taux_pauvrete_40", "part_menages_imposes", "nb_menages_fiscaux",
    "flag_secret_statistique",
)
ACTIVITY = (
    "pop_active_1564", "nb_chomeurs_1564", "actifs_occupes_1564", "nb_emplois_aides",
    "taux_chomage_pct", "taux_emploi_pct", "taux_activite_pct",
)
FACILITIES = (
    "nb_equipements_total", "nb_equip_sante", "nb_equip_enseignement", "nb_equip_transports",
    "nb_equip_commerces", "nb_equip_services", "nb_medecins_generalistes", "nb_pharmacies",
    "nb_ecoles_primaires", "nb_colleges_lycees", "nb_gares_arrets_tc", "nb_banques_agences",
    "nb_france_services",
)

# Columns of the published tables.
ENVIRONMENT_OUT = (
    "iris_code", "iris_label", "bv_code", "dep_code", *HOUSING, "taux_vacance_logements_pct", *ENERGY,
    "score_env_0_100",
)
SOCIAL_OUT = (
    "iris_code", "iris_label", "bv_code", "dep_code", *POPULATION, *INCOME, "ratio_interdecile_d9d1",
    *ACTIVITY, "score_social_0_100",
)
GOVERNANCE_OUT = (
    "iris_code", "iris_label", "bv_code", "com_code", "dep_code", *FACILITIES,
    "indice_presence_services", "est_zrr", "score_gouvernance_0_100",
)
# Column order of the published master table.
MASTER_OUT = (
    *GEOGRAPHY,
    "nb_logements_total", "nb_residences_principales", "nb_logements_vacants", "taux_vacance_logements_pct",
    "part_proprietaires_pct", "part_hlm_pct", "part_logements_avant_1971_pct", *ENERGY, "score_env_0_100",
    "population_totale", "part_moins_25_ans_pct", "part_plus_65_ans_pct", "part_cadres_pct",
    "revenu_median_uc", "revenu_q1_uc", "revenu_d1_uc", "revenu_d9_uc", "taux_pauvrete_60",
    "taux_pauvrete_40", "ratio_interdecile_d9d1", "part_menages_imposes", "nb_menages_fiscaux",
    "taux_chomage_pct", "taux_emploi_pct", "taux_activite_pct", "pop_active_1564", "nb_chomeurs_1564",
    "nb_emplois_aides", "flag_secret_statistique", "score_social_0_100",
    *FACILITIES, "indice_presence_services", "est_zrr", "score_gouvernance_0_100",
    "score_esg_0_100", "pct_completude", "version_modele",
)


def _measures(table: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return table.select("iris_code", *columns)


def with_environment(areas: DataFrame) -> DataFrame:
    stock, vacant = F.col("nb_logements_total"), F.col("nb_logements_vacants")
    return areas.withColumns(
        {
            "taux_vacance_logements_pct": percentage(vacant, stock),
            "score_env_0_100": scores.environment_score(
                F.col("taux_passoires_energetiques_pct"),
                F.col("part_logements_avant_1971_pct"),
                vacant,
                stock,
            ),
        }
    )


def interdecile_ratio():
    low, high = F.col("revenu_d1_uc"), F.col("revenu_d9_uc")
    return F.when(low > 0, rounded(ratio(high, low), 2))


def with_social(areas: DataFrame) -> DataFrame:
    return areas.withColumns(
        {
            "ratio_interdecile_d9d1": interdecile_ratio(),
            "score_social_0_100": scores.social_score(
                F.col("taux_chomage_pct"), F.col("revenu_median_uc"), F.col("taux_pauvrete_60")
            ),
        }
    )


def service_panel(areas: DataFrame, facilities: DataFrame, communes: DataFrame) -> DataFrame:
    """Every area with its facility measures and its commune flag."""
    panel = star(areas.select(*GEOGRAPHY), _measures(facilities, FACILITIES))
    return flag_by_commune(panel, communes).withColumn(
        "_presence", zero_if_null(F.col("nb_equipements_total"))
    )


def with_governance(panel: DataFrame) -> DataFrame:
    ranked = with_percent_rank(panel, "_presence", key="iris_code", output="_presence_rank")
    return ranked.withColumns(
        {
            "indice_presence_services": rounded(F.col("_presence_rank") * 100, 2),
            "score_gouvernance_0_100": scores.governance_score(
                F.col("_presence_rank"),
                F.col("nb_medecins_generalistes"),
                F.col("est_zrr"),
                F.col("nb_ecoles_primaires"),
                F.col("nb_colleges_lycees"),
            ),
        }
    ).drop("_presence", "_presence_rank")


def environment(areas: DataFrame, housing: DataFrame, energy: DataFrame) -> DataFrame:
    joined = star(areas.select(*GEOGRAPHY), _measures(housing, HOUSING), _measures(energy, ENERGY))
    return with_environment(joined).select(*ENVIRONMENT_OUT)


def social(
    areas: DataFrame, income: DataFrame, population: DataFrame, activity: DataFrame
) -> DataFrame:
    joined = star(
        areas.select(*GEOGRAPHY),
        _measures(income, INCOME),
        _measures(population, POPULATION),
        _measures(activity, ACTIVITY),
    )
    return with_social(joined).select(*SOCIAL_OUT)


def governance(
    areas: DataFrame,
    facilities: DataFrame,
    communes: DataFrame,
    store: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """The panel is read twice, for the ranks and for their lookup; ``store`` may write it out between."""
    return with_governance(store(service_panel(areas, facilities, communes))).select(*GOVERNANCE_OUT)


def area_master(
    areas: DataFrame,
    housing: DataFrame,
    energy: DataFrame,
    income: DataFrame,
    population: DataFrame,
    activity: DataFrame,
    facilities: DataFrame,
    communes: DataFrame,
    store: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """All indicators of an area in one row.

    The three pillar tables all start from the same areas, so the master table is one star over the silver
    tables instead of a join of three stars: every silver table is shuffled once, the areas once.
    """
    ranked = with_governance(store(service_panel(areas, facilities, communes)))
    joined = star(
        ranked,
        _measures(housing, HOUSING),
        _measures(energy, ENERGY),
        _measures(income, INCOME),
        _measures(population, POPULATION),
        _measures(activity, ACTIVITY),
    )
    return _finish_master(with_social(with_environment(joined)))


def area_master_from_pillars(
    areas: DataFrame, environment: DataFrame, social: DataFrame, governance: DataFrame
) -> DataFrame:
    """The same table from stored pillar tables."""
    joined = star(
        areas.select(*GEOGRAPHY),
        *(t.drop("iris_label", "bv_code", "com_code", "dep_code") for t in (environment, social, governance)),
    )
    return _finish_master(joined)


def _finish_master(joined: DataFrame) -> DataFrame:
    return joined.withColumns(
        {
            "score_esg_0_100": scores.composite_score(
                F.col("score_social_0_100"),
                F.col("score_env_0_100"),
                F.col("score_gouvernance_0_100"),
            ),
            "pct_completude": scores.completeness(*(F.col(c) for c in scores.KEY_INDICATORS)),
            "version_modele": F.lit(MODEL_VERSION),
        }
    ).select(*MASTER_OUT)


def populated(master: DataFrame) -> DataFrame:
    return master.where(F.col("population_totale") > 0)


BASIN_KEYS = ("bv_code", "bv_label", "dep_code")


def basin_means() -> dict:
    """Weighted means of indicators, each over the areas where it is known."""
    people = F.col("population_totale")
    active = F.col("pop_active_1564")
    homes = F.col("nb_residences_principales")
    return {
        "revenu_median_uc_pondere": rounded(weighted_mean(F.col("revenu_median_uc"), people), 2),
        "taux_pauvrete_60_pondere": rounded(weighted_mean(F.col("taux_pauvrete_60"), people), 2),
        "taux_chomage_pondere": rounded(weighted_mean(F.col("taux_chomage_pct"), active), 2),
        "taux_passoires_energetiques_pondere": rounded(
            weighted_mean(F.col("taux_passoires_energetiques_pct"), homes), 2
        ),
    }


def basin_scores() -> dict:
    """Population-weighted scores; an unknown score counts as the neutral one."""
    return {
        output: rounded(
            weighted_mean_with_default(F.col(score), scores.NEUTRAL, F.col("population_totale")), 2
        )
        for output, score in {
            "score_social_pondere": "score_social_0_100",
            "score_env_pondere": "score_env_0_100",
            "score_gouvernance_pondere": "score_gouvernance_0_100",
            "score_esg_pondere": "score_esg_0_100",
        }.items()
    }


def basin_averages() -> dict:
    return {
        "ratio_interdecile_moy": rounded(mean(F.col("ratio_interdecile_d9d1")), 2),
        "part_logts_avant_1971_moy": rounded(mean(F.col("part_logements_avant_1971_pct")), 2),
        "indice_services_moy": rounded(mean(F.col("indice_presence_services")), 2),
        "completude_moy_pct": rounded(mean(F.col("pct_completude")), 1),
    }


def basin_counts() -> dict:
    return {
        "population_totale_bv": F.sum("population_totale"),
        "nb_iris": F.count("iris_code"),
        "nb_passoires_energetiques_estime_bv": rounded(
            F.sum(zero_if_null(F.col("nb_passoires_energetiques_estime"))), 2
        ),
        "nb_equipements_total_bv": F.sum("nb_equipements_total"),
        "nb_equip_sante_bv": F.sum("nb_equip_sante"),
        "nb_medecins_bv": F.sum("nb_medecins_generalistes"),
        "nb_iris_zrr": F.count_if(F.col("est_zrr")),
        "nb_iris_incomplets": F.count_if(F.col("pct_completude") < 40),
    }


# Column order of the published table.
BASIN_OUT = (
    *BASIN_KEYS, "population_totale_bv", "nb_iris", "revenu_median_uc_pondere",
    "taux_pauvrete_60_pondere", "taux_chomage_pondere", "ratio_interdecile_moy",
    "taux_passoires_energetiques_pondere", "nb_passoires_energetiques_estime_bv",
    "part_logts_avant_1971_moy", "nb_equipements_total_bv", "nb_equip_sante_bv", "nb_medecins_bv",
    "indice_services_moy", "nb_iris_zrr", "score_social_pondere", "score_env_pondere",
    "score_gouvernance_pondere", "score_esg_pondere", "completude_moy_pct", "nb_iris_incomplets",
    "version_modele",
)


def roll_up(master: DataFrame, *groups: dict) -> DataFrame:
    """Aggregate populated areas to catchments. All measures combine before the shuffle."""
    measures = {name: column for group in groups for name, column in group.items()}
    return populated(master).groupBy(*BASIN_KEYS).agg(*(c.alias(n) for n, c in measures.items()))


def basin_final(master: DataFrame) -> DataFrame:
    rolled = roll_up(master, basin_counts(), basin_means(), basin_scores(), basin_averages())
    return rolled.withColumn("version_modele", F.lit(MODEL_VERSION)).select(*BASIN_OUT)
