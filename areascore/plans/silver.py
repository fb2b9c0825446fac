"""Silver tables: raw text tables become typed, one row per area.

Each ``clean_*`` function types and derives columns without looking at the referential; the function of
the same name without the prefix also keeps only areas inside the perimeter. Gold plans start from the
referential with left joins, so they may take either form.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areascore.functions.codes import (
    area_code,
    commune_code,
    is_whole_commune,
    label,
    upper_code,
)
from areascore.functions.numbers import (
    SECRECY_MARKS,
    blank_decimal,
    decimal_text,
    int_or_zero,
    percentage,
    zero_if_null,
)
from areascore.operators.keys import first_per_key, key_bits, maybe_known, valid_keys, within_perimeter
from areascore.settings import MODEL_VERSION, VINTAGES

# Published column -> clean column, with the decimal type of the clean one.
INCOME_AMOUNTS = {
    "disp_med21": "revenu_median_uc",
    "disp_q121": "revenu_q1_uc",
    "disp_q321": "revenu_q3_uc",
    "disp_d121": "revenu_d1_uc",
    "disp_d921": "revenu_d9_uc",
}
INCOME_RATES = {"disp_tp6021": "taux_pauvrete_60", "disp_pimpot21": "part_menages_imposes"}
POPULATION_COUNTS = {
    "p22_pop": "population_totale",
    "p22_pop0002": "pop_0_2_ans",
    "p22_pop0305": "pop_3_5_ans",
    "p22_pop0610": "pop_6_10_ans",
    "p22_pop1117": "pop_11_17_ans",
    "p22_pop1824": "pop_18_24_ans",
    "p22_pop2539": "pop_25_39_ans",
    "p22_pop4054": "pop_40_54_ans",
    "p22_pop5564": "pop_55_64_ans",
    "p22_pop6579": "pop_65_79_ans",
    "p22_pop80p": "pop_80_ans_plus",
    "c22_pop15p_stat_gsec11_21": "nb_agriculteurs",
    "c22_pop15p_stat_gsec12_22": "nb_artisans_commercants",
    "c22_pop15p_stat_gsec13_23": "nb_cadres_prof_intel",
    "c22_pop15p_stat_gsec14_24": "nb_prof_intermediaires",
    "c22_pop15p_stat_gsec15_25": "nb_employes",
    "c22_pop15p_stat_gsec16_26": "nb_ouvriers",
    "c22_pop15p_stat_gsec32": "nb_retraites",
    "c22_pop15p_stat_gsec40": "nb_sans_activite",
}
UNDER_25 = ("pop_0_2_ans", "pop_3_5_ans", "pop_6_10_ans", "pop_11_17_ans", "pop_18_24_ans")
OVER_65 = ("pop_65_79_ans", "pop_80_ans_plus")
OCCUPATIONS = (
    "nb_agriculteurs",
    "nb_artisans_commercants",
    "nb_cadres_prof_intel",
    "nb_prof_intermediaires",
    "nb_employes",
    "nb_ouvriers",
    "nb_retraites",
    "nb_sans_activite",
)
ACTIVITY_COUNTS = {
    "p22_pop1564": "pop_1564",
    "p22_act1564": "pop_active_1564",
    "p22_actocc1564": "actifs_occupes_1564",
    "p22_chom1564": "nb_chomeurs_1564",
    "p22_inact1564": "nb_inactifs_1564",
    "p22_sal15p_empaid": "nb_emplois_aides",
    "p22_nsal15p": "nb_non_salaries",
}
HOUSING_COUNTS = {
    "p22_log": "nb_logements_total",
    "p22_rp": "nb_residences_principales",
    "p22_rsecocc": "nb_residences_secondaires",
    "p22_logvac": "nb_logements_vacants",
    "p22_rp_prop": "nb_proprietaires",
    "p22_rp_loc": "nb_locataires",
    "p22_rp_lochlmv": "nb_locataires_hlm",
    "p22_rp_grat": "nb_logts_gratuits",
    "p22_rp_ach1919": "nb_logts_avant_1919",
    "p22_rp_ach1945": "nb_logts_1919_1945",
    "p22_rp_ach1970": "nb_logts_1946_1970",
    "p22_rp_ach1990": "nb_logts_1971_1990",
    "p22_rp_ach2005": "nb_logts_1991_2005",
    "p22_rp_ach2019": "nb_logts_2006_2019",
    "p22_rp_1p": "nb_logts_1_piece",
    "p22_rp_2p": "nb_logts_2_pieces",
    "p22_rp_3p": "nb_logts_3_pieces",
    "p22_rp_4p": "nb_logts_4_pieces",
    "p22_rp_5pp": "nb_logts_5_pieces_plus",
}
BEFORE_1971 = ("nb_logts_avant_1919", "nb_logts_1919_1945", "nb_logts_1946_1970")

# Facility domains, and the facility types behind the key measures.
FACILITY_DOMAINS = {
    "nb_equip_sante": "A",
    "nb_equip_enseignement": "B",
    "nb_equip_transports": "C",
    "nb_equip_sports_loisirs": "D",
    "nb_equip_commerces": "E",
    "nb_equip_services": "F",
    "nb_equip_tourisme": "G",
}
FACILITY_TYPES = {
    "nb_medecins_generalistes": ("A206", "A207", "A208"),
    "nb_pharmacies": ("A301",),
    "nb_gares_arrets_tc": ("C101", "C102", "C201"),
    "nb_banques_agences": ("E107",),
    "nb_france_services": ("F116",),
}
FACILITY_TYPE_PREFIXES = {"nb_ecoles_primaires": "B1", "nb_colleges_lycees": "B2"}


def typed_counts(names: dict[str, str], precision: int = 18, scale: int = 6) -> list[Column]:
    return [decimal_text(raw, precision, scale).alias(clean) for raw, clean in names.items()]


def null_as_zero_sum(names: tuple[str, ...]) -> Column:
    total = zero_if_null(F.col(names[0]))
    for name in names[1:]:
        total = total + zero_if_null(F.col(name))
    return total


def with_vintage(df: DataFrame, table: str) -> DataFrame:
    return df.withColumn("millesime", F.lit(VINTAGES[table]))


# --- referential ---------------------------------------------------------------------------------


def located_areas(raw: DataFrame) -> DataFrame:
    """Cleaned catchment map before de-duplication."""
    return valid_keys(raw, "code_iris").select(
        area_code(F.col("code_iris")).alias("iris_code"),
        label(F.col("lib_iris")).alias("iris_label"),
        F.trim("code_bv").alias("bv_code"),
        label(F.col("lib_bv")).alias("bv_label"),
    )


def referential(raw: DataFrame) -> DataFrame:
    """One row per area; of several, the first by label, catchment code and catchment label."""
    order = [F.col(c).asc_nulls_last() for c in ("iris_label", "bv_code", "bv_label")]
    return with_geography(first_per_key(located_areas(raw), "iris_code", order)).withColumn(
        "version_modele", F.lit(MODEL_VERSION)
    )


def with_geography(areas: DataFrame) -> DataFrame:
    code = F.col("iris_code")
    return areas.withColumns(
        {
            "dep_code": F.left(code, F.lit(2)),
            "com_code": F.left(code, F.lit(5)),
            "is_commune_entiere": is_whole_commune(code),
        }
    )


# --- income --------------------------------------------------------------------------------------


def secrecy_flag() -> Column:
    """Both the median and the poverty rate are hidden; an unknown text is not a hidden one."""
    hidden = [upper_code(F.col(c)).isin(*SECRECY_MARKS) for c in ("disp_med21", "disp_tp6021")]
    return F.when(hidden[0] & hidden[1], F.lit(True)).otherwise(F.lit(False))


def clean_income(raw: DataFrame) -> DataFrame:
    cleaned = valid_keys(raw, "iris").select(
        area_code(F.col("iris")).alias("iris_code"),
        *typed_counts(INCOME_AMOUNTS, 10, 2),
        *typed_counts(INCOME_RATES, 5, 2),
        # Not published at this grain; kept so that the table layout is complete.
        F.lit(None).cast("decimal(5,2)").alias("taux_pauvrete_40"),
        F.lit(None).cast("decimal(5,2)").alias("taux_pauvrete_50"),
        F.lit(None).cast("int").alias("nb_menages_fiscaux"),
        secrecy_flag().alias("flag_secret_statistique"),
    )
    return with_vintage(cleaned, "silver_filosofi")


# --- census --------------------------------------------------------------------------------------


def clean_population(raw: DataFrame) -> DataFrame:
    counts = valid_keys(raw, "iris").select(
        area_code(F.col("iris")).alias("iris_code"), *typed_counts(POPULATION_COUNTS)
    )
    return with_vintage(with_population_shares(counts), "silver_rp_population")


def with_population_shares(counts: DataFrame) -> DataFrame:
    everyone = F.col("population_totale")
    return counts.withColumns(
        {
            "part_moins_25_ans_pct": percentage(null_as_zero_sum(UNDER_25), everyone),
            "part_plus_65_ans_pct": percentage(null_as_zero_sum(OVER_65), everyone),
            # An unknown number of managers stays unknown, while unknown other groups count as zero.
            "part_cadres_pct": percentage(F.col("nb_cadres_prof_intel"), null_as_zero_sum(OCCUPATIONS)),
        }
    )


def clean_activity(raw: DataFrame) -> DataFrame:
    counts = valid_keys(raw, "iris").select(
        area_code(F.col("iris")).alias("iris_code"), *typed_counts(ACTIVITY_COUNTS)
    )
    return with_vintage(with_labour_rates(counts), "silver_rp_activite")


def with_labour_rates(counts: DataFrame) -> DataFrame:
    active, adults = F.col("pop_active_1564"), F.col("pop_1564")
    return counts.withColumns(
        {
            "taux_chomage_pct": percentage(F.col("nb_chomeurs_1564"), active),
            "taux_emploi_pct": percentage(F.col("actifs_occupes_1564"), adults),
            "taux_activite_pct": percentage(active, adults),
        }
    )


def clean_housing(raw: DataFrame) -> DataFrame:
    counts = valid_keys(raw, "iris").select(
        area_code(F.col("iris")).alias("iris_code"), *typed_counts(HOUSING_COUNTS)
    )
    return with_vintage(with_housing_rates(counts), "silver_rp_logement")


def with_housing_rates(counts: DataFrame) -> DataFrame:
    homes = F.col("nb_residences_principales")
    return counts.withColumns(
        {
            "part_proprietaires_pct": percentage(F.col("nb_proprietaires"), homes),
            "part_hlm_pct": percentage(F.col("nb_locataires_hlm"), homes),
            "part_logements_avant_1971_pct": percentage(null_as_zero_sum(BEFORE_1971), homes),
        }
    )


# --- facilities ----------------------------------------------------------------------------------


def facility_records(raw: DataFrame) -> DataFrame:
    return valid_keys(raw, "geo").select(
        area_code(F.col("geo")).alias("iris_code"),
        upper_code(F.col("facility_type")).alias("type_equip"),
        upper_code(F.col("facility_dom")).alias("domaine"),
        int_or_zero(F.col("obs_value")).alias("nb_equipements"),
    )


def _position(tests: Iterable[Column]) -> Column:
    """Number of the first test that holds, counted from zero; NULL when none does."""
    return F.coalesce(*(F.when(test, F.lit(number)) for number, test in enumerate(tests)))


def _family_tests() -> dict[str, Column]:
    """Facility families; no type belongs to two of them."""
    kind = F.col("type_equip")
    tests = {name: kind.isin(*codes) for name, codes in FACILITY_TYPES.items()}
    return tests | {name: kind.startswith(start) for name, start in FACILITY_TYPE_PREFIXES.items()}


def with_measure_numbers(records: DataFrame) -> DataFrame:
    """Number the domain and the family of a record.

    The texts are compared once per record, so that each of the sums compares a small number.
    """
    domains = (F.col("domaine") == code for code in FACILITY_DOMAINS.values())
    return records.select(
        "iris_code",
        "nb_equipements",
        _position(domains).alias("domain_no"),
        _position(_family_tests().values()).alias("family_no"),
    )


def facility_measures() -> dict[str, Column]:
    """Filtered sums per measure over numbered records; NULL when no record of an area matches."""
    count = F.col("nb_equipements")
    families = (*FACILITY_TYPES, *FACILITY_TYPE_PREFIXES)
    numbered = [("domain_no", FACILITY_DOMAINS), ("family_no", families)]
    return {
        name: F.sum(F.when(F.col(column) == number, count))
        for column, names in numbered
        for number, name in enumerate(names)
    }


def clean_facilities(raw: DataFrame, perimeter: DataFrame | None = None) -> DataFrame:
    """One row per area. The sums are combined before the shuffle, so a crowded area is no hot spot.

    ``perimeter``, a bit map of area codes, drops records of other areas before they are summed.
    """
    measures = [column.alias(name) for name, column in facility_measures().items()]
    found = facility_records(raw)
    if perimeter is not None:
        found = maybe_known(found, perimeter)
    records = with_measure_numbers(found)
    totals = records.groupBy("iris_code").agg(
        F.sum("nb_equipements").alias("nb_equipements_total"), *measures
    )
    return with_vintage(totals, "silver_bpe")


# --- energy --------------------------------------------------------------------------------------


def clean_energy(raw: DataFrame) -> DataFrame:
    cleaned = valid_keys(raw, "district").select(
        area_code(F.col("district")).alias("iris_code"),
        commune_code(F.col("city")).alias("com_code"),
        F.trim("city_name").alias("commune_label"),
        F.trim("department").alias("dep_code"),
        blank_decimal(F.col("nombre"), 14, 4).alias("nb_passoires_energetiques_estime"),
        blank_decimal(F.col("taux"), 7, 4).alias("taux_passoires_energetiques_pct"),
        blank_decimal(F.col("total"), 14, 4).alias("nb_residences_principales_estime"),
    )
    return with_vintage(cleaned, "silver_passoires_energetiques")


# Table name -> (raw table, cleaning plan).
CLEANERS = {
    "silver_filosofi": ("raw_filosofi_iris", clean_income),
    "silver_rp_population": ("raw_rp_population_iris", clean_population),
    "silver_rp_activite": ("raw_rp_activite_iris", clean_activity),
    "silver_rp_logement": ("raw_rp_logement_iris", clean_housing),
    "silver_bpe": ("raw_bpe_iris", clean_facilities),
    "silver_passoires_energetiques": ("raw_passoires_energetiques_iris", clean_energy),
}


def build(table: str, raw: DataFrame, areas: DataFrame, prefilter: bool = False) -> DataFrame:
    """A silver table other than the referential, limited to the perimeter.

    For facilities the semi join comes after the aggregation: the grouped rows are already partitioned by
    area, and so is the referential, so the join needs no further shuffle and never sees a hot key. With
    ``prefilter``, for stored areas, a bit map of their codes drops most records from elsewhere at the scan.
    """
    if prefilter and table == "silver_bpe":
        cleaned = clean_facilities(raw, key_bits(areas))
    else:
        cleaned = CLEANERS[table][1](raw)
    return within_perimeter(cleaned, areas)
