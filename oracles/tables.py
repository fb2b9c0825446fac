"""Common table expressions that compute every layer in SQL, independently of the Spark plans."""

from __future__ import annotations

from areascore.plans.silver import (
    ACTIVITY_COUNTS,
    HOUSING_COUNTS,
    INCOME_AMOUNTS,
    INCOME_RATES,
    POPULATION_COUNTS,
)
from areascore.sources.fixtures import GIVEN_TABLES, VIEWS, needed_views

R = "DECIMAL(20,10)"


def code9(c: str) -> str:
    return f"CASE WHEN trim({c}) <> '' THEN lpad(trim({c}), 9, '0') END"


def num(c: str, p: int = 10, s: int = 2) -> str:
    return (
        f"CASE WHEN upper(trim({c})) IN ('S','NS','ND','NC','N.D.','N/A','') THEN NULL "
        f"ELSE CAST(replace(trim({c}), ',', '.') AS DECIMAL({p},{s})) END"
    )


def div(a: str, b: str) -> str:
    return f"CAST(({a}) / ({b}) AS {R})"


def pct(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN CAST(round({div(a, b)} * 100, 2) AS DECIMAL(14,2)) END"


def rnd(x: str, digits: int = 2) -> str:
    return f"CAST(round({x}, {digits}) AS DECIMAL(20,{digits}))"


def avg(x: str) -> str:
    return div(f"sum({x})", f"nullif(count({x}), 0)")


def plus(*cols: str) -> str:
    return "(" + " + ".join(f"coalesce({c}, 0)" for c in cols) + ")"


def picked(names: dict[str, str], p: int, s: int) -> str:
    return ", ".join(f"{num(raw, p, s)} AS {clean}" for raw, clean in names.items())


def keyed(c: str) -> str:
    return f"{c} IS NOT NULL AND trim({c}) <> ''"


CTES: dict[str, str] = {
    name: sql.format(**{t: t for t in GIVEN_TABLES}).strip() for name, sql in VIEWS.items()
}

CTES["located"] = f"""
SELECT {code9("code_iris")} AS iris_code, trim(coalesce(lib_iris, '')) AS iris_label,
  trim(code_bv) AS bv_code, trim(coalesce(lib_bv, '')) AS bv_label
FROM raw_internal_bv_iris WHERE {keyed("code_iris")}"""

CTES["areas"] = """
SELECT iris_code, iris_label, bv_code, bv_label, left(iris_code, 2) AS dep_code,
  left(iris_code, 5) AS com_code, right(iris_code, 4) = '0000' AS is_commune_entiere,
  '1.0' AS version_modele
FROM (SELECT *, row_number() OVER (PARTITION BY iris_code
        ORDER BY iris_label NULLS LAST, bv_code NULLS LAST, bv_label NULLS LAST) AS rn FROM located)
WHERE rn = 1"""

CTES["income_all"] = f"""
SELECT {code9("iris")} AS iris_code, {picked(INCOME_AMOUNTS, 10, 2)}, {picked(INCOME_RATES, 5, 2)},
  coalesce(upper(trim(disp_med21)) IN ('S','ND') AND upper(trim(disp_tp6021)) IN ('S','ND'), false)
    AS flag_secret_statistique
FROM raw_filosofi_iris WHERE {keyed("iris")}"""

CTES["population_counts"] = f"""
SELECT {code9("iris")} AS iris_code, {picked(POPULATION_COUNTS, 18, 6)}
FROM raw_rp_population_iris WHERE {keyed("iris")}"""

_occupations = plus(
    "nb_agriculteurs", "nb_artisans_commercants", "nb_cadres_prof_intel", "nb_prof_intermediaires",
    "nb_employes", "nb_ouvriers", "nb_retraites", "nb_sans_activite",
)
_young = plus("pop_0_2_ans", "pop_3_5_ans", "pop_6_10_ans", "pop_11_17_ans", "pop_18_24_ans")
CTES["population_all"] = f"""
SELECT *, {pct(_young, "population_totale")} AS part_moins_25_ans_pct,
  {pct(plus("pop_65_79_ans", "pop_80_ans_plus"), "population_totale")} AS part_plus_65_ans_pct,
  {pct("nb_cadres_prof_intel", _occupations)} AS part_cadres_pct
FROM population_counts"""

CTES["activity_counts"] = f"""
SELECT {code9("iris")} AS iris_code, {picked(ACTIVITY_COUNTS, 18, 6)}
FROM raw_rp_activite_iris WHERE {keyed("iris")}"""

CTES["activity_all"] = f"""
SELECT *, {pct("nb_chomeurs_1564", "pop_active_1564")} AS taux_chomage_pct,
  {pct("actifs_occupes_1564", "pop_1564")} AS taux_emploi_pct,
  {pct("pop_active_1564", "pop_1564")} AS taux_activite_pct
FROM activity_counts"""

CTES["housing_counts"] = f"""
SELECT {code9("iris")} AS iris_code, {picked(HOUSING_COUNTS, 18, 6)}
FROM raw_rp_logement_iris WHERE {keyed("iris")}"""

_old = plus("nb_logts_avant_1919", "nb_logts_1919_1945", "nb_logts_1946_1970")
CTES["housing_all"] = f"""
SELECT *, {pct("nb_proprietaires", "nb_residences_principales")} AS part_proprietaires_pct,
  {pct("nb_locataires_hlm", "nb_residences_principales")} AS part_hlm_pct,
  {pct(_old, "nb_residences_principales")} AS part_logements_avant_1971_pct
FROM housing_counts"""

CTES["facility_records"] = f"""
SELECT {code9("geo")} AS iris_code, upper(trim(facility_type)) AS type_equip,
  upper(trim(facility_dom)) AS domaine,
  coalesce(CAST(nullif(trim(obs_value), '') AS INTEGER), 0) AS nb_equipements
FROM raw_bpe_iris WHERE {keyed("geo")}"""

FACILITY_FILTERS = {
    "nb_equip_sante": "domaine = 'A'",
    "nb_equip_enseignement": "domaine = 'B'",
    "nb_equip_transports": "domaine = 'C'",
    "nb_equip_sports_loisirs": "domaine = 'D'",
    "nb_equip_commerces": "domaine = 'E'",
    "nb_equip_services": "domaine = 'F'",
    "nb_equip_tourisme": "domaine = 'G'",
    "nb_medecins_generalistes": "type_equip IN ('A206','A207','A208')",
    "nb_pharmacies": "type_equip = 'A301'",
    "nb_ecoles_primaires": "type_equip LIKE 'B1%'",
    "nb_colleges_lycees": "type_equip LIKE 'B2%'",
    "nb_gares_arrets_tc": "type_equip IN ('C101','C102','C201')",
    "nb_banques_agences": "type_equip = 'E107'",
    "nb_france_services": "type_equip = 'F116'",
}
_filtered = ", ".join(
    f"CAST(sum(nb_equipements) FILTER (WHERE {cond}) AS BIGINT) AS {name}"
    for name, cond in FACILITY_FILTERS.items()
)
CTES["facilities_all"] = f"""
SELECT iris_code, CAST(sum(nb_equipements) AS BIGINT) AS nb_equipements_total, {_filtered}
FROM facility_records GROUP BY iris_code"""

CTES["energy_all"] = f"""
SELECT {code9("district")} AS iris_code, lpad(trim(city), 5, '0') AS com_code,
  trim(city_name) AS commune_label, trim(department) AS dep_code,
  CAST(nullif(trim(nombre), '') AS DECIMAL(14,4)) AS nb_passoires_energetiques_estime,
  CAST(nullif(trim(taux), '') AS DECIMAL(7,4)) AS taux_passoires_energetiques_pct,
  CAST(nullif(trim(total), '') AS DECIMAL(14,4)) AS nb_residences_principales_estime
FROM raw_passoires_energetiques_iris WHERE {keyed("district")}"""

for _name in ("income", "population", "activity", "housing", "facilities", "energy"):
    CTES[_name] = f"""
SELECT * FROM {_name}_all WHERE iris_code IN (SELECT iris_code FROM areas)"""

CTES["zrr"] = f"""
SELECT DISTINCT lpad(trim(codgeo), 5, '0') AS com_code, true AS est_zrr FROM raw_zrr_communes
WHERE {keyed("codgeo")} AND regexp_matches(trim(codgeo), '^(0[1-9]|[1-9][0-9]|2[AB])[0-9]{{3}}$')"""

ENERGY_PART = "greatest(0, 100 - coalesce(taux_passoires_energetiques_pct, 20) * 2.5)"
OLD_PART = "(100 - coalesce(part_logements_avant_1971_pct, 50))"
VACANCY_PART = (
    "greatest(0, 100 - CASE WHEN nb_logements_total > 0 THEN "
    + div("nb_logements_vacants", "nb_logements_total")
    + " * 500 ELSE 50 END)"
)
UNEMPLOYMENT_PART = f"greatest(0, 100 - {div('coalesce(taux_chomage_pct, 10) * 100', '30')})"
INCOME_PART = f"least(100, greatest(0, {div('coalesce(revenu_median_uc, 20000) - 10000', '200')}))"
POVERTY_PART = "greatest(0, 100 - coalesce(taux_pauvrete_60, 15) * 2)"
HEALTH_PART = (
    "CASE WHEN coalesce(nb_medecins_generalistes, 0) >= 3 THEN CAST(100 AS DECIMAL(20,10)) "
    "WHEN coalesce(nb_medecins_generalistes, 0) > 0 THEN "
    + div("CAST(nb_medecins_generalistes AS DECIMAL(18,0)) * 100", "3")
    + " WHEN est_zrr THEN 0 ELSE 30 END"
)
EDUCATION_PART = (
    "least(100, (coalesce(nb_ecoles_primaires, 0) + coalesce(nb_colleges_lycees, 0)) * 50)"
)


def score(*parts: tuple[str, str]) -> str:
    total = " + ".join(f"CAST({c} AS {R}) * {w}" for c, w in parts)
    return f"CAST(round({total}, 2) AS DECIMAL(14,2))"


CTES["pillar_e"] = f"""
SELECT r.iris_code, r.iris_label, r.bv_code, r.dep_code, nb_logements_total, nb_residences_principales,
  nb_logements_vacants, part_proprietaires_pct, part_hlm_pct, part_logements_avant_1971_pct,
  {pct("nb_logements_vacants", "nb_logements_total")} AS taux_vacance_logements_pct,
  nb_passoires_energetiques_estime, taux_passoires_energetiques_pct, nb_residences_principales_estime,
  {score((ENERGY_PART, "0.40"), (OLD_PART, "0.35"), (VACANCY_PART, "0.25"))} AS score_env_0_100
FROM areas r LEFT JOIN housing l ON r.iris_code = l.iris_code
LEFT JOIN energy p ON r.iris_code = p.iris_code"""

CTES["pillar_s"] = f"""
SELECT r.iris_code, r.iris_label, r.bv_code, r.dep_code, population_totale, part_moins_25_ans_pct,
  part_plus_65_ans_pct, part_cadres_pct, nb_cadres_prof_intel, nb_ouvriers, nb_employes,
  revenu_median_uc, revenu_q1_uc, revenu_q3_uc, revenu_d1_uc, revenu_d9_uc, taux_pauvrete_60,
  CAST(NULL AS DECIMAL(5,2)) AS taux_pauvrete_40, part_menages_imposes,
  CAST(NULL AS INTEGER) AS nb_menages_fiscaux, flag_secret_statistique,
  CASE WHEN revenu_d1_uc > 0 THEN {rnd(div("revenu_d9_uc", "revenu_d1_uc"))} END AS ratio_interdecile_d9d1,
  pop_active_1564, nb_chomeurs_1564, actifs_occupes_1564, nb_emplois_aides, taux_chomage_pct,
  taux_emploi_pct, taux_activite_pct,
  {score((UNEMPLOYMENT_PART, "0.35"), (INCOME_PART, "0.35"), (POVERTY_PART, "0.30"))} AS score_social_0_100
FROM areas r LEFT JOIN income f ON r.iris_code = f.iris_code
LEFT JOIN population p ON r.iris_code = p.iris_code
LEFT JOIN activity a ON r.iris_code = a.iris_code"""

CTES["panel"] = """
SELECT r.iris_code, r.iris_label, r.bv_code, r.com_code, r.dep_code, b.* EXCLUDE (iris_code),
  coalesce(z.est_zrr, false) AS est_zrr,
  CAST(percent_rank() OVER (ORDER BY coalesce(nb_equipements_total, 0)) AS DECIMAL(20,10)) AS presence
FROM areas r LEFT JOIN facilities b ON r.iris_code = b.iris_code
LEFT JOIN zrr z ON r.com_code = z.com_code"""

CTES["pillar_g"] = f"""
SELECT iris_code, iris_label, bv_code, com_code, dep_code, nb_equipements_total, nb_equip_sante,
  nb_equip_enseignement, nb_equip_transports, nb_equip_commerces, nb_equip_services,
  nb_medecins_generalistes, nb_pharmacies, nb_ecoles_primaires, nb_colleges_lycees, nb_gares_arrets_tc,
  nb_banques_agences, nb_france_services, {rnd("presence * 100")} AS indice_presence_services, est_zrr,
  {score(("presence * 100", "0.40"), (HEALTH_PART, "0.35"), (EDUCATION_PART, "0.25"))}
    AS score_gouvernance_0_100
FROM panel"""

_known = " + ".join(
    f"CAST({c} IS NOT NULL AS INTEGER)"
    for c in (
        "revenu_median_uc", "taux_pauvrete_60", "taux_chomage_pct", "population_totale",
        "part_logements_avant_1971_pct", "taux_passoires_energetiques_pct", "nb_equipements_total",
        "nb_medecins_generalistes", "taux_vacance_logements_pct", "ratio_interdecile_d9d1",
    )
)
_composite = (
    "coalesce(score_social_0_100, 50) * 0.50 + coalesce(score_env_0_100, 50) * 0.25"
    " + coalesce(score_gouvernance_0_100, 50) * 0.25"
)
CTES["master"] = f"""
SELECT r.* EXCLUDE (version_modele), e.* EXCLUDE (iris_code, iris_label, bv_code, dep_code),
  s.* EXCLUDE (iris_code, iris_label, bv_code, dep_code, nb_cadres_prof_intel, nb_ouvriers, nb_employes,
               revenu_q3_uc, actifs_occupes_1564),
  g.* EXCLUDE (iris_code, iris_label, bv_code, com_code, dep_code),
  CAST(round({_composite}, 2) AS DECIMAL(14,2)) AS score_esg_0_100,
  CAST(({_known}) * 10 AS DECIMAL(5,0)) AS pct_completude, '1.0' AS version_modele
FROM areas r LEFT JOIN pillar_e e ON r.iris_code = e.iris_code
LEFT JOIN pillar_s s ON r.iris_code = s.iris_code
LEFT JOIN pillar_g g ON r.iris_code = g.iris_code"""


def weighted(x: str, w: str) -> str:
    top = f"sum(coalesce({x}, 0) * coalesce({w}, 0))"
    bottom = f"nullif(sum(CASE WHEN {x} IS NOT NULL THEN coalesce({w}, 0) ELSE 0 END), 0)"
    return rnd(div(top, bottom))


def weighted_score(x: str) -> str:
    return rnd(div(f"sum(coalesce({x}, 50) * population_totale)", "sum(population_totale)"))


BASIN_MEANS = {
    "revenu_median_uc_pondere": weighted("revenu_median_uc", "population_totale"),
    "taux_pauvrete_60_pondere": weighted("taux_pauvrete_60", "population_totale"),
    "taux_chomage_pondere": weighted("taux_chomage_pct", "pop_active_1564"),
    "taux_passoires_energetiques_pondere": weighted(
        "taux_passoires_energetiques_pct", "nb_residences_principales"
    ),
}
BASIN_SCORES = {
    "score_social_pondere": weighted_score("score_social_0_100"),
    "score_env_pondere": weighted_score("score_env_0_100"),
    "score_gouvernance_pondere": weighted_score("score_gouvernance_0_100"),
    "score_esg_pondere": weighted_score("score_esg_0_100"),
}
BASIN_AVERAGES = {
    "ratio_interdecile_moy": rnd(avg("ratio_interdecile_d9d1")),
    "part_logts_avant_1971_moy": rnd(avg("part_logements_avant_1971_pct")),
    "indice_services_moy": rnd(avg("indice_presence_services")),
    "completude_moy_pct": rnd(avg("pct_completude"), 1),
}
BASIN_COUNTS = {
    "population_totale_bv": "sum(population_totale)",
    "nb_iris": "count(iris_code)",
    "nb_passoires_energetiques_estime_bv": rnd("sum(coalesce(nb_passoires_energetiques_estime, 0))"),
    "nb_equipements_total_bv": "CAST(sum(nb_equipements_total) AS BIGINT)",
    "nb_equip_sante_bv": "CAST(sum(nb_equip_sante) AS BIGINT)",
    "nb_medecins_bv": "CAST(sum(nb_medecins_generalistes) AS BIGINT)",
    "nb_iris_zrr": "count(*) FILTER (WHERE est_zrr)",
    "nb_iris_incomplets": "count(*) FILTER (WHERE pct_completude < 40)",
}


def by_basin(measures: dict[str, str]) -> str:
    listed = ", ".join(f"{sql} AS {name}" for name, sql in measures.items())
    return (
        f"SELECT bv_code, bv_label, dep_code, {listed} FROM master WHERE population_totale > 0 "
        "GROUP BY bv_code, bv_label, dep_code"
    )


CTES["basin"] = by_basin({**BASIN_COUNTS, **BASIN_MEANS, **BASIN_SCORES, **BASIN_AVERAGES})


def statement(body: str) -> str:
    """A self-contained statement: the needed CTEs in front of ``body``."""
    names = needed_views(body, CTES)
    prefix = ", ".join(f"{name} AS ({CTES[name].strip()})" for name in names)
    return f"WITH {prefix} {body}" if names else body
