"""One SQL statement per query, for the tables the driver registers."""

from __future__ import annotations

from areascore.catalog import FRESHNESS_DATE
from areascore.plans.silver import (
    ACTIVITY_COUNTS,
    HOUSING_COUNTS,
    INCOME_AMOUNTS,
    INCOME_RATES,
    POPULATION_COUNTS,
)
from areascore.quality.rules import MASTER_SUITE, REFERENCES, TABLE_RULES, Rule
from areascore.settings import SOURCES
from oracles import tables as t

SQL: dict[str, str] = {}


def doubles(*names: str) -> list[str]:
    return [f"CAST({n} AS DOUBLE) AS {n}" for n in names]


def longs(*names: str) -> list[str]:
    return [f"CAST({n} AS BIGINT) AS {n}" for n in names]


def select(table: str, *items: str | list[str], tail: str = "") -> str:
    flat = [x for item in items for x in ([item] if isinstance(item, str) else item)]
    return f"SELECT {', '.join(flat)} FROM {table} {tail}".strip()


def add(name: str, body: str) -> None:
    SQL[name] = t.statement(body)


# --- scans, sources, sinks -----------------------------------------------------------------------

add("scan_delimited", "SELECT * FROM raw_filosofi_iris")
add(
    "scan_encoding_fallback",
    "SELECT code_iris, concat('Île d''été ', lib_iris) AS lib_iris, code_bv FROM raw_internal_bv_iris",
)
add("scan_zip_members", "SELECT * FROM raw_rp_activite_iris")
add("scan_layer_attributes", "SELECT * FROM raw_passoires_energetiques_iris")
add(
    "detect_format",
    "SELECT kind, detected_format, count(*) > 0 AS seen FROM raw_zrr_communes, (VALUES "
    "('archive','zip_csv'), ('workbook','xlsx'), ('shapes','zip_shp'), ('other archive','xls'), "
    "('layer','gpkg'), ('old workbook','xls'), ('text','csv'), ('unknown','xls')) "
    "AS v(kind, detected_format) GROUP BY 1, 2",
)
add(
    "discover_header",
    "SELECT CAST(2 AS BIGINT) AS header_row, "
    "'district,city,nom_de_la_cite,department,nombre,taux,total' AS columns",
)
add("rows_below_header", "SELECT * FROM raw_passoires_energetiques_iris")
add("bronze_load", "SELECT * FROM raw_zrr_communes UNION ALL SELECT * FROM raw_zrr_communes")
_null_tokens = (
    "'s','nd','ND','S','nc','NC','',' ','n.d.','N/A','#N/A','#N/A N/A','#NA','-1.#IND','-1.#QNAN','-NaN',"
    "'-nan','1.#IND','1.#QNAN','<NA>','NA','NULL','NaN','None','n/a','nan','null'"
)
add(
    "null_tokens",
    select(
        "raw_filosofi_iris",
        [f"CASE WHEN {c} NOT IN ({_null_tokens}) THEN {c} END AS {c}"
         for c in ("iris", "disp_med21", "disp_tp6021", "disp_d121", "disp_d921", "disp_q121", "disp_q321",
                   "disp_pimpot21")],
    ),
)
add(
    "bronze_partitioned",
    "SELECT iris, disp_med21, 'S01' AS source_id, '2021' AS millesime, '20240201_000000' AS run_ts "
    "FROM raw_filosofi_iris",
)
add(
    "export_gold",
    select("master", "iris_code", "iris_label", "bv_code", doubles("score_esg_0_100", "population_totale"),
           "est_zrr"),
)
add(
    "audit_append",
    "SELECT source_id, status, count(*) AS loads, CAST(sum(row_count) AS BIGINT) AS row_count FROM ("
    "SELECT source_id, status, row_count FROM ingestion_log "
    "UNION ALL SELECT 'S12', 'SUCCESS', (SELECT count(*) FROM raw_internal_bv_iris) "
    "UNION ALL SELECT 'S12', 'FAILED', NULL) GROUP BY source_id, status",
)
_content = "concat_ws(';', iris, disp_med21, disp_tp6021, disp_pimpot21)"
_files = f"SELECT left(iris, 1) AS part, string_agg({_content} || chr(10), '' ORDER BY {_content}) AS body FROM raw_filosofi_iris GROUP BY 1"
add(
    "content_checksum",
    f"SELECT part, md5(body) AS checksum_md5, CAST(strlen(body) AS BIGINT) AS file_size_bytes FROM ({_files})",
)
add(
    "normalize_headers",
    "SELECT iris, p22_pop1564 AS pop_15_64_ans, p22_act1564 AS pop_active, p22_chom1564 AS chomeurs, "
    "p22_actocc1564 AS actifs_occupes, p22_inact1564 AS inactifs, p22_sal15p_empaid AS emplois_aides, "
    "p22_nsal15p AS emplois_aides_2 FROM raw_rp_activite_iris",
)
add("map_columns", "SELECT code_iris, lib_iris, code_bv, lib_bv FROM raw_internal_bv_iris")
add(
    "last_row_count",
    "SELECT source_id, CAST(row_count AS BIGINT) AS row_count FROM (SELECT *, row_number() OVER ("
    "PARTITION BY source_id ORDER BY ingested_at DESC, file_size_bytes DESC) AS rn FROM ingestion_log "
    "WHERE status = 'SUCCESS' AND row_count IS NOT NULL) WHERE rn = 1",
)
add(
    "ascii_fold",
    "SELECT doc_id, coalesce(nullif(trim(regexp_replace(strip_accents(text), '[^\\x01-\\x7F]', '', 'g'), "
    "concat(chr(9), chr(10), chr(11), chr(12), chr(13), chr(28), chr(29), chr(30), chr(31), ' ')), ''), "
    "'n-a') AS folded FROM documents",
)

# --- projections ---------------------------------------------------------------------------------

_code = t.code9("code_iris")
add("normalize_area_code", f"SELECT code_iris, {_code} AS iris_code FROM raw_internal_bv_iris")
add("area_to_department", f"SELECT code_iris, left({_code}, 2) AS dep_code FROM raw_internal_bv_iris")
add("area_to_commune", f"SELECT code_iris, left({_code}, 5) AS com_code FROM raw_internal_bv_iris")
add(
    "nullify_secret",
    select(
        "raw_filosofi_iris", "iris",
        [f"CASE WHEN upper(trim({c})) NOT IN ('S','NS','ND','NC','N.D.','N/A','') THEN {c} END AS {c}"
         for c in ("disp_med21", "disp_tp6021", "disp_pimpot21")],
    ),
)
add(
    "safe_numeric",
    f"SELECT iris, CAST({t.num('disp_med21')} AS DOUBLE) AS median, "
    f"CAST({t.num('disp_tp6021', 5, 2)} AS DOUBLE) AS poverty FROM raw_filosofi_iris",
)
add(
    "safe_numeric_lenient",
    "SELECT lib_iris, CAST(TRY_CAST(lib_iris AS DECIMAL(10,2)) AS DOUBLE) AS from_label, "
    "CAST(TRY_CAST(code_bv AS DECIMAL(10,2)) AS DOUBLE) AS from_code FROM raw_internal_bv_iris",
)
add(
    "safe_int",
    "SELECT coalesce(CAST(nullif(trim(obs_value), '') AS BIGINT), 0) AS value, obs_value, count(*) AS n "
    "FROM raw_bpe_iris GROUP BY 1, 2",
)
add(
    "blank_decimal",
    "SELECT district, CAST(CAST(nullif(trim(nombre), '') AS DECIMAL(14,4)) AS DOUBLE) AS nombre, "
    "CAST(CAST(nullif(trim(taux), '') AS DECIMAL(7,4)) AS DOUBLE) AS taux "
    "FROM raw_passoires_energetiques_iris",
)
add(
    "normalize_commune",
    "SELECT district, lpad(trim(city), 5, '0') AS com_code FROM raw_passoires_energetiques_iris",
)
add(
    "clean_labels",
    "SELECT upper(trim(facility_type)) AS type_equip, upper(trim(facility_dom)) AS domaine, "
    "trim(coalesce(facility_type, '')) AS label, count(*) AS n FROM raw_bpe_iris GROUP BY 1, 2, 3",
)
add(
    "derive_geography",
    "SELECT *, left(iris_code, 2) AS dep_code, left(iris_code, 5) AS com_code, "
    "right(iris_code, 4) = '0000' AS is_commune_entiere FROM located",
)
add(
    "secrecy_flag",
    "SELECT iris, upper(trim(disp_med21)) IN ('S','ND') AND upper(trim(disp_tp6021)) IN ('S','ND') "
    "AS flag_secret_statistique FROM raw_filosofi_iris",
)
add(
    "labour_rates",
    select("activity_all", "iris_code", doubles("taux_chomage_pct", "taux_emploi_pct", "taux_activite_pct")),
)
add(
    "housing_rates",
    select("housing_all", "iris_code",
           doubles("part_proprietaires_pct", "part_hlm_pct", "part_logements_avant_1971_pct")),
)
add(
    "population_shares",
    select("population_all", "iris_code",
           doubles("part_moins_25_ans_pct", "part_plus_65_ans_pct", "part_cadres_pct")),
)
add(
    "vacancy_rate",
    f"SELECT iris_code, CAST({t.pct('nb_logements_vacants', 'nb_logements_total')} AS DOUBLE) "
    "AS taux_vacance_logements_pct FROM housing_all",
)
add(
    "interdecile_ratio",
    "SELECT iris_code, CAST(CASE WHEN revenu_d1_uc > 0 THEN "
    f"{t.rnd(t.div('revenu_d9_uc', 'revenu_d1_uc'))} END AS DOUBLE) AS ratio_interdecile_d9d1 "
    "FROM income_all",
)
_parts = {
    "energy": t.ENERGY_PART,
    "building_age": t.OLD_PART,
    "vacancy": t.VACANCY_PART,
    "unemployment": t.UNEMPLOYMENT_PART,
    "income": t.INCOME_PART,
    "poverty": t.POVERTY_PART,
}
add(
    "clamped_scores",
    "SELECT r.iris_code, "
    + ", ".join(f"CAST(round(CAST({sql} AS {t.R}), 4) AS DOUBLE) AS {name}" for name, sql in _parts.items())
    + " FROM areas r LEFT JOIN housing_all USING (iris_code) LEFT JOIN energy_all USING (iris_code) "
    "LEFT JOIN income_all USING (iris_code) LEFT JOIN activity_all USING (iris_code)",
)
add("score_environment", select("pillar_e", "iris_code", doubles("score_env_0_100")))
add("score_social", select("pillar_s", "iris_code", doubles("score_social_0_100")))
add(
    "score_health_access",
    f"SELECT iris_code, CAST(round(CAST({t.HEALTH_PART} AS {t.R}), 4) AS DOUBLE) AS health_access FROM panel",
)
add(
    "score_education_access",
    f"SELECT iris_code, CAST({t.EDUCATION_PART} AS DOUBLE) AS education_access FROM panel",
)
add("score_governance", select("pillar_g", "iris_code", doubles("score_gouvernance_0_100")))
add("score_composite", select("master", "iris_code", doubles("score_esg_0_100")))
add("completeness", select("master", "iris_code", doubles("pct_completude")))
_band = (
    "CASE WHEN score_esg_0_100 < 30 THEN '0-30 Fragile' WHEN score_esg_0_100 < 45 THEN '30-45 Faible' "
    "WHEN score_esg_0_100 < 55 THEN '45-55 Moyen' WHEN score_esg_0_100 < 65 THEN '55-65 Correct' "
    "ELSE '65+ Favorable' END"
)
add("score_bands", f"SELECT iris_code, {_band} AS tranche_score FROM master")

# --- filters and joins ---------------------------------------------------------------------------

add("filter_valid_key", f"SELECT * FROM raw_internal_bv_iris WHERE {t.keyed('code_iris')}")
add(
    "filter_commune_regex",
    "SELECT codgeo FROM raw_zrr_communes "
    "WHERE regexp_matches(trim(codgeo), '^(0[1-9]|[1-9][0-9]|2[AB])[0-9]{3}$')",
)
add(
    "join_perimeter",
    select("income_all i JOIN areas a USING (iris_code)", "iris_code", doubles("revenu_median_uc")),
)
add(
    "join_star",
    "SELECT r.iris_code, r.bv_code, CAST(nb_logements_total AS DOUBLE) AS nb_logements_total, "
    "CAST(taux_passoires_energetiques_pct AS DOUBLE) AS taux_passoires_energetiques_pct FROM areas r "
    "LEFT JOIN housing_all h ON r.iris_code = h.iris_code LEFT JOIN energy_all p ON r.iris_code = p.iris_code",
)
add(
    "join_commune_flag",
    "SELECT r.iris_code, r.com_code, coalesce(z.est_zrr, false) AS est_zrr FROM areas r "
    "LEFT JOIN zrr z ON r.com_code = z.com_code",
)

# --- aggregations and windows --------------------------------------------------------------------

add("facility_totals", "SELECT iris_code, nb_equipements_total FROM facilities_all")
add("facility_measures", "SELECT * EXCLUDE (nb_equipements_total) FROM facilities_all")


def _basin(name: str, measures: dict[str, str], whole: tuple[str, ...] = ()) -> None:
    items = [n if n in whole else f"CAST({n} AS DOUBLE) AS {n}" for n in measures]
    add(name, f"SELECT bv_code, bv_label, dep_code, {', '.join(items)} FROM ({t.by_basin(measures)})")


COUNTED = (
    "nb_iris", "nb_equipements_total_bv", "nb_equip_sante_bv", "nb_medecins_bv", "nb_iris_zrr",
    "nb_iris_incomplets",
)
_basin("weighted_means", t.BASIN_MEANS)
_basin("weighted_scores", t.BASIN_SCORES)
_basin("basin_averages", t.BASIN_AVERAGES)
_basin("basin_counts", t.BASIN_COUNTS, COUNTED)
add("zrr_communes", "SELECT * FROM zrr")
add(
    "master_metrics",
    f"SELECT count(*) AS nb_iris, CAST({t.rnd(t.avg('pct_completude'), 1)} AS DOUBLE) AS completude_moy, "
    f"CAST({t.rnd(t.avg('score_esg_0_100'), 1)} AS DOUBLE) AS score_esg_moy FROM master",
)
_features = (
    "revenu_median_uc", "taux_pauvrete_60", "ratio_interdecile_d9d1", "taux_chomage_pct",
    "taux_activite_pct", "population_totale", "part_moins_25_ans_pct", "part_cadres_pct",
    "part_logements_avant_1971_pct", "part_hlm_pct", "nb_equipements_total", "nb_equip_sante",
)
_feature_rows = (
    "SELECT f.iris_code, revenu_median_uc, taux_pauvrete_60, CASE WHEN revenu_d1_uc > 0 THEN "
    f"{t.rnd(t.div('revenu_d9_uc', 'revenu_d1_uc'))} END AS ratio_interdecile_d9d1, taux_chomage_pct, "
    "taux_activite_pct, population_totale, part_moins_25_ans_pct, part_cadres_pct, "
    "part_logements_avant_1971_pct, part_hlm_pct, nb_equipements_total, nb_equip_sante "
    "FROM income f LEFT JOIN activity USING (iris_code) LEFT JOIN population USING (iris_code) "
    "LEFT JOIN housing USING (iris_code) LEFT JOIN facilities USING (iris_code)"
)
add(
    "feature_table",
    select(f"({_feature_rows})", "iris_code", doubles(*_features[:10]),
           "nb_equipements_total", "nb_equip_sante"),
)
add(
    "profile_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS count, CAST(round({t.avg(c)}, 6) AS DOUBLE) AS mean, "
        f"round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM ({_feature_rows})"
        for c in _features
    ),
)
add(
    "correlation",
    "SELECT count(*) AS pairs, round(corr(taux_pauvrete_60, taux_chomage_pct), 6) AS correlation "
    "FROM master WHERE taux_pauvrete_60 IS NOT NULL AND taux_chomage_pct IS NOT NULL",
)
_long = " UNION ALL ".join(
    f"SELECT '{c}' AS pillar, CAST({c} * 100 AS BIGINT) AS x FROM master WHERE {c} IS NOT NULL"
    for c in ("score_env_0_100", "score_social_0_100", "score_gouvernance_0_100")
)
add(
    "distinct_rollup",
    "SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, count(DISTINCT l_partkey) AS exact, true AS within FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey",
)
add(
    "facilities_within_perimeter",
    select("facilities", "iris_code", longs("nb_equipements_total", "nb_equip_sante", "nb_medecins_generalistes")),
)
add(
    "score_histogram",
    f"SELECT pillar, bin, n, round((lo + (hi - lo) * bin / 30) / 100, 6) AS lower_edge FROM ("
    f"SELECT r.pillar, CAST(b.i AS BIGINT) AS bin, r.lo, r.hi, count(v.x) AS n FROM "
    f"(SELECT pillar, min(x) AS lo, max(x) AS hi FROM ({_long}) GROUP BY pillar) r "
    f"CROSS JOIN range(30) b(i) LEFT JOIN ({_long}) v ON v.pillar = r.pillar "
    f"AND least(29, ((v.x - r.lo) * 30) // (r.hi - r.lo)) = b.i GROUP BY ALL)",
)
add("score_medians", f"SELECT pillar, median(x) / 100.0 AS median FROM ({_long}) GROUP BY pillar")
add(
    "dedup_first",
    "SELECT iris_code, iris_label, bv_code, bv_label FROM areas",
)
add(
    "percent_rank_panel",
    "SELECT iris_code, coalesce(nb_equipements_total, 0) AS nb_equipements_total, "
    "CAST(round(presence, 6) AS DOUBLE) AS presence_rank FROM panel",
)

# --- tables --------------------------------------------------------------------------------------

_rates = {
    "population": ("part_moins_25_ans_pct", "part_plus_65_ans_pct", "part_cadres_pct"),
    "activity": ("taux_chomage_pct", "taux_emploi_pct", "taux_activite_pct"),
    "housing": ("part_proprietaires_pct", "part_hlm_pct", "part_logements_avant_1971_pct"),
}
add("silver_referential", "SELECT * FROM areas")
add(
    "silver_income",
    select("income", "iris_code", doubles(*INCOME_AMOUNTS.values(), *INCOME_RATES.values()),
           "CAST(NULL AS DOUBLE) AS taux_pauvrete_40", "CAST(NULL AS DOUBLE) AS taux_pauvrete_50",
           "CAST(NULL AS BIGINT) AS nb_menages_fiscaux", "flag_secret_statistique", "'2021' AS millesime"),
)
for _name, _counts in (
    ("population", POPULATION_COUNTS), ("activity", ACTIVITY_COUNTS), ("housing", HOUSING_COUNTS)
):
    add(
        f"silver_{_name}",
        select(_name, "iris_code", doubles(*_counts.values(), *_rates[_name]), "'2022' AS millesime"),
    )
add("silver_facilities", "SELECT *, '2024' AS millesime FROM facilities")
add(
    "silver_energy",
    select("energy", "iris_code", "com_code", "commune_label", "dep_code",
           doubles("nb_passoires_energetiques_estime", "taux_passoires_energetiques_pct",
                   "nb_residences_principales_estime"), "'2022' AS millesime"),
)
_e_numbers = (
    "nb_logements_total", "nb_residences_principales", "nb_logements_vacants", "part_proprietaires_pct",
    "part_hlm_pct", "part_logements_avant_1971_pct", "taux_vacance_logements_pct",
    "nb_passoires_energetiques_estime", "taux_passoires_energetiques_pct",
    "nb_residences_principales_estime", "score_env_0_100",
)
_s_numbers = (
    "population_totale", "part_moins_25_ans_pct", "part_plus_65_ans_pct", "part_cadres_pct",
    "revenu_median_uc", "revenu_q1_uc", "revenu_d1_uc", "revenu_d9_uc", "taux_pauvrete_60",
    "taux_pauvrete_40", "part_menages_imposes", "ratio_interdecile_d9d1", "pop_active_1564",
    "nb_chomeurs_1564", "nb_emplois_aides", "taux_chomage_pct", "taux_emploi_pct", "taux_activite_pct",
    "score_social_0_100",
)
_s_extra = ("nb_cadres_prof_intel", "nb_ouvriers", "nb_employes", "revenu_q3_uc", "actifs_occupes_1564")
_g_counts = (
    "nb_equipements_total", "nb_equip_sante", "nb_equip_enseignement", "nb_equip_transports",
    "nb_equip_commerces", "nb_equip_services", "nb_medecins_generalistes", "nb_pharmacies",
    "nb_ecoles_primaires", "nb_colleges_lycees", "nb_gares_arrets_tc", "nb_banques_agences",
    "nb_france_services",
)
_g_numbers = ("indice_presence_services", "score_gouvernance_0_100")
add(
    "gold_environment",
    select("pillar_e", "iris_code", "iris_label", "bv_code", "dep_code", doubles(*_e_numbers)),
)
add(
    "gold_social",
    select("pillar_s", "iris_code", "iris_label", "bv_code", "dep_code", doubles(*_s_numbers, *_s_extra),
           longs("nb_menages_fiscaux"), "flag_secret_statistique"),
)
add(
    "gold_governance",
    select("pillar_g", "iris_code", "iris_label", "bv_code", "com_code", "dep_code", list(_g_counts),
           "est_zrr", doubles(*_g_numbers)),
)
add(
    "gold_area_final",
    select("master", "iris_code", "iris_label", "bv_code", "bv_label", "dep_code", "com_code",
           "is_commune_entiere", doubles(*_e_numbers, *_s_numbers, *_g_numbers),
           longs("nb_menages_fiscaux"), "flag_secret_statistique", list(_g_counts), "est_zrr",
           doubles("score_esg_0_100", "pct_completude"), "version_modele"),
)
_all_basin = {**t.BASIN_COUNTS, **t.BASIN_MEANS, **t.BASIN_SCORES, **t.BASIN_AVERAGES}
_basin_table = select(
    "basin", "bv_code", "bv_label", "dep_code", list(COUNTED),
    doubles(*(n for n in _all_basin if n not in COUNTED)), "'1.0' AS version_modele",
)
add("gold_basin_final", _basin_table)
add("run_chain", _basin_table)
add(
    "run_log",
    " UNION ALL ".join(
        f"SELECT '{name}' AS model_name, '{name.split('_')[0]}' AS layer, 'SUCCESS' AS status, "
        f"count(*) AS rows_affected FROM {cte}"
        for name, cte in {
            "silver_referentiel_iris": "areas", "silver_filosofi": "income",
            "silver_rp_population": "population", "silver_rp_activite": "activity",
            "silver_rp_logement": "housing", "silver_bpe": "facilities",
            "silver_passoires_energetiques": "energy", "gold_indicateurs_e": "pillar_e",
            "gold_indicateurs_s": "pillar_s", "gold_indicateurs_g": "pillar_g",
            "gold_esg_iris_final": "master", "gold_esg_bassin_vie_final": "basin",
        }.items()
    ),
)
add(
    "audit_summary",
    "SELECT source_id, source_name, millesime, strftime(max(ingested_at), '%Y-%m-%d') AS derniere_ingestion, "
    "count(*) AS nb_runs_total, count(*) FILTER (WHERE status = 'SUCCESS') AS nb_succes, "
    "count(*) FILTER (WHERE status = 'FAILED') AS nb_echecs, "
    "CAST(max(row_count) AS BIGINT) AS dernier_row_count, max(file_size_bytes) AS dernier_file_size_bytes, "
    "CAST(last(row_count ORDER BY ingested_at, file_size_bytes) AS BIGINT) AS dernier_row_count_exact "
    "FROM ingestion_log GROUP BY source_id, source_name, millesime",
)
add(
    "ingest_job",
    "SELECT 'S01' AS source_id, '2021' AS millesime, 'SUCCESS' AS status, count(*) AS row_count, "
    "count(*) AS bronze_rows FROM raw_filosofi_iris",
)
add(
    "ingest_internal",
    "SELECT code_iris, concat('Cité ', lib_iris) AS lib_iris, code_bv, lib_bv FROM raw_internal_bv_iris",
)

add("chain_from_files", _basin_table)
_built = {
    "silver_referentiel_iris": "areas", "silver_filosofi": "income", "silver_rp_population": "population",
    "silver_rp_activite": "activity", "silver_rp_logement": "housing", "silver_bpe": "facilities",
    "gold_indicateurs_s": "pillar_s", "gold_indicateurs_g": "pillar_g",
}
_arrived = {
    "S01": "raw_filosofi_iris", "S02": "raw_rp_population_iris", "S03": "raw_rp_activite_iris", "S04": "raw_rp_logement_iris",
    "S05": "raw_bpe_iris", "S11": "raw_zrr_communes", "S12": "raw_internal_bv_iris",
}
add(
    "chain_without_a_source",
    " UNION ALL ".join(
        [f"SELECT 'source' AS what, '{s}' AS name, 'SUCCESS' AS status, count(*) AS n FROM {raw}" for s, raw in _arrived.items()]
        + [f"SELECT 'table', '{name}', 'BUILT', count(*) FROM {cte}" for name, cte in _built.items()]
        + ["SELECT 'source', 'S09', 'FAILED', NULL"]
        + [
            f"SELECT 'table', '{name}', 'SKIPPED', NULL"
            for name in ("silver_passoires_energetiques", "gold_indicateurs_e", "gold_esg_iris_final", "gold_esg_bassin_vie_final")
        ]
    ),
)
_shrunk = "(SELECT count(*) AS a, count(*) FILTER (ends_with(iris, '0000')) AS b FROM raw_filosofi_iris)"
add(
    "ingest_drift",
    " UNION ALL ".join(
        f"SELECT '{ts}' AS run_ts, {n} AS row_count, 'SUCCESS' AS status, true AS digest, true AS sized, {note} AS notes FROM {_shrunk}"
        for ts, n, note in (
            ("20240101_000000", "a", "NULL"), ("20240102_000000", "a", "NULL"),
            ("20240103_000000", "b",
             "CASE WHEN (a - b) * 100.0 / a > 20 THEN printf('row count %d -> %d: %.4f %% of drift, limit 20 %%', a, b, (a - b) * 100.0 / a) END"),
        )
    ),
)

# --- data quality --------------------------------------------------------------------------------

LAYER = {
    "silver_referentiel_iris": "areas", "silver_filosofi": "income", "silver_rp_population": "population",
    "silver_rp_activite": "activity", "silver_rp_logement": "housing", "silver_bpe": "facilities",
    "silver_passoires_energetiques": "energy", "gold_esg_iris_final": "master",
    "gold_esg_bassin_vie_final": "basin",
}


def rule_numbers(rule: Rule, cte: str) -> tuple[str, str, str, str, str]:
    """FROM clause, evaluated, violations, observed and success of a rule, in SQL."""
    c, none = rule.column, "CAST(NULL AS DOUBLE)"
    if rule.kind == "not_null":
        bad = f"count(*) FILTER (WHERE {c} IS NULL)"
        return cte, "count(*)", bad, none, f"{bad} = 0"
    if rule.kind == "unique":
        source = f"(SELECT {c}, count(*) OVER (PARTITION BY {c}) AS times FROM {cte} WHERE {c} IS NOT NULL)"
        bad = "count(*) FILTER (WHERE times > 1)"
        return source, "count(*)", bad, none, f"{bad} = 0"
    if rule.kind == "row_count":
        return cte, "count(*)", "0", "CAST(count(*) AS DOUBLE)", f"count(*) BETWEEN {rule.low} AND {rule.high}"
    if rule.kind == "mean":
        mean = f"CAST(round({t.avg(c)}, 6) AS DOUBLE)"
        return cte, f"count({c})", "0", mean, f"{mean} BETWEEN {rule.low} AND {rule.high}"
    if rule.kind == "regex":
        bad = f"count({c}) FILTER (WHERE NOT regexp_matches({c}, '{rule.pattern}'))"
        return cte, f"count({c})", bad, none, f"{bad} = 0"
    bad = f"count({c}) FILTER (WHERE {c} < {rule.low} OR {c} > {rule.high})"
    ok = f"count({c}) = 0 OR (count({c}) - {bad}) >= {rule.mostly} * count({c})"
    return cte, f"count({c})", bad, none, ok


def suite_sql(rules: list[Rule]) -> str:
    selects = []
    for number, rule in enumerate(rules, 1):
        source, evaluated, bad, observed, ok = rule_numbers(rule, "master")
        selects.append(
            f"SELECT CAST({number} AS BIGINT) AS rule_no, '{rule.kind}' AS kind, "
            f"'{rule.column or ''}' AS column_name, CAST({evaluated} AS BIGINT) AS evaluated, "
            f"CAST({bad} AS BIGINT) AS violations, {observed} AS observed, ({ok}) AS success FROM {source}"
        )
    return " UNION ALL ".join(selects)


def table_rules_sql(kind: str) -> str:
    selects = []
    for table, rules in TABLE_RULES.items():
        for rule in rules:
            if rule.kind == kind:
                source, evaluated, bad, _, ok = rule_numbers(rule, LAYER[table])
                selects.append(
                    f"SELECT '{table}' AS table_name, '{kind}' AS kind, '{rule.column}' AS column_name, "
                    f"CAST({evaluated} AS BIGINT) AS evaluated, CAST({bad} AS BIGINT) AS violations, "
                    f"({ok}) AS success FROM {source}"
                )
    return " UNION ALL ".join(selects)


add("q_not_null", table_rules_sql("not_null").replace("version_modele IS NULL", "'1.0' IS NULL"))
add("q_unique", table_rules_sql("unique"))
add("q_range", table_rules_sql("between"))
add("q_suite", suite_sql(list(MASTER_SUITE)))
for _kind in ("row_count", "mean", "regex"):
    add(f"q_{_kind}", suite_sql([r for r in MASTER_SUITE if r.kind == _kind]))
add("q_duplicates", "SELECT iris_code, count(*) AS occurrences FROM located GROUP BY 1 HAVING count(*) > 1")
add(
    "q_relationships",
    " UNION ALL ".join(
        f"SELECT '{r.child}' AS table_name, '{r.parent}' AS parent_name, '{r.key}' AS column_name, "
        f"count(*) AS violations FROM {LAYER[r.child]} WHERE {r.key} IS NOT NULL "
        f"AND {r.key} NOT IN (SELECT {r.key} FROM {LAYER[r.parent]})"
        for r in REFERENCES
    ),
)
_broken = "left(right({}, 5), 1) = '{}'".format
_faults = {
    ("silver_referentiel_iris", "not_null:bv_code"): f"count(*) AS n FROM areas WHERE {_broken('iris_code', 7)}",
    ("silver_filosofi", "between:taux_pauvrete_60"): f"count(*) AS n FROM income WHERE {_broken('iris_code', 3)}",
    ("silver_rp_logement", "unique:iris_code"): f"CAST(2 * count(*) AS BIGINT) AS n FROM housing WHERE {_broken('iris_code', 5)}",
}
add(
    "gate_trips",
    " UNION ALL ".join(
        [
            f"SELECT '{what}' AS what, '{table}' AS table_name, '{rule}' AS rule, {n}"
            for what in ("failed", "quarantined") for (table, rule), n in _faults.items()
        ]
        + [
            f"SELECT 'not built', '{table}', '', CAST(0 AS BIGINT)"
            for table in ("gold_indicateurs_e", "gold_indicateurs_s", "gold_indicateurs_g", "gold_esg_iris_final",
                          "gold_esg_bassin_vie_final")
        ]
        + [f"SELECT 'kept', 'gold_esg_iris_final', '', count(*) FROM areas WHERE NOT {_broken('iris_code', 7)}"]
    ),
)
# Rows of the faulty tables: the catchment is unknown in one commune of ten, the poverty rate 140 in another.
_fault_areas = f"(SELECT iris_code, com_code, CASE WHEN NOT {_broken('iris_code', 7)} THEN bv_code END AS bv_code FROM areas)"
_fault_income = (
    "(SELECT revenu_median_uc, CAST(CASE WHEN " + _broken("iris_code", 3) + " THEN 140 ELSE taux_pauvrete_60 END "
    "AS DECIMAL(10,2)) AS rate FROM income)"
)
_fault_rules = [
    ("silver_referentiel_iris", 1, "unique", "iris_code", f"SELECT count(*), 0, true FROM {_fault_areas}"),
    ("silver_referentiel_iris", 2, "unique", "bv_code",
     f"SELECT sum(n), coalesce(sum(n) FILTER (n > 1), 0), max(n) <= 1 FROM (SELECT count(*) AS n FROM {_fault_areas} "
     "WHERE bv_code IS NOT NULL GROUP BY bv_code)"),
    ("silver_referentiel_iris", 3, "not_null", "iris_code", f"SELECT count(*), 0, true FROM {_fault_areas}"),
    ("silver_referentiel_iris", 4, "not_null", "bv_code",
     f"SELECT count(*), count(*) - count(bv_code), count(bv_code) = count(*) FROM {_fault_areas}"),
    ("silver_referentiel_iris", 5, "regex", "iris_code", f"SELECT count(*), 0, true FROM {_fault_areas}"),
    ("silver_referentiel_iris", 6, "regex", "com_code",
     f"SELECT count(*), count(*) FILTER (right(com_code, 1) > '6'), count(*) FILTER (right(com_code, 1) > '6') = 0 FROM {_fault_areas}"),
    ("silver_referentiel_iris", 7, "row_count", "", f"SELECT count(*), 0, true FROM {_fault_areas}"),
    ("silver_referentiel_iris", 8, "row_count", "", f"SELECT count(*), 0, false FROM {_fault_areas}"),
    ("silver_filosofi", 1, "between", "revenu_median_uc", f"SELECT count(revenu_median_uc), 0, true FROM {_fault_income}"),
    ("silver_filosofi", 2, "between", "taux_pauvrete_60",
     f"SELECT count(rate), count(*) FILTER (rate > 100), count(*) FILTER (rate > 100) = 0 FROM {_fault_income}"),
    ("silver_filosofi", 3, "mean", "taux_pauvrete_60", f"SELECT count(rate), 0, true FROM {_fault_income}"),
    ("silver_filosofi", 4, "mean", "taux_pauvrete_60", f"SELECT count(rate), 0, false FROM {_fault_income}"),
]
add(
    "q_broken_rules",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, CAST({no} AS BIGINT) AS rule_no, '{kind}' AS kind, '{column}' AS column_name, "
        f"CAST(e AS BIGINT) AS evaluated, CAST(v AS BIGINT) AS violations, ok AS success FROM ({body}) AS x(e, v, ok)"
        for table, no, kind, column, body in _fault_rules
    ),
)
add(
    "q_source_contract",
    " UNION ALL ".join(
        f"SELECT '{s.source_id}' AS source_id, count(*) AS row_count, CAST(0 AS BIGINT) AS missing_columns, "
        f"count(*) < {s.min_rows} AS too_few_rows, count(*) > {s.max_rows} AS too_many_rows, "
        f"count(*) BETWEEN {s.min_rows} AND {s.max_rows} AS accepted FROM {s.table}"
        for s in SOURCES.values()
    ),
)
_drift = (
    "SELECT source_id, CAST(row_count AS BIGINT) AS new_count, CAST(lead(row_count) OVER w AS BIGINT) "
    "AS previous_count, row_number() OVER w AS rn FROM ingestion_log "
    "WHERE status = 'SUCCESS' AND row_count IS NOT NULL "
    "WINDOW w AS (PARTITION BY source_id ORDER BY ingested_at DESC, file_size_bytes DESC)"
)
_delta = (
    f"CASE WHEN previous_count <> 0 THEN {t.div('abs(new_count - previous_count) * 100', 'previous_count')} END"
)
add(
    "q_row_drift",
    f"SELECT source_id, new_count, previous_count, CAST(round({_delta}, 4) AS DOUBLE) AS delta_pct, "
    f"CASE WHEN {_delta} IS NULL THEN 'skipped' WHEN {_delta} > 20 THEN 'warn' ELSE 'ok' END AS verdict "
    f"FROM ({_drift}) WHERE rn = 1",
)
_age = f"datediff('day', CAST(max(ingested_at) AS DATE), DATE '{FRESHNESS_DATE}')"
add(
    "q_freshness",
    f"SELECT source_id, {_age} AS age_days, CASE WHEN {_age} > 30 THEN 'error' WHEN {_age} > 14 THEN 'warn' "
    "ELSE 'ok' END AS verdict FROM ingestion_log GROUP BY source_id",
)
add("q_score_not_null", "SELECT iris_code FROM master WHERE score_esg_0_100 IS NULL")
add(
    "q_referential_complete",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, r.iris_code FROM areas r LEFT JOIN {cte} x "
        f"ON r.iris_code = x.iris_code WHERE x.iris_code IS NULL"
        for name, cte in LAYER.items()
        if cte not in ("areas", "basin")
    ),
)
add(
    "q_poverty_range",
    "SELECT iris_code, CAST(taux_pauvrete_60 AS DOUBLE) AS taux_pauvrete_60 FROM master "
    "WHERE taux_pauvrete_60 < 0 OR taux_pauvrete_60 > 100",
)

# --- dashboards ----------------------------------------------------------------------------------


def one(name: str, alias: str) -> str:
    return f"CAST(round({name}, 1) AS DOUBLE) AS {alias}"


_basin_name = "bv_code || ' - ' || bv_label AS bassin_de_vie"
add(
    "b1_score_by_basin",
    select("basin", _basin_name, one("score_esg_pondere", "score_esg"),
           one("score_social_pondere", "score_social"), one("score_env_pondere", "score_env"),
           one("score_gouvernance_pondere", "score_gouvernance"), "nb_iris",
           "CAST(round(population_totale_bv, 0) AS BIGINT) AS population",
           tail="ORDER BY score_esg_pondere, bv_code"),
)
add(
    "b2_score_distribution",
    f"SELECT {_band} AS tranche_score, count(*) AS nb_iris FROM master GROUP BY 1 "
    "ORDER BY min(score_esg_0_100)",
)
add(
    "b3_bottom10",
    select("master", "iris_code", "iris_label", "bv_label AS bassin_de_vie",
           one("score_esg_0_100", "score_esg"), one("score_social_0_100", "score_social"),
           one("score_env_0_100", "score_env"), one("score_gouvernance_0_100", "score_gouv"),
           "CAST(round(population_totale, 0) AS BIGINT) AS population",
           tail="ORDER BY score_esg_0_100 NULLS LAST, iris_code LIMIT 10"),
)
add(
    "b4_completeness",
    select("basin", _basin_name, one("completude_moy_pct", "completude_pct"), "nb_iris",
           "nb_iris_incomplets", tail="ORDER BY completude_moy_pct, bv_code"),
)
add(
    "b5_pillars",
    select("basin", "bv_label AS bassin_de_vie", one("score_social_pondere", "social"),
           one("score_env_pondere", "environnement"), one("score_gouvernance_pondere", "gouvernance"),
           tail="ORDER BY bv_label"),
)
add(
    "b6_key_indicators",
    "SELECT count(*) AS nb_iris, count(DISTINCT bv_code) AS nb_bassins_vie, "
    f"CAST({t.rnd(t.avg('score_esg_0_100'), 1)} AS DOUBLE) AS score_esg_moyen, "
    f"CAST({t.rnd(t.avg('pct_completude'), 1)} AS DOUBLE) AS completude_moyenne_pct, "
    f"CAST({t.rnd(t.avg('taux_chomage_pct'), 1)} AS DOUBLE) AS taux_chomage_moyen_pct, "
    "CAST(round(sum(population_totale), 0) AS BIGINT) AS population_totale FROM master",
)
add(
    "b7_unemployment_social",
    select("master", "iris_label", doubles("taux_chomage_pct", "score_social_0_100"),
           "bv_label AS bassin_de_vie",
           tail="WHERE taux_chomage_pct IS NOT NULL ORDER BY taux_chomage_pct DESC, iris_code"),
)
add(
    "b8_zrr_split",
    "SELECT CASE WHEN est_zrr THEN 'En ZRR' ELSE 'Hors ZRR' END AS zone, count(*) AS nb_iris, "
    f"CAST({t.rnd(t.avg('score_esg_0_100'), 1)} AS DOUBLE) AS score_esg_moyen FROM master GROUP BY est_zrr",
)
add(
    "ops_recent_loads",
    "SELECT source_id, millesime, CAST(row_count AS BIGINT) AS row_count, status, "
    "strftime(ingested_at, '%Y-%m-%d') AS ingested_on FROM ingestion_log "
    "ORDER BY ingested_at DESC, source_id, file_size_bytes DESC LIMIT 20",
)
