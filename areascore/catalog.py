"""Every operator as a query over a folder of given tables.

A query takes the session and the folder and returns a frame with portable types: text, 64-bit integers,
doubles and booleans.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime
from functools import cache, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areascore.functions import codes, numbers, scores, text
from areascore.operators import keys, profile, sketches
from areascore.operators.ranking import with_percent_rank
from areascore.plans import gold, reports, silver
from areascore.plans.chain import AT_ONCE
from areascore.plans.chain import run_chain as run_whole_chain
from areascore.plans.delivery import Delivery, run_from_files
from areascore.plans.ingest import ingest_catchment_map, ingest_source
from areascore.plans.layers import Layers
from areascore.quality import audit, contracts, rules
from areascore.settings import SILVER_TABLES, SOURCES
from areascore.sources import containers, packing, tabular
from areascore.sources.fixtures import given, raw_table
from areascore.sources.storage import fresh_path, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MASTER = "gold_esg_iris_final"
BASINS = "gold_esg_bassin_vie_final"
AREAS = "silver_referentiel_iris"
FRESHNESS_DATE = "2001-08-20"
NO_BOUND = 2**62


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: portable(build(spark, sf_dir))
    return build


def _portable_type(name: str, kind: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.DecimalType, T.FloatType)):
        return column.cast("double").alias(name)
    if isinstance(kind, (T.IntegerType, T.ShortType)):
        return column.cast("bigint").alias(name)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd").alias(name)
    return column


def portable(df: DataFrame) -> DataFrame:
    return df.select(*(_portable_type(f.name, f.dataType) for f in df.schema))


def layers(spark: SparkSession, sf_dir: str, stored: bool = False) -> Layers:
    return Layers(lambda name: raw_table(spark, sf_dir, name), stored=stored)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return layers(spark, sf_dir).table(name)


# --- scans, sources, sinks -----------------------------------------------------------------------


@query
def scan_delimited(spark, d):
    raw = raw_table(spark, d, "raw_filosofi_iris")
    path = fresh_path(spark, "delimited")
    tabular.write_delimited(raw, path)
    return tabular.scan_delimited(spark, path, columns=raw.columns)


@query
def scan_encoding_fallback(spark, d):
    raw = raw_table(spark, d, "raw_internal_bv_iris").select(
        "code_iris", F.concat(F.lit("Île d'été "), "lib_iris").alias("lib_iris"), "code_bv"
    )
    even = F.col("code_bv").cast("int") % 2 == 0
    paths = [fresh_path(spark, "utf8"), fresh_path(spark, "latin1")]
    tabular.write_delimited(raw.where(even), paths[0])
    tabular.write_delimited(raw.where(~even), paths[1], encoding=tabular.LATIN_1)
    return tabular.scan_encoding_fallback(spark, paths, columns=raw.columns)


@query
def scan_zip_members(spark, d):
    raw = raw_table(spark, d, "raw_rp_activite_iris")
    packed = packing.pack_zip(raw)
    return containers.scan_zip_members(packed, raw.columns).drop("source_file")


@query
def scan_layer_attributes(spark, d):
    raw = raw_table(spark, d, "raw_passoires_energetiques_iris")
    layer = SOURCES["S09"].layer
    return containers.scan_layer_attributes(packing.pack_layer(raw, layer), raw.columns, layer).drop(
        "source_file"
    )


@query
def detect_format(spark, d):
    raw = raw_table(spark, d, "raw_zrr_communes")
    kinds = {
        "archive": packing.pack_zip(raw),
        "workbook": packing.pack_entries(raw, "[Content_Types].xml", "xl/workbook.xml"),
        "shapes": packing.pack_entries(raw, "zone.shp", "zone.dbf"),
        "other archive": packing.pack_entries(raw, "notes.bin"),
        "layer": packing.pack_layer(raw, "zones"),
        "old workbook": packing.pack_with_prefix(raw, bytes.fromhex(containers.OLE_MAGIC)),
        "text": packing.pack_csv(raw),
        "unknown": packing.pack_csv(raw, suffix=".dat"),
    }
    labelled = reduce(
        DataFrame.unionByName, (df.withColumn("kind", F.lit(k)) for k, df in kinds.items())
    )
    found = containers.detect_format(labelled, hint="xls")
    return found.groupBy("kind", "detected_format").agg(F.lit(True).alias("seen"))


@query
def discover_header(spark, d):
    raw = raw_table(spark, d, "raw_passoires_energetiques_iris")
    renamed = raw.withColumnsRenamed({"district": "District", "taux": "Taux", "city_name": "Nom de la Cité"})
    path = fresh_path(spark, "preamble")
    packing.lines_with_preamble(renamed, ["Zonage", "source;2021;x"]).write.text(path)
    found = tabular.discover_header(spark, path, keys=("district", "nombre", "taux"))
    return found.select("header_row", F.array_join("columns", ",").alias("columns")).distinct()


@query
def rows_below_header(spark, d):
    """Rows of files with different preambles and headers in different order."""
    raw = raw_table(spark, d, "raw_passoires_energetiques_iris")
    path = fresh_path(spark, "below")
    turned = raw.select(*reversed(raw.columns))
    for k, (part, above) in enumerate(((raw.where("total > '5'"), ["Zonage", "source;2021;x"]), (turned.where("total <= '5'"), []))):
        packing.lines_with_preamble(part, above).write.text(f"{path}/{k}")
    return tabular.rows_below_header(spark, [f"{path}/0", f"{path}/1"], ("district", "nombre", "taux"), raw.columns)


@query
def bronze_load(spark, d):
    raw = raw_table(spark, d, "raw_zrr_communes")
    path = fresh_path(spark, "raw_zrr_communes")
    for mode in ("replace", "replace", "append"):
        loaded = tabular.load_bronze(raw, path, mode)
    return loaded


@query
def null_tokens(spark, d):
    return tabular.with_null_tokens(raw_table(spark, d, "raw_filosofi_iris"))


@query
def bronze_partitioned(spark, d):
    root = fresh_path(spark, "landing")
    energy = raw_table(spark, d, "raw_zrr_communes")
    tabular.land(energy.select(F.col("codgeo").alias("iris")), root, "S11", "2021", "20240101_000000")
    income = raw_table(spark, d, "raw_filosofi_iris").select("iris", "disp_med21")
    for run in ("20240101_000000", "20240201_000000"):
        tabular.land(income, root, "S01", "2021", run)
    return tabular.landed(spark, root, income.columns, "S01", "20240201_000000")


@query
def export_gold(spark, d):
    path = fresh_path(spark, "export")
    master = _table(spark, d, MASTER)
    tabular.export_sorted(master, path, "iris_code")
    back = tabular.scan_delimited(spark, path, sep=",", columns=master.columns)
    return back.select(
        "iris_code", "iris_label", "bv_code", F.col("score_esg_0_100").cast("double"),
        F.col("population_totale").cast("double"), F.col("est_zrr").cast("boolean"),
    )


@query
def audit_append(spark, d):
    path = fresh_path(spark, "ingestion_log")
    history = raw_table(spark, d, "ingestion_log").select(
        F.uuid().alias("id"), "source_id", "source_name", F.lit("file").alias("file_name"),
        F.lit("path").alias("minio_path"), "millesime", "status",
        F.col("row_count").cast("bigint").alias("row_count"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
    )
    history.write.parquet(path)
    rows = raw_table(spark, d, "raw_internal_bv_iris").count()
    audit.append_load(
        spark, path, source_id="S12", source_name="map", file_name="f", minio_path="p", row_count=rows
    )
    audit.append_load(
        spark, path, source_id="S12", source_name="map", file_name="f", minio_path="p", status="FAILED",
        error_message="unreadable",
    )
    return audit.read_loads(spark, path).groupBy("source_id", "status").agg(
        F.count(F.lit(1)).alias("loads"), F.sum("row_count").alias("row_count")
    )


@query
def content_checksum(spark, d):
    """Digests of landed files, one per department, read back as bytes."""
    raw = raw_table(spark, d, "raw_filosofi_iris").select(
        F.left("iris", F.lit(1)).alias("part"), F.concat_ws(";", "iris", "disp_med21", "disp_tp6021", "disp_pimpot21").alias("line")
    )
    path = fresh_path(spark, "files")
    raw.repartition("part").sortWithinPartitions("part", "line").write.partitionBy("part").text(path)
    part = F.regexp_extract("path", "/part=([^/]*)/", 1)
    return containers.file_digests(spark, path).select(part.alias("part"), "checksum_md5", "file_size_bytes")


@query
def normalize_headers(spark, d):
    raw = raw_table(spark, d, "raw_rp_activite_iris")
    messy = raw.toDF("IRIS", "Pop 15-64 ans", "Pop. active", "Chômeurs", "Actifs occupés", "% inactifs",
                     "Emplois aidés", "emplois_AIDÉS")
    return tabular.normalize_headers(messy)


@query
def map_columns(spark, d):
    raw = raw_table(spark, d, "raw_internal_bv_iris")
    delivered = raw.toDF(" IRIS", "Lib IRIS", "Code bassin de vie", "Libelle bassin de vie ")
    return tabular.map_columns(delivered)


@query
def last_row_count(spark, d):
    return audit.last_row_count(raw_table(spark, d, "ingestion_log"))


@query
def ascii_fold(spark, d):
    return given(spark, d, "documents").select("doc_id", text.ascii_fold(F.col("text")).alias("folded"))


# --- projections and scalar functions ------------------------------------------------------------


@query
def normalize_area_code(spark, d):
    raw = raw_table(spark, d, "raw_internal_bv_iris")
    return raw.select("code_iris", codes.area_code(F.col("code_iris")).alias("iris_code"))


@query
def area_to_department(spark, d):
    raw = raw_table(spark, d, "raw_internal_bv_iris")
    return raw.select("code_iris", codes.department_of(F.col("code_iris")).alias("dep_code"))


@query
def area_to_commune(spark, d):
    raw = raw_table(spark, d, "raw_internal_bv_iris")
    return raw.select("code_iris", codes.commune_of(F.col("code_iris")).alias("com_code"))


@query
def nullify_secret(spark, d):
    raw = raw_table(spark, d, "raw_filosofi_iris")
    return raw.select(
        "iris",
        *(numbers.nullify_secret(c).alias(c) for c in ("disp_med21", "disp_tp6021", "disp_pimpot21")),
    )


@query
def safe_numeric(spark, d):
    raw = raw_table(spark, d, "raw_filosofi_iris")
    return raw.select(
        "iris",
        numbers.decimal_text("disp_med21").alias("median"),
        numbers.decimal_text("disp_tp6021", 5, 2).alias("poverty"),
    )


@query
def safe_numeric_lenient(spark, d):
    raw = raw_table(spark, d, "raw_internal_bv_iris")
    return raw.select(
        "lib_iris",
        numbers.decimal_text("lib_iris", strict=False).alias("from_label"),
        numbers.decimal_text("code_bv", strict=False).alias("from_code"),
    )


@query
def safe_int(spark, d):
    raw = raw_table(spark, d, "raw_bpe_iris")
    return raw.groupBy(numbers.int_or_zero(F.col("obs_value")).alias("value"), "obs_value").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def blank_decimal(spark, d):
    raw = raw_table(spark, d, "raw_passoires_energetiques_iris")
    return raw.select(
        "district",
        numbers.blank_decimal(F.col("nombre"), 14, 4).alias("nombre"),
        numbers.blank_decimal(F.col("taux"), 7, 4).alias("taux"),
    )


@query
def normalize_commune(spark, d):
    raw = raw_table(spark, d, "raw_passoires_energetiques_iris")
    return raw.select("district", codes.commune_code(F.col("city")).alias("com_code"))


@query
def clean_labels(spark, d):
    raw = raw_table(spark, d, "raw_bpe_iris")
    return raw.groupBy(
        codes.upper_code(F.col("facility_type")).alias("type_equip"),
        codes.upper_code(F.col("facility_dom")).alias("domaine"),
        codes.label(F.col("facility_type")).alias("label"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def derive_geography(spark, d):
    located = silver.located_areas(raw_table(spark, d, "raw_internal_bv_iris"))
    return silver.with_geography(located)


@query
def secrecy_flag(spark, d):
    raw = raw_table(spark, d, "raw_filosofi_iris")
    return raw.select("iris", silver.secrecy_flag().alias("flag_secret_statistique"))


@query
def labour_rates(spark, d):
    table = silver.clean_activity(raw_table(spark, d, "raw_rp_activite_iris"))
    return table.select("iris_code", "taux_chomage_pct", "taux_emploi_pct", "taux_activite_pct")


@query
def housing_rates(spark, d):
    table = silver.clean_housing(raw_table(spark, d, "raw_rp_logement_iris"))
    return table.select(
        "iris_code", "part_proprietaires_pct", "part_hlm_pct", "part_logements_avant_1971_pct"
    )


@query
def population_shares(spark, d):
    table = silver.clean_population(raw_table(spark, d, "raw_rp_population_iris"))
    return table.select("iris_code", "part_moins_25_ans_pct", "part_plus_65_ans_pct", "part_cadres_pct")


@query
def vacancy_rate(spark, d):
    table = silver.clean_housing(raw_table(spark, d, "raw_rp_logement_iris"))
    rate = numbers.percentage(F.col("nb_logements_vacants"), F.col("nb_logements_total"))
    return table.select("iris_code", rate.alias("taux_vacance_logements_pct"))


@query
def interdecile_ratio(spark, d):
    table = silver.clean_income(raw_table(spark, d, "raw_filosofi_iris"))
    return table.select("iris_code", gold.interdecile_ratio().alias("ratio_interdecile_d9d1"))


def _pillar_inputs(spark, d) -> DataFrame:
    """Areas with the indicators the environment and social scores use."""
    tables = layers(spark, d)
    measures = {
        "silver_rp_logement": (
            "nb_logements_total", "nb_logements_vacants", "part_logements_avant_1971_pct",
        ),
        "silver_passoires_energetiques": ("taux_passoires_energetiques_pct",),
        "silver_filosofi": ("revenu_median_uc", "taux_pauvrete_60"),
        "silver_rp_activite": ("taux_chomage_pct",),
    }
    parts = [
        silver.CLEANERS[name][1](tables.raw(silver.CLEANERS[name][0])).select("iris_code", *columns)
        for name, columns in measures.items()
    ]
    return keys.star(tables.table(AREAS).select("iris_code"), *parts)


@query
def clamped_scores(spark, d):
    col = F.col
    components = {
        "energy": scores.energy_component(col("taux_passoires_energetiques_pct")),
        "building_age": scores.building_age_component(col("part_logements_avant_1971_pct")),
        "vacancy": scores.vacancy_component(col("nb_logements_vacants"), col("nb_logements_total")),
        "unemployment": scores.unemployment_component(col("taux_chomage_pct")),
        "income": scores.income_component(col("revenu_median_uc")),
        "poverty": scores.poverty_component(col("taux_pauvrete_60")),
    }
    return _pillar_inputs(spark, d).select(
        "iris_code", *(numbers.rounded(c, 4).alias(n) for n, c in components.items())
    )


@query
def score_environment(spark, d):
    score = scores.environment_score(
        F.col("taux_passoires_energetiques_pct"), F.col("part_logements_avant_1971_pct"),
        F.col("nb_logements_vacants"), F.col("nb_logements_total"),
    )
    return _pillar_inputs(spark, d).select("iris_code", score.alias("score_env_0_100"))


@query
def score_social(spark, d):
    score = scores.social_score(
        F.col("taux_chomage_pct"), F.col("revenu_median_uc"), F.col("taux_pauvrete_60")
    )
    return _pillar_inputs(spark, d).select("iris_code", score.alias("score_social_0_100"))


def _service_panel(spark, d) -> DataFrame:
    tables = layers(spark, d)
    facilities = silver.clean_facilities(tables.raw("raw_bpe_iris"))
    return gold.service_panel(tables.table(AREAS), facilities, tables.communes)


@query
def score_health_access(spark, d):
    score = scores.health_access(F.col("nb_medecins_generalistes"), F.col("est_zrr"))
    return _service_panel(spark, d).select("iris_code", numbers.rounded(score, 4).alias("health_access"))


@query
def score_education_access(spark, d):
    score = scores.education_access(F.col("nb_ecoles_primaires"), F.col("nb_colleges_lycees"))
    return _service_panel(spark, d).select("iris_code", numbers.rounded(score, 4).alias("education_access"))


@query
def score_governance(spark, d):
    return _table(spark, d, "gold_indicateurs_g").select("iris_code", "score_gouvernance_0_100")


@query
def score_composite(spark, d):
    return _table(spark, d, MASTER).select("iris_code", "score_esg_0_100")


@query
def completeness(spark, d):
    return _table(spark, d, MASTER).select("iris_code", "pct_completude")


@query
def score_bands(spark, d):
    band = scores.score_band(F.col("score_esg_0_100"))
    return _table(spark, d, MASTER).select("iris_code", band.alias("tranche_score"))


# --- filters and joins ---------------------------------------------------------------------------


@query
def filter_valid_key(spark, d):
    return keys.valid_keys(raw_table(spark, d, "raw_internal_bv_iris"), "code_iris")


@query
def filter_commune_regex(spark, d):
    raw = raw_table(spark, d, "raw_zrr_communes")
    return raw.where(codes.is_commune_code(F.col("codgeo")))


@query
def join_perimeter(spark, d):
    income = silver.clean_income(raw_table(spark, d, "raw_filosofi_iris"))
    return keys.within_perimeter(income, _table(spark, d, AREAS)).select("iris_code", "revenu_median_uc")


@query
def join_star(spark, d):
    tables = layers(spark, d)
    housing = silver.clean_housing(tables.raw("raw_rp_logement_iris"))
    energy = silver.clean_energy(tables.raw("raw_passoires_energetiques_iris"))
    return keys.star(
        tables.table(AREAS).select("iris_code", "bv_code"),
        housing.select("iris_code", "nb_logements_total"),
        energy.select("iris_code", "taux_passoires_energetiques_pct"),
    )


@query
def join_commune_flag(spark, d):
    tables = layers(spark, d)
    areas = tables.table(AREAS).select("iris_code", "com_code")
    return keys.flag_by_commune(areas, tables.communes)


# --- aggregations and windows --------------------------------------------------------------------


@query
def facility_totals(spark, d):
    records = silver.facility_records(raw_table(spark, d, "raw_bpe_iris"))
    return records.groupBy("iris_code").agg(F.sum("nb_equipements").alias("nb_equipements_total"))


@query
def facility_measures(spark, d):
    records = silver.with_measure_numbers(silver.facility_records(raw_table(spark, d, "raw_bpe_iris")))
    measures = silver.facility_measures()
    return records.groupBy("iris_code").agg(*(c.alias(n) for n, c in measures.items()))


@query
def weighted_means(spark, d):
    return gold.roll_up(_table(spark, d, MASTER), gold.basin_means())


@query
def weighted_scores(spark, d):
    return gold.roll_up(_table(spark, d, MASTER), gold.basin_scores())


@query
def basin_averages(spark, d):
    return gold.roll_up(_table(spark, d, MASTER), gold.basin_averages())


@query
def basin_counts(spark, d):
    return gold.roll_up(_table(spark, d, MASTER), gold.basin_counts())


@query
def distinct_rollup(spark, d):
    """Distinct parts per nation from sketches stored per customer, beside the exact count and the sketches' bound."""
    owned = given(spark, d, "lineitem").join(given(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    owned = owned.join(given(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    per_area = stage(sketches.distinct_sketches(owned, ["c_nationkey", "c_custkey"], "l_partkey"), "sketches")
    merged = sketches.estimates(sketches.merged_sketches(per_area, ["c_nationkey"]))
    exact = owned.groupBy("c_nationkey").agg(F.count_distinct("l_partkey").alias("exact"))
    bound = F.col("exact") * (4 * sketches.relative_error())
    return exact.join(merged, "c_nationkey").select("c_nationkey", "exact", (F.abs(F.col("distinct") - F.col("exact")) <= bound).alias("within"))


@query
def facilities_within_perimeter(spark, d):
    """Facilities of stored areas, records from elsewhere dropped before they are summed."""
    tables = layers(spark, d)
    areas = stage(tables.table(AREAS).select("iris_code"), "areas")
    built = silver.build("silver_bpe", tables.raw("raw_bpe_iris"), areas, prefilter=True)
    return built.select("iris_code", "nb_equipements_total", "nb_equip_sante", "nb_medecins_generalistes")


@query
def zrr_communes(spark, d):
    return layers(spark, d).communes


@query
def master_metrics(spark, d):
    return reports.master_metrics(_table(spark, d, MASTER))


@query
def profile_columns(spark, d):
    return profile.profile(feature_table(spark, d), reports.FEATURES)


@query
def correlation(spark, d):
    return profile.correlation(_table(spark, d, MASTER), "taux_pauvrete_60", "taux_chomage_pct")


@query
def score_histogram(spark, d):
    return profile.histogram(_table(spark, d, MASTER), reports.PILLAR_SCORES)


@query
def score_medians(spark, d):
    return profile.medians(_table(spark, d, MASTER), reports.PILLAR_SCORES)


@query
def dedup_first(spark, d):
    located = silver.located_areas(raw_table(spark, d, "raw_internal_bv_iris"))
    order = [F.col(c).asc_nulls_last() for c in ("iris_label", "bv_code", "bv_label")]
    return keys.first_per_key(located, "iris_code", order)


@query
def percent_rank_panel(spark, d):
    panel = stage(_service_panel(spark, d).select("iris_code", "_presence"), "presence")
    ranked = with_percent_rank(panel, "_presence", key="iris_code", output="presence_rank")
    return ranked.select(
        "iris_code", F.col("_presence").alias("nb_equipements_total"), numbers.rounded(F.col("presence_rank"), 6)
        .alias("presence_rank"),
    )


# --- tables --------------------------------------------------------------------------------------

TABLE_QUERIES = {
    "silver_referential": AREAS,
    "silver_income": "silver_filosofi",
    "silver_population": "silver_rp_population",
    "silver_activity": "silver_rp_activite",
    "silver_housing": "silver_rp_logement",
    "silver_facilities": "silver_bpe",
    "silver_energy": "silver_passoires_energetiques",
    "gold_environment": "gold_indicateurs_e",
    "gold_social": "gold_indicateurs_s",
    "gold_governance": "gold_indicateurs_g",
    "gold_area_final": MASTER,
    "gold_basin_final": BASINS,
}
for _key, _name in TABLE_QUERIES.items():
    QUERIES[_key] = lambda spark, d, name=_name: portable(_table(spark, d, name))


@query
def audit_summary(spark, d):
    return audit.summary(raw_table(spark, d, "ingestion_log"))


def unbounded(rule: rules.Rule) -> rules.Rule:
    """The rule without bounds on size: the given tables grow, the published bounds do not."""
    if rule.kind == "row_count":
        return replace(rule, low=1, high=NO_BOUND)
    if rule.column in ("nb_equipements_total", "population_totale", "population_totale_bv"):
        return replace(rule, high=NO_BOUND)
    return rule


def _chain_options() -> dict:
    return {
        "as_of": datetime(2024, 1, 1),
        "suite": tuple(map(unbounded, rules.MASTER_SUITE)),
        "table_rules": {t: tuple(map(unbounded, rs)) for t, rs in rules.TABLE_RULES.items()},
    }


def _run_chain(spark, d, run_log: str | None = None, raw=raw_table, **options):
    return run_whole_chain(
        spark,
        lambda name: raw(spark, d, name),
        fresh_path(spark, "warehouse"),
        run_log=run_log,
        **_chain_options(),
        **options,
    )


def faulty_raw(spark, d, name: str) -> DataFrame:
    """Raw tables in which every tenth commune breaks a rule: no catchment, a poverty rate of 140, rows twice."""
    raw = raw_table(spark, d, name)
    commune = lambda code: F.left(F.right(F.trim(code), F.lit(5)), F.lit(1))
    if name == "raw_internal_bv_iris":
        return raw.withColumn("code_bv", F.when(commune("code_iris") != "7", F.col("code_bv")))
    if name == "raw_filosofi_iris":
        return raw.withColumn("disp_tp6021", F.when(commune("iris") == "3", "140").otherwise(F.col("disp_tp6021")))
    if name == "raw_rp_logement_iris":
        return raw.unionAll(raw.where(commune("iris") == "5"))
    return raw


@query
def gate_trips(spark, d):
    """Faulty tables: what the gate says and leaves unbuilt, and what quarantine splits off and keeps."""
    # Both runs read the same raw tables, which are written once.
    raw = cache(lambda *given: stage(faulty_raw(*given), given[-1]))
    try:
        _run_chain(spark, d, raw=raw)
        told = []
    except rules.QualityError as error:
        told = [("failed", t, f"{kind}:{column}", n) for t, kind, column, n in error.failed]
        told += [("not built", t, "", 0) for t in error.not_built]
    done = _run_chain(spark, d, raw=raw, quarantine=True)
    found = [
        rows.select(F.lit(t).alias("table_name"), F.explode("_broken").alias("rule"))
        for t, rows in done.quarantined.items()
    ]
    split = reduce(DataFrame.unionAll, found).groupBy("table_name", "rule").agg(F.count(F.lit(1)).alias("n"))
    kept = done.tables[MASTER].select(F.lit(MASTER).alias("table_name")).groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
    schema = "what string, table_name string, rule string, n long"
    return (
        spark.createDataFrame(told, schema)
        .unionByName(split.withColumn("what", F.lit("quarantined")))
        .unionByName(kept.withColumns({"what": F.lit("kept"), "rule": F.lit("")}))
    )


@query
def run_chain(spark, d):
    return _run_chain(spark, d).tables[BASINS].drop("dbt_updated_at")


@query
def run_log(spark, d):
    path = fresh_path(spark, "run_log")
    _run_chain(spark, d, path)
    return audit.read_model_runs(spark, path).select("model_name", "layer", "status", "rows_affected")


def _landed_spec(source_id: str):
    return replace(SOURCES[source_id], min_rows=1, max_rows=NO_BOUND)


def _ingest_paths(spark) -> dict[str, str]:
    root = fresh_path(spark, "ingest")
    return {k: f"{root}/{k}" for k in ("landing", "bronze", "log")}


def _load_outcome(spark, log: str, table: str) -> DataFrame:
    loaded = tabular.read_bronze(spark, table).agg(F.count(F.lit(1)).alias("bronze_rows"))
    logged = audit.read_loads(spark, log).select("source_id", "millesime", "status", "row_count")
    return logged.join(loaded, F.col("row_count") == F.col("bronze_rows"), "left")


@query
def ingest_job(spark, d):
    raw = raw_table(spark, d, "raw_filosofi_iris")
    path = fresh_path(spark, "S01")
    tabular.write_delimited(raw.toDF(*(c.upper() for c in raw.columns)), path)
    paths = _ingest_paths(spark)
    ingest_source(
        spark, _landed_spec("S01"), path, raw.columns, **paths, run_id="run", run_ts="20240101_000000"
    )
    return _load_outcome(spark, paths["log"], f"{paths['bronze']}/raw_filosofi_iris")


@query
def ingest_internal(spark, d):
    raw = raw_table(spark, d, "raw_internal_bv_iris")
    path = fresh_path(spark, "S12")
    delivered = raw.toDF("IRIS", "lib_iris", "Code Bassin de Vie", "Libelle Bassin de Vie")
    labelled = delivered.withColumn("lib_iris", F.concat(F.lit("Cité "), "lib_iris"))
    tabular.write_delimited(labelled, path, encoding=tabular.LATIN_1)
    paths = _ingest_paths(spark)
    ingest_catchment_map(
        spark, path, **paths, run_id="run", run_ts="20240101_000000", spec=_landed_spec("S12")
    )
    return tabular.read_bronze(spark, f"{paths['bronze']}/raw_internal_bv_iris")


def _delivered(spark, d, faulty: str | None = None) -> dict[str, Delivery]:
    """Files of every source; those of ``faulty`` lack a key column."""
    root = fresh_path(spark, "delivered")

    def deliver(source_id: str) -> Delivery:
        spec = SOURCES[source_id]
        raw = raw_table(spark, d, spec.table)
        if source_id == faulty:
            raw = raw.drop(spec.key_columns[-1].lower())
        if spec.internal:
            raw = raw.toDF("IRIS", "lib_iris", "Code Bassin de Vie", "Libelle Bassin de Vie")
        tabular.write_delimited(raw, f"{root}/{source_id}", spec.separator)
        return Delivery(f"{root}/{source_id}", raw.columns)

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return dict(zip(SOURCES, pool.map(inheritable_thread_target(spark)(deliver), SOURCES)))


def _run_from_files(spark, d, faulty: str | None = None):
    return run_from_files(
        spark, _delivered(spark, d, faulty), fresh_path(spark, "from_files"), "run", "20240101_000000",
        specs={s: _landed_spec(s) for s in SOURCES}, **_chain_options(),
    )


@query
def chain_from_files(spark, d):
    """Landed files of all sources to the catchment table, in one call."""
    return _run_from_files(spark, d)[1].tables[BASINS].drop("dbt_updated_at")


@query
def chain_without_a_source(spark, d):
    """One source fails: its loads and tables, and what is still built."""
    loads, done = _run_from_files(spark, d, faulty="S09")
    rows = [("source", s, r["status"], r.get("row_count")) for s, r in loads.items()]
    rows += [("table", t, "BUILT", n) for t, n in done.rows.items()] + [("table", t, "SKIPPED", None) for t in done.skipped]
    return spark.createDataFrame(rows, "what string, name string, status string, n long")


@query
def ingest_drift(spark, d):
    """Three loads of a source that shrinks by half: versions, drift notes and digests in the records."""
    raw = raw_table(spark, d, "raw_filosofi_iris")
    paths, spec = _ingest_paths(spark), _landed_spec("S01")
    for run, part in enumerate((raw, raw.withColumn("disp_d121", F.lit("1")), raw.where(F.col("iris").endswith("0000")))):
        path = fresh_path(spark, "S01")
        tabular.write_delimited(part, path)
        ingest_source(spark, spec, path, raw.columns, **paths, run_id="run", run_ts=f"2024010{run + 1}_000000")
    log = audit.read_loads(spark, paths["log"])
    return log.select(
        F.right("minio_path", F.lit(15)).alias("run_ts"), "row_count", "status", (F.length("checksum_md5") == 32).alias("digest"),
        (F.col("file_size_bytes") > 0).alias("sized"), "notes",
    )


# --- data quality --------------------------------------------------------------------------------

QUALITY_COLUMNS = ("table_name", "kind", "column_name", "evaluated", "violations", "success")


def _stored_tables(spark, d, *names: str) -> dict[str, DataFrame]:
    stored = layers(spark, d, stored=True)
    return {name: stored.table(name) for name in names or tuple(rules.TABLE_RULES)}


def _rule_results(spark, d, kind: str) -> DataFrame:
    tables = layers(spark, d)
    return rules.evaluate_tables({n: tables.table(n) for n in rules.TABLE_RULES}, kinds=(kind,)).select(*QUALITY_COLUMNS)


@query
def q_not_null(spark, d):
    return _rule_results(spark, d, "not_null")


@query
def q_unique(spark, d):
    return _rule_results(spark, d, "unique")


@query
def q_range(spark, d):
    return _rule_results(spark, d, "between")


# Every kind of rule once kept and once broken by the faulty tables.
FAULT_RULES = {
    AREAS: (
        rules.Rule("unique", "iris_code"), rules.Rule("unique", "bv_code"), rules.Rule("not_null", "iris_code"),
        rules.Rule("not_null", "bv_code"), rules.Rule("regex", "iris_code", pattern=r"^\d{9}$"),
        rules.Rule("regex", "com_code", pattern=r"[0-6]$"), rules.Rule("row_count", low=1, high=NO_BOUND),
        rules.Rule("row_count", low=0, high=0),
    ),
    "silver_filosofi": (
        rules.Rule("between", "revenu_median_uc", 0, 1_000_000), rules.Rule("between", "taux_pauvrete_60", 0, 100),
        rules.Rule("mean", "taux_pauvrete_60", 0, 1000), rules.Rule("mean", "taux_pauvrete_60", 0, 1),
    ),
}


@query
def q_broken_rules(spark, d):
    tables = Layers(lambda name: faulty_raw(spark, d, name))
    found = rules.evaluate_tables({n: tables.table(n) for n in FAULT_RULES}, FAULT_RULES)
    return found.select("table_name", "rule_no", "kind", "column_name", "evaluated", "violations", "success")


@query
def q_duplicates(spark, d):
    return rules.duplicates(silver.located_areas(raw_table(spark, d, "raw_internal_bv_iris")), "iris_code")


@query
def q_relationships(spark, d):
    tables = layers(spark, d)
    return rules.evaluate_references({n: tables.table(n) for n in (AREAS, "silver_filosofi", MASTER)})


@query
def q_suite(spark, d):
    return rules.evaluate(_table(spark, d, MASTER), rules.MASTER_SUITE)


def _suite_rule(spark, d, kind: str) -> DataFrame:
    chosen = [r for r in rules.MASTER_SUITE if r.kind == kind]
    return rules.evaluate(_table(spark, d, MASTER), chosen)


@query
def q_row_count(spark, d):
    return _suite_rule(spark, d, "row_count")


@query
def q_mean(spark, d):
    return _suite_rule(spark, d, "mean")


@query
def q_regex(spark, d):
    return _suite_rule(spark, d, "regex")


@query
def q_source_contract(spark, d):
    return reduce(
        DataFrame.unionByName,
        (contracts.contract_report(raw_table(spark, d, spec.table), spec) for spec in SOURCES.values()),
    )


@query
def q_row_drift(spark, d):
    drift = audit.row_count_drift(raw_table(spark, d, "ingestion_log"))
    return drift.withColumn("delta_pct", numbers.rounded(F.col("delta_pct"), 4))


@query
def q_freshness(spark, d):
    return audit.freshness(raw_table(spark, d, "ingestion_log"), FRESHNESS_DATE)


@query
def q_score_not_null(spark, d):
    master = _table(spark, d, MASTER)
    return rules.violations_of(master, F.col("score_esg_0_100").isNull(), "iris_code")


@query
def q_referential_complete(spark, d):
    tables = _stored_tables(spark, d, *SILVER_TABLES, MASTER)
    areas = tables.pop(AREAS)
    return keys.absent_from(areas, tables)


@query
def q_poverty_range(spark, d):
    return rules.out_of_range(_table(spark, d, MASTER), "taux_pauvrete_60", 0, 100, "iris_code")


# --- dashboards ----------------------------------------------------------------------------------


@query
def b1_score_by_basin(spark, d):
    return reports.score_by_basin(_table(spark, d, BASINS))


@query
def b2_score_distribution(spark, d):
    return reports.score_distribution(_table(spark, d, MASTER))


@query
def b3_bottom10(spark, d):
    return reports.most_fragile(_table(spark, d, MASTER))


@query
def b4_completeness(spark, d):
    return reports.completeness_by_basin(_table(spark, d, BASINS))


@query
def b5_pillars(spark, d):
    return reports.pillars_by_basin(_table(spark, d, BASINS))


@query
def b6_key_indicators(spark, d):
    return reports.key_indicators(_table(spark, d, MASTER))


@query
def b7_unemployment_social(spark, d):
    return reports.unemployment_and_social_score(_table(spark, d, MASTER))


@query
def b8_zrr_split(spark, d):
    return reports.rural_zone_split(_table(spark, d, MASTER))


@query
def feature_table(spark, d):
    tables = layers(spark, d)
    # The income table limits the areas; the others join to it from the left.
    others = ("silver_rp_activite", "silver_rp_population", "silver_rp_logement", "silver_bpe")
    cleaned = (silver.CLEANERS[n][1](tables.raw(silver.CLEANERS[n][0])) for n in others)
    return reports.feature_table(tables.table("silver_filosofi"), *cleaned)


@query
def ops_recent_loads(spark, d):
    return audit.recent_loads(raw_table(spark, d, "ingestion_log"))
