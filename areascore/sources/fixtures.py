"""Raw tables derived from the given star schema, as text every column.

One customer stands for one area, one nation for one catchment and one line item for one facility record.
The SQL is plain enough to run in any engine, so the checks read the very same inputs. ``{customer}`` and
the other braces are the given tables.

Area codes have four digits for the area within a commune. When there are more customers than codes,
several customers share a code and are merged into one area by summing (``terr``), so a raw table never
holds an area twice except where that is the point of the test row.

No row is left out: where a source does not cover an area, its row carries a code outside the referential
(``_coded``), which the perimeter join has to drop.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_SCHEMAS: dict[tuple[str, str], StructType] = {}
GIVEN_TABLES = ("customer", "nation", "region", "orders", "lineitem")


def _text(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR(20))"


def _cycle(step: int, modulus: int, start: int = 0) -> str:
    """Deterministic pseudo-values of an area, as text."""
    base = f"{start}+" if start else ""
    return _text(f"{base}(k*{step})%{modulus}")


def _columns(spec: Mapping[str, tuple[int, int]]) -> str:
    return ", ".join(f"{_cycle(step, modulus)} AS {name}" for name, (step, modulus) in spec.items())


def _coded(outside: str) -> str:
    """Area code, moved beyond all codes of the referential where ``outside`` holds."""
    return f"CASE WHEN {outside} THEN {_text('CAST(code AS BIGINT)+700000000')} ELSE code END"


VIEWS: dict[str, str] = {}

VIEWS["owner"] = f"""
SELECT c_custkey AS k, c_nationkey AS n, c_custkey%200 AS com,
  {_text("CAST((c_nationkey+1)*10000000 + (c_custkey%200)*10000 + CAST((c_custkey - c_custkey%200)/200 AS BIGINT)%10000 AS BIGINT)")} AS code
FROM {{customer}}"""

VIEWS["terr"] = """
SELECT CAST(sum(k) AS BIGINT) AS k, min(n) AS n, min(com) AS com, count(*) AS customers, code FROM owner GROUP BY code"""

VIEWS["raw_internal_bv_iris"] = f"""
SELECT code AS code_iris, concat('IRIS ',code) AS lib_iris, {_text("n")} AS code_bv, concat(' ',n_name) AS lib_bv
FROM terr JOIN {{nation}} ON n=n_nationkey
UNION ALL
SELECT concat(' ',code), concat('ZZ ',code), {_text("n")}, n_name
FROM terr JOIN {{nation}} ON n=n_nationkey WHERE k%50=0
UNION ALL
SELECT '  ', 'blank', '0', 'blank' FROM {{region}}"""

VIEWS["raw_filosofi_iris"] = f"""
SELECT {_coded("k%10=9")} AS iris,
  CASE k%7 WHEN 0 THEN 's' WHEN 1 THEN ' nd '
    ELSE concat({_cycle(37, 30000, 8000)},',',lpad({_text("k%100")},2,'0')) END AS disp_med21,
  CASE k%7 WHEN 0 THEN 'S' WHEN 2 THEN 'N.D.'
    ELSE concat({_cycle(13, 55)},'.',{_text("k%10")}) END AS disp_tp6021,
  {_cycle(17, 9000, 4000)} AS disp_d121, {_cycle(29, 40000, 20000)} AS disp_d921,
  {_cycle(23, 15000, 7000)} AS disp_q121, {_cycle(31, 25000, 14000)} AS disp_q321,
  CASE WHEN k%14=0 THEN 'ns' ELSE {_cycle(17, 98)} END AS disp_pimpot21
FROM terr"""

VIEWS["raw_rp_activite_iris"] = f"""
SELECT {_coded("k%11=5")} AS iris, {_cycle(7, 1900, 100)} AS p22_pop1564,
  CASE WHEN k%23=0 THEN '0' ELSE concat({_cycle(5, 1500, 80)},'.',{_text("k%1000")}) END AS p22_act1564,
  {_columns({"p22_chom1564": (3, 79), "p22_actocc1564": (4, 1200), "p22_inact1564": (9, 400),
             "p22_sal15p_empaid": (7, 30), "p22_nsal15p": (11, 120)})}
FROM terr"""

# Facility type by part number modulo 14.
_TYPES = ("A206", "a207 ", "A208", "A301", "B101", "B201", "C101", "C201", "D101", "E107", "F116", "G101",
          "E201", "F201")
_TYPE_CASE = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_TYPES))

VIEWS["raw_bpe_iris"] = f"""
SELECT {_coded("k%13=4")} AS geo, t.ty AS facility_type, substring(t.ty,1,1) AS facility_dom,
  CASE WHEN l_linenumber=7 THEN '' ELSE {_text("CAST(l_quantity AS INT)%4")} END AS obs_value
FROM (SELECT l_orderkey, l_linenumber, l_quantity, CASE l_partkey%14 {_TYPE_CASE} END AS ty
      FROM {{lineitem}}) t
JOIN {{orders}} ON t.l_orderkey=o_orderkey JOIN owner ON o_custkey=k"""

# Communes outside the zone have a code of no commune.
_ZONE = "(n+1)*1000+com + CASE WHEN com%3=0 THEN 0 ELSE 70000 END"

VIEWS["raw_zrr_communes"] = f"""
SELECT DISTINCT CASE WHEN com%2=0 THEN lpad({_text(_ZONE)},5,'0')
  ELSE {_text(_ZONE)} END AS codgeo
FROM owner"""

VIEWS["ingestion_log"] = f"""
SELECT concat('S',lpad({_text("o_orderkey%8+1")},2,'0')) AS source_id,
  concat('src ',{_text("o_orderkey%8+1")}) AS source_name, {_text("year(o_orderdate)")} AS millesime,
  CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'SUCCESS' ELSE 'PARTIAL' END AS status,
  CAST(o_custkey AS INT) AS row_count, o_orderkey*100 AS file_size_bytes, o_orderdate AS ingested_at
FROM {{orders}}"""

VIEWS["raw_rp_population_iris"] = f"""
SELECT {_coded("k%12=7")} AS iris,
  CASE WHEN k%37=0 THEN '0' WHEN k%41=0 THEN 'nc'
    ELSE concat({_cycle(19, 4800, 200)},'.',{_text("k%1000")}) END AS p22_pop,
  CASE WHEN k%29=0 THEN '' ELSE {_cycle(7, 80)} END AS p22_pop0610,
  {_columns({"p22_pop0002": (3, 60), "p22_pop0305": (5, 70), "p22_pop1117": (11, 90),
             "p22_pop1824": (13, 95), "p22_pop6579": (17, 300), "p22_pop80p": (23, 150),
             "p22_pop2539": (29, 700), "p22_pop4054": (31, 720), "p22_pop5564": (37, 500),
             "c22_pop15p_stat_gsec11_21": (3, 12), "c22_pop15p_stat_gsec12_22": (5, 60),
             "c22_pop15p_stat_gsec13_23": (7, 140), "c22_pop15p_stat_gsec14_24": (11, 200),
             "c22_pop15p_stat_gsec15_25": (13, 260), "c22_pop15p_stat_gsec16_26": (17, 230),
             "c22_pop15p_stat_gsec32": (19, 400), "c22_pop15p_stat_gsec40": (23, 180)})}
FROM terr"""

VIEWS["raw_rp_logement_iris"] = f"""
SELECT {_coded("k%15=2")} AS iris,
  CASE WHEN k%31=0 THEN '0' ELSE {_cycle(11, 2600, 120)} END AS p22_log,
  CASE WHEN k%31=0 THEN '0' ELSE {_cycle(11, 2300, 100)} END AS p22_rp,
  CASE WHEN k%19=0 THEN 'nd' ELSE {_cycle(7, 110)} END AS p22_logvac,
  CASE WHEN k%17=0 THEN 's' ELSE {_cycle(5, 29)} END AS p22_rp_ach1970,
  {_columns({"p22_rp_prop": (5, 90), "p22_rp_lochlmv": (3, 40), "p22_rp_ach1919": (2, 33),
             "p22_rp_ach1945": (3, 31), "p22_rsecocc": (3, 80), "p22_rp_loc": (7, 70),
             "p22_rp_grat": (2, 9), "p22_rp_ach1990": (5, 35), "p22_rp_ach2005": (7, 37),
             "p22_rp_ach2019": (9, 39), "p22_rp_1p": (2, 20), "p22_rp_2p": (3, 40),
             "p22_rp_3p": (5, 60), "p22_rp_4p": (7, 80), "p22_rp_5pp": (11, 90)})}
FROM terr"""

VIEWS["raw_passoires_energetiques_iris"] = f"""
SELECT {_coded("k%4=3")} AS district, {_text("(n+1)*1000+com")} AS city, concat(' Commune ',{_text("com")}) AS city_name,
  {_text("n+1")} AS department, concat({_cycle(7, 300)},'.',{_text("k%10000")}) AS nombre,
  CASE WHEN k%21=0 THEN ' ' ELSE concat({_cycle(3, 60)},'.',{_text("k%1000")}) END AS taux,
  {_cycle(11, 2300, 100)} AS total
FROM terr"""


def needed_views(sql: str, views: Mapping[str, str]) -> list[str]:
    """Names of the views a statement reads, directly or through other views, in definition order."""
    needed: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name in views:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(views[name])
    return [name for name in views if name in needed]


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table. Its schema is read once per session: each reading costs a job."""
    path = f"{sf_dir}/{table}.parquet"
    known = (spark.sparkContext.applicationId, path)
    if known not in _SCHEMAS:
        _SCHEMAS[known] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[known]).parquet(path)


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw table as a lazy plan over the given tables."""
    names = [*needed_views(VIEWS[name], VIEWS), name]
    ctes = ", ".join(f"{n} AS ({VIEWS[n]})" for n in dict.fromkeys(names))
    statement = f"WITH {ctes} SELECT * FROM {name}"
    used = [t for t in GIVEN_TABLES if "{" + t + "}" in statement]
    return spark.sql(statement, **{t: given(spark, sf_dir, t) for t in used})
