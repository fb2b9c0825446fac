"""Source records, vintages and published names: configuration as data."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SourceSpec:
    """What is known about one landed source before it is read."""

    source_id: str
    table: str
    label: str
    vintage: str
    file_format: str
    key_columns: tuple[str, ...]
    min_rows: int
    max_rows: int
    pillar: str
    separator: str = ";"
    encoding: str = "utf-8"
    layer: str | None = None
    member_pattern: str | None = None
    licence: str = "Etalab 2.0"
    internal: bool = False
    multiline: bool = False  # quoted cells may hold line breaks; such a file is not split


# Source ids, vintages, formats, key columns and row bounds.
SOURCES = {
    spec.source_id: spec
    for spec in (
        SourceSpec("S01", "raw_filosofi_iris", "Disposable income and poverty", "2021", "csv",
                   ("IRIS", "DISP_MED21", "DISP_TP6021"), 15_000, 60_000, "S"),
        SourceSpec("S02", "raw_rp_population_iris", "Census population", "2022", "zip_csv",
                   ("IRIS", "P22_POP"), 45_000, 70_000, "S"),
        SourceSpec("S03", "raw_rp_activite_iris", "Census labour market", "2022", "zip_csv",
                   ("IRIS", "P22_ACT1564", "P22_CHOM1564"), 45_000, 70_000, "S"),
        SourceSpec("S04", "raw_rp_logement_iris", "Census housing", "2022", "zip_csv",
                   ("IRIS", "P22_RP", "P22_RP_PROP"), 45_000, 70_000, "E"),
        SourceSpec("S05", "raw_bpe_iris", "Facilities", "2024", "zip_csv",
                   ("GEO", "FACILITY_TYPE", "OBS_VALUE"), 1_000_000, 4_000_000, "G"),
        SourceSpec("S09", "raw_passoires_energetiques_iris", "Energy sieves", "2022", "gpkg",
                   ("district", "nombre", "taux"), 30_000, 100_000, "E", separator=",",
                   layer="districts_with_result_final"),
        SourceSpec("S11", "raw_zrr_communes", "Rural revitalisation communes", "2021", "xls",
                   ("CODGEO",), 10_000, 50_000, "G", separator=","),
        SourceSpec("S12", "raw_internal_bv_iris", "Catchment map", "v1", "csv",
                   ("code_iris", "code_bv"), 100, 60_000, "referentiel",
                   licence="internal", internal=True),
    )
}

MODEL_VERSION = "1.0"

# Vintage label written into each silver table.
VINTAGES = {
    "silver_filosofi": "2021",
    "silver_rp_population": "2022",
    "silver_rp_activite": "2022",
    "silver_rp_logement": "2022",
    "silver_bpe": "2024",
    "silver_passoires_energetiques": "2022",
}

SILVER_TABLES = (
    "silver_referentiel_iris",
    "silver_filosofi",
    "silver_rp_population",
    "silver_rp_activite",
    "silver_rp_logement",
    "silver_bpe",
    "silver_passoires_energetiques",
)
GOLD_TABLES = (
    "gold_indicateurs_e",
    "gold_indicateurs_s",
    "gold_indicateurs_g",
    "gold_esg_iris_final",
    "gold_esg_bassin_vie_final",
)
