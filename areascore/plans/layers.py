"""Named tables: which plan builds a table, and from which other tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from areascore.operators.keys import flagged_communes
from areascore.plans import gold, silver
from areascore.sources.storage import stage


_AREAS = "silver_referentiel_iris"
#: What each table is built from: raw tables and other tables.
INPUTS: dict[str, tuple[str, ...]] = {
    _AREAS: ("raw_internal_bv_iris",),
    **{name: (raw, _AREAS) for name, (raw, _) in silver.CLEANERS.items()},
    "gold_indicateurs_e": (_AREAS, "silver_rp_logement", "silver_passoires_energetiques"),
    "gold_indicateurs_s": (_AREAS, "silver_filosofi", "silver_rp_population", "silver_rp_activite"),
    "gold_indicateurs_g": (_AREAS, "silver_bpe", "raw_zrr_communes"),
    "gold_esg_iris_final": (_AREAS, "gold_indicateurs_e", "gold_indicateurs_s", "gold_indicateurs_g"),
    "gold_esg_bassin_vie_final": ("gold_esg_iris_final",),
}


def raw_inputs(table: str) -> frozenset[str]:
    """The raw tables a table depends on, directly or through others."""
    if table not in INPUTS:
        return frozenset([table])
    return frozenset().union(*map(raw_inputs, INPUTS[table]))


def level(table: str) -> int:
    """How many tables of the chain stand on one another up to this one; a raw table is at 0."""
    return 1 + max(map(level, INPUTS[table])) if table in INPUTS else 0


class Layers:
    """Silver and gold tables over a set of raw tables.

    ``raw`` maps a raw table name to its DataFrame. With ``stored=True`` each table is written once to the
    shared folder and read from there by everything that follows, as the layers are in production; else
    the tables stay lazy plans and only the panel that is read twice is written.
    """

    def __init__(
        self,
        raw: Callable[[str], DataFrame],
        stored: bool = False,
        store: Callable[[DataFrame, str], DataFrame] = stage,
    ):
        self._raw = raw
        self._stored = stored
        self._store = store
        self._tables: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return self._raw(name)

    @cached_property
    def communes(self) -> DataFrame:
        return flagged_communes(self.raw("raw_zrr_communes"))

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            built = self._build(name)
            self._tables[name] = self._store(built, name) if self._stored else built
        return self._tables[name]

    def _store_panel(self, panel: DataFrame) -> DataFrame:
        return self._store(panel, "service_panel")

    def _measures(self, name: str) -> DataFrame:
        """Silver measures for a left join from the areas, which makes the perimeter filter redundant."""
        if self._stored:
            return self.table(name)
        raw, clean = silver.CLEANERS[name]
        return clean(self.raw(raw))

    def _build(self, name: str) -> DataFrame:
        if name == "silver_referentiel_iris":
            return silver.referential(self.raw("raw_internal_bv_iris"))
        if name == "gold_esg_bassin_vie_final":
            return gold.basin_final(self.table("gold_esg_iris_final"))
        areas = self.table("silver_referentiel_iris")
        if name in silver.CLEANERS:
            return silver.build(name, self.raw(silver.CLEANERS[name][0]), areas, prefilter=self._stored)
        if name == "gold_indicateurs_e":
            return gold.environment(
                areas,
                self._measures("silver_rp_logement"),
                self._measures("silver_passoires_energetiques"),
            )
        if name == "gold_indicateurs_s":
            return gold.social(
                areas,
                self._measures("silver_filosofi"),
                self._measures("silver_rp_population"),
                self._measures("silver_rp_activite"),
            )
        if name == "gold_indicateurs_g":
            return gold.governance(
                areas, self._measures("silver_bpe"), self.communes, self._store_panel
            )
        if name == "gold_esg_iris_final":
            if self._stored:
                pillars = ("gold_indicateurs_e", "gold_indicateurs_s", "gold_indicateurs_g")
                return gold.area_master_from_pillars(areas, *(self.table(p) for p in pillars))
            return gold.area_master(
                areas,
                housing=self._measures("silver_rp_logement"),
                energy=self._measures("silver_passoires_energetiques"),
                income=self._measures("silver_filosofi"),
                population=self._measures("silver_rp_population"),
                activity=self._measures("silver_rp_activite"),
                facilities=self._measures("silver_bpe"),
                communes=self.communes,
                store=self._store_panel,
            )
        raise KeyError(f"no table named {name}")
