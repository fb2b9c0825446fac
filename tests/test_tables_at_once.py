"""Tables that do not depend on one another are built at the same time, and reported in their order."""

from __future__ import annotations

from threading import Barrier

from areascore import catalog
from areascore.plans.chain import run_chain
from areascore.plans.layers import level
from areascore.quality import audit
from areascore.settings import GOLD_TABLES, SILVER_TABLES
from areascore.sources.fixtures import raw_table

SMALL = "/root/testdata/sf0.001"


def test_levels():
    assert level("raw_bpe_iris") == 0 and level("silver_referentiel_iris") == 1 and level("gold_indicateurs_s") == 3
    assert level("gold_esg_bassin_vie_final") == 5


def test_two_tables_meet(spark, tmp_path):
    both = Barrier(2)

    def raw(name):
        if name in ("raw_filosofi_iris", "raw_rp_population_iris"):
            both.wait(timeout=60)
        return raw_table(spark, SMALL, name)

    log = str(tmp_path / "log")
    done = run_chain(spark, raw, str(tmp_path / "root"), run_log=log, **catalog._chain_options())
    order = [*SILVER_TABLES, *GOLD_TABLES]
    assert list(done.tables) == order and list(done.rows) == order
    logged = audit.read_model_runs(spark, log).collect()
    assert sorted(r.model_name for r in logged) == sorted(order) and {r.status for r in logged} == {"SUCCESS"}
