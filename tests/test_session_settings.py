"""Settings that hold while a job runs, and raw tables that two runs share."""

from __future__ import annotations

from collections import Counter

import pytest
from areascore import catalog
from areascore.plans.chain import run_chain
from areascore.session import BROADCAST_SETTING, MEASURED_SETTING, METHOD_SETTING, measured_broadcasts
from conftest import plan_of

SMALL = "/root/testdata/sf0.001"


def test_gate_trips_builds_each_raw_table_once(spark, monkeypatch):
    built, limits, original = Counter(), set(), catalog.faulty_raw

    def counted(spark, d, name):
        built[name] += 1
        limits.add(spark.conf.get(METHOD_SETTING))
        return original(spark, d, name)

    monkeypatch.setattr(catalog, "faulty_raw", counted)
    before = spark.conf.get(METHOD_SETTING)
    found = catalog.gate_trips(spark, SMALL).collect()
    assert {r.what for r in found} == {"failed", "not built", "quarantined", "kept"}
    assert len(built) == 8 and set(built.values()) == {1}
    assert limits == {"8000"} and spark.conf.get(METHOD_SETTING) == before


class Seen(Exception):
    pass


def test_many_rows_in_small_files_are_not_broadcast_by_the_chain(spark, tmp_path):
    plans, sizes = [], {"many": 400_000, "few": 400}
    for name, n in sizes.items():
        spark.range(n).selectExpr("lpad(id, 9, '0') AS k", "id % 10 AS v").repartition(1).sortWithinPartitions("k").write.parquet(str(tmp_path / name))
    files = [f.stat().st_size for f in (tmp_path / "many").glob("part-*")]
    assert 1 << 19 < sum(files) < 10 << 20
    read = lambda name: spark.read.parquet(str(tmp_path / name))

    def raw(name):
        plans.extend(plan_of(read("many").alias("a").join(read(side).select("k"), "k", "left_semi")) for side in sizes)
        found = read("many").join(read("many").groupBy("k").count(), "k")
        plans.append((found.count(), found._jdf.queryExecution().executedPlan().toString()))
        raise Seen

    before = [spark.conf.get(x, None) for x in (BROADCAST_SETTING, MEASURED_SETTING)]
    with pytest.raises(Seen):
        run_chain(spark, raw, str(tmp_path / "root"))
    assert "Broadcast" not in plans[0] and "BroadcastHashJoin" in plans[1]
    # 400 000 rows take more than 10 MB as rows, so that they are not broadcast once they are measured either.
    assert plans[2][0] == 400_000 and "Broadcast" not in plans[2][1]
    assert [spark.conf.get(x, None) for x in (BROADCAST_SETTING, MEASURED_SETTING)] == before


def test_a_lower_limit_of_the_session_is_kept(spark):
    spark.conf.set(BROADCAST_SETTING, "-1")
    try:
        with measured_broadcasts(spark):
            assert (spark.conf.get(BROADCAST_SETTING), spark.conf.get(MEASURED_SETTING)) == ("-1", "-1")
    finally:
        spark.conf.unset(BROADCAST_SETTING)
