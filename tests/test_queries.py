"""Every query of the catalogue: same rows as its SQL, and a plan fit for large data."""

import re

import pytest
from compare import check, connect

import __spark_entry__ as entry_point
from spanbill.catalog.oracle import oracle_sql
from spanbill.catalog.queries import QUERIES

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) <= set(entry_point.queries())


def gathered(plan: str) -> list[str]:
    """Exchanges into one task, other than the last step of a global aggregate.

    A global aggregate (a scalar over the calendar) moves one row per task.
    """
    lines = plan.splitlines()
    return [
        line
        for line, below in zip(lines, [*lines[1:], ""])
        if "SinglePartition" in line and not re.search(r"Aggregate\(keys?=\[\], functions=\[partial_", below)
    ]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    plans = []

    def job(session, folder):
        df = QUERIES[name](session, folder)
        made = [df, *(plan for same in df.stages.known.values() for plan, _, _ in same)]  # the result and all stages behind it
        plans.extend(x._jdf.queryExecution().executedPlan().toString() for x in made)
        return df

    assert check(spark, con, sf_dir, name, job, ORACLE[name]) is None
    for plan in plans:
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas"):
            assert bad not in plan, plan
        assert gathered(plan) == []


@pytest.mark.parametrize(
    "name",
    ["next_exit_asof", "detail_enroll_numbered", "next_transition", "earliest_end", "interval_merge", "interval_dedupe_number", "interval_clip",
     "exit_reason_attach", "exit_reasons_all", "same_start_repair", "asof_district", "asof_coach", "build_intervals", "current_state"],
)
def test_query_with_hot_people(spark, con, sf_dir, name):
    spark.conf.set("spark.spanbill.hotKeyRows", "65")
    try:
        assert check(spark, con, sf_dir, name, QUERIES[name], ORACLE[name]) is None
    finally:
        spark.conf.unset("spark.spanbill.hotKeyRows")


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
