"""Plan-shape checks: the physical plans we rely on for scale."""

from __future__ import annotations

import re

import pytest

from skirmish.plans.queries import REGISTRY
from tests.conftest import SF_SMALL
from scripts.plan_report import EagerWrites, census, final_plan
from tests.util import executed_plan

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cartesian_or_nested_loop(spark, name):
    """Neither in the result's plan nor in that of anything the query writes on the way."""
    with EagerWrites() as eager:
        df = REGISTRY[name](spark, SF_SMALL)
    for plan in [*eager.plans, executed_plan(df)]:
        for bad in BAD:
            assert bad not in plan, f"{name} plans a {bad}"


def test_report_keeps_the_main_plan_behind_a_subquery(spark):
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, "-1")
    try:
        c = census(final_plan(REGISTRY["banned_subgraph"](spark, SF_SMALL)))
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
    assert c["scan"] >= 4 and c["SMJ"] >= 4  # the subquery alone has fewer


def test_top_k_is_take_ordered(spark):
    plan = executed_plan(REGISTRY["top_banned"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = executed_plan(REGISTRY["normalize_match_event"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # the tracked-player predicate is evaluated at the scan, and only the used columns are read
    assert "PushedFilters: [IsNotNull(o_custkey)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double," \
           "o_orderdate:timestamp_ntz>" in plan
    assert "o_orderpriority" not in plan


def test_degrees_one_shuffle_for_both_directions(spark):
    from skirmish.operators import graph
    from skirmish import schemas
    e = spark.createDataFrame([(1, 2, "a", "b", "Against")] * 3, schemas.EDGE)
    plan = executed_plan(graph.degrees(e))
    assert plan.count("Exchange hashpartitioning") == 1


def test_banned_filter_needs_no_join(spark):
    df = REGISTRY["banned_subgraph"](spark, SF_SMALL)
    plan = executed_plan(df)
    # the top-k list is one inlined subquery value; the edge scan itself is not joined
    assert "arrays_overlap" in plan and "ExistenceJoin" not in plan


def test_running_count_needs_no_window_over_the_bans(spark):
    plan = executed_plan(REGISTRY["ban_running_count"](spark, SF_SMALL))
    assert "row_number()" not in plan  # places come from sorted range partitions; the only window runs over (champion, part) counts


def test_match_list_slices_shuffle_the_games_once(spark):
    plan = census(final_plan(REGISTRY["match_list_slice"](spark, SF_SMALL)))
    assert plan["shuffle"] == 1 and plan["SMJ"] + plan["SHJ"] + plan["BHJ"] == 0


def test_bucketed_matches_are_not_shuffled_again(spark):
    """Edges and nested events of loaded match tables: no exchange, even where nothing may be broadcast."""
    from skirmish.plans.queries import _match_store
    store = _match_store(spark, SF_SMALL)
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, "-1")
    try:
        for df in (store.edges(), store.events()):
            plan = executed_plan(df)
            assert "Exchange" not in plan and "Bucketed: true" in plan
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
