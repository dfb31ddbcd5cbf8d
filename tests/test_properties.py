"""Invariants on generated inputs (hypothesis) and on the driver tables."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skirmish import schemas
from skirmish.operators import bans, graph, marts, normalize, stats
from tests.util import rows

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

edge_rows = st.lists(st.tuples(st.integers(1, 6), st.integers(1, 6), st.sampled_from(["A", "B", "C"]),
                               st.sampled_from(["A", "B", "C"]), st.sampled_from(["Against", "Together"])),
                     min_size=0, max_size=25)


@SETTINGS
@given(edge_rows)
def test_degree_sums_equal_edge_count(spark, es):
    e = spark.createDataFrame(es, schemas.EDGE)
    d = graph.degrees(e).agg(F.sum("in_degree").alias("i"), F.sum("out_degree").alias("o")).first()
    assert (d.i or 0) == (d.o or 0) == len(es)


ban_rows = st.lists(st.tuples(st.integers(1, 30), st.integers(1, 5), st.sampled_from(["x", "y", "z"])),
                    min_size=0, max_size=40, unique_by=lambda r: (r[0], r[1]))


@SETTINGS
@given(ban_rows, st.integers(1, 7))
def test_running_count_max_is_total_and_order_invariant(spark, bs, block):
    mb = spark.createDataFrame(bs, "match_id long, pos int, champion string")
    run = bans.running_ban_count(mb, blocks=block)
    per = {r.champion: (r.mx, r.n) for r in run.groupBy("champion").agg(
        F.max("running").alias("mx"), F.count(F.lit(1)).alias("n")).collect()}
    assert all(mx == n for mx, n in per.values())
    totals = {r.champion: r.ban_count for r in bans.ban_counts(mb).collect()}
    assert {c: n for c, (_, n) in per.items()} == totals
    shuffled = spark.createDataFrame(list(reversed(bs)), "match_id long, pos int, champion string")
    assert rows(bans.running_ban_count(shuffled, blocks=block)) == rows(run)


match_rows = st.lists(st.tuples(st.integers(0, 3000), st.integers(0, 3000), st.sampled_from(["Red", "Blue"])),
                      min_size=1, max_size=30)


@SETTINGS
@given(match_rows)
def test_red_plus_blue_is_total_and_windows_cover_each_match_six_times(spark, ms):
    t0 = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(t0 + dt.timedelta(minutes=m), d, w) for m, d, w in ms],
                               "ts timestamp_ntz, game_duration long, winner string")
    ws = {r.side: r.wins for r in marts.win_share(ev).collect()}
    assert ws["Red Side"] + ws["Blue Side"] == len(ms)
    s = stats.sliding_stats(ev).agg(F.sum("tot_matches").alias("n"), F.sum("duration").alias("d")).first()
    assert s.n == 6 * len(ms) and s.d == 6 * sum(d for _, d, _ in ms)
    assert rows(stats.sliding_stats(ev)) == rows(stats.sliding_stats(ev.orderBy(F.rand(7))))


def test_edges_per_match_below_participants(spark, small_tables):
    e = normalize.match_edges(small_tables).groupBy("match_id", "my_id").count()
    p = small_tables.participants.groupBy("match_id").agg(F.count(F.lit(1)).alias("np"))
    bad = e.join(p, "match_id").filter(F.col("count") > F.col("np") - 1)
    assert bad.count() == 0
