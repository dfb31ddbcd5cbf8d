"""A key holding a third of all rows stays exact and is spread over tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from skirmish.functions.ranking import blocked_row_number
from skirmish.operators import bans, graph


def hot_bans(n=30_000, seed=7):
    rng = np.random.default_rng(seed)
    champ = np.where(rng.random(n) < 1 / 3, "HOT", rng.choice([f"c{i}" for i in range(50)], n))
    return pd.DataFrame({"match_id": np.arange(n) // 3 + 1, "pos": np.arange(n) % 3 + 1, "champion": champ})


def test_running_count_exact_with_hot_key(spark):
    pdf = hot_bans()
    df = spark.createDataFrame(pdf)
    got = bans.running_ban_count(df, blocks=20).toPandas().sort_values(["match_id", "pos"])
    exp = pdf.sort_values(["match_id", "pos"]).assign(running=lambda x: x.groupby("champion").cumcount() + 1)
    assert got["running"].tolist() == exp["running"].tolist()


def test_hot_key_rows_spread_over_window_partitions(spark):
    pdf = hot_bans()
    df = spark.createDataFrame(pdf).repartition(8)
    # the window runs per (champion, block): count how many partitions hold hot rows.  AQE would
    # merge these small partitions into one, so coalescing is off while we look.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = blocked_row_number(df, ["champion"], ["match_id", "pos"], F.floor(F.col("match_id") / 500))
        per_part = (ranked.filter(F.col("champion") == "HOT").groupBy(F.spark_partition_id().alias("p"))
                    .count().toPandas())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = (pdf["champion"] == "HOT").sum()
    assert len(per_part) > 1 and per_part["count"].max() < hot  # no single task holds the hot key


def test_degrees_of_a_hub_vertex(spark):
    n = 20_000
    e = spark.range(n).select(F.lit(1).cast("bigint").alias("src_id"), (F.col("id") + 2).alias("dst_id"),
                              F.lit("a").alias("src_champ"), F.lit("b").alias("dst_champ"),
                              F.lit("Against").alias("side"))
    d = {r.id: (r.in_degree, r.out_degree) for r in graph.degrees(e).filter("id <= 3").collect()}
    assert d[1] == (0, n) and d[2] == (1, 0) and d[3] == (1, 0)


def test_edges_of_a_hot_match(spark):
    import datetime as dt
    from skirmish.operators import normalize
    from scripts.plan_report import final_plan
    from tests.util import match_model
    t0 = dt.datetime(2024, 1, 1)
    # match 1 holds most participants; the tracked player (1) appears twice, the last one wins
    parts = [(1, i, 100 + i, i % 7 + 1, 100 if i % 2 else 200) for i in range(1, 3000)]
    parts += [(1, 0, 1, 1, 100), (1, 3000, 1, 5, 200), (2, 0, 2, 2, 100), (2, 1, 3, 3, 200)]
    players = [(k, f"P{k}", k < 10) for k in range(1, 3200)]
    t = match_model(spark, [(1, t0, 10, 100, "Win", 200, "Fail", 1), (2, t0, 10, 100, "Fail", 200, "Win", 2)],
                    parts, players=players)
    edges = normalize.match_edges(t)
    assert edges.filter("match_id = 1").count() == 2999  # everyone but the tracked player's two seats
    assert {r.my_champion for r in edges.filter("match_id = 1").collect()} == {"Champ5"}
    # no window and no grouping by match alone: the join on match_id may be split
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    big = t.__class__(**{**t.__dict__, "participants": t.participants.repartition(8)})
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        plan = final_plan(normalize.match_edges(big))
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert "Window" not in plan
    assert "skew" in plan


def test_join_with_a_hub_spreads_without_adaptive_splitting(spark):
    from skirmish.operators.joins import heavy_keys, join_heavy
    n = 24_000
    rel = spark.range(n, numPartitions=8).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") % 997 + 100).alias("src_id"),
                                                 F.col("id").alias("dst_id"))
    dim = spark.range(0, 2000).select(F.col("id").alias("src_id"), F.concat(F.lit("P"), "id").alias("name"))
    assert heavy_keys(rel, "src_id", 0.05) == [7] and heavy_keys(rel.limit(0), "src_id") == []
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        size = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        plain, split = size(rel.join(dim, "src_id")), size(join_heavy(rel, dim, "src_id", 0.05))
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert sum(plain) == sum(split) == n // 3 * 2
    assert plain[-1] > n // 3 and split[-1] <= 3 * split[len(split) // 2]
    assert join_heavy(rel, dim, "src_id").exceptAll(rel.join(dim, "src_id")).count() == 0
