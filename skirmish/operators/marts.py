"""Reporting marts: what the dashboard shows, as DataFrames.

* top bans for the chart (k = 15, ascending display order),
* average game length in minutes with its delta to a 25-minute reference,
* win share per side.

``source="matches"`` (default) computes from match events, each match once.
``source="slots"`` sums the rows of the sliding statistics table instead, as
the dashboard does; overlapping windows then count a match up to six times,
so totals are inflated while ratios stay weighted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bans import TOP_CHART, top_banned

# Fixed value: reference game length of the dashboard indicator, minutes.
LENGTH_REFERENCE_MIN = 25


def top_bans_chart(ban_count: DataFrame, k: int = TOP_CHART) -> DataFrame:
    """Top-k bans in the chart's ascending order; ``chart_pos`` numbers the bars from 1."""
    order = [F.asc("ban_count"), F.desc("champion")]
    top = top_banned(ban_count, k)  # k rows
    return top.withColumn("chart_pos", F.row_number().over(Window.orderBy(*order)).cast("bigint")).orderBy("chart_pos")


def _totals(df: DataFrame, source: str) -> DataFrame:
    if source == "matches":
        return df.agg(F.sum("game_duration").cast("bigint").alias("total_length"),
                      F.count(F.lit(1)).alias("total_matches"),
                      F.count_if(F.col("winner") == "Red").alias("red_wins"))
    if source == "slots":
        return df.agg(F.sum("duration").cast("bigint").alias("total_length"),
                      F.sum("tot_matches").cast("bigint").alias("total_matches"),
                      F.sum("red_win").cast("bigint").alias("red_wins"))
    raise ValueError(f"unknown source {source!r}")


def avg_length(df: DataFrame, source: str = "matches") -> DataFrame:
    """(total_length, total_matches, avg_min, delta_min); null average when empty."""
    t = _totals(df, source)
    avg = F.round(F.try_divide(F.col("total_length").cast("double"), F.col("total_matches")) / 60, 6)
    return t.select("total_length", "total_matches", avg.alias("avg_min"),
                    F.round(avg - LENGTH_REFERENCE_MIN, 6).alias("delta_min"))


def win_share(df: DataFrame, source: str = "matches") -> DataFrame:
    """Two rows: ('Red Side', wins, share), ('Blue Side', total - red, share)."""
    t = _totals(df, source)
    rows = t.select("total_matches", F.expr(
        "stack(2, 'Red Side', red_wins, 'Blue Side', total_matches - red_wins) AS (side, wins)"))
    return rows.select("side", F.col("wins").cast("bigint").alias("wins"),
                       F.round(F.try_divide(F.col("wins").cast("double"), F.col("total_matches")), 6)
                       .alias("share"))
