"""Match model derived from the driver's TPC-H-like tables.

Mapping (fixed by the test fixtures): an order is a match seen from its
customer, who is the tracked player and participant 0; each line item is one
more participant (its part key is the player, its supplier key the champion)
and one ban.  Part brands are champion names, customers are players.

Everything here is a lazy DataFrame.  Line items are shuffled once by order
key: the semi-join with the tracked matches and the de-duplicating group-by on
(order, line number) share that partitioning (when the join is not
broadcast), and bans and participants are two projections of the same
aggregate, so a plan that needs both reuses the line-item exchange.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping.
TRACKED_MODULUS = 5          # a customer is tracked when key % 5 < 2
TRACKED_BELOW = 2
UNKNOWN_CHAMPION_MODULUS = 10  # parts with size % 10 = 0 are not in the champion list
BLUE_SIDE = 100
RED_SIDE = 200
NO_BAN_KEY = -1              # a line with quantity 1 bans nobody
BAN_KEY_OFFSET = 7           # otherwise the ban is supplier key + 7


@dataclass(frozen=True)
class MatchTables:
    """The flat match model: every frame is keyed by match_id except the dims."""

    champions: DataFrame     # champion_key, champion
    players: DataFrame       # player_key, player_name, tracked
    matches: DataFrame       # match_id, ts, game_duration, side0, win0, side1, win1 [, tracked_key]
    match_list: DataFrame | None  # player_key (tracked player), match_id; None when matches
                                  # carry the tracked player themselves (tracked_key)
    participants: DataFrame  # match_id, participant_id, player_key, champion_key, team_id
    bans: DataFrame          # match_id, pos, champion_key


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def is_tracked(key: Column) -> Column:
    return (key % TRACKED_MODULUS) < TRACKED_BELOW


def champions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    return (part.filter((F.col("p_size") % UNKNOWN_CHAMPION_MODULUS) != 0)
            .select(F.col("p_partkey").alias("champion_key"), F.col("p_brand").alias("champion")))


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer")
    return cust.select(F.col("c_custkey").alias("player_key"), F.col("c_name").alias("player_name"),
                       is_tracked(F.col("c_custkey")).alias("tracked"))


def tracked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").filter(is_tracked(F.col("o_custkey")))


def matches(spark: SparkSession, sf_dir: str, with_tracked: bool = False) -> DataFrame:
    """Tracked matches; ``with_tracked`` keeps the tracked player (the order's
    customer) on the row, which spares a self-join with the match list."""
    o = tracked_orders(spark, sf_dir)
    extra = [F.col("o_custkey").alias("tracked_key")] if with_tracked else []
    return o.select(
        F.col("o_orderkey").alias("match_id"),
        F.col("o_orderdate").alias("ts"),
        F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("game_duration"),
        F.lit(BLUE_SIDE).alias("side0"),
        F.when(F.col("o_orderstatus") == "O", "Win").otherwise("Fail").alias("win0"),
        F.lit(RED_SIDE).alias("side1"),
        F.when(F.col("o_orderstatus") == "F", "Win").otherwise("Fail").alias("win1"),
        *extra,
    )


def match_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = tracked_orders(spark, sf_dir)
    return o.select(F.col("o_custkey").alias("player_key"), F.col("o_orderkey").alias("match_id"))


def match_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (match, line number) of a tracked match.

    (order, line number) is not unique in the source, hence the aggregate.
    Participants and bans both come from these lines.  The three values travel
    as one struct column, so neither consumer can prune the other's fields:
    the line-item scan and its shuffle are then identical in both and a plan
    that needs participants and bans reads and shuffles the line items once
    (the exchange is reused).
    """
    li = read_table(spark, sf_dir, "lineitem")
    ids = tracked_orders(spark, sf_dir).select(F.col("o_orderkey").alias("l_orderkey"))
    return (li.join(ids, "l_orderkey", "left_semi")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(F.struct(F.min("l_partkey").alias("partkey"), F.min("l_suppkey").alias("suppkey"),
                          F.min("l_quantity").alias("quantity")).alias("line")))


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    me = tracked_orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("match_id"),
        F.lit(0).alias("participant_id"),
        F.col("o_custkey").alias("player_key"),
        F.col("o_custkey").alias("champion_key"),
        F.when(F.col("o_custkey") % 2 == 0, BLUE_SIDE).otherwise(RED_SIDE).alias("team_id"),
    )
    others = match_lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("match_id"),
        F.col("l_linenumber").alias("participant_id"),
        F.col("line.partkey").alias("player_key"),
        F.col("line.suppkey").alias("champion_key"),
        F.when(F.col("l_linenumber") % 2 == 1, BLUE_SIDE).otherwise(RED_SIDE).alias("team_id"),
    )
    return me.unionByName(others)


def bans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("match_id"),
        F.col("l_linenumber").alias("pos"),
        F.when(F.col("line.quantity") == 1, F.lit(NO_BAN_KEY).cast("bigint"))
         .otherwise(F.col("line.suppkey") + BAN_KEY_OFFSET).alias("champion_key"),
    )


def load(spark: SparkSession, sf_dir: str) -> MatchTables:
    """The match model of the driver tables.  Each order lists exactly one
    tracked player (its customer), so matches carry it and no separate match
    list is joined back."""
    return MatchTables(
        champions=champions(spark, sf_dir),
        players=players(spark, sf_dir),
        matches=matches(spark, sf_dir, with_tracked=True),
        match_list=None,
        participants=participants(spark, sf_dir),
        bans=bans(spark, sf_dir),
    )


def events_as_matches(ev: DataFrame) -> DataFrame:
    """Finished-match fixture over the events table (batch or streaming frame).

    One event = one match; duration = floor(value * 10); the Red side wins
    'click' and 'view' events.
    """
    return ev.select(
        "ts",
        F.floor(F.col("value") * 10).cast("bigint").alias("game_duration"),
        F.when(F.col("event_type").isin("click", "view"), "Red").otherwise("Blue").alias("winner"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_matches(read_table(spark, sf_dir, "events"))
