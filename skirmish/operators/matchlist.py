"""Match lists and the tracked roster.

Match-list polling is re-expressed as batch slicing: the poller asks, per
player, for the ranked-queue games of [begin, begin + step) and advances begin
by ``step`` each poll (8 640 000 ms, i.e. 2.4 h, in replay mode).  Over a
table of games that is a per-player bucketing of the time axis plus the
position of each game inside its slice (0 .. endIndex-1).  Positions are
counted per (player, slice): a slice is a few hours of one player, so even a
player with a third of all games is spread over all slices, and one shuffle
serves both the position and the slice size.

The roster is the first n league entries (n = 20 in the reference, bounded by
the API rate limit), each resolved to an account id by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..functions.columns import epoch_micros_to_ntz, ntz_to_epoch_micros, url_escape_blanks

# Fixed values of the poller.
POLL_STEP_MS = 8_640_000
ROSTER_SIZE = 20


def match_list_slices(games: DataFrame, begin: Column, step_ms: int = POLL_STEP_MS,
                      queue: str | None = None, player="user_id", game="event_id", ts="ts",
                      queue_col="event_type") -> DataFrame:
    """(player, poll, slice_begin, slice_end, idx, game_id, ts, end_index).

    Games before ``begin`` are never polled.  ``poll`` is the slice number,
    ``idx`` the 0-based position in the slice ordered by (ts, game id) and
    ``end_index`` the slice size.
    """
    # ``begin`` (possibly a scalar subquery) is evaluated once, as a column.
    g = games.select(F.col(player).alias("player"), F.col(game).alias("game_id"),
                     F.col(ts).cast("timestamp_ntz").alias("ts"), F.col(queue_col).alias("queue"),
                     begin.cast("timestamp_ntz").alias("b0"))
    if queue is not None:
        g = g.filter(F.col("queue") == queue)
    # Time arithmetic on epoch microseconds (session-zone free).
    g = g.withColumn("t_us", ntz_to_epoch_micros("ts")).withColumn("b_us", ntz_to_epoch_micros("b0"))
    step_us = step_ms * 1000
    g = g.withColumn("poll", F.floor((F.col("t_us") - F.col("b_us")) / step_us)).filter(F.col("poll") >= 0)
    own = Window.partitionBy("player", "poll")
    ranked = g.select("*", F.row_number().over(own.orderBy("ts", "game_id")).cast("bigint").alias("rn"),
                      F.count("*").over(own).alias("end_index"))
    start = F.col("b_us") + F.col("poll") * step_us
    return ranked.select(
        "player", F.col("poll").cast("bigint").alias("poll"),
        epoch_micros_to_ntz(start).alias("slice_begin"),
        epoch_micros_to_ntz(start + step_us).alias("slice_end"),
        (F.col("rn") - 1).alias("idx"), "game_id", "ts", "end_index")


def roster(entries: DataFrame, n: int = ROSTER_SIZE, order: list | None = None) -> DataFrame:
    """First n league entries (explicit order) -> (rank, summoner_name).

    The result has at most n rows (TakeOrderedAndProject).
    """
    order = order or [F.desc("rating"), F.asc("summoner_name")]
    return entries.orderBy(*order).limit(n)


def resolve_accounts(names: DataFrame, accounts: DataFrame) -> DataFrame:
    """Roster names -> account ids; names without an account are dropped.

    Accounts are de-duplicated by name first (the last lookup wins, here the
    largest id), then joined; ``url_name`` is the escaped request name.
    """
    wanted = F.broadcast(names.select("summoner_name"))  # at most n rows (roster limit)
    acc = (accounts.join(wanted, "summoner_name", "left_semi")
           .groupBy("summoner_name").agg(F.max("account_id").alias("account_id")))
    return names.join(acc, "summoner_name").select(
        "summoner_name", url_escape_blanks("summoner_name").alias("url_name"), "account_id",
        *[c for c in names.columns if c != "summoner_name"])


def poll_increment(games: DataFrame, cursor: DataFrame, begin: Column,
                   player: str = "player", ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """One incremental poll over a table of games with a high-water mark per player.

    ``cursor`` is (player, last_ts).  Returns (games newer than the player's
    mark, or at/after ``begin`` for players without one; the advanced
    cursor).  The cursor has one row per player and the new marks come from
    a partial aggregation, so a very active player costs no more than any other.
    """
    c = cursor.select(F.col(player).alias(player), F.col("last_ts"))
    mark = F.col("last_ts")
    marks = c.withColumnRenamed(player, "__player")
    new = (games.join(marks, F.col(player).eqNullSafe(F.col("__player")), "left").drop("__player")
           .filter(F.when(mark.isNull(), F.col(ts) >= begin).otherwise(F.col(ts) > mark))
           .drop("last_ts"))
    advanced = (c.unionByName(new.groupBy(player).agg(F.max(ts).alias("last_ts")))
                .groupBy(player).agg(F.max("last_ts").alias("last_ts")))
    return new, advanced


class PollStore:
    """Polls whose games and cursor become visible together.

    A poll writes the new games and the advanced marks of the players who have any, then commits one record that names both.  A
    poll that stops anywhere before its commit leaves nothing behind that a reader or the next poll would take, so games are neither
    skipped nor repeated.  Marks are kept in hash buckets, so a poll rewrites only the buckets of players with new games.
    """

    def __init__(self, spark: SparkSession, root: str, player: str = "player BIGINT", games: str = "player BIGINT, game_id BIGINT, ts TIMESTAMP_NTZ",
                 buckets: int = 64):
        from ..streaming.versions import Appended, BucketStore, Keyed
        self.player = player.split()[0]
        self.store = BucketStore(spark, root, {
            "cursor": Keyed(f"{player}, last_ts TIMESTAMP_NTZ", (self.player,), {"last_ts": F.max}), "games": Appended(games)}, buckets)

    def poll(self, games: DataFrame, begin: Column) -> DataFrame:
        """Take the games newer than the players' marks (or from ``begin`` on); returns them once they are committed."""
        found, number = self.store.folders("games"), self.store.next_batch()
        new, _ = poll_increment(games, self.store.read("cursor"), begin, self.player)
        new = materialize(new, "poll")
        marks = new.groupBy(self.player).agg(F.max("ts").alias("last_ts"))
        self.store.merge({"games": new, "cursor": marks}, number)
        return self.store._read("games", [f for f in self.store.folders("games") if f not in found])

    def games(self) -> DataFrame:
        """All games of committed polls."""
        return self.store.read("games")

    def cursor(self) -> DataFrame:
        return self.store.read("cursor")
