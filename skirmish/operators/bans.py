"""Ban statistics: totals per champion, running count per ban, top-k.

Totals are a plain group-by (partial aggregation map-side, so a champion
banned in a third of all matches costs no more than any other).  The running
count reproduces the streaming job's per-input output (each ban emits the
champion's new total) as a batch operator, made skew-proof by the range-partitioned
row number of ``functions.ranking``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import range_row_number

# Champion key excluded from rankings, default ranking sizes.
EXCLUDED_CHAMPIONS = ("-1",)
TOP_BANNED = 3
TOP_CHART = 15


def ban_counts(match_bans: DataFrame) -> DataFrame:
    """(champion, ban_count) over all bans."""
    return match_bans.groupBy("champion").agg(F.count(F.lit(1)).alias("ban_count"))


def ban_counts_by_key(raw_bans: DataFrame, champions: DataFrame) -> DataFrame:
    """(champion, ban_count) from raw bans (champion keys), aggregating first.

    Counting per champion key before the name lookup means the dimension
    join sees one row per key instead of one per ban: when the champion
    table is too large to broadcast, the shuffle of that join carries a few
    rows per key, not the bans.  Keys without a name count as "None"; keys
    sharing a name are summed.
    """
    per_key = raw_bans.groupBy("champion_key").agg(F.count(F.lit(1)).alias("n"))
    dim = champions.select("champion_key", "champion")
    named = (per_key.join(dim, "champion_key", "left")
             .select(F.coalesce("champion", F.lit("None")).alias("champion"), "n"))
    return named.groupBy("champion").agg(F.sum("n").cast("bigint").alias("ban_count"))


def running_ban_count(match_bans: DataFrame, blocks: int | None = None) -> DataFrame:
    """(match_id, pos, champion, running): the champion's count up to this ban.

    Bans are ordered by (match_id, pos) within a champion, bans without a match id first and
    in any order.  The rows are cut into ``blocks`` parts of equal size (default: the session's
    shuffle partitions), so a hot champion is spread over tasks whatever its match ids are.
    """
    return range_row_number(match_bans, ["champion"], ["match_id", "pos"], "running", blocks).select(
        "match_id", "pos", "champion", "running")


def top_banned(ban_count: DataFrame, k: int = TOP_BANNED,
               exclude: tuple[str, ...] = EXCLUDED_CHAMPIONS) -> DataFrame:
    """The k most banned champions; ties broken by champion name.

    Plans as TakeOrderedAndProject: each task keeps its own k best rows, so
    the result (at most k rows) is safe to broadcast.
    """
    src = ban_count.filter(~F.col("champion").isin(*exclude)) if exclude else ban_count
    return src.orderBy(F.desc("ban_count"), F.asc("champion")).limit(k)
