"""Sliding-window match statistics (30-minute windows every 5 minutes).

Per window: total game duration (the reference names it an average but
stores the sum), Red-side wins and number of matches; empty windows produce no
row.  Batch plan: matches are first reduced to one row per 5-minute bucket
(partial aggregation before any shuffle), and only those bucket rows are fanned
out to the 6 windows that contain them, so the fan-out costs nothing at scale.
The streaming form uses ``window()`` directly on a watermarked event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the statistics job.
WINDOW_MINUTES = 30
SLIDE_MINUTES = 5


def _measures():
    """The three measures of a window (or bucket) of matches."""
    return (F.sum("game_duration").alias("duration"),
            F.count_if(F.col("winner") == "Red").alias("red_win"),
            F.count(F.lit(1)).alias("tot_matches"))


def sliding_stats(matches: DataFrame, window_minutes: int = WINDOW_MINUTES,
                  slide_minutes: int = SLIDE_MINUTES, dedupe_key: str | None = None) -> DataFrame:
    """(slot, duration, red_win, tot_matches) keyed by window start.

    ``matches`` needs ts, game_duration and winner.  The window length must be
    a multiple of the slide.  A match reported by several tracked players is
    counted once per report, as in the reference; ``dedupe_key`` (e.g.
    match_id) counts it once instead (rows without the key each).  Matches without a
    time belong to no window here; the stream counts them by their arrival.
    """
    if window_minutes % slide_minutes:
        raise ValueError("window length must be a multiple of the slide")
    if dedupe_key:
        matches = distinct_matches(matches, dedupe_key)
    return slide_panes(panes(matches, slide_minutes), window_minutes, slide_minutes)


def distinct_matches(matches: DataFrame, key: str, watermarked: bool = False) -> DataFrame:
    """One row per value of ``key``; rows without one cannot be told to be the same match, so all of them stay.

    On a stream duplicates are dropped within the watermark if the frame has one, else for good.
    """
    known = matches.filter(F.col(key).isNotNull())
    known = known.dropDuplicatesWithinWatermark([key]) if watermarked else known.dropDuplicates([key])
    return known.unionByName(matches.filter(F.col(key).isNull()))


def panes(matches: DataFrame, slide_minutes: int = SLIDE_MINUTES) -> DataFrame:
    """(pane, duration, red_win, tot_matches): matches summed up per slide; also of a streaming frame."""
    return (matches.groupBy(F.window("ts", f"{slide_minutes} minutes").alias("w")).agg(*_measures())
            .select(F.col("w.start").alias("pane"), "duration", "red_win", "tot_matches"))


def slots_of(pane: str, window_minutes: int = WINDOW_MINUTES, slide_minutes: int = SLIDE_MINUTES) -> F.Column:
    """The slots (window starts) that contain a pane, one row each."""
    steps = F.sequence(F.lit(0), F.lit(window_minutes // slide_minutes - 1))
    return F.explode(F.transform(steps, lambda i: F.col(pane) - F.make_dt_interval(mins=i * slide_minutes)))


def slide_panes(panes: DataFrame, window_minutes: int = WINDOW_MINUTES, slide_minutes: int = SLIDE_MINUTES) -> DataFrame:
    """Windows from panes: every pane counts in the slots that contain it."""
    slots = panes.select(slots_of("pane", window_minutes, slide_minutes).alias("slot"), "duration", "red_win", "tot_matches")
    return slots.groupBy("slot").agg(*(F.sum(c).cast("bigint").alias(c) for c in ("duration", "red_win", "tot_matches")))


def sliding_stats_streaming(matches: DataFrame, window_minutes: int = WINDOW_MINUTES,
                            slide_minutes: int = SLIDE_MINUTES, dedupe_key: str | None = None,
                            watermarked: bool = True) -> DataFrame:
    """Same measures with ``window()``: usable on a streaming frame.

    ``ts`` must be TIMESTAMP (watermarks do not accept TIMESTAMP_NTZ).  With
    ``dedupe_key`` duplicates are dropped: within the watermark if the frame has
    one, else for good.
    """
    if dedupe_key:
        matches = distinct_matches(matches, dedupe_key, watermarked)
    w = F.window("ts", f"{window_minutes} minutes", f"{slide_minutes} minutes")
    return (matches.groupBy(w.alias("w")).agg(*_measures())
            .select(F.col("w.start").alias("slot"), "duration", "red_win", "tot_matches"))
