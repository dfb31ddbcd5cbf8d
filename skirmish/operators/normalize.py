"""Match normalisation: raw match model -> match events, bans, edges.

Semantics follow the ingest program being re-implemented:

* winner: team index 0 wins when its ``win`` is "Win", otherwise team 1 is
  declared winner (also for remakes); side 100 is Blue, anything else Red.
* bans: team 0 then team 1, champion id -> name, unknown ids become "None".
* edges: for every tracked player of a match, one edge per *other*
  participant.  The tracked participant is located by name, the last one
  wins; when absent, every participant counts as an opponent ("Against") and
  the tracked champion is "None".  Participants sharing the tracked player's
  name are skipped.  ``outcome`` describes the *other* participant (his team
  won -> "Win"), ``competition`` is "Together" for the same team.

Plan shape: no step gathers a match in one task.  The tracked participant is
found by a join on (match, name), which spreads even a huge match over its many
names, and a partially aggregated ``max_by``; it is attached to the few tracked
rows, and the participants then join on match_id with nothing keyed by match
after it, so AQE may split a hot match.  Champion names are looked up last.
Dimension joins are ordinary equi-joins; AQE broadcasts them at run time when
their measured size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import BLUE_SIDE, RED_SIDE, MatchTables

NO_CHAMPION = "None"


def winner_side(side0="side0", win0="win0", side1="side1") -> F.Column:
    """Winning side id, normalised to 100 (Blue) or 200 (Red)."""
    side = F.when(F.col(win0) == "Win", F.col(side0)).otherwise(F.col(side1))
    return F.when(side == BLUE_SIDE, F.lit(BLUE_SIDE)).otherwise(F.lit(RED_SIDE))


def winner_name(side: F.Column) -> F.Column:
    return F.when(side == BLUE_SIDE, F.lit("Blue")).otherwise(F.lit("Red"))


def match_events(t: MatchTables, flag_remake: bool = False) -> DataFrame:
    """One row per match: id, time, duration and winning side name.

    ``flag_remake`` adds ``remake`` (no team won; the winner column then
    names team 1's side, as the reference does).
    """
    cols = ["match_id", "ts", "game_duration", winner_name(winner_side()).alias("winner")]
    if flag_remake:
        cols.append(((F.col("win0") != "Win") & (F.col("win1") != "Win")).alias("remake"))
    return t.matches.select(*cols)


def name_champions(df: DataFrame, champions: DataFrame, key: str, out: str) -> DataFrame:
    """Left lookup of a champion key; unknown keys get "None"."""
    dim = champions.select(F.col("champion_key").alias(key), F.col("champion").alias(out))
    return (df.join(dim, key, "left")
            .withColumn(out, F.coalesce(F.col(out), F.lit(NO_CHAMPION))))


def match_bans(t: MatchTables) -> DataFrame:
    """One row per ban: (match_id, pos, champion)."""
    return name_champions(t.bans, t.champions, "champion_key", "champion").select(
        "match_id", "pos", "champion")


def identities(t: MatchTables) -> DataFrame:
    """Participants with their player identity; unknown players keep their id and get the empty name.

    ``position`` is the place of the identity in the match's identity list (the
    participant id for tables that have no such list).
    """
    if "player_name" in t.participants.columns:  # documents carry the name themselves
        p = t.participants
    else:
        p = t.participants.join(player_names(t), "player_key", "left")
    position = F.col("position") if "position" in t.participants.columns else F.col("participant_id")
    return p.select("match_id", "participant_id", position.alias("position"), F.col("player_key").alias("his_id"),
                    F.coalesce(F.col("player_name"), F.lit("")).alias("his_name"), "champion_key", "team_id")


def player_names(t: MatchTables) -> DataFrame:
    """(player_key, player_name): one projection shared by every name lookup,
    so that the tracked-player and participant lookups read (and, when the
    dimension is shuffled, exchange) the players table once."""
    return t.players.select("player_key", "player_name")


def tracked_matches(t: MatchTables, extra: tuple[str, ...] = ()) -> DataFrame:
    """(match, tracked player) pairs with the tracked name, the winning side
    and any ``extra`` match columns."""
    if t.match_list is None:  # matches carry their tracked player
        m = t.matches.select("match_id", F.col("tracked_key").alias("player_key"),
                             winner_side().alias("win_team"), *extra)
    else:
        m = (t.match_list.select("match_id", "player_key")
             .join(t.matches.select("match_id", winner_side().alias("win_team"), *extra), "match_id"))
    return (m.join(player_names(t), "player_key")
            .withColumnRenamed("player_key", "my_id").withColumnRenamed("player_name", "my_name"))


def match_edges(t: MatchTables) -> DataFrame:
    """Normalised edges (one per tracked player and other participant)."""
    return _opponents(t, tracked_matches(t), "inner").filter(F.col("his_name") != F.col("my_name")).select(
        "match_id", "participant_id", "my_id", "my_name", "his_id", "his_name", "my_champion", "his_champion",
        "outcome", "competition")


def _opponents(t: MatchTables, tracked: DataFrame, how: str) -> DataFrame:
    """``tracked_matches`` rows joined with every participant of the match.

    Adds the tracked participant's champion, the participant's champion, the
    outcome and the competition.  The tracked participant is the last of that
    name in the identity list.
    """
    ident = identities(t)
    named = ident.select("match_id", F.col("his_name").alias("my_name"), "position",
                         F.col("champion_key").alias("c"), F.col("team_id").alias("t"))
    me = (tracked.select("match_id", "my_id", "my_name").join(named, ["match_id", "my_name"])
          .groupBy("match_id", "my_id").agg(F.max_by(F.struct("c", "t"), F.col("position")).alias("me")))
    tracked = tracked.join(me, ["match_id", "my_id"], "left").select(
        *tracked.columns, F.col("me.c").alias("my_key"), F.col("me.t").alias("my_team"))
    tracked = name_champions(tracked, t.champions, "my_key", "my_champion")  # few rows: one per tracked player
    rows = name_champions(tracked.join(ident, "match_id", how), t.champions, "champion_key", "his_champion")
    return (rows.withColumn("outcome", F.when(F.col("team_id") == F.col("win_team"), "Win").otherwise("Fail"))
            .withColumn("competition", F.when(F.col("team_id") == F.col("my_team"), "Together").otherwise("Against")))


# ---------------------------------------------------------------------------
# Nested match events (the published message) and their parsing
# ---------------------------------------------------------------------------

def event_documents(t: MatchTables) -> DataFrame:
    """One nested match event per (match, tracked player).

    Columns: key (tracked player name), match_id, my_id, ts, gameDuration,
    winner, bans ARRAY<STRING> (ban order), edges ARRAY<STRUCT> (participant
    order).

    Everything comes from one frame of tracked matches and participants;
    a player's edges are collected per (match, tracked player), bans per match
    (groups the game format bounds).  Element order is restored with
    array_sort on the carried position.
    """
    b = (match_bans(t).groupBy("match_id")
         .agg(F.array_sort(F.collect_list(F.struct("pos", "champion"))).alias("bs"))
         .select("match_id", F.transform("bs", lambda x: x["champion"]).alias("bans")))
    return nested(_opponents(t, tracked_matches(t, ("ts", "game_duration")), "left"), b)


def nested(rows: DataFrame, bans: DataFrame) -> DataFrame:
    """Events of tracked rows joined with the participants of their match, and of the ban list (match_id, bans)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))  # noqa: E731  an unknown id is the empty text
    edge = F.struct(
        F.col("participant_id").alias("pid"),
        F.struct(
            text("his_id").alias("hisSummonerId"),
            F.col("his_name").alias("hisSummonerName"),
            F.col("my_champion").alias("myChampionId"),
            text("my_id").alias("mySummonerID"),
            F.col("my_name").alias("mySummonerName"),
            F.col("his_champion").alias("hisChampionId"),
            F.col("outcome"), F.col("competition")).alias("e"))
    opponent = F.col("his_name") != F.col("my_name")
    docs = rows.groupBy("match_id", "my_id").agg(
        F.first("my_name").alias("key"), F.first("ts").alias("ts"), F.first("game_duration").alias("game_duration"),
        F.first("win_team").alias("win_team"), F.array_sort(F.collect_list(F.when(opponent, edge))).alias("es"))
    return (docs.join(bans, "match_id", "left")
            .select("key", "match_id", "my_id", "ts",
                    F.col("game_duration").cast("double").alias("gameDuration"),
                    winner_name(F.col("win_team")).alias("winner"),
                    F.coalesce("bans", F.array().cast("array<string>")).alias("bans"),
                    F.transform("es", lambda x: x["e"]).alias("edges")))


def to_records(docs: DataFrame) -> DataFrame:
    """Serialise events to the (key, value) record contract of the topic."""
    payload = F.struct("match_id", F.col("ts").cast("string").alias("ts"),
                       "gameDuration", "winner", "bans", "edges")
    return docs.select(F.col("key"), F.to_json(payload).alias("value"))
