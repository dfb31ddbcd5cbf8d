"""Canonical schemas.

The flat match model is what every operator consumes; the nested document
schemas describe the raw JSON (match documents, match lists, rosters) and the
published match event.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- flat match model (all keyed by match_id) --------------------------------
CHAMPIONS = "champion_key BIGINT, champion STRING"
PLAYERS = "player_key BIGINT, player_name STRING, tracked BOOLEAN"
MATCHES = ("match_id BIGINT, ts TIMESTAMP_NTZ, game_duration BIGINT, "
           "side0 INT, win0 STRING, side1 INT, win1 STRING")
MATCH_LIST = "player_key BIGINT, match_id BIGINT"
PARTICIPANTS = "match_id BIGINT, participant_id INT, player_key BIGINT, champion_key BIGINT, team_id INT"
BANS = "match_id BIGINT, pos INT, champion_key BIGINT"

# ---- normalised outputs -------------------------------------------------------
MATCH_EVENT = "match_id BIGINT, ts TIMESTAMP_NTZ, game_duration BIGINT, winner STRING"
MATCH_BAN = "match_id BIGINT, pos INT, champion STRING"
MATCH_EDGE = ("match_id BIGINT, participant_id INT, my_id BIGINT, my_name STRING, his_id BIGINT, "
              "his_name STRING, my_champion STRING, his_champion STRING, outcome STRING, competition STRING")

# ---- graph files (headerless CSV or Parquet) ---------------------------------
EDGE = T.StructType([
    T.StructField("src_id", T.LongType(), True),
    T.StructField("dst_id", T.LongType(), True),
    T.StructField("src_champ", T.StringType(), True),
    T.StructField("dst_champ", T.StringType(), True),
    T.StructField("side", T.StringType(), True),
])
VERTEX = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("tracking", T.BooleanType(), True),
])

# ---- upsert tables ------------------------------------------------------------
BAN_COUNT = "champion STRING, ban_count BIGINT"
MATCH_STATS = "slot TIMESTAMP_NTZ, duration BIGINT, red_win BIGINT, tot_matches BIGINT"

# ---- nested documents -----------------------------------------------------------
# Published match event (one per match and tracked player).  Key names are
# fixed by the wire format; match_id and ts are additions of ours.
EVENT_EDGE = T.StructType([
    T.StructField("hisSummonerId", T.StringType()),
    T.StructField("hisSummonerName", T.StringType()),
    T.StructField("myChampionId", T.StringType()),
    T.StructField("mySummonerID", T.StringType()),
    T.StructField("mySummonerName", T.StringType()),
    T.StructField("hisChampionId", T.StringType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("competition", T.StringType()),
])
EVENT = T.StructType([
    T.StructField("match_id", T.LongType()),
    T.StructField("ts", T.StringType()),
    T.StructField("gameDuration", T.DoubleType()),
    T.StructField("winner", T.StringType()),
    T.StructField("bans", T.ArrayType(T.StringType())),
    T.StructField("edges", T.ArrayType(EVENT_EDGE)),
])
# Fields without which the reference parser fails; rows missing one are quarantined.
EVENT_REQUIRED = ("gameDuration", "winner", "bans", "edges")

# Raw match document as served by the match API.  Key names of this and the following
# documents are fixed by the API.
RAW_MATCH_DOC = T.StructType([
    T.StructField("gameId", T.LongType()),
    T.StructField("gameCreation", T.LongType()),
    T.StructField("gameDuration", T.DoubleType()),
    T.StructField("teams", T.ArrayType(T.StructType([
        T.StructField("teamId", T.IntegerType()),
        T.StructField("win", T.StringType()),
        T.StructField("bans", T.ArrayType(T.StructType([T.StructField("championId", T.LongType())]))),
    ]))),
    T.StructField("participants", T.ArrayType(T.StructType([
        T.StructField("participantId", T.IntegerType()),
        T.StructField("championId", T.LongType()),  # wider than the API's ints: keys may exceed 2^31
        T.StructField("teamId", T.IntegerType()),
    ]))),
    T.StructField("participantIdentities", T.ArrayType(T.StructType([
        T.StructField("participantId", T.IntegerType()),
        T.StructField("player", T.StructType([
            T.StructField("summonerId", T.StringType()),
            T.StructField("summonerName", T.StringType()),
        ])),
    ]))),
])
MATCH_LIST_DOC = T.StructType([
    T.StructField("accountId", T.StringType()),
    T.StructField("endIndex", T.IntegerType()),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("gameId", T.LongType()),
        T.StructField("queue", T.IntegerType()),
        T.StructField("timestamp", T.LongType()),
    ]))),
])
LEAGUE_ENTRY_DOC = T.ArrayType(T.StructType([T.StructField("summonerName", T.StringType())]))
ACCOUNT_DOC = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("accountId", T.StringType()),
])
