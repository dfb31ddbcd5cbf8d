"""Document sources: JSON match events, raw match documents, match lists,
rosters and accounts, the champion list and the Kafka record contract.

Parsing is schema-on-read with explicit schemas (never inferred).  Records
that do not parse, or lack a field the reference parser dereferences, are not
fatal: they go to a quarantine frame with the raw text, so one bad message
cannot stop a stream.

Raw match documents are flattened without a shuffle: teams, participants and
identities live inside one document, so the participant <-> identity lookup is
done with array functions inside the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.columns import epoch_micros_to_ntz, ntz_to_epoch_micros
from ..sources.tables import MatchTables

# ---------------------------------------------------------------------------
# Match events (topic value)
# ---------------------------------------------------------------------------

ARRAY_OF_EVENTS = T.ArrayType(schemas.EVENT)


def parse_events(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse event JSON whose root may be an object or an array.

    An array root uses its element 0.  Adds ``quarantined`` and ``reason`` next to the parsed
    fields; the original columns are kept.  A record is quarantined when its
    text is not JSON, a required field or a key of an edge is missing, the
    duration does not fit a BIGINT, or there is a time that does not parse;
    ``reason`` names the first of these that applies (null for a good record).
    """
    text = F.col(value_col).cast("string")
    parsed = F.get(F.from_json(text, ARRAY_OF_EVENTS, {"mode": "PERMISSIVE"}), 0)
    out = records.withColumn("_event", parsed)
    reason = F.when(F.col("_event").isNull(), "unparsable")
    for name in schemas.EVENT_REQUIRED:
        reason = reason.when(F.col(f"_event.{name}").isNull(), f"no {name}")

    def incomplete(edge):
        missing = edge.isNull()
        for name in schemas.EVENT_EDGE.fieldNames():
            missing = missing | edge[name].isNull()
        return missing

    ts = F.col("_event.ts")
    reason = (reason.when(F.exists(F.col("_event.edges"), incomplete), "incomplete edge")
              .when(F.col("_event.gameDuration").try_cast("bigint").isNull(), "duration")
              .when(ts.isNotNull() & ts.try_cast("timestamp_ntz").isNull(), "time"))
    return out.withColumn("reason", reason).withColumn("quarantined", F.col("reason").isNotNull())


def with_payload(records: DataFrame, value_col: str = "value", out: str = "payload") -> DataFrame:
    """Add the whole record as a VARIANT (null if it is not JSON), so fields that the schema does not know are kept.

    ``F.try_variant_get(out, "$.field", type)`` reads one of them, ``F.to_json(out)`` writes all of them back.
    """
    return records.withColumn(out, F.try_parse_json(F.col(value_col).cast("string")))


def split_quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good events flattened to top-level fields, quarantined raw records with their reason).

    Record columns (key, metadata) are kept next to the event fields; where a
    name exists in both, the parsed event field wins.
    """
    fields = set(schemas.EVENT.fieldNames())
    keep = [c for c in parsed.columns if c not in ("_event", "quarantined", "reason", "value") and c not in fields]
    good = parsed.filter(~F.col("quarantined")).select(*keep, "_event.*")
    bad = parsed.filter(F.col("quarantined")).drop("_event", "quarantined")
    return good, bad


def event_edges(good: DataFrame) -> DataFrame:
    """Flatten the edge array of parsed events (events without edges vanish).

    Ids become BIGINT keys where they are numeric and null otherwise (the
    match API's summoner ids are opaque strings: derive ids from names then).
    """
    e = good.select("match_id", F.explode("edges").alias("e"))
    return e.select(
        "match_id",
        F.col("e.mySummonerID").try_cast("bigint").alias("my_id"),
        F.col("e.mySummonerName").alias("my_name"),
        F.col("e.hisSummonerId").try_cast("bigint").alias("his_id"),
        F.col("e.hisSummonerName").alias("his_name"),
        F.col("e.myChampionId").alias("my_champion"),
        F.col("e.hisChampionId").alias("his_champion"),
        F.col("e.outcome").alias("outcome"),
        F.col("e.competition").alias("competition"),
    )


def event_bans(good: DataFrame) -> DataFrame:
    """Flatten bans keeping their position (1-based)."""
    return good.select("match_id", F.posexplode("bans").alias("pos", "champion")).select(
        "match_id", (F.col("pos") + 1).alias("pos"), "champion")


# ---------------------------------------------------------------------------
# Kafka record contract (key STRING, value STRING)
# ---------------------------------------------------------------------------

def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str = "matches",
                 **options) -> DataFrame:
    """Streaming (key, value) records from a Kafka topic.

    Needs the spark-sql-kafka connector on the classpath; options (group id,
    security, offsets) are passed through untouched.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))


def write_kafka(records: DataFrame, bootstrap_servers: str, topic: str = "matches", **options) -> None:
    """Publish (key, value) records to a Kafka topic (batch write).

    Needs the spark-sql-kafka connector; for a stream use
    ``records.writeStream.format("kafka")`` with the same options.
    """
    w = (records.select(F.col("key").cast("string"), F.col("value").cast("string"))
         .write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic))
    for k, v in options.items():
        w = w.option(k, v)
    w.save()


def json_record_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                       max_bytes_per_trigger: int | None = None) -> DataFrame:
    """File-based stand-in for the topic: JSON lines with key and value fields."""
    reader = spark.readStream.schema("key STRING, value STRING")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    # micro-batches of a publishing stream land in folders of their own
    return reader.option("recursiveFileLookup", "true").json(path)


# ---------------------------------------------------------------------------
# Raw match documents (match API payload)
# ---------------------------------------------------------------------------

CORRUPT = "_corrupt_record"


def read_raw_matches(spark: SparkSession, path: str, streaming: bool = False, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Raw match documents; the text of a line that does not parse is in ``_corrupt_record``."""
    schema = T.StructType([*schemas.RAW_MATCH_DOC.fields, T.StructField(CORRUPT, T.StringType())])
    reader = (spark.readStream if streaming else spark.read).schema(schema)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def split_raw_matches(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good documents, rejected documents).

    A document is rejected when it does not parse, or lacks the game id, one
    of the two teams, a team's id or result, the participants or their
    identities, or a duration that fits a BIGINT.
    """
    reason = raw_reject_reason(CORRUPT in docs.columns)
    return docs.filter(reason.isNull()).drop(CORRUPT), docs.filter(reason.isNotNull())


def raw_reject_reason(corrupt: bool = True) -> F.Column:
    """Why a raw match document is rejected (the first that applies), null if it is good."""
    teams = F.coalesce(F.size("teams") >= 2, F.lit(False))
    for k in (0, 1):
        teams = teams & F.get("teams", k)["teamId"].isNotNull() & F.get("teams", k)["win"].isNotNull()
    out = F.when(F.col(CORRUPT).isNotNull(), "unparsable") if corrupt else F.when(F.lit(False), "")
    return (out.when(F.col("gameId").isNull(), "no game id").when(~teams, "teams")
            .when(F.col("participants").isNull() | F.col("participantIdentities").isNull(), "participants")
            .when(F.col("gameDuration").try_cast("bigint").isNull(), "duration"))


def flatten_raw_matches(docs: DataFrame, champions: DataFrame, players: DataFrame,
                        match_list: DataFrame) -> MatchTables:
    """Raw match documents -> the flat match model.

    Participants are paired with their identity inside the document (last
    identity with the participant id wins); a participant without identity
    gets an empty id and name.  Summoner ids become the player key when they
    are numeric; players is the name dimension.  Rejected documents
    (``split_raw_matches``) give no rows.
    """
    docs, _ = split_raw_matches(docs)
    d = docs.select(
        F.col("gameId").alias("match_id"),
        epoch_micros_to_ntz(F.col("gameCreation") * 1000).alias("ts"),
        F.col("gameDuration").try_cast("bigint").alias("game_duration"),
        F.get("teams", 0).alias("t0"), F.get("teams", 1).alias("t1"),
        "participants", "participantIdentities")
    matches = d.select("match_id", "ts", "game_duration",
                       F.col("t0.teamId").alias("side0"), F.col("t0.win").alias("win0"),
                       F.col("t1.teamId").alias("side1"), F.col("t1.win").alias("win1"))
    ban_arr = F.concat(F.coalesce(F.col("t0.bans"), F.array()), F.coalesce(F.col("t1.bans"), F.array()))
    bans = (d.select("match_id", F.posexplode(ban_arr).alias("pos", "b"))
            .select("match_id", (F.col("pos") + 1).alias("pos"),
                    F.col("b.championId").cast("bigint").alias("champion_key")))

    placed = F.transform("participantIdentities", lambda i, n: F.struct(i.alias("i"), n.alias("n")))

    def identity_of(p):
        hits = F.filter("placed", lambda x: x["i"]["participantId"] == p["participantId"])
        return F.try_element_at(hits, F.lit(-1))  # last wins; null when absent (ANSI-safe)

    parts = d.withColumn("placed", placed).select("match_id", F.explode(F.transform(
        "participants", lambda p: F.struct(p["participantId"].alias("participant_id"),
                                           p["championId"].cast("bigint").alias("champion_key"),
                                           p["teamId"].alias("team_id"),
                                           identity_of(p)["n"].alias("position"),
                                           identity_of(p)["i"]["player"]["summonerId"].alias("summoner_id"),
                                           identity_of(p)["i"]["player"]["summonerName"].alias("player_name"))
    )).alias("p")).select("match_id", "p.*")
    participants = parts.select("match_id", "participant_id",
                                F.expr("try_cast(summoner_id AS BIGINT)").alias("player_key"),
                                "champion_key", "team_id", "position", "player_name")
    return MatchTables(champions=champions, players=players, matches=matches,
                       match_list=match_list, participants=participants, bans=bans)


# ---------------------------------------------------------------------------
# Match lists, league entries (roster) and accounts
# ---------------------------------------------------------------------------

def read_match_lists(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MATCH_LIST_DOC).json(path)


def explode_match_lists(lists: DataFrame) -> DataFrame:
    """Entries 0..endIndex-1 of each match-list page -> (account_id, idx, game_id)."""
    head = F.slice("matches", 1, F.coalesce(F.col("endIndex"), F.lit(0)))
    return (lists.select(F.col("accountId").alias("account_id"), F.posexplode(head).alias("idx", "m"))
            .select("account_id", "idx", F.col("m.gameId").alias("game_id"),
                    F.col("m.queue").alias("queue"), F.col("m.timestamp").alias("game_ts")))


def read_league_entries(spark: SparkSession, path: str) -> DataFrame:
    """League pages (JSON arrays of entries) -> (summoner_name)."""
    raw = spark.read.text(path)
    entries = F.from_json("value", schemas.LEAGUE_ENTRY_DOC)
    return raw.select(F.explode(entries).alias("e")).select(F.col("e.summonerName").alias("summoner_name"))


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ACCOUNT_DOC).json(path).select(
        F.col("name").alias("summoner_name"), F.col("accountId").alias("account_id"))


# ---------------------------------------------------------------------------
# Champion list: headerless "id,name" lines
# ---------------------------------------------------------------------------

def read_champion_csv(spark: SparkSession, path: str) -> DataFrame:
    """Champion dimension from headerless ``id,name`` text.

    Like a split on ',' that keeps the first two fields, extra fields are
    ignored.
    """
    raw = (spark.read.schema("champion_id STRING, champion STRING")
           .option("header", "false").option("mode", "PERMISSIVE").csv(path))
    return raw.select(F.expr("try_cast(champion_id AS BIGINT)").alias("champion_key"), "champion")


def write_champion_csv(champions: DataFrame, path: str) -> None:
    (champions.select(F.col("champion_key").cast("string"), "champion")
     .write.mode("overwrite").option("header", "false").csv(path))


def to_raw_documents(t: MatchTables) -> DataFrame:
    """The flat match model nested back into match-API documents.

    Inverse of ``flatten_raw_matches`` (used to land test documents and to
    export).  Participants, identities and bans are collected per match, a
    group the game format bounds; all bans go to team 0 in ban order, which
    keeps the "team 0 then team 1" sequence.  Identity names come from the
    players dimension, unknown players get an empty name.
    """
    names = t.players.select("player_key", "player_name")
    p = (t.participants.join(names, "player_key", "left")
         .select("match_id", F.struct(
             F.col("participant_id").alias("participantId"),
             F.col("champion_key").alias("championId"),
             F.col("team_id").alias("teamId"),
             F.struct(F.col("player_key").cast("string").alias("summonerId"),
                      F.coalesce("player_name", F.lit("")).alias("summonerName")).alias("player")).alias("p")))
    parts = p.groupBy("match_id").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    b = (t.bans.groupBy("match_id")
         .agg(F.array_sort(F.collect_list(F.struct("pos", F.col("champion_key").alias("c"))))
              .alias("bs")))
    m = t.matches.join(parts, "match_id", "left").join(b, "match_id", "left")
    ban_structs = F.transform(F.coalesce("bs", F.array()), lambda x: F.struct(x["c"].alias("championId")))
    ps = F.coalesce("ps", F.array())
    return m.select(
        F.col("match_id").alias("gameId"),
        F.floor(ntz_to_epoch_micros("ts") / 1000).alias("gameCreation"),
        F.col("game_duration").cast("double").alias("gameDuration"),
        F.array(F.struct(F.col("side0").alias("teamId"), F.col("win0").alias("win"), ban_structs.alias("bans")),
                F.struct(F.col("side1").alias("teamId"), F.col("win1").alias("win"),
                         F.array().cast("array<struct<championId:bigint>>").alias("bans"))).alias("teams"),
        F.transform(ps, lambda x: F.struct(x["participantId"].alias("participantId"),
                                           x["championId"].alias("championId"),
                                           x["teamId"].alias("teamId"))).alias("participants"),
        F.transform(ps, lambda x: F.struct(x["participantId"].alias("participantId"),
                                           x["player"].alias("player"))).alias("participantIdentities"))
