"""Match tables bucketed by match, with names and champions resolved when they are loaded.

The flat model (``tables.MatchTables``) joins players and champions each time edges are made, and every join by match
shuffles.  A ``MatchStore`` does that once per load: participants carry their name and champion, tracked
rows their name and winning side, bans their champion, and all three tables lie in buckets of the match id.  Whatever is
computed per match afterwards (the tracked participant, edges, nested events) reads bucket by bucket and shuffles nothing.

A bucket holds whole matches, so this suits games, whose matches have a bounded number of participants; for a match of
unbounded size use ``normalize.match_edges`` on the flat model, where adaptive execution may split it.

Folders: ``<root>/participants``, ``tracked`` and ``bans``, plain Parquet with Spark's bucket numbers in the file
names.  ``add`` loads the matches a table does not hold yet, tracked rows last: readers start from them, so they
never see a match whose participants are still being written, and a load that is run again adds nothing twice.
Loads of one store must not overlap; rows of a match that is loaded already are not changed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import normalize
from .tables import MatchTables

SCHEMAS = {
    "participants": "match_id BIGINT, participant_id INT, position INT, his_id BIGINT, his_name STRING, his_champion STRING, team_id INT",
    "bans": "match_id BIGINT, pos INT, champion STRING",
    "tracked": "match_id BIGINT, my_id BIGINT, my_name STRING, win_team INT, ts TIMESTAMP_NTZ, game_duration BIGINT",
}


@dataclass(frozen=True)
class MatchStore:
    """Bucketed tables below ``root``; ``buckets`` is fixed for the life of the store."""

    spark: SparkSession
    root: str
    buckets: int
    tag: str

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"skirmish_{name}_{self.tag}")

    def add(self, t: MatchTables) -> None:
        """Load the matches of ``t``: one shuffle by match per table, after the lookups of names and champions."""
        resolved = {
            "participants": normalize.name_champions(normalize.identities(t), t.champions, "champion_key", "his_champion"),
            "bans": normalize.match_bans(t),
            "tracked": normalize.tracked_matches(t, ("ts", "game_duration")),
        }
        for name, schema in SCHEMAS.items():
            fields = [f.strip().split(" ") for f in schema.split(",")]
            rows = resolved[name].select(*[F.col(c).cast(kind).alias(c) for c, kind in fields])
            known = self.table(name).select("match_id").distinct()
            new = rows.join(known, "match_id", "left_anti").repartition(self.buckets, "match_id").sortWithinPartitions("match_id")
            (new.write.mode("append").format("parquet").bucketBy(self.buckets, "match_id").sortBy("match_id")
             .saveAsTable(f"skirmish_{name}_{self.tag}"))

    def edges(self) -> DataFrame:
        """The rows of ``normalize.match_edges``, without a shuffle."""
        return self.opponents("inner").filter(F.col("his_name") != F.col("my_name")).select(
            "match_id", "participant_id", "my_id", "my_name", "his_id", "his_name", "my_champion", "his_champion",
            "outcome", "competition")

    def opponents(self, how: str) -> DataFrame:
        """Tracked rows with every participant of their match, as in ``normalize``.

        The participants of a match become one list, so a single join by bucket brings both the tracked participant (the
        last of its name in the identity list) and the others.
        """
        one = F.struct("position", "participant_id", "his_id", "his_name", "his_champion", "team_id")
        lists = self.table("participants").groupBy("match_id").agg(F.array_sort(F.collect_list(one)).alias("all"))
        rows = self.table("tracked").join(lists, "match_id", how)
        me = F.element_at(F.filter("all", lambda p: p["his_name"] == F.col("my_name")), -1)  # null if nobody has the name
        each = F.explode_outer if how == "left" else F.explode
        rows = rows.withColumn("me", F.when(F.exists("all", lambda p: p["his_name"] == F.col("my_name")), me)).withColumn("p", each("all"))
        return (rows.select("match_id", "my_id", "my_name", "win_team", "ts", "game_duration", F.coalesce("me.his_champion", F.lit(normalize.NO_CHAMPION)).alias("my_champion"),
                            F.col("me.team_id").alias("my_team"), "p.*")
                .withColumn("outcome", F.when(F.col("team_id") == F.col("win_team"), "Win").otherwise("Fail"))
                .withColumn("competition", F.when(F.col("team_id") == F.col("my_team"), "Together").otherwise("Against")))

    def events(self) -> DataFrame:
        """The nested events of ``normalize.event_documents``, without a shuffle."""
        bans = (self.table("bans").groupBy("match_id").agg(F.array_sort(F.collect_list(F.struct("pos", "champion"))).alias("bs"))
                .select("match_id", F.transform("bs", lambda b: b["champion"]).alias("bans")))
        return normalize.nested(self.opponents("left"), bans)


def open_store(spark: SparkSession, root: str, buckets: int) -> MatchStore:
    """The store below ``root``, new or with what earlier sessions loaded; ``buckets`` must be the number it was made with."""
    tag = uuid.uuid4().hex[:12]
    for name, schema in SCHEMAS.items():
        spark.sql(f"CREATE TABLE skirmish_{name}_{tag} ({schema}) USING parquet CLUSTERED BY (match_id) SORTED BY (match_id) "
                  f"INTO {int(buckets)} BUCKETS LOCATION '{root.rstrip('/')}/{name}'")
    return MatchStore(spark, root, int(buckets), tag)
