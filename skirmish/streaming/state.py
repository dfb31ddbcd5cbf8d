"""Stateful operators: running totals per champion, and match lists that wait for their matches.

Both run on ``transformWithState`` (pandas form), which needs the RocksDB state store; ``rocksdb`` switches it on for the
queries started inside it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Ship the processors with the query, so Python workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside use the RocksDB state store."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


# ---- running totals per champion ------------------------------------------------------------------

class Totals(StatefulProcessor):
    """State: the bans of a champion so far.  Emits that total as it was before the batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer) -> Iterator[pd.DataFrame]:
        before = self.total.get()[0] if self.total.exists() else 0
        self.total.update((before + sum(int(r["n"].sum()) for r in rows),))
        yield pd.DataFrame({"champion": [key[0]], "prior": [before]})

    def close(self) -> None:
        pass


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pc.value_counts(batch.column(0))
        yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["champion", "n"])


def prior_totals(bans: DataFrame) -> DataFrame:
    """Streaming (champion, prior): the total of every champion of the batch before that batch.

    Bans are counted inside the tasks first, so the state of a hot champion gets a row per task, not one per ban.
    """
    counts = bans.select("champion").mapInArrow(_partial_counts, "champion string, n bigint")
    return counts.groupBy("champion").transformWithStateInPandas(Totals(), "champion string, prior bigint", "Update", "None")


# ---- match lists and matches ------------------------------------------------------------------------

class Arrivals(StatefulProcessor):
    """State of a game: whether its match has arrived, and the accounts whose lists name it."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.arrived = handle.getValueState("arrived", "yes boolean", self.ttl_ms)
        self.listed = handle.getMapState("listed", "account string", "yes boolean", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer) -> Iterator[pd.DataFrame]:
        before = now = self.arrived.exists()
        new = {}
        for batch in rows:
            now = now or bool(batch["is_match"].any())
            for account in batch.loc[~batch["is_match"], "account_id"]:
                if not self.listed.containsKey((account,)):
                    new[account] = True
        told = list(new)
        if now and not before:  # those that waited
            told = [k[0] for k in self.listed.keys()] + told
            self.arrived.update((True,))
        for account in new:
            self.listed.updateValue((account,), (True,))
        if told:
            yield pd.DataFrame({"account_id": told, "game_id": [key[0]] * len(told), "status": ["matched" if now else "pending"] * len(told)})

    def close(self) -> None:
        pass


def list_arrivals(lists: DataFrame, matches: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Streaming (account_id, game_id, status) over two streams: list entries (account_id, game_id) and matches (game_id).

    An entry is ``pending`` until its match is there and then ``matched``, whichever comes first.  A game's state is one row of a
    streaming aggregate (whether its match has arrived, and the few accounts whose lists name it), so no game passes through Python;
    a batch gives the entries of every game it touches, those told before among them.  ``ttl_ms`` bounds the state, which only
    ``Arrivals`` can do (game by game in Python, slow for millions of games) and which gives an entry only when it is new or changes: a
    game whose list or match did not come in that time is forgotten (its entries stay pending in the output).
    """
    both = lists.select(F.col("account_id").cast("string"), "game_id", F.lit(False).alias("is_match")).unionByName(
        matches.select(F.lit(None).cast("string").alias("account_id"), "game_id", F.lit(True).alias("is_match")))
    known = both.filter("game_id is not null and (is_match or account_id is not null)")
    if ttl_ms:
        return known.groupBy("game_id").transformWithStateInPandas(
            Arrivals(ttl_ms), "account_id string, game_id bigint, status string", "Update", "ProcessingTime")
    games = known.groupBy("game_id").agg(F.bool_or("is_match").alias("arrived"), F.collect_set("account_id").alias("listed"))
    return games.select(F.explode("listed").alias("account_id"), F.col("game_id").cast("bigint"),
                        F.when(F.col("arrived"), "matched").otherwise("pending").alias("status"))
