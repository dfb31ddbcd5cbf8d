"""Shared by the tests of the training-data operators."""

from __future__ import annotations

import duckdb

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, shard string, p int, size string"


def awkward(spark):
    """Documents with nulls in every column, empty and long texts, copies, repeated rows and clashing extra columns."""
    long = "lorem ipsum dolor sit amet " * 20000 + "end"
    rows = [(1, "the quick brown fox jumps over the lazy dog again and again today", "en", "a"), (2, None, "en", "a"),
            (3, "", None, None), (4, long, "en", "a"), (5, "the quick brown fox jumps over the lazy dog again and again today", "de", None),
            (5, "the quick brown fox jumps over the lazy dog again and again today", "de", None), (6, " \n\t ", "en", "b"),
            (None, "text without an id but with some words in it to read here", None, "b"), (7, "Ünïcödé 😀 字 word", "fr", "b"),
            (-3, "a b c", "en", "a")]
    return spark.createDataFrame([(i, t, g, s, None, None, "x", 1, "y") for i, t, g, s in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def duck(sf_dir, tables=("documents", "pages", "labels")):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
