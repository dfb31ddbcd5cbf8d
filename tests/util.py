"""Helpers shared by tests: DuckDB over the driver tables, frame comparison,
small hand-written match models, plan text."""

from __future__ import annotations


import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normalise(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            if getattr(s.dt, "tz", None) is not None:
                s = s.dt.tz_convert("UTC").dt.tz_localize(None)
            df[c] = s.astype("datetime64[us]").astype(str)
        elif pd.api.types.is_float_dtype(s) or pd.api.types.is_integer_dtype(s) and s.isna().any():  # nullable integers come as either
            df[c] = s.astype("float64").round(6).astype(str)
        else:
            df[c] = s.astype(object).where(s.notna(), None).astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def same_rows(a: pd.DataFrame, b: pd.DataFrame) -> bool:
    return sorted(a.columns) == sorted(b.columns) and len(a) == len(b) and normalise(a).equals(normalise(b))


def rows(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.collect())


def executed_plan(df) -> str:
    """Physical plan text after execution (AQE final plan)."""
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def match_model(spark, matches, participants, bans=(), players=None, champions=None, match_list=None):
    """A small MatchTables from Python rows (unit-test inputs only)."""
    from skirmish import schemas
    from skirmish.sources.tables import MatchTables

    champions = champions if champions is not None else [(i, f"Champ{i}") for i in range(1, 20)]
    players = players if players is not None else [(k, f"P{k}", k < 10) for k in range(1, 30)]
    if match_list is None:
        match_list = [(m[7], m[0]) for m in matches]  # (tracked player, match)
    m_rows = [m[:7] for m in matches]
    return MatchTables(
        champions=spark.createDataFrame(champions, schemas.CHAMPIONS),
        players=spark.createDataFrame(players, schemas.PLAYERS),
        matches=spark.createDataFrame(m_rows, schemas.MATCHES),
        match_list=spark.createDataFrame(match_list, schemas.MATCH_LIST),
        participants=spark.createDataFrame(list(participants), schemas.PARTICIPANTS),
        bans=spark.createDataFrame(list(bans), schemas.BANS),
    )
