"""Edge and vertex files of the graph (readers S2/S3, writers T4/T5).

Parquet is the default format.  CSV (headerless, as the reference writes it)
is supported with options that make it lossless: by default Spark's CSV writer
trims names and writes "" as null; here leading/trailing blanks are kept and
null is written as \\N on both sides, so blanks, quotes, commas, empty strings
and nulls all survive the round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas

CSV_OPTIONS = {
    "header": "false",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",
    "escape": '"',
}


def write_graph_file(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                     skip_empty: bool = False) -> bool:
    """Append (or overwrite) a batch of edges / vertices; returns whether written.

    ``skip_empty`` avoids producing an empty file for an empty batch (the
    reference guards edges this way, not vertices).
    """
    if skip_empty and df.isEmpty():
        return False
    w = df.write.mode(mode)
    if fmt == "csv":
        w.options(**CSV_OPTIONS).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return True


def _read(spark: SparkSession, path: str, schema, fmt: str) -> DataFrame:
    """Read with the fixed schema; partition columns of per-batch folders
    (``batch_id=N``) are dropped so the contract stays the file schema."""
    if fmt == "csv":
        df = spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)
    elif fmt == "parquet":
        df = spark.read.schema(schema).parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return df.select(*schema.fieldNames())


def read_edges(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, schemas.EDGE, fmt)


def read_vertices(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, schemas.VERTEX, fmt)
