"""Running counts / row numbers that stay distributed under heavy key skew.

A plain ``row_number() OVER (PARTITION BY k ORDER BY o)`` sends every row of
a key to one task; with one key holding a third of the data that task is the
job.  Here the order space is cut into blocks: the window only ever spans one
(key, block), and a block's starting offset is a prefix sum over per-block
counts:

    n      = count(*) group by key, block               -- combined map-side, one row per block
    offset = sum(n) over (key order by block rows unbounded preceding .. -1)
    result = row_number() over (key, block order by o) + offset

Choose blocks so that the offsets are few next to the rows.  The rows cross the
network once; the counts read the input a second time, so hand in a table (or a
materialised frame), not an expensive plan.  Keys may be null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def blocked_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                       block: Column, out: str = "rn", total: str | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row within its key in ``order``.

    ``block`` must be monotone (non-decreasing) in ``order`` within a key, e.g.
    ``floor(match_id / block_size)`` when ordering by match_id.  When ``total``
    is given, the key's row count is added as well.
    """
    keys = list(keys)
    b = "__block"
    rows = df.withColumn(b, F.coalesce(block, F.lit(0)).cast("bigint"))
    per_block = rows.groupBy(*keys, b).agg(F.count("*").alias("__n"))
    prior = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    named = [F.col(k).alias(f"__k{i}") for i, k in enumerate([*keys, b])]
    extra = [F.sum("__n").over(Window.partitionBy(*keys)).alias(total)] if total else []
    offsets = per_block.select(*named, F.coalesce(F.sum("__n").over(prior), F.lit(0)).alias("__off"), *extra)
    local = rows.withColumn("__local", F.row_number().over(Window.partitionBy(*keys, b).orderBy(*order)))
    same = F.lit(True)
    for i, k in enumerate([*keys, b]):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    joined = local.join(offsets, same)
    return joined.withColumn(out, (F.col("__local") + F.col("__off")).cast("bigint")).select(
        *df.columns, out, *([total] if total else []))


def range_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "rn", parts: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row within its key in ``order``, whatever the keys and order values are.

    Rows are range-partitioned by (keys, order, a row id), so blocks follow the rows, not the values: a hot key, wide or missing
    order values and ties are all cut into parts of equal size.  The sorted rows are written once; a part's offset is a prefix
    sum over (key, part).  ``parts`` is the number of parts (default: the session's shuffle partitions).
    """
    keys, at = list(keys), "__at"
    along = [*keys, *order, "__tie"]
    rows = df.withColumn("__tie", F.monotonically_increasing_id())
    placed = materialize(rows.repartitionByRange(*([parts] if parts else []), *along).sortWithinPartitions(*along).drop("__tie")
                         .withColumn(at, F.monotonically_increasing_id()), "ranked")
    part = F.call_function("shiftright", F.col(at), F.lit(33))
    counts = placed.groupBy(*keys, part.alias("__p")).agg(F.min(at).alias("__low"), F.count("*").alias("__n"))
    prior = Window.partitionBy(*keys).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    named = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    offsets = counts.select(*named, F.col("__p").alias("__kp"), (F.coalesce(F.sum("__n").over(prior), F.lit(0)) - F.col("__low") + 1).alias("__off"))
    same = F.col("__p") == F.col("__kp")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return placed.withColumn("__p", part).join(offsets, same).withColumn(out, (F.col(at) + F.col("__off")).cast("bigint")).select(*df.columns, out)
