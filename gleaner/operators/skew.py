"""Joins whose left side may hold a large share of its rows under one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.session import written

HOT_ROWS = 1_000_000  # rows of one key a single task may take
MAX_HOT_KEYS = 10_000  # hot keys that are broadcast; more of them travel as a table


def hot_keys(
    rows: DataFrame | None,
    keys: str | list[str],
    limit: int = HOT_ROWS,
    counts: DataFrame | None = None,
    most: int = MAX_HOT_KEYS,
) -> list | DataFrame:
    """Keys with more than ``limit`` rows, each with ``_pieces``, the number of pieces to split it into.

    The count is a map-side combined aggregation (or given as ``counts``: the keys and ``_n``). Up to ``most`` keys come
    as a list; more of them stay a written table, all of them, and never reach the driver.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if counts is None:
        counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    # the pieces of all keys together are at most one per ``limit`` rows of the data, and one per key
    pieces = F.ceil(F.col("_n") / limit).cast("int")
    hot = counts.filter(F.col("_n") > limit).select(*keys, pieces.alias("_pieces"))
    first = hot.limit(most + 1).collect()
    return first if len(first) <= most else written(hot, "hot-keys")


def skew_join(
    big: DataFrame,
    small: DataFrame,
    keys: str | list[str],
    how: str = "inner",
    limit: int = HOT_ROWS,
    counts: DataFrame | None = None,
    hot: list | DataFrame | None = None,
    most: int = MAX_HOT_KEYS,
) -> DataFrame:
    """``big.join(small, keys, how)`` with hot keys of ``big`` spread over several tasks.

    Every hot key is cut into pieces by a hash of its other columns and the matching rows of
    ``small`` are repeated once per piece, so all rows still meet. The hot keys are looked up in ``big``, or in
    ``counts``, or taken from ``hot``, an earlier answer of ``hot_keys`` for the same key values: which keys are
    split decides how the work is spread, never the result. Up to ``most`` of them are broadcast; a longer list is
    joined by key, where AQE splits the partitions of hot keys. Without hot keys this is the plain join.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if hot is None:
        hot = hot_keys(big, keys, limit, counts, most)
    if not isinstance(hot, DataFrame) and not hot:
        return big.join(small, keys, how)
    left = salted(big, keys, hot)
    right = (
        small.join(hot_table(big, keys, hot), keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)))
        .drop("_pieces")
    )
    return left.join(right, keys + ["_salt"], how).drop("_salt")


def hot_table(rows: DataFrame, keys: list[str], hot: list | DataFrame) -> DataFrame:
    if isinstance(hot, DataFrame):
        return hot.toDF(*keys, "_pieces")
    fields = [T.StructField(k, rows.schema[k].dataType) for k in keys] + [T.StructField("_pieces", T.IntegerType())]
    return F.broadcast(rows.sparkSession.createDataFrame([tuple(h) for h in hot], T.StructType(fields)))  # <= MAX_HOT_KEYS rows


def salted(rows: DataFrame, keys: str | list[str], hot: list | DataFrame) -> DataFrame:
    """``rows`` with ``_salt``: the piece of its key that a row falls to by a hash of the other columns, 0 if it isn't hot."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in rows.columns if c not in keys] or keys
    joined = rows.join(hot_table(rows, keys, hot), keys, "left")
    return joined.withColumn("_salt", F.pmod(F.xxhash64(*others), F.coalesce(F.col("_pieces"), F.lit(1))).cast("int")).drop("_pieces")


def block_count(rows: Column, limit: int) -> Column:
    """How many blocks of about ``limit`` rows a group of ``rows`` rows is cut into."""
    return F.ceil(rows / F.lit(limit)).cast("int")
