"""Positions in a total order, computed by range partitions instead of one sorting task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.operators.skew import skew_join
from gleaner.session import written


def numbered(rows: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """Add the 0-based position of each row in ``order``.

    Rows are range-partitioned and sorted inside each partition; the placement is written out because
    range bounds are sampled anew on every run. The offset of a partition is the size of those before it:
    that table has one row per partition.
    """
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = written(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_row": local}),
        "numbered",
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .drop("_part", "_row", "_offset")
    )


def ranked(rows: DataFrame, group: str, order: list[Column | str], name: str) -> DataFrame:
    """1-based rank inside ``group``, also for groups too large for one task."""
    placed = numbered(rows, [group, *order], "_pos")
    first = placed.groupBy(group).agg(F.min("_pos").alias("_first"))
    return (
        skew_join(placed, first, group)
        .withColumn(name, F.col("_pos") - F.col("_first") + 1)
        .drop("_pos", "_first")
    )


def token_dict(rows: DataFrame, column: str) -> DataFrame:
    """Dense 0-based token of every distinct id, in id order: ``id, token``."""
    ids = rows.select(F.col(column).alias("id")).filter(F.col("id").isNotNull()).distinct()
    return numbered(ids, ["id"], "token")


def encode(
    rows: DataFrame, tokens: DataFrame, column: str, name: str, counts: DataFrame | None = None
) -> DataFrame:
    """Add the token of ``column``; ``counts`` as in ``skew_join``."""
    coded = tokens.select(F.col("id").alias(column), F.col("token").alias(name))
    return skew_join(rows, coded, column, counts=counts)
