"""A table replayed as a stream: its rows arrive in order, in parts, and the query starts anew for every part."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

MAX_PARTS = 1000


def parts_of(rows: DataFrame, order: str, parts: int) -> list[DataFrame]:
    """``rows`` cut into up to ``parts`` ranges of the number or time ``order``, about equal in rows; nulls come first.

    The bounds are percentiles, found in one aggregation; each part is a filter that reaches the scan.
    """
    if not 1 <= parts <= MAX_PARTS:
        raise ValueError(f"1 to {MAX_PARTS} parts")
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return [rows]
    kind = rows.schema[order].dataType
    timed = isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType))
    place = F.unix_micros(F.col(order).cast("timestamp")) if timed else F.col(order)
    bounds = rows.agg(F.percentile_approx(place, shares, 100_000).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    cut = lambda v: F.timestamp_micros(F.lit(v)).cast(kind) if timed else F.lit(v)
    if not bounds:
        return [rows]
    first = rows.filter(F.col(order).isNull() | (F.col(order) <= cut(bounds[0])))
    middle = [rows.filter((F.col(order) > cut(a)) & (F.col(order) <= cut(z))) for a, z in zip(bounds, bounds[1:], strict=False)]
    return [first, *middle, rows.filter(F.col(order) > cut(bounds[-1]))]


def source(spark: SparkSession, folder: str, schema: T.StructType, per_trigger: int | None = None) -> DataFrame:
    """The stream of Parquet files that arrive in ``folder``; ``per_trigger`` bounds the files of a micro-batch."""
    spark.createDataFrame([], schema).write.mode("append").parquet(folder)  # the folder must be there first
    reader = spark.readStream.schema(schema)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(folder)


def replay(parts: Iterable[DataFrame], folder: str, start: Callable[[], StreamingQuery]) -> list[StreamingQuery]:
    """Let the parts arrive in ``folder`` one after the other, and run the query over each.

    ``start`` starts it on ``source(folder)`` with a trigger that ends when all there is has been read, and with the same
    checkpoint every time: each part is a micro-batch or more, and each but the first goes on from the state that the run
    before left.
    """
    ran = []
    for part in parts:
        part.write.mode("append").parquet(folder)
        query = start()
        query.awaitTermination()
        ran.append(query)
    return ran


def closing_row(rows: DataFrame, ts: str, after: str) -> DataFrame:
    """One row like the latest of ``rows`` but ``after`` later, an interval: it moves the watermark past all windows.

    Its own window stays open, so it adds nothing to what is written. No rows: none.
    """
    last = rows.filter(F.col(ts).isNotNull()).orderBy(F.desc(ts)).limit(1)
    later = (F.col(ts).cast("timestamp") + F.expr(f"interval {after}")).cast(rows.schema[ts].dataType)
    return last.withColumn(ts, later).select(rows.columns)
