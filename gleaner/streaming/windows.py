"""Distinct counts over sliding windows, for tables and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleaner.functions.hashing import FM_BUCKETS, FM_HASHES, SEED, text_number
from gleaner.operators.sketch import fm_tails, fm_total

WINDOW = "30 seconds"
SLIDE = "10 seconds"
LG_K = 12  # a sketch has 2 ** 12 slots, a standard error of 1.6 %


def fm_windows(
    df: DataFrame,
    ts: str,
    column: str,
    window: str = WINDOW,
    slide: str = SLIDE,
    watermark: str | None = None,
    hashes: int = FM_HASHES,
    m: int = FM_BUCKETS,
    seed: int = SEED,
    group_mean: bool = False,
) -> DataFrame:
    """``window_start, exact, estimate`` per window with at least one value.

    First the distinct values of each window, then one row per window: state and memory hold one row per
    window and value, never the set of a window. On a stream, give ``watermark`` and write in append mode.
    """
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if watermark is not None:
        timed = timed.withWatermark(ts, watermark)
    known = timed.filter(F.col(column).isNotNull() & (F.col(column) != ""))
    # the number of a value is found per input row, before rows are repeated for each window
    numbered = known.select(ts, column, text_number(F.col(column)).alias("_x"))
    values = numbered.groupBy(F.window(ts, window, slide).alias("window"), column, "_x").agg(F.count("*").alias("_seen"))
    tails = values.select("window", *fm_tails("_x", hashes, m, seed))
    counted = tails.groupBy("window").agg(
        F.count("*").alias("exact"), *[F.max(f"r{i}").alias(f"r{i}") for i in range(hashes)]
    )
    return counted.select(
        F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "exact",
        F.floor(fm_total(hashes, group_mean)).alias("estimate"),
    )


def pane_sketches(
    df: DataFrame, ts: str, column: str, pane: str = SLIDE, hashes: int = FM_HASHES, m: int = FM_BUCKETS, seed: int = SEED, lg_k: int = LG_K
) -> DataFrame:
    """``pane, sketch, r0 …``: a distinct-count sketch and the largest tails of each pane, a window part of one slide.

    A row has a fixed size whatever the pane holds. States of days, parts or streams can be kept and united later.
    """
    known = df.withColumn(ts, F.col(ts).cast("timestamp")).filter(F.col(column).isNotNull() & (F.col(column) != ""))
    rows = known.withColumn("_x", text_number(F.col(column)))
    tails = fm_tails("_x", hashes, m, seed)
    return rows.select(F.window(ts, pane)["start"].alias("pane"), column, *tails).groupBy("pane").agg(
        F.hll_sketch_agg(column, lg_k).alias("sketch"), *[F.max(f"r{i}").alias(f"r{i}") for i in range(hashes)]
    )


def united_windows(
    panes: DataFrame, window: str = WINDOW, pane: str = SLIDE, hashes: int = FM_HASHES, group_mean: bool = False
) -> DataFrame:
    """``window_start, estimate, sketched`` of every window from the states of its panes: no value is looked at again.

    ``estimate`` is that of the tails, ``sketched`` that of the united sketches. ``window`` is a multiple of ``pane``.
    """
    seconds = lambda text: F.unix_seconds(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {text}"))
    back = F.sequence(F.lit(0).cast("long"), F.floor(seconds(window) / seconds(pane)) - 1)
    parts = panes.withColumn("_back", F.explode(back))
    start = F.timestamp_seconds(F.unix_seconds("pane") - F.col("_back") * seconds(pane))
    tails = [F.max(f"r{i}").alias(f"r{i}") for i in range(hashes)]
    united = parts.groupBy(start.alias("start")).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("sketched"), *tails)
    return united.select(
        F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.floor(fm_total(hashes, group_mean)).alias("estimate"),
        "sketched",
    )


def write_windows(windows: DataFrame, path: str, checkpoint: str, every: str | None = "5 seconds") -> StreamingQuery:
    """Append finished windows as CSV ``Time,Ground Truth,Estimation``; ``every=None`` handles what is there and ends."""
    shown = windows.select(
        F.col("window_start").alias("Time"), F.col("exact").alias("Ground Truth"), F.col("estimate").alias("Estimation")
    )
    writer = shown.writeStream.outputMode("append").format("csv").option("header", True)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)
