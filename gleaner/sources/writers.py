"""Reports, models and line files, written by the tasks that hold the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.numbering import numbered

ORDER = "_order"  # folder beside the files of an ordered text, which readers of the text itself skip
PIECE = 1000  # averages to a JSON object


def review_report(stats: DataFrame, users: DataFrame, words: DataFrame) -> DataFrame:
    """``value``: one JSON object A to E from the statistics row and the two top lists (m and n rows)."""
    user_list = users.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "user_id", "n"))).alias("l")
    ).select(F.transform("l", lambda u: F.array(u["user_id"].cast("string"), u["n"].cast("string"))))
    word_list = words.agg(F.array_sort(F.collect_list("word")))
    return stats.select(F.to_json(F.struct(
        F.col("total").alias("A"),
        F.col("in_year").alias("B"),
        F.col("users").alias("C"),
        user_list.scalar().alias("D"),
        word_list.scalar().alias("E"),
    )).alias("value"))


def category_report(top: DataFrame) -> DataFrame:
    """``value``: ``{"result": [[category, stars], …]}`` of a top-n list."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("stars")).alias("o"), "category", "stars")))
    shown = F.transform(ordered, lambda c: F.array(c["category"], c["stars"].cast("string")))
    return top.agg(F.to_json(F.struct(shown.alias("result"))).alias("value"))


def partition_report(stats: DataFrame, found: DataFrame, per_line: int = 1000) -> DataFrame:
    """``value``: JSON lines with the partition counts first, then pieces of the popular list."""
    by_pid = F.array_sort(F.collect_list(F.struct("pid", "n_items")))
    head = stats.agg(F.to_json(F.struct(
        F.count("*").alias("n_partitions"), F.transform(by_pid, lambda p: p["n_items"]).alias("n_items")
    )).alias("value")).withColumn("line", F.lit(-1).cast("long"))
    placed = numbered(found, [F.desc("n"), "business_id"], "pos")
    rows = placed.groupBy(F.floor(F.col("pos") / F.lit(per_line)).alias("line")).agg(
        F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("pos", "business_id", "n"))).alias("result"))).alias("value")
    )
    return head.unionByName(rows).orderBy("line").select("value")


def write_report(report: DataFrame, path: str) -> None:
    report.write.text(path)


def write_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.json(path)


def write_profiles(model: DataFrame, path: str) -> None:
    """Long-form profile rows, one folder per kind."""
    model.write.partitionBy("description").json(path)


def write_pairs(pairs: DataFrame, path: str) -> None:
    pairs.write.option("header", True).csv(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """``line_no, line`` as text files whose names follow the line order."""
    lines.orderBy("line_no").select("line").write.text(path)


def write_ordered(lines: DataFrame, path: str) -> None:
    """``line_no, line`` as text files, each a range of lines in order, and the order of the files beside them.

    Ranges are cut by Spark from a sample of the numbers; no task holds more than a range. ``file, place`` of every file is a
    small table in ``path/_order``: what reads the text in order goes by it, not by the names.
    """
    placed = lines.select("line_no", F.col("line").alias("value")).repartitionByRange("line_no").sortWithinPartitions("line_no")
    placed.select("value").write.text(path)
    files = lines.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(  # names only
        F.element_at(F.split("path", "/"), -1).alias("file")
    )
    place = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    files.select("file", place.alias("place")).write.json(f"{path}/{ORDER}")


def write_csv_ordered(rows: DataFrame, order: list[Column | str], path: str) -> None:
    """Comma-separated rows in order, the header on the first line, as ordered text files; no value holds a comma or quote."""
    shown = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns])
    lines = numbered(rows, order, "line_no").select((F.col("line_no") + 1).alias("line_no"), shown.alias("line"))
    head = rows.sparkSession.createDataFrame([(0, ",".join(rows.columns))], "line_no long, line string")
    write_ordered(lines.unionByName(head), path)


def write_averages(averages: DataFrame, overall: DataFrame, path: str, unknown: str = "UNK") -> None:
    """``id, avg`` as JSON objects of up to about ``PIECE`` ids, the entry ``unknown`` (``avg`` of ``overall``) in one of its own."""
    n = averages.count()
    entries = averages.select(F.col("id").cast("string").alias("id"), "avg")
    pieces = entries.groupBy(F.pmod(F.xxhash64("id"), F.lit(-(-n // PIECE) or 1)).alias("piece"))
    known = pieces.agg(F.map_from_entries(F.collect_list(F.struct("id", "avg"))).alias("m"))
    other = overall.select(F.lit(-1).cast("long").alias("piece"), F.create_map(F.lit(unknown), "avg").alias("m"))
    known.unionByName(other).select(F.to_json("m").alias("value")).write.text(path)


def write_store(model: DataFrame, path: str) -> None:
    """Long-form profile rows, all kinds in one Parquet table with a partition per kind."""
    model.write.partitionBy("description").parquet(path)


def membership_lines(flags: DataFrame, order: Column | str, per_line: int = 1000) -> DataFrame:
    """``line_no, line``: flags in input order as ``1 0 1``, ``per_line`` to a line."""
    placed = numbered(flags.select(F.col(order).alias("seq") if isinstance(order, str) else order.alias("seq"), "flag"),
                      ["seq"], "pos")
    joined = F.array_sort(F.collect_list(F.struct("pos", F.col("flag").cast("string").alias("f"))))["f"]
    return placed.groupBy(F.floor(F.col("pos") / F.lit(per_line)).alias("line_no")).agg(
        F.array_join(joined, " ").alias("line")
    )
