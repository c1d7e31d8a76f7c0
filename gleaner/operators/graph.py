"""Co-occurrence graphs and label-propagation communities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import quoted
from gleaner.operators import pairs as pair_operators
from gleaner.operators.numbering import numbered
from gleaner.operators.pairs import Need, overlaps
from gleaner.operators.skew import skew_join
from gleaner.session import written

ROUNDS = 5


def cooccur_edges(
    pairs: DataFrame, node: str, shared: str, min_shared: int, max_group: int = pair_operators.MAX_GROUP
) -> DataFrame:
    """``src, dst, n``: nodes that share at least ``min_shared`` values, ``src < dst``.

    ``pairs`` are distinct rows of a table.
    """
    found = overlaps(pairs.select(node, shared), node, shared, need=Need(min_shared), max_group=max_group)
    return found.select(F.col("k1").alias("src"), F.col("k2").alias("dst"), "n")


def nodes(edges: DataFrame) -> DataFrame:
    """``id`` of every node that has an edge."""
    ends = F.explode(F.array("src", "dst"))
    return edges.select(ends.alias("id")).distinct()


def label_propagation(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``id, label`` after a fixed number of rounds over undirected edges.

    A node takes the most frequent label among its neighbours, the smallest on ties. Each round is
    written out: the next one reads a table instead of the whole history.
    """
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = written(both.distinct(), "links")
    degrees = written(both.groupBy("src").agg(F.count("*").alias("_n")), "degrees")
    labels = degrees.select(F.col("src").alias("id"), F.col("src").alias("label"))
    for _ in range(rounds):
        sent = skew_join(both, labels.withColumnRenamed("id", "src"), "src", counts=degrees)
        votes = sent.groupBy("dst", "label").agg(F.count("*").alias("n"))
        # most votes first, then the smallest label: two aggregations that combine before the shuffle
        best = votes.groupBy("dst").agg(F.max_by("label", F.struct("n", _smaller_first(votes, "label"))).alias("label"))
        labels = written(best.select(F.col("dst").alias("id"), "label"), "labels")
    return labels


def _smaller_first(df: DataFrame, column: str):
    """An expression that orders ``column`` the other way round, for numeric and string labels."""
    if df.schema[column].dataType.typeName() in ("byte", "short", "integer", "long", "double", "float"):
        return -F.col(column)
    # complement every hex digit and close with a mark above them: a prefix then sorts after its extensions
    return F.concat(F.translate(F.hex(F.encode(column, "UTF-8")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("~"))


def communities(labels: DataFrame) -> DataFrame:
    """``label, size, member`` in long form: a community may hold a large share of all nodes."""
    size = labels.groupBy("label").agg(F.count("*").alias("size"))
    counts = size.select("label", F.col("size").alias("_n"))
    return skew_join(labels, size, "label", counts=counts).select("label", "size", F.col("id").alias("member"))


def community_lines(members: DataFrame, per_line: int = 1000) -> DataFrame:
    """``line_no, line``: communities by size and first member, members in order as ``'a', 'b'``.

    A community with more than ``per_line`` members continues on the next lines.
    """
    first = members.groupBy("label").agg(F.min("member").alias("first"))
    counts = members.groupBy("label").agg(F.count("*").alias("_n"))
    keyed = skew_join(members, first, "label", counts=counts)
    placed = numbered(keyed, ["size", "first", "member"], "pos")
    start = placed.groupBy("label").agg(F.min("pos").alias("start"))
    placed = skew_join(placed, start, "label", counts=counts).withColumn(
        "piece", F.floor((F.col("pos") - F.col("start")) / F.lit(per_line))
    )
    lines = placed.groupBy("size", "first", "piece").agg(
        quoted(F.array_sort(F.collect_list("member"))).alias("line")
    )
    return numbered(lines, ["size", "first", "piece"], "line_no").select("line_no", "line")
