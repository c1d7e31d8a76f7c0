"""Overlap of item pairs without listing every pair of a large group.

Input is a set of distinct ``(item, element[, value])`` rows. Two items overlap where they share
elements. Elements held by at most ``max_group`` items are paired directly: at most ``max_group / 2`` pairs
per input row, which travel as lists, a row per item and element, to the item with fewer elements and are summed there.
Elements above that are *heavy* and never paired as a whole:

* a pair already met on a light element looks its heavy elements up by key, from the side that
  has fewer of them;
* a pair that meets on heavy elements only is searched on each item's prefix. With heavy elements
  ordered from rarest to most common, an item that needs ``c`` common elements must meet its
  partner before its last ``c - 1`` elements, so the most common elements never form pairs, and
  size and position rule out partners that cannot reach the limit. What is left of a large group
  is paired block by block.

Both routes are exact: the result is that of the full self-join.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators.numbering import ranked
from gleaner.operators.skew import block_count, skew_join
from gleaner.session import written

MAX_GROUP = 1000
LIST_BYTES = 8 << 20  # an Arrow batch of lists
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


@dataclass(frozen=True)
class Need:
    """What a pair must reach: a number of common elements, and optionally a Jaccard similarity."""

    common: int = 1
    jaccard: float | None = None

    def of_item(self, size: Column) -> Column:
        """Fewest common elements any partner of an item of this size must share with it."""
        least = F.lit(self.common)
        if self.jaccard is None:
            return least
        # rounded down a little so that floating point never asks for one element too many
        return F.greatest(least, F.ceil(size * F.lit(self.jaccard) - F.lit(1e-9)).cast("int"))

    def possible(self, most: Column, size_a: Column, size_b: Column) -> Column:
        """Whether at most ``most`` common elements can be enough."""
        enough = most >= self.common
        if self.jaccard is None:
            return enough
        return enough & (most * (1 + self.jaccard) >= (size_a + size_b) * F.lit(self.jaccard) - F.lit(1e-9))

    def met(self, n: Column, size_a: Column, size_b: Column) -> Column:
        enough = n >= self.common
        if self.jaccard is None:
            return enough
        return enough & (n / (size_a + size_b - n) >= self.jaccard)


def sizes(rows: DataFrame, item: str) -> DataFrame:
    return rows.groupBy(item).agg(F.count("*").cast("int").alias("size"))


def _sums(valued: bool) -> list[Column]:
    if not valued:
        return [F.count("*").alias("n")]
    x, y = F.col("x"), F.col("y")
    return [
        F.count("*").alias("n"),
        F.sum(x).alias("sx"),
        F.sum(y).alias("sy"),
        F.sum(x * x).alias("sxx"),
        F.sum(y * y).alias("syy"),
        F.sum(x * y).alias("sxy"),
    ]


def numbers(values: pa.Array) -> np.ndarray:
    """Integers that are equal where the values are."""
    return values.to_numpy() if pa.types.is_integer(values.type) else values.dictionary_encode().indices.to_numpy()


def _products(x: pa.Array, y: pa.Array) -> list[np.ndarray]:
    """The terms of ``SUMS`` beside their numbers of values; a null has no term."""
    there = [np.asarray(v.is_valid()) for v in (x, y)]
    a, b = (v.fill_null(0).to_numpy() for v in (x, y))
    both = there[0] & there[1]
    return [a, b, a * a, b * b, a * b * both, there[0], there[1], both]


def _pair_numbers(group: np.ndarray, other: np.ndarray) -> np.ndarray:
    """One number for a pair, ascending by group: of the values of ``other`` as they are, or of their places where they lie too far apart."""
    least = int(other.min())
    span = int(other.max()) - least + 1
    if span * (int(group.max()) + 1) >= 1 << 62:
        values, other = np.unique(other, return_inverse=True)
        least, span = 0, len(values)
    return group * span + (other.astype(np.int64) - least)


def _summed(valued: bool, need: Need):
    """Function of a task's batches, sorted by ``one``: the sums of each pair of ``one`` and a listed item.

    Only pairs that can meet ``need`` go on: the listed items have as many elements as ``one`` or more.
    """
    share = 0.0 if need.jaccard is None else 2 * need.jaccard / (1 + need.jaccard)

    def can(n: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (n >= need.common) & (n >= share * size - 1e-9)

    def given(one: pa.Array, size: np.ndarray, other: pa.Array, sums: list[np.ndarray]) -> pa.RecordBatch:
        enough = np.flatnonzero(can(sums[0], size))
        columns = [one.take(pa.array(enough)), other.take(pa.array(enough)), pa.array(sums[0][enough])]
        if valued:
            nx, ny, nxy = (sums[k][enough] == 0 for k in (6, 7, 8))
            for k, none in enumerate((nx, ny, nx, ny, nxy), 1):
                columns.append(pa.array(sums[k][enough], mask=none))
        return pa.RecordBatch.from_arrays(columns, names=["one", "other", *(SUMS if valued else SUMS[:1])])

    def run(batches):
        held = None  # the last item so far: its lists may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            listed = batch.column(2)
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(listed).to_numpy())
            other, ones = listed.flatten(), batch.column(0)
            sums = [np.ones(len(other), np.int64)]
            if valued:
                terms = _products(batch.column(3).take(pa.array(row)), batch.column(4).flatten())
                sums += terms[:5] + [t.astype(np.int64) for t in terms[5:]]
            size = batch.column(1).to_numpy()
            if held is not None:
                ones, other = pa.concat_arrays([held[0], ones]), pa.concat_arrays([held[2], other])
                row = np.concatenate((np.zeros(len(held[2]), np.int64), row + 1))
                size, sums = np.concatenate((held[1], size)), [np.concatenate(s) for s in zip(held[3], sums, strict=True)]
            code = numbers(ones)
            group = np.cumsum(np.concatenate(([False], code[1:] != code[:-1])))
            last = group[-1]
            pair = _pair_numbers(group[row], numbers(other))
            order = np.argsort(pair)
            pair = pair[order]
            starts = np.concatenate(([True], pair[1:] != pair[:-1]))
            first = np.flatnonzero(starts)
            n = np.add.reduceat(sums[0][order], first)
            # most pairs end here: the other sums are taken of those that go on, or may
            kept = can(n, size[row[order[first]]]) | (group[row[order[first]]] == last)
            order, first = order[kept[np.cumsum(starts) - 1]], np.diff(np.append(first, len(order)))[kept]
            first = np.cumsum(first) - first
            sums = [n[kept], *(np.add.reduceat(s[order], first) for s in sums[1:])]
            at = order[first]
            other, row = other.take(pa.array(at)), row[at]
            upto = int(np.searchsorted(group[row], last))
            yield given(ones.take(pa.array(row[:upto])), size[row[:upto]], other.slice(0, upto), [s[:upto] for s in sums])
            held = ones.slice(len(ones) - 1), size[-1:], other.slice(upto), [s[upto:] for s in sums]
        if held is not None:
            n = len(held[2])
            yield given(held[0].take(pa.array(np.zeros(n, np.int64))), np.repeat(held[1], n), held[2], held[3])

    return run


def _paired(rows: DataFrame, size: DataFrame, valued: bool, need: Need) -> DataFrame:
    """``k1, k2`` and sums over the elements of ``rows``, of pairs that can meet ``need`` by these alone.

    The items of an element are listed by size; each takes those behind it, so that an item of very many elements
    collects from none but larger ones. A pair is a number in a list until it is summed.
    """
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(LIST_BYTES))
    known = rows.filter(F.col("item").isNotNull() & F.col("element").isNotNull())
    sized = skew_join(known, size.select("item", "size"), "item")
    values = [F.col("x").cast("double").alias("x")] if valued else []
    members = F.sort_array(F.collect_list(F.struct("size", "item", *values)))  # at most max_group
    lists = sized.groupBy("element").agg(members.alias("m")).filter(F.size("m") > 1)
    lists = lists.select(*[F.col(f"m.{c}").alias(c) for c in ("item", "size", *(["x"] if valued else []))])
    after = lambda c: F.slice(F.col(c), F.col("i") + 2, F.size(c))
    taken = lists.select("*", F.posexplode("item").alias("i", "one")).filter(F.col("i") + 1 < F.size("item")).select(
        "one", F.get("size", "i").alias("of"), after("item").alias("others"),
        *([F.get("x", "i").alias("v"), after("x").alias("vs")] if valued else []),
    )
    kind = rows.schema["item"].dataType
    sums = [T.StructField(c, T.LongType() if c == "n" else T.DoubleType()) for c in (SUMS if valued else SUMS[:1])]
    schema = T.StructType([T.StructField("one", kind), T.StructField("other", kind), *sums])
    dealt = taken.repartition("one").sortWithinPartitions("one")
    found = dealt.mapInArrow(_summed(valued, need), schema)
    turned = F.col("one") > F.col("other")
    of = lambda a, b: F.when(turned, F.col(b)).otherwise(F.col(a))
    return found.select(
        of("one", "other").alias("k1"), of("other", "one").alias("k2"), "n",
        *([of("sx", "sy").alias("sx"), of("sy", "sx").alias("sy"), of("sxx", "syy").alias("sxx"), of("syy", "sxx").alias("syy"), "sxy"] if valued else []),
    )


def overlaps(
    rows: DataFrame,
    item: str,
    element: str,
    value: str | None = None,
    need: Need = Need(),
    max_group: int = MAX_GROUP,
) -> DataFrame:
    """Pairs that meet ``need``: ``k1, k2, n`` and, with ``value``, the sums over common elements."""
    valued = value is not None
    base = rows.select(
        F.col(item).alias("item"), F.col(element).alias("element"), *([F.col(value).alias("x")] if valued else [])
    )
    # counted where the rows lie
    heavy = base.groupBy("element").agg(F.count("*").alias("degree")).filter(F.col("degree") > max_group)
    if heavy.isEmpty():
        return _meeting(_paired(base, sizes(base, "item"), valued, need), base, need)
    heavy = written(heavy, "heavy")
    return _overlaps_with_heavy(base, heavy, valued, need, max_group)


def _meeting(sums: DataFrame, base: DataFrame, need: Need) -> DataFrame:
    """``sums`` have ``need.common`` already."""
    if need.jaccard is None:
        return sums
    return with_sizes(sums, sizes(base, "item")).filter(need.met(F.col("n"), F.col("size1"), F.col("size2")))


def with_sizes(pairs: DataFrame, size: DataFrame, names: tuple[str, str] = ("size1", "size2")) -> DataFrame:
    """Add the sizes of both items of a pair; one item may be in a large share of the pairs."""
    one = size.select(F.col("item").alias("k1"), F.col("size").alias(names[0]))
    two = size.select(F.col("item").alias("k2"), F.col("size").alias(names[1]))
    return pairs.join(one, "k1").join(two, "k2")


def _overlaps_with_heavy(base: DataFrame, heavy: DataFrame, valued: bool, need: Need, max_group: int) -> DataFrame:
    # at most one heavy element per max_group rows, but no constant bound: no broadcast hint here
    degrees = heavy.select("element", F.col("degree").alias("_n"))
    light_rows = skew_join(base, heavy.select("element"), "element", "left_anti", counts=degrees)
    heavy_rows = written(skew_join(base, heavy, "element", counts=degrees), "heavy-rows")
    size = written(
        sizes(base, "item").join(
            heavy_rows.groupBy("item").agg(F.count("*").cast("int").alias("heavy_size")), "item", "left"
        ).fillna(0, ["heavy_size"]),
        "sizes",
    )

    light = written(_paired(light_rows, size, valued, Need()), "light-pairs")  # all of them: heavy elements may add to any
    both = with_sizes(with_sizes(light, size), size.select("item", F.col("heavy_size").alias("size")), ("h1", "h2"))
    reach = F.col("n") + F.least("h1", "h2")
    reachable = both.filter(need.possible(reach, F.col("size1"), F.col("size2")))
    looked_up = reachable.filter(F.least("h1", "h2") > 0).select("k1", "k2", "h1", "h2")

    searched = _heavy_only(heavy_rows, size, need, max_group).join(light, ["k1", "k2"], "left_anti")
    searched = with_sizes(searched, size.select("item", F.col("heavy_size").alias("size")), ("h1", "h2"))
    common = common_sums(looked_up.unionByName(searched), heavy_rows, valued)

    keep = ["k1", "k2", *(SUMS if valued else SUMS[:1])]
    parts = reachable.select(*keep).unionByName(common.select(*keep))
    total = parts.groupBy("k1", "k2").agg(*[F.sum(c).alias(c) for c in keep[2:]])
    enough = with_sizes(total, size.select("item", "size"))
    return enough.filter(need.met(F.col("n"), F.col("size1"), F.col("size2"))).select(
        *keep, *(["size1", "size2"] if need.jaccard is not None else [])
    )


def common_sums(pairs: DataFrame, rows: DataFrame, valued: bool) -> DataFrame:
    """Sums over the common elements of given ``k1, k2`` with list lengths ``h1, h2`` in the given rows.

    The shorter list is read and the longer one probed by key.
    """
    values = ["x"] if valued else []
    from_one = F.col("h1") <= F.col("h2")
    probes = pairs.select(
        "k1", "k2", from_one.alias("from_one"),
        F.when(from_one, F.col("k1")).otherwise(F.col("k2")).alias("read"),
        F.when(from_one, F.col("k2")).otherwise(F.col("k1")).alias("probe"),
    )
    reading = rows.select(F.col("item").alias("read"), "element", *[F.col(v).alias("vr") for v in values])
    probing = rows.select(F.col("item").alias("probe"), "element", *[F.col(v).alias("vp") for v in values])
    met = skew_join(probes, reading, "read").join(probing, ["probe", "element"])
    if valued:
        one = F.col("from_one")
        met = met.withColumns({
            "x": F.when(one, F.col("vr")).otherwise(F.col("vp")),
            "y": F.when(one, F.col("vp")).otherwise(F.col("vr")),
        })
    return met.groupBy("k1", "k2").agg(*_sums(valued))


def _heavy_only(heavy_rows: DataFrame, size: DataFrame, need: Need, max_group: int) -> DataFrame:
    """Pairs that could reach the need through heavy elements alone: ``k1, k2``."""
    placed = ranked(
        heavy_rows.select("item", "element", "degree"), "item", [F.desc("degree"), F.desc("element")], "place"
    )
    # elements of the item that are more common than this one
    prefix = skew_join(placed, size.select("item", "size", "heavy_size"), "item").select(
        "item", "element", "size", (F.col("place") - 1).cast("int").alias("after")
    )
    prefix = written(prefix.filter(F.col("after") >= need.of_item(F.col("size")) - 1), "prefix")

    # blocks of about max_group rows; each pair of blocks of an element is one small join group
    counts = prefix.groupBy("element").agg(F.count("*").alias("_n"))
    blocks = counts.filter(F.col("_n") > 1).select("element", block_count(F.col("_n"), max_group).alias("blocks"))
    cut = skew_join(prefix, blocks, "element", counts=counts).withColumn(
        "block", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int")
    )
    left = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = cut.withColumn("mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left = left.select(
        "element", F.col("block").alias("b1"), F.col("other").alias("b2"),
        F.col("item").alias("k1"), F.col("size").alias("s1"), F.col("after").alias("a1"),
    )
    right = right.select(
        "element", F.col("mine").alias("b1"), F.col("block").alias("b2"),
        F.col("item").alias("k2"), F.col("size").alias("s2"), F.col("after").alias("a2"),
    )
    met = left.join(right, ["element", "b1", "b2"]).filter(F.col("k1") < F.col("k2"))
    most = F.least("a1", "a2") + 1
    return met.filter(need.possible(most, F.col("s1"), F.col("s2"))).select("k1", "k2").distinct()
