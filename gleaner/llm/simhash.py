"""Near copies by SimHash fingerprints and a Gray-order hierarchical index."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import UPPER_TO_LOWER, free_names, per_text
from gleaner.llm.components import components
from gleaner.session import written

BUCKET = 4096  # fingerprints that one block of a bucket holds about; larger buckets become pairs of blocks
LEAF = 16  # fingerprints under a leaf node, and leaves under an upper node
PATTERN = 1024  # fingerprints that a masked pattern holds about: with more, patterns get more bits


def _fingerprints(width: int, seed: int):
    import xxhash

    digest = xxhash.xxh64_intdigest

    def one(text: bytes) -> int:
        words = text.translate(UPPER_TO_LOWER).split()
        if not words:
            return 0
        joined = b" ".join(words)
        starts = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
        n = max(1, len(words) - width + 1)
        begin, end = starts[:n].tolist(), (starts[min(width, len(words)) :][:n] - 1).tolist()
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(begin, end, strict=True)], "<u8")
        counts = np.zeros(64, np.int64)
        for i in range(0, n, 1 << 16):
            counts += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        bits = np.packbits(2 * counts > n, bitorder="little")
        return int(bits.view("<i8")[0])

    return lambda texts: [[one(t) for t in texts]]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, seed: int = 42) -> DataFrame:
    """``fp`` (64 bits as a signed long) of every row; texts without words have 0, shorter ones a single shingle."""
    return per_text(docs, text_col, [id_col], [("fp", T.LongType(), pa.int64())], lambda: _fingerprints(width, seed))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a bit pattern in Gray order, where neighbours differ in one bit."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def masks(distance: int, parts: int) -> list[int]:
    """Bit masks of all choices of ``parts - distance`` parts: two words that differ in ``distance`` bits agree on one."""
    cuts = [round(64 * i / parts) for i in range(parts + 1)]
    part = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(part, parts - distance)]


def parts_for(n: int, distance: int) -> int:
    """Parts of a fingerprint so that a pattern, all but ``distance`` of them, holds about ``PATTERN`` of ``n`` at most.

    Up to ``BUCKET`` fingerprints no bit is asked for: they all stand under one tree. Beyond, a pattern is one part or more.
    """
    if n <= BUCKET and distance:
        return distance
    parts = distance + 1
    while parts < 4 * distance and n > PATTERN * 2.0 ** (64 * (parts - distance) / parts):
        parts += 1
    return parts


def _shared(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each run of ``size`` values: the mask of the bits all share, and those bits."""
    first = np.arange(0, len(x), size)
    ones, zeros = np.bitwise_and.reduceat(x, first), np.bitwise_and.reduceat(~x, first)
    return ones | zeros, ones


def tree_links(x: np.ndarray, distance: int, at: int, until: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (query, later member) within ``distance`` for the queries ``at .. until`` of ``x``, in Gray order.

    A node holds the bits its members share, without those of the node above. Differences to them add up on the way
    down, and what lies under a node goes as soon as they exceed the distance.
    """
    leaf_mask, leaf_bits = _shared(x, LEAF)
    top_mask, top_bits = _shared(x, LEAF * LEAF)
    queries = np.arange(at, until)
    q = x[queries]
    top_end = np.minimum((np.arange(len(top_mask)) + 1) * LEAF * LEAF, len(x))
    spent = np.bitwise_count((q[:, None] ^ top_bits) & top_mask)
    row, node = np.nonzero((spent <= distance) & (top_end > queries[:, None] + 1))
    spent = spent[row, node]
    leaf = (node[:, None] * LEAF + np.arange(LEAF)).ravel()
    row, spent, node = np.repeat(row, LEAF), np.repeat(spent, LEAF), np.repeat(node, LEAF)
    real = (leaf < len(leaf_mask)) & ((leaf + 1) * LEAF > queries[row] + 1)
    row, spent, node, leaf = row[real], spent[real], node[real], leaf[real]
    own = leaf_mask[leaf] & ~top_mask[node]
    spent = spent + np.bitwise_count((q[row] ^ leaf_bits[leaf]) & own)
    near = spent <= distance
    row, spent, leaf = row[near], spent[near], leaf[near]
    member = (leaf[:, None] * LEAF + np.arange(LEAF)).ravel()
    row, spent, leaf = np.repeat(row, LEAF), np.repeat(spent, LEAF), np.repeat(leaf, LEAF)
    real = (member < len(x)) & (member > queries[row])
    row, spent, leaf, member = row[real], spent[real], leaf[real], member[real]
    spent = spent + np.bitwise_count((q[row] ^ x[member]) & ~leaf_mask[leaf])
    near = spent <= distance
    return queries[row[near]], member[near]


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of ``a[i]`` and ``b[i]`` in ``root``, which names the smallest member of each set."""
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        differ = low != high
        a, b, low, high = a[differ], b[differ], low[differ], high[differ]
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def _group_links(x: np.ndarray, group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links that connect all members within ``distance`` of the same group. x, group: sorted by group, Gray order."""
    n = len(x)
    root = np.arange(n)
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.append(first, n))
    end = np.repeat(first + sizes, sizes)
    small = np.repeat(sizes <= LEAF, sizes)  # a single leaf: nothing stands above it
    i = np.flatnonzero(small)
    for step in range(1, LEAF):
        i = i[i + step < end[i]]
        if not len(i):
            break
        near = i[np.bitwise_count(x[i] ^ x[i + step]) <= distance]
        unite(root, near, near + step)
    for at, size in zip(first[sizes > LEAF].tolist(), sizes[sizes > LEAF].tolist(), strict=True):
        own = x[at : at + size]
        for k in range(0, size, 256):
            a, b = tree_links(own, distance, k, min(k + 256, size))
            unite(root, a + at, b + at)
    linked = np.flatnonzero(root != np.arange(n))
    return x[root[linked]], x[linked]


def _link_batches(distance: int):
    def run(batches):
        held_x, held_g = np.zeros(0, np.uint64), np.zeros((0, 3), np.int64)

        def found(x, g):
            change = np.concatenate(([0], np.cumsum((g[1:] != g[:-1]).any(axis=1)))) if len(g) else np.zeros(0, np.int64)
            order = np.lexsort((gray_rank(x), change))
            a, b = _group_links(x[order], change[order], distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            x = np.concatenate([held_x, batch.column(0).to_numpy().view(np.uint64)])
            g = np.concatenate([held_g, np.stack([batch.column(k).to_numpy() for k in (1, 2, 3)], axis=1)])
            last = len(g) - 1 - int(np.argmax((g[::-1] != g[-1]).any(axis=1))) + 1 if (g[0] != g[-1]).any() else 0
            if last:
                yield found(x[:last], g[:last])
            held_x, held_g = x[last:], g[last:]
        if len(held_x):
            yield found(held_x, held_g)

    return run


def hamming_links(values: DataFrame, distance: int = 4, parts: int | None = None) -> DataFrame:
    """Links ``a, b`` that connect all distinct ``fp`` within ``distance`` bits (directly or over others within it).

    The root level of the index is a set of masked patterns: of ``parts`` parts all but ``distance`` agree for every pair
    sought, so pairs meet below a common pattern. ``parts`` grows with the counted fingerprints (``parts_for``), which
    keeps the members of a pattern, and what a fingerprint is compared with, about the same at every size. Below it fingerprints stand in Gray order under nodes of
    shared bits. A pattern with more than ``BUCKET`` members is cut into blocks and every pair of blocks becomes a
    group of its own, so nothing is capped and no task takes a whole hot pattern. Groups give star links only, linear in
    their size.
    """
    listed = masks(distance, parts or parts_for(values.count(), distance))
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in listed]
    spots = F.array(*(F.struct(F.lit(k).cast("long").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(signed)))
    rows = values.select("fp", F.explode(spots).alias("_s")).select("fp", F.col("_s.t"), F.col("_s.bits"))
    large = rows.groupBy("t", "bits").agg(F.count("*").alias("_n")).filter(F.col("_n") > BUCKET)
    blocks = F.coalesce(F.ceil(F.col("_n") / BUCKET), F.lit(1)).cast("int")
    placed = rows.join(large, ["t", "bits"], "left").withColumn("_b", F.pmod(F.xxhash64("fp"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    dealt = placed.withColumn("_o", other).select(
        "fp", "t", "bits", (F.least("_b", "_o").cast("long") * (1 << 31) + F.greatest("_b", "_o")).alias("block")
    )
    grouped = dealt.repartition("t", "bits", "block").sortWithinPartitions("t", "bits", "block")
    links = grouped.mapInArrow(_link_batches(distance), "a long, b long")
    return links.distinct()


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4, width: int = 4, seed: int = 42
) -> DataFrame:
    """Per row: id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable over links of at most
    ``distance`` bits.

    Equal fingerprints are one node, so groups of copies stay linear. Null and wordless texts have fingerprint zero and
    link like any other. Repeated rows and ids each keep their row; null ids never name a component unless it holds
    nothing else (then null). An empty table gives no rows. Fingerprints and links are written tables.
    """
    rows = written(fingerprints(docs, id_col, text_col, width, seed), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min(id_col).alias("_first")), "nodes")
    roots = components(hamming_links(nodes.select("fp"), distance)).select(F.col("node").alias("fp"), "root")
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("_first").alias("component_id"))
    named = written(placed.join(least, "root").select("fp", "component_id"), "named")
    text = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.join(named, "fp").select(id_col, text.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that name their group of near copies, each once; all columns as they were, of whatever names.

    A group is named by its smallest triple of id and two hashes of all columns (null ids first), and every row that isn't
    this one goes; of rows equal in all columns one stays. Texts move only where the rows to drop are too many to send along.
    """
    one, two, held, n = free_names(docs, "key", "key2", "id", "n")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.withColumns({one: F.xxhash64(*columns), two: F.xxhash64(F.lit(7), *columns[::-1])})
    triple = F.struct(F.col(id_col).alias("id"), F.col(one).alias("key"), F.col(two).alias("key2"))
    named = written(near_copies(keyed.select(triple.alias(held), text_col), held, text_col, **settings), "groups")
    first = F.col(held).eqNullSafe(F.col("component_id"))
    keys = [F.col(f"{held}.key").alias(one), F.col(f"{held}.key2").alias(two)]
    left = keyed.join(named.filter(~first).select(*keys).distinct(), [one, two], "left_anti")
    twice = named.filter(first).groupBy(*keys).agg(F.count("*").alias(n)).filter(F.col(n) > 1).drop(n)
    single = left.join(twice, [one, two], "left_anti")
    return single.unionByName(left.join(twice, [one, two], "left_semi").dropDuplicates([one, two])).select(*docs.columns)
