"""Frequent itemsets over long-form baskets (``basket_id, item``).

A basket is kept as rows, never as one list. Itemsets grow level by level: an occurrence of a frequent
set in a basket is extended by later frequent items of that basket.

Very large baskets would list a power of their size. There are few of them and each adds at most one to any
support, so baskets above a size limit are set aside, at most half the support in number: with ``h`` baskets
aside, a frequent set has support of at least ``support - h`` in the rest. Sets that reach this there are counted in
the baskets set aside, level by level, before they grow.

Baskets of equal items are mined once: ``weight`` beside the rows of a basket says how many it stands for (``merged``). Rows
without that column stand for one basket each.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import quoted
from gleaner.operators.numbering import numbered, token_dict
from gleaner.operators.skew import skew_join
from gleaner.session import written

LARGE_BASKET = 200  # items; larger baskets are set aside
BROADCAST_BUCKETS = 1 << 27  # buckets whose bitmap, two million words, travels to every task


def baskets(pairs: DataFrame, key: str, item: str, min_size: int = 1) -> DataFrame:
    """``basket_id, item, size``: the distinct items of each basket with at least ``min_size`` items.

    Long form on purpose: a basket may hold a large share of all rows.
    """
    rows = pairs.select(F.col(key).alias("basket_id"), F.col(item).alias("item")).distinct()
    rows = written(rows, "basket-rows")
    size = rows.groupBy("basket_id").agg(F.count("*").alias("size"))
    counts = size.select("basket_id", F.col("size").alias("_n"))
    return skew_join(rows, size.filter(F.col("size") >= min_size), "basket_id", counts=counts)


def basket_pieces(rows: DataFrame, piece: Column | None = None, limit: int = 1000) -> DataFrame:
    """``basket_id, piece, items``: baskets as sorted lists of about ``limit`` items each."""
    size = rows.groupBy("basket_id").agg(F.count("*").alias("_size"))
    pieces = F.ceil(F.col("_size") / F.lit(limit))
    cut = skew_join(rows.select("basket_id", "item"), size, "basket_id").withColumn(
        "piece", F.pmod(piece if piece is not None else F.xxhash64("item"), pieces)
    )
    return cut.groupBy("basket_id", "piece").agg(F.array_sort(F.collect_list("item")).alias("items"))


def _weight(rows: DataFrame) -> list[str]:
    return ["weight"] if "weight" in rows.columns else []


def _number(rows: DataFrame) -> Column:
    """How many baskets rows of one each stand for."""
    return F.sum("weight") if _weight(rows) else F.count("*")


def _sizes(rows: DataFrame, here: list[str]) -> DataFrame:
    """``here, _n, _w``: items of each basket, and how many baskets it stands for."""
    weight = F.max("weight") if _weight(rows) else F.lit(1).cast("long")
    return rows.groupBy(*here).agg(F.count("*").alias("_n"), weight.alias("_w"))


def merged(rows: DataFrame, chunk: Column | None = None, large: int = LARGE_BASKET) -> DataFrame:
    """``basket_id, item, weight``, written: baskets of equal items (in one ``chunk``, if given) as one, by their smallest id.

    ``weight`` is how many they are. Only baskets of up to ``large`` items are compared, as sorted lists; larger ones, and rows
    without a basket, stay as they are.
    """
    weight = F.col("weight") if _weight(rows) else F.lit(1).cast("long").alias("weight")
    rows = rows.select("basket_id", "item", weight)
    known = rows.filter(F.col("basket_id").isNotNull())
    others = rows.filter(F.col("basket_id").isNull())
    size = known.groupBy("basket_id").agg(F.count("*").alias("_n"))
    if (size.agg(F.max("_n")).first()[0] or 0) > large:
        size = written(size, "basket-sizes")
        over = written(size.filter(F.col("_n") > large).select("basket_id"), "over")
        others = others.unionByName(skew_join(known, over, "basket_id", "left_semi", counts=size))
        known = skew_join(known, over, "basket_id", "left_anti", counts=size)
    # dealt by basket first, so that a list is made once, from at most ``large`` rows; structs keep items that are null
    lists = known.repartition("basket_id").groupBy("basket_id").agg(
        F.sort_array(F.collect_list(F.struct("item"))).alias("_items"), F.max("weight").alias("_w")
    )
    place = chunk if chunk is not None else F.lit(0)
    equal = lists.groupBy(place.alias("_chunk"), "_items").agg(F.min("basket_id").alias("basket_id"), F.sum("_w").alias("weight"))
    once = equal.select("basket_id", F.explode("_items").alias("_item"), "weight")
    return written(once.select("basket_id", F.col("_item.item").alias("item"), "weight").unionByName(others), "merged")


def basket_count(rows: DataFrame) -> int:
    """How many baskets have an id."""
    known = rows.filter(F.col("basket_id").isNotNull())
    if not _weight(rows):
        return known.select("basket_id").distinct().count()
    return _sizes(known, ["basket_id"]).agg(F.sum("_w")).first()[0] or 0


def support_count(rows: DataFrame, fraction: float) -> int:
    """``ceil(fraction * number of baskets)``"""
    return math.ceil(fraction * basket_count(rows))


def _above(limit: int) -> Column:
    """How many baskets of ``_sizes`` have more than ``limit`` items."""
    return F.sum(F.when(F.col("_n") > limit, F.col("_w")).otherwise(0))


def _set_aside(rows: DataFrame, support: int, large: int) -> tuple[DataFrame, DataFrame | None, int]:
    """Ordinary rows, rows of the baskets set aside, and how many baskets those are.

    The size limit starts at ``large`` and doubles until at most half the support lies above it.
    """
    size = _sizes(rows, ["basket_id"])
    top = size.agg(F.max("_n")).first()[0] or 0
    if top <= large:
        return rows, None, 0
    size = written(size, "basket-sizes")
    limits = [large]
    while limits[-1] < top:
        limits.append(limits[-1] * 2)
    above = size.agg(*[_above(limit) for limit in limits]).first()
    limit, n_aside = next((t, n) for t, n in zip(limits, above) if n <= support // 2)
    if n_aside == 0:
        return rows, None, 0
    over = size.filter(F.col("_n") > limit).select("basket_id")
    aside = skew_join(rows, over, "basket_id", "left_semi", counts=size)
    ordinary = skew_join(rows, over, "basket_id", "left_anti", counts=size)
    return written(ordinary, "ordinary"), written(aside, "aside"), n_aside


def _candidates(frequent: DataFrame, scope: list[str], k: int) -> DataFrame:
    """Sets of ``k + 1`` items whose every subset of ``k`` is frequent: ``scope, i1 … i(k+1), least``.

    Two frequent sets that share all but their last item make one; the other subsets are looked up by key. ``least``, the
    smaller support of the two, bounds the support of the new set. Nothing here looks at a basket.
    """
    shared, last = [f"i{j}" for j in range(1, k)], f"i{k}"
    one = frequent.select(*scope, *shared, last, F.col("support").alias("_s1"))
    two = frequent.select(*scope, *shared, F.col(last).alias(f"i{k + 1}"), F.col("support").alias("_s2"))
    made = one.join(two, [*scope, *shared]).filter(F.col(last) < F.col(f"i{k + 1}"))
    made = made.withColumn("least", F.least("_s1", "_s2")).drop("_s1", "_s2")
    for left_out in range(1, k):
        subset = [f"i{j}" for j in range(1, k + 2) if j != left_out]
        known = frequent.select(*scope, *(F.col(f"i{j}").alias(name) for j, name in enumerate(subset, 1)))
        made = made.join(known, [*scope, *subset], "left_semi")
    return made


def _held(aside: DataFrame, found: DataFrame, scope: list[str], k: int) -> DataFrame:
    """Occurrences of the sets in ``found`` in the baskets set aside, from the occurrences of their subsets there."""
    places = [f"i{j}" for j in range(1, k + 1)]
    if k == 1:
        return aside.join(found.select(*scope, "i1"), [*scope, "i1"], "left_semi")
    sets = found.select(*scope, *places)
    met = aside.join(sets, [*scope, *places[:-1]])
    others = aside.withColumnRenamed(f"i{k - 1}", f"i{k}")
    return met.join(others, [*scope, "basket_id", *places[:-2], f"i{k}"], "left_semi")


def _grow(
    rows: DataFrame,
    near: Callable[[DataFrame], DataFrame],
    scope: list[str],
    max_k: int | None,
    prune: Callable[[DataFrame, int], DataFrame] | None = None,
    aside: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> list[DataFrame]:
    """Frequent sets of every level: ``scope, items, support``.

    ``rows`` has ``basket_id, item, weight`` and the ``scope`` columns (the chunk of a two-pass run). A set of level k is held in
    columns ``i1 … ik``; its occurrences are joined once and written, then counted and filtered from there. From pairs on
    only candidates are listed, sets whose every subset is frequent, in baskets that hold the two sets they are made of.

    ``near(counts)`` applies the support threshold to ``scope, items, support``. Baskets in ``aside`` (as ``rows``) list no
    pairs: ``near`` then lets through what they could still lift over the support, those sets are counted there level by
    level, and ``keep`` applies the support to the sum, so no set that is not frequent is ever extended.
    ``prune(occurrences, k)`` may drop occurrences before they are counted; other columns of ``rows`` stand beside the items
    of pairs (as they are and with an underscore) until it drops them.
    """
    here = [*scope, "basket_id"]
    levels: list[DataFrame] = []
    occurrences, k = rows.withColumnRenamed("item", "i1"), 1
    held = None if aside is None else aside.select(*here, "weight", F.col("item").alias("i1"))
    while True:
        places = [f"i{j}" for j in range(1, k + 1)]
        key = [*scope, *places]
        if k > 1:
            occurrences = written(occurrences if prune is None else prune(occurrences, k), f"occurrences{k}")
        counts = occurrences.groupBy(*key).agg(F.sum("weight").alias("support"))
        frequent = near(counts)
        if held is not None:
            frequent = written(frequent, f"near{k}")
            held = written(_held(held, frequent, scope, k), f"held{k}")
            more = held.groupBy(*key).agg(F.sum("weight").alias("_more"))
            total = F.col("support") + F.coalesce("_more", F.lit(0))
            frequent = keep(frequent.join(more, key, "left").withColumn("support", total).drop("_more"))
        frequent = written(frequent, f"frequent{k}")
        if frequent.isEmpty():
            return levels
        levels.append(frequent.select(*scope, F.array(*places).alias("items"), "support"))
        if k == max_k:
            return levels
        if held is not None:
            held = held.join(frequent.select(*key), key, "left_semi")
        shared, last, new = places[:-1], places[-1], f"i{k + 1}"
        if k == 1:
            # a frequent item may occur in a large share of the baskets; its support says so
            size = frequent.select(*key, F.col("support").alias("_n"))
            kept = skew_join(occurrences, frequent.select(*key), key, "left_semi", counts=size)
            extra = [F.col(c).alias(f"_{c}") for c in rows.columns if c not in (*here, "item", "weight")]  # what pruning pairs needs
            two = kept.select(*here, F.col("i1").alias("i2"), *extra)
            occurrences = kept.join(two, here).filter(F.col("i1") < F.col("i2"))
        else:
            wanted = written(_candidates(frequent, scope, k), f"candidates{k + 1}")
            if wanted.isEmpty():
                return levels
            one = occurrences.join(wanted.select(*key), key, "left_semi")
            ends = wanted.select(*scope, *shared, F.col(new).alias(last))
            two = occurrences.drop("weight").join(ends, key, "left_semi").withColumnRenamed(last, new)
            met = one.join(two, [*here, *shared]).filter(F.col(last) < F.col(new))
            size = wanted.select(*key, new, F.col("least").alias("_n"))
            occurrences = skew_join(met, wanted.select(*key, new), [*key, new], "left_semi", counts=size)
        k += 1


def contained(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """``items, support``: how many baskets contain each candidate set, by key joins only.

    Each basket meets a candidate at its rarest item and must then hold every other item, one join per
    place: a candidate never meets the baskets of its commonest item.
    """
    degree = rows.groupBy("item").agg(F.count("*").alias("degree"))
    places = candidates.select("items").distinct().select("items", F.explode("items").alias("item"))
    ordered = skew_join(places, degree, "item").groupBy("items").agg(
        F.array_sort(F.collect_list(F.struct("degree", "item"))).alias("_by_degree")
    )
    ordered = written(
        ordered.filter(F.size("_by_degree") == F.size("items")).select("items", F.col("_by_degree.item").alias("seek")),
        "seek",
    )
    longest = ordered.agg(F.max(F.size("items"))).first()[0] or 0
    found = None
    parts = []
    for place in range(longest):
        if place == 0:
            start = ordered.select("items", "seek", F.col("seek")[0].alias("item"))
            found = skew_join(rows.select("basket_id", "item", *_weight(rows)), start, "item").drop("item")
        else:
            wanted = found.filter(F.size("items") > place).withColumn("item", F.col("seek")[place])
            found = wanted.join(rows.select("basket_id", "item"), ["basket_id", "item"], "left_semi").drop("item")
        found = written(found, f"found{place}")
        done = found.filter(F.size("items") == place + 1)
        parts.append(done.groupBy("items").agg(_number(rows).alias("support")))
    if not parts:
        return candidates.select("items", F.lit(0).cast("long").alias("support")).limit(0)
    return reduce(DataFrame.unionByName, parts)


def _shaped(found: DataFrame) -> DataFrame:
    return found.select("items", F.size("items").alias("size"), F.col("support").cast("long"))


def frequent_itemsets(
    rows: DataFrame,
    support: int,
    max_k: int | None = None,
    strict: bool = False,
    method: str = "levelwise",
    buckets: int | None = None,
    chunks: int = 4,
    large: int = LARGE_BASKET,
    candidates: DataFrame | None = None,
) -> DataFrame:
    """``items, size, support`` of all sets in at least ``support`` baskets (more than, if ``strict``).

    ``rows`` are distinct ``basket_id, item``, with a ``weight`` if they are merged; else they are merged here. ``levelwise``, ``pcy`` (a bitmap of full buckets drops occurrences before
    they are listed; ``buckets`` is twice the baskets by default), ``son`` (two passes over chunks) and ``fpgrowth`` give
    the same answer; ``fpgrowth`` holds a basket as one list, of at most the size beyond which baskets are set aside.
    ``candidates`` (``items``) is the first pass of ``son``, if it is there already.
    """
    rows = rows.select("basket_id", "item", *_weight(rows))
    least = support + 1 if strict else support
    if method == "son":
        if candidates is None:
            if not _weight(rows):
                rows = merged(rows, _chunk(chunks))
            candidates = written(_chunk_frequent(rows, least, chunks, max_k, None, large).select("items").distinct(), "candidates")
        # the second pass only counts, baskets of all chunks together: every frequent set is among the candidates
        found = contained(merged(rows), candidates.select("items")).filter(F.col("support") >= least)
        return _shaped(found if max_k is None else found.filter(F.size("items") <= max_k))

    if method != "fpgrowth" and not _weight(rows):
        rows = merged(rows)
    ordinary, aside, n_aside = _set_aside(rows, least, large)
    threshold = least - n_aside
    if method == "fpgrowth":
        found = _fpgrowth(ordinary, threshold, max_k)
        if aside is not None:
            more = contained(aside, found.select("items"))
            found = found.unionByName(more).groupBy("items").agg(F.sum("support").alias("support"))
        return _shaped(found.filter(F.col("support") >= least))

    near = lambda counts: counts.filter(F.col("support") >= threshold)
    keep = lambda counts: counts.filter(F.col("support") >= least)
    prune = None
    if method == "pcy":
        bits = buckets or bitmap_size(rows)
        coded = written(_tokens_of(ordinary).withColumn("r", F.col("token") % F.lit(_side(bits))).drop("token"), "coded")
        prune = lambda met, k: _bucket_prune(met, k, coded, threshold, bits)
        ordinary = coded
    levels = _grow(ordinary, near, [], max_k, prune, aside, keep)
    if not levels:
        return _shaped(rows.select(F.array("item").alias("items"), F.lit(0).alias("support")).limit(0))
    return _shaped(reduce(DataFrame.unionByName, levels))


def _fpgrowth(rows: DataFrame, threshold: int, max_k: int | None) -> DataFrame:
    """Sets by prefix trees over each basket as one list."""
    from pyspark.ml.fpm import FPGrowth

    n = basket_count(rows)
    lists = rows.groupBy("basket_id").agg(F.collect_set("item").alias("items"), *map(F.max, _weight(rows)))
    if _weight(rows):  # the trees know no weights
        lists = lists.select("items", F.explode(F.sequence(F.lit(1).cast("long"), F.col("max(weight)"))))
    model = FPGrowth(itemsCol="items", minSupport=max(threshold - 0.5, 0.5) / max(n, 1)).fit(lists)
    found = model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("support"))
    return found if max_k is None else found.filter(F.size("items") <= max_k)


def _tokens_of(rows: DataFrame) -> DataFrame:
    """``basket_id, item, token``: every row with the dense number of its item, and its weight if it has one."""
    tokens = written(token_dict(rows, "item"), "tokens")
    coded = skew_join(rows.select("basket_id", F.col("item").alias("id"), *_weight(rows)), tokens, "id")
    return coded.select("basket_id", F.col("id").alias("item"), "token", *_weight(rows))


def bitmap_size(rows: DataFrame) -> int:
    """Buckets of a bitmap over these baskets: two for each."""
    return 2 * max(1, _sizes(rows, ["basket_id"]).agg(F.sum("_w")).first()[0] or 0)


def _side(buckets: int) -> int:
    """Residues whose pairs, equal ones included, fill at most ``buckets`` buckets."""
    return max(1, (math.isqrt(8 * buckets + 1) - 1) // 2)


def _pair_bucket(r1: Column, r2: Column) -> Column:
    """Bucket of two residues in any order."""
    high = F.greatest(r1, r2)
    return F.shiftright(high * (high + 1), 1) + F.least(r1, r2)


def _bucket_prune(met: DataFrame, k: int, coded: DataFrame, threshold: int, buckets: int) -> DataFrame:
    """Occurrences whose bucket reaches the threshold, by a bitmap of such buckets; one bitmap for each level.

    Pair buckets are counted from residues (column ``r`` of ``coded``) before any pair is listed; those of larger sets from
    a hash of their items, as they are met, before they are written.
    """
    if k == 2:
        placed = met.withColumn("_bucket", _pair_bucket(F.col("r"), F.col("_r"))).drop("r", "_r")
        counts = _pair_buckets(coded)
    else:
        placed = met.withColumn("_bucket", F.pmod(F.xxhash64(*[f"i{j}" for j in range(1, k + 1)]), F.lit(buckets)))
        counts = placed.groupBy(F.col("_bucket").alias("bucket")).agg(_number(placed).alias("n"))
    return _in_bitmap(placed, "_bucket", bitmap(counts.filter(F.col("n") >= threshold)), buckets).drop("_bucket")


def bitmap(full: DataFrame) -> DataFrame:
    """``at, word``: the buckets of ``full`` as bits, 64 to a word; words without a bit are left out."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bucket").bitwiseAND(F.lit(63)).cast("int"))
    return full.groupBy(F.shiftright("bucket", 6).alias("at")).agg(F.bit_or(bit).alias("word"))


def _in_bitmap(rows: DataFrame, bucket: str, words: DataFrame, buckets: int) -> DataFrame:
    """Rows whose bucket is set. Up to ``BROADCAST_BUCKETS`` buckets the words travel to the rows, beyond they meet by key."""
    placed = rows.withColumn("at", F.shiftright(bucket, 6))
    met = placed.join(F.broadcast(words), "at") if buckets <= BROADCAST_BUCKETS else skew_join(placed, words, "at")
    return met.filter(F.getbit("word", F.col(bucket).bitwiseAND(F.lit(63)).cast("int")) == 1).drop("at", "word")


def pcy_buckets(rows: DataFrame, support: int, buckets: int | None = None) -> DataFrame:
    """``bucket, n``: pair buckets that reach ``support``, of at most ``buckets`` (twice the baskets by default).

    An item falls to a residue of its token, a pair to the bucket of its two residues. A basket is first reduced to a
    count per residue, so no more rows meet each other than there are buckets, whatever its size.
    """
    side = _side(buckets or bitmap_size(rows))
    coded = _tokens_of(rows).withColumn("r", F.col("token") % F.lit(side))
    return _pair_buckets(coded).filter(F.col("n") >= support)


def _pair_buckets(coded: DataFrame) -> DataFrame:
    weight = F.max("weight") if _weight(coded) else F.lit(1).cast("long")
    residues = written(coded.groupBy("basket_id", "r").agg(F.count("*").alias("c"), weight.alias("_w")), "residues")
    one = residues.select("basket_id", F.col("r").alias("r1"), F.col("c").alias("c1"), "_w")
    two = residues.select("basket_id", F.col("r").alias("r2"), F.col("c").alias("c2"))
    across = one.join(two, "basket_id").filter(F.col("r1") < F.col("r2")).select(
        _pair_bucket(F.col("r1"), F.col("r2")).alias("bucket"), (F.col("c1") * F.col("c2") * F.col("_w")).alias("n")
    )
    within = residues.filter(F.col("c") > 1).select(
        _pair_bucket(F.col("r"), F.col("r")).alias("bucket"), F.expr("c * (c - 1) div 2 * _w").alias("n")
    )
    return across.unionByName(within).groupBy("bucket").agg(F.sum("n").alias("n"))


def itemset_candidates(
    rows: DataFrame,
    support: int,
    chunks: int,
    max_k: int | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """``items, size``: sets frequent in at least one chunk at its share of the support, first pass of two.

    ``rows`` are distinct ``basket_id, item``, with a ``weight`` if they are merged by ``chunk``; else they are merged here.
    A chunk with ``c`` of the ``N`` baskets asks for ``ceil(support * c / N)``. A set with global
    support has that in some chunk, so this contains every frequent set.
    """
    rows = rows.select("basket_id", "item", *_weight(rows))
    found = _chunk_frequent(rows, support, chunks, max_k, chunk).select("items").distinct()
    return found.select("items", F.size("items").alias("size"))


def _chunk(chunks: int) -> Column:
    return F.pmod(F.xxhash64("basket_id"), F.lit(chunks))


def _chunk_frequent(
    rows: DataFrame, support: int, chunks: int, max_k: int | None, chunk: Column | None, large: int = LARGE_BASKET
) -> DataFrame:
    """``chunk, items, support`` of the sets frequent inside a chunk.

    Each chunk sets its largest baskets aside, at most half its own threshold in number and of over ``large`` items: they
    list no pairs, and the sets that they may lift over the threshold are counted in them by key, in time linear in
    their items. The thresholds are a table of a row a chunk.
    """
    place = chunk if chunk is not None else _chunk(chunks)
    if not _weight(rows):
        rows = merged(rows, place)
    placed = rows.withColumn("chunk", place.cast("int"))
    size = written(_sizes(placed, ["chunk", "basket_id"]), "chunk-baskets")
    seen = size.agg(F.sum("_w").alias("baskets"), F.max("_n").alias("top")).first()
    if not seen["baskets"]:
        return placed.select("chunk", F.array("item").alias("items"), F.lit(0).cast("long").alias("support")).limit(0)
    limits = [large]
    while limits[-1] < seen["top"]:
        limits.append(limits[-1] * 2)
    # ceiling division in whole numbers
    need = F.expr(f"({support}L * c + {seen['baskets'] - 1}L) div {seen['baskets']}L")
    shares = size.groupBy("chunk").agg(
        F.sum("_w").alias("c"), *[_above(limit).alias(f"a{limit}") for limit in limits]
    ).withColumn("need", need)
    fits = [F.when(F.col(f"a{t}") <= F.shiftright("need", 1), F.struct(F.lit(t).alias("limit"), F.col(f"a{t}").alias("n"))) for t in limits]
    shares = written(shares.withColumn("_fit", F.coalesce(*fits)).select("chunk", "need", "_fit.limit", "_fit.n"), "chunk-limits")
    above = lambda counts, least: counts.join(shares.select("chunk", least.alias("_least")), "chunk").filter(
        F.col("support") >= F.col("_least")
    ).drop("_least")
    near = lambda counts: above(counts, F.col("need") - F.col("n"))
    keep = lambda counts: above(counts, F.col("need"))
    aside = None
    if seen["top"] > large:
        over = size.join(shares, "chunk").filter(F.col("_n") > F.col("limit")).select("chunk", "basket_id")
        over = written(over, "over")
        here = ["chunk", "basket_id"]
        aside = written(skew_join(placed, over, here, "left_semi", counts=size), "aside")
        placed = written(skew_join(placed, over, here, "left_anti", counts=size), "ordinary")
    levels = _grow(placed, near, ["chunk"], max_k, None, aside, keep)
    if not levels:
        return placed.select("chunk", F.array("item").alias("items"), F.lit(0).cast("long").alias("support")).limit(0)
    return reduce(DataFrame.unionByName, levels)


def multiset_baskets(pairs: DataFrame, key: str, item: str) -> DataFrame:
    """``basket_id, item, n``: items of each basket with how often it holds them."""
    return pairs.groupBy(F.col(key).alias("basket_id"), F.col(item).alias("item")).agg(F.count("*").alias("n"))


def frequent_multisets(rows: DataFrame, support: int, max_k: int = 3, strict: bool = True) -> DataFrame:
    """``items, size, support`` of the multisets of up to ``max_k`` items met more than (at least, unless ``strict``)
    ``support`` times, repeats inside a basket included.

    ``rows`` are distinct ``basket_id, item, n``. A basket meets a multiset as often as its items can be picked from it:
    the item ``a`` n times, the pair (a, b) n(a) n(b) times, (a, a) n(a) (n(a) - 1) / 2 times, and so on. Counts are
    products of the numbers of a row per item; repeats are never listed. A multiset is listed in the baskets that hold it
    only if all its parts of one item less are frequent.
    """
    least = support + 1 if strict else support
    occurrences = rows.select("basket_id", F.col("item").alias("i1"), F.col("n").alias("ways"), "n", F.lit(1).cast("long").alias("m"))
    levels, singles, k = [], None, 1
    while True:
        places = [f"i{j}" for j in range(1, k + 1)]
        if k > 1:
            occurrences = written(occurrences, f"multi{k}")
        counts = occurrences.groupBy(*places).agg(F.sum("ways").alias("support"), F.count("*").alias("_n"))
        frequent = written(counts.filter(F.col("support") >= least), f"multi-frequent{k}")
        if frequent.isEmpty():
            break
        levels.append(frequent.select(F.array(*places).alias("items"), "support"))
        if k == max_k:
            break
        last, new = places[-1], f"i{k + 1}"
        sized = frequent.select(*places, "_n")
        kept = skew_join(occurrences, frequent.select(*places), places, "left_semi", counts=sized)
        if k == 1:
            singles = written(kept.select("basket_id", F.col("i1").alias("_item"), F.col("n").alias("_more")), "multi-items")
        met = kept.join(singles, "basket_id").filter(
            (F.col("_item") > F.col(last)) | ((F.col("_item") == F.col(last)) & (F.col("n") > F.col("m")))
        )
        same = F.col("_item") == F.col(last)
        again = F.expr("ways * (n - m) div (m + 1)")
        grown = met.select(
            "basket_id", *places, F.col("_item").alias(new),
            F.when(same, again).otherwise(F.col("ways") * F.col("_more")).alias("ways"),
            F.col("_more").alias("n"), F.when(same, F.col("m") + 1).otherwise(F.lit(1)).alias("m"),
        )
        if k > 1:
            wanted = frequent.select(*places).join(frequent.select(*places[:-1], F.col(last).alias(new)), places[:-1])
            wanted = wanted.filter(F.col(last) <= F.col(new))
            for left_out in range(1, k):
                subset = [f"i{j}" for j in range(1, k + 2) if j != left_out]
                known = frequent.select(*(F.col(f"i{j}").alias(name) for j, name in enumerate(subset, 1)))
                wanted = wanted.join(known, subset, "left_semi")
            grown = grown.join(written(wanted, f"multi-candidates{k + 1}"), [*places, new], "left_semi")
        occurrences, k = grown, k + 1
    if not levels:
        return _shaped(rows.select(F.array("item").alias("items"), F.lit(0).alias("support")).limit(0))
    return _shaped(reduce(DataFrame.unionByName, levels))


def itemset_report(candidates: DataFrame, frequent: DataFrame, per_line: int = 1000) -> DataFrame:
    """``line_no, line``: both lists, one line per size and a blank line between, items as ``('a', 'b')``.

    A size with more than ``per_line`` sets continues on further lines.
    """
    def lines(section: int, sets: DataFrame) -> DataFrame:
        placed = numbered(sets.select(F.size("items").alias("size"), "items"), ["size", "items"], "pos")
        first = placed.groupBy("size").agg(F.min("pos").alias("first"))
        placed = placed.join(first, "size").withColumn(
            "piece", F.floor((F.col("pos") - F.col("first")) / F.lit(per_line)).cast("int")
        )
        shown = F.concat(F.lit("("), quoted(F.col("items")), F.lit(")"))
        line = F.array_join(F.array_sort(F.collect_list(F.struct("items", shown.alias("shown"))))["shown"], ",")
        body = placed.groupBy("size", "piece").agg(line.alias("line"))
        gap = first.select("size", F.lit(1_000_000_000).alias("piece"), F.lit("").alias("line"))
        return body.unionByName(gap).select(F.lit(section).alias("section"), "size", "piece", "line")

    spark = candidates.sparkSession
    heads = spark.createDataFrame(
        [(0, 0, 0, "Candidates:"), (1, 0, 0, "Frequent Itemsets:")], "section int, size int, piece int, line string"
    )
    whole = heads.unionByName(lines(0, candidates)).unionByName(lines(1, frequent))
    return numbered(whole, ["section", "size", "piece"], "line_no").select("line_no", "line")
