"""Collaborative filtering: rating tables, Pearson models, predictions and hit rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions import similarity as formulas
from gleaner.functions.hashing import Hash
from gleaner.operators import pairs as pair_operators
from gleaner.operators.numbering import token_dict
from gleaner.operators.pairs import Need, overlaps
from gleaner.operators.similarity import in_common_bucket, minhash, packed_kind, rows_of_pairs
from gleaner.operators.skew import hot_keys, skew_join
from gleaner.session import written

NEIGHBOURS = 3
MIN_COMMON = 3


def ratings_dedup(reviews: DataFrame) -> DataFrame:
    """``user_id, business_id, stars``: the latest rating of each pair (by date, then review id, then stars)."""
    latest = F.max(F.struct("date", "review_id", "stars"))
    return reviews.groupBy("user_id", "business_id").agg(latest["stars"].alias("stars"))


def _counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("_n"))


def rated_often(reviews: DataFrame, column: str, at_least: int = MIN_COMMON) -> DataFrame:
    """Ids of ``column`` with at least this many review rows, repeated ratings included."""
    return _counts(reviews, column).filter(F.col("_n") >= at_least).select(column)


def pearson(
    reviews: DataFrame,
    item: str,
    rater: str,
    min_common: int = MIN_COMMON,
    mean: str = "full",
    max_group: int = pair_operators.MAX_GROUP,
    min_jaccard: float | None = None,
) -> DataFrame:
    """``k1, k2, sim`` above 0 for items with at least ``min_common`` common raters, and ``min_jaccard`` if given.

    ``reviews`` is a table: it is read more than once.

    The mean of an item divides its common ratings by all its raters; ``mean="corated"`` divides by the
    common ones.
    """
    ratings = _ratings(reviews, item, rater, min_common, hot_keys(reviews, item))
    sums = overlaps(ratings, item, rater, "stars", Need(min_common, min_jaccard), max_group)
    return _correlated(sums.select("k1", "k2", *pair_operators.SUMS), ratings, item, mean)


def _ratings(reviews: DataFrame, item: str, rater: str, at_least: int, hot: list) -> DataFrame:
    """Latest ratings of items with enough review rows, repeated ratings included."""
    latest = ratings_dedup(reviews).select(item, rater, "stars")
    often = rated_often(reviews, item, at_least)
    return written(skew_join(latest, often, item, "left_semi", hot=hot), "ratings")


def _correlated(sums: DataFrame, ratings: DataFrame, item: str, mean: str) -> DataFrame:
    sized = pair_operators.with_sizes(sums, pair_operators.sizes(ratings.withColumnRenamed(item, "item"), "item"))
    n = F.col("n")
    lx, ly = (F.col("size1"), F.col("size2")) if mean == "full" else (n, n)
    sim = formulas.pearson(n, *[F.col(c) for c in pair_operators.SUMS[1:]], lx, ly)
    return sized.select("k1", "k2", sim.alias("sim")).filter(F.col("sim") > 0)


def pearson_lsh(
    reviews: DataFrame,
    item: str,
    rater: str,
    family: list[Hash],
    n_bands: int,
    min_common: int = MIN_COMMON,
    min_jaccard: float = 0.01,
    mean: str = "full",
    max_group: int = pair_operators.MAX_GROUP,
) -> DataFrame:
    """``k1, k2, sim`` above 0 over pairs that share a band bucket, ``min_common`` raters and ``min_jaccard``.

    ``reviews`` is a table, read more than once. Signatures read the elements with at least ``min_common`` review
    rows, correlations read all ratings of items with that many rows. Only what has a correlation gets a signature.
    """
    near = written(pearson(reviews, item, rater, min_common, mean, max_group, min_jaccard), "near")
    seen = rows_of_pairs(near, reviews.select(F.col(item).alias("item"), F.col(rater).alias("element")), "item").distinct()
    often = rated_often(reviews, rater, min_common).withColumnRenamed(rater, "element")
    # elements are numbered over the whole training table, before rare ones are left out
    tokens = token_dict(reviews, rater).select(F.col("id").alias("element"), "token")
    signed = written(
        skew_join(seen, tokens.join(often, "element", "left_semi"), "element", hot=hot_keys(reviews, rater)), "signed"
    )
    kind = packed_kind(family)
    return in_common_bucket(near, minhash(signed, "item", "token", family, kind=kind), n_bands, kind)


def averages(reviews: DataFrame, column: str) -> DataFrame:
    """``id, avg``: average stars per id."""
    return reviews.groupBy(F.col(column).alias("id")).agg(F.avg("stars").alias("avg"))


def overall_average(reviews: DataFrame) -> DataFrame:
    """One row ``avg``: the fallback of ids without reviews."""
    return reviews.agg(F.avg("stars").alias("avg"))


def split_averages(table: DataFrame, unknown: str = "UNK") -> tuple[DataFrame, DataFrame]:
    """The averages of known ids and the one-row fallback of a ready ``id, avg`` table."""
    fallback = table.filter(F.col("id") == unknown).select("avg")
    return table.filter(F.col("id") != unknown), fallback


def both_ways(model: DataFrame) -> DataFrame:
    """``target, near, sim`` in either orientation of a ``k1, k2, sim`` model."""
    return model.select(F.col("k1").alias("target"), F.col("k2").alias("near"), "sim").unionByName(
        model.select(F.col("k2").alias("target"), F.col("k1").alias("near"), "sim")
    )


def _neighbours(test: DataFrame, history: DataFrame, model: DataFrame, hot: tuple[list, list]) -> DataFrame:
    """``owner, target, near, sim`` and the other columns of ``history``: the rated neighbours of each test pair.

    ``test`` is distinct ``owner, target``, ``history`` has ``owner, near``. A pair is resolved through the
    shorter of two lists: the history of its owner or the model row of its target. ``hot`` lists the hot owners
    and the hot targets of ``test``.
    """
    hot_owners, hot_targets = hot
    oriented = written(both_ways(model), "model")
    listed = history.groupBy("owner").agg(F.count("*").alias("listed"))
    degree = oriented.groupBy("target").agg(F.count("*").alias("degree"))
    # no history or no model row: nothing to weigh
    routed = skew_join(skew_join(test, listed, "owner", hot=hot_owners), degree, "target", hot=hot_targets)
    routed = written(routed, "routed")
    short_history = routed.filter(F.col("listed") <= F.col("degree")).select("owner", "target")
    short_model = routed.filter(F.col("listed") > F.col("degree")).select("owner", "target")
    # an active owner repeats its history, a popular target its model row: both are spread
    by_history = skew_join(short_history, history, "owner", hot=hot_owners).join(oriented, ["target", "near"])
    by_model = skew_join(short_model, oriented, "target", hot=hot_targets).join(history, ["owner", "near"])
    return by_history.unionByName(by_model)


def _fallback(found: DataFrame, avgs: DataFrame, overall: DataFrame, column: str, hot: list) -> DataFrame:
    """Add ``avg`` of ``column`` or the overall average, and whether the id is unknown."""
    joined = skew_join(found, avgs.withColumnRenamed("id", column), column, "left", hot=hot)
    known = F.col("avg").isNotNull()
    return joined.withColumns({
        "cold_start": ~known,
        "avg": F.coalesce(F.col("avg"), overall.select("avg").scalar()),
    })


def _weighted(top: Column, weight: Column, otherwise: Column, base: Column | None = None) -> Column:
    ratio = top / weight if base is None else base + top / weight
    return F.when((weight == 0) | (top == 0) | top.isNull(), otherwise).otherwise(ratio)


def predict_item(
    test: DataFrame, train: DataFrame, model: DataFrame, avgs: DataFrame, overall: DataFrame, n: int = NEIGHBOURS
) -> DataFrame:
    """``user_id, business_id, stars, cold_start`` from the user's ratings of the ``n`` most similar items.

    Without a rated neighbour the item's average is given, or the overall one for an unknown item.
    """
    pairs = written(test.select("user_id", "business_id").distinct(), "asked")
    history = train.select(F.col("user_id").alias("owner"), F.col("business_id").alias("near"), "stars").distinct()
    asked = pairs.select(F.col("user_id").alias("owner"), F.col("business_id").alias("target"))
    hot_users, hot_items = hot_keys(pairs, "user_id"), hot_keys(pairs, "business_id")
    near = _neighbours(asked, history, model, (hot_users, hot_items))
    best = Window.partitionBy("owner", "target").orderBy(F.desc("sim"), "near", "stars")
    chosen = near.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= n)
    weighed = chosen.groupBy("owner", "target").agg(
        F.sum(F.col("sim") * F.col("stars")).alias("top"), F.sum(F.abs("sim")).alias("weight")
    )
    found = pairs.join(weighed.withColumnsRenamed({"owner": "user_id", "target": "business_id"}),
                       ["user_id", "business_id"], "left")
    whole = _fallback(found, avgs, overall, "business_id", hot_items)
    stars = _weighted(F.col("top"), F.col("weight"), F.col("avg"))
    return whole.select("user_id", "business_id", stars.alias("stars"), "cold_start")


def predict_user(
    test: DataFrame, train: DataFrame, model: DataFrame, avgs: DataFrame, overall: DataFrame
) -> DataFrame:
    """``user_id, business_id, stars, cold_start`` from all similar users who rated the item.

    Each neighbour's rating counts by how far it lies from that neighbour's average. Items nobody rated are
    dropped.
    """
    rated = train.select(F.col("business_id").alias("owner"), F.col("user_id").alias("near"), "stars").distinct()
    near_avgs = avgs.withColumnsRenamed({"id": "near", "avg": "near_avg"})
    rated = written(skew_join(rated, near_avgs, "near", hot=hot_keys(train, "user_id")), "rated")
    pairs = written(test.select("user_id", "business_id").distinct(), "asked")
    hot_users, hot_items = hot_keys(pairs, "user_id"), hot_keys(pairs, "business_id")
    known = rated.select(F.col("owner").alias("business_id")).distinct()
    pairs = skew_join(pairs, known, "business_id", "left_semi", hot=hot_items)
    asked = pairs.select(F.col("business_id").alias("owner"), F.col("user_id").alias("target"))
    near = _neighbours(asked, rated, model, (hot_items, hot_users))
    weighed = near.groupBy("owner", "target").agg(
        F.sum((F.col("stars") - F.col("near_avg")) * F.col("sim")).alias("top"), F.sum(F.abs("sim")).alias("weight")
    )
    found = pairs.join(weighed.withColumnsRenamed({"owner": "business_id", "target": "user_id"}),
                       ["user_id", "business_id"], "left")
    whole = _fallback(found, avgs, overall, "user_id", hot_users)
    stars = _weighted(F.col("top"), F.col("weight"), F.col("avg"), F.col("avg"))
    return whole.select("user_id", "business_id", stars.alias("stars"), "cold_start")


def hit_rate(truth: DataFrame, predictions: DataFrame, keys: list[str]) -> DataFrame:
    """``hits, total, rate``: share of distinct truth pairs that were predicted, each counted once."""
    wanted = truth.select(*keys).distinct()
    given = predictions.select(*keys).distinct().withColumn("_hit", F.lit(1))
    return wanted.join(given, keys, "left").agg(
        F.count("_hit").alias("hits"),
        F.count("*").alias("total"),
        F.coalesce(F.try_divide(F.count("_hit"), F.count("*")), F.lit(0.0)).alias("rate"),
    )
