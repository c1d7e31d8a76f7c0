import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators import skew
from gleaner.operators.numbering import numbered, ranked, token_dict


@pytest.fixture(scope="module")
def sides(spark):
    draw = random.Random(1)
    big = [(1 if draw.random() < 0.4 else draw.randint(2, 30), i) for i in range(600)] + [(None, -1)]
    small = [(k, c) for k in range(0, 25) for c in "ab"[: 1 + k % 2]]
    return spark.createDataFrame(big, "k int, v int"), spark.createDataFrame(small, "k int, c string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_keys_join_like_a_plain_join(sides, how):
    big, small = sides
    plain = big.join(small, ["k"], how)
    split = skew.skew_join(big, small, "k", how, limit=20)
    assert sorted(map(repr, split.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_more_hot_keys_than_are_broadcast(sides, how):
    """All of them are split, none is left out for being one too many."""
    big, small = sides
    hot = skew.hot_keys(big, ["k"], limit=5, most=3)
    counts = {r["k"]: r["count"] for r in big.groupBy("k").count().collect()}
    assert {r["k"]: r["_pieces"] for r in hot.collect()} == {k: -(-n // 5) for k, n in counts.items() if n > 5}
    plain = big.join(small, ["k"], how)
    split = skew.skew_join(big, small, "k", how, limit=5, most=3)
    assert sorted(map(repr, split.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))


def test_only_keys_over_the_limit_are_hot(sides):
    hot = skew.hot_keys(sides[0], ["k"], limit=100)
    assert [(r["k"], r["_pieces"]) for r in hot] == [(1, -(-sides[0].filter("k = 1").count() // 100))]


def test_given_counts_decide(sides):
    big, small = sides
    counts = big.groupBy("k").agg(F.count("*").alias("_n"))
    joined = skew.skew_join(big, small, "k", limit=20, counts=counts)
    assert joined.count() == big.join(small, "k").count()


def test_numbered_is_the_position_in_the_order(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(7)
    got = numbered(rows, [F.desc("x")], "pos").collect()
    assert all(r["pos"] == 4999 - r["x"] for r in got) and len(got) == 5000


def test_ranked_restarts_in_each_group(spark):
    rows = spark.range(900).select((F.col("id") % 3).alias("g"), F.col("id").alias("x"))
    got = ranked(rows, "g", [F.desc("x")], "place").collect()
    assert all(r["place"] == (897 + r["g"] - r["x"]) // 3 + 1 for r in got)


def test_tokens_follow_id_order(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",), ("b",), (None,)], "u string")
    assert {r["id"]: r["token"] for r in token_dict(rows, "u").collect()} == {"a": 0, "b": 1, "c": 2}
