import random
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from gleaner.operators.pairs import SUMS, Need, overlaps


def ratings(seed, items=40, elements=30, rows=350):
    """Elements 0 and 1 are held by most items, the others by few."""
    draw = random.Random(seed)
    held = {}
    for i in range(items):
        for e in (0, 1, 2):
            if draw.random() < 0.7:
                held[i, e] = draw.randint(1, 5)
    while len(held) < rows:
        held[draw.randrange(items), draw.randrange(elements)] = draw.randint(1, 5)
    for copy in range(items, items + 6):  # items with the hot element only
        held[copy, 0] = 3
    return held


def brute(held, need):
    by_item = defaultdict(dict)
    for (i, e), v in held.items():
        by_item[i][e] = float(v)
    found = {}
    for a, c in combinations(sorted(by_item), 2):
        both = by_item[a].keys() & by_item[c].keys()
        n = len(both)
        if n < need.common or (need.jaccard and n / len(by_item[a].keys() | by_item[c].keys()) < need.jaccard):
            continue
        x, y = [by_item[a][e] for e in both], [by_item[c][e] for e in both]
        found[a, c] = (
            n, sum(x), sum(y), sum(v * v for v in x), sum(v * v for v in y), sum(v * w for v, w in zip(x, y))
        )
    return found


@pytest.mark.parametrize("need", [Need(1), Need(3), Need(1, 0.3), Need(3, 0.2)])
@pytest.mark.parametrize("max_group", [1000, 5])
def test_overlaps_match_the_full_self_join(spark, need, max_group):
    held = ratings(7)
    rows = spark.createDataFrame([(i, e, float(v)) for (i, e), v in held.items()], "item int, rater int, stars double")
    got = overlaps(rows, "item", "rater", "stars", need, max_group)
    assert {(r["k1"], r["k2"]): tuple(r[c] for c in SUMS) for r in got.collect()} == brute(held, need)


def test_counts_without_values(spark):
    held = ratings(8)
    rows = spark.createDataFrame(list(held), "item int, rater int")
    got = overlaps(rows, "item", "rater", need=Need(2), max_group=6)
    assert {(r["k1"], r["k2"]): r["n"] for r in got.collect()} == {k: v[0] for k, v in brute(held, Need(2)).items()}


def test_a_hot_element_alone_forms_no_pairs(spark):
    """400 items share one element and nothing else: with a need of two no pair of them may be built."""
    rows = spark.createDataFrame([(i, 0) for i in range(400)] + [(i, 1000 + i) for i in range(400)], "item int, e int")
    assert overlaps(rows, "item", "e", need=Need(2), max_group=20).count() == 0


def test_light_pairs_travel_as_lists(spark):
    """No row per pair before the sums: an item's lists go on over batches, nulls count as in SQL sums, names may be strings."""
    draw = random.Random(3)
    held = {(f"i{draw.randrange(40)}", draw.randrange(60)): draw.choice([None, 1.0, 2.0, 5.0]) for _ in range(900)}
    rows = spark.createDataFrame([(i, e, x) for (i, e), x in held.items()], "item string, element int, x double").localCheckpoint()
    most = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        found = overlaps(rows, "item", "element", "x", Need(2))
        assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[0]
        got = {(r["k1"], r["k2"]): tuple(r[c] for c in SUMS) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
    one, two = rows.toDF("k1", "element", "x"), rows.toDF("k2", "element", "y")
    sums = ["sum(x) sx", "sum(y) sy", "sum(x * x) sxx", "sum(y * y) syy", "sum(x * y) sxy"]
    whole = one.join(two, "element").filter("k1 < k2").groupBy("k1", "k2").agg(*[F.expr(e) for e in ("count(*) n", *sums)]).filter("n >= 2")
    assert got == {(r["k1"], r["k2"]): tuple(r[c] for c in SUMS) for r in whole.collect()} and got
