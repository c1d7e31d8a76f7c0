import math
import random
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from gleaner.functions.hashing import USER_MINHASH_BUCKETS, minhash_family
from gleaner.operators import recommend


@pytest.fixture(scope="module")
def log():
    """(user, business, stars, day, review); repeated ratings included."""
    draw = random.Random(11)
    rows = [(draw.randrange(25), draw.randrange(12), draw.randint(1, 5), draw.randrange(50), r) for r in range(260)]
    return rows + [(99, 0, 4, 1, 1000), (98, 77, 5, 1, 1001)]


@pytest.fixture(scope="module")
def train(spark, log):
    rows = [(u, b, float(s), r, d) for u, b, s, d, r in log]
    df = spark.createDataFrame(rows, "user_id int, business_id int, stars double, review_id long, day int")
    return df.withColumn("date", F.timestamp_seconds(F.col("day") * 86400))


def latest(log):
    best = {}
    for u, b, s, d, r in log:
        best[u, b] = max(best.get((u, b), (-1, -1, -1)), (d, r, s))
    return {k: v[2] for k, v in best.items()}


def correlate(ri, rj, mean):
    both = ri.keys() & rj.keys()
    li, lj = (len(ri), len(rj)) if mean == "full" else (len(both), len(both))
    ai, aj = sum(ri[k] for k in both) / li, sum(rj[k] for k in both) / lj
    top = sum((ri[k] - ai) * (rj[k] - aj) for k in both)
    bottom = math.sqrt(sum((ri[k] - ai) ** 2 for k in both)) * math.sqrt(sum((rj[k] - aj) ** 2 for k in both))
    return top / bottom if bottom else 0.0


def item_model(log, mean="full", axis=1, least=3):
    counts, vectors = defaultdict(int), defaultdict(dict)
    for row in log:
        counts[row[axis]] += 1
    for (u, b), s in latest(log).items():
        pair = (u, b)
        vectors[pair[axis]][pair[1 - axis]] = s
    out = {}
    for i, j in combinations(sorted(k for k in vectors if counts[k] >= 3), 2):
        if len(vectors[i].keys() & vectors[j].keys()) >= least:
            sim = correlate(vectors[i], vectors[j], mean)
            if sim > 1e-12:
                out[i, j] = sim
    return out


def as_dict(df):
    return {(r["k1"], r["k2"]): r["sim"] for r in df.collect()}


def test_latest_rating_wins(train, log):
    got = {(r["user_id"], r["business_id"]): r["stars"] for r in recommend.ratings_dedup(train).collect()}
    assert got == latest(log)


@pytest.mark.parametrize("mean, max_group", [("full", 1000), ("full", 8), ("corated", 1000)])
def test_item_model(train, log, mean, max_group):
    got = as_dict(recommend.pearson(train, "business_id", "user_id", mean=mean, max_group=max_group))
    assert got == pytest.approx(item_model(log, mean))


def test_user_model_is_part_of_the_full_one(train, log):
    family = minhash_family(200, USER_MINHASH_BUCKETS)
    got = as_dict(recommend.pearson_lsh(train, "user_id", "business_id", family, 100))
    full = item_model(log, axis=0)
    assert set(got) <= set(full) and len(got) > 0.9 * len(full)
    assert got == pytest.approx({k: full[k] for k in got})


def averages(log, axis):
    values = defaultdict(list)
    for row in log:
        values[row[axis]].append(row[2])
    return {k: sum(v) / len(v) for k, v in values.items()}


ASKED = [(u, b) for u in range(0, 25, 2) for b in range(12)] + [(0, 555), (555, 0), (555, 555), (99, 3), (98, 1), (0, 0)]


def test_item_predictions(spark, train, log):
    model = recommend.pearson(train, "business_id", "user_id")
    test = spark.createDataFrame(ASKED, "user_id int, business_id int")
    got = recommend.predict_item(
        test, train, model, recommend.averages(train, "business_id"), recommend.overall_average(train)
    ).collect()
    sims, avg = item_model(log), averages(log, 1)
    overall = sum(r[2] for r in log) / len(log)
    expected = {}
    for u, b in set(ASKED):
        rated = {(i, s) for v, i, s, _, _ in log if v == u}
        near = sorted(
            ((sims.get((min(i, b), max(i, b)), 0), i, s) for i, s in rated), key=lambda n: (-n[0], n[1], n[2])
        )[:3]
        top, weight = sum(n[0] * n[2] for n in near), sum(n[0] for n in near)
        expected[u, b] = top / weight if top else avg.get(b, overall)
    assert {(r["user_id"], r["business_id"]): r["stars"] for r in got} == pytest.approx(expected)
    assert all(r["cold_start"] == (r["business_id"] == 555) for r in got)


def test_ready_averages_with_an_unknown_entry(spark):
    ready = spark.createDataFrame([("b1", 4.0), ("UNK", 3.5)], "id string, avg double")
    train = spark.createDataFrame([("u1", "b1", 4.0)], "user_id string, business_id string, stars double")
    model = spark.createDataFrame([], "k1 string, k2 string, sim double")
    test = spark.createDataFrame([("u1", "b1"), ("u9", "b9")], "user_id string, business_id string")
    got = recommend.predict_item(test, train, model, *recommend.split_averages(ready)).collect()
    assert {r["business_id"]: (r["stars"], r["cold_start"]) for r in got} == {"b1": (4.0, False), "b9": (3.5, True)}


def test_user_predictions(spark, train, log):
    family = minhash_family(200, USER_MINHASH_BUCKETS)
    model = recommend.pearson_lsh(train, "user_id", "business_id", family, 100)
    sims = as_dict(model)
    test = spark.createDataFrame(ASKED, "user_id int, business_id int")
    got = recommend.predict_user(
        test, train, model, recommend.averages(train, "user_id"), recommend.overall_average(train)
    ).collect()
    avg, overall = averages(log, 0), sum(r[2] for r in log) / len(log)
    expected = {}
    for u, b in set(ASKED):
        raters = {(v, s) for v, i, s, _, _ in log if i == b}
        if not raters:
            continue
        near = [(sims.get((min(u, v), max(u, v)), 0), s - avg[v]) for v, s in raters]
        top, weight = sum(w * d for w, d in near), sum(w for w, _ in near)
        base = avg.get(u, overall)
        expected[u, b] = base + top / weight if top else base
    assert {(r["user_id"], r["business_id"]): r["stars"] for r in got} == pytest.approx(expected)
    assert all(r["cold_start"] == (r["user_id"] == 555) for r in got)


def test_hit_rate_counts_a_pair_once(spark):
    truth = spark.createDataFrame([(1, 1), (1, 1), (2, 2), (3, 3)], "u int, b int")
    given = spark.createDataFrame([(1, 1), (1, 1), (3, 3), (9, 9)], "u int, b int")
    assert tuple(recommend.hit_rate(truth, given, ["u", "b"]).first()) == (2, 3, pytest.approx(2 / 3))


def test_banded_user_correlations_have_high_recall(spark, sf):
    """Bands find most of the correlated users, and the same correlations; the exact form finds all."""
    from gleaner.plans.queries import queries

    found = {(r["k1"], r["k2"]): r["sim"] for r in queries()["q_pearson_user"](spark, sf).collect()}
    known = {(r["k1"], r["k2"]): r["sim"] for r in queries()["q_pearson_user_exact"](spark, sf).collect()}
    assert found.items() <= known.items()
    assert len(found) >= 0.9 * len(known) > 100


@pytest.fixture
def most_rows(monkeypatch):
    """Rows of the largest table written by the operators."""
    from gleaner.operators import similarity

    counts, write = [0], similarity.written

    def counted(df, label):
        table = write(df, label)
        counts[0] = max(counts[0], table.count())
        return table

    for module in (similarity, recommend):
        monkeypatch.setattr(module, "written", counted)
    return counts


@pytest.fixture(scope="module")
def strangers(spark):
    """100 groups of 3 users rate 4 businesses of their own: pairs have common ratings within a group only."""
    rows = [(u, 4 * (u // 3) + k, float(1 + (u + k * (1 + u % 2)) % 5), 4 * u + k) for u in range(300) for k in range(4)]
    df = spark.createDataFrame(rows, "user_id int, business_id int, stars double, review_id long")
    return df.withColumn("date", F.timestamp_seconds(F.lit(86400)))


def test_user_model_costs_no_pairs_of_chance_buckets(strangers, most_rows):
    """Functions of two values: most of the 44,850 pairs of users share a bucket."""
    found = as_dict(recommend.pearson_lsh(strangers, "user_id", "business_id", minhash_family(40, 2), 20))
    assert found and all(u // 3 == v // 3 for u, v in found)
    assert 0 < most_rows[0] <= 1200


def test_user_predictions_cost_no_pairs_of_chance_buckets(spark, strangers, most_rows):
    model = recommend.pearson_lsh(strangers, "user_id", "business_id", minhash_family(40, 2), 20)
    asked = spark.createDataFrame([(u, 4 * (u // 3)) for u in range(300)], "user_id int, business_id int")
    overall = recommend.overall_average(strangers)
    found = recommend.predict_user(asked, strangers, model, recommend.averages(strangers, "user_id"), overall)
    assert found.count() == 300
    assert 0 < most_rows[0] <= 1200
