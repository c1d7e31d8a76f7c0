import math
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleaner.functions import text as T
from gleaner.operators import reviews, textmodel
from gleaner.operators.skew import hot_keys

ODD = "It's  a\tb c d　e\x1cf\x85g\n!!! don't-stop, 3.14 abc3 Été x​y "


def py_words(text):
    return text.translate(str.maketrans("", "", string.punctuation)).split()


def test_words_split_like_the_unicode_rule(spark):
    row = spark.createDataFrame([(ODD,), ("",), ("...",)], "t string").select(T.words(F.col("t")).alias("w")).collect()
    assert [r["w"] for r in row] == [py_words(ODD), [], []]


def test_whole_and_prefix_words(spark):
    rows = spark.createDataFrame([("abc3 abc the 9ab été abc",)], "text string")
    prefix = {r["word"]: r["n"] for r in reviews.word_counts(rows, ["the"]).collect()}
    whole = {r["word"]: r["n"] for r in reviews.word_counts(rows, ["the"], full_match=True).collect()}
    assert prefix == {"abc3": 1, "abc": 2} and whole == {"abc": 2}


def test_stop_word_table(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 1)], "word string, n long")
    stop = spark.createDataFrame([("a",)], "word string")
    assert [r["word"] for r in reviews.without_words(counts, stop).collect()] == ["b"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([
        ("x", "Apple apple APPLE apple pear pear the of"),
        ("x", "plum! plum? 1234 kiwi"),
        ("y", "apple grape grape"),
        ("z", "the of a"),
    ], "k string, text string")


def expected_tf(rows, stop):
    docs = {}
    for k, text in rows:
        docs.setdefault(k, []).extend(
            w for w in (w.lower() for w in py_words(text)) if re.match("[a-zA-Z]+", w) and w not in stop and len(w) > 3
        )
    out = {}
    for k, words in docs.items():
        counts = Counter(words)
        kept = {w: n for w, n in counts.items() if n > 3} or counts
        out.update({(k, w): n / len(words) for w, n in kept.items()})
    return out


def test_tf_lists_frequent_words_or_all(texts):
    stop = ["the", "of"]
    got = {(r["k"], r["word"]): r["tf"] for r in textmodel.tf(texts, "k", stop).collect()}
    assert got == pytest.approx(expected_tf([tuple(r) for r in texts.collect()], stop))


def test_idf_counts_all_documents(texts):
    weights = textmodel.tf(texts, "k", [])
    got = {r["word"]: r["idf"] for r in textmodel.idf(weights, 3).collect()}
    assert got["apple"] == pytest.approx(math.log(3 / 2)) and got["grape"] == pytest.approx(math.log(3))


def test_profile_order_and_ties(spark):
    scores = spark.createDataFrame([("k", w, s) for w, s in [("d", 0.2), ("a", 0.1), ("c", 0.1), ("b", 0.3)]],
                                   "k string, word string, score double")
    low = [r["word"] for r in textmodel.tfidf_profile(scores, "k", 3).orderBy("rank").collect()]
    high = [r["word"] for r in textmodel.tfidf_profile(scores, "k", 3, "desc").orderBy("rank").collect()]
    assert low == ["a", "c", "d"] and high == ["b", "d", "a"]


def test_top_words_are_limited_before_the_shuffle(spark):
    scores = spark.createDataFrame([("k", "w", 1.0)], "k string, word string, score double")
    plan = textmodel.tfidf_top(scores, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_content_prediction(spark):
    profile = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "c")], "business_id int, word string")
    visits = spark.createDataFrame([(7, 1), (8, 2), (8, 1), (9, 5)], "user_id int, business_id int")
    users = textmodel.user_profile(visits, profile)
    asked = spark.createDataFrame([(7, 2), (7, 1), (8, 1), (9, 1), (7, 5), (7, 2)], "user_id int, business_id int")
    got = {(r[0], r[1]): r[2] for r in textmodel.content_predict(asked, users, profile).collect()}
    assert got == pytest.approx({(7, 2): 0.5, (7, 1): 1.0, (8, 1): 2 / math.sqrt(6)})


def test_category_rules(spark):
    business = spark.createDataFrame(
        [(1, "a, b"), (2, "a,,a"), (3, None), (4, ""), (5, "never")], "business_id int, categories string"
    )
    stars = spark.createDataFrame([(1, 4.0), (1, 2.0), (2, 5.0), (3, 1.0)], "business_id int, stars double")
    got = {r["category"]: r["stars"] for r in reviews.category_avg(stars, business).collect()}
    assert got == pytest.approx({"a": (6 + 10) / 4, "b": 3.0, "": 5.0})
    assert reviews.category_avg(stars, business, keep_empty=True).filter("category = 'never'").first()["stars"] == 0.0
    assert reviews.category_avg(stars, business, n=0).count() == 0


def test_missing_state_is_empty(spark):
    business = spark.createDataFrame([(1, "NV"), (2, None)], "business_id int, state string")
    rows = spark.createDataFrame([(1, 7, 1), (2, 7, 1), (3, 8, 2)], "review_id int, user_id int, business_id int")
    assert reviews.semi_state(rows, business, "NV").count() == 2
    assert [tuple(r) for r in reviews.semi_state(rows, business, "").collect()] == [(8, 2)]


def test_empty_partitions_are_listed(spark):
    rows = spark.createDataFrame([(3,), (3,), (11,)], "business_id int")
    got = reviews.partition_stats(rows, 8, "custom", F.col("business_id")).orderBy("pid").collect()
    assert [r["n_items"] for r in got] == [0, 0, 0, 3, 0, 0, 0, 0]
    assert sum(r["n_items"] for r in reviews.partition_stats(rows, 2).collect()) == 3


def test_few_partitions_do_not_run_the_join_before_them(spark, sf):
    from gleaner.plans import bindings

    rows = bindings.reviews(spark, sf)
    found = reviews.partition_stats(rows, 2)
    assert "l_orderkey" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [r["pid"] for r in found.orderBy("pid").collect()] == [0, 1]
    assert found.agg({"n_items": "sum"}).first()[0] == rows.count()


REPEATED = [
    (1, "b b a 12 the c_c  C"), (2, "b a"), (1, "a　a.d"), (None, "x y y"), (3, None), (4, ""), (None, "x the"), (5, "été b 1.5 B"),
]


def expected_counts(rows, stop):
    docs = {}
    for k, text in rows:
        docs.setdefault(k, Counter()).update(w.lower() for w in py_words(text or ""))
    listed = {(k, w): n for k, c in docs.items() for w, n in c.items() if w not in stop and not w.isdecimal()}
    return listed, {k: sum(c.values()) for k, c in docs.items()}


@pytest.mark.parametrize("most", [10_000, 0])  # repeated keys as a list, as a table
def test_document_words_of_single_and_repeated_keys(spark, monkeypatch, most):
    monkeypatch.setattr(textmodel, "hot_keys", lambda *a: hot_keys(*a, most=most))
    listed, total = expected_counts(REPEATED, ["the"])
    rows = spark.createDataFrame(REPEATED, "k long, text string").repartition(3)
    found = [tuple(r) for r in textmodel.document_tf(rows, "k", ["the"]).collect()]
    assert sorted(found, key=repr) == sorted(((k, w, n, n / total[k]) for (k, w), n in listed.items()), key=repr)
    top = [tuple(r) for r in textmodel.doc_top_words(rows, "k", ["the"], 2).collect()]
    best = [sorted(((-n, w) for (j, w), n in listed.items() if j == k))[:2] for k in total]
    assert sorted(top, key=repr) == sorted(((k, w, -n) for k, b in zip(total, best, strict=True) for n, w in b), key=repr)


def test_words_of_single_texts_are_counted_without_a_shuffle(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, "b")], "k long, text string")
    for found in (textmodel.document_tf(rows, "k", []), textmodel.doc_top_words(rows, "k", [], 1)):
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("common", [0.5, 3, 500_000])  # no word, some words, all words are broadcast
def test_scores_of_common_and_rare_words(spark, monkeypatch, common):
    monkeypatch.setattr(textmodel, "COMMON_WORDS", common)
    rows = [("x", "a", 0.5), ("x", "b", 0.5), ("y", "a", 1.0), ("z", "a", 0.25), ("z", "c", 0.75)]
    weights = spark.createDataFrame(rows, "k string, word string, tf double")
    df = Counter(w for _, w, _ in rows)
    found = {(r["k"], r["word"]): r["score"] for r in textmodel.tfidf(weights, 4, "k").collect()}
    assert found == pytest.approx({(k, w): tf * math.log(4 / df[w]) for k, w, tf in rows})


def test_rows_of_common_words_are_not_shuffled_by_word(spark):
    weights = spark.createDataFrame([("x", "a", 0.5)], "k string, word string, tf double")
    plan = textmodel.tfidf(weights, 4, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "Union" in plan


def test_top_scores_with_ties_at_the_limit(spark):
    rows = [(k, w, s + d) for k in (1, None) for w, s, d in [("d", 0.2, 0), ("c", 0.1, 0), ("a", 0.1, -1e-14), ("b", 0.1, 1e-14), ("e", 0.05, 0)]]
    scores = spark.createDataFrame(rows, "k int, word string, score double").coalesce(1)
    found = textmodel.tfidf_top(scores, "k", 2).collect()
    assert sorted(((r["k"], r["word"]) for r in found), key=repr) == sorted([(k, w) for k in (1, None) for w in "da"], key=repr)
