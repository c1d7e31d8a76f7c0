from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gleaner.functions import hashing as H
from gleaner.operators import graph, sketch

NAMES = ["Las Vegas", "Montréal", "Zürich", "Phoenix", "東京", "a", ""]


def number(text):
    return int.from_bytes(text.encode("utf8"), "big")


def test_text_number(spark):
    rows = spark.createDataFrame([(n,) for n in NAMES if n], "c string")
    got = {r["c"]: r["x"] for r in rows.select("c", H.text_number(F.col("c")).alias("x")).collect()}
    assert got == {n: number(n) % H.SKETCH_PRIME for n in NAMES if n}


def test_trailing_zeros(spark):
    rows = spark.createDataFrame([(0,), (1,), (8,), (12,), (2**21,)], "v long")
    assert [r[0] for r in rows.select(H.trailing_zeros(F.col("v"))).collect()] == [20, 0, 3, 2, 21]


def test_bloom(spark):
    build = spark.createDataFrame([(f"city{i}",) for i in range(200)] + [(None,), ("",)], "c string")
    asked = spark.createDataFrame([(i, f"city{i}") for i in range(400)] + [(900, None), (901, "")], "id int, c string")
    bits = sketch.bloom_bits(build, "c")
    family = H.sketch_family(7, 8351)
    places = {(h.a * number(f"city{i}") + h.c) % h.prime % h.buckets for i in range(200) for h in family}
    assert {r["pos"] for r in bits.collect()} == places
    got = {r["id"]: r["flag"] for r in sketch.bloom_probe(asked, "c", bits).collect()}
    expected = {
        i: int(all((h.a * number(f"city{i}") + h.c) % h.prime % h.buckets in places for h in family)) for i in range(400)
    }
    assert got == {**expected, 900: 0, 901: 0}
    assert all(got[i] for i in range(200)) and sum(got.values()) < 260


def test_empty_bloom_filter_answers_no(spark):
    bits = sketch.bloom_bits(spark.createDataFrame([(None,)], "c string"), "c")
    asked = spark.createDataFrame([("x",)], "c string")
    assert sketch.bloom_probe(asked, "c", bits).first()["flag"] == 0


@pytest.mark.parametrize("group_mean", [False, True])
def test_distinct_estimate(spark, group_mean):
    values = [f"u{i % 700}" for i in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,), ("",)], "c string")
    got = sketch.fm_estimate(rows, "c", group_mean=group_mean).first()
    tails = [
        max(20 if (v := (h.a * number(c) + h.c) % h.prime % h.buckets) == 0 else (v & -v).bit_length() - 1
            for c in set(values))
        for h in H.sketch_family(12, H.FM_BUCKETS)
    ]
    assert got["exact"] == 700
    assert got["estimate"] == sum(2**t for t in tails) // (12 if group_mean else 24)


def test_no_value_gives_no_estimate(spark):
    assert sketch.fm_estimate(spark.createDataFrame([(None,)], "c string"), "c").count() == 0


def test_samples_of_parts_merge(spark):
    rows = spark.range(5000).withColumnRenamed("id", "m")
    whole = {r["m"] for r in sketch.reservoir(rows, "m", 50).collect()}
    parts = sketch.reservoir(rows.filter("m < 2500"), "m", 50).union(sketch.reservoir(rows.filter("m >= 2500"), "m", 50))
    assert {r["m"] for r in sketch.reservoir(parts, "m", 50).collect()} == whole and len(whole) == 50


def test_tag_order(spark):
    rows = spark.createDataFrame([(["b", "A"],), (["A"],), (["c"],)], "tags array<string>")
    assert [tuple(r) for r in sketch.tag_counts(rows).collect()] == [("A", 2), ("b", 1), ("c", 1)]


def propagate(edges, rounds):
    near = defaultdict(list)
    for a, c in edges:
        near[a].append(c)
        near[c].append(a)
    labels = {n: n for n in near}
    for _ in range(rounds):
        labels = {
            n: min(Counter(labels[m] for m in ms).items(), key=lambda kv: (-kv[1], kv[0]))[0] for n, ms in near.items()
        }
    return labels


EDGES = [(1, 2), (2, 3), (1, 3), (3, 4), (4, 5), (5, 6), (4, 6), (7, 8), (10, 11), (10, 12), (10, 13)]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_label_propagation(spark, kind):
    name = (lambda n: n) if kind == "long" else (lambda n: "abcdefghijklmn"[n] * (1 + n % 3))
    named = [(name(a), name(c)) for a, c in EDGES]
    edges = spark.createDataFrame(named, f"src {kind}, dst {kind}")
    for rounds in (1, 5):
        got = {r["id"]: r["label"] for r in graph.label_propagation(edges, rounds).collect()}
        assert got == propagate(named, rounds)


def test_community_lines(spark):
    labels = spark.createDataFrame([("b", "a"), ("a", "a"), ("c", "a"), ("x", "x"), ("d", "x")], "id string, label string")
    members = graph.communities(labels)
    assert {(r["label"], r["size"]) for r in members.collect()} == {("a", 3), ("x", 2)}
    lines = [r["line"] for r in graph.community_lines(members).orderBy("line_no").collect()]
    assert lines == ["'d', 'x'", "'a', 'b', 'c'"]
    cut = [r["line"] for r in graph.community_lines(members, per_line=2).orderBy("line_no").collect()]
    assert cut == ["'d', 'x'", "'a', 'b'", "'c'"]


def test_edges_and_nodes(spark):
    rows = [(u, i) for u, items in {1: "abc", 2: "abcd", 3: "cd", 4: "z"}.items() for i in items]
    edges = graph.cooccur_edges(spark.createDataFrame(rows, "u int, i string"), "u", "i", 2)
    assert {tuple(r) for r in edges.collect()} == {(1, 2, 3), (2, 3, 2)}
    assert {r["id"] for r in graph.nodes(edges).collect()} == {1, 2, 3}
