import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from gleaner.operators import itemsets
from gleaner.sources.writers import write_lines


def basket_data(seed=3, n=60, items="abcdefgh"):
    draw = random.Random(seed)
    data = {i: sorted(x for x in items if draw.random() < 0.35) for i in range(n)}
    for i in range(n, n + 4):  # large baskets
        data[i] = sorted(items + "xyz")
    return {k: v for k, v in data.items() if v}


def brute(data, least, max_k=None):
    counts = Counter(
        s for items in data.values() for k in range(1, (max_k or len(items)) + 1) for s in combinations(items, k)
    )
    return {s: n for s, n in counts.items() if n >= least}


@pytest.fixture(scope="module")
def data():
    return basket_data()


@pytest.fixture(scope="module")
def rows(spark, data):
    return spark.createDataFrame([(b, i) for b, items in data.items() for i in items], "basket_id long, item string")


def as_dict(df):
    return {tuple(r["items"]): r["support"] for r in df.collect()}


@pytest.mark.parametrize("method", ["levelwise", "pcy", "son", "fpgrowth"])
@pytest.mark.parametrize("large", [6, 200])
def test_methods_match_brute_force(rows, data, method, large):
    got = itemsets.frequent_itemsets(rows, 9, method=method, buckets=11, chunks=3, large=large)
    assert as_dict(got) == brute(data, 9)


def residue_bucket(t1, t2, buckets):
    side = itemsets._side(buckets)
    low, high = sorted((t1 % side, t2 % side))
    return high * (high + 1) // 2 + low


def pair_rows(rows, buckets):
    coded = itemsets._tokens_of(rows).withColumn("r", F.col("token") % itemsets._side(buckets)).drop("token")
    other = coded.withColumnsRenamed({"item": "i2", "r": "_r"})
    return coded, coded.withColumnRenamed("item", "i1").join(other, "basket_id").filter("i1 < i2")


@pytest.mark.parametrize("limit", [0, 1 << 27])
def test_bitmap_prunes_pairs_before_they_are_listed(rows, data, monkeypatch, limit):
    """Whatever the number of buckets, occurrences of a full bucket stay and those of others go, by either way to the bits."""
    monkeypatch.setattr(itemsets, "BROADCAST_BUCKETS", limit)
    token = {x: t for t, x in enumerate(sorted({x for v in data.values() for x in v}))}
    met = [tuple(sorted(p)) for v in data.values() for p in combinations(v, 2)]
    for buckets in (1, 12, 300):
        coded, found = pair_rows(rows, buckets)
        bucket = lambda p: residue_bucket(token[p[0]], token[p[1]], buckets)  # noqa: B023, E731
        counts = Counter(map(bucket, met))
        kept = itemsets._bucket_prune(found, 2, coded, 20, buckets)
        assert Counter((r["i1"], r["i2"]) for r in kept.collect()) == Counter(p for p in met if counts[bucket(p)] >= 20)
    assert kept.count() < len(met)  # enough buckets leave none but frequent pairs
    assert {tuple(r) for r in kept.select("i1", "i2").collect()} == {p for p, n in Counter(met).items() if n >= 20}


def test_bitmap_of_larger_sets_loses_no_frequent_set(rows, data):
    triples = [t for v in data.values() for t in combinations(v, 3)]
    frame = rows.sparkSession.createDataFrame([(i, *t) for i, t in enumerate(triples)], "basket_id int, i1 string, i2 string, i3 string")
    kept = Counter((r.i1, r.i2, r.i3) for r in itemsets._bucket_prune(frame, 3, None, 15, 500).collect())
    counts = Counter(triples)
    assert all(kept[t] == n for t, n in counts.items() if n >= 15) and sum(kept.values()) < len(triples)


def test_bitmap_has_two_buckets_a_basket(rows, data):
    assert itemsets.bitmap_size(rows) == 2 * len(data)
    full = rows.sparkSession.createDataFrame([(0, 9), (63, 9), (64, 9), (1000, 9)], "bucket long, n long")
    assert {r["at"]: r["word"] for r in itemsets.bitmap(full).collect()} == {0: (1 | 1 << 63) - (1 << 64), 1: 1, 15: 1 << 40}


def test_candidates_have_only_frequent_subsets(spark):
    pairs = ["ab", "ac", "bc", "bd", "cd", "ad", "ce", "de", "xy"]
    frame = spark.createDataFrame([(p[0], p[1], 5 + i) for i, p in enumerate(pairs)], "i1 string, i2 string, support long")
    made = {(r.i1, r.i2, r.i3): r.least for r in itemsets._candidates(frame, [], 2).collect()}
    assert made == {("a", "b", "c"): 5, ("a", "b", "d"): 5, ("a", "c", "d"): 6, ("b", "c", "d"): 7, ("c", "d", "e"): 9}
    triples = spark.createDataFrame([(*t, 3) for t in ("abc", "abd", "acd", "bcd", "abe", "ace")], "i1 string, i2 string, i3 string, support long")
    assert [(r.i1, r.i2, r.i3, r.i4) for r in itemsets._candidates(triples, [], 3).collect()] == [("a", "b", "c", "d")]


def test_triples_are_listed_only_where_all_pairs_are_frequent(rows, data, monkeypatch):
    sizes, real = {}, itemsets.written

    def watched(df, label):
        out = real(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(itemsets, "written", watched)
    least = 11
    got = itemsets.frequent_itemsets(rows, least, max_k=3)
    frequent = brute(data, least, 2)
    assert as_dict(got) == brute(data, least, 3)
    listed = sum(all(p in frequent for p in combinations(t, 2)) for v in data.values() for t in combinations(v, 3))
    assert sizes["occurrences3"] <= listed < sum(len(v) * (len(v) - 1) * (len(v) - 2) // 6 for v in data.values())


def test_strict_and_max_size(rows, data):
    got = itemsets.frequent_itemsets(rows, 9, max_k=2, strict=True, large=6)
    assert as_dict(got) == brute(data, 10, 2)


def test_support_above_all_gives_nothing(rows):
    assert itemsets.frequent_itemsets(rows, 10_000).count() == 0


def test_candidates_contain_all_frequent_sets(rows, data):
    found = {tuple(r["items"]) for r in itemsets.itemset_candidates(rows, 9, 4).collect()}
    assert found >= set(brute(data, 9))


def test_contained_counts_any_candidate(rows, data, spark):
    wanted = [("a", "b"), ("c",), ("a", "d", "x"), ("a", "nowhere")]
    sets = spark.createDataFrame([(list(w),) for w in wanted], "items array<string>")
    expected = {w: sum(set(w) <= set(v) for v in data.values()) for w in wanted}
    assert as_dict(itemsets.contained(rows, sets)) == {w: n for w, n in expected.items() if n}


def test_pcy_buckets_count_pairs_of_large_baskets_too(rows, data):
    token = {i: t for t, i in enumerate(sorted({i for v in data.values() for i in v}))}
    for buckets in (3, 7, None):
        n = buckets or 2 * len(data)
        counts = Counter(residue_bucket(token[x], token[y], n) for v in data.values() for x, y in combinations(v, 2))
        got = {r["bucket"]: r["n"] for r in itemsets.pcy_buckets(rows, 5, buckets).collect()}
        assert got == {k: n for k, n in counts.items() if n >= 5}


def chunk_candidates(data, support, chunks):
    found, n = set(), len(data)
    for chunk in range(chunks):
        part = {k: v for k, v in data.items() if k % chunks == chunk}
        need = -(-support * len(part) // n)
        counts = Counter(s for v in part.values() for k in range(1, 6) for s in combinations(v, k))
        found |= {s for s, c in counts.items() if c >= need}
    return found


@pytest.mark.parametrize("large", [3, 6, 200])
def test_chunk_candidates_match_brute_force_whatever_is_set_aside(rows, data, large, monkeypatch):
    monkeypatch.setattr(itemsets, "LARGE_BASKET", large)
    got = itemsets._chunk_frequent(rows, 20, 3, 5, F.pmod("basket_id", F.lit(3)), large)
    found = {tuple(r["items"]) for r in got.collect()}
    assert found == chunk_candidates(data, 20, 3)


def test_a_basket_of_ten_thousand_items_is_mined_in_its_chunk(spark, monkeypatch):
    """Its items are common in its chunk, yet it lists no pairs: what is written there is linear in it."""
    draw = random.Random(11)
    n = 10_000
    data = {0: list(range(n))} | {k: draw.sample(range(n), 20) for k in range(1, 4001)}
    for k in range(4001, 4013):
        data[k] = [5, 6, 7, 8]
    frame = spark.createDataFrame([(b, i) for b, v in data.items() for i in v], "basket_id long, item long")
    sizes, real = {}, itemsets.written

    def watched(df, label):
        out = real(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(itemsets, "written", watched)
    got = itemsets._chunk_frequent(frame, 6, 1, None, F.lit(0))
    found = {tuple(r["items"]): r["support"] for r in got.collect()}
    singles = Counter(i for v in data.values() for i in v)
    assert {k[0]: s for k, s in found.items() if len(k) == 1} == {i: c for i, c in singles.items() if c >= 6}
    assert len([k for k in found if len(k) == 1]) > 5000
    assert found[5, 6, 7, 8] == 13 and len(max(found, key=len)) == 4
    assert max(v for k, v in sizes.items() if k.startswith("held")) <= n
    assert sizes["occurrences2"] < 4012 * 190


def multi_brute(data, support, max_k):
    """All ways to pick positions of a basket; a set counts if its parts of one item less do."""
    kept = {}
    for k in range(1, max_k + 1):
        counts = Counter(tuple(sorted(s)) for v in data.values() for s in combinations(v, k))
        kept |= {s: c for s, c in counts.items() if c > support and (k == 1 or all(t in kept for t in combinations(s, k - 1)))}
    return kept


@pytest.mark.parametrize(("support", "max_k"), [(0, 3), (8, 3), (15, 4), (10_000, 3)])
def test_multisets_match_brute_force(spark, support, max_k):
    draw = random.Random(4)
    data = {b: draw.choices("abcdef", weights=(6, 3, 2, 1, 1, 1), k=draw.randrange(1, 9)) for b in range(40)}
    pairs = spark.createDataFrame([(b, i) for b, v in data.items() for i in v], "b long, i string")
    rows = itemsets.multiset_baskets(pairs, "b", "i")
    assert as_dict(itemsets.frequent_multisets(rows, support, max_k)) == multi_brute(data, support, max_k)


def test_basket_pieces_hold_every_item_once(rows, data):
    pieces = itemsets.basket_pieces(rows, limit=4).collect()
    whole = defaultdict(list)
    for r in pieces:
        whole[r["basket_id"]] += r["items"]
    assert {k: sorted(v) for k, v in whole.items()} == data


def test_report_lines(spark, tmp_path):
    sets = spark.createDataFrame([(["b"],), (["a"],), (["a", "b"],)], "items array<string>")
    lines = itemsets.itemset_report(sets, sets.filter(F.size("items") == 1))
    shown = [r["line"] for r in lines.orderBy("line_no").collect()]
    assert shown == ["Candidates:", "('a'),('b')", "", "('a', 'b')", "", "Frequent Itemsets:", "('a'),('b')", ""]
    write_lines(lines, str(tmp_path / "report"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "report").glob("part-*.txt")))
    assert text.splitlines() == shown


def repeated(spark, n):
    """``n`` baskets in two chunks, of three kinds."""
    kinds = [["a", "b", "c"], ["a", "b"], ["b", "c", "d", "e"]]
    data = {i: kinds[i // 2 % 3] for i in range(n)}
    return data, spark.createDataFrame([(b, i) for b, items in data.items() for i in items], "basket_id long, item string")


@pytest.mark.parametrize("method", ["levelwise", "pcy", "son"])
def test_equal_baskets_are_mined_once(spark, monkeypatch, method):
    """The tables that mining writes grow with the kinds of baskets, not with their number."""
    sizes, real = {}, itemsets.written

    def watched(df, label):
        out = real(df, label)
        sizes[label] = max(out.count(), sizes.get(label, 0))
        return out

    monkeypatch.setattr(itemsets, "written", watched)
    data, rows = repeated(spark, 300)
    got = itemsets.frequent_itemsets(rows, 50, method=method, chunks=2)
    assert as_dict(got) == brute(data, 50)
    chunks = 2 if method == "son" else 1
    assert max(sizes.values()) <= chunks * 45  # 45 sets are all that the three kinds hold


def test_merged_baskets_stand_for_all(spark):
    data, rows = repeated(spark, 100)
    large = [(1000, f"x{i}") for i in range(300)] + [(1001, f"x{i}") for i in range(300)]  # are not compared
    odd = [(2000, None), (2000, "a"), (2001, None), (2001, "a"), (None, "a"), (None, "b")]
    rows = rows.unionByName(spark.createDataFrame(large + odd, rows.schema))
    chunk = F.pmod("basket_id", F.lit(2))
    once = itemsets.merged(rows, chunk)
    kept = defaultdict(set)
    for r in once.collect():
        kept[r.basket_id, r.weight].add(r.item)
    expected = Counter((i % 2, frozenset(v)) for i, v in data.items())
    first = {(i % 2, frozenset(v)): i for i, v in reversed(data.items())}
    want = {(first[k], n): set(k[1]) for k, n in expected.items()}
    want |= {(b, 1): {f"x{i}" for i in range(300)} for b in (1000, 1001)}
    want |= {(2000, 1): {None, "a"}, (2001, 1): {None, "a"}, (None, 1): {"a", "b"}}
    assert kept == want
    again = itemsets.merged(once)
    assert itemsets.basket_count(rows) == itemsets.basket_count(once) == itemsets.basket_count(again) == 104
    assert sorted({(r.basket_id, r.weight) for r in again.collect()}, key=str)[:2] == [(0, 34), (1000, 1)]
    assert again.count() < once.count()
    plain = {(tuple(r.items), r.size) for r in itemsets.itemset_candidates(rows, 20, 2, chunk=chunk).collect()}
    assert plain == {(tuple(r.items), r.size) for r in itemsets.itemset_candidates(once, 20, 2, chunk=chunk).collect()}


@pytest.mark.parametrize("method", ["levelwise", "pcy", "son", "fpgrowth"])
@pytest.mark.parametrize("large", [2, 200])
def test_merged_baskets_give_the_same_sets(spark, method, large):
    data, rows = repeated(spark, 90)
    got = itemsets.frequent_itemsets(itemsets.merged(rows), 20, method=method, chunks=2, large=large)
    assert as_dict(got) == brute(data, 20)
    assert {r["bucket"]: r["n"] for r in itemsets.pcy_buckets(rows, 5, 9).collect()} == {
        r["bucket"]: r["n"] for r in itemsets.pcy_buckets(itemsets.merged(rows), 5, 9).collect()
    }
