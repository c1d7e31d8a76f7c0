"""Periodic runs, ranked search and licence scans against brute force, with odd rows and empty tables."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import licenses, queries, runs, search

ODD = [None, "", " ", "\n\t", "a", "a a a a a", "a a a a a a", "é ö " * 12, "x y z " * 4000, "日本語 テキスト", "A b\nA b\n\nA b", "cc by", "CC-BY cc by cc"]
SCHEMA = "doc_id long, text string, _text string, runs int, score string"


@pytest.fixture(scope="module")
def docs(spark, sf):
    base = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [(10_000 + i // 2, t, "clash", i, None) for i, t in enumerate(ODD)] + [(10_003, ODD[8], "twice", 1, "")] * 2
    odd = spark.createDataFrame([*rows, (None, "no id no id no id no id", None, None, None)], SCHEMA)
    return base.withColumns({"_text": F.lit("x"), "runs": F.lit(1), "score": F.lit("s")}).unionByName(odd)


@pytest.fixture(scope="module")
def rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def all_runs(words):
    """Every lag, every diagonal; of equal stretches the smallest lag."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def test_sparse_diagonals_find_all_runs():
    draw = np.random.default_rng(5)
    for _ in range(600):
        parts = []
        for _ in range(draw.integers(1, 4)):
            n = int(draw.integers(0, 70))
            words = draw.integers(0, draw.integers(1, 4), n)
            if n and draw.random() < 0.7:
                s, p = int(draw.integers(0, n)), 1 + int(draw.integers(0, max(1, n // 4)))
                words = np.array([words[i] if i < s else words[s + (i - s) % p] for i in range(n)])
                words[draw.integers(0, n)] = 0
            parts.append(words)
        offsets = np.cumsum([0, *map(len, parts)])
        want = [(s + int(o), n, q) for o, x in zip(offsets, parts, strict=False) for s, n, q in all_runs(x.tolist())]
        doc = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        assert [tuple(r) for r in runs.find_runs(np.concatenate(parts).astype(np.int64), doc).tolist()] == want


def test_one_word_over_and_over_has_few_cells():
    names = np.zeros(50_000, np.int64)
    cells = sum(int((lag > 0).sum()) for _, lag in runs.active_lags(names, names))
    assert cells < 2 * len(names)  # its earlier occurrences are 1,249,975,000
    assert runs.find_runs(names, names).tolist() == [[0, 50_000, 1]]


def test_periodic_runs_of_texts(docs, rows, empty):
    def want(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        found = all_runs(words)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        return len(words), found, " ".join(w for i, w in enumerate(words) if i not in gone)

    small = docs.filter(F.coalesce(F.length("text"), F.lit(0)) < 30_000)
    given = [(k, t) for k, t in rows if len(t or "") < 30_000]
    got = [(str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(small).collect()]
    assert sorted(got) == sorted((str(k), *want(t)) for k, t in given)
    assert any(found for _, _, found, _ in got)
    assert runs.periodic_runs(empty).count() == 0


def test_loops_and_the_strongest_run(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.text): r.made for r in runs.looped(frame.withColumn("made", F.col("text")), text_col="made").collect()}
    changed = 0
    for k, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(k).encode()) if k is not None else 1
        want = text
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            want = " ".join(words[i if i < a else a + (i - a) % p] for i in range(n))
            changed += 1
        assert got[k, text] == want
    assert changed > 5
    one = lambda *x: "array(" + ",".join(f"named_struct('start',{s}L,'length',{n}L,'period',{q}L)" for s, n, q in x) + ")"
    best = spark.range(1).select(runs.strongest(F.expr(one((0, 9, 2), (3, 18, 4), (4, 27, 6), (9, 13, 3)))).alias("b")).first().b
    assert tuple(best) == (0, 9, 2)


def ranking(rows, items, k=50):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    texts = [(i, cut(t)) for i, t in rows]
    n, words = sum(1 for _, t in texts if t), sum(len(t) for _, t in texts)
    df = {}
    for _, t in texts:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for doc, t in texts:
            m = 50 + (50 * len(t) * n) // max(words, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10**9 * t.count(x) // (1000 * t.count(x) + 20 * m))
                for x in set(cut(text)) if x in t
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, r, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(900, "no id"), (901, None), (902, "!!"), (None, "a b x"), (903, "X y z x y"), (903, "X y z x y"), (904, "é テキスト")]


@pytest.mark.parametrize(("block", "passes"), [(2_000_000, 200_000), (500, 200_000), (60, 400)])
def test_ranked_search_matches_brute_force(spark, sf, docs, rows, monkeypatch, block, passes):
    monkeypatch.setattr(search, "BLOCK_POSTINGS", block)
    monkeypatch.setattr(search, "PASS_TERMS", passes)
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").limit(12).unionByName(spark.createDataFrame(ITEMS, "item_id long, text string"))
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    got = [tuple(r) for r in search.ranked_search(docs, bench).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=str) == ranking(rows, items)


def test_ranked_search_of_empty_tables(spark, docs, empty):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search.ranked_search(empty, bench).count() == 0
    assert search.ranked_search(docs, bench.limit(0)).count() == 0


def test_best_positions_stop_early_and_keep_ties():
    draw = np.random.default_rng(6)
    for ties in (False, True):
        docs, terms, k = 5000, 4, 10
        count = np.where(draw.random((docs, terms)) < 0.3, draw.integers(1, 3 if ties else 60, (docs, terms)), 0)
        n = np.full(docs, 100) if ties else draw.lognormal(5, 1.5, docs).astype(np.int64) + 1
        if not ties:
            count[:: docs // 20], n[:: docs // 20] = 60, 5  # some documents of which all lists think highly
        doc, term = np.nonzero(count)
        block = search.Block(np.array([3000, 2000, 1500, 900]), n, term, count[doc, term], doc, docs, int(n.sum()))
        total = np.bincount(doc, weights=block.impact, minlength=docs).astype(np.int64)
        found, scores, reads = block.best(np.arange(terms), np.ones(terms, bool), k, 1)
        assert (total[found] == scores).all()
        kth = np.sort(total)[-k]
        assert set(np.flatnonzero(total >= kth)) <= set(found)  # ties with the k-th too
        if not ties:
            assert reads < len(doc) / 2
        again, _, _ = block.best(np.arange(terms), np.ones(terms, bool), k, int(kth))
        assert set(np.flatnonzero(total >= kth)) <= set(again)


def test_automaton_gives_matching_statistics():
    draw = np.random.default_rng(7)
    for _ in range(150):
        made = [draw.integers(0, 3, draw.integers(0, 9)).tolist() for _ in range(draw.integers(1, 5))]
        automaton = licenses.Automaton(made)
        text = draw.integers(0, 4, 25).tolist()
        inside = lambda part, x: [i for i in range(len(x) - len(part) + 1) if x[i : i + len(part)] == part]
        for i, (state, length) in enumerate(automaton.matches(text)):
            most = max((n for n in range(1, i + 2) if any(inside(text[i + 1 - n : i + 1], x) for x in made)), default=0)
            part = text[i + 1 - most : i + 1]
            assert length == most
            if most:
                assert sorted(automaton.places[state]) == sorted({(k, s + most) for k, x in enumerate(made) for s in inside(part, x)})
            ending = {k for k, x in enumerate(made) if x and text[: i + 1][-len(x) :] == x}
            assert {k for k, n in automaton.whole[state] if n <= length} == ending


def test_phrases_match_brute_force(docs, rows, empty):
    def want(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        places = []
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
        return len(words), sorted(places)

    got = [(str(r.doc_id), r.n_words, [(p.start, p.label) for p in r.places]) for r in licenses.find_licenses(docs).collect()]
    assert sorted(got) == sorted((str(k), *want(t)) for k, t in rows)
    assert licenses.find_licenses(empty).count() == 0


def test_licence_texts_are_found_with_changes(spark):
    by = {}
    for t in licenses.default_templates():
        if t.share < 1:
            by[t.label] = t.text
    edited = re.sub(r"Software", "Program Thing", by["mit"], count=2).replace("free of charge", "at no cost")
    cases = {
        1: ("intro words here. " + by["mit"] + " more", {"mit"}),
        2: (edited, {"mit"}),
        3: (by["bsd-3-clause"], {"bsd-3-clause"}),
        4: (by["bsd-2-clause"], {"bsd-2-clause"}),
        5: (by["isc"] + " -- " + by["mit"], {"isc", "mit"}),
        6: ("This work is licensed under the GNU General Public License, version 2.", {"gpl-2.0"}),
        7: ("Licensed under CC BY-NC-SA 4.0.", {"cc-by-nc-sa-4.0"}),
        8: ("Licensed under the Apache License, Version 9.", set()),
        9: ("the software is provided with all the rights to use of the software, subject to the conditions", set()),
        10: (by["mit"][: len(by["mit"]) // 2], set()),
        11: ("mit " + (by["zlib"] + " ") * 300, {"zlib"}),
    }
    frame = spark.createDataFrame([(k, t) for k, (t, _) in cases.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.find_licenses(frame).collect()}
    for k, (_, labels) in cases.items():
        assert {s.label for s in got[k].spans} == labels, k
    assert [(s.start, s.share) for s in got[1].spans] == [(3, 1.0)]
    assert len(got[11].spans) == 300
    assert 0.4 < got[10].score < 0.6 and got[8].score == 1.0 and got[9].score < 0.2


def test_chains_cover_most_words():
    draw = np.random.default_rng(8)
    m = licenses.Match
    assert licenses.chains([m(0, 5, 0, 5), m(7, 12, 5, 10), m(50, 55, 10, 15)]) == [(0, 12, 10), (50, 55, 5)]
    assert licenses.chains([m(0, 6, 0, 6), m(4, 10, 4, 10)]) == [(0, 10, 10)]
    for _ in range(60):
        given = [m(int(a), int(a) + 4, int(b), int(b) + 4) for a, b in draw.integers(0, 30, (6, 2))]
        best = 0
        for mask in range(1, 64):
            part = sorted(x for i, x in enumerate(given) if mask >> i & 1)
            fits = all(a.start < b.start and a.at < b.at and b.start - a.end <= licenses.MOST_GAP for a, b in zip(part, part[1:], strict=False))
            if fits:
                best = max(best, 4 * len(part) - sum(max(0, a.end - b.start, a.to - b.at) for a, b in zip(part, part[1:], strict=False)))
        assert max(c[2] for c in licenses.chains(given)) == best


def test_query_columns(spark, sf):
    found = queries.queries()["op13_licenses"](spark, sf).collect()
    assert {r.base_labels for r in found} > {""}
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} for r in found)
    assert all((r.first_word is None) == (r.n_base == 0) and 0 <= r.score <= 1 for r in found)
    plain = [r for r in queries.queries()["op11_periodic_runs"](spark, sf).collect() if r.n_runs == 0]
    assert plain and all(r.start is r.period is r.exponent_milli is None for r in plain)
    assert plain[0].runs_sha256 == hashlib.sha256(b"").hexdigest()
