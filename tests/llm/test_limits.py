"""Limits of the quality rules, repeats in the mix, columns of any name, and letters."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleaner.llm import language, leaks, mixing, repetition, simhash
from gleaner.llm.common import free_names


def words(n, tag):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_each_quality_limit_decides_alone(spark):
    lines = [words(9, f"l{k}x") for k in range(4)]
    cases = {
        "plain": words(200, "w"),
        "few repeats": words(180, "w") + " " + " ".join([lines[0]] * 2),
        "covered": words(128, "w") + " " + " ".join(x for x in lines for _ in "12"),  # 72 of 200 words, none of the repeats long
        "at the limit": words(120, "w") + " " + " ".join([words(15, "r")] * 2) + " " + words(50, "v"),
        "stutter": words(83, "w") + " " + " ".join(["a"] * 17),  # 17 of 100 words, a repeat of 16
        "short": words(49, "w"),
        "base": " ".join([words(30, "w")] * 4),
    }
    frame = spark.createDataFrame(list(cases.items()), "doc_id string, text string")
    got = {r.doc_id: r for r in repetition.quality_rules(frame).collect()}
    assert {k for k, r in got.items() if r.base_failed} == {"short", "base"}
    assert {k for k, r in got.items() if r.kept} == {"plain", "few repeats", "at the limit"}
    covered, stutter = got["covered"], got["stutter"]
    assert covered.n_covered == 72 and covered.longest_repeat <= 0.15 * covered.n_words
    assert stutter.longest_repeat == 16 and stutter.n_covered <= 0.3 * stutter.n_words
    loose = {r.doc_id for r in repetition.quality_rules(frame, max_covered=0.5, max_longest=0.5).filter("kept").collect()}
    assert loose == {"plain", "few repeats", "at the limit", "covered", "stutter"}


def test_quality_counts_of_odd_rows(spark):
    draw = random.Random(2)
    texts = [None, "", " \n ", "a", "x " * 60, *(" ".join(draw.choices("abcde", k=draw.randrange(50, 90))) for _ in range(40))]
    frame = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id int, text string").withColumn("kept", F.lit("clash"))

    def want(text):
        w = (text or "").split()
        seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        thrice = {p for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for p in range(i, i + 3)}
        longest, at = 0, set()
        for i in range(len(w)):
            for j in range(i):
                n = 0
                while i + n < len(w) and w[i + n] == w[j + n]:
                    n += 1
                longest = max(longest, n)
                if n >= 8:
                    at |= set(range(i, i + n)) | set(range(j, j + n))
        failed = len(w) < 50 or 100 * len(thrice) > 50 * len(w)
        good = 10 * len(at) <= 3 * len(w) and 100 * longest <= 15 * len(w)
        return len(w), len(thrice), len(at), longest, failed, not failed and good

    names = "n_words n_repeat_words n_covered longest_repeat base_failed kept".split()
    got = sorted((r.doc_id, *(r[c] for c in names)) for r in repetition.quality_rules(frame).collect())
    assert got == sorted((i // 2, *want(t)) for i, t in enumerate(texts))


@pytest.mark.parametrize("chunk", [2_000, 7])
def test_repeated_rows_miss_no_target(spark, monkeypatch, chunk):
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    rows = [(1, "s", words(45, "r"))] * 300 + [(10 + i, "s", words(20 + i % 40, "w")) for i in range(300)] + [(900, "t", "a b")] * 2
    frame = spark.createDataFrame(rows, "doc_id int, source string, text string")
    found = mixing.mix(frame).collect()
    for s in "st":
        own = [r for r in found if r.source == s]
        taken, longest = sum(r.size * r.copies * r.repeats for r in own), max(r.size for r in own)
        assert abs(taken - own[0].target) <= 2 * longest
        assert sum(r.size * r.repeats for r in own) == own[0].source_size
    assert sum(r.repeats for r in found if r.doc_id == 1) == 300 and len([r for r in found if r.doc_id == 1]) <= 2
    assert all(0 <= r.copies <= 2 for r in found)
    mixed = Counter(r.doc_id for r in mixing.apply_mix(frame).collect())
    assert mixed == {k: n for k, n in Counter({r.doc_id: 0 for r in found}).items() if n} | {
        k: n for k in {r.doc_id for r in found} if (n := sum(r.copies * r.repeats for r in found if r.doc_id == k))
    }


CLASH = ["_key", "_key2", "key", "key2", "_unit", "unit", "unit2", "_copies", "copies", "base", "extra", "copy", "id", "n", "_id", "fp", "_source", "size"]


def test_columns_of_any_name_come_through(spark):
    rows = [(i, words(30, f"d{i % 9}x"), "en", f"s{i % 2}", *[f"{c}{i}" for c in CLASH]) for i in range(12)]
    rows += [(None, None, None, None, *[None] * len(CLASH)), (13, "", "en", "s0", *["v"] * len(CLASH))]
    schema = "doc_id int, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASH)
    frame = spark.createDataFrame(rows, schema)
    bench = spark.createDataFrame([(7, words(12, "d3x"))], "item_id int, text string")
    given = set(rows)
    kept = [tuple(r) for r in simhash.one_of_each(frame).collect()]
    assert set(kept) <= given and len(kept) == 9 + 1  # nine texts; null and empty are one group
    clean = [tuple(r) for r in leaks.remove_contaminated(frame, bench).collect()]
    assert Counter(clean) == Counter(r for r in rows if r[0] is None or r[0] == 13 or r[0] % 9 != 3)
    mixed = mixing.apply_mix(frame)
    assert mixed.columns == frame.columns and {tuple(r) for r in mixed.collect()} <= given
    for name, stage in corpus_pipeline.STAGES[1:4]:
        if name != "decontamination":
            assert stage(spark, frame, "").columns == frame.columns
            assert stage(spark, frame.limit(0), "").count() == 0
    assert leaks.remove_contaminated(frame.limit(0), bench).count() == 0
    assert leaks.remove_contaminated(frame, bench.limit(0)).count() == len(rows)


def test_rows_that_differ_in_other_columns_are_not_equal(spark):
    rows = [(1, "same text here", "en"), (1, "same text here", "fr"), (1, "same text here", "fr")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    assert simhash.one_of_each(frame).count() == 1
    assert {tuple(r) for r in simhash.one_of_each(frame).collect()} == {tuple(r) for r in simhash.one_of_each(frame).collect()}


def test_only_letters_are_letters(spark):
    english = [(i, "the river and the stone of the house", "en") for i in range(60)]
    german = [(100 + i, "der Fluss und das Haus und der Stein", "de") for i in range(60)]
    odd = [(1000, "½ ² ① ٣", None), (1001, "1 2 _ !", None), (1002, "", None), (1003, None, None), (1004, "ª river", None), (1005, "日本", None)]
    frame = spark.createDataFrame(english + german + odd, "doc_id int, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.language_id(frame).collect()}
    assert {k for k, (lang, _) in got.items() if lang == "und"} == {1000, 1001, 1002, 1003}
    assert all(got[k] == ("und", 0.0) for k in (1000, 1003)) and got[1005][0] in ("en", "de")
    assert sum(got[k][0] == lang for k, _, lang in english + german) == 120


def test_free_names():
    class Frame:
        columns = ["Key", "_key", "x"]

    assert free_names(Frame, "key", "key", "y", "X") == ["__key", "___key", "y", "_X"]
    assert re.match("_+key", free_names(Frame, "key")[0])
