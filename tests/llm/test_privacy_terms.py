"""Terms that disclose personal data against brute force, and spans of very long texts."""

import math
import random
import time
from collections import defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from gleaner.llm import privacy
from gleaner.llm import spans as S


def brute(rows, disclosure=0.8, removal=0.95, support=3):
    """Marked places of every row, by the definition: rows holding term and entity, one pair at a time."""
    email = regex.compile(privacy.EMAIL.replace("++", "+").replace(r"(?:(?<![A-Za-z0-9._%+-])|\G)", r"(?<![A-Za-z0-9._%+-])"))
    seen, terms = [], []
    for _, text in rows:
        spans = [m.span() for m in email.finditer(text or "")]
        seen.append({"email:" + (text or "")[a:b].lower() for a, b in spans})
        places = [m.span() for m in regex.finditer(privacy.TERM, text or "")]
        terms.append([(a, z) for a, z in places if all(z <= s or e <= a for s, e in spans)])
    words = [{(rows[i][1] or "")[a:z].lower() for a, z in t} for i, t in enumerate(terms)]
    with_entity, with_term, both = defaultdict(int), defaultdict(int), defaultdict(int)
    for i in range(len(rows)):
        for e in seen[i]:
            with_entity[e] += 1
            for w in words[i]:
                both[e, w] += 1
        for w in words[i]:
            with_term[w] += 1
    mark = {}
    for (e, w), n in both.items():
        ratio = 1 + math.log(n / with_term[w]) / -math.log(with_entity[e] / (len(rows) + 1))
        if n >= support and ratio >= disclosure:
            mark[w] = min(mark.get(w, "[TERM]"), "" if ratio >= removal else "[TERM]")
    return sorted(
        (str(rows[i][0]), [(a, z, mark[w]) for a, z in t if (w := rows[i][1][a:z].lower()) in mark]) for i, t in enumerate(terms)
    )


def corpus(seed):
    """People with an address and words of their own, some shared; a list of many; copies; texts without any."""
    draw = random.Random(seed)
    plain = ["river", "stone", "O'Neil", "well-known", "über", "and", "the"]
    rows = []
    for person in range(12):
        own = [f"Name{'abcdefghijkl'[person]}", f"Town{'abcdefghijkl'[person % 6]}"]
        for _ in range(draw.randrange(1, 7)):
            body = draw.choices(plain, k=5) + draw.sample(own, draw.randrange(1, 3))
            if draw.random() < 0.8:
                body.append(draw.choice(["", "<", "'", "é'"]) + f"p{person}@mail.org" + draw.choice(["", ">", ".", "'s"]))
            draw.shuffle(body)
            rows.append((len(rows), " ".join(body)))
    page = " ".join(f"Name{'abcdefghijkl'[p]} p{p}@mail.org" for p in range(12)) + " " + " ".join(f"q{i}@list.net" for i in range(30))
    rows += [(900 + i, page + " Directory") for i in range(3)] + [(950, rows[0][1]), (950, rows[0][1]), (951, None), (952, ""), (None, rows[3][1])]
    rows += [(960 + i, " ".join(draw.choices(plain, k=8))) for i in range(60)] + [(1100, "Namea alone in Towna")]
    return rows


@pytest.mark.parametrize(("seed", "bits"), [(1, 1 << 20), (2, 64), (3, 1 << 20)])
def test_terms_match_brute_force(spark, monkeypatch, seed, bits):
    monkeypatch.setattr(privacy, "FILTER_BITS", bits)  # a full filter only lets more through
    rows = corpus(seed)
    got = privacy.find_personal(spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit("clash")))
    found = sorted((str(r.doc_id), [(t.start, t.end, t.mark) for t in r.terms]) for r in got.collect())
    assert found == brute(rows)
    assert sum(len(t) for _, t in found) > 20


def test_places_outside_spans_match_brute_force(spark):
    draw, rows = random.Random(4), []
    for k in range(300):
        cuts = sorted(draw.sample(range(60), 2 * draw.randrange(0, 8)))
        places = [(a, z, f"t{a}") for a, z in zip(cuts[::2], cuts[1::2], strict=True)]
        spans = [(a, a + draw.randrange(1, 9)) for a in (draw.randrange(60) for _ in range(draw.randrange(0, 5)))]
        rows.append((k, places, spans))
    kind = "k int, places array<struct<start:bigint,end:bigint,value:string>>, spans array<struct<start:bigint,end:bigint>>"
    frame = spark.createDataFrame(rows, kind).select("k", S.outside(F.col("places"), F.col("spans")).alias("o"))
    got = {r.k: [tuple(x) for x in r.o] for r in frame.collect()}
    assert got == {k: [p for p in places if all(p[1] <= a or z <= p[0] for a, z in spans)] for k, places, spans in rows}


def test_time_is_linear_in_the_addresses_of_a_text(spark):
    taken = {}
    for n in (500, 4_000, 32_000):
        text = " ".join(f"user{i}@mail.org word" for i in range(n))
        frame = spark.createDataFrame([(1, text)] * 3, "doc_id long, text string")
        start = time.perf_counter()
        row = privacy.find_personal(frame).first()
        taken[n] = time.perf_counter() - start
        assert len(row.email) == n and row.email[-1].end == len(text) - 5
    assert taken[32_000] < 8 * taken[4_000] + 20  # eight times the addresses; a square would be 64 times


def test_entities_of_the_same_rows_are_one_class(spark):
    held = [(r, f"e{e}", 3) for e in range(200) for r in (1, 2, 3)] + [(r, "other", 3) for r in (1, 2, 4)]
    frame = spark.createDataFrame(held, "_row long, entity string, with_entity long")
    got = sorted(tuple(r) for r in privacy._classes(frame).select("_row", "class").collect())
    assert got == [(1, "e0"), (1, "other"), (2, "e0"), (2, "other"), (3, "e0"), (4, "other")]
