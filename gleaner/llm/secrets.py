"""Secrets: patterns, and random strings by the log-likelihood ratio of two character Markov models. SQL functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm import spans as S
from gleaner.llm.common import first_by_hash
from gleaner.session import written

KINDS = ("assign", "access", "hex")
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9+/_.=-]++"
KEY_PART = r"^[A-Za-z_]+[\"']?\x20*[:=]\x20*[\"']?"
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789+/_=-"  # of the models; case is folded


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each kind, failing matches dropped. Texts must not be null."""
    value = lambda s: F.regexp_replace(s["value"], KEY_PART, "")
    sign = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    return {
        "assign": F.filter(S.when(sign, S.found(text, ASSIGN)), lambda s: F.length(value(s)) >= 6),
        "access": F.filter(S.when(F.contains(text, F.lit("AKIA")), S.found(text, ACCESS)), lambda s: F.length(s["value"]) >= 20),
        "hex": S.when(F.rlike(text, F.lit("[0-9a-f]{24}")), S.found(text, HEX)),
    }


def _pairs(words: DataFrame) -> DataFrame:
    """Counts of neighbouring characters of the model's letters in ``w``."""
    chars = words.filter(F.length("w") >= 2).select(F.split("w", "").alias("c"))
    steps = F.arrays_zip(F.expr("slice(c, 1, size(c) - 1)").alias("a"), F.expr("slice(c, 2, size(c) - 1)").alias("b"))
    pairs = chars.select(F.explode(F.transform(steps, lambda s: F.concat(s["a"], s["b"]))).alias("p"))
    return pairs.groupBy("p").agg(F.count("*").alias("n"))


def fit(
    rows: DataFrame, docs: DataFrame, id_col: str, text_col: str, sample_docs: int = 500, sample_secrets: int = 5_000
) -> list[float]:
    """Log-likelihood ratio, random over ordinary, of every pair of letters, from labelled samples.

    Random: up to ``sample_secrets`` values the patterns found, ordinary: the words of ``sample_docs`` documents, both the
    first by a hash. Add-one counts keep both models defined; without any sample of a class it is uniform.
    """
    tail = F.regexp_replace("s.value", KEY_PART, "")
    known = rows.select(F.explode(F.concat(*KINDS)).alias("s")).select(F.lower(tail).alias("w")).distinct()
    known = first_by_hash(known, sample_secrets, "w")
    ids = first_by_hash(docs.select(F.col(id_col).alias("_id")).filter("_id is not null").distinct(), sample_docs, "_id")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t")).join(F.broadcast(ids), "_id", "left_semi")  # sample_docs ids
    words = texts.select(F.explode(F.regexp_extract_all(F.lower("_t"), F.lit("(?<![a-z0-9+/_=-])[a-z_-]{4,}+(?![a-z0-9+/_=-])"), F.lit(0))).alias("w"))
    models = []
    for sample in (known, words):
        counts = {r["p"]: r["n"] for r in _pairs(sample).collect() if len(r["p"]) == 2}  # pairs of letters
        model = []
        for a in LETTERS:
            total = sum(counts.get(a + b, 0) for b in LETTERS) + len(LETTERS)
            model += [math.log((counts.get(a + b, 0) + 1) / total) for b in LETTERS]
        models.append(model)
    return [x - y for x, y in zip(*models, strict=True)]


def ratio(value, table: list[float]) -> Column:
    """Mean log-likelihood ratio of the steps of a string of the models' letters."""
    held = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    places = F.transform(F.split(F.lower(value), ""), lambda c: F.instr(F.lit(LETTERS), c) - 1)
    start = F.expr("named_struct('last', -1, 'sum', 0.0D)")

    def step(acc, place):
        gain = F.when(acc["last"] < 0, F.lit(0.0)).otherwise(F.get(held, acc["last"] * len(LETTERS) + place))
        return F.struct(place.alias("last"), (acc["sum"] + gain).alias("sum"))

    return F.aggregate(places, start, step, lambda acc: acc["sum"]) / (F.length(value) - 1)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Per row: id, spans of each kind (``assign access hex``) and ``random``: strings of 20 characters and more, outside the
    others, whose mean log-likelihood ratio is ``least`` or more.

    Null texts are empty and have no spans; repeated rows each keep theirs. One pass over the texts writes spans and
    candidates, a bounded sample trains the models, and the candidates are scored where they lie.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("_id"), text.alias("_t"))
    t = F.col("_t")
    candidates = S.when(F.rlike(t, F.lit("[A-Za-z0-9+/_=-]{20}")), S.found(t, CANDIDATE))
    rows = written(source.select("_id", *(x.alias(k) for k, x in base_spans(t).items()), candidates.alias("_c")), "secrets")
    table = fit(rows, docs, id_col, text_col)
    base = F.concat(*KINDS)
    free = lambda c: ~F.exists(base, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]))
    random = F.filter("_c", lambda c: free(c) & (ratio(c["value"], table) >= least))
    return rows.select(F.col("_id").alias(id_col), *KINDS, random.alias("random"))


def redacted(text: Column) -> Column:
    """The text of a row of ``find_secrets`` (joined back by the caller) with every secret as ``[SECRET]``."""
    every = F.concat(*KINDS, F.col("random"))
    marks = F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("[SECRET]").alias("mark")))
    return S.replaced(F.coalesce(text, F.lit("")), marks)
