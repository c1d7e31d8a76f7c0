"""Periodic runs: stretches of words that repeat with a fixed lag, by the sparse diagonals of a text against itself."""

from __future__ import annotations

from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import per_text

LEAST_WORDS = 6
LEAST_PERIODS = 4


def active_lags(names: np.ndarray, doc: np.ndarray):
    """Cells of the sparse diagonals, scale by scale: ``size`` and the active lag of every word (0: none).

    A word could extend the diagonal of each of its earlier occurrences, which is quadratic where a word is frequent. A run
    of period q has at least four periods, so its words stand q words after the same words with their next ``size`` - 1,
    ``size`` being the power of two from q up; and as q is the smallest period, they stand nowhere nearer. So of all lags in
    (size / 2, size] only that of the nearest earlier occurrence of word and followers can belong to a run, and a text of n
    words has at most n log n cells, also where it is one word over and over.
    """
    n, size = len(names), 1
    at = np.arange(n)
    key = doc.astype(np.int64) * (int(names.max()) + 1 if n else 1) + names
    name = np.full(n, -1, np.int64)
    while len(at):
        order = np.argsort(key, kind="stable")
        sorted_key, places = key[order], at[order]
        again = np.concatenate(([False], sorted_key[1:] == sorted_key[:-1]))
        gap = places[1:] - places[:-1]
        lag = np.zeros(n, np.int64)
        near = again[1:] & (gap <= size) & (2 * gap > size)
        lag[places[1:][near]] = gap[near]
        yield size, lag
        repeated = again | np.append(again[1:], False)  # only what a text holds twice can grow
        name[:] = -1
        name[places[repeated]] = np.cumsum(~again)[repeated]
        at = np.sort(places[repeated])
        at = at[at + size < n]
        at = at[(name[at + size] >= 0) & (doc[at] == doc[at + size])]
        key = name[at] * (n + 1) + name[at + size]
        size *= 2


def find_runs(names: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Rows ``start, length, period`` of all runs, by start, then period; starts count words of all texts together.

    While a word keeps the active lag of the word before it, the diagonal grows by a word; where it does not, the diagonal
    ends, and is a run if it has ``LEAST_WORDS`` words and ``LEAST_PERIODS`` periods.
    """
    found = []
    for size, lag in active_lags(names, doc):
        at = np.flatnonzero(lag)
        if not len(at):
            continue
        ends = np.append((np.diff(at) != 1) | (np.diff(lag[at]) != 0), True)
        first = at[np.concatenate(([True], ends[:-1]))]
        last, period = at[ends], lag[at[ends]]
        length = last + size - first + period
        long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        found.append(np.stack([first - period, length, period], axis=1)[long])
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _measure(texts: list[bytes]) -> list:
    words = [t.split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    ids: dict[bytes, int] = {}
    names = np.array([ids.setdefault(x, len(ids)) for x in chain.from_iterable(words)], np.int64)
    rows = find_runs(names, doc)
    change = np.zeros(len(names) + 1, np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 0] + rows[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    first = np.cumsum(sizes) - sizes
    runs: list[list[dict]] = [[] for _ in texts]
    for start, length, period in rows.tolist():
        k = int(doc[start])
        runs[k].append({"start": start - int(first[k]), "length": length, "period": period})
    collapsed = []
    for k, listed in enumerate(words):
        flags = kept[first[k] : first[k] + sizes[k]]
        collapsed.append(b" ".join(listed if flags.all() else compress(listed, flags)))
    return [sizes, runs, pa.array(collapsed, pa.binary()).cast(pa.string())]


_RUN = ("start", "length", "period")
FIELDS = [
    ("n_words", T.LongType(), pa.int64()),
    ("runs", T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in _RUN])), pa.list_(pa.struct([(x, pa.int64()) for x in _RUN]))),
    ("collapsed", T.StringType(), pa.string()),
]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: the id (or the ``keep`` columns), ``n_words``, ``runs`` and ``collapsed``.

    Words are runs of anything but ASCII white space, numbered from 0. A run is a longest stretch of words that equal those
    ``period`` words before them, of at least 6 words and 4 periods, ``period`` being its smallest; ``runs`` lists all of
    them by start, then period, overlapping ones included. ``collapsed`` is the text without the words that some run holds
    after its first period, joined by single spaces. Null and empty texts have no words, no runs and an empty ``collapsed``;
    repeated rows and ids each get their row, null ids stay null, an empty table gives no rows, and only the named columns
    are read. Nothing is shuffled; a task holds the arrays of one slice of texts, or of one long text.
    """
    return per_text(docs, text_col, keep or [id_col], FIELDS, lambda: _measure)


def strongest(runs: Column | str) -> Column:
    """The run with the greatest exact length / period; of equal ones the first listed (null without runs)."""
    run = F.col(runs) if isinstance(runs, str) else runs
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    better = lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r
    ).otherwise(best)
    return F.reduce(run, none, better)


def looped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a loop in the text of every tenth row, dealt by the crc32 of the id as text (null ids: none).

    With h the crc32 and g = floor(h / 10), where h % 10 = 0 and the text has n > 0 words, word i from a = g % n on becomes
    word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)). Other texts stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(r"([^\x20\x09-\x0D]+)"))

    def rebuilt(x: Column) -> Column:
        n, g = F.size(x["w"]).cast("long"), x["g"]
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        bound = F.struct(x["w"].alias("w"), a.alias("a"), p.alias("p"), n.alias("n"))
        return F.transform(F.array(bound), lambda b: F.array_join(F.transform(
            F.sequence(F.lit(0).cast("long"), b["n"] - 1),
            lambda i: b["w"][F.when(i < b["a"], i).otherwise(b["a"] + (i - b["a"]) % b["p"]).cast("int")]), " "))[0]

    held = F.struct(words.alias("w"), g.alias("g"))
    text = F.transform(F.array(held), lambda x: F.when(F.size(x["w"]) > 0, rebuilt(x)))[0]  # words are cut once a row
    return docs.withColumn(text_col, F.when((h % 10 == 0) & F.col(text_col).isNotNull(), F.coalesce(text, F.col(text_col).cast("string"))).otherwise(F.col(text_col)))
