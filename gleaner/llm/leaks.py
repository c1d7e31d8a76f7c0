"""Benchmark decontamination by winnowing."""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import Memo, free_names, per_text
from gleaner.session import written

SPAN = 10  # words of a shared span that must be found
GRAM = 5  # words of a fingerprint; the smallest of SPAN - GRAM + 1 neighbours is kept
#: Everything but letters, digits and non-ASCII bytes parts words; A-Z become a-z.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
FILTER_BITS = (1 << 16, 1 << 25)  # smallest and largest filter; beyond the largest it only lets more through


def _grams(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``size`` words from each position, and whether they lie in one document."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out, doc[:n] == doc[size - 1 :]


def winnow(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes and the positions kept: of every window of ``SPAN`` words the last smallest gram."""
    grams, whole = _grams(hashes, doc, GRAM)
    n = len(hashes) - SPAN + 1
    kept = np.zeros(len(grams), bool)
    if n > 0:
        value = np.where(whole, grams, np.uint64(0xFFFFFFFFFFFFFFFF))
        best, at = value[:n].copy(), np.arange(n)
        for j in range(1, SPAN - GRAM + 1):
            less = value[j : j + n] <= best
            best[less], at[less] = value[j : j + n][less], np.flatnonzero(less) + j
        kept[at[doc[:n] == doc[SPAN - 1 :]]] = True
    return grams, np.flatnonzero(kept)


def _hashes():
    import xxhash

    memo = Memo()

    def run(listed: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        memo.room()
        unknown = set(chain.from_iterable(listed)) - memo.keys()
        memo.update((w, xxhash.xxh64_intdigest(w)) for w in unknown)
        sizes = [len(w) for w in listed]
        values = np.fromiter(map(memo.__getitem__, chain.from_iterable(listed)), np.uint64, sum(sizes))
        return values, np.repeat(np.arange(len(listed)), sizes)

    return run


def _key(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()


def _item_rows():
    hashed = _hashes()

    def run(texts: list[bytes]) -> list:
        listed = [t.translate(WORD_BYTES).split() for t in texts]
        values, doc = hashed(listed)
        grams, kept = winnow(values, doc)
        per: list[list[int]] = [[] for _ in texts]
        for p in kept.tolist():
            per[doc[p]].append(int(grams[p].astype(np.int64)))
        windows, sizes = [], []
        first = np.concatenate(([0], np.cumsum([len(w) for w in listed])))
        for k, words in enumerate(listed):
            size = min(SPAN, len(words))
            sizes.append(size)
            windows.append([_key(words[i : i + size]) for i in range(len(words) - size + 1)] if size else [])
            if 0 < size < SPAN:
                whole, _ = _grams(values[first[k] : first[k + 1]], doc[first[k] : first[k + 1]], size)
                per[k] = whole.view(np.int64).tolist()
        return [sizes, windows, per]

    return run


ITEM_FIELDS = [
    ("size", T.IntegerType(), pa.int32()),
    ("windows", T.ArrayType(T.BinaryType()), pa.list_(pa.binary())),
    ("grams", T.ArrayType(T.LongType()), pa.list_(pa.int64())),
]


def _filter_bits(items: DataFrame) -> tuple[np.ndarray, list[int]]:
    """A bit filter of all fingerprints of the items, at most 4 MB, and the sizes of windows shorter than ``SPAN``."""
    seen = items.agg(F.sum(F.size("grams")).alias("n"), F.collect_set("size").alias("sizes")).first()  # sizes: 0 to SPAN
    bits = FILTER_BITS[0]
    while bits < min(16 * (seen["n"] or 0), FILTER_BITS[1]):
        bits *= 2
    spots = F.array(*(F.shiftrightunsigned("g", s).bitwiseAND(F.lit(bits - 1)) for s in (0, 20, 39)))
    rows = items.select(F.explode("grams").alias("g")).select(F.explode(spots).alias("p"))
    one = F.expr("shiftleft(1L, cast(p & 63 as int))")
    words = rows.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(one).alias("b")).collect()  # at most bits / 64 rows
    held = np.zeros(bits // 64, np.int64)
    for r in words:
        held[r["w"]] = r["b"]
    return np.unpackbits(held.view(np.uint8), bitorder="little").view(bool), sorted(s for s in seen["sizes"] if 0 < s < SPAN)


def _doc_rows(packed: bytes, short: list[int]):
    def start():
        held = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").view(bool)
        mask = np.uint64(len(held) - 1)
        hashed = _hashes()
        likely = lambda g: held[g & mask] & held[g >> np.uint64(20) & mask] & held[g >> np.uint64(39) & mask]

        def run(texts: list[bytes]) -> list:
            listed = [t.translate(WORD_BYTES).split() for t in texts]
            values, doc = hashed(listed)
            first = np.concatenate(([0], np.cumsum([len(w) for w in listed]))).astype(np.int64)
            grams, kept = winnow(values, doc)
            kept = kept[likely(grams[kept])]
            starts = np.unique((kept[:, None] - np.arange(SPAN - GRAM + 1)).ravel())  # windows that hold a likely gram
            starts = starts[(starts >= 0) & (starts + SPAN <= len(doc))]
            starts = starts[doc[starts] == doc[starts + SPAN - 1]] if len(starts) else starts
            spots = [(SPAN, starts)]
            for size in short:
                whole, inside = _grams(values, doc, size)
                spots.append((size, np.flatnonzero(inside & likely(whole)) if len(whole) else np.zeros(0, np.int64)))
            spans: list[list[dict]] = [[] for _ in texts]
            for size, at in spots:
                for p in at.tolist():
                    k = int(doc[p])
                    i = p - int(first[k])
                    spans[k].append({"start": i, "size": size, "key": _key(listed[k][i : i + size])})
            return [[len(w) for w in listed], spans]

        return run

    return start


DOC_FIELDS = [
    ("n_words", T.LongType(), pa.int64()),
    (
        "_spans",
        T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("size", T.LongType()), T.StructField("key", T.BinaryType())])),
        pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64()), ("key", pa.binary())])),
    ),
]


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Per row of ``docs``: the id (or the ``keep`` columns), ``n_words``, ``n_hit`` (words inside a window of some item),
    ``items`` (sorted ids of these items as strings), ``spans`` (first word and length of every window found).

    Documents and items keep the smallest 5-word hash of each 10-word window, so any shared window shares a fingerprint.
    Documents test theirs against a filter of the items' fingerprints, and each likely one is extended to the windows
    around it, which join the items' windows by SHA-256. Items of fewer than 10 words are one window, looked up by the
    hash of all their words. Null texts have no words; items without words hit nothing; null item ids count as hits
    without a name. Repeated rows keep their rows. One pass over the texts, none of them shuffled.
    """
    keep = keep or [id_col]
    rows = benchmark.select(F.col(item_col).cast("string").alias("_item"), F.col(item_text_col).alias("_t"))
    items = written(per_text(rows, "_t", ["_item"], ITEM_FIELDS, _item_rows), "items")
    held, short = _filter_bits(items)
    packed = np.packbits(held, bitorder="little").tobytes()
    found = written(
        per_text(docs, text_col, keep, DOC_FIELDS, _doc_rows(packed, short)).withColumn("_row", F.monotonically_increasing_id()),
        "windows",
    )
    windows = items.select("_item", F.explode("windows").alias("key")).distinct()
    spans = found.select("_row", F.explode("_spans").alias("_s")).select("_row", "_s.start", "_s.size", "_s.key")
    hits = spans.join(windows, "key").groupBy("_row").agg(
        F.collect_set(F.struct("start", "size")).alias("_hits"), F.collect_set("_item").alias("_items")
    )
    return found.join(hits, "_row", "left").select(
        *keep, "n_words", union_size(F.coalesce("_hits", F.expr("cast(array() as array<struct<start:bigint,size:bigint>>)"))).alias("n_hit"),
        F.coalesce(F.array_sort("_items"), F.expr("cast(array() as array<string>)")).alias("items"),
        F.array_sort("_hits").alias("spans"),
    )


def union_size(spans):
    """Words covered by the union of spans (start, size)."""
    ordered = F.array_sort(spans)
    zero = F.expr("named_struct('n', 0L, 'end', 0L)")
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(s["start"] + s["size"] - F.greatest(acc["end"], s["start"]), F.lit(0).cast("long"))).alias("n"),
        F.greatest(acc["end"], s["start"] + s["size"]).alias("end"),
    )
    return F.aggregate(ordered, zero, step, lambda acc: acc["n"])


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any window of an item; all columns as they were, of whatever names.

    Rows are told apart by two independent hashes of id and text. Null texts stay; an empty table or benchmark changes nothing.
    """
    one, two = free_names(docs, "key", "key2")
    columns = [F.col(id_col), F.col(text_col)]
    keyed = docs.withColumns({one: F.xxhash64(*columns), two: F.xxhash64(F.lit(7), *columns[::-1])})
    hit = decontaminate(keyed, benchmark, id_col, text_col, keep=[one, two]).filter("n_hit > 0").select(one, two).distinct()
    return keyed.join(hit, [one, two], "left_anti").select(*docs.columns)
