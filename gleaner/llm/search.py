"""Ranked lexical search: impact lists of bounded blocks of documents, read by best positions."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import BATCH_BYTES, per_text
from gleaner.llm.leaks import WORD_BYTES
from gleaner.session import written

TOP = 50
PASS_TERMS = 200_000  # terms of items, with repeats, that one pass over the documents looks for
BLOCK_POSTINGS = 2_000_000  # postings whose impact lists stand in a task at a time
FIRST_DEPTH = 16  # positions read from each list at first; doubled until the search stops
MERGE_PARTS = 256  # groups of tasks whose best documents of an item meet before all of them do


def _item_terms(texts: list[bytes]) -> list:
    return [[sorted(set(t.translate(WORD_BYTES).split())) for t in texts]]


def _postings(ids: dict[bytes, int]):
    def run(texts: list[bytes]) -> list:
        sizes, terms, counts = [], [], []
        for text in texts:
            words = text.translate(WORD_BYTES).split()
            seen: dict[int, int] = {}
            for i in map(ids.get, words):
                if i is not None:
                    seen[i] = seen.get(i, 0) + 1
            sizes.append(len(words))
            terms.append(list(seen))
            counts.append(list(seen.values()))
        return [sizes, terms, counts]

    return run


POSTINGS = [
    ("n", T.LongType(), pa.int64()),
    ("terms", T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    ("counts", T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
]


class Block:
    """Impact lists of a block of documents: by term the postings in falling impact, and by document all its postings."""

    def __init__(self, weights: np.ndarray, n: np.ndarray, term: np.ndarray, count: np.ndarray, doc: np.ndarray, docs: int, words: int):
        m = np.array([50 + 50 * x * docs // max(words, 1) for x in n.tolist()], np.int64)  # the product may pass 64 bits
        self.impact = weights[term] * ((1_000_000_000 * count) // (1000 * count + 20 * m[doc]))
        order = np.lexsort((doc, -self.impact, term))
        self.doc, self.term = doc, term
        self.listed = order  # posting at each place of the concatenated lists
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.list_start = np.searchsorted(term[order], np.arange(len(weights) + 1))
        self.doc_start = np.searchsorted(doc, np.arange(len(n) + 1))

    def best(self, item: np.ndarray, in_item: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents read for an item with their scores, among them all that could be of its ``k`` best, and the reads.

        Places of the item's lists are read side by side. A document met for the first time is accessed directly: all its
        postings of the item add up to its score, and their places count as seen. The best position of a list is the last
        place with nothing unseen before it; a document not met yet has at most the impact there (a list seen to its end
        has nothing for it). The search stops when these bounds add up to less than the ``k``-th best score found, or than
        ``floor``, the ``k``-th best of earlier blocks: strictly, as an equal score can still win by its id.
        """
        start = self.list_start[item]
        size = self.list_start[item + 1] - start
        have = size > 0
        start, size = start[have], size[have]
        best = np.zeros(len(start), np.int64)  # places seen from the top, without a gap
        seen = [np.zeros(x, bool) for x in size.tolist()]
        slot = np.full(len(self.list_start), -1, np.int64)
        slot[item[have]] = np.arange(len(start))
        met = np.zeros(len(self.doc_start) - 1, bool)
        docs, scores, depth, step, reads = [], [], 0, FIRST_DEPTH, 0
        kth = floor
        while (depth < size).any():
            spots = [self.listed[s + depth : s + min(depth + step, x)] for s, x in zip(start.tolist(), size.tolist(), strict=True) if depth < x]
            new = np.unique(self.doc[np.concatenate(spots)])
            new = new[~met[new]]
            depth, step = depth + step, step * 2
            if len(new):
                met[new] = True
                spans = self.doc_start[new + 1] - self.doc_start[new]
                posting = np.repeat(self.doc_start[new] - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
                owner = np.repeat(np.arange(len(new)), spans)
                mine = in_item[self.term[posting]]
                posting, owner = posting[mine], owner[mine]
                sums = np.zeros(len(new), np.int64)
                np.add.at(sums, owner, self.impact[posting])
                docs.append(new)
                scores.append(sums)
                reads += len(posting)
                which = slot[self.term[posting]]
                order = np.argsort(which, kind="stable")
                which, spot = which[order], self.place[posting][order]
                cuts = np.searchsorted(which, np.arange(len(start) + 1))
                for i in np.flatnonzero(np.diff(cuts)).tolist():
                    seen[i][spot[cuts[i] : cuts[i + 1]] - start[i]] = True
                    ahead = seen[i][best[i] :]
                    gap = int(ahead.argmin()) if len(ahead) else 0
                    best[i] += len(ahead) if len(ahead) and ahead[gap] else gap
                have_k = np.concatenate(scores)
                if len(have_k) >= k:
                    kth = max(kth, int(np.partition(have_k, len(have_k) - k)[len(have_k) - k]))
            last = start + np.maximum(best - 1, 0)
            bound = int(np.where(best < size, self.impact[self.listed[np.minimum(last, len(self.listed) - 1)]], 0).sum())
            if bound < kth:
                break
        none = np.zeros(0, np.int64)
        return (np.concatenate(docs), np.concatenate(scores), reads) if docs else (none, none, reads)


def _ranks(ids: pa.Array) -> np.ndarray:
    """Place of each id in ascending order, nulls last."""
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank


def _search(items: list[tuple[int, np.ndarray]], weights: np.ndarray, docs: int, words: int, k: int, id_name: str):
    """Function of a task's batches: for every item the ``k`` best of the task's documents, or a few more where it has blocks."""

    def blocks(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column(2).flatten())
            if size >= BLOCK_POSTINGS:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
        if size:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches):
        floors = np.ones(len(items), np.int64)  # scores above 0
        kept: list[np.ndarray] = [np.zeros(0, np.int64) for _ in items]
        for rows in blocks(batches):
            ids, terms, counts = rows.column(0).chunk(0), rows.column(2).chunk(0), rows.column(3).chunk(0)
            sizes = pc.list_value_length(terms).to_numpy()
            block = Block(
                weights, rows.column(1).to_numpy(), terms.flatten().to_numpy().astype(np.int64),
                counts.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(sizes)), sizes), docs, words,
            )
            rank = _ranks(ids)
            in_item = np.zeros(len(weights), bool)
            for x, (item, listed) in enumerate(items):
                in_item[listed] = True
                found, scores, _ = block.best(listed, in_item, k, int(floors[x]))
                in_item[listed] = False
                good = scores >= floors[x]
                found, scores = found[good], scores[good]
                first = np.lexsort((rank[found], -scores))[:k]
                found, scores = found[first], scores[first]
                kept[x] = np.sort(np.concatenate([kept[x], scores]))[-k:]
                if len(kept[x]) == k:
                    floors[x] = max(floors[x], kept[x][0])
                if len(found):
                    columns = [pa.array(np.full(len(found), item), pa.int64()), ids.take(pa.array(found)), pa.array(scores, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["_item", id_name, "score"])

    return run


def _best(rows: DataFrame, group: list[str], id_col: str, k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last(id_col))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = TOP,
) -> DataFrame:
    """The ``k`` documents that score highest for each item: ``item_col``, ``rank`` (from 1), ``id_col``, ``score`` (above 0).

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. N counts the documents with a term, L
    all terms, n a document's, df the documents holding a term, tf its occurrences in a document. With
    w = floor(1000 ln((2N + 2) / (2df + 1))) and m = 50 + (50 n N) div L a document scores the sum of
    w ((10^9 tf) div (1000 tf + 20 m)) over the item's terms, once each. Equal scores rank by ascending id, nulls last.

    One pass over the texts writes the postings of the items' terms (items with over ``PASS_TERMS`` terms in sum are dealt to
    several passes). Every task then searches its documents in blocks of about ``BLOCK_POSTINGS`` postings with the best
    position algorithm (``Block.best``), and ``k`` rows per item, task and block are merged. No list of a term crosses tasks, so
    a term that all documents hold is as long as its block at most.

    Every row of ``items`` is an item of its own, every row of ``docs`` a document of its own: repeated rows are ranked one
    by one. Null and empty texts have no terms and match nothing; empty tables give no rows; a text of any length is one
    posting list of distinct terms; other columns are not read.
    """
    named = items.select(F.col(item_col).alias("_name"), F.col(item_text_col).alias("_t"))
    asked = written(
        per_text(named, "_t", ["_name"], [("terms", T.ArrayType(T.BinaryType()), pa.list_(pa.binary()))], lambda: _item_terms)
        .withColumn("_item", F.monotonically_increasing_id()),
        "items",
    )
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    passes = -(-total // PASS_TERMS) or 1
    parts = [_one_pass(docs, asked.filter(F.pmod(F.xxhash64("_item"), F.lit(passes)) == p), id_col, text_col, k) for p in range(passes)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    near = found.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)))
    top = _best(_best(near, ["_item", "_part"], id_col, k).drop("_part"), ["_item"], id_col, k)
    return top.join(asked.select("_item", "_name"), "_item").select(
        F.col("_name").alias(item_col), F.col("rank").cast("int").alias("rank"), id_col, "score"
    )


def _one_pass(docs: DataFrame, asked: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    spark = docs.sparkSession
    listed = [(r["_item"], [bytes(t) for t in r["terms"]]) for r in asked.select("_item", "terms").collect()]  # about PASS_TERMS terms
    ids = {term: i for i, term in enumerate(sorted(set(chain.from_iterable(terms for _, terms in listed))))}
    postings = written(per_text(docs, text_col, [id_col], POSTINGS, lambda: _postings(ids)), "postings")
    size = postings.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("words")).first()
    n_docs, n_words = size["docs"], size["words"] or 0
    held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    ratio = (F.lit(2 * n_docs + 2).cast("double")) / (2 * F.col("df") + 1).cast("double")
    rows = held.select("term", F.floor(1000 * F.log(ratio)).cast("long").alias("w")).collect()  # one row per term of ids
    weights = np.zeros(max(len(ids), 1), np.int64)
    for r in rows:
        weights[r["term"]] = r["w"]
    wanted = [(item, np.array([ids[t] for t in terms], np.int64)) for item, terms in listed if terms]
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    schema = T.StructType([T.StructField("_item", T.LongType()), docs.select(id_col).schema[0], T.StructField("score", T.LongType())])
    return postings.filter(F.size("terms") > 0).select(id_col, "n", "terms", "counts").mapInArrow(_search(wanted, weights, n_docs, n_words, k, id_col), schema)
