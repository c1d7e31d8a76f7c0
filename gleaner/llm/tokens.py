"""Token ids as binary shards with Elias-Fano document boundaries, and their reader."""

from __future__ import annotations

import os
import zlib
from array import array
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import Memo, cuts, narrow, with_fields
from gleaner.llm.elias_fano import encode, select
from gleaner.session import scratch_path

SHARD_BYTES = 8 << 20
SHARD_DOCS = 1 << 16
MARKS = ".,;:!?"
START, LEADS = "\r", "\r\n"  # mark of the first word of a text; of that and of the first of a line
BYTE_CHARS = {" ": "\u0120", "\n": "\u010a"}  # how a byte-level vocabulary writes these
JOINED = 64  # words encoded as one string
WORDS = 800_000  # words remembered per worker
#: White space other than single spaces and line breaks between other characters.
ODD = (
    r"[\t\r\x0B\x0C\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]|[ \n][ \n]|\A[ \n]|[ \n]\z|\A\z"
)


def _encoder(tokenizer_path: str):
    """The encoder of this file as it is now; a worker keeps the last one, and the words it met, for its next tasks."""
    state = os.stat(tokenizer_path)
    return _kept_encoder(tokenizer_path, state.st_mtime_ns, state.st_size)


@lru_cache(maxsize=1)
def _kept_encoder(tokenizer_path: str, changed: int, size: int):
    """A function of a slice of texts (an Arrow array of UTF-8 strings): the ids of all, and how many each text has.

    The byte-level pattern always ends a piece before a single space or line break between two other characters, so the
    ids of such a text are those of its words. Arrow cuts the texts and finds the distinct words of the slice; only these
    meet the memo, and numpy gathers their ids in the order of the texts. Words not met before are encoded once, many in
    one string: the ids of the next begin where a token holds its space or line break. Texts with any other white space go
    to the tokenizer whole.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    memo = Memo(WORDS)
    first = {lead: np.zeros(tokenizer.get_vocab_size(), bool) for lead in BYTE_CHARS}
    for token, i in tokenizer.get_vocab().items():
        for lead, char in BYTE_CHARS.items():
            first[lead][i] = token.startswith(char)

    def whole(texts: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def joined(words: list[str], lead: str) -> list[bytes]:
        """As ``whole`` of words that all begin with ``lead`` and hold no other white space."""
        ids = b"".join(whole(["".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]))
        starts = np.flatnonzero(first[lead][np.frombuffer(ids, "<u4")]) * 4
        if len(starts) != len(words):  # a vocabulary of another form
            return whole(words)
        bounds = [*starts.tolist(), len(ids)]
        return [ids[a:b] for a, b in pairwise(bounds)]

    def learn(words: list[str]) -> None:
        spaced, marked = [], []
        for w in words:
            if w[0] not in LEADS:
                (marked if w[-1] in marks and w[:-1].isalpha() else spaced).append(w)
        memo.update(zip(spaced, joined([" " + w for w in spaced], " "), strict=True))
        rest = []
        for w in marked:
            value = memo.get(w[:-1])  # a mark after letters is a piece of its own
            if value:
                memo[w] = value + marks[w[-1]]
            else:
                rest.append(w)
        memo.update(zip(rest, joined([" " + w for w in rest], " "), strict=True))
        lines = [w for w in words if w[0] == "\n"]
        memo.update(zip(lines, joined(lines, "\n"), strict=True))
        texts = [w for w in words if w[0] == START]
        memo.update(zip(texts, whole([w[1:] for w in texts]), strict=True))

    marks = dict(zip(MARKS, whole(list(MARKS)), strict=True))

    def by_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The first word of a text and of a line say so by a leading mark."""
        marked = pc.binary_join_element_wise(START, pc.replace_substring(texts, "\n", " \n"), "")
        split = pc.split_pattern(marked, " ")
        coded = split.flatten().dictionary_encode()
        every = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        words = pc.binary_join(every, " ")[0].as_py().split(" ")  # no word holds a space, and none is empty
        memo.room()
        values = list(map(memo.get, words))
        unknown = [k for k, v in enumerate(values) if v is None]
        if unknown:
            learn([words[k] for k in unknown])
            for k in unknown:
                values[k] = memo[words[k]]
        size = np.fromiter(map(len, values), np.int64, len(values)) // 4
        flat, first = np.frombuffer(b"".join(values), "<u4"), np.cumsum(size) - size
        index = coded.indices.to_numpy()
        many = size[index]
        ends = np.cumsum(many)
        ids = flat[np.repeat(first[index] - ends + many, many) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.concatenate(([0], ends))[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return ids, np.diff(upto)

    def run(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        if not odd.any():
            return by_words(texts)
        sizes, parts = np.zeros(len(texts), np.int64), [np.zeros(0, "<u4")] * len(texts)
        plain = np.flatnonzero(~odd)
        if len(plain):
            ids, sizes[plain] = by_words(texts.take(pa.array(plain)))
            for k, part in zip(plain.tolist(), np.split(ids, np.cumsum(sizes[plain])[:-1]), strict=True):
                parts[k] = part
        for k, found in zip(np.flatnonzero(odd).tolist(), whole(texts.filter(pa.array(odd)).to_pylist()), strict=True):
            parts[k] = np.frombuffer(found, "<u4")
            sizes[k] = len(parts[k])
        return np.concatenate(parts), sizes

    return run, tokenizer.get_vocab_size()


SHARD_FIELDS = [
    ("part", T.IntegerType()), ("seq", T.IntegerType()), ("before", T.LongType()), ("n_docs", T.LongType()),
    ("n_ids", T.LongType()), ("width", T.IntegerType()), ("ids", T.BinaryType()), ("low_bits", T.IntegerType()),
    ("ends_low", T.BinaryType()), ("ends_high", T.BinaryType()), ("ends_samples", T.BinaryType()),
]


def write_tokens(
    docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2
) -> None:
    """Encode every whole text in ascending id order and write the shards below ``path``.

    One range shuffle of the texts orders them; each task concatenates ids into shards of bounded size: the ids in 2
    or 4 bytes, the ids of the documents, and the ends of the documents in Elias-Fano form. Spark commits the files, so
    a lost task leaves nothing. ``end_id`` closes every document, also empty and null ones. Null ids come first; rows
    with the same id all stay, next to each other. An empty table writes no shard.
    """
    source = narrow(docs, text_col, [id_col]).repartitionByRange(id_col).sortWithinPartitions(id_col)
    id_type = source.schema[id_col].dataType
    schema = with_fields(T.StructType([T.StructField("doc_ids", T.ArrayType(id_type))]), *SHARD_FIELDS)

    def run(batches):
        tokenize, vocabulary = _encoder(tokenizer_path)
        small = max(vocabulary, end_id + 1) <= 1 << 16
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        keys: list[pa.Array] = []
        size = n_docs = 0

        def shard():
            nonlocal seq, before, size, n_docs
            ids, ends = np.concatenate(held), np.cumsum(np.concatenate(sizes))
            low_bits, low, high, samples = encode(ends, len(ids))
            listed = pa.concat_arrays(keys)
            whole = pa.ListArray.from_arrays(pa.array([0, len(listed)], pa.int32()), listed)
            values = [part, seq, before, n_docs, len(ids), 2 if small else 4, (ids if small else ids.astype("<u4")).tobytes(), low_bits, low, high, samples]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            columns = [whole, *(pa.array([v], k) for v, k in zip(values, kinds, strict=True))]
            seq, before, size, n_docs = seq + 1, before + len(ids), 0, 0
            held.clear()
            sizes.clear()
            keys.clear()
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            for a, b in cuts(batch.column(1)):
                ids, n = tokenize(batch.column(1).slice(a, b - a).cast(pa.string()))
                closed = np.insert(ids, np.cumsum(n), end_id)
                held.append(closed.astype("<u2") if small else closed)
                sizes.append(n + 1)
                keys.append(batch.column(0).slice(a, b - a))
                size, n_docs = size + 4 * len(closed), n_docs + b - a
                if size >= 2 * SHARD_BYTES or n_docs >= SHARD_DOCS:
                    yield shard()
        if held:
            yield shard()

    source.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``, the number of ids before each, over all shards."""
    shards = spark.read.parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_offset"))
    # one row per written partition, whatever the data
    return shards.join(F.broadcast(offsets), "part").withColumn("start", F.col("_offset") + F.col("before")).drop("_offset")


def boundaries(shard: dict):
    """First id and end of every document of a shard, one after the other, by ``select`` from the stored samples."""
    first = 0
    for i in range(shard["n_docs"]):
        end = select(i, shard["low_bits"], shard["ends_low"], shard["ends_high"], shard["ends_samples"])
        yield first, end
        first = end


def document_ids(shard: dict, i: int) -> np.ndarray:
    """Ids of document ``i`` of a shard alone, its end id included; no other boundary is decoded."""
    ends = [select(k, shard["low_bits"], shard["ends_low"], shard["ends_high"], shard["ends_samples"]) if k >= 0 else 0 for k in (i - 1, i)]
    width = shard["width"]
    return np.frombuffer(shard["ids"], f"<u{width}", ends[1] - ends[0], ends[0] * width).astype("<u4")


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files alone: id, ``start``, ``n_tokens``, and ``ids_crc32``."""
    shards = read_shards(spark, path).select(
        "doc_ids", "start", "n_docs", "width", "ids", "low_bits", "ends_low", "ends_high", "ends_samples"
    )
    id_type = shards.schema["doc_ids"].dataType.elementType
    fields = [(id_col, id_type), ("start", T.LongType()), ("n_tokens", T.LongType()), ("ids_crc32", T.LongType())]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names) if name != "doc_ids"}
                keys = batch.column(0)[i].values
                ids = np.frombuffer(row["ids"], "<u2" if row["width"] == 2 else "<u4")
                starts, sizes, crc = [], [], []
                for a, b in boundaries(row):
                    starts.append(row["start"] + a)
                    sizes.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].astype("<u4")))
                columns = [keys, *(pa.array(x, pa.int64()) for x in (starts, sizes, crc))]
                yield pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])

    return shards.mapInArrow(run, with_fields(T.StructType([]), *fields))


def token_output(docs: DataFrame, tokenizer_path: str, path: str | None = None, **columns) -> DataFrame:
    """Write the shards and read the documents back; an empty table gives no rows."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer_path, **columns)
    return read_documents(spark, path, columns.get("id_col", "doc_id"))
