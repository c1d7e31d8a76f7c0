"""Helpers of the text operators: slices of Arrow batches, bounded memos, narrow inputs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_BYTES = 4 << 20  # an Arrow batch; Spark's own bound of 64 MB stands four times in an executor of two tasks
SLICE_BYTES = 1 << 20  # text worked on at a time; a longer text is a slice of its own
MEMO_ENTRIES = 400_000  # words remembered per worker; a full memo starts anew, results stay the same
UPPER_TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def narrow(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """Only the kept columns and ``_text`` as bytes (null: empty); other columns of any name stay out.

    The session's Arrow batches are bounded by bytes from here on: 10,000 long texts never stand in memory at once.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("_text"))


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """Names for columns beside those of ``docs``, none of which they cover whatever these are called."""
    taken = {c.lower() for c in docs.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def with_fields(kept: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*kept.fields, *(T.StructField(name, kind) for name, kind in fields)])


def cuts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``SLICE_BYTES`` of text."""
    start = held = 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        held += size
        if held >= SLICE_BYTES:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def slices(texts: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """Ranges of rows that hold about ``SLICE_BYTES`` of text, with their texts; the others stay in the batch."""
    for a, b in cuts(texts):
        yield a, b, texts.slice(a, b - a).to_pylist()


def per_text(
    docs: DataFrame,
    text_col: str,
    keep: list[str],
    fields: list[tuple[str, T.DataType, pa.DataType]],
    start: Callable[[], Callable[[list[bytes]], list]],
) -> DataFrame:
    """The kept columns of every row, untouched, beside ``fields`` computed from slices of whole texts.

    ``start`` runs once per task and gives the function of a slice: a list of texts to one column per field.
    """
    source = narrow(docs, text_col, keep)
    kinds = [kind for _, _, kind in fields]
    names = [*keep, *(name for name, _, _ in fields)]

    def run(batches):
        work = start()
        for batch in batches:
            for a, b, texts in slices(batch.column(len(keep))):
                found = work(texts)
                held = [batch.column(i).slice(a, b - a) for i in range(len(keep))]
                made = [x if isinstance(x, pa.Array) else pa.array(x, kind) for x, kind in zip(found, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(held + made, names=names)

    kept = T.StructType(source.schema.fields[:-1])
    return source.mapInArrow(run, with_fields(kept, *((name, kind) for name, kind, _ in fields)))


class Memo(dict):
    """Values of words seen before. When full, the words met first (mostly the frequent ones) stay and the rest goes."""

    def __init__(self, limit: int = MEMO_ENTRIES):
        super().__init__()
        self.limit = limit

    def room(self) -> None:
        if len(self) > self.limit:
            first = list(islice(self.items(), self.limit // 2))
            self.clear()
            self.update(first)


def crc_fold(key: Column, folds: int = 3) -> Column:
    """Fold of a row: crc32 of the key as text, modulo ``folds`` (null keys: fold 0)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0).cast("bigint"))


def first_by_hash(rows: DataFrame, limit: int, *keys: str) -> DataFrame:
    """The ``limit`` rows that come first by a hash of the keys.

    A share of the hash range that holds about three times as many is cut out first, so what is sorted stays that small at
    any size.
    """
    n = max(rows.count(), 1)
    place = F.shiftrightunsigned(F.xxhash64(*keys), 11) / float(1 << 53)
    near = rows.filter(place < (3 * limit + 100) / n) if n > 3 * limit + 100 else rows
    return near.orderBy(F.xxhash64(*keys), *keys).limit(limit)
