"""A uniform sample kept over a stream of tagged messages, in the state store."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from gleaner.functions.hashing import SEED
from gleaner.operators.sketch import SAMPLE_SIZE, priority, reservoir, tag_counts

BUCKETS = 16  # groups a stream is dealt to; each keeps a sample of its own, so no task sees all messages
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ENTRY = "priority long, id long, body string"


def tagged(messages: DataFrame, tags: str = "tags") -> DataFrame:
    return messages.filter(F.size(tags) > 0)


def tracked(messages: DataFrame, track: list[str], language: str | None = "en", text: str = "text") -> DataFrame:
    """Messages in a language that mention one of the tracked words."""
    mentioned = F.arrays_overlap(F.split(F.lower(text), r"\W+"), F.array(*[F.lit(t.lower()) for t in track]))
    return messages.filter(mentioned if language is None else mentioned & (F.col("lang") == language))


class KeepSmallest(StatefulProcessor):
    """State of a bucket: its ``k`` messages of smallest priority. Messages that enter it are passed on."""

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("kept", ENTRY)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = [tuple(r) for r in self.kept.get()]
        best = {(p, i): body for p, i, body in before}
        for frame in rows:
            frame = frame.nsmallest(self.k, ["priority", "id"])  # more of one batch cannot stay
            best.update({(int(p), int(i)): body for p, i, body in zip(frame["priority"], frame["id"], frame["body"], strict=True)})
        kept = sorted(best)[: self.k]
        old = {(p, i) for p, i, _ in before}
        entered = [(p, i, best[p, i]) for p, i in kept if (p, i) not in old]
        if entered:
            self.kept.put([(p, i, best[p, i]) for p, i in kept])
        yield pd.DataFrame(entered, columns=["priority", "id", "body"])

    def close(self) -> None:
        pass


def entering(stream: DataFrame, id_column: str, k: int = SAMPLE_SIZE, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """``priority, id, body`` of the messages that enter the sample of their bucket, as JSON.

    Ids are whole numbers; a message seen again is the same message. A bucket keeps ``k`` messages in the state store and
    passes on about ``k ln(n / k)`` of the ``n`` it sees. The ``k`` smallest of all that entered are the sample.
    """
    # the state store that keeps lists
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
    rows = stream.select(
        F.pmod(F.xxhash64(id_column), F.lit(buckets)).alias("bucket"), priority(F.col(id_column), seed).alias("priority"),
        F.col(id_column).cast("long").alias("id"), F.to_json(F.struct(*stream.columns)).alias("body"),
    )
    return rows.groupBy("bucket").transformWithStateInPandas(
        KeepSmallest(k), outputStructType=T._parse_datatype_string(ENTRY), outputMode="Append", timeMode="None"
    )


def keep_sample(
    stream: DataFrame,
    id_column: str,
    base: str,
    checkpoint: str,
    k: int = SAMPLE_SIZE,
    seed: int = SEED,
    every: str | None = "5 seconds",
    on_sample: Callable[[DataFrame, int], None] | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep the ``k`` messages of smallest priority seen so far, over micro-batches and restarts.

    The state store holds the sample; messages that enter it are appended to the one folder ``base``, where ``last_sample``
    finds it. ``on_sample`` sees every new sample (live tag counts). A micro-batch that is run again appends the same
    messages again, which count once.
    """

    def append(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("append").parquet(base)
        if on_sample is not None:
            on_sample(last_sample(batch.sparkSession, base, stream.schema, id_column, k, seed), epoch)

    entered = entering(stream, id_column, k, seed, buckets)
    writer = entered.writeStream.outputMode("append").foreachBatch(append).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def show_tags(sample: DataFrame, epoch: int) -> None:
    """Live tag table for ``on_sample``: the counts over the sample, recounted after every batch."""
    tag_counts(sample).show(truncate=False)


def last_sample(
    spark: SparkSession, base: str, schema: T.StructType, id_column: str, k: int = SAMPLE_SIZE, seed: int = SEED
) -> DataFrame:
    """The sample as messages of ``schema``: the ``k`` of smallest priority among those that entered."""
    entered = spark.read.schema(ENTRY).parquet(base).dropDuplicates(["id"])
    messages = entered.select(F.from_json("body", schema).alias("m")).select("m.*")
    return reservoir(messages, id_column, k, seed)
