"""Session settings, table loading and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}
_scopes: list[list[str]] = []  # paths given out inside each open scope, the innermost last


def get_session(app: str = "gleaner", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Run-time SQL settings every operator assumes; memory and parallelism stay the cluster's."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # small tables keep as many pieces as there are cores; large ones go by the advisory size
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # a skewed join may be split even where the next step then needs its own shuffle
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a machine-local folder only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder every executor can reach")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="gleaner-")
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables, states and files that operators write inside, and no others, at its end.

    Results are read from them: write or collect a result before the scope ends.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage by a table in the shared folder: computed once, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Use all cores where a source scan comes in fewer pieces than there are cores.

    For scans only. Large sources have more pieces than cores and are left as they are: no shuffle of raw
    text at scale.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows
