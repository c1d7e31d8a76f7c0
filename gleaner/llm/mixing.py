"""Mixing sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

import math
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import free_names
from gleaner.session import written

CHUNK = 2_000  # units one flight takes
MAX_SOURCES = 1_000_000  # rows that the driver holds and sends along
WEIGHTS = (3, 1, 2)
EDGE = 1e-9


def source_targets(sizes: dict, weights: tuple = WEIGHTS, share: float = 1.5, most: float = 2.0) -> dict:
    """Target of each source. Sources by code point, null last, take the weights in turn and divide ``share`` of all sizes;
    a target stops at ``most`` times its source's size and the rest is divided anew.
    """
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, targets = share * sum(sizes.values()), list(names), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        part = {s: left * weight[s] / whole for s in open_}
        full = [s for s in open_ if part[s] > most * sizes[s]]
        if not full:
            targets |= part
            break
        targets |= {s: most * sizes[s] for s in full}
        left -= sum(targets[s] for s in full)
        open_ = [s for s in open_ if s not in targets]
    return targets


def flight(sizes: list[float], chance: list[float], draw: np.random.Generator, land: bool) -> list[float]:
    """Move inclusion chances to 0 or 1 inside the null space of the totals of sizes and of documents.

    Three units have one direction that keeps both totals; a move along it settles at least one of them. Up to two
    units stay open; landing settles these too, keeping the total of sizes as long as two are left.
    """
    chance = list(chance)
    units = iter([k for k, p in enumerate(chance) if EDGE < p < 1 - EDGE])
    held: list[int] = []

    def move(way: list[float]) -> None:
        up = down = math.inf
        for k, u in zip(held, way, strict=True):
            if u:
                p = chance[k]
                up = min(up, (1 - p) / u if u > 0 else p / -u)
                down = min(down, p / u if u > 0 else (1 - p) / -u)
        by = up if draw.random() * (up + down) < down else -down
        for k, u in zip(held, way, strict=True):
            p = chance[k] + by * u
            chance[k] = 0.0 if p < EDGE else 1.0 if p > 1 - EDGE else p
        held[:] = [k for k in held if 0 < chance[k] < 1]

    while True:
        held += islice(units, 3 - len(held))
        if len(held) < 3:
            break
        a, b, c = (sizes[k] for k in held)
        move([b - c, c - a, a - b] if not a == b == c else [1, -1, 0])
    while land and held:
        if len(held) == 2:
            a, b = (sizes[k] for k in held)
            move([b, -a] if a or b else [1, -1])
        else:
            chance[held[0]] = float(draw.random() < chance[held[0]])
            held = []
    return chance


def _fly(seed: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("weight", "descending"), ("unit", "ascending")])
        land = table.column("chunks")[0].as_py() == 1
        first = table.column("unit")[0].as_py()
        draw = np.random.default_rng([seed, first & 0xFFFFFFFF, len(table)])
        chance = flight(table.column("weight").to_pylist(), table.column("chance").to_pylist(), draw, land)
        at = table.schema.get_field_index("chance")
        return table.set_column(at, "chance", pa.array(chance, pa.float64()))

    return run


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 9,
) -> DataFrame:
    """How often the mix takes each row: id, source, ``size`` (words), ``unit`` and ``unit2`` (hashes of the row), ``repeats`` (how
    many equal rows this holds for), ``source_size``, ``target`` and ``copies``.

    A source takes its target over its size times: the whole part is copies of everything, the fraction a balanced
    sample. Of equal rows (id, source and text) the whole part of that fraction takes one copy more, and a single one of
    them flies for the rest, so repeats miss no target; they come as up to two rows of different ``copies``. Flights run on chunks of at most ``CHUNK`` units of a source, cut by hash, so a hot source is many tasks;
    what they leave open (two units each) flies again until a source is one chunk, which lands. Null sources are one
    source, null texts size 0; sources without words take nothing; an empty table gives no rows; columns but the three
    named are not read. Reruns draw the same. The driver holds one row per source, at most ``MAX_SOURCES``; units move
    without their texts.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        id_col, F.col(source_col).alias("_source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"), *unit_of(id_col, source_col, text_col),
    )
    units = written(rows.groupBy(id_col, "_source", "size", "unit", "unit2").agg(F.count("*").alias("repeats")), "units")
    total = F.sum(F.col("size") * F.col("repeats"))
    found = units.groupBy("_source").agg(total.alias("size"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"over {MAX_SOURCES} sources")
    sizes = {r["_source"]: r["size"] for r in found}
    targets = source_targets(sizes, weights, share, most)
    rates = {s: targets[s] / sizes[s] if sizes[s] else 0.0 for s in sizes}
    chunks = {r["_source"]: max(1, math.ceil(r["n"] / CHUNK)) for r in found}
    kind = units.schema["_source"].dataType

    def per_source(columns: str, values: list[tuple]) -> DataFrame:
        fields = [T.StructField("_s", kind), *T._parse_datatype_string(columns).fields]
        return F.broadcast(spark.createDataFrame(values, T.StructType(fields)))  # one row per source

    fixed = [(s, sizes[s], float(targets[s]), int(rates[s]), rates[s] - int(rates[s])) for s in sizes]
    same = F.col("_source").eqNullSafe(F.col("_s"))
    known = per_source("source_size long, target double, whole int, part double", fixed)
    more = F.col("repeats") * F.col("part")
    open_ = units.join(known, same).withColumns(
        {"sure": F.floor(more), "chance": more - F.floor(more), "weight": F.col("size").cast("double")}
    ).drop("_s", "part")
    done = []
    turn = 0
    while True:
        cut = per_source("chunks int", [(s, chunks[s]) for s in chunks])
        dealt = open_.join(cut, same).drop("_s").withColumn("chunk", F.pmod(F.xxhash64("unit", F.lit(turn)), F.col("chunks")))
        flown = written(dealt.groupBy("_source", "chunk").applyInArrow(_fly(seed + turn), dealt.schema).drop("chunk", "chunks"), "flight")
        settled = (F.col("chance") <= 0) | (F.col("chance") >= 1)
        done.append(flown.filter(settled))
        if max(chunks.values(), default=1) == 1:
            break
        open_ = flown.filter(~settled)
        chunks = {s: max(1, math.ceil(2 * n / CHUNK)) for s, n in chunks.items()}
        turn += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    extra = F.col("sure") + F.round("chance").cast("long")
    classes = F.array(
        F.struct(extra.alias("repeats"), (F.col("whole") + 1).alias("copies")),
        F.struct((F.col("repeats") - extra).alias("repeats"), F.col("whole").alias("copies")),
    )
    split = out.withColumn("_c", F.explode(F.filter(classes, lambda c: c["repeats"] > 0)))
    return split.select(
        id_col, F.col("_source").alias(source_col), "size", "unit", "unit2", "_c.repeats", "source_size", "target", "_c.copies"
    )


def unit_of(id_col: str, source_col: str, text_col: str) -> list[Column]:
    """Two independent hashes of a row: 64 bits would meet by chance among 10 ** 11 rows, 128 do not."""
    columns = [F.col(id_col), F.col(source_col), F.col(text_col)]
    return [F.xxhash64(*columns).alias("unit"), F.xxhash64(F.lit(7), *columns[::-1]).alias("unit2")]


def apply_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **settings) -> DataFrame:
    """The mixed rows themselves: every row as often as the mix takes it, with the columns of ``docs`` as they were.

    Of equal rows (id, source and text) some may be taken once more than the others: these copies all come from one of
    them, any one, should they differ in other columns. Nulls, empty texts and empty tables are as in ``mix``.
    """
    one, two, base, extra, copy = free_names(docs, "unit", "unit2", "base", "extra", "copy")
    found = mix(docs, id_col, source_col, text_col, **settings).groupBy(F.col("unit").alias(one), F.col("unit2").alias(two))
    least = F.min("copies")
    chosen = written(found.agg(least.alias(base), (F.sum(F.col("copies") * F.col("repeats")) - least * F.sum("repeats")).alias(extra)), "chosen")
    first, second = unit_of(id_col, source_col, text_col)
    keyed = docs.withColumns({one: first, two: second})
    times = lambda rows, n: rows.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n).cast("long")))).select(*docs.columns)
    every = times(keyed.join(chosen.filter(F.col(base) > 0), [one, two]), base)
    more = keyed.join(chosen.filter(F.col(extra) > 0), [one, two]).dropDuplicates([one, two])
    return every.unionByName(times(more, extra))
