"""Membership filters that grow with their keys: blocks of 512 bits, built and probed by joins on the block.

A key falls into one block and sets up to seven bits there. Filters of one shape unite by ``unite``, so parts, days or
micro-batches can keep their own. The filter stays a table; no task, broadcast or literal holds all of it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.skew import skew_join

BLOCK_BITS = 512
WORDS = BLOCK_BITS // 64
MAX_HASHES = 7  # pieces of nine bits in the second half of an MD5
BLOCK_COST = 1.35  # bits a key needs more than in one large filter, as blocks fill unevenly


@dataclass(frozen=True)
class Shape:
    blocks: int
    hashes: int


def shape_for(keys: int, rate: float = 0.01) -> Shape:
    """Blocks and bits per key so that about ``rate`` of absent values are answered with yes."""
    per_key = BLOCK_COST * -math.log(rate) / math.log(2) ** 2
    hashes = min(MAX_HASHES, max(1, round(-math.log2(rate))))
    return Shape(max(1, math.ceil(keys * per_key / BLOCK_BITS)), hashes)


def count_keys(values: DataFrame, column: str) -> int:
    """Distinct values that are neither null nor empty."""
    return values.filter(_present(column)).select(column).distinct().count()


def _present(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def _spots(digest: Column, shape: Shape) -> tuple[Column, list[Column]]:
    """Block and bits of a value, from the two halves of its MD5."""
    number = lambda first, digits: F.conv(F.substring(digest, first, digits), 16, 10).cast("long")
    high, low = number(17, 8), number(25, 8)  # 32 bits each: three pieces of nine bits, and one more over both ends
    bits = [F.shiftright(half, 9 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for half in (high, low) for i in range(3)]
    rest = F.shiftleft(F.shiftright(high, 27), 5) + F.shiftright(low, 27)
    return number(1, 15) % F.lit(shape.blocks), [*bits, rest.bitwiseAND(F.lit(BLOCK_BITS - 1))][: shape.hashes]


def _masks(bits: list[Column]) -> list[Column]:
    """The bits of a value as the words of its block."""
    one = lambda p, w: F.when(F.shiftright(p, 6) == w, F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int")))
    found = []
    for w in range(WORDS):
        word = F.lit(0).cast("long")
        for p in bits:
            word = word.bitwiseOR(F.coalesce(one(p, w), F.lit(0).cast("long")))
        found.append(word)
    return found


def _hashed(rows: DataFrame, column: str, shape: Shape) -> DataFrame:
    """``rows`` with ``block`` and the masks ``m0`` to ``m7``; both null for null and empty values."""
    digested = rows.withColumn("_md5", F.when(_present(column), F.md5(F.col(column).cast("string").cast("binary"))))
    block, bits = _spots(F.col("_md5"), shape)
    placed = digested.withColumns({"block": block, **{f"_p{i}": p for i, p in enumerate(bits)}})
    masks = _masks([F.col(f"_p{i}") for i in range(len(bits))])
    return placed.withColumns({f"m{w}": m for w, m in enumerate(masks)}).drop("_md5", *(f"_p{i}" for i in range(len(bits))))


def build(values: DataFrame, column: str, shape: Shape) -> DataFrame:
    """``block, w0 … w7``: one row per block that holds a key; null and empty values are no keys.

    Bits are united map-side, so a value that fills a third of the rows costs one row per task.
    """
    keyed = _hashed(values.filter(_present(column)).select(column), column, shape)
    return keyed.groupBy("block").agg(*(F.bit_or(f"m{w}").alias(f"w{w}") for w in range(WORDS)))


def unite(*filters: DataFrame) -> DataFrame:
    """One filter that holds the keys of all; their shapes must be the same."""
    rows = filters[0]
    for other in filters[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("block").agg(*(F.bit_or(f"w{w}").alias(f"w{w}") for w in range(WORDS)))


def probe(values: DataFrame, column: str, held: DataFrame, shape: Shape) -> DataFrame:
    """Input rows with ``flag``: 1 if all bits of the value are set in its block, 0 for null and empty values.

    Distinct values meet the blocks, not the rows: a value repeated in many rows is looked up once, and its rows take the
    answer by a join that splits hot values.
    """
    asked = values.filter(_present(column)).select(column).distinct()
    met = _hashed(asked, column, shape).join(held, "block")
    hit = F.lit(True)
    for w in range(WORDS):
        hit = hit & (F.col(f"w{w}").bitwiseAND(F.col(f"m{w}")) == F.col(f"m{w}"))
    answers = met.filter(hit).select(column, F.lit(1).alias("flag"))
    return skew_join(values, answers, column, "left").withColumn("flag", F.coalesce("flag", F.lit(0)))


def quality(flags: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``present, missed, absent, wrong``: asked distinct values that are keys, those of them answered with no, asked
    values that are no keys, and those of them answered with yes."""
    asked = flags.filter(_present(column)).groupBy(column).agg(F.max("flag").alias("flag"))
    known = keys.select(column).distinct().withColumn("_key", F.lit(True))
    joined = asked.join(known, column, "left")
    is_key = F.coalesce("_key", F.lit(False))
    return joined.agg(
        F.count_if(is_key).alias("present"),
        F.count_if(is_key & (F.col("flag") == 0)).alias("missed"),
        F.count_if(~is_key).alias("absent"),
        F.count_if(~is_key & (F.col("flag") == 1)).alias("wrong"),
    )
