"""Bloom membership, distinct-count estimates and uniform samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.hashing import (
    BLOOM_BITS,
    BLOOM_HASHES,
    FM_BUCKETS,
    FM_HASHES,
    SEED,
    SKETCH_PRIME,
    affine_mod,
    hash_value,
    sketch_family,
    text_number,
    trailing_zeros,
)

SAMPLE_SIZE = 100


def _present(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def bloom_bits(values: DataFrame, column: str, m: int = BLOOM_BITS, k: int = BLOOM_HASHES, seed: int = SEED) -> DataFrame:
    """``pos``: positions of the set bits, at most ``m`` rows."""
    known = values.filter(_present(column)).select(text_number(F.col(column)).alias("x"))
    places = F.array(*[hash_value(F.col("x"), h) for h in sketch_family(k, m, seed)])
    return known.select(F.explode(places).alias("pos")).distinct()


def bloom_words(bits: DataFrame, m: int = BLOOM_BITS) -> DataFrame:
    """One row ``words``: the bit vector in 64-bit words, ``m / 64`` of them."""
    words = bits.groupBy(F.shiftright("pos", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pos & 63 as int))")).alias("word")
    )
    return words.agg(F.map_from_entries(F.collect_list(F.struct("at", "word"))).alias("by_place")).select(
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.lit((m - 1) // 64).cast("long")),
            lambda i: F.coalesce(F.col("by_place")[i], F.lit(0).cast("long")),
        ).alias("words")
    )


def bloom_probe(
    values: DataFrame, column: str, bits: DataFrame, m: int = BLOOM_BITS, k: int = BLOOM_HASHES, seed: int = SEED
) -> DataFrame:
    """Input rows with ``flag``: 1 if all bits of the value are set, 0 for null and empty values.

    The bit vector is one value of fixed size ``m / 8`` bytes; rows are tested where they are, without a shuffle.
    """
    # one subquery: its answer is found once and reused for every hash
    words = bloom_words(bits, m).scalar()
    probed = values.withColumn("_x", F.when(_present(column), text_number(F.col(column))))
    hits = F.col("_x").isNotNull()
    for h in sketch_family(k, m, seed):
        place = hash_value(F.col("_x"), h)
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        hits = hits & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return probed.withColumn("flag", F.when(hits, 1).otherwise(0)).drop("_x")


def fm_tails(column: str, hashes: int = FM_HASHES, m: int = FM_BUCKETS, seed: int = SEED) -> list[Column]:
    """Trailing zeros of each hash of ``column``, as ``r0, r1, …``."""
    return [
        trailing_zeros(hash_value(F.col(column), h)).alias(f"r{i}") for i, h in enumerate(sketch_family(hashes, m, seed))
    ]


def fm_total(hashes: int = FM_HASHES, group_mean: bool = False) -> Column:
    """Estimate from the largest tails: two groups of hashes, each sum divided by the number of all hashes.

    ``group_mean=True`` divides by the size of a group instead.
    """
    powers = [F.pow(F.lit(2.0), F.col(f"r{i}")) for i in range(hashes)]
    half = hashes // 2
    whole = sum(powers[1:], powers[0])
    return whole / (2 * (half if group_mean else hashes))


def fm_estimate(
    df: DataFrame,
    column: str,
    group: list[str] | None = None,
    hashes: int = FM_HASHES,
    m: int = FM_BUCKETS,
    seed: int = SEED,
    group_mean: bool = False,
) -> DataFrame:
    """``group…, exact, estimate``: distinct values of ``column`` counted and estimated.

    Values are made distinct first, with map-side combine: no task holds the set of a group.
    """
    group = group or []
    known = df.filter(_present(column)).groupBy(*group, column).agg(F.lit(1).alias("_one"))
    tails = known.withColumn("_x", text_number(F.col(column))).select(*group, *fm_tails("_x", hashes, m, seed))
    counted = tails.groupBy(*group).agg(
        F.count("*").alias("exact"), *[F.max(f"r{i}").alias(f"r{i}") for i in range(hashes)]
    )
    return counted.filter(F.col("exact") > 0).select(
        *group, "exact", F.floor(fm_total(hashes, group_mean)).alias("estimate")
    )


def priority(ids: Column, seed: int = SEED) -> Column:
    """Seeded order of message ids: an affine map modulo a large number, ties by id."""
    h = sketch_family(1, SKETCH_PRIME, seed)[0]
    return affine_mod(ids, h.a, h.c, SKETCH_PRIME)


def reservoir(df: DataFrame, id_column: str, k: int = SAMPLE_SIZE, seed: int = SEED) -> DataFrame:
    """Uniform sample of ``k`` rows: those of smallest seeded priority. Samples of parts merge by the same rule."""
    return df.withColumn("_priority", priority(F.col(id_column), seed)).orderBy("_priority", id_column).limit(k).drop(
        "_priority"
    )


def tag_counts(sample: DataFrame, tags: str = "tags") -> DataFrame:
    """``tag, n`` over a sample, most frequent first, then by lower-case tag."""
    found = sample.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))
    return found.orderBy(F.desc("n"), F.lower("tag"), "tag")
