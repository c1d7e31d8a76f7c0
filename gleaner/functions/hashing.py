"""Universal hash families on 64-bit columns."""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seed, moduli and table sizes of the hash families.
SEED = 25
MINHASH_PRIME = 2**35 - 365
MINHASH_BUCKETS = 42949
USER_MINHASH_BUCKETS = 4294975
SKETCH_PRIME = 2**35 - 355
BLOOM_BITS = 8351
BLOOM_HASHES = 7
FM_BUCKETS = 4293517
FM_HASHES = 12
ZERO_HASH_TAIL = 20  # trailing zeros counted for a hash value of 0

SPLIT = 18  # a value below 2**35 is multiplied in two parts of at most this many low bits


@dataclass(frozen=True)
class Hash:
    """``((a * x + c) mod prime) mod buckets``"""

    a: int
    c: int
    prime: int
    buckets: int


def minhash_family(count: int, buckets: int = MINHASH_BUCKETS, seed: int = SEED) -> list[Hash]:
    """Member i adds ``i`` times its second draw."""
    draw = random.Random(seed)
    family = []
    for i in range(count):
        a = draw.randint(1, MINHASH_PRIME - 1)
        b = draw.randint(217, MINHASH_PRIME - 1)
        family.append(Hash(a, b * i % MINHASH_PRIME, MINHASH_PRIME, buckets))
    return family


def sketch_family(count: int, buckets: int, seed: int = SEED) -> list[Hash]:
    draw = random.Random(seed)
    family = []
    for _ in range(count):
        a = draw.randint(1, SKETCH_PRIME - 1)
        b = draw.randint(0, SKETCH_PRIME - 1)
        family.append(Hash(a, b, SKETCH_PRIME, buckets))
    return family


def affine_mod(x: Column, a: Column | int, c: Column | int, prime: int) -> Column:
    """``(a * x + c) mod prime`` for 0 <= x < 2**53 and a, c < 2**35, without passing 2**63."""
    a = F.lit(a) if isinstance(a, int) else a
    c = F.lit(c) if isinstance(c, int) else c
    reduced = x % F.lit(prime)
    high = F.shiftright(reduced, SPLIT)
    low = reduced.bitwiseAND(F.lit((1 << SPLIT) - 1))
    return (F.shiftleft((a * high) % F.lit(prime), SPLIT) + a * low + c) % F.lit(prime)


def hash_value(x: Column, h: Hash) -> Column:
    return affine_mod(x, h.a, h.c, h.prime) % F.lit(h.buckets)


def text_number(text: Column, prime: int = SKETCH_PRIME) -> Column:
    """UTF-8 bytes of ``text`` read as one big-endian integer, modulo ``prime`` (below 2**39)."""
    # three bytes at a time, from the hex digits filled up on the left
    digits = F.hex(F.encode(text, "UTF-8"))
    filled = F.lpad(digits, (F.ceil(F.length(digits) / 6) * 6).cast("int"), F.lit("0"))
    parts = F.transform(F.regexp_extract_all(filled, F.lit("(.{6})"), 1), lambda p: F.conv(p, 16, 10).cast("long"))
    return F.aggregate(parts, F.lit(0).cast("long"), lambda acc, v: (F.shiftleft(acc, 24) + v) % F.lit(prime))


def trailing_zeros(value: Column) -> Column:
    lowest = value.bitwiseAND(-value)
    return F.when(value == 0, F.lit(ZERO_HASH_TAIL)).otherwise(F.bit_count(lowest - 1))
