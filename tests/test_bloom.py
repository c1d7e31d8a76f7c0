import hashlib

import pytest

from gleaner.operators import bloom


def block_and_bits(value, shape):
    digest = hashlib.md5(value.encode()).hexdigest()
    high, low = int(digest[16:24], 16), int(digest[24:32], 16)
    bits = [half >> 9 * i & 511 for half in (high, low) for i in range(3)] + [((high >> 27 << 5) + (low >> 27)) & 511]
    return int(digest[:15], 16) % shape.blocks, set(bits[: shape.hashes])


@pytest.fixture(scope="module")
def keys(spark):
    return spark.createDataFrame([(f"k{i}",) for i in range(3000)] * 2 + [(None,), ("",)], "c string")


def test_shape_grows_with_the_keys():
    assert bloom.shape_for(0).blocks == 1
    small, large = bloom.shape_for(10_000), bloom.shape_for(1_000_000)
    assert 99 < large.blocks / small.blocks < 101 and small.hashes == large.hashes == 7
    assert bloom.shape_for(1000, 0.1).hashes == 3


def test_filter_matches_brute_force(spark, keys):
    shape = bloom.Shape(17, 5)
    want = {}
    for i in range(3000):
        block, bits = block_and_bits(f"k{i}", shape)
        want.setdefault(block, set()).update(bits)
    held = bloom.build(keys, "c", shape)
    got = {r.block: {64 * w + b for w in range(8) for b in range(64) if r[f"w{w}"] >> b & 1} for r in held.collect()}
    assert got == want
    asked = spark.createDataFrame([(i, f"k{i * 7}") for i in range(2000)] + [(-1, None), (-2, "")] + [(-3, "k0")] * 3, "n int, c string")
    flags = [(r.n, r.flag) for r in bloom.probe(asked, "c", held, shape).collect()]

    def hit(value):
        block, bits = block_and_bits(value, shape)
        return int(bits <= want.get(block, set()))

    assert sorted(flags) == sorted([(i, hit(f"k{i * 7}")) for i in range(2000)] + [(-1, 0), (-2, 0)] + [(-3, 1)] * 3)


@pytest.mark.parametrize("rate", [0.01, 0.05])
def test_no_key_is_missed_and_few_others_pass(spark, rate):
    n = 40_000  # the fixed filter of 8,351 bits says yes to all by then
    given = spark.range(n).selectExpr("concat('user', id) as c")
    shape = bloom.shape_for(bloom.count_keys(given, "c"), rate)
    asked = spark.range(3 * n).selectExpr("concat('user', id) as c")
    flags = bloom.probe(asked, "c", bloom.build(given, "c", shape), shape)
    present, missed, absent, wrong = bloom.quality(flags, given, "c").first()
    assert (present, missed, absent) == (n, 0, 2 * n)
    assert wrong < rate * absent


def test_parts_unite_to_the_whole(spark, keys):
    shape = bloom.shape_for(3000)
    whole = sorted(bloom.build(keys, "c", shape).collect())
    parts = [bloom.build(keys.filter(f"hash(c) % 3 in ({p}, -{p})"), "c", shape) for p in range(3)]
    assert sorted(bloom.unite(*parts).collect()) == whole


def test_empty_filter_answers_no(spark, keys):
    shape = bloom.shape_for(0)
    held = bloom.build(keys.limit(0), "c", shape)
    assert bloom.probe(keys, "c", held, shape).agg({"flag": "max"}).first()[0] == 0
    assert bloom.probe(keys.limit(0), "c", held, shape).count() == 0


def test_no_block_leaves_its_table(spark, keys):
    """The filter is met by a join on the block, never as one row or a literal."""
    shape = bloom.Shape(1000, 7)
    plan = bloom.probe(keys, "c", bloom.build(keys, "c", shape), shape)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan and "block" in plan
