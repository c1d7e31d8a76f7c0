from pathlib import Path

import pytest

from gleaner.plans.queries import queries
from gleaner.session import scratch_dir, scratch_path, scratch_scope, written


def held(spark):
    return {p.name for p in Path(scratch_dir(spark).removeprefix("file://")).iterdir()}


def test_a_scope_removes_what_was_written_in_it_and_nothing_else(spark, sf):
    outer = written(spark.range(5), "outer")
    before = held(spark)
    with scratch_scope(spark):
        inner = written(spark.range(7), "inner")
        with scratch_scope(spark):
            rows = queries()["q_itemsets"](spark, sf).count()
            assert held(spark) > before
        assert inner.count() == 7 and rows > 0
    assert held(spark) == before and outer.count() == 5


def test_a_scope_ends_after_an_error_and_ignores_unused_paths(spark):
    before = held(spark)
    with pytest.raises(ValueError), scratch_scope(spark):
        scratch_path(spark, "never-written")
        written(spark.range(3), "lost")
        raise ValueError
    assert held(spark) == before
