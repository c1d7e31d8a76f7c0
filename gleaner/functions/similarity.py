"""Similarity formulas over counts and sums of common elements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def jaccard(common: Column, size_a: Column, size_b: Column) -> Column:
    return common / (size_a + size_b - common)


def set_cosine(common: Column, size_a: Column, size_b: Column) -> Column:
    return common / (F.sqrt(size_a) * F.sqrt(size_b))


def pearson(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column, lx: Column, ly: Column) -> Column:
    """Correlation over common raters where the means divide the common sums by ``lx`` and ``ly``.

    Both sides of the fraction are multiplied by ``lx * ly``: whole-number ratings then give exact
    sums and an exact sign. No spread on one side gives 0.
    """
    lx, ly = lx.cast("double"), ly.cast("double")
    top = lx * ly * sxy - sx * sy * (lx + ly - n)
    spread_x = F.greatest(lx * lx * sxx - sx * sx * (2 * lx - n), F.lit(0.0))
    spread_y = F.greatest(ly * ly * syy - sy * sy * (2 * ly - n), F.lit(0.0))
    bottom = F.sqrt(spread_x) * F.sqrt(spread_y)
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)
