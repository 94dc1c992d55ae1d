"""Random numbers fixed by hashes of columns: the same on every run and
partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO31 = 2 ** 31


def unit(*cols: Column) -> Column:
    """Uniform in (0, 1)."""
    return (F.pmod(F.xxhash64(*cols), F.lit(TWO31)) + F.lit(1)).cast("double") / F.lit(float(TWO31 + 1))


def normal(idx: Column, f: Column, seed: int) -> Column:
    """Standard normal of an index and a factor."""
    u1 = unit(idx, f, F.lit(seed), F.lit(1))
    u2 = unit(idx, f, F.lit(seed), F.lit(2))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)
