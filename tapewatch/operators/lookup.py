"""Join of a per-key summary to a table that may be large and skewed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewatch.session import settle


def lookup(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", computed: bool = True) -> DataFrame:
    """Join a per-key summary to a table that may hold very many rows of one key; null keys match each other.

    A ``computed`` summary is settled first, so its true size decides: under the broadcast threshold
    ``big`` is not shuffled at all, above it adaptive execution splits the skewed partitions of
    ``big``. A stored table has its own statistics.
    """
    side = settle(small, "lookup") if computed else small
    side = side.select(*[F.col(c).alias(f"_key_{c}") for c in on], *[c for c in side.columns if c not in on])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in on])
    return big.join(side, same, how).drop(*[f"_key_{c}" for c in on])
