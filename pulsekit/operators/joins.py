"""Joins of large data with a table that is usually, but not provably, small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join `small` to `big`. Nothing is counted or hinted: Spark knows the sizes when it runs the join, broadcasts a
    side that is small in bytes, and splits a key that turns out to hold too much.
    """
    if how not in ("left", "inner", "left_semi"):
        raise ValueError(f"a lookup cannot be a {how} join")
    return big.join(small, list(on), how)
