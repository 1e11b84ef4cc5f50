"""Channel names, qualified names and name patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def default_backend(base_url: str) -> str:
    """Backend named by the last path segment of a service address."""
    return base_url.strip().removesuffix("/").rpartition("/")[2]


def split_channel(name: Column, fallback_backend: str | Column) -> tuple[Column, Column]:
    """(backend, channel) of "backend/name"; without a slash the fallback backend is used.

    Segments after the second are ignored.
    """
    fallback = fallback_backend if isinstance(fallback_backend, Column) else F.lit(fallback_backend)
    parts = F.split(name, "/")
    qualified = F.size(parts) > 1
    return (
        F.when(qualified, F.get(parts, F.lit(0))).otherwise(fallback),
        F.when(qualified, F.get(parts, F.lit(1))).otherwise(name),
    )


def name_matches(name: Column, pattern: str = ".*") -> Column:
    """Does the name contain the pattern?

    The pattern is put between two ".*" and matched from the start of the name, so an alternation
    `a|b` means "contains a, or starts with b".
    """
    return name.rlike(f"^(?:.*{pattern}.*)")
