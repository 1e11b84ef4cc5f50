"""Importing this module registers every plan."""

from pulsekit.plans import archives, channels, codec, live, small_buckets, streams_in_order  # noqa: F401
