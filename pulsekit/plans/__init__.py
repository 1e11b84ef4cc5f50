"""Queries over the driver tables: the message and sample views, and one plan per operator."""
