"""The list of plans: a name, a function of (spark, sf_dir), and the same answer in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
SQL: dict[str, str] = {}


def plan(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def register(function: Plan) -> Plan:
        PLANS[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register
