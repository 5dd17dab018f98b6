"""The registry of named queries: a Spark plan and, where SQL can say the same, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agorakit.plans.tables import Model
from agorakit.session import apply_runtime_conf

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, build: Callable[[Model], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Model(apply_runtime_conf(spark), sf_dir))

    run.__name__ = name
    QUERIES[name] = run
    if sql is not None:
        SQL[name] = sql


def load_all() -> None:
    from agorakit.plans import batch, business, experiments, quality, realtime, sessions  # noqa: F401
