"""Registered queries and their SQL twins, by name of operator."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """The driver's tables as attributes, read lazily; frames, labels and manifest as the episode model sees them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def frames(self) -> DataFrame:
        """Frame stream: an episode for each user, frames numbered by time."""
        from ..operators.windows import numbered_frames

        return numbered_frames(self.events.selectExpr("user_id AS episode", "ts", "event_id", "event_type AS instruction", "value"), ["episode"], ["ts", "event_id"])


#: The same stream for SQL twins.
FRAMES = "f AS (SELECT user_id AS episode, ts, event_id, event_type AS instruction, value, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::INT AS frame FROM events)"


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of Tables under a name, with the SQL that gives the same rows."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return f(Tables(spark, folder))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return f

    return add


for _module in ("windows", "joins", "aggregates", "projections", "ordering", "sequences", "quantization", "audits", "sources"):
    importlib.import_module(f"framewright.plans.{_module}")
