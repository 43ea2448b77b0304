"""Keyed joins of frames, labels and manifests, with what each does about misses."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OnMiss = Literal["fail", "count", "drop"]


def canonical_join(labels: DataFrame, vision: DataFrame, keys: list[str], on_miss: OnMiss = "fail") -> DataFrame:
    """Inner join of labels with vision rows on all keys of the canonical identity.

    "drop" leaves misses out; "fail" raises in the task that meets one; "count" keeps them with `missed` true.
    The build side is left to the planner: vision rows are never broadcast by hand.
    """
    if on_miss == "drop":
        return labels.join(vision, keys)
    marked = labels.join(vision.withColumn("_found", F.lit(True)), keys, "left")
    missed = F.col("_found").isNull()
    if on_miss == "count":
        return marked.withColumn("missed", missed).drop("_found")
    said = F.concat_ws(" ", F.lit("no vision row for"), *(F.col(k).cast("string") for k in keys))
    return marked.filter(F.when(missed, F.raise_error(said).cast("boolean")).otherwise(True)).drop("_found")


def miss_count(labels: DataFrame, vision: DataFrame, keys: list[str]) -> DataFrame:
    """One row: labels without a vision row. The vision side carries its keys only."""
    return labels.join(vision.select(*keys), keys, "left_anti").agg(F.count("*").alias("n_missed"))


def pending(expected: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return expected.join(done.select(*keys), keys, "left_anti")


def wanted(df: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(listed.select(*keys), keys, "left_semi")


def last_wins(df: DataFrame, keys: list[str], order: list[Column | str], values: list[str]) -> DataFrame:
    """One row for each key: the last by an explicit order; an aggregate, so rows combine before the shuffle."""
    rank = F.struct(*order)
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), rank).alias("_last")).select(*keys, "_last.*")


def neighbours_clamped(df: DataFrame, folder: str, step: str, window: int) -> DataFrame:
    """Each file with the one `window` steps on in its folder, clamped to the last."""
    sizes = df.groupBy(folder).agg(F.count("*").alias("_n"))
    placed = df.join(sizes, folder).withColumn("next_step", F.least(F.col(step) + window, F.col("_n") - 1)).drop("_n")
    other = df.select(folder, *(F.col(c).alias("next_step" if c == step else f"next_{c}") for c in df.columns if c != folder))
    return placed.join(other, [folder, "next_step"])


def grid(*axes: DataFrame) -> DataFrame:
    """Every combination of parameter axes, each a short literal table."""
    out = axes[0]
    for a in axes[1:]:
        out = out.crossJoin(a)
    return out


def rank_violations(perf: DataFrame, task: str, policy: str, sim: str, real: str) -> DataFrame:
    """By task and policy, the largest real difference to a policy that the simulation ranks the other way round."""
    a, b = perf.alias("a"), perf.alias("b")
    pairs = a.join(b, F.col(f"a.{task}") == F.col(f"b.{task}"))
    wrong = (F.col(f"a.{sim}") > F.col(f"b.{sim}")) != (F.col(f"a.{real}") > F.col(f"b.{real}"))
    gap = F.when(wrong, F.abs(F.col(f"a.{real}") - F.col(f"b.{real}"))).otherwise(0.0)
    return pairs.groupBy(F.col(f"a.{task}").alias(task), F.col(f"a.{policy}").alias(policy)).agg(F.max(gap).alias("violation"))
