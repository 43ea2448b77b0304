"""Integrity audits: queries that return violations, and gates that fail a job on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class AuditFailure(RuntimeError):
    """A gate found rows that must not be there, or too few."""


def errors(**rules: Column) -> Column:
    """Names of the rules that a row breaks, in order; a null test is no violation."""
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in rules.items())))


def key_mismatches(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.filter(~F.col(a).eqNullSafe(F.col(b)))


def count_mismatches(expected: DataFrame, found: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Keys whose number of found rows isn't the expected one; none found is zero."""
    counts = found.groupBy(*keys).agg(F.count("*").alias("n_found"))
    joined = expected.join(counts, keys, "left").withColumn("n_found", F.coalesce("n_found", F.lit(0)))
    return joined.filter(F.col(n) != F.col("n_found"))


def orphans(df: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(parent.select(*keys), keys, "left_anti")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def gate(violations: DataFrame, what: str, show: int = 20) -> None:
    """Raises if there are violations; a few of them are fetched for the message."""
    if found := violations.limit(show).collect():
        raise AuditFailure(f"{what}: {[r.asDict() for r in found]}")


def expect_count(df: DataFrame, n: int, what: str) -> None:
    if (found := df.count()) != n:
        raise AuditFailure(f"{what}: {found} rows, expected {n}")


def first_rows(df: DataFrame, keys: list[str], order: Column | str) -> DataFrame:
    """The first row of each file or episode, as an aggregate rather than a sort."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def cardinality(rows: DataFrame, episode: str, expected: DataFrame) -> DataFrame:
    """n_rows, n_episodes, expected_rows, expected_episodes, passes: whether both totals are the expected ones, of a table of one row."""
    found = rows.agg(F.count("*").alias("n_rows"), F.count_distinct(episode).alias("n_episodes"))
    both = found.crossJoin(expected.select("expected_rows", "expected_episodes"))  # one row each
    return both.withColumn("passes", (F.col("n_rows") == F.col("expected_rows")) & (F.col("n_episodes") == F.col("expected_episodes")))


def require(gate: DataFrame) -> DataFrame:
    """The gate's row; an error that names the totals, when it is read, if it doesn't pass."""
    text = F.concat(F.lit("expected "), F.to_json(F.struct(*gate.columns)))
    return gate.withColumn("passes", F.when(F.col("passes"), True).otherwise(F.raise_error(text).cast("boolean")))
