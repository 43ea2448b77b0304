"""Writing: staged and audited publishing, per-episode overwrite, compact JSON, summaries, append."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


_made: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares, deleted when the driver ends; a local one only where the session names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    base = (base or "file:///tmp/checkpoints").rstrip("/")
    _made.append(path := f"{base}/{name}-{uuid.uuid4().hex[:12]}")
    return path


@atexit.register
def _clean() -> None:
    for path in _made:
        with contextlib.suppress(OSError, pa.ArrowInvalid):
            filesystem, at = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
            filesystem.delete_dir(at)


def publish(df: DataFrame, path: str, audit: Callable[[DataFrame], None], fmt: str = "json") -> None:
    """Writes beside the target, audits what was written, then moves it there; a failure leaves the target alone.

    The old target is moved aside, and back if the new one can't take its place; a crash in between leaves both
    whole, beside each other.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    staged, target, aside = (jvm.org.apache.hadoop.fs.Path(path + end) for end in (".staging", "", ".old"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        df.write.mode("overwrite").format(fmt).save(f"{path}.staging")
        audit(spark.read.format(fmt).schema(df.schema).load(f"{path}.staging"))
        if fs.exists(aside) and not fs.exists(target):  # left by a crash between the two moves
            fs.rename(aside, target)
        fs.delete(aside, True)
        had = fs.exists(target)
        if had and not fs.rename(target, aside):
            raise OSError(f"could not move {path} aside")
        if not fs.rename(staged, target):
            if had:
                fs.rename(aside, target)
            raise OSError(f"could not publish {path}")
        fs.delete(aside, True)
    finally:
        fs.delete(staged, True)


def write_episodes(df: DataFrame, path: str, keys: list[str], fmt: str = "parquet") -> None:
    """A folder for each episode; running again overwrites the episodes in df and no others."""
    df.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).format(fmt).save(path)


def write_ordered(df: DataFrame, path: str, by: list[str]) -> None:
    """Parts in order: part files sorted by name hold sorted ranges, so a merged read needs no single file."""
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").json(path)


def write_observed(df: DataFrame, path: str, **metrics: object) -> dict:
    """Writes and returns aggregates of the rows written, in the same pass."""
    seen = Observation()
    df.observe(seen, *(c.alias(k) for k, c in metrics.items())).write.mode("overwrite").parquet(path)
    return seen.get


def compact_json(df: DataFrame, name: str = "value") -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))


def append_text(df: DataFrame, path: str) -> None:
    df.write.mode("append").text(path)


def bins_csv(edges: DataFrame, path: str, width: int) -> None:
    """A line for each dimension, padded with blanks to `width` cells, as ragged_csv reads it."""
    wide = edges.select("dim", *(F.get("edges", F.lit(i)).alias(str(i)) for i in range(width)))
    wide.coalesce(1).sortWithinPartitions("dim").drop("dim").write.mode("overwrite").option("header", True).csv(path)
