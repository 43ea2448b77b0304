"""Runs of a file stream to completion, resumed from a checkpoint, with sinks that a repeated batch can't double."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_available(spark: SparkSession, source: str, schema: str, out: str, files_per_batch: int = 100) -> None:
    """Reads the files that the checkpoint hasn't seen and appends their rows to out/data; ends when none are left."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(source)
    run = stream.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()


def run_episodes(spark: SparkSession, source: str, schema: str, out: str, keys: list[str]) -> None:
    """Each batch overwrites the folders of its own episodes: a batch that is run again after a failure writes the same."""
    from ..sources.sinks import write_episodes

    def write(batch: DataFrame, _: int) -> None:
        write_episodes(batch, f"{out}/data", keys)

    stream = spark.readStream.schema(schema).json(source)
    run = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
