"""Operators that keep state by episode in a stream: future pairs and the sticky action."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.windows import held_moves
from ..sources.sinks import scratch


def run_to_table(df: DataFrame, name: str) -> DataFrame:
    """Runs a stream over the files that are there and returns the rows it wrote."""
    spark, out = df.sparkSession, scratch(df.sparkSession, name)
    df.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{out}/data")


def pairs(stream: DataFrame, offset: int) -> DataFrame:
    """(episode, old, new): each event with the one `offset` later in its episode; the state is the last `offset` events.

    Events of an episode are taken in order within a batch, and batches must follow each other in time.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [*state.get[0]] if state.exists else []
        new = sorted(e for pdf in batches for e in pdf["event"].tolist())
        row = held + new
        out = [(key[0], row[i - offset], row[i]) for i in range(max(offset, len(held)), len(row))]
        state.update((row[-offset:],))
        yield pd.DataFrame(out, columns=["episode", "old", "new"])

    return stream.groupBy("episode").applyInPandasWithState(step, "episode long, old long, new long", "held array<long>", "append", GroupStateTimeout.NoTimeout)


def stream_pairs(spark: SparkSession, source: str, offset: int) -> DataFrame:
    """pairs() over JSON files of (episode, event), one file a batch in order of modification."""
    stream = spark.readStream.schema("episode long, event long").option("maxFilesPerTrigger", 1).json(source)
    return run_to_table(pairs(stream, offset), "pairs")


def sticky_stream(stream: DataFrame, trigger: float = 0.5, hold: int = 15) -> DataFrame:
    """(episode, t, sticky): the sticky action; the state is what is left of a span that a batch has begun, and its move."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        left, kept = state.get if state.exists else (0, 0.0)
        moves = pd.concat([*batches]).sort_values("t")
        held, left, kept = held_moves(moves["move"].to_numpy(float), trigger, hold, left, kept)
        state.update((left, kept))
        yield pd.DataFrame({"episode": key[0], "t": moves["t"].to_numpy(), "sticky": held})

    return stream.groupBy("episode").applyInPandasWithState(step, "episode long, t long, sticky double", "steps int, kept double", "append", GroupStateTimeout.NoTimeout)
