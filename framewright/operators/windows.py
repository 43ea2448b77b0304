"""Positional windows over frames: pairs, gaps, islands, runs, ensembles. One sort by (episode, frame) serves each."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered_frames(df: DataFrame, keys: list[str], order: list[str], name: str = "frame") -> DataFrame:
    """Dense frame numbers from 0 in each episode."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("int"))


def future_frame(df: DataFrame, keys: list[str], offset: int, frame: str = "frame") -> DataFrame:
    """Pairs each frame with the one `offset` places later, the last frame at the tail.

    Both window functions share one specification, so there is one shuffle and one sort.
    """
    w = Window.partitionBy(*keys).orderBy(frame)
    last = F.last(frame).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn("future_frame", F.coalesce(F.lead(frame, offset).over(w), last))


def exact_pairs(df: DataFrame, keys: list[str], offset: int, frame: str = "frame") -> DataFrame:
    """(old, new): frames `offset` places apart whose numbers are `offset` apart too; others are dropped."""
    w = Window.partitionBy(*keys).orderBy(frame)
    paired = df.withColumn("old_frame", F.lag(frame, offset).over(w))
    return paired.filter(F.col(frame) - F.col("old_frame") == offset).withColumnRenamed(frame, "new_frame")


def discontinuities(df: DataFrame, keys: list[str], frame: str = "frame") -> DataFrame:
    """Frames that don't follow the one before, counted by episode; the first frame follows none."""
    w = Window.partitionBy(*keys).orderBy(frame)
    broken = df.withColumn("_gap", F.col(frame) != F.lag(frame).over(w) + 1)
    return broken.groupBy(*keys).agg(F.count("*").alias("n_frames"), F.count_if("_gap").alias("n_breaks"))


def islands(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Contiguous ranges [first, end) of distinct ordinals."""
    w = Window.partitionBy(*keys).orderBy(index)
    grouped = df.withColumn("_island", F.col(index) - F.row_number().over(w))
    out = grouped.groupBy(*keys, "_island").agg(F.min(index).alias("range_start"), (F.max(index) + 1).alias("range_end"))
    return out.drop("_island")


def missing_ranges(expected: DataFrame, done: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Ranges of expected ordinals that are not done, found by an anti join before anything is opened."""
    return islands(expected.join(done.select(*keys, index), [*keys, index], "left_anti"), keys, index)


def greedy_chunks(df: DataFrame, keys: list[str], index: str, most: int) -> DataFrame:
    """Packs each key's islands into chunks of at most `most` ordinals, in order: (keys, chunk, range_start, range_end).

    A chunk that holds something is closed rather than filled with part of an island; an island longer than a
    chunk is cut. The scan carries state, so one task reads one key's ranges, which are few for their ordinals.
    """
    ranges = islands(df, keys, index)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, chunk, held = [], 0, 0
        for a, b in sorted(zip(pdf["range_start"].tolist(), pdf["range_end"].tolist(), strict=True)):
            while a < b:
                if held and held + (b - a) > most:
                    chunk, held = chunk + 1, 0
                take = min(b - a, most - held)
                rows.append((chunk, a, a + take))
                a, held = a + take, held + take
                if held == most:
                    chunk, held = chunk + 1, 0
        out = pd.DataFrame(rows, columns=["chunk", "range_start", "range_end"])
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    types = dict(ranges.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", chunk int, range_start long, range_end long"
    return ranges.groupBy(*keys).applyInPandas(pack, schema)


def runs_of(df: DataFrame, keys: list[str], order: str, flag: str) -> DataFrame:
    """`run`: how many rows in a row, this one included, have had the flag."""
    w = Window.partitionBy(*keys).orderBy(order)
    marked = df.withColumn("_island", F.sum(F.when(F.col(flag), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(*keys, "_island").orderBy(order)
    held = F.sum(F.when(F.col(flag), 1).otherwise(0)).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("run", held.cast("int"))


def latched(df: DataFrame, keys: list[str], order: str, hold: str, flag: str, name: str = "latched") -> DataFrame:
    """True from the first `flag` of a run of `hold` on; a row without `hold` resets it."""
    w = Window.partitionBy(*keys).orderBy(order)
    marked = df.withColumn("_island", F.sum(F.when(F.col(hold), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(*keys, "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn(name, F.max(F.col(hold) & F.col(flag)).over(inside)).drop("_island")


def history(df: DataFrame, keys: list[str], order: str, value: str, horizon: int) -> DataFrame:
    """The last `horizon` values, oldest first, and how many places of the horizon are empty yet."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(horizon - 1), 0)
    held = F.collect_list(value).over(w)
    return df.withColumn("history", held).withColumn("n_pad", F.lit(horizon) - F.size("history"))


def temporal_ensemble(df: DataFrame, keys: list[str], order: str, predictions: str, horizon: int, temperature: float) -> DataFrame:
    """Averages what the last `horizon` predictions say of this step, weighted exp(-temperature * k), k = 0 the oldest."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(horizon - 1), 0)
    held = df.withColumn("_held", F.collect_list(predictions).over(w))
    n = F.size("_held")
    said = F.transform("_held", lambda p, k: F.get(p, n - 1 - k))
    weight = F.transform("_held", lambda _, k: F.exp(F.lit(-temperature) * k))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    return held.withColumn("ensembled", total(F.zip_with(said, weight, lambda x, y: x * y)) / total(weight)).drop("_held")


def rank_ranges(n: Column, ranks: int, rank: Column) -> tuple[Column, Column]:
    """The contiguous range of ordinals of one of `ranks` workers: floor(n * r / R); not ntile."""
    return F.floor(n * rank / ranks), F.floor(n * (rank + 1) / ranks)


def held_moves(moves: np.ndarray, trigger: float, hold: int, left: int = 0, kept: float = 0.0) -> tuple[np.ndarray, int, float]:
    """Moves with spans of `hold` steps filled by the move over the trigger that begins each; then what a later part needs.

    A span begins at the first move over the trigger after the span before. `left` and `kept` are the steps and the
    move of a span that goes on from an earlier part of the same episode.
    """
    out, starts, at = moves.astype(float), np.flatnonzero(np.abs(moves) > trigger), min(left, len(moves))
    out[:at] = kept
    left -= at
    while (k := np.searchsorted(starts, at)) < len(starts):
        begin, kept = int(starts[k]), float(moves[starts[k]])
        out[begin : begin + hold] = kept
        left, at = max(0, begin + hold - len(moves)), min(begin + hold, len(moves))
    return out, left, kept


def sticky_action(df: DataFrame, keys: list[str], order: str, value: str, trigger: float = 0.5, hold: int = 15) -> DataFrame:
    """(keys, order, value, sticky): a relative action over the trigger is repeated for `hold` steps. An episode is one task's rows."""
    types = dict(df.dtypes)
    chosen = df.select(*keys, order, value)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        return pdf.assign(sticky=held_moves(pdf[value].to_numpy(float), trigger, hold)[0])

    schema = ", ".join(f"{c} {types[c]}" for c in (*keys, order, value)) + ", sticky double"
    return chosen.groupBy(*keys).applyInPandas(run, schema)
