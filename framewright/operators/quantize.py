"""Vector quantization: nearest codes, code lookup, usage statistics, and the hook for model scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Codebook entries that are broadcast as one array; a larger book is joined in blocks of about so many.
BLOCK = 4096


def squared_distance(x: Column, c: Column) -> Column:
    square = F.zip_with(x, c, lambda a, b: (a - b) * (a - b))
    return F.aggregate(square, F.lit(0.0), lambda s, v: s + v)


def nearest_code(vectors: DataFrame, codebook: DataFrame, vector: str, code: str, entry: str) -> DataFrame:
    """Adds `nearest` and `distance`: the least (distance, code), so ties go to the lowest code.

    The book is counted and broadcast in blocks of at most `BLOCK` entries, one after another; vectors are never
    shuffled.
    """
    parts = -(-codebook.count() // BLOCK) or 1
    entries = codebook.select(F.struct(F.col(code).alias("c"), F.col(entry).cast("array<double>").alias("e")).alias("b"), F.pmod(F.xxhash64(code), F.lit(parts)).alias("part"))
    found, best = vectors, F.lit(None)
    for k in range(parts):
        # one row, of BLOCK entries or little more
        block = entries.filter(F.col("part") == k).agg(F.sort_array(F.collect_list("b")).alias("_book"))
        near = F.array_min(F.transform("_book", lambda b: F.struct(squared_distance(F.col(vector).cast("array<double>"), b["e"]).alias("d"), b["c"].alias("c"))))
        best = near if not k else F.when(F.col("_best").isNull() | (near < F.col("_best")), near).otherwise(F.col("_best"))
        found = found.crossJoin(F.broadcast(block)).withColumn("_best", best).drop("_book")
    return found.withColumn("nearest", F.col("_best.c")).withColumn("distance", F.col("_best.d")).drop("_best")


def replace_dead(codebook: DataFrame, used: DataFrame, code: str, entry: str, least: int) -> DataFrame:
    """The book with `source`: a code that is used less than `least` times takes the entry of a live one, the most used first, in turn.

    `used` has counts `n` of codes. With no live code, all stay. A book is one task's rows.
    """
    n = codebook.join(used, code, "left").select(code, entry, F.coalesce("n", F.lit(0)).alias("n"))
    dead = F.col("n") < least
    numbered = n.withColumn("_rank", F.row_number().over(Window.partitionBy(dead).orderBy(F.when(dead, 0).otherwise(-F.col("n")), code)) - 1)
    live = numbered.filter(~dead).select(F.col(code).alias("source"), F.col(entry).alias("_new"), "_rank")
    m = live.agg(F.greatest(F.count("*"), F.lit(1)).alias("_m"))  # one row
    key = F.when(dead, F.col("_rank") % F.col("_m"))
    turned = numbered.crossJoin(F.broadcast(m)).withColumn("_rank", key).join(live, "_rank", "left")
    return turned.select(code, F.coalesce("_new", entry).alias(entry), F.coalesce("source", code).alias("source"), "n")


class PairLabeler:
    """A model that labels the change between two frames: the nearest code of the book for each of several parts of it."""

    def __init__(self, codes: np.ndarray, entries: np.ndarray, parts: int) -> None:
        self.codes, self.entries, self.parts = codes, entries, parts

    @classmethod
    def of(cls, codebook: DataFrame, code: str, entry: str, parts: int) -> PairLabeler:
        """From a book, which is a model's weights and so comes to the driver whole."""
        rows = sorted((r[0], r[1]) for r in codebook.select(code, F.col(entry).cast("array<double>")).collect())
        return cls(np.array([c for c, _ in rows]), np.array([e for _, e in rows], float), parts)

    def __call__(self, pdf: pd.DataFrame) -> pd.Series:
        change = np.stack(pdf["new"].to_numpy()) - np.stack(pdf["old"].to_numpy())
        out = []
        for x, book in zip(np.split(change, self.parts, axis=1), np.split(self.entries, self.parts, axis=1), strict=True):
            distance = np.stack([((x - e) ** 2).sum(axis=1) for e in book], axis=1)
            out.append(self.codes[distance.argmin(axis=1)])
        return pd.Series([*np.stack(out, axis=1)], index=pdf.index)


def score_model(df: DataFrame, model: Callable[[pd.DataFrame], pd.Series], output: str) -> DataFrame:
    """score_batches with a model that is broadcast once and not sent with each task."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    return score_batches(df, lambda pdf: shared.value(pdf), output)


def look_up(codes: DataFrame, codebook: DataFrame, code: str) -> DataFrame:
    return codes.join(codebook, code)


def perplexity(p: Column, eps: float = 1e-10) -> Column:
    """exp of the entropy of code shares, as an aggregate."""
    return F.exp(-F.sum(p * F.log(p + F.lit(eps))))


def score_batches(df: DataFrame, model: Callable[[pd.DataFrame], pd.Series], output: str) -> DataFrame:
    """Rows with a model's output, batch by batch: rows and outputs leave the task together, so none can slip."""
    name = output.split()[0]
    schema = ", ".join(f"{c} {t}" for c, t in df.dtypes) + f", {output}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{name: model(pdf)})

    return df.mapInPandas(run, schema)
