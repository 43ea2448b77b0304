"""Token counts from an exact histogram of encoded lengths."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, slices, texts_of
from .tokens import TOKENIZER, encoder

#: Lengths whose suffix sums one task adds up; blocks are summed on their own.
BLOCK = 128


def length_histogram(docs: DataFrame, text: str = "text", tokenizer: str = TOKENIZER, end_tokens: int = 1) -> DataFrame:
    """(length, n_docs): how many documents encode to so many tokens, `end_tokens` included.

    Each task counts its documents before the shuffle, so that carries at most a row for each length and task.
    A null or empty text has no tokens besides the end tokens; repeated rows count each; no rows, no lengths.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for batch in slices(batches, "text"):
            seen.update(map(len, encoder(tokenizer)([t.decode() for t in texts_of(batch, "text")])))
        yield pa.RecordBatch.from_pydict({"length": pa.array([n + end_tokens for n in seen], pa.int64()), "n": pa.array(list(seen.values()), pa.int64())})

    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, "length long, n long")
    return counted.groupBy("length").agg(F.sum("n").alias("n_docs"))


def context_totals(histogram: DataFrame) -> DataFrame:
    """What a length histogram says of each context limit that is a length: one row per length.

    length, n_docs; docs_at_least and tokens_at_least: documents of this length or more and their tokens;
    truncated_tokens: tokens left when every document is cut to this limit; docs_up_to and quantile: documents
    of this length or less, as a number and as a share. `at_limits` and `quantiles` answer for any limit or share.
    """
    h = histogram.withColumns({"tokens": F.col("length") * F.col("n_docs"), "block": F.floor(F.col("length") / BLOCK)})
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    # the longest text bounds the number of blocks, so one task can hold their totals
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", *(F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in "dt"), F.sum("d").over(Window.partitionBy()).alias("all_d"), F.sum("t").over(Window.partitionBy()).alias("all_t"))
    within = Window.partitionBy("block").orderBy(F.desc("length"))
    h = h.join(blocks, "block").withColumns({"docs_at_least": F.sum("n_docs").over(within) + F.col("d_later"), "tokens_at_least": F.sum("tokens").over(within) + F.col("t_later")})
    up_to = F.col("all_d") - F.col("docs_at_least") + F.col("n_docs")
    return h.select(
        "length",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (F.col("all_t") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_tokens"),
        up_to.alias("docs_up_to"),
        (up_to / F.col("all_d")).alias("quantile"),
    )


def at_limits(totals: DataFrame, limits: list[int]) -> DataFrame:
    """limit, docs_at_least, tokens_at_least, truncated_tokens for any context limits, from the rows of context_totals.

    A limit has the suffix sums of the least length from it on; beyond the longest text, none. No rows give zeros.
    """

    def answer(limit: int) -> Column:
        longest = F.when(F.col("length") >= limit, F.struct("docs_at_least", "tokens_at_least"))
        rest = F.max(longest)  # of suffix sums, the largest is that of the least length
        docs, tokens = (F.coalesce(rest[c], F.lit(0)) for c in ("docs_at_least", "tokens_at_least"))
        everything = F.coalesce(F.max("tokens_at_least"), F.lit(0))
        return F.struct(F.lit(limit).cast("long").alias("limit"), docs.alias("docs_at_least"), tokens.alias("tokens_at_least"), (everything - tokens + docs * limit).alias("truncated_tokens"))

    return totals.agg(F.array(*map(answer, limits)).alias("a")).select(F.inline("a"))


def quantiles(totals: DataFrame, shares: list[float]) -> DataFrame:
    """share, length: the least length that such a share of the documents doesn't exceed; null without documents."""
    each = [F.struct(F.lit(float(p)).alias("share"), F.min(F.when(F.col("quantile") >= p, F.col("length"))).alias("length")) for p in shares]
    return totals.agg(F.array(*each).alias("a")).select(F.inline("a"))


def token_totals(spark: SparkSession, docs: DataFrame, text: str = "text", tokenizer: str = TOKENIZER, end_tokens: int = 1) -> DataFrame:
    """context_totals of docs. The histogram is written first, as it is read twice and the texts shall be encoded once."""
    return context_totals(Scratch(spark, "token_counts").table(length_histogram(docs, text, tokenizer, end_tokens), "histogram"))
