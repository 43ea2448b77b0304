"""Line dedup by a suffix array over line ids, built by distributed prefix doubling.

Documents, in id order, are one sequence of line ids in which each document ends with a symbol of its own. Ranks
of suffixes by their first line are doubled to two lines, four, ... by joining each suffix with the one that starts
where its sorted prefix ends, until nobody shares a rank. Suffixes of one rank at depth d are an interval of the
suffix array whose longest common prefix is d lines or more; all but the first of them in sequence order repeat an
earlier place. Their overlapping prefixes are the maximal repeated runs, which are deleted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, slices, texts_of

WHITE = " \t\n\x0b\x0c\r"
KEY = ["id", "th"]
LAST = (1 << 63) - 1


def _id(doc_id: str) -> Column:
    """Place of a document: null ids come last; rows of one id are told apart by their texts."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))


def line_ids(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, th, k, a, b): the k-th line with a word of each document, as 128 bits of hash. Rows equal in id and text are one document."""
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: F.translate(x, WHITE, "") != "")
    each = docs.select(_id(doc_id).alias("id"), F.xxhash64(text).alias("th"), F.posexplode(lines).alias("k", "line"))
    return each.select("id", "th", "k", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))


def numbered(scratch: Scratch, counted: DataFrame, by: list[str], name: str) -> DataFrame:
    """Adds `before`: the sum of n over the rows that sort before, for rows with distinct `by`.

    Sorted by range over all tasks; each adds up its own range, and the totals of the ranges, a number for each,
    are added up by another query.
    """

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            before = total + np.cumsum(n) - n
            total += int(n.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before), pa.array(np.full(len(n), part, np.int32))], [*batch.schema.names, "within", "part"])

    ranged = counted.repartitionByRange(*by).sortWithinPartitions(*by)
    schema = ", ".join(f"{c} {t}" for c, t in counted.dtypes)
    local = scratch.table(ranged.mapInArrow(add, f"{schema}, within long, part int"), name)
    parts = local.groupBy("part").agg(F.sum("n").alias("total"))
    offsets = parts.select("part", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    # a row for each partition of the sort
    return local.join(F.broadcast(offsets), "part").select(*counted.columns, (F.col("within") + F.col("offset")).alias("before"))


def _ranked(scratch: Scratch, places: DataFrame, by: list[str], name: str) -> DataFrame:
    """(id, th, k, r, first): places whose `by` others share, ranked by it among all such, and the first place of each rank."""
    counted = places.groupBy(*by).agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "k")).alias("first")).filter("n > 1")
    # the order is written, so that the join deals out both sides itself and can split a rank that many places share
    order = numbered(scratch, counted, by, f"order-{name}")
    return scratch.table(places.join(order, by).select(*KEY, "k", F.col("before").alias("r"), "first"), f"ranks-{name}")


def lcp_intervals(scratch: Scratch, lines: DataFrame, least: int) -> list[tuple[int, DataFrame]]:
    """The intervals of the suffix array with a common prefix of `least` lines or more, by prefixes of least, 2 least, 4 least ... lines.

    For each such depth, (id, th, k, r, first): the suffixes in intervals of this depth. r is the place of the
    interval among all of its depth, first the first of its suffixes in sequence order. A suffix whose rank nobody
    shares is in place and leaves; doubling ends when all have left, so the last depth is over half of the longest
    repeated run.
    """
    lines = scratch.table(lines.dropDuplicates([*KEY, "k"]), "lines")
    ranks, depth = _ranked(scratch, lines, ["a", "b"], "1"), 1
    out = []
    while not ranks.isEmpty():
        if depth >= least:
            out.append((depth, ranks))
        step = depth if depth >= least else min(depth, least - depth)
        after = ranks.select(*KEY, (F.col("k") - step).alias("k"), F.col("r").alias("r2"))
        pairs = scratch.table(ranks.select(*KEY, "k", "r").join(after, [*KEY, "k"]), f"pairs-{depth + step}")
        depth += step
        ranks = _ranked(scratch, pairs, ["r", "r2"], str(depth))
    return out


def repeats(intervals: list[tuple[int, DataFrame]]) -> DataFrame:
    """(id, th, k, n, first): the n lines from k on also stand at the earlier place `first`; for every depth at which they do."""
    out = None
    for depth, ranks in intervals:
        later = ranks.filter(F.struct(*KEY, "k") > F.col("first")).select(*KEY, "k", F.lit(depth).alias("n"), "first")
        out = later if out is None else out.unionByName(later)
    return out


def _merged(pieces: DataFrame, by: list[str]) -> DataFrame:
    """(by, k, n): unions of overlapping pieces of n lines from k on, with the least k and the whole length."""
    w = Window.partitionBy(*by).orderBy("k")
    end = F.max(F.col("k") + F.col("n")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = pieces.select(*by, "k", "n", F.when(F.col("k") < end, 0).otherwise(1).alias("new"))
    runs = new.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*by, "run").agg(F.min("k").alias("k"), (F.max(F.col("k") + F.col("n")) - F.min("k")).alias("n")).drop("run")


def maximal_runs(intervals: list[tuple[int, DataFrame]]) -> DataFrame:
    """(id, th, k, n): maximal runs of lines of a document of which each part is repeated from earlier places.

    A place whose longest earlier match has L lines, of depth d <= L < 2d, is itself in an interval of depth d, and
    so is the place d lines before the match's end: their prefixes overlap and make up the whole match.
    """
    return _merged(repeats(intervals).select(*KEY, "k", "n"), KEY)


def repeated_runs(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = 1) -> DataFrame:
    """(id, th, k, n_lines, copy_id, copy_k): runs of lines of docs with an earlier place that they are copied from; k counts lines with a word.

    Prefixes that follow each other in a document as their first copies do belong to one run. th is the hash of
    the text. No docs or no repeated lines, no rows.
    """
    scratch = Scratch(spark, "line_dedup")
    intervals = lcp_intervals(scratch, line_ids(docs, doc_id, text), min_lines)
    if not intervals:
        return spark.createDataFrame([], "id long, th long, k int, n_lines int, copy_id long, copy_k int")
    shift = F.col("k") - F.col("first.k")
    flat = repeats(intervals).select(*KEY, "k", "n", F.col("first.id").alias("copy_id"), F.col("first.th").alias("copy_th"), shift.alias("shift"))
    runs = _merged(flat, [*KEY, "copy_id", "copy_th", "shift"])
    return runs.select(*KEY, "k", F.col("n").alias("n_lines"), "copy_id", (F.col("k") - F.col("shift")).alias("copy_k"))


def _without(text: bytes, runs: list[dict[str, int]]) -> tuple[bytes, int, int]:
    """The text without the given runs of its lines with words, how many such lines it has, and how many are gone."""
    lines = text.split(b"\n")
    real = [i for i, x in enumerate(lines) if x.strip()]
    drop = {i for run in runs for i in real[run["k"] : run["k"] + run["n"]]}
    return (b"\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text), len(real), len(drop)


def dedup_lines(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = 1, digest: bool = False) -> DataFrame:
    """docs with later copies of runs of `min_lines` lines or more deleted from the text, all columns as they are.

    Lines are cut at line feeds and compared exactly; lines without a word belong to no run and stay. The earliest
    copy, by doc_id and line, stays. A null text stays null, an empty one empty; a text may become empty. Rows with
    a null id come last in order; rows equal in id and text are one document and end up the same. With `digest`,
    the rows are doc_id, n_lines (with a word), n_removed, kept_sha256 (of the text that is left; null as empty).
    """
    scratch = Scratch(spark, "line_dedup")
    intervals = lcp_intervals(scratch, line_ids(docs, doc_id, text), min_lines)
    runs = maximal_runs(intervals) if intervals else spark.createDataFrame([], "id long, th long, k int, n int")
    gone = scratch.table(runs.groupBy(*KEY).agg(F.collect_list(F.struct("k", "n")).alias("gone")), "gone")
    names = [f"_{i}" for i in range(len(docs.columns))]
    wanted = [docs.columns.index(doc_id), docs.columns.index(text)] if digest else [*range(len(names))]
    at = names[docs.columns.index(text)]
    keyed = docs.toDF(*names).select(*(names[i] for i in wanted), _id(names[docs.columns.index(doc_id)]).alias("id"), F.xxhash64(at).alias("th"))
    joined = keyed.join(gone.hint("merge"), KEY, "left").drop(*KEY)  # texts are dealt out the same way at every size
    kept_types = [docs.schema[i] for i in wanted]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            new = [_without(t, g or []) for t, g in zip(texts_of(batch, at), batch.column("gone").to_pylist(), strict=True)]
            if digest:
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(names[wanted[0]]).cast(pa.int64()), "n_lines": pa.array([n for _, n, _ in new], pa.int64()), "n_removed": pa.array([k for _, _, k in new], pa.int64()), "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t, _, _ in new], pa.string())})
            else:
                null = batch.column(at).is_null().to_numpy(zero_copy_only=False)
                texts = pa.array([t for t, _, _ in new], pa.binary(), mask=null).cast(pa.string())
                yield pa.RecordBatch.from_arrays([texts if names[i] == at else batch.column(names[i]) for i in wanted], [names[i] for i in wanted])

    if digest:
        return joined.mapInArrow(cut, "doc_id long, n_lines long, n_removed long, kept_sha256 string")
    schema = ", ".join(f"{names[i]} {f.dataType.simpleString()}" for i, f in zip(wanted, kept_types, strict=True))
    return joined.mapInArrow(cut, schema).toDF(*docs.columns)
