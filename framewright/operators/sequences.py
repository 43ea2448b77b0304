"""Building token sequences with aligned masks, and packing them into chunks and batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import scratch

#: Fixed values of the sequence format.
BOS, EOS, END_OF_FRAME, END_OF_VISION = 1, 2, 8192, 8193
TOKEN = "struct<token: int, loss: float, vision: boolean, delta: boolean, action: boolean>"


def tokens(ids: Column, loss: float, vision: bool = False, delta: bool = False, action: bool = False) -> Column:
    """An array of token structs with equal masks."""
    return F.transform(ids, lambda t: F.struct(t.cast("int").alias("token"), F.lit(loss).cast("float").alias("loss"), F.lit(vision).alias("vision"), F.lit(delta).alias("delta"), F.lit(action).alias("action")))


def literal(ids: list[int]) -> Column:
    return F.array(*(F.lit(i) for i in ids)) if ids else F.array().cast("array<int>")


def code_points(c: Column) -> Column:
    """A tokenizer without a model: a token for each UTF-8 byte, by value."""
    raw = F.hex(F.encode(c, "UTF-8"))
    n = F.length(raw) / 2
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n.cast("int")), lambda i: F.conv(F.substring(raw, 2 * i - 1, F.lit(2)), 16, 10).cast("int"))).otherwise(F.array().cast("array<int>"))


def with_bytes(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds `name`: what code_points gives for the whole text, in time that grows with its length, not with the square of it."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = pc.fill_null(batch.column(text), "").cast(pa.large_binary())
            ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1] if len(raw) else np.zeros(1, np.int64)
            data = raw.buffers()[2]
            values = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
            lists = pa.ListArray.from_arrays(pa.array((ends - ends[0]).astype(np.int32)), pa.array(values.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, name])

    types = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return df.mapInArrow(add, f"{types}, `{name}` array<int>")


@dataclass
class Spec:
    """Fields of a sequence, in order: "[a]" bears no loss, "a+b" joins texts, names with vision, delta or action are code arrays."""

    fields: str
    per_frame: int = 256
    max_frames: int = -1
    bos: bool = True
    eos: bool = True
    prepend: str = ""
    separator: str = " "
    brackets: dict[str, tuple[list[int], list[int]]] = field(default_factory=lambda: {"vision": ([3], [4]), "delta": ([5], [6]), "action": ([7], [8])})


def vision_block(codes: Column, per_frame: int, max_frames: int) -> Column:
    """Frames of codes, each closed by a token: the last one by another. Too many frames are sampled evenly."""
    from ..functions.arrays import frames_of

    frames = frames_of(codes, per_frame)
    if max_frames > 0:
        n = F.size(frames)
        picked = F.transform(F.sequence(F.lit(0), F.lit(max_frames - 1)), lambda i: F.get(frames, F.when(i == max_frames - 1, n - 1).otherwise((i * ((n - 1) / F.lit(float(max(max_frames - 1, 1))))).cast("int")) if max_frames > 1 else F.lit(0)))
        frames = F.when(n > max_frames, picked).otherwise(frames)
    last = F.size(frames) - 1
    return F.flatten(F.transform(frames, lambda f, i: F.concat(f, F.array(F.when(i == last, END_OF_VISION).otherwise(END_OF_FRAME)))))


def build(spec: Spec, tokenize=code_points) -> Column:
    """One array of (token, loss, vision, delta, action) from a row's columns; masks can't get out of step."""
    parts: list[Column] = [tokens(literal([BOS]), 0.0)] if spec.bos else []
    for k, name in enumerate(spec.fields.split(",")):
        quiet = name.startswith("[") and name.endswith("]")
        name, loss = (name[1:-1], 0.0) if quiet else (name, 1.0)
        kind = next((b for b in spec.brackets if b in name), None)
        if name in ("<|bos|>", "<|eos|>"):
            parts.append(tokens(literal([BOS if name == "<|bos|>" else EOS]), loss))
        elif kind:
            before, after = spec.brackets[kind]
            body = vision_block(F.col(name), spec.per_frame, spec.max_frames) if kind == "vision" else F.col(name)
            parts += [tokens(literal(before), loss), tokens(body, loss, **{kind: True}), tokens(literal(after), loss)]
        else:
            text = F.concat_ws(spec.separator, *name.split("+"))
            parts.append(tokens(tokenize(F.concat(F.lit(spec.prepend), text) if k == 0 and spec.prepend else text), loss))
    if spec.eos:
        parts.append(tokens(literal([EOS]), 1.0))
    return F.concat(*parts)


#: Which fields each kind of dataset builds.
KINDS = {
    "text": "[instruction],answer",
    "vision_text": "[instruction],vision",
    "delta_vision_text": "[instruction],[vision],delta",
    "vision_action": "[instruction],[vision],action",
    "delta_vision_action": "[instruction],[vision],delta,action",
    "delta_text": "[instruction],delta",
}


def sequences(df: DataFrame, kind: str, **options: object) -> DataFrame:
    """df with `seq` for a kind of dataset."""
    return df.withColumn("seq", build(Spec(KINDS[kind], **options)))


def global_order(df: DataFrame, by: list[str], name: str, size: str | None = None) -> DataFrame:
    """Adds a running position over all rows in an order: of rows, or of the sizes in a column.

    Rows are sorted by range over all tasks, each counts its own, and only the totals of the ranges, one number
    each, are added up in one place. What the tasks counted is written to the shared folder, so a lost executor
    can't have it sampled again. The order must be total.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *by).sortWithinPartitions(*by)
    types = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            sizes = batch.column(size).to_numpy() if size else np.ones(batch.num_rows, np.int64)
            within = total + np.cumsum(sizes) - sizes
            total += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(within.astype(np.int64)), pa.array(np.full(len(sizes), part, np.int32))], [*batch.schema.names, "_within", "_part"])

    counted = ranged.mapInArrow(count, f"{types}, _within long, _part int")
    counted.write.parquet(path := scratch(spark, "order"))
    local = spark.read.schema(counted.schema).parquet(path)
    totals = local.groupBy("_part").agg(F.max(F.col("_within") + (F.col(size) if size else 1)).alias("_n"))
    offsets = totals.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    # one row for each range
    return local.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_within") + F.col("_offset")).drop("_within", "_offset", "_part")


def concat_and_chunk(df: DataFrame, by: list[str], seq: str, chunk: int) -> DataFrame:
    """(chunk_id, inputs, targets): all sequences joined in order and cut; chunk k is there if over (k + 1) * chunk + 1 tokens are.

    Targets are the inputs moved by one, so a chunk's last target is the next one's first input. Each sequence
    sends its slices to the chunks that they belong to; no task holds more than its chunks.
    """
    sized = df.select(*by, F.col(seq).alias("_seq"), F.size(seq).cast("long").alias("_size")).filter("_size > 0")
    placed = global_order(sized, by, "_start", "_size")
    total = placed.agg(F.coalesce(F.max(F.col("_start") + F.col("_size")), F.lit(0)).alias("_total"))  # one row
    first = F.greatest(F.floor((F.col("_start") - 1) / chunk), F.lit(0))
    reach = F.explode(F.sequence(first.cast("long"), F.floor((F.col("_start") + F.col("_size") - 1) / chunk).cast("long")))
    parts = placed.select("_seq", "_start", "_size", reach.alias("chunk_id"))
    begin = F.greatest(F.col("_start"), F.col("chunk_id") * chunk)
    end = F.least(F.col("_start") + F.col("_size"), (F.col("chunk_id") + 1) * chunk + 1)
    cut = parts.filter(end > begin).select("chunk_id", begin.alias("_at"), F.slice("_seq", (begin - F.col("_start") + 1).cast("int"), (end - begin).cast("int")).alias("_piece"))
    whole = cut.groupBy("chunk_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_piece"))), lambda x: x["_piece"])).alias("_all"))
    kept = whole.crossJoin(F.broadcast(total)).filter((F.col("chunk_id") + 1) * chunk + 1 < F.col("_total"))
    return kept.select("chunk_id", F.slice("_all", 1, chunk).alias("inputs"), F.slice("_all", 2, chunk).alias("targets"))


def padded(seq: Column, length: int, pad: Column, aligned: bool = True) -> tuple[Column, Column, Column]:
    """(inputs, targets, loss of targets) of one row in pad mode.

    Not aligned, the loss mask of a cut sequence is one place early against its targets, as a known quirk has it.
    """
    from ..functions.arrays import pad_right

    whole = pad_right(seq, length + 1, pad)
    loss = F.transform(F.slice(whole, 2, length), lambda x: x["loss"])
    if not aligned:
        early = F.transform(pad_right(F.slice(seq, 2, length + 1), length + 1, pad), lambda x: x["loss"])
        loss = F.when(F.size(seq) > length + 1, F.slice(early, 2, length)).otherwise(loss)
    ids = lambda a: F.transform(a, lambda x: x["token"])
    return ids(F.slice(whole, 1, length)), ids(F.slice(whole, 2, length)), loss


def batches_by_count(df: DataFrame, by: list[str], size: int, keep_partial: bool) -> DataFrame:
    """Adds batch_id and row_in_batch in an order; an incomplete last batch is kept or left out."""
    placed = global_order(df, by, "_place").withColumns({"batch_id": F.floor(F.col("_place") / size), "row_in_batch": F.col("_place") % size})
    if not keep_partial:
        n = placed.agg(F.count("*").alias("_n"))  # one row
        placed = placed.crossJoin(F.broadcast(n)).filter((F.col("batch_id") + 1) * size <= F.col("_n")).drop("_n")
    return placed.drop("_place")


def shard(a: Column, rank: int, ranks: int, length: int) -> Column:
    """The part of a sequence dimension that one rank holds."""
    return F.slice(a, rank * (length // ranks) + 1, length // ranks)


def forced_end_of_frame(token: Column, position: Column, per_frame: int = 256) -> Column:
    """Generated tokens, with the end-of-frame token at every (per_frame + 1)-th place."""
    return F.when((position + 1) % (per_frame + 1) == 0, END_OF_FRAME).otherwise(token)


def left_padded_prompt(prompt: Column, vision: Column, suffix: Column, length: int, pad: int) -> Column:
    """Text padded on the left to a length, then vision codes, then a suffix."""
    kept = F.slice(prompt, F.greatest(F.size(prompt) - length + 1, F.lit(1)), length)
    return F.concat(F.array_repeat(F.lit(pad), F.greatest(F.lit(length) - F.size(prompt), F.lit(0))), kept, vision, suffix)
