"""Token ids as Arrow files of equal-length sequences and masks, which are read by memory map without a copy."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, slices, store, texts_of
from .tokens import TOKENIZER, encoder, partitions

#: Sequences in each record batch of a file; all but a file's last batch have so many.
BATCH_ROWS = 256

MANIFEST = "shard int, ids_uri string, docs_uri string, n_docs long, n_tokens long"


def _publish(uri: str, schema: pa.Schema, batches: Iterable[pa.RecordBatch]) -> None:
    """Writes an Arrow file. Its name is that of this attempt: the manifest names the files of the attempt that counts, and no other touches them."""
    filesystem, path = store(uri)
    filesystem.create_dir(path.rpartition("/")[0], recursive=True)
    with filesystem.open_output_stream(path) as out, pa.ipc.new_file(out, schema) as writer:
        for batch in batches:
            writer.write_batch(batch)


def write_token_files(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, end_id: int = 0, width: int = 1024) -> DataFrame:
    """Encodes documents in ascending id order (null ids first) into files below `folder`; returns the manifest to be written.

    A shard N has two Arrow files. ids-N-attempt.arrow: `ids`, fixed-size lists of `width` unsigned integers (16 bits if
    the vocabulary fits), and `mask`, fixed-size lists of booleans that are false on the padding, which only a
    shard's last row has. docs-N-attempt.arrow: doc_id, start and length of each document in the shard. Sorting is by
    range, so shards follow each other in id order; rows of one id, or without one, follow each other by a hash of
    their texts, so that many of them are dealt over tasks too. A null or empty text is its end id alone; repeated
    rows are written each; without rows there is no shard with documents.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(tokenizer), TaskContext.get().partitionId()
        index: list[pa.RecordBatch] = []
        total = 0
        dtype = encode.dtype
        ids_schema = pa.schema({"ids": pa.list_(pa.from_numpy_dtype(dtype), width), "mask": pa.list_(pa.bool_(), width)})

        def rows(ids: np.ndarray, real: int) -> pa.RecordBatch:
            mask = pa.array(np.arange(len(ids)) < real)
            return pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(ids), width), pa.FixedSizeListArray.from_arrays(mask, width)], schema=ids_schema)

        def sequences() -> Iterator[pa.RecordBatch]:
            nonlocal total
            full, held, n_held = BATCH_ROWS * width, [], 0
            for batch in slices(batches, "text"):
                encoded = encode([t.decode() for t in texts_of(batch, "text")])
                lengths = np.array([len(e) + 1 for e in encoded], np.int64)
                starts = total + np.cumsum(lengths) - lengths
                total += int(lengths.sum())
                index.append(pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(starts), pa.array(lengths)], ["doc_id", "start", "length"]))
                for e in encoded:
                    held += [e, np.array([end_id], dtype)]
                    n_held += len(e) + 1
                if n_held >= full:
                    flat = np.concatenate(held)
                    for i in range(0, n_held - full + 1, full):
                        yield rows(flat[i : i + full], full)
                    held, n_held = [flat[n_held // full * full :]], n_held % full
            if n_held:
                flat = np.concatenate(held)
                yield rows(np.concatenate([flat, np.zeros(-n_held % width, dtype)]), n_held)

        name = f"{shard:06}-{TaskContext.get().taskAttemptId()}.arrow"
        ids_uri, docs_uri = f"{folder}/ids-{name}", f"{folder}/docs-{name}"
        _publish(ids_uri, ids_schema, sequences())
        _publish(docs_uri, pa.schema({"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64()}), index)
        if total:
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "ids_uri": [ids_uri], "docs_uri": [docs_uri], "n_docs": [sum(b.num_rows for b in index)], "n_tokens": [total]})

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    return chosen.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order).mapInArrow(write, MANIFEST)


def open_arrow(uri: str) -> pa.ipc.RecordBatchFileReader:
    """A reader of one file: by memory map where the store is local, so that batches are views of the file."""
    filesystem, path = store(uri)
    return pa.ipc.open_file(pa.memory_map(path) if filesystem.type_name == "local" else filesystem.open_input_file(path))


def ids_between(reader: pa.ipc.RecordBatchFileReader, start: int, length: int, width: int) -> Iterator[np.ndarray]:
    """The ids from a place in a shard on, as views of its batches, each found by arithmetic alone."""
    full = BATCH_ROWS * width
    while length > 0:
        k, at = divmod(start, full)
        piece = reader.get_batch(k).column("ids").flatten().to_numpy(zero_copy_only=True)[at : at + length]
        yield piece
        start, length = start + len(piece), length - len(piece)


def read_documents(manifest: DataFrame, width: int = 1024) -> DataFrame:
    """Reads every file of a manifest back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in (row for batch in batches for row in batch.to_pylist()):
            ids, docs = open_arrow(shard["ids_uri"]), open_arrow(shard["docs_uri"])
            for k in range(docs.num_record_batches):
                d = docs.get_batch(k)
                starts, lengths = d.column("start").to_numpy(), d.column("length").to_numpy()
                flat = np.concatenate([x.astype("<u4") for x in ids_between(ids, int(starts[0]), int(lengths.sum()), width)])
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(flat[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([d.column("doc_id"), pa.array(starts + shard["before"]), pa.array(lengths), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # a row for each shard, some ten thousand even at 100 TB
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.withColumn("before", F.coalesce(before, F.lit(0)))
    return placed.repartition(partitions(manifest.sparkSession), "shard").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_digest(spark: SparkSession, docs: DataFrame, **options: object) -> DataFrame:
    """Writes documents as token files in the shared folder and reads all of them back."""
    scratch = Scratch(spark, "token_files")
    manifest = scratch.table(write_token_files(docs, f"{scratch.uri}/shards", **options), "manifest")
    return read_documents(manifest)
