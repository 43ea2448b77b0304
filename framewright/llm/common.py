"""What the operators share: tables in the cluster's shared folder, slices of texts, words as arrays of codes."""

from __future__ import annotations

import atexit
import contextlib
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no shared folder, as in tests on one machine.
LOCAL_SHARED_DIR = "file:///tmp/checkpoints"
#: Bytes of text that a task holds as Python objects at a time; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20
SPACE_CLASS = r"\x20\x09-\x0D"

_open: dict[str, list[Scratch]] = {}
_owners: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else a local one where there is one machine only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (folder or LOCAL_SHARED_DIR).rstrip("/")


def delete(uri: str) -> None:
    """Removes a folder of the shared store; one that is gone already is no error."""
    with contextlib.suppress(FileNotFoundError, OSError, pa.ArrowInvalid):
        filesystem, path = store(uri)
        filesystem.delete_dir(path)


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI (file, hdfs, s3, gs ...); a bare path is local."""
    return pafs.FileSystem.from_uri(uri if re.match(r"\w+:", uri) else f"file://{uri}")


def is_scan(df: DataFrame) -> bool:
    """Whether df is files with columns chosen and rows filtered, so that its partitions are the same each time."""

    def plain(plan: object) -> bool:
        children = plan.children()
        return plan.nodeName() in ("Project", "Filter", "LogicalRelation", "RelationV2") and all(plain(children.apply(i)) for i in range(children.size()))

    plan = df._jdf.queryExecution().optimizedPlan()
    return plan.deterministic() and plain(plan)


class Scratch:
    """A folder in the shared store for one run of an operator.

    Tables written here cut lineage and outlive lost executors. Results read them lazily, so the folder
    lives until `free` is called with its owner's name, or until the driver ends.
    """

    def __init__(self, spark: SparkSession, owner: str) -> None:
        self.spark, self.uri = spark, f"{shared_dir(spark)}/{owner}-{uuid.uuid4().hex[:12]}"
        _open.setdefault(_owners[-1] if _owners else owner, []).append(self)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df as Parquet and returns a frame that reads it back."""
        df.write.option("compression", "zstd").parquet(path := f"{self.uri}/{name}")
        return self.spark.read.schema(df.schema).parquet(path)


def free(owner: str) -> None:
    """Deletes what earlier runs of this owner have left; their results must have been written by then."""
    for scratch in _open.pop(owner, []):
        delete(scratch.uri)


def hand_over(owner: str, new: str) -> None:
    """Gives one owner's folders to another, whose results still need them."""
    _open.setdefault(new, []).extend(_open.pop(owner, []))


@contextlib.contextmanager
def owned(owner: str) -> Iterator[None]:
    """Folders begun inside belong to this owner, whichever operator begins them."""
    _owners.append(owner)
    try:
        yield
    finally:
        _owners.pop()


atexit.register(lambda: [free(x) for x in [*_open]])


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches into runs of rows with about `limit` bytes of text; no row is cut, none is lost."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def texts_of(batch: pa.RecordBatch, text: str) -> list[bytes]:
    """UTF-8 texts; null counts as empty."""
    column = batch.column(text)
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


_SPACE = np.array([chr(c) in " \t\n\x0b\x0c\r" for c in range(256)])


class Words:
    """The words between ASCII white space of several texts, as places in their joined bytes."""

    def __init__(self, texts: list[bytes]) -> None:
        self.raw = np.frombuffer(b" ".join(texts) + b" " * 9, np.uint8)
        space = _SPACE[self.raw]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate([[0], edge])
        self.first, self.end = edge[::2], edge[1::2]
        #: Index of each text's first word, and the number of all words.
        size = np.array([len(t) + 1 for t in texts], np.int64)
        self.bounds = np.append(np.cumsum(size) - size, len(self.raw))
        self.start = np.searchsorted(self.first, self.bounds)

    def __len__(self) -> int:
        return len(self.first)

    def hashes(self, lane: int) -> np.ndarray:
        """64 bits of each word, eight bytes of it at a time; words of up to eight bytes can't share them in one length."""
        eight = np.ndarray((len(self.raw) - 7,), "<u8", self.raw, strides=(1,))
        size = self.end - self.first
        with np.errstate(over="ignore"):
            h = size.astype(np.uint64) * np.uint64(BASES[1 - lane]) + np.uint64(BASES[lane])
            live, at = np.arange(len(size)), self.first
            while len(live):
                left = size[live] - (at - self.first[live])
                mask = np.where(left >= 8, np.uint64((1 << 64) - 1), (np.uint64(1) << (8 * np.minimum(left, 7)).astype(np.uint64)) - np.uint64(1))
                h[live] = mix(h[live] ^ (eight[at] & mask))
                more = left > 8
                live, at = live[more], at[more] + 8
        return h

    def kept(self, gone: np.ndarray) -> list[bytes]:
        """Each text's words that are not gone, joined by spaces."""
        keep = ~gone
        step = np.zeros(len(self.raw) + 1, np.int8)
        step[self.first[keep]] += 1
        step[self.end[keep] + 1] -= 1  # with the white space after it
        inside = np.cumsum(step[:-1]).astype(bool)
        raw = self.raw.copy()
        raw[self.end[keep]] = 32
        out = raw[inside].tobytes()
        at = np.concatenate([[0], np.cumsum(inside)])[self.bounds].tolist()
        return [out[a : max(a, b - 1)] for a, b in zip(at, at[1:], strict=False)]


#: Odd multipliers of two independent polynomials over word hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads each bit over all others."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_hashes(h: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """64-bit hash of each run of `width` words in a sequence of word hashes, whatever text they lie in."""
    n = len(h)
    if n < width:
        return np.zeros(0, np.uint64)
    base, total, run, k, at, left = BASES[lane], np.zeros(n - width + 1, np.uint64), h, 1, 0, width
    with np.errstate(over="ignore"):
        while True:  # Horner over doubling runs: the run of 2k words from i is run_k[i] * base**k + run_k[i + k]
            if left & k:
                total = total * np.uint64(pow(base, k, 1 << 64)) + run[at : at + n - width + 1]
                at, left = at + k, left - k
            if not left:
                return mix(total)
            run = run[: len(run) - k] * np.uint64(pow(base, k, 1 << 64)) + run[k:]
            k *= 2
