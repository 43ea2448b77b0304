"""Substring dedup: a count-min sketch finds windows that may repeat; only these are then grouped exactly.

Texts are never shuffled. Each task reads its documents three times: it sends a sketch of its windows, sends the
windows whose merged cells are counted twice or more, and removes the words of those that do repeat. A sketch has as
many cells as all windows need, so what a task sends of it is its cells that aren't zero, as sorted gaps. Sketches are
cut by hash into shards of fixed size, which other tasks add up; their answers lie in the shared folder, by scan
partition. Windows are grouped, and removed, by 128 bits of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, Words, is_scan, slices, store, texts_of, window_hashes
from .tokens import partitions

#: Bits of a cell's number, rows of the sketch, and windows for which a shard is made.
CELL_BITS, ROWS, SHARD_WINDOWS = 24, 2, 1 << 22
#: Bytes of text of one message's windows.
CHUNK_BYTES = 8 << 20
_SPREAD = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)


def pack_cells(cells: np.ndarray) -> bytes:
    """Sorted cells, twice where a chunk has them twice or more, as gaps of 16 bits if all fit."""
    gaps = np.diff(cells, prepend=np.uint32(0)).astype(np.uint32)
    small = len(gaps) == 0 or gaps[1:].max(initial=0) < 1 << 16
    return b"\1" + cells[:1].astype("<u4").tobytes() + gaps[1:].astype("<u2").tobytes() if small else b"\0" + cells.astype("<u4").tobytes()


def unpack_cells(raw: bytes) -> np.ndarray:
    if raw[:1] == b"\0":
        return np.frombuffer(raw, "<u4", offset=1).astype(np.int64)
    if len(raw) == 1:
        return np.zeros(0, np.int64)
    return np.cumsum(np.concatenate([np.frombuffer(raw[1:5], "<u4"), np.frombuffer(raw, "<u2", offset=5)]).astype(np.int64))


class Chunk:
    """The windows of a slice of documents: hashes of those within one text, and where they start in its words."""

    def __init__(self, texts: list[bytes], width: int) -> None:
        self.words = Words(texts)
        self.start, self.width = self.words.start, width
        n = max(0, len(self.words) - width + 1)
        last = np.repeat(self.start[1:], np.diff(self.start)) - width
        self.place = np.flatnonzero(last[:n] >= np.arange(n))

    def hashes(self, lane: int) -> np.ndarray:
        return window_hashes(self.words.hashes(lane), self.width, lane)[self.place]


def digest_of(h: np.ndarray) -> int:
    """Tells whether a chunk has the same windows as when it was read before."""
    return int(np.bitwise_xor.reduce(h, initial=np.uint64(len(h))).view(np.int64)) if len(h) else 0


def same_chunk(replies: Iterable[dict], h: np.ndarray) -> None:
    if any(r["digest"] != digest_of(h) for r in replies):
        raise RuntimeError("a scan partition has other rows than before; write the input to a table first")


def shard_of(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


def cells_of(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Shard and cell of each window in a row of the sketch, as one number that sorts by shard."""
    with np.errstate(over="ignore"):
        cell = (h ^ (h >> np.uint64(29))) * np.uint64(_SPREAD[row]) >> np.uint64(64 - CELL_BITS)
    return shard_of(h, bits) << CELL_BITS | cell.astype(np.int64)


def _sort_twice(cells: np.ndarray) -> np.ndarray:
    """Sorted, with at most two of each: a cell's count matters up to two only."""
    cells = np.sort(cells)
    return cells[np.concatenate([np.ones(min(2, len(cells)), bool), cells[2:] != cells[:-2]])]


def _by_shard(sorted_cells: np.ndarray, bits: int) -> list[np.ndarray]:
    ends = np.searchsorted(sorted_cells, np.arange(1, (1 << bits) + 1) << CELL_BITS)
    return np.split(sorted_cells, ends[:-1])


def sketch_message(h: np.ndarray, bits: int) -> Iterator[tuple[int, list[bytes]]]:
    """For each shard in which the chunk has windows: its cells in each row."""
    rows = [_by_shard(_sort_twice(cells_of(h, r, bits)), bits) for r in range(ROWS)]
    for shard, parts in enumerate(zip(*rows, strict=True)):
        if len(parts[0]):
            yield shard, [pack_cells((p & ((1 << CELL_BITS) - 1)).astype(np.uint32)) for p in parts]


def merge_sketches(messages: list[bytes]) -> list[bytes]:
    """Adds one row of all sketches of a shard; for each message, a bit for each of its cells: counted twice or more."""
    table = np.zeros(1 << CELL_BITS, np.uint8)
    cells = []
    for m in messages:
        c = unpack_cells(m)
        new = np.concatenate([np.ones(min(1, len(c)), bool), c[1:] != c[:-1]])
        once, number = c[new], np.diff(np.append(np.flatnonzero(new), len(c)))
        table[once] = np.minimum(table[once] + number, 2)
        cells.append(once)
    return [np.packbits(table[c] >= 2).tobytes() for c in cells]


def repeated_of(windows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Exact groups over all messages (both hashes, whether the chunk has it more than once): for each, which of its windows repeat."""
    a, b, many = (np.concatenate(x) for x in zip(*windows, strict=True))
    order = np.lexsort((b, a))
    new = np.concatenate([np.ones(min(1, len(a)), bool), (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])
    group = np.cumsum(new) - 1
    total = np.bincount(group, 1 + many[order])
    out = np.empty(len(a), bool)
    out[order] = total[group] >= 2
    return np.split(out, np.cumsum([len(x) for x, _, _ in windows])[:-1])


def among(a: np.ndarray, b: np.ndarray, many_a: np.ndarray, many_b: np.ndarray) -> np.ndarray:
    """For each pair (a, b), whether it is one of the given, which are sorted by a."""
    hit = np.zeros(len(a), bool)
    at = np.searchsorted(many_a, a)
    live = np.arange(len(a))
    while len(live):
        live = live[at[live] < len(many_a)]
        live = live[many_a[at[live]] == a[live]]
        hit[live] |= many_b[at[live]] == b[live]
        live = live[~hit[live]]
        at[live] += 1
    return hit


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8")


def repeated_windows(scratch: Scratch, docs: DataFrame, text: str, width: int) -> str:
    """Finds the windows of `width` words that start twice or more; returns the folder with each partition's, by hash."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bits = max(0, (int(size) // 6 // SHARD_WINDOWS).bit_length())
    n = partitions(docs.sparkSession)

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(slices(batches, text, CHUNK_BYTES)):
            h = Chunk(texts_of(batch, text), width).hashes(0)
            rows = [*sketch_message(h, bits)]
            yield pa.RecordBatch.from_pydict({"digest": pa.array([digest_of(h)] * len(rows), pa.int64()), "shard": pa.array([s for s, _ in rows], pa.int32()), "part": pa.array([part] * len(rows), pa.int32()), "chunk": pa.array([k] * len(rows), pa.int32())} | {f"r{r}": pa.array([p[r] for _, p in rows], pa.binary()) for r in range(ROWS)})

    def merge(table: pa.Table) -> pa.Table:
        return table.select(["digest", "shard", "part", "chunk"]).append_column("m0", pa.array(merge_sketches(table.column("r0").to_pylist()), pa.binary())).append_column("m1", pa.array(merge_sketches(table.column("r1").to_pylist()), pa.binary()))

    asked = docs.mapInArrow(ask, "digest long, shard int, part int, chunk int, r0 binary, r1 binary")
    answers = asked.groupBy("shard").applyInArrow(merge, "digest long, shard int, part int, chunk int, m0 binary, m1 binary")
    folder = _answers(scratch, answers, "sketch", n)

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        replies = _read(folder, part)
        for k, batch in enumerate(slices(batches, text, CHUNK_BYTES)):
            chunk = Chunk(texts_of(batch, text), width)
            a = chunk.hashes(0)
            held, digest, maybe = replies.get(k, {}), digest_of(a), np.ones(len(a), bool)
            same_chunk(held.values(), a)
            for r in range(ROWS):  # estimated repeated: every row's cell is
                cells = cells_of(a, r, bits)
                order = np.argsort(cells)
                new = np.concatenate([np.ones(min(1, len(a)), bool), np.diff(cells[order]) != 0])
                parts = [len(p) for p in _by_shard(cells[order][new], bits)]
                bit = [np.unpackbits(np.frombuffer(held[s][f"m{r}"], np.uint8), count=n) for s, n in enumerate(parts) if n]
                maybe[order] &= np.concatenate(bit).astype(bool)[np.cumsum(new) - 1] if bit else False
            live = np.flatnonzero(maybe)
            a, b = a[live], chunk.hashes(1)[live]
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.flatnonzero(np.concatenate([np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            many = np.diff(np.append(new, len(a))) > 1
            a, b = a[new], b[new]
            ends = np.searchsorted(shard_of(a, bits), np.arange((1 << bits) + 1))
            rows = [(s, i, j) for s, (i, j) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)) if j > i]
            yield pa.RecordBatch.from_pydict({"digest": pa.array([digest] * len(rows), pa.int64()), "shard": pa.array([s for s, _, _ in rows], pa.int32()), "part": pa.array([part] * len(rows), pa.int32()), "chunk": pa.array([k] * len(rows), pa.int32())} | {c: pa.array([x[i:j].tobytes() for _, i, j in rows], pa.binary()) for c, x in (("a", a), ("b", b), ("many", many))})

    def group(table: pa.Table) -> pa.Table:
        windows = [(_numbers(a), _numbers(b), np.frombuffer(m, bool)) for a, b, m in zip(*(table.column(c).to_pylist() for c in ("a", "b", "many")), strict=True)]
        out = table.select(["digest", "part", "chunk"])
        for lane, name in enumerate("ab"):
            out = out.append_column(name, pa.array([w[lane][r].tobytes() for w, r in zip(windows, repeated_of(windows), strict=True)], pa.binary()))
        return out

    sent = docs.mapInArrow(send, "digest long, shard int, part int, chunk int, a binary, b binary, many binary")
    return _answers(scratch, sent.groupBy("shard").applyInArrow(group, "digest long, part int, chunk int, a binary, b binary"), "windows", n)


def _answers(scratch: Scratch, df: DataFrame, name: str, n: int) -> str:
    """Writes answers into a folder for each scan partition, of one file each."""
    df.repartition(n, "part").write.partitionBy("part").option("compression", "zstd").parquet(folder := f"{scratch.uri}/{name}")
    return folder


def _read(folder: str, part: int) -> dict[int, dict[int, dict]]:
    """The answers to one scan partition: by chunk, by shard (or order)."""
    filesystem, path = store(f"{folder}/part={part}")
    out: dict[int, dict[int, dict]] = {}
    if filesystem.get_file_info(path).type == pafs.FileType.NotFound:
        return out
    for f in filesystem.get_file_info(pafs.FileSelector(path)):
        if f.base_name.endswith(".parquet"):
            for row in pq.read_table(f.path, filesystem=filesystem, partitioning=None).to_pylist():
                of = out.setdefault(row["chunk"], {})
                of[row.get("shard", len(of))] = row
    return out


def remove_repeats(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 35, with_text: bool = True) -> DataFrame:
    """Removes each word that lies in a window of `width` words whose sequence also starts anywhere else.

    One row per row of docs: doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by spaces), and
    kept, that text, if asked for. A null or empty text has no words; a text shorter than the window keeps all;
    repeated rows are copies of each other and lose their windows. Rows must come in the same partitions each time
    they are read, as a scan of files has them; any other input is written to the shared folder first.
    """
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scratch = Scratch(spark, "substring_dedup")
    if not is_scan(chosen):
        chosen = scratch.table(chosen, "input")
    folder = repeated_windows(scratch, chosen.select("text"), "text", width)

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replies = _read(folder, TaskContext.get().partitionId())
        for k, batch in enumerate(slices(batches, "text", CHUNK_BYTES)):
            chunk = Chunk(texts_of(batch, "text"), width)
            found = [*replies.get(k, {}).values()]
            a = chunk.hashes(0)
            same_chunk(found, a)
            hit = chunk.place[:0]
            if found:
                often = [np.concatenate([_numbers(r[lane]) for r in found]) for lane in "ab"]
                order = np.argsort(often[0])
                hit = chunk.place[among(a, chunk.hashes(1), often[0][order], often[1][order])]
            cover = np.zeros(len(chunk.words) + 1, np.int64)
            cover[hit] += 1
            cover[hit + width] -= 1
            gone = np.cumsum(cover[:-1]) > 0
            kept = chunk.words.kept(gone)
            lost = np.concatenate([[0], np.cumsum(gone)])
            columns = [batch.column("doc_id"), pa.array(np.diff(chunk.start)), pa.array(lost[chunk.start[1:]] - lost[chunk.start[:-1]]), pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array([t.decode() for t in kept], pa.string())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return chosen.mapInArrow(remove, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)
