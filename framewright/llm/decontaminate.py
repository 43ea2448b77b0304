"""Benchmark decontamination: an FM-index of each shard of documents, searched backwards for test phrases.

A shard is a slice of a task's documents. Its index holds every word of them: the wavelet matrix of the
Burrows-Wheeler transform, as packed bits, and the suffix array at every so many places. Indexes are stored, so that
each new benchmark is a search of them alone; phrases are read block by block.
"""

from __future__ import annotations

import functools
import hashlib
import io
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, slices, store, texts_of
from .tokens import partitions

#: Words of test items that a block has, and blocks that a task holds at once.
BLOCK_WORDS, BLOCKS = 200_000, 4
#: Bytes of text of a shard; a longer text is a shard of its own.
SHARD_BYTES = 8 << 20
#: Every so many places of a text, the suffix array is kept; others are found by walking back to one.
SAMPLE = 16

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_KEEP = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters, digits and all characters beyond ASCII."""
    return text.translate(_KEEP).split()


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of s, by doubling of sorted prefixes; suffixes that are in place are left alone."""
    n = len(s)
    order = np.argsort(s)
    key, at, rank, k = s[order], np.arange(n), np.empty(n, np.int64), 1
    while len(at):
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[order[at]] = np.maximum.accumulate(np.where(new, at, 0))
        shared = ~(new & np.append(new[1:], True))
        at = at[shared]
        i = order[at]
        second = rank[np.minimum(i + k, n - 1)] + 1
        second[i + k >= n] = 0
        key = rank[i] * (n + 1) + second
        by = np.argsort(key)
        order[at], key = i[by], key[by]
        k *= 2
    return order


Span = dict[str, int]


class Bits:
    """A row of bits with the number of ones before each place."""

    def __init__(self, words: np.ndarray) -> None:
        ones = np.bitwise_count(words)
        self.words, self.before = words, np.cumsum(ones) - ones

    @classmethod
    def of(cls, bit: np.ndarray) -> Bits:
        raw = np.packbits(bit, bitorder="little")
        words = np.zeros(len(bit) // 64 + 1, "<u8")
        words.view(np.uint8)[: len(raw)] = raw
        return cls(words)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before place i."""
        w = i >> 6
        return self.before[w].astype(np.int64) + np.bitwise_count(self.words[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Ranks of symbols in a sequence: how often c stands before place i, by one bit of c at a time."""

    def __init__(self, levels: list[Bits], zeros: np.ndarray) -> None:
        self.levels, self.zeros = levels, zeros

    @classmethod
    def of(cls, s: np.ndarray, bits: int) -> WaveletMatrix:
        levels, zeros = [], []
        for b in range(bits - 1, -1, -1):
            one = (s >> b & 1).astype(bool)
            levels.append(Bits.of(one))
            zeros.append(len(s) - int(one.sum()))
            s = np.concatenate([s[~one], s[one]])
        return cls(levels, np.array(zeros, np.int64))

    def _down(self) -> Iterator[tuple[int, Bits, int]]:
        return zip(range(len(self.levels) - 1, -1, -1), self.levels, self.zeros.tolist(), strict=True)

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        start = np.zeros_like(i)
        for b, level, zeros in self._down():
            one = c >> b & 1 == 1
            s, e = level.rank(start), level.rank(i)
            start, i = np.where(one, zeros + s, start - s), np.where(one, zeros + e, i - e)
        return i - start

    def access(self, i: np.ndarray) -> np.ndarray:
        c = np.zeros_like(i)
        for _, level, zeros in self._down():
            one, ones = level.get(i), level.rank(i)
            c = c << 1 | one
            i = np.where(one, zeros + ones, i - ones)
        return c


class FMIndex:
    """Occurrences of phrases in a sequence of codes; its last code must stand nowhere else and be the least."""

    def __init__(self, n: int, less: np.ndarray, bwt: WaveletMatrix, kept: Bits, places: np.ndarray) -> None:
        self.n, self.less, self.bwt, self.kept, self.places = n, less, bwt, kept, places

    @classmethod
    def of(cls, s: np.ndarray) -> FMIndex:
        order = suffix_array(s)
        number = np.bincount(s)
        kept = order % SAMPLE == 0
        return cls(len(s), np.concatenate([[0], np.cumsum(number)]), WaveletMatrix.of(s[order - 1].astype(np.int32), max(1, (len(number) - 1).bit_length())), Bits.of(kept), order[kept].astype(np.uint32))

    def arrays(self) -> dict[str, np.ndarray]:
        levels = {f"words{k}": level.words for k, level in enumerate(self.bwt.levels)}
        return levels | {"n": np.array(self.n), "less": self.less, "zeros": self.bwt.zeros, "kept": self.kept.words, "places": self.places}

    @classmethod
    def from_arrays(cls, a: dict[str, np.ndarray]) -> FMIndex:
        levels = [Bits(a[f"words{k}"]) for k in range(len(a["zeros"]))]
        return cls(int(a["n"]), a["less"], WaveletMatrix(levels, a["zeros"]), Bits(a["kept"]), a["places"])

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffix array that begin with each phrase (of one width): first, end."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, j]
            a, b = self.less[c] + self.bwt.rank(c, lo[live]), self.less[c] + self.bwt.rank(c, hi[live])
            lo[live], hi[live] = a, np.maximum(a, b)
            live = live[a < b]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of rows of the suffix array."""
        place, steps, live, row = np.zeros(len(rows), np.int64), 0, np.arange(len(rows)), rows.copy()
        while len(live):
            done = self.kept.get(row[live])
            at = live[done]
            place[at] = self.places[self.kept.rank(row[at])].astype(np.int64) + steps
            live = live[~done]
            c = self.bwt.access(row[live])
            row[live] = self.less[c] + self.bwt.rank(c, row[live])
            steps += 1
        return place


@dataclass
class Hits:
    """What a search finds in each document: hit words, ids of items, merged spans of hit words."""

    n_hit: np.ndarray
    items: list[set[str]]
    spans: list[list[Span]]

    def contaminated(self, size: np.ndarray, share: Fraction) -> np.ndarray:
        return (self.n_hit > 0) & (self.n_hit * share.denominator >= share.numerator * size)


@dataclass
class Phrases:
    """The windows of a block of items: its words, phrases by width as places in them, items by phrase."""

    words: pa.Array
    by_width: list[tuple[int, np.ndarray, list[list[str]]]]


def phrases_of(items: Iterable[tuple[str | None, bytes]], width: int) -> Phrases:
    codes: dict[bytes, int] = {}
    found: dict[int, dict[tuple[int, ...], set[str]]] = {}
    for item, text in items:
        c = [codes.setdefault(w, len(codes)) for w in words_of(text)]
        k = min(width, len(c))
        for i in range(len(c) - k + 1 if c else 0):
            found.setdefault(k, {}).setdefault(tuple(c[i : i + k]), set()).update([] if item is None else [item])
    return Phrases(pa.array([*codes], pa.binary()), [(k, np.array([*f], np.int64), [sorted(x) for x in f.values()]) for k, f in sorted(found.items())])


@functools.lru_cache(maxsize=BLOCKS)
def _block(uri: str, width: int) -> Phrases:
    filesystem, path = store(uri)
    table = pq.read_table(path, filesystem=filesystem)
    return phrases_of(((i, (t or "").encode()) for i, t in zip(table["item"].to_pylist(), table["text"].to_pylist(), strict=True)), width)


class Shard:
    """The words of some documents and their index."""

    def __init__(self, words: pa.Array, codes: np.ndarray, size: np.ndarray, index: FMIndex) -> None:
        self.words, self.codes, self.size, self.index = words, codes, size, index
        #: Place of each document's first word; a separator of its own follows its last.
        self.start = np.cumsum(size + 1) - size - 1

    @classmethod
    def of(cls, raw: list[bytes]) -> Shard:
        texts = [words_of(t) for t in raw]
        size = np.array([len(t) for t in texts], np.int64)
        coded = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
        ends = np.cumsum(size + 1) - 1
        codes = np.empty(int((size + 1).sum()), np.int64)
        codes[ends] = np.arange(len(texts))[::-1]  # the last separator is the least code
        inside = np.ones(len(codes), bool)
        inside[ends] = False
        codes[inside] = coded.indices.to_numpy().astype(np.int64) + len(texts)
        return cls(coded.dictionary, codes, size, FMIndex.of(codes))

    def save(self, uri: str, doc_id: pa.Array) -> None:
        arrays = self.index.arrays() | {"codes": self.codes.astype(np.uint32), "size": self.size, "vocabulary": np.frombuffer(b" ".join(self.words.to_pylist()), np.uint8)}
        arrays |= {"doc_id": doc_id.fill_null(0).to_numpy(), "null": doc_id.is_null().to_numpy(zero_copy_only=False)}
        filesystem, path = store(uri)
        filesystem.create_dir(path.rpartition("/")[0], recursive=True)
        held = io.BytesIO()
        np.savez(held, **arrays)
        with filesystem.open_output_stream(path) as out:
            out.write(held.getbuffer())

    @classmethod
    def load(cls, uri: str) -> tuple[Shard, pa.Array]:
        filesystem, path = store(uri)
        with filesystem.open_input_file(path) as f, np.load(io.BytesIO(f.read())) as z:
            a = {k: z[k] for k in z.files}
        shard = cls(pa.array(a["vocabulary"].tobytes().split(), pa.binary()), a["codes"].astype(np.int64), a["size"], FMIndex.from_arrays(a))
        return shard, pa.array(a["doc_id"], pa.int64(), mask=a["null"])

    def occurrences(self, phrases: Phrases) -> Iterator[tuple[int, np.ndarray, list[str]]]:
        """(width, places, items) for each phrase that occurs."""
        code = pc.fill_null(pc.index_in(phrases.words, self.words), -1).to_numpy().astype(np.int64)
        for width, table, items in phrases.by_width:
            known = np.flatnonzero((code[table] >= 0).all(axis=1))
            lo, hi = self.index.search(code[table[known]] + len(self.size))
            hit = np.flatnonzero(hi > lo)
            n = (hi - lo)[hit]
            where = self.index.locate(np.repeat(lo[hit] - (np.cumsum(n) - n), n) + np.arange(int(n.sum())))
            for k, at in zip(known[hit].tolist(), np.split(where, np.cumsum(n)[:-1]) if len(hit) else [], strict=True):
                yield width, at, items[k]

    def hits(self, blocks: list[str], width: int) -> Hits:
        cover = np.zeros(len(self.codes) + 1, np.int32)
        found: dict[int, set[str]] = {}
        for block in blocks:
            for n, at, names in self.occurrences(_block(block, width)):
                np.add.at(cover, at, 1)
                np.add.at(cover, at + n, -1)
                for d in np.unique(np.searchsorted(self.start, at, side="right") - 1).tolist():
                    found.setdefault(d, set()).update(names)
        hit = np.cumsum(cover[:-1]) > 0
        n_hit = np.add.reduceat(hit, self.start, dtype=np.int64) if len(self.size) else np.zeros(0, np.int64)
        spans: list[list[Span]] = [[] for _ in self.size]
        for d in np.flatnonzero(n_hit).tolist():
            edge = np.diff(np.concatenate([[0], hit[self.start[d] : self.start[d] + self.size[d]].astype(np.int8), [0]]))
            spans[d] = [{"first": a, "end": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)]
        return Hits(n_hit, [found.get(d, set()) for d in range(len(self.size))], spans)

    def left(self, spans: list[list[Span]]) -> list[bytes]:
        """The words of each document outside its spans, joined by spaces."""
        own = np.ones(len(self.codes), bool)
        own[self.start + self.size] = False
        for d, of in enumerate(spans):
            for s in of:
                own[self.start[d] + s["first"] : self.start[d] + s["end"]] = False
        words = self.words.take(pa.array(self.codes[own] - len(self.size))).to_pylist()
        end = np.cumsum(own)[self.start + self.size].tolist()
        return [b" ".join(words[i:j]) for i, j in zip([0, *end], end, strict=False)]


def _blocks(spark: SparkSession, benchmark: DataFrame, item_id: str, item_text: str) -> list[str]:
    """Writes the items in blocks to the shared folder; each task reads the blocks one by one."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
    words = items.agg(F.sum(F.length("text"))).first()[0] or 0
    scratch = Scratch(spark, "decontaminate")
    scratch.table(items.repartition(1 + int(words) // (4 * BLOCK_WORDS)), "items")
    filesystem, path = store(f"{scratch.uri}/items")
    return sorted(f"{scratch.uri}/items/{x.base_name}" for x in filesystem.get_file_info(pafs.FileSelector(path)) if x.base_name.endswith(".parquet"))


RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<first:int,end:int>>, left_sha256 string"


def build_index(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the index of each shard of docs below `folder`; returns the manifest to be written: (uri, n_docs).

    A null or empty text has no words; null and repeated ids are kept as they are. File names are those of one
    attempt of a task, so the manifest names whole files only. Nothing is shuffled. No docs, no shards.
    """

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        for k, batch in enumerate(slices(batches, "text", SHARD_BYTES)):
            uri = f"{folder}/shard-{task.partitionId():06}-{k:04}-{task.taskAttemptId()}.npz"
            Shard.of(texts_of(batch, "text")).save(uri, batch.column("doc_id"))
            yield pa.RecordBatch.from_pydict({"uri": [uri], "n_docs": [batch.num_rows]})

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(build, "uri string, n_docs long")


def search_index(spark: SparkSession, manifest: DataFrame, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", width: int = 13, share: float = 0.05) -> DataFrame:
    """Words of indexed documents that lie in a phrase of `width` words of a test item (all of a shorter item).

    One row per indexed row: doc_id, n_words, n_hit, n_items (distinct ids of items with a phrase in it),
    items_sha256 of those ids as sorted, comma-joined strings, contaminated (hit words are at least `share` of
    all), the merged spans of hit words (first, end), and left_sha256 of the lower-cased words outside them, joined
    by spaces. A text without words has no hits, an item without words no phrases; an item with a null id hits words
    but isn't counted. Repeated rows are judged each.
    """
    blocks, part = _blocks(spark, benchmark, item_id, item_text), Fraction(str(share))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri in (u for batch in batches for u in batch.column("uri").to_pylist()):
            shard, doc_id = Shard.load(uri)
            found = shard.hits(blocks, width)
            names = [",".join(sorted(x)) for x in found.items]
            yield pa.RecordBatch.from_arrays(
                [
                    doc_id,
                    pa.array(shard.size),
                    pa.array(found.n_hit),
                    pa.array([len(x) for x in found.items], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in names]),
                    pa.array(found.contaminated(shard.size, part)),
                    pa.array(found.spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
                    pa.array([hashlib.sha256(x).hexdigest() for x in shard.left(found.spans)]),
                ],
                [f.split()[0] for f in RESULT.split(", ")],
            )

    return manifest.select("uri").repartition(partitions(spark), "uri").mapInArrow(search, RESULT)


def find_passages(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: object) -> DataFrame:
    """search_index over an index of docs that is built for it and stored until the result has been written."""
    scratch = Scratch(spark, "decontaminate")
    manifest = scratch.table(build_index(docs, f"{scratch.uri}/index", doc_id, text), "manifest")
    return search_index(spark, manifest, benchmark, **options)


def without_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text: str = "text", width: int = 13, share: float = 0.05, cut: bool = False) -> DataFrame:
    """The rows of docs, all columns as they are, of which less than `share` of the words is hit; null and empty texts stay.

    With `cut`, hit words of the rows that stay are removed from the text. One pass: a shard's index is built,
    searched and given up.
    """
    blocks, part = _blocks(spark, benchmark, "item_id", "text"), Fraction(str(share))
    names = [f"_{i}" for i in range(len(docs.columns))]
    at = names[docs.columns.index(text)]

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at, SHARD_BYTES):
            raw = texts_of(batch, at)
            shard = Shard.of(raw)
            found = shard.hits(blocks, width)
            if cut and found.n_hit.any():
                null = batch.column(at).is_null().to_numpy(zero_copy_only=False)
                new = pa.array([without_spans(t, s) for t, s in zip(raw, found.spans, strict=True)], pa.binary(), mask=null).cast(batch.column(at).type)
                batch = pa.RecordBatch.from_arrays([new if c == at else batch.column(c) for c in names], names)
            yield batch.filter(pa.array(~found.contaminated(shard.size, part)))

    renamed = docs.toDF(*names)
    return renamed.mapInArrow(keep, renamed.schema).toDF(*docs.columns)


def without_spans(text: bytes, spans: list[dict[str, int]]) -> bytes:
    """The text without the words of the given spans and what stands between them."""
    if not spans:
        return text
    at = [m.span() for m in _WORD.finditer(text.translate(_KEEP))]
    out, last = [], 0
    for s in spans:
        out.append(text[last : at[s["first"]][0]])
        last = at[s["end"] - 1][1]
    return b"".join([*out, text[last:]])
