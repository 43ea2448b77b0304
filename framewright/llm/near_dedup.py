"""SimHash near-duplicates by tables of distances to reference fingerprints.

A fingerprint's coordinates are its Hamming distances to reference fingerprints (pivots). Two fingerprints that
differ in three bits have coordinates that differ by three at most, so a larger difference discards a pair. The
pivots are a base and, for each of five segments of the word, some that differ from the base within that segment
alone. Of five segments three bits can touch three: relative to their distance to the base, the coordinates that
linked fingerprints have to the pivots of two segments are equal. Each two segments are a table that is looked up
by these coordinates; a pair found there is discarded by its largest difference over all pivots, or verified.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, mix, slices, texts_of
from .tokens import partitions

#: Differing bits of linked fingerprints, words of a shingle, and seed of its hash.
DISTANCE, SHINGLE, SEED = 3, 3, 42
SEGMENTS = 5
#: Pivots of a segment of more bits than that; a shorter one has a pivot for each bit.
PIVOTS = 10
#: A bucket with more fingerprints is dealt out anew by pivots of more segments.
LARGE = 8192
#: Pairs that are looked at at once.
PAIRS = 4 << 20
BASE = 0x9E3779B97F4A7C15

_M = (1 << 64) - 1


def _mixed(k: int) -> int:
    """A fixed mix of a number."""
    x = (k + 1) * BASE & _M
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _M
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _M
    return x ^ (x >> 31)


def _cut(bits: list[int], n: int) -> list[int]:
    """Masks of n segments, as even as can be, of the given bits."""
    return [sum(1 << b for b in bits[len(bits) * i // n : len(bits) * (i + 1) // n]) for i in range(n)]


def pivots(segment: int) -> list[int]:
    """Reference fingerprints that differ from the base within a segment: in about half of its bits, or in one each if it is short."""
    bits = [b for b in range(64) if segment >> b & 1]
    if len(bits) <= PIVOTS:
        return [BASE ^ 1 << b for b in bits]
    return [BASE ^ (_mixed(bits[0] * PIVOTS + j) & segment) for j in range(PIVOTS)]


WORD = _cut([*range(64)], SEGMENTS)
#: Each table's segments, as places in WORD.
TABLES = [*combinations(range(SEGMENTS), SEGMENTS - DISTANCE)]
ALL_PIVOTS = [BASE, *(p for segment in WORD for p in pivots(segment))]


def finer(table: int) -> list[list[int]]:
    """For a table, lists of three further segments: of six parts of the bits it doesn't cover, three that the differing bits leave alone."""
    covered = sum(WORD[i] for i in TABLES[table])
    parts = _cut([b for b in range(64) if not covered >> b & 1], 2 * DISTANCE)
    return [list(p) for p in combinations(parts, DISTANCE)]


def coordinates(x: np.ndarray, segment: int) -> np.ndarray:
    """Distances to the pivots of a segment, less that to the base: a row for each pivot."""
    return np.stack([np.bitwise_count(x ^ np.uint64(p)) for p in pivots(segment)]).astype(np.int8) - np.bitwise_count(x ^ np.uint64(BASE)).astype(np.int8)


def buckets(x: np.ndarray, segments: list[int]) -> np.ndarray:
    """The same number for fingerprints of equal coordinates; others that a hash gives it too do no harm."""
    key = np.zeros(len(x), np.uint64)
    for c in (c for segment in segments for c in coordinates(x, segment)):
        key = mix(key ^ (c.astype(np.int64) + 64).astype(np.uint64))
    return key


@dataclass(frozen=True)
class Features:
    """What a text's fingerprints are made of: runs of so many words, each as often as it occurs or once, and how many fingerprints.

    Further fingerprints are of the same runs under other hashes; texts are linked by any of them.
    """

    shingle: int = SHINGLE
    once: bool = False
    number: int = 1


#: Finds near copies whose three-word runs differ in more than three bits: an edit changes one word, not three runs.
WORD_SETS = Features(1, True, 3)
_hashes: dict[bytes, int] = {}


def fingerprints_of(text: bytes, features: Features = Features()) -> np.ndarray:  # noqa: B008
    """64 bits each: set if over half of the features' hashes set it."""
    words = text.lower().split()  # ASCII only, as the input is bytes
    if not words:
        return np.zeros(features.number, np.uint64)
    k = min(features.shingle, len(words))
    grams = words if k == 1 else map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
    if features.once:
        if len(_hashes) > 300_000:
            _hashes.clear()
        grams = {*grams}
        for g in [g for g in grams if g not in _hashes]:
            _hashes[g] = xxhash.xxh64_intdigest(g, SEED)
        h = np.array([_hashes[g] for g in grams], "<u8")
    else:
        h = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], "<u8")
    out = []
    for i in range(features.number):
        bits = np.unpackbits((mix(h ^ np.uint64(_mixed(i))) if i else h).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(np.packbits(2 * bits > len(h), bitorder="little").view("<u8")[0])
    return np.array(out, np.uint64)


def fingerprints(docs: DataFrame, text: str, keep: list[str], features: Features = Features()) -> DataFrame:  # noqa: B008
    """The columns to keep, of longs, and fp0, fp1 ...: a row per row of docs; the bits as signed longs. A null text has no words, and fingerprints zero."""
    names = [f"fp{i}" for i in range(features.number)]

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fp = np.array([fingerprints_of(t, features) for t in texts_of(batch, "text")], np.uint64).reshape(-1, features.number).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(x) for x in fp.T.copy())], [*keep, *names])

    return docs.select(*keep, F.col(text).alias("text")).mapInArrow(sign, ", ".join(f"{c} long" for c in [*keep, *names]))


def pivot_table(x: np.ndarray) -> np.ndarray:
    """Distances of fingerprints to all pivots: a row for each pivot."""
    return np.stack([np.bitwise_count(x ^ np.uint64(p)) for p in ALL_PIVOTS]).astype(np.int8)


def close_pairs(x: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs of one bucket within the distance; buckets stand together, numbered from 0 on.

    Within a bucket, fingerprints are sorted by their first coordinate; those up to three further are looked at, and
    left by the first other coordinate that differs by more.
    """
    table = pivot_table(x)
    rank = bucket * 256 + table[0]
    order = np.argsort(rank, kind="stable")
    x, table, rank = x[order], table[:, order], rank[order]
    n = np.searchsorted(rank, rank + DISTANCE, side="right") - np.arange(len(x)) - 1
    before = np.concatenate([[0], np.cumsum(n)])
    start = 0
    while start < len(x):
        end = max(start + 1, int(np.searchsorted(before, before[start] + PAIRS, side="right")) - 1)
        some = n[start:end]
        a = np.repeat(np.arange(start, end), some)
        b = a + 1 + np.arange(len(a)) - np.repeat(before[start:end] - before[start], some)
        for coordinate in table[1:]:
            near = np.abs(coordinate[a] - coordinate[b]) <= DISTANCE
            a, b = a[near], b[near]
        near = np.bitwise_count(x[a] ^ x[b]) <= DISTANCE
        yield order[a[near]], order[b[near]]
        start = end


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least place that each place is linked to, over all links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        np.minimum.at(after, root[a], low)
        np.minimum.at(after, root[b], low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _bucket_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (t, key, fp) sorted by bucket, over batches -> (u, v): each fingerprint and the least it is linked to in its bucket."""

    def links(t: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        bucket = np.cumsum(np.concatenate([[False], (t[1:] != t[:-1]) | (key[1:] != key[:-1])]))
        a, b = (np.concatenate(p) for p in zip(*close_pairs(fp.view(np.uint64), bucket), strict=True))
        root = forest(len(fp), a, b)
        linked = np.flatnonzero(root != np.arange(len(fp)))
        return pa.RecordBatch.from_pydict({"u": fp[linked], "v": fp[root[linked]]})

    held: list[np.ndarray] = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        held = [np.concatenate([h, batch.column(c).to_numpy().astype(np.int64)]) for h, c in zip(held, ("t", "key", "fp"), strict=True)]
        t, key, _ = held
        last = np.flatnonzero((t != t[-1]) | (key != key[-1]))  # the last bucket may go on in the next batch
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield links(*(h[:cut] for h in held))
            held = [h[cut:] for h in held]
    if len(held[0]):
        yield links(*held)


def links(scratch: Scratch, distinct: DataFrame) -> DataFrame:
    """(u, v): links that join all fingerprints (kind, fp) of one kind within the distance, at most one for each of them, table and bucket."""
    n = partitions(distinct.sparkSession)

    def bucketed(df: DataFrame, tables: dict[int, list[int]], name: str) -> tuple[DataFrame, DataFrame]:
        def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, kind = batch.column("fp").to_numpy().view(np.uint64), batch.column("kind").to_numpy()
                for t, segments in tables.items():
                    yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("fp"), pa.array(np.full(len(x), t)), pa.array(mix(buckets(x, segments) ^ kind.view(np.uint64)).view(np.int64))], ["kind", "fp", "t", "key"])

        each = df.select("kind", "fp").mapInArrow(look_up, "kind long, fp long, t long, key long")
        return each, scratch.table(each.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1"), name)

    def compared(df: DataFrame) -> DataFrame:
        return df.select("t", "key", "fp").repartition(n, "t", "key").sortWithinPartitions("t", "key", "fp").mapInArrow(_bucket_links, "u long, v long")

    first, sizes = bucketed(distinct, {t: [WORD[i] for i in table] for t, table in enumerate(TABLES)}, "buckets")
    out = compared(first.join(sizes.filter(F.col("n") <= LARGE), ["t", "key"]))
    large = sizes.filter(F.col("n") > LARGE)
    for t, table in enumerate(TABLES) if not large.isEmpty() else []:
        again = scratch.table(first.filter(F.col("t") == t).join(large, ["t", "key"]).select("kind", "fp"), f"hot-{t}")
        own = [WORD[i] for i in table]
        deep, deep_sizes = bucketed(again, {1000 * (t + 1) + k: own + more for k, more in enumerate(finer(t))}, f"deep-{t}")
        # equal in 44 bits, a bucket has 2**20 fingerprints at most, of 8 bytes
        out = out.unionByName(compared(deep.join(deep_sizes, ["t", "key"])))
    return scratch.table(out.distinct(), "links")


def components(scratch: Scratch, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(u, root): the least member of the component of each linked node, by large-star and small-star rounds.

    Every round is written, so that a lost executor costs one round. Node lists are never gathered: a round is
    two minima by node, and joins of edges with them.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    before = None
    for k in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = scratch.table(large, f"large-{k}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v")
        edges = scratch.table(small.distinct(), f"star-{k}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select("u", F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components still change after {most_rounds} rounds")


def near_duplicates(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id (least doc_id that links reach, its own included) for each row of docs.

    Equal fingerprints are one node, however many documents have them. Null and empty texts have fingerprint
    zero and are linked like any other; null ids are linked too but are nobody's least id; repeated rows are
    repeated in the result. No rows, no result rows.
    """
    scratch = Scratch(spark, "near_dedup")
    signed = scratch.table(fingerprints(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "text", ["doc_id"]).withColumnRenamed("fp0", "fp"), "fingerprints")
    nodes = scratch.table(signed.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(scratch, links(scratch, nodes.select(F.lit(0).cast("long").alias("kind"), "fp")))
    rooted = nodes.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = scratch.table(rooted.join(named, "root").select("fp", "component_id"), "classes")
    return signed.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def joint_links(scratch: Scratch, signed: DataFrame, number: int) -> DataFrame:
    """(u, v): links of all fingerprints of each kind, and of each text's further fingerprints to its first.

    A further fingerprint joins texts only if it is linked, or if texts of several first ones have it; others are
    left out. A fingerprint is the same node for all kinds: that two kinds have an equal one by chance is as likely as
    that two hashes of 64 bits are equal.
    """
    kinds = F.posexplode(F.array(*(f"fp{i}" for i in range(number))))
    own = scratch.table(signed.select("fp0", kinds.alias("kind", "fp")).select("fp0", F.col("kind").cast("long").alias("kind"), "fp").distinct(), "kinds")
    found = links(scratch, own.select("kind", "fp").distinct())
    if number == 1:
        return found
    shared = own.filter("kind > 0").groupBy("fp").agg(F.count("*").alias("n")).filter("n > 1").select("fp")
    useful = found.select(F.explode(F.array("u", "v")).alias("fp")).unionByName(shared).distinct()
    return found.unionByName(own.join(useful, "fp").filter("fp0 <> fp").select(F.col("fp0").alias("u"), F.col("fp").alias("v")))


def one_of_each(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", features: Features = Features()) -> DataFrame:  # noqa: B008
    """The rows of docs that are the first of their component, by doc_id and a hash of the text; all columns as they are.

    Rows are told apart by id and text, so rows of one id with texts that aren't alike stay; rows equal in both are
    one document, of which one row stays. Null ids come last: such a row stays only where no row with an id is alike.
    """
    scratch = Scratch(spark, "near_dedup")
    names = [f"_{i}" for i in range(len(docs.columns))]
    i, t = names[docs.columns.index(doc_id)], names[docs.columns.index(text)]
    key = [F.coalesce(F.col(i).cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.xxhash64(t).alias("th")]
    keyed = docs.toDF(*names).select(*names, *key)
    signed = scratch.table(fingerprints(keyed, t, ["id", "th"], features).distinct(), "fingerprints")
    roots = components(scratch, joint_links(scratch, signed, features.number))
    rooted = signed.join(roots.withColumnRenamed("u", "fp0"), "fp0", "left").select("id", "th", F.coalesce("root", "fp0").alias("root"))
    first = scratch.table(rooted.groupBy("root").agg(F.min(F.struct("id", "th")).alias("f")).select("f.id", "f.th"), "first")
    kept = keyed.join(first.hint("merge"), ["id", "th"], "left_semi")
    return kept.dropDuplicates(["id", "th"]).select(names).toDF(*docs.columns)
