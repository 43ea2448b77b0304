"""Quality by votes of the nearest labelled documents in a latent semantic space."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, texts_of
from .toxicity import is_held_out, labelled_sample

#: At most so many labelled documents vote, those of the lowest hashes of their ids. They bound what is broadcast.
MAX_LABELLED = 6_000
FEATURES, TOPICS, NEIGHBOURS = 2048, 32, 25
#: Rows of one block of cosine products.
BLOCK = 1024
#: Similarity counts to this power, so that near neighbours outvote far ones.
SHARPNESS = 8

#: How much a word counts, compared to its outline.
TERM_WEIGHT = 0.5

_SHAPE = bytes(ord("a") if 97 <= c <= 122 or c >= 128 else ord("A") if 65 <= c <= 90 else ord("0") if 48 <= c <= 57 else c for c in range(256))
_known: dict[bytes, tuple[int, int]] = {}


def _slot(name: bytes) -> int:
    return zlib.crc32(name) % FEATURES


def _slots(word: bytes) -> tuple[int, int]:
    """The features of a word itself, whatever its case, and of its outline: runs of lower, upper, digits and each mark once."""
    s = word.translate(_SHAPE)
    return _slot(b"w" + word.lower()), _slot(b"s" + bytes(c for c, before in zip(s, b"\0" + s, strict=False) if c != before))


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sparse counts of a whole text: its words and their outlines, repeats near by, and its proportions in steps."""
    words = text.split()
    if len(_known) > 300_000:
        _known.clear()
    terms, shapes = Counter(), Counter()
    for w, c in Counter(words).items():
        k = _known.get(w)
        if k is None:
            k = _known[w] = _slots(w)
        terms[k[0]] += c
        shapes[k[1]] += c
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    out = {k: 1 + math.log(c) for k, c in shapes.items()}
    for k, c in terms.items():
        out[k] = out.get(k, 0.0) + TERM_WEIGHT * (1 + math.log(c))

    def grade(name: str, value: float, weight: float = 3.0) -> None:
        out[_slot(f"g{name}{value:.0f}".encode())] = weight

    distinct = len(set(words))
    grade("words", math.log2(n + 1), 1.0)
    grade("distinct", 8 * distinct / max(n, 1))
    grade("again", 8 * sum(map(bytes.__eq__, words, words[1:])) / max(n, 1))
    grade("lines", 8 * len(set(lines)) / max(len(lines), 1))
    grade("line", math.log2(n / max(len(lines), 1) + 1), 1.0)
    size = max(len(text), 1)
    for name, marks in (("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", b"0123456789"), ("mark", b"#*$%&|<>@^_~=+{}[]\\/"), ("shout", b"!?"), ("stop", b".,;:")):
        grade(name, 4 * math.log2(1 + 64 * (len(text) - len(text.translate(None, marks))) / size))
    return np.fromiter(out, np.int64, len(out)), np.fromiter(out.values(), np.float64, len(out))


def count_matrix(texts: list[bytes]) -> np.ndarray:
    m = np.zeros((len(texts), FEATURES), np.float32)
    for i, t in enumerate(texts):
        k, v = features(t)
        np.add.at(m[i], k, v)
    return m


@dataclass
class Space:
    """Weights of features, latent axes, and the labelled vectors in them."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        z = (counts * self.idf) @ self.axes
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Weighted votes of the nearest labelled documents by exact cosine, in blocks; all that tie with the last of them vote too."""
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for i in range(0, len(texts), BLOCK):
            z = self.project(count_matrix(texts[i : i + BLOCK]))
            cos = np.round(z @ self.vectors.T, 4)  # equal vectors tie, wherever their columns stand in a product
            least = np.partition(cos, -k, axis=1)[:, -k, None]
            w = np.where(cos >= least, np.clip(cos, 0, 1), 0).astype(np.float32) ** SHARPNESS
            out[i : i + BLOCK] = (w @ self.labels + 0.1 * self.prior) / (w.sum(1) + 0.1)
        return out


def latent_axes(x: np.ndarray, n: int) -> np.ndarray:
    """The n directions of features in which rows of x vary most, by orthogonal iteration from fixed start values."""
    q = np.random.default_rng(0).standard_normal((x.shape[1], min(n + 8, x.shape[1]))).astype(np.float32)
    for _ in range(30):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, vectors = np.linalg.eigh((x @ q).T @ (x @ q))
    return (q @ vectors[:, ::-1][:, :n]).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Space:
    """The latent space of at most `limit` labelled documents that aren't held out; their counts alone come to the driver.

    Without labels every score is the prior of one half.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [features(t) for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_pydict({"k": pa.array([k.tolist() for k, _ in rows], pa.list_(pa.int64())), "v": pa.array([v.tolist() for _, v in rows], pa.list_(pa.float64())), "y": batch.column("y")})

    got = labelled_sample(docs, labels, "quality", limit).mapInArrow(count, "k array<long>, v array<double>, y int").toArrow().to_pylist()
    got.sort(key=lambda r: (r["y"], r["k"], r["v"]))  # whatever the order of tasks
    if not got:
        return Space(np.ones(FEATURES, np.float32), np.zeros((FEATURES, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    m = np.zeros((len(got), FEATURES), np.float32)
    for i, r in enumerate(got):
        np.add.at(m[i], np.array(r["k"], np.int64), np.array(r["v"], np.float32))
    y = np.array([r["y"] for r in got], np.float64)
    idf = (np.log((1 + len(m)) / (1 + (m > 0).sum(0))) + 0.2).astype(np.float32)
    x = m * idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    axes = latent_axes(x, min(TOPICS, len(got)))
    space = Space(idf, axes, np.zeros((0, axes.shape[1]), np.float32), y, float((y.sum() + 1) / (len(y) + 2)))
    space.vectors = space.project(m)
    return space


RESULT = "doc_id long, held_out boolean, score double, predicted int"


def classify(spark: SparkSession, docs: DataFrame, space: Space, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs; a null text is scored as an empty one.

    The space is broadcast; its size is bounded by the limit of its sample: 1.1 MB at 6,000 documents.
    """
    shared = spark.sparkContext.broadcast(space)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            s = shared.value.score(texts_of(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), is_held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    return chosen.mapInArrow(judge, RESULT)


def quality(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by their nearest labelled ones."""
    return classify(spark, docs, fit(docs, labels))
