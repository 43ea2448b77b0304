"""Toxicity by a weighted finite-state grammar: clauses are matched, not single words.

Words become classes, and five transducers read them: insults, threats, targets, negation and reported speech. They
are composed into one machine that reads a paragraph from the left. Reported speech is composed a second time, read
from the right, for a report that follows ("..., she said"). What the classes are in the end weighs their words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, slices, texts_of

#: At most so many labelled documents train the grammar, those of the lowest hashes of their ids.
MAX_LABELLED = 20_000
#: A term is learnt from so many differing documents at least, at such log odds.
MIN_DOCUMENTS, MIN_ODDS = 5, 3.0
STEMS = (4, 5, 6)
#: Words without weight that a worker remembers.
HARMLESS = 200_000

# Classes of tokens, those that words have and those that the machines write.
OTHER, TERM, VERB, INTENT, TARGET, NEGATION, REPORT, QUOTE, END = range(9)
INSULT, DIRECTED, MENACE, DENIED, QUOTED = range(9, 14)
CLASSES = 14

#: Start values of the grammar in four languages; labels add to the insults.
WORDS = {
    TERM: "idiot moron stupid loser pathetic worthless trash scum disgusting clown dumm idiotisch blödmann abschaum wertlos imbécile stupide ordure minable idiota estúpido basura patético imbécil",
    VERB: "kill hurt destroy beat shoot stab burn töten verletzen vernichten schlagen tuer frapper détruire brûler matar herir destruir golpear quemar",
    INTENT: "will shall gonna werde wirst vais allons voy vamos",
    TARGET: "you your yourself u they them du dich dir ihr euch tu te toi vous ti usted ustedes vosotros",
    NEGATION: "not no never n't isn't aren't wasn't nicht kein keine nie ne pas jamais nunca ningún",
    REPORT: "said says say wrote writes claimed called quoted reported sagte schrieb nannte behauptete dit écrit appelé déclaré dijo escribió llamó",
}
SEED_WEIGHT = 0.8

_TOKEN = re.compile(r"[^\W_]+(?:['’]t\b)?|[\"“”„«»]|[.!?;]")
MARKS = dict.fromkeys(".!?;", END) | dict.fromkeys("\"“”„«»", QUOTE)


@dataclass
class Transducer:
    """Reads classes and writes classes, from `start` on: (state, class) -> (state, class written)."""

    start: int
    step: Callable[[int, int], tuple[int, int]]


def _scope(opens: int, reach: int, inside: dict[int, int], outside: dict[int, int], quotes: bool = False) -> Transducer:
    """After a word that opens a scope, the next `reach` tokens of its clause are written as `inside` has them, others as `outside`.

    With `quotes`, all tokens between two quotation marks are inside too, clause after clause.
    """

    def step(state: int, c: int) -> tuple[int, int]:
        quoted, left = divmod(state, reach + 1)
        if c == END:
            return quoted * (reach + 1), c
        if c == QUOTE and quotes:
            return (1 - quoted) * (reach + 1) + left, c
        if c == opens:
            return quoted * (reach + 1) + reach, c
        rewrite = inside if quoted or left else outside
        return quoted * (reach + 1) + max(0, left - 1), rewrite.get(c, c)

    return Transducer(0, step)


INSULTS = Transducer(0, lambda state, c: (state, INSULT if c == TERM else c))
THREATS = _scope(INTENT, 4, {VERB: MENACE}, {VERB: OTHER})
TARGETS = _scope(TARGET, 5, {INSULT: DIRECTED}, {})
NEGATED = _scope(NEGATION, 3, dict.fromkeys((INSULT, DIRECTED, MENACE), DENIED), {})
REPORTED = _scope(REPORT, 4, dict.fromkeys((INSULT, DIRECTED, MENACE), QUOTED), {}, quotes=True)
REPORTED_AFTER = _scope(REPORT, 4, dict.fromkeys((INSULT, DIRECTED, MENACE), QUOTED), {})


def compose(machines: list[Transducer]) -> dict[tuple[int, int], tuple[int, int]]:
    """One machine that does what the given ones do one after another, as a table of the states that can be reached; 0 is the first."""
    first = tuple(m.start for m in machines)
    names, table, todo = {first: 0}, {}, [first]
    while todo:
        at = todo.pop()
        for c in range(CLASSES):
            out, after = c, []
            for m, s in zip(machines, at, strict=True):
                s, out = m.step(s, out)
                after.append(s)
            if (key := tuple(after)) not in names:
                names[key] = len(names)
                todo.append(key)
            table[names[at], c] = names[key], out
    return table


#: How much of a term's weight counts in each reading; a verb of harm counts only as a threat.
SHARE = {INSULT: 1.0, DIRECTED: 1.3, MENACE: 1.0, DENIED: 0.3, QUOTED: 0.5}
GRAMMAR, FROM_RIGHT = compose([INSULTS, THREATS, TARGETS, NEGATED, REPORTED]), compose([REPORTED_AFTER])


@dataclass
class Grammar:
    """Learnt terms and stems with weights, and the line that turns a document's weight into a probability."""

    terms: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    slope: float = 7.0

    def __post_init__(self) -> None:
        self.classes = {w: c for c, words in WORDS.items() for w in words.split()} | MARKS
        self.harmless: set[str] = set()

    def look_up(self, word: str) -> tuple[int, float]:
        """Class and weight of a token."""
        c = self.classes.get(word, OTHER)
        if c in (OTHER, TERM):
            w = self.terms.get(word, 0.0) or max((self.stems.get(word[:k], 0.0) for k in STEMS if len(word) > k), default=0.0)
            if w:
                return TERM, w
        return c, SEED_WEIGHT if c in (TERM, VERB) else 0.0

    def paragraph(self, tokens: list[str]) -> float:
        """Weight of a paragraph in the composed machines."""
        state, read = 0, []
        for c, w in map(self.look_up, tokens):
            state, out = GRAMMAR[state, c]
            read.append((out, w))
        state, total = 0, 0.0
        for c, w in reversed(read):
            state, out = FROM_RIGHT[state, c]
            total += SHARE.get(out, 0.0) * w
        return total

    def weight(self, text: str) -> float:
        """Sum over the paragraphs; one without a word of weight weighs nothing, whatever else it has."""
        if len(self.harmless) > HARMLESS:
            self.harmless.clear()
        total = 0.0
        for part in text.lower().split("\n"):
            tokens = _TOKEN.findall(part)
            other = {*tokens} - self.harmless
            if other:
                heavy = {x for x in other if self.look_up(x)[1]}
                self.harmless |= other - heavy
                if heavy:
                    total += self.paragraph(tokens)
        return total

    def score(self, text: str) -> float:
        return 0.5 + 0.5 * math.tanh((self.bias + self.slope * math.log1p(self.weight(text))) / 2)


def is_held_out(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(text, y) of at most `limit` labelled documents that aren't held out, one row for each id.

    Of conflicting labels of an id the higher counts, of several texts the one of the least hash.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~is_held_out())
    chosen = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    # `limit` rows of two numbers at most
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("t.text", "y")


def _words(text: str) -> set[str]:
    return {w for w in _TOKEN.findall(text.lower()) if w[0].isalpha()}


def _kin(words: set[str]) -> int:
    """The same for most copies of a text: the two lowest hashes of its long words, or of all its words if it has few long ones."""
    long = [w for w in words if len(w) >= 8]
    h = sorted(xxhash.xxh3_64_intdigest(w.encode()) for w in (long if len(long) >= 4 else words))
    return xxhash.xxh3_64_intdigest(repr(h[:2]).encode()) >> 1


def _terms(words: set[str]) -> set[str]:
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Grammar:
    """Learns insults, as words and stems, from labelled documents, copies counted once, and the probability line from an eighth that no term was learnt from.

    No labels leave the start values. The sample is written once and read three times; what comes to the driver is
    bounded by it.
    """
    spark = docs.sparkSession

    def with_kin(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.append_column("kin", pa.array([_kin(_words(t.decode())) for t in texts_of(batch, "text")], pa.int64()))

    sample = labelled_sample(docs, labels, "toxic", limit).mapInArrow(with_kin, "text string, y int, kin long")
    # copies of a text come to one task, which counts them once
    sample = Scratch(spark, "toxicity").table(sample, "sample").repartition(max(1, spark.sparkContext.defaultParallelism), "kin")

    def terms_of(y: int, wanted: dict[str, int] | None) -> DataFrame:
        """(term, n): how many differing documents of a label have a term, and how many there are, under an empty term."""

        def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen, count = set(), Counter()
            for batch in slices(batches, "text"):
                for t, kin in zip(texts_of(batch, "text"), batch.column("kin").to_pylist(), strict=True):
                    if kin % 8 and kin not in seen:
                        seen.add(kin)
                        count[""] += 1
                        count.update(x for x in _terms(_words(t.decode())) if wanted is None or x in wanted)
            yield pa.RecordBatch.from_pydict({"term": pa.array([*count], pa.string()), "n": pa.array([*count.values()], pa.int64())})

        chosen = sample.filter(F.col("y") == y).select("text", "kin").mapInArrow(emit, "term string, n long")
        return chosen.groupBy("term").agg(F.sum("n").alias("n"))

    support = {r["term"]: r["n"] for r in terms_of(1, None).filter((F.col("n") >= MIN_DOCUMENTS) | (F.col("term") == "")).collect()}
    n_toxic = support.pop("", 0)
    if not support:
        return Grammar()
    clean = {r["term"]: r["n"] for r in terms_of(0, support).collect()}
    n_clean = clean.pop("", 0)
    odds = {t: math.log((p + 0.5) / (n_toxic + 1)) - math.log((clean.get(t, 0) + 0.5) / (n_clean + 1)) for t, p in support.items()}
    # weights between a half and one, so that clauses count more than how rare a term is; little support is weak evidence
    good = {t: 0.5 + min(w, 6.0) / 12 * support[t] / (support[t] + 5) for t, w in odds.items() if w >= MIN_ODDS and clean.get(t, 0) * 20 <= support[t]}
    grammar = Grammar({t: w for t, w in good.items() if t[-1] != "*"}, {t[:-1]: w for t, w in good.items() if t[-1] == "*"})

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            new = [(grammar.weight(t.decode()), y) for t, y, kin in zip(texts_of(batch, "text"), batch.column("y").to_pylist(), batch.column("kin").to_pylist(), strict=True) if not kin % 8]
            yield pa.RecordBatch.from_pydict({"x": pa.array([x for x, _ in new], pa.float64()), "y": pa.array([y for _, y in new], pa.int32())})

    points = sample.mapInArrow(weigh, "x double, y int").toPandas()
    grammar.bias, grammar.slope = _line(np.log1p(points["x"].to_numpy()), points["y"].to_numpy())
    return grammar


def _line(x: np.ndarray, y: np.ndarray, prior: float = 3.0) -> tuple[float, float]:
    """Logistic regression on one number, by Newton's method, drawn to the start values."""
    a = np.stack([np.ones_like(x), x], 1)
    start = np.array([Grammar.bias, Grammar.slope])
    b = start.copy()
    for _ in range(50):
        p = 0.5 + 0.5 * np.tanh(a @ b / 2)
        g = a.T @ (y - p) - prior * (b - start)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + prior * np.eye(2), g)
        b = b + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return float(b[0]), float(b[1])


RESULT = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, grammar: Grammar, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs. A null text is scored as an empty one; a null id is held out as null."""

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            s = np.array([grammar.score(t.decode()) for t in texts_of(batch, "text")], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), is_held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    return chosen.mapInArrow(judge, RESULT)


def without_toxic(docs: DataFrame, grammar: Grammar, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of docs, all columns as they are, that the grammar doesn't reject; null and empty texts stay."""

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield batch.filter(pa.array([grammar.score(t.decode()) < threshold for t in texts_of(batch, text)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by the grammar that their labels teach."""
    return score(docs, fit(docs, labels))
