"""Quality rules as a bitmask ledger, in DataFrame functions only.

Each rule is evaluated once for each document; the ledger keeps what was measured and a bit for each failure.
Policies are masks over those bits, so versions and ablations are computed from the ledger without the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


def rules() -> dict[str, Column]:
    """Failure tests by name; the place in this order is the bit."""
    n, share = F.col("n_words"), lambda c, percent, of: 100 * F.col(c) > percent * F.col(of)
    return {
        "few_words": n < 10,
        "repeated_words": share("n_repeat_words", 20, "n_words"),
        "symbols": share("n_symbols", 20, "n_words"),
        "repeated_lines": (F.col("n_dup_lines") > 2) & share("n_dup_lines", 30, "n_lines"),  # of three lines, two may well be one
        "short_words": (n > 0) & (F.col("word_chars") < 2 * n),
        "long_words": F.col("word_chars") > 25 * n,
        "shouting": share("n_upper", 50, "word_chars"),
        "no_text": n == 0,
    }


#: Policies by version: names of the rules that reject a document.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words", "shouting", "no_text"),
}


def mask(policy: str) -> int:
    return sum(1 << k for k, name in enumerate(rules()) if name in POLICIES[policy])


def _dealt(value: Column, use) -> Column:
    """use(value) with value computed once for each row, bound as a lambda's variable."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(words: Column) -> Column:
    """Words in windows of five that a text has twice or more, the first included; windows are told apart by 64 bits of hash."""

    def of(w: Column) -> Column:
        return _dealt(_dealt(F.transform(w, lambda x: F.xxhash64(x)), windows), covered)

    def windows(h: Column) -> Column:
        first = F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0)))
        return F.transform(first, lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, WINDOW))))

    def covered(h: Column) -> Column:
        # only a text with a repeated window sorts its windows; those with an equal neighbour start repeats
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            def repeated(x: Column, i: Column) -> Column:
                return (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])

            return F.sort_array(F.transform(F.filter(s, lambda x, i: F.coalesce(repeated(x, i), F.get(s, i - 1)["h"] == x["h"], F.get(s, i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))

        def length(p: Column) -> Column:
            return F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, x: a + x)

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_dealt(_dealt(order, places), length))

    return F.when(F.size(words) < WINDOW + 1, F.lit(0).cast("long")).otherwise(of(words))


def _measures(text: Column) -> Column:
    """A struct of all measurements of one text, from one pass of splitting."""

    def of(w: Column) -> Column:
        count = lambda marks: F.regexp_count(text, F.lit(marks)).cast("long")
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
        counted = _dealt(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            (F.length(text) - count(WHITE)).alias("word_chars"),
            count(SYMBOLS).alias("n_symbols"),
            counted.alias("lines"),
            _repeat_words(w).alias("n_repeat_words"),
            count("[A-Z]").alias("n_upper"),
        )

    return _dealt(F.filter(F.split(text, WHITE + "+"), lambda x: x != ""), of)


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, measurements and `failures`, a bit for each rule: one row per row of docs.

    A null text is measured as an empty one, which has no words and no lines. Every row is measured on its own:
    no shuffle, and a long text is one row's arrays. Repeated rows and null ids are kept as they are.
    """
    m = docs.select(F.col(doc_id).alias("doc_id"), _measures(F.coalesce(F.col(text), F.lit(""))).alias("m"))
    flat = m.select("doc_id", "m.n_words", "m.word_chars", "m.n_symbols", F.col("m.lines.dup").alias("n_dup_lines"), "m.n_repeat_words", F.col("m.lines.n").alias("n_lines"), "m.n_upper")
    bits = [F.when(test, F.lit(1 << k)).otherwise(0) for k, test in enumerate(rules().values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return flat.withColumn("failures", total.cast("long"))


def fails(policy: str) -> Column:
    return F.col("failures").bitwiseAND(F.lit(mask(policy))) != 0


def verdicts(book: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with base_failed and kept: a policy's verdict, which the base rules always bind."""
    return book.withColumns({"base_failed": fails("base"), "kept": ~fails("base") & ~fails(policy)})


def ablation(book: DataFrame, policy: str = "v1") -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone, and that the policy keeps without it.

    One aggregate over the distinct bit patterns, at most two to the number of rules.
    """
    patterns = book.groupBy(F.col("failures").bitwiseAND(F.lit(mask(policy))).alias("bits")).agg(F.count("*").alias("n"))
    names = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(1 << k).cast("long").alias("bit")) for k, name in enumerate(rules()) if name in POLICIES[policy]))
    each = patterns.select("bits", "n", F.explode(names).alias("r")).select("bits", "n", "r.rule", "r.bit")
    has = F.col("bits").bitwiseAND(F.col("bit")) != 0
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    return each.groupBy("rule").agg(count(has).alias("n_fail"), count(F.col("bits") == F.col("bit")).alias("n_only"), count((F.col("bits") == 0) | (F.col("bits") == F.col("bit"))).alias("n_kept_without"))
