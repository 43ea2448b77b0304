"""The ten operators against brute force, exact round trips, held-out accuracy and edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import combinations

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from framewright.llm import decontaminate, line_dedup, near_dedup, packing, quality_classifier, quality_rules, queries, substring_dedup, token_counts, token_files, tokens, toxicity
from framewright.llm.common import Scratch

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, n_words long, score double, fp string, part int, kept string"

#: Null and empty texts, blanks, repeated rows, a null id, ties, long texts; columns with names that operators use.
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "no id here\nsecond line"), (5, LONG), (6, LONG), (7, "a b c\nd e f\ng"), (8, "x\na b c\nd e f"),
    (9, "é ü 日本 ‍ \U0001f600 ok"), (10, "<|endoftext|> is text"), (11, "idiot moron scum. not stupid"), (None, None),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, t, "en", 9, 0.5, "z", 3, "k") for i, t in EDGE], SCHEMA)


@pytest.fixture(scope="module")
def none(edge):
    return edge.limit(0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def texts():
    d = pd.read_parquet(f"{FOLDER}/documents.parquet")
    return dict(zip(d.doc_id.tolist(), d.text.tolist(), strict=True))


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda x: t.encode(x, add_special_tokens=False).ids


def table(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# tokens


def test_chunks_encode_like_the_library(plain):
    rng, encode = random.Random(3), tokens.encoder()
    parts = [" ", "  ", "\n", " \n", "a", "b1", "é", " ", "\t", "!", "***", "'s", "   ", "\x85", "0", "\x00", "日", "\x1c", "<|endoftext|>", "　", "ⅷ", "wörd", ", ", "; ", " x."]
    for _ in range(400):
        some = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(5)]
        assert [x.tolist() for x in encode(some)] == [plain(t) for t in some]
    assert encode([]) == []
    special = "hello <|endoftext|> world"
    assert encode([special, "a"])[0].tolist() == plain(special) == [31373, 220, 50256, 995]


def test_token_counts(docs, texts, plain, edge, none):
    n = np.array([len(plain(t)) + 1 for t in texts.values()])
    got = token_counts.context_totals(token_counts.length_histogram(docs)).collect()
    assert sum(r.n_docs for r in got) == len(n)
    for r in got:
        assert (r.docs_at_least, r.tokens_at_least) == ((n >= r.length).sum(), n[n >= r.length].sum())
        assert r.truncated_tokens == np.minimum(n, r.length).sum()
        assert r.docs_up_to == (n <= r.length).sum()
        assert r.quantile == pytest.approx((n <= r.length).mean())
    totals = token_counts.token_totals(docs.sparkSession, docs)
    limits = [0, 1, 2, 57, 512, 1000, 10**6]
    for r, limit in zip(token_counts.at_limits(totals, limits).collect(), limits, strict=True):
        assert (r.limit, r.docs_at_least, r.tokens_at_least, r.truncated_tokens) == (limit, (n >= limit).sum(), n[n >= limit].sum(), np.minimum(n, limit).sum())
    for r in token_counts.quantiles(totals, [0.01, 0.5, 0.9, 1.0]).collect():
        assert r.length == min(x for x in n if (n <= x).mean() >= r.share)
    assert [r[1:] for r in token_counts.at_limits(totals.limit(0), [5]).collect()] == [(0, 0, 0)]
    assert sum(r.n_docs for r in token_counts.length_histogram(edge).collect()) == len(EDGE)
    assert token_counts.context_totals(token_counts.length_histogram(none)).collect() == []


def test_token_files(spark, docs, texts, plain, edge, none):
    start, got = 0, table(token_files.token_file_digest(spark, docs))
    for i in sorted(texts):
        ids = [*plain(texts[i]), 0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    # null ids first, then by id; rows of one id by their texts' hashes
    rows = sorted(token_files.token_file_digest(spark, edge).collect(), key=lambda r: r.start)
    want = [(i, tuple(plain(t or "")) + (0,)) for i, t in EDGE]
    assert [r.doc_id for r in rows] == sorted((i for i, _ in EDGE), key=lambda i: i or -1)
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in rows) == sorted((i or -1, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want)
    assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:k]) for k in range(len(rows))]
    assert token_files.token_file_digest(spark, none).collect() == []


def test_token_files_are_mapped_without_copies(spark, docs):
    scratch = Scratch(spark, "test")
    shard = token_files.write_token_files(docs, f"{scratch.uri}/s", width=64).orderBy("shard").first()
    reader = token_files.open_arrow(shard.ids_uri)
    batch = reader.get_batch(0)
    assert batch.column("ids").type.list_size == 64
    assert batch.num_rows == token_files.BATCH_ROWS or reader.num_record_batches == 1
    mask = np.concatenate([reader.get_batch(k).column("mask").flatten().to_numpy(zero_copy_only=False) for k in range(reader.num_record_batches)])
    assert mask.sum() == shard.n_tokens
    assert mask[: shard.n_tokens].all()


# packing


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing(spark, docs, texts, plain, edge, none):
    rows = packing.pack(spark, docs).collect()
    n = check_packing(rows, 1024)
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    counts = {}
    for i, t in texts.items():
        ids, at = [*plain(t), 2], 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            assert k == 0 or r.length == 1024
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
            counts[r.length] = counts.get(r.length, 0) + 1
        assert at == len(ids)
    assert packing.lower_bound(counts, 1024) <= n <= sum(k for _, k in packing.best_fit(counts, 1024))
    rows = packing.pack(spark, edge).collect()
    check_packing(rows, 1024)
    assert sum(r.piece == 0 for r in rows) == len(EDGE)
    assert packing.pack(spark, none).collect() == []


def test_lower_bound():
    rng = random.Random(7)
    for _ in range(50):
        lengths = [rng.randint(1, 20) for _ in range(rng.randint(0, 9))]
        best = -(-sum(lengths) // 20)
        for k in range(11):
            large, middle = [x for x in lengths if x > 20 - k], [x for x in lengths if 10 < x <= 20 - k]
            rest = sum(x for x in lengths if max(k, 1) <= x <= 10) - (20 * len(middle) - sum(middle))
            best = max(best, len(large) + len(middle) + max(0, -(-rest // 20)))
        assert packing.lower_bound({x: lengths.count(x) for x in lengths}, 20) == best


def fewest(lengths, capacity):
    """Fewest bins by trying everything."""
    best = [len(lengths)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= lengths[k]:
                place(k + 1, [*rooms[:i], rooms[i] - lengths[k], *rooms[i + 1 :]])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(5)
    for _ in range(80):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = {x: lengths.count(x) for x in lengths}
        packed = packing.bin_completion(counts, 20, nodes=None)
        assert sorted(x for f, n in packed for x in f * n) == sorted(lengths)
        assert all(sum(f) <= 20 for f, _ in packed)
        assert sum(n for _, n in packed) == fewest(lengths, 20)
    assert packing.bin_completion({}, 20) == []


def slow_fillings(counts, room):
    """All fillings that no other one dominates by a piece in the place of some of its pieces."""
    every = {()}
    for x, n in counts.items():
        every |= {tuple(sorted((*f, *[x] * k), reverse=True)) for f in every for k in range(1, n + 1) if sum(f) + k * x <= room}

    def dominated(f):
        for k in range(len(f) + 1):
            for some in combinations(f, k):
                for x, n in counts.items():
                    if n > f.count(x) and sum(some) <= x <= sum(some) + room - sum(f) and some != (x,):
                        return True
        return False

    return {f for f in every if not dominated(f)}


def test_all_undominated_fillings_are_found():
    rng = random.Random(6)
    for _ in range(60):
        room = rng.randint(0, 25)
        counts = {x: rng.randint(1, 3) for x in rng.sample(range(1, 16), rng.randint(0, 6))}
        stock = np.zeros(30, np.int64)
        for x, n in counts.items():
            stock[x] = n
        some = packing.Fillings(stock, room)
        got = [f for waste in range(room + 1) for f in some.with_waste(waste, 0, room)]
        assert len(got) == len({*got})
        assert {*got} == slow_fillings({x: n for x, n in counts.items() if x <= room}, room)
        few = [f for waste in range(room + 1) for n in range(room + 1) for f in some.with_waste(waste, n, n)]
        assert sorted(few) == sorted(got)


def test_search_needs_fewer_sequences_than_best_fit(plain):
    counts = {}
    for t in pd.read_parquet("/root/testdata/sf0.01/documents.parquet").text.tolist():
        n = len(plain(t)) + 1
        counts[(n - 1) % 1024 + 1] = counts.get((n - 1) % 1024 + 1, 0) + 1
        counts[1024] = counts.get(1024, 0) + (n - 1) // 1024
    fitted, searched = packing.best_fit(counts, 1024), packing.bin_completion(counts, 1024)
    assert sum(n for _, n in searched) == packing.lower_bound(counts, 1024) < sum(n for _, n in fitted)
    assert {x: sum(f.count(x) * n for f, n in searched) for x in counts} == counts


# near duplicates


def link_all(prints):
    ids, x = [*prints], np.array([*prints.values()], np.uint64)
    root = [*range(len(ids))]

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(ids)):
        for b in np.flatnonzero(np.bitwise_count(x ^ x[a]) <= 3).tolist():
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {i: min(j for k2, j in enumerate(ids) if find(k2) == find(k)) for k, i in enumerate(ids)}


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates(spark, docs, texts):
    prints = {i: slow_print(t) for i, t in texts.items()}
    roots = link_all(prints)
    for i, r in table(near_dedup.near_duplicates(spark, docs)).items():
        assert (r.fingerprint, r.component_id) == (f"{prints[i]:016x}", roots[i])


def test_near_copies_by_word_sets(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    pairs, copies = [], 0
    for i in range(0, 400, 4):
        base = [rng.choice(words) for _ in range(rng.randint(150, 400))]
        pairs.append((i, " ".join(base)))
        for j in (1, 2):
            new = base.copy()
            for _ in range(len(base) // 60):  # about 0.85 of the five-word runs stay
                new[rng.randrange(len(new))] = rng.choice(words)
            pairs.append((i + j, " ".join(new)))
            copies += 1
        pairs.append((i + 3, " ".join(rng.choice(words) for _ in range(200))))
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    left = {f: {r.doc_id for r in near_dedup.one_of_each(spark, docs, features=f).collect()} for f in (near_dedup.Features(), near_dedup.WORD_SETS)}
    for kept in left.values():
        assert {i for i, _ in pairs if i % 4 in (0, 3)} <= kept
    caught = {f: sum(i not in kept for i, _ in pairs if i % 4 in (1, 2)) / copies for f, kept in left.items()}
    assert caught[near_dedup.WORD_SETS] >= 0.9 > caught[near_dedup.Features()]
    # the same components by brute force over all fingerprints
    prints = {i: near_dedup.fingerprints_of(t.encode(), near_dedup.WORD_SETS) for i, t in pairs}
    roots = {i: i for i in prints}
    for _ in range(5):
        for a in prints:
            for b in prints:
                if np.bitwise_count(prints[a] ^ prints[b]).min() <= 3:
                    roots[a] = roots[b] = min(roots[a], roots[b])
    assert left[near_dedup.WORD_SETS] == {*roots.values()}


def test_near_duplicates_edges(spark, edge, none):
    rows = near_dedup.near_duplicates(spark, edge).collect()
    assert len(rows) == len(EDGE)
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {1}
    assert near_dedup.near_duplicates(spark, none).collect() == []
    kept = near_dedup.one_of_each(spark, edge)
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 4, 5, 7, 8, 9, 10, 11]
    assert ids.count(None) == 1  # the null text without an id is like the one of id 1
    one_id = spark.createDataFrame([(5, "a first text of its own"), (5, "another one that differs in all"), (5, "a first text of its own"), (6, None), (7, "a first text of its own")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text or "") for r in near_dedup.one_of_each(spark, one_id).collect()) == [(5, "a first text of its own"), (5, "another one that differs in all"), (6, "")]


def test_links_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LARGE", 40)
    rng = np.random.default_rng(2)
    x = {0}
    while len(x) < 400:  # a chain of near copies in few bits
        x.add([*x][rng.integers(len(x))] ^ (1 << int(rng.integers(40))) ^ (1 << int(rng.integers(40))))
    x |= {int(v) for v in rng.integers(0, 2**63, 200)}
    prints = {v: v for v in sorted(x)}
    df = spark.createDataFrame([(v,) for v in x], "fp long")
    scratch = Scratch(spark, "test")
    got = {r.u: r.root for r in near_dedup.components(scratch, near_dedup.links(scratch, df.withColumn("kind", F.lit(0).cast("long")))).collect()}
    assert {v: got.get(v, v) for v in prints} == link_all(prints)


def test_close_pairs(monkeypatch):
    monkeypatch.setattr(near_dedup, "PAIRS", 50)
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 60, dtype=np.uint64)
    near = x[:30] ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64))
    x = np.unique(np.concatenate([x, near]))
    bucket = np.arange(len(x)) // 40
    got = {tuple(sorted(p)) for ab in near_dedup.close_pairs(x, bucket) for p in zip(*(a.tolist() for a in ab), strict=True)}
    assert got == {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if bucket[i] == bucket[j] and int(x[i] ^ x[j]).bit_count() <= 3}


def test_coordinates_of_linked_fingerprints_are_equal_in_a_table():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2**64, 300, dtype=np.uint64)
    y = x.copy()
    for _ in range(3):
        y ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    found = np.zeros(300, bool)
    for table in near_dedup.TABLES:
        segments = [near_dedup.WORD[i] for i in table]
        equal = np.logical_and.reduce([(near_dedup.coordinates(x, s) == near_dedup.coordinates(y, s)).all(axis=0) for s in segments])
        assert (near_dedup.buckets(x, segments) == near_dedup.buckets(y, segments))[equal].all()
        found |= equal
    assert found.all()
    far = np.abs(near_dedup.pivot_table(x)[:, None, :] - near_dedup.pivot_table(x)[:, :, None]).max(axis=0)
    assert (far[~np.eye(300, dtype=bool)] > 3).all()  # pivots alone tell random fingerprints apart


# SQL twins


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twins(spark, duck, name):
    got, want = queries.QUERIES[name](spark, FOLDER).toPandas(), duck.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda df: sorted(map(str, df[sorted(df.columns)].itertuples(index=False, name=None)))
    assert key(got) == key(want)


# line dedup


def slow_lines(pairs, m):
    """Deletes runs of m lines that stand earlier, over documents in id order."""
    order = sorted({(i if i is not None else 1 << 63, t) for i, t in pairs if t is not None}, key=lambda p: (p[0],))
    seen, out = set(), {}
    for i, t in order:
        lines = t.split("\n")
        real = [k for k, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        gone = set()
        for a in range(len(real) - m + 1):
            run = tuple(lines[k] for k in real[a : a + m])
            if run in seen:
                gone |= set(real[a : a + m])
            seen.add(run)
        out[i, t] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


@pytest.mark.parametrize("m", [1, 2, 3, 5])
def test_line_runs(spark, m):
    rng = random.Random(m)
    pairs = [(i, "\n".join(rng.choice(["a a", "b", "c", "d d d", "", " "]) for _ in range(rng.randint(0, 12)))) for i in range(40)]
    want = slow_lines(pairs, m)
    got = line_dedup.dedup_lines(spark, spark.createDataFrame(pairs, "doc_id long, text string"), min_lines=m).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted((i, want[i, t]) for i, t in pairs)


def test_single_lines_in_query_and_stage(spark, docs, texts):
    import corpus_pipeline

    want = slow_lines(texts.items(), 1)
    got = table(queries.QUERIES["op1_line_dedup"](spark, FOLDER))
    assert {i: r.kept_sha256 for i, r in got.items()} == {i: hashlib.sha256(want[i, t].encode()).hexdigest() for i, t in texts.items()}
    left = table(corpus_pipeline.drop_repeated_lines(spark, docs, FOLDER))
    assert {i: (r.text, r.n_chars) for i, r in left.items()} == {i: (want[i, t], len(want[i, t])) for i, t in texts.items()}
    assert corpus_pipeline.drop_repeated_lines(spark, docs.drop("n_chars", "lang"), FOLDER).count() == docs.count()


def test_maximal_runs(spark):
    pairs = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny\nc\nd"), (3, "a\nb\nc\nd")]
    got = line_dedup.repeated_runs(spark, spark.createDataFrame(pairs, "doc_id long, text string"), min_lines=2).collect()
    assert sorted((r.id, r.k, r.n_lines, r.copy_id, r.copy_k) for r in got) == [(2, 1, 3, 1, 0), (2, 5, 2, 1, 2), (3, 0, 4, 1, 0)]


def test_maximal_runs_are_the_longest_earlier_matches(spark):
    rng = random.Random(11)
    lines = {i: [rng.choice("abcd") for _ in range(rng.randint(0, 40))] for i in range(25)}
    lines[25], lines[26] = lines[3] * 3, ["z", *lines[3] * 3]
    docs = spark.createDataFrame([(i, "\n".join(x)) for i, x in lines.items()], "doc_id long, text string")
    flat = [(i, k) for i, x in lines.items() for k in range(len(x))]

    def match(p, q):
        (i, a), (j, b) = p, q
        n = 0
        while a + n < len(lines[i]) and b + n < len(lines[j]) and lines[i][a + n] == lines[j][b + n]:
            n += 1
        return n

    for m in (1, 3, 4):
        want = set()
        for at, p in enumerate(flat):
            n = max((match(p, q) for q in flat[:at]), default=0)
            want |= {(p[0], p[1] + x) for x in range(n)} if n >= m else set()
        intervals = line_dedup.lcp_intervals(Scratch(spark, "test"), line_dedup.line_ids(docs), m)
        runs = line_dedup.maximal_runs(intervals).collect()
        assert {(r.id, r.k + x) for r in runs for x in range(r.n)} == want
        assert 2 * intervals[-1][0] > max(match(p, q) for at, p in enumerate(flat) for q in flat[:at]) >= intervals[-1][0]
        for r in line_dedup.repeated_runs(spark, docs, min_lines=m).collect():
            assert match((r.id, r.k), (r.copy_id, r.copy_k)) >= r.n_lines >= m


def test_line_dedup_edges(spark, edge, none):
    got = line_dedup.dedup_lines(spark, edge)
    assert got.columns == edge.columns
    rows = got.collect()
    assert len(rows) == len(EDGE)
    by = {r.doc_id: r.text for r in rows if r.doc_id}
    assert (by[1], by[2], by[7], by[8]) == (None, "", "a b c\nd e f\ng", "x")
    clash = edge.select("doc_id", "text", *(F.lit(1).alias(c) for c in ("id", "th", "k", "n", "gone", "first", "r", "a")))
    assert line_dedup.dedup_lines(spark, clash).columns == clash.columns
    assert line_dedup.dedup_lines(spark, clash).count() == len(EDGE)
    assert line_dedup.dedup_lines(spark, none).collect() == []
    assert line_dedup.dedup_lines(spark, none, digest=True).collect() == []


# decontamination


def test_fm_index():
    rng = np.random.default_rng(4)
    s = np.append(rng.integers(1, 5, 300), 0)
    index = decontaminate.FMIndex.of(s)
    assert decontaminate.suffix_array(s).tolist() == sorted(range(301), key=lambda i: s[i:].tolist())
    index = decontaminate.FMIndex.from_arrays(index.arrays())
    for width in (1, 2, 5):
        phrases = np.unique(rng.integers(1, 5, (40, width)), axis=0)
        lo, hi = index.search(phrases)
        for p, a, b in zip(phrases.tolist(), lo.tolist(), hi.tolist(), strict=True):
            want = [i for i in range(len(s) - width + 1) if s[i : i + width].tolist() == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_decontamination_edges(spark, edge, none):
    items = spark.createDataFrame([(1, "ONE"), (2, None), (3, ""), (None, "no id HERE"), (4, "one"), (4, "one"), (5, " ".join(f"w{i}" for i in range(20)))], "item_id long, text string")
    rows = decontaminate.find_passages(spark, edge, items).collect()
    assert len(rows) == len(EDGE)
    by = {r.doc_id: r for r in rows if r.doc_id}
    assert (by[4].n_hit, by[4].n_items, by[4].contaminated) == (1, 2, True)
    assert by[4].items_sha256 == hashlib.sha256(b"1,4").hexdigest()
    assert (by[1].n_words, by[1].contaminated, by[5].n_items, by[5].contaminated) == (0, False, 1, False)
    nameless = next(r for r in rows if r.doc_id is None and r.n_words)
    assert (nameless.n_hit, nameless.n_items, nameless.contaminated) == (3, 0, True)
    assert decontaminate.find_passages(spark, none, items).collect() == []
    assert not any(r.n_hit for r in decontaminate.find_passages(spark, edge, items.limit(0)).collect())
    kept = decontaminate.without_contaminated(spark, edge, items)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 5, 6, 7, 8, 9, 10, 11]
    # a share that is no unit fraction: 3 of 7 words are hit
    three = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string"), spark.createDataFrame([(1, "c d e")], "item_id long, text string")
    for share, n in ((0.42, 0), (0.43, 1), (0.3, 0)):
        assert decontaminate.without_contaminated(spark, *three, share=share).count() == n
    cut = decontaminate.without_contaminated(spark, *three, share=0.9, cut=True).collect()
    assert [r.text for r in cut] == ["a b  f g"]


def test_a_stored_index_serves_other_benchmarks(spark, docs):
    scratch = Scratch(spark, "test")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    manifest = scratch.table(decontaminate.build_index(docs, f"{scratch.uri}/index"), "manifest")
    for some in (items, items.limit(5), items.limit(0)):
        got, want = table(decontaminate.search_index(spark, manifest, some)), table(decontaminate.find_passages(spark, docs, some))
        assert got == want
    kept = {r.doc_id for r in decontaminate.without_contaminated(spark, docs, items).collect()}
    assert kept == {i for i, r in table(decontaminate.search_index(spark, manifest, items)).items() if not r.contaminated}


def test_blocks_of_items(spark, docs, monkeypatch):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    want = table(decontaminate.find_passages(spark, docs, items))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    got = table(decontaminate.find_passages(spark, docs, items))
    assert {i: (r.n_hit, r.items_sha256) for i, r in got.items()} == {i: (r.n_hit, r.items_sha256) for i, r in want.items()}


def test_spans_are_cut():
    assert decontaminate.without_spans(b"A, b c. D!", [{"first": 1, "end": 3}]) == b"A, . D!"


# substring dedup


def test_substring_edges(spark, edge, none):
    rows = substring_dedup.remove_repeats(spark, edge).collect()
    assert len(rows) == len(EDGE)
    by = {r.doc_id: r for r in rows if r.doc_id}
    assert (by[1].n_words, by[4].n_words, by[4].n_removed, by[7].kept) == (0, 1, 0, "a b c d e f g")
    assert (by[5].n_removed, by[6].n_removed) == (30_000, 30_000)
    assert substring_dedup.remove_repeats(spark, none).collect() == []


def test_substring_dedup_of_shuffled_input_and_long_texts(spark, docs, monkeypatch):
    want = table(substring_dedup.remove_repeats(spark, docs))
    assert table(substring_dedup.remove_repeats(spark, docs.repartition(4))) == want
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 1000)  # most texts are longer than a chunk
    assert table(substring_dedup.remove_repeats(spark, docs)) == want


def test_pairs_of_hashes():
    a, b = np.array([5, 1, 5, 5, 9], np.uint64), np.array([1, 1, 2, 4, 9], np.uint64)
    assert substring_dedup.among(a, b, np.array([1, 5, 5, 9], np.uint64), np.array([2, 1, 4, 9], np.uint64)).tolist() == [True, False, False, True, True]
    assert substring_dedup.among(a[:0], b[:0], a[:0], b[:0]).tolist() == []


def test_sketch_never_loses_a_repeat():
    rng = np.random.default_rng(6)
    chunks = [rng.integers(0, 500, 300).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(4)]
    total = np.unique(np.concatenate(chunks), return_counts=True)
    often = set(total[0][total[1] > 1].tolist())
    for row in range(substring_dedup.ROWS):
        messages = [dict(substring_dedup.sketch_message(h, 0))[0][row] for h in chunks]
        for h, bits in zip(chunks, substring_dedup.merge_sketches(messages), strict=True):
            cells = np.unique(substring_dedup.cells_of(h, row, 0))
            flagged = set(cells[np.unpackbits(np.frombuffer(bits, np.uint8), count=len(cells)) == 1].tolist())
            assert all(c in flagged for x, c in zip(h.tolist(), substring_dedup.cells_of(h, row, 0).tolist(), strict=True) if x in often)


def test_cells_round_trip():
    for cells in ([], [5], [5, 5, 9], [0, 70_000, 1 << 23], [3, 3, 1 << 16]):
        assert substring_dedup.unpack_cells(substring_dedup.pack_cells(np.array(cells, np.uint32))).tolist() == cells


# quality and toxicity


@pytest.fixture(scope="module")
def labelled(spark):
    folder = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def held_out(scores, labels, label):
    rows = scores.join(labels, "doc_id").filter("held_out").select("predicted", label).collect()
    hit = sum(r.predicted == r[label] for r in rows) / len(rows)
    positive = [r.predicted for r in rows if r[label] == 1]
    return hit, sum(positive) / len(positive)


def test_quality_votes_row_by_row(spark, docs, texts):
    space = quality_classifier.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    unit = lambda z: z / max(np.sqrt((z * z).sum()), 1e-9)
    for i, r in table(quality_classifier.classify(spark, docs, space)).items():
        names, values = quality_classifier.features(texts[i].encode())
        z = unit(sum((v * space.idf[k] * space.axes[k] for k, v in zip(names, values, strict=True)), np.zeros(space.axes.shape[1])))
        cos = [round(float(z @ v), 4) for v in space.vectors.astype(np.float64)]
        least = sorted(cos, reverse=True)[:25][-1]
        votes = [(max(c, 0) ** 8, y) for c, y in zip(cos, space.labels, strict=True) if c >= least]
        want = (sum(w * y for w, y in votes) + 0.1 * space.prior) / (sum(w for w, _ in votes) + 0.1)
        assert r.score == pytest.approx(want, abs=0.03)
        assert r.predicted == (r.score >= 0.5)


def test_quality_held_out(spark, labelled):
    accuracy, _ = held_out(quality_classifier.quality(spark, *labelled), labelled[1], "quality")
    assert accuracy >= 0.98


def test_toxicity_held_out(spark, labelled):
    accuracy, recall = held_out(toxicity.toxicity(spark, *labelled), labelled[1], "toxic")
    assert accuracy >= 0.965
    assert recall >= 0.7


def test_held_out_rows_teach_nothing(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    other = labels.withColumn("quality", F.when(toxicity.is_held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (table(quality_classifier.quality(spark, docs, x)) for x in (labels, other))
    assert {i: r.score for i, r in a.items()} == pytest.approx({i: r.score for i, r in b.items()})


def test_scores_of_edges(spark, edge, none):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (None, 1, 1), (7, None, None), (11, 0, 1)], "doc_id long, quality int, toxic int")
    for f in (quality_classifier.quality, toxicity.toxicity):
        for given in (labels, labels.limit(0)):
            rows = f(spark, edge, given).collect()
            assert len(rows) == len(EDGE)
            assert all(0 <= r.score <= 1 for r in rows)
        assert f(spark, none, labels).collect() == []


def test_grammar_reads_clauses():
    g = toxicity.Grammar()
    weigh = g.weight
    assert weigh("a fine day. nothing else") == 0
    assert weigh("you are an idiot") > weigh("an idiot") > weigh("he said an idiot") > weigh("not an idiot") > 0
    assert weigh('the word "idiot" here') < weigh("the word idiot here")
    assert weigh("we will hurt you") > weigh("does it hurt")
    assert weigh("not. an idiot") == weigh("an idiot")
    assert weigh('"That is it. You idiot. Go." she said') < weigh("That is it. You idiot. Go.")
    assert weigh("what an idiot, she said") < weigh("what an idiot, she came")
    assert weigh('"Go\nidiot') == weigh("idiot")  # an open quote ends with its paragraph


def slow_weight(grammar, text):
    """A rule for each clause, looking around from each word of weight."""
    total = 0.0
    for part in text.lower().split("\n"):
        words = [grammar.look_up(x) for x in toxicity._TOKEN.findall(part)]
        classes = [c for c, _ in words]
        for i, (c, w) in enumerate(words):
            if not w:
                continue
            first = max((k + 1 for k in range(i) if classes[k] == toxicity.END), default=0)
            last = min((k for k in range(i, len(words)) if classes[k] == toxicity.END), default=len(words))
            before = lambda kind, reach, skip=(): kind in [x for x in classes[first:i] if x not in skip][-reach:]  # noqa: E731, B023
            after = [x for x in classes[i + 1 : last]][:4]
            if c == toxicity.VERB and not before(toxicity.INTENT, 4):
                continue
            share = 1.3 if c == toxicity.TERM and before(toxicity.TARGET, 5) else 1.0
            if before(toxicity.NEGATION, 3):
                share = 0.3
            elif classes[:i].count(toxicity.QUOTE) % 2 or before(toxicity.REPORT, 4, (toxicity.QUOTE,)) or toxicity.REPORT in after:
                share = 0.5
            total += share * w
    return total


def test_composed_machines_equal_rules(texts):
    g = toxicity.Grammar({"grumble": 0.6}, {"snar": 0.7})
    rng = random.Random(9)
    some = [w for words in toxicity.WORDS.values() for w in words.split()[:4]] + ["a", "b", "grumble", "snarling", '"', ".", "\n", ",", "c", "d"]
    for _ in range(1500):
        text = " ".join(rng.choice(some) for _ in range(rng.randint(0, 25)))
        assert g.weight(text) == pytest.approx(slow_weight(g, text)), text
    for t in texts.values():
        assert g.weight(t) == pytest.approx(slow_weight(g, t))


def test_toxicity_scores_row_by_row(spark, docs, texts):
    g = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    for i, r in table(toxicity.score(docs, g)).items():
        assert r.score == pytest.approx(1 / (1 + np.exp(-g.bias - g.slope * np.log1p(slow_weight(g, texts[i])))))
        assert r.predicted == (r.score >= 0.7)


def test_short_texts_teach(spark):
    rows = [(i, f"no {w} at all t{i}" if i % 2 else f"a day of sun t{i}", i % 2) for i, w in enumerate(["grix", "ok"] * 400)]
    rows = [(i, f"you are grix u{i}" if y else t, y) for i, t, y in rows]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    assert "grix" in toxicity.fit(docs, labels).terms


def test_labelled_sample_has_a_row_for_each_id(spark):
    a, b = [i for i in range(20) if zlib.crc32(str(i).encode()) % 3 != 1][:2]
    docs = spark.createDataFrame([(a, f"text {i}") for i in range(500)] + [(b, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(a, 1, 1), (b, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.labelled_sample(docs, labels, "toxic", 20).count() == 2


def test_without_toxic(edge):
    got = toxicity.without_toxic(edge, toxicity.Grammar())
    assert got.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in got.collect()) == sorted(i or 0 for i, _ in EDGE if i != 11)


# rules


def test_rules_edges(edge, none):
    rows = quality_rules.verdicts(quality_rules.ledger(edge)).collect()
    assert len(rows) == len(EDGE)
    by = {r.doc_id: r for r in rows if r.doc_id}
    assert (by[1].n_words, by[1].base_failed, by[1].kept) == (0, True, False)
    assert by[9].word_chars == len("éü日本‍\U0001f600ok")
    assert by[5].n_repeat_words == 30_000
    assert quality_rules.ledger(none).collect() == []


def test_ablation(docs):
    book = quality_rules.ledger(docs).cache()
    rows = {r.rule: r for r in quality_rules.ablation(book).collect()}
    kept = quality_rules.verdicts(book).filter("kept").count()
    for k, name in enumerate(quality_rules.rules()):
        r = rows[name]
        assert r.n_kept_without == kept + r.n_only
        assert r.n_fail == book.filter(F.col("failures").bitwiseAND(F.lit(1 << k)) != 0).count()


# pipeline


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs, columns = spark.read.parquet(f"{FOLDER}/documents.parquet"), ["doc_id", "text", "lang", "source", "n_chars"]
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, FOLDER).write.parquet(path := f"file://{tmp_path}/{name}")
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
            assert docs.select("doc_id").distinct().count() == docs.count()
            assert docs.join(before, "doc_id", "left_anti").count() == 0
        if name == "near_dedup":
            again = near_dedup.one_of_each(spark, docs, features=near_dedup.WORD_SETS)
            assert again.count() == docs.count()
            roots = link_all({r.doc_id: slow_print(r.text) for r in before.collect()})
            assert {*roots.values()} >= {r.doc_id for r in docs.collect()}
        if name == "decontamination":
            left = decontaminate.find_passages(spark, docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet"))
            assert left.filter("contaminated").count() == 0
            kept = docs.select("doc_id").collect()
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] >= sizes[4] > 0
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == {r.doc_id for r in kept}
    check_packing(docs.collect(), 1024)
    whole = corpus_pipeline.run(spark, FOLDER).select("doc_id", "piece", "length", "ids_crc32")
    assert whole.exceptAll(docs.select("doc_id", "piece", "length", "ids_crc32")).count() == 0


def slow_contaminated(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    own, hit = words(text), set()
    for item in items:
        w = words(item)
        k = min(13, len(w))
        windows = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
        for i in range(len(own) - k + 1 if w else 0):
            if tuple(own[i : i + k]) in windows:
                hit |= {*range(i, i + k)}
    return bool(hit) and 20 * len(hit) >= len(own)


def test_pipeline_equals_brute_force(spark, docs, texts, plain):
    import corpus_pipeline

    g = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    left = {i: t for i, t in texts.items() if 1 / (1 + np.exp(-g.bias - g.slope * np.log1p(slow_weight(g, t)))) < 0.7}
    lines = slow_lines(left.items(), 1)
    left = {i: lines[i, t] for i, t in left.items()}
    prints = {i: near_dedup.fingerprints_of(t.encode(), near_dedup.WORD_SETS) for i, t in left.items()}
    roots = {i: i for i in prints}
    for _ in range(5):
        for a in prints:
            for b in prints:
                if np.bitwise_count(prints[a] ^ prints[b]).min() <= 3:
                    roots[a] = roots[b] = min(roots[a], roots[b])
    left = {i: left[i] for i in {*roots.values()}}
    items = pd.read_parquet(f"{FOLDER}/benchmark.parquet").text.tolist()
    left = {i: t for i, t in left.items() if not slow_contaminated(t, items)}
    want = set()
    for i, t in left.items():
        ids, at = [*plain(t), 2], 0
        while at < len(ids):
            size = 1024 if at else (len(ids) - 1) % 1024 + 1
            want.add((i, at, size, zlib.crc32(np.array(ids[at : at + size], "<u4").tobytes())))
            at += size
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {(r.doc_id, r.start, r.length, r.ids_crc32) for r in rows} == want
    assert len(rows) == len(want)
    check_packing(rows, 1024)
