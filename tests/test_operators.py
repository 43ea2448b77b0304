"""Hand-sized cases of operators, and properties that hold over several of them."""

import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framewright.functions import arrays, numeric, text
from framewright.operators import aggregates, audits, joins, quantize, sequences, windows
from framewright.plans import registry
from framewright.sources import files, images, sinks
from framewright.streaming import stateful


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def frames(spark, *numbers):
    return spark.createDataFrame([(1, n) for n in numbers], "episode long, frame int")


def test_future_frame_clamps_at_the_tail(spark):
    assert rows(windows.future_frame(frames(spark, 0, 1, 2, 3, 4), ["episode"], 2), "frame", "future_frame") == [(0, 2), (1, 3), (2, 4), (3, 4), (4, 4)]


def test_exact_pairs_drop_gaps(spark):
    assert rows(windows.exact_pairs(frames(spark, 0, 1, 2, 4, 5), ["episode"], 2), "old_frame", "new_frame") == [(0, 2)]


def test_missing_ranges(spark):
    assert rows(windows.missing_ranges(frames(spark, *range(8)), frames(spark, 2, 5), ["episode"], "frame"), "range_start", "range_end") == [(0, 2), (3, 5), (6, 8)]


@pytest.mark.parametrize(
    ("ordinals", "chunks"),
    [((1, 2, 3, 7, 9, 10), [(0, 1, 4), (1, 7, 8), (1, 9, 11)]), ((1, 2, 4, 5, 6, 7), [(0, 1, 3), (1, 4, 7), (2, 7, 8)]), ((0, 1, 2, 3, 4, 5, 6), [(0, 0, 3), (1, 3, 6), (2, 6, 7)])],
)
def test_greedy_chunks(spark, ordinals, chunks):
    assert rows(windows.greedy_chunks(frames(spark, *ordinals), ["episode"], "frame", 3), "chunk", "range_start", "range_end") == chunks


def test_runs(spark):
    df = spark.createDataFrame([(1, t, f) for t, f in enumerate([True, True, False, True, True, True, True, True])], "episode long, t int, g boolean")
    got = rows(windows.runs_of(df, ["episode"], "t", "g"), "t", "run")
    assert [t for t, run in got if run >= 5] == [7]


def test_collisions(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 3), ("a", 2, 4)], "dataset string, stored int, size int")
    r = aggregates.collisions(df, ["dataset", "stored"], "size").first()
    assert tuple(r) == (12, 9, 3, 1)


def test_join_gates(spark):
    labels = spark.createDataFrame([("d", 1, 0), ("d", 1, 1), ("d", 1, 2)], "dataset string, episode int, frame int")
    vision = labels.limit(2).withColumn("vision", F.lit(7))
    keys = ["dataset", "episode", "frame"]
    assert joins.canonical_join(labels, vision, keys, "drop").count() == 2
    assert joins.miss_count(labels, vision, keys).first()[0] == 1
    assert joins.canonical_join(labels, vision, keys, "count").filter("missed").count() == 1
    with pytest.raises(Exception, match="no vision row for"):
        joins.canonical_join(labels, vision, keys, "fail").collect()


def test_audit_gate(spark):
    with pytest.raises(audits.AuditFailure, match="repeated"):
        audits.gate(audits.repeated_keys(frames(spark, 1, 1), ["episode", "frame"]), "repeated frames")
    audits.gate(audits.repeated_keys(frames(spark, 1, 2), ["episode", "frame"]), "repeated frames")


def test_bins(spark):
    e = F.array(*(F.lit(float(x)) for x in range(4)))
    got = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 1.0, 2.5, 3.0, 9.0, float("nan"), None)], "x double").select(numeric.assign_bin(F.col("x"), e).alias("b"))
    assert [r.b for r in got.collect()] == [0, 0, 1, 2, 2, 2, None, None]
    assert tuple(spark.range(1).select(*(numeric.bin_middle(e, F.lit(i)) for i in (0, 2, 3))).first()) == (0.5, 2.5, 1.0)


def test_trial_expansion(spark):
    df = spark.createDataFrame([(0.5,), (float("nan"),), (None,)], "s double").select(aggregates.expand_trials(F.lit(5), F.col("s")).alias("t"))
    assert [r.t for r in df.collect()] == [[1, 1, 0, 0, 0], [0] * 5, [0] * 5]


def test_spread(spark):
    got = spark.range(1).select(arrays.spread(F.lit(10), 4), arrays.spread(F.lit(5), 1), arrays.spread(F.lit(31), 23)).first()
    assert got[0] == [0, 3, 6, 9]
    assert got[1] == [0]
    assert got[2][-1] == 30


@pytest.mark.parametrize(("n", "chunks"), [(5, 1), (6, 2), (3, 0), (4, 1)])
def test_chunks_need_more_than_one_token_over(spark, n, chunks):
    df = spark.createDataFrame([(i, [i]) for i in range(n)], "i int, seq array<int>")
    got = sequences.concat_and_chunk(df, ["i"], "seq", 2).orderBy("chunk_id").collect()
    assert len(got) == chunks
    for r in got:
        assert r.inputs == [2 * r.chunk_id, 2 * r.chunk_id + 1]
        assert r.targets == [x + 1 for x in r.inputs]


def test_text_packing_takes_every_byte(spark, tmp_path):
    rows = [(1, 1, "a long turn of more than three characters"), (1, 2, "ab"), (2, 1, None), (2, 2, ""), (2, 3, "é日本 \U0001f600"), (3, 1, "x" * 100)]
    spark.createDataFrame(rows, "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    stream = b"".join((text or "").encode() for _, _, text in rows)
    want = [",".join(map(str, stream[i : i + 32])) for i in range(0, len(stream), 32) if i + 33 < len(stream)]
    got = registry.QUERIES["t14_text_packing"](spark, str(tmp_path)).orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.inputs) for r in got] == [*enumerate(want)]


def test_rotations_of_all_angles(spark, tmp_path):
    values = [0.0, 150.0, 250.0, 310.0, 320.0, 560.0, 700.0, -100.0, -400.0]
    spark.createDataFrame([*enumerate(values)], "event_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    turn = [math.remainder(v / 100, 2 * math.pi) for v in values]
    got = {q: registry.QUERIES[q](spark, str(tmp_path)).orderBy("event_id").collect() for q in ("f18_quaternion", "f22_euler_to_axis_angle")}
    for found in got.values():
        assert [r.angle for r in found] == pytest.approx([abs(a) for a in turn], abs=1e-6)
    assert all(r.ok for r in got["f18_quaternion"])
    assert [r.z for r in got["f22_euler_to_axis_angle"]] == [(a > 0) - (a < 0) for a in turn]


def test_turns_of_more_than_a_chord_shows(spark, tmp_path):
    values = [0.0, 300.0, 628.31, 628.32, 700.0, 1256.64, 1300.0, 99999.99, math.inf, math.nan, -700.0, None]
    spark.createDataFrame([*enumerate(values)], "event_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = registry.QUERIES["f21_chordal_angle"](spark, str(tmp_path)).orderBy("event_id").collect()
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
        want = c.execute(registry.ORACLES["f21_chordal_angle"] + " ORDER BY event_id").fetchall()
    assert [r.event_id for r in got] == [k for k, _ in want] == list(range(10))
    assert [r.angle for r in got] == pytest.approx([x for _, x in want], abs=1e-9, nan_ok=True)


def test_chordal_angle_of_half_a_turn_and_of_no_number(spark):
    turn = lambda *v: F.array(*(F.lit(float(x)) for x in v))
    same = turn(1, 0, 0, 0, 1, 0, 0, 0, 1)
    got = spark.range(1).select(numeric.chordal_angle(turn(-1, 0, 0, 0, -1, 0, 0, 0, 1), same), numeric.chordal_angle(turn(math.nan, 0, 0, 0, 1, 0, 0, 0, 1), same)).first()
    assert got[0] == pytest.approx(math.pi / 2)
    assert math.isnan(got[1])


def test_pearson_is_one_for_identical_vectors(spark):
    df = spark.createDataFrame([("t", 0.5, 0.5), ("t", 0.5, 0.5)], "task string, s double, r double")
    assert aggregates.pearson(df, ["task"], "s", "r").first()["pearson"] == 1


#: Published success rates (task, policy, simulated, real) of one task.
COKE = [("rt-2-x", 0.787, 0.907), ("rt-1-converged", 0.857, 0.853), ("rt-1-15pct", 0.710, 0.920), ("rt-1-x", 0.567, 0.760), ("rt-1-begin", 0.027, 0.133), ("octo-base", 0.170, 0.293)]


def test_golden_agreement(spark):
    df = spark.createDataFrame([("coke", *r) for r in COKE], "task string, policy string, s double, r double")
    assert aggregates.pearson(df, ["task"], "s", "r").first()["pearson"] == pytest.approx(0.975434, abs=1e-6)
    assert aggregates.mean_maximum_rank_violation(df, ["task"], "policy", "s", "r").first()["mmrv"] == pytest.approx(0.031333, abs=1e-6)


def test_kruskal(spark):
    data = [("k", "a", x) for x in (1.0, 3.0, 5.0, 7.0, 9.0)] + [("k", "b", x) for x in (2.0, 4.0, 6.0, 8.0, 10.0)] + [("same", g, 1.0) for g in "ab" for _ in range(3)]
    got = {r.key: r for r in aggregates.kruskal(spark.createDataFrame(data, "key string, g string, v double"), ["key"], "g", "v").collect()}
    assert got["k"].h == pytest.approx(0.272727, abs=1e-6)
    assert got["k"].p_value == pytest.approx(0.601508, abs=1e-6)
    assert got["same"].p_value == 1.0


@given(st.floats(0.01, 60), st.integers(1, 12))
@settings(max_examples=60, deadline=None)
def test_chi_square_tail_falls(h, k):
    p = aggregates.chi_square_tail(h, k)
    assert 0 <= p <= 1
    assert aggregates.chi_square_tail(h + 1, k) <= p
    if k == 2:
        assert p == pytest.approx(math.exp(-h / 2), rel=1e-9)


@given(st.integers(0, 500), st.integers(1, 40))
@settings(max_examples=100, deadline=None)
def test_rank_ranges_cover(n, ranks):
    ranges = [(n * r // ranks, n * (r + 1) // ranks) for r in range(ranks)]
    assert [x for a, b in ranges for x in range(a, b)] == [*range(n)]


def test_tolerant_json(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{bad\n{"a": 2}\n')
    good, bad = files.jsonl_tolerant(spark, f"file://{tmp_path}/x.jsonl", "a long")
    assert rows(good, "a") == [(1,), (2,)]
    assert rows(bad, "line") == [("{bad",)]


def test_publish_leaves_the_target_alone_when_an_audit_fails(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    sinks.publish(frames(spark, 1, 2), path, lambda d: None)

    def refuse(d):
        raise audits.AuditFailure("no")

    with pytest.raises(audits.AuditFailure):
        sinks.publish(frames(spark, 9), path, refuse)
    assert rows(spark.read.json(path), "frame") == [(1,), (2,)]


def test_coercion():
    assert [text.coerce(x) for x in ("3", "-2.5", "1e3", "True", "abc")] == [3, -2.5, 1000.0, True, "abc"]


def test_sticky_stream_equals_batch(spark, tmp_path):
    moves = [0.1, 0.9, 0.0, -0.8, 0.0, 0.0, 0.7, 0.1]
    for half, part in enumerate((moves[:3], moves[3:])):
        spark.createDataFrame([(1, 3 * half + i, m) for i, m in enumerate(part)], "episode long, t long, move double").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    stream = spark.readStream.schema("episode long, t long, move double").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    got = [v for _, v in rows(stateful.run_to_table(stateful.sticky_stream(stream, 0.5, 3), "sticky"), "t", "sticky")]
    assert got == windows.held_moves(np.array(moves), 0.5, 3)[0].tolist()


def test_empty_tables(spark):
    none = frames(spark, 1).limit(0)
    assert windows.future_frame(none, ["episode"], 3).count() == 0
    assert windows.greedy_chunks(none, ["episode"], "frame", 3).count() == 0
    assert aggregates.code_histogram(spark.createDataFrame([], "c array<int>"), "c", 8).filter("n = 0").count() == 8


def test_held_moves_equal_a_step_by_step_rule():
    rng = np.random.default_rng(3)
    for hold in (1, 3, 15):
        for n in (0, 1, 7, 60):
            moves = np.round(rng.normal(0, 0.6, n), 2)
            want, until, at_trigger = [], -1, 0.0
            for i, v in enumerate(moves.tolist()):
                if i > until and abs(v) > 0.5:
                    until, at_trigger = i + hold - 1, v
                want.append(at_trigger if i <= until else v)
            assert windows.held_moves(moves, 0.5, hold)[0].tolist() == want
            out, left, kept = [], 0, 0.0
            for part in np.array_split(moves, 4):
                x, left, kept = windows.held_moves(part, 0.5, hold, left, kept)
                out += x.tolist()
            assert out == want


def test_many_ties_are_no_overflow(spark):
    df = spark.range(3_000_000).selectExpr("1 AS k", "id % 2 AS g", "CASE WHEN id < 10 THEN 1 ELSE 0 END AS v")
    row = aggregates.kruskal(df, ["k"], "g", "v").first()
    assert row.h == pytest.approx(0, abs=1e-6)
    assert row.p_value == pytest.approx(1, abs=1e-3)


def test_publish_keeps_one_whole_target(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.publish(spark.range(3), path, lambda df: None)
    sinks.publish(spark.range(5), path, lambda df: None)
    assert spark.read.json(path).count() == 5

    def fails(df):
        raise ValueError

    with pytest.raises(ValueError):
        sinks.publish(spark.range(9), path, fails)
    assert spark.read.json(path).count() == 5
    (tmp_path / "out").rename(tmp_path / "out.old")  # as a crash between the moves leaves it
    with pytest.raises(ValueError):
        sinks.publish(spark.range(9), path, fails)
    sinks.publish(spark.range(7), path, lambda df: None)
    assert spark.read.json(path).count() == 7
    assert sorted(x.name for x in tmp_path.iterdir()) == ["out"]


def test_cardinality_gate(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,)], "e long")
    for expected, passes in (((3, 2), True), ((4, 2), False), ((3, 3), False)):
        gate = audits.cardinality(rows, "e", spark.createDataFrame([expected], "expected_rows long, expected_episodes long"))
        assert gate.first().passes == passes
        if passes:
            assert audits.require(gate).first().passes
        else:
            with pytest.raises(Exception, match="expected"):
                audits.require(gate).collect()


def test_nearest_code_over_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    book, x = rng.normal(size=(30, 4)).round(2), rng.normal(size=(50, 4)).round(2)
    codes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(book)], "code long, entry array<double>")
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i long, v array<double>")
    want = ((x[:, None] - book) ** 2).sum(-1).argmin(1).tolist()
    for block in (4096, 7):
        monkeypatch.setattr(quantize, "BLOCK", block)
        assert [r.nearest for r in quantize.nearest_code(vectors, codes, "v", "code", "entry").orderBy("i").collect()] == want
    assert quantize.nearest_code(vectors, codes.limit(0), "v", "code", "entry").filter("nearest IS NOT NULL").count() == 0


def test_images_round_trip(spark, tmp_path):
    rng = np.random.default_rng(5)
    for channels in (1, 3, 4):
        pixels = rng.integers(0, 256, (7, 9, channels), dtype=np.uint8)
        assert (images.decode(images.encode(pixels)) == pixels).all()
    gray = rng.integers(0, 256, (4, 6, 1), dtype=np.uint8)
    assert (images.decode(b"P5\n6 4\n255\n" + gray.tobytes()) == gray).all()
    # each filter of the format undoes what its definition does
    above, row = rng.integers(0, 256, 12, dtype=np.uint8), rng.integers(0, 256, 12, dtype=np.uint8)
    for kind in range(5):
        coded = []
        for i in range(12):
            left, up, corner = (int(row[i - 3]) if i > 2 else 0), int(above[i]), (int(above[i - 3]) if i > 2 else 0)
            nearest = sorted((abs(left + up - corner - x), k, x) for k, x in enumerate((left, up, corner)))[0][2]
            coded.append((int(row[i]) - (0, left, up, (left + up) // 2, nearest)[kind]) & 255)
        assert images._unfiltered(np.array(coded, np.uint8), kind, above, 3).tolist() == row.tolist()
    (tmp_path / "a.png").write_bytes(images.encode(pixels))
    (tmp_path / "b.png").write_bytes(b"no image")
    got = {r.path[-5:]: r for r in images.images(spark, f"file://{tmp_path}").collect()}
    assert (got["a.png"].height, got["a.png"].width, bytes(got["a.png"].pixels)) == (7, 9, pixels.tobytes())
    assert got["b.png"].error
    assert got["b.png"].pixels is None
