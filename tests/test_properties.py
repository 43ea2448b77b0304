"""Properties over random inputs, checked against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from framewright import ship
from framewright.functions import arrays, numeric, text
from framewright.operators import joins, quantize, sequences, windows
from framewright.sources import files


@pytest.fixture(scope="module")
def rng():
    return random.Random(17)


def episodes(spark, rng, n=40, holes=0.2):
    rows = [(e, f) for e in range(n) for f in range(rng.randint(0, 30)) if rng.random() > holes]
    return rows, spark.createDataFrame(rows, "episode long, frame int")


def test_every_frame_has_one_future(spark, rng):
    rows, df = episodes(spark, rng)
    got = windows.future_frame(df, ["episode"], 7).collect()
    assert sorted((r.episode, r.frame) for r in got) == sorted(rows)
    by = {}
    for e, f in sorted(rows):
        by.setdefault(e, []).append(f)
    for r in got:
        fs = by[r.episode]
        assert r.future_frame == fs[min(fs.index(r.frame) + 7, len(fs) - 1)]


def test_ranges_are_the_pending_set(spark, rng):
    rows, done = episodes(spark, rng)
    expected = [(e, f) for e in range(40) for f in range(31)]
    ranges = windows.missing_ranges(spark.createDataFrame(expected, "episode long, frame int"), done, ["episode"], "frame").collect()
    assert sorted((r.episode, f) for r in ranges for f in range(r.range_start, r.range_end)) == sorted({*expected} - {*rows})
    starts = {(r.episode, r.range_start) for r in ranges}
    assert not starts & {(r.episode, r.range_end) for r in ranges}  # ranges don't touch


@pytest.mark.parametrize("most", [1, 3, 8])
def test_chunks_hold_all_ordinals_within_their_size(spark, rng, most):
    rows, df = episodes(spark, rng)
    got = windows.greedy_chunks(df, ["episode"], "frame", most).collect()
    assert sorted((r.episode, f) for r in got for f in range(r.range_start, r.range_end)) == sorted(rows)
    size = {}
    for r in got:
        size[r.episode, r.chunk] = size.get((r.episode, r.chunk), 0) + r.range_end - r.range_start
    assert max(size.values()) <= most


def test_exact_pairs_are_an_equi_join(spark, rng):
    _, df = episodes(spark, rng, holes=0)
    pairs = windows.exact_pairs(df, ["episode"], 4)
    other = df.withColumnRenamed("frame", "new_frame").withColumn("old_frame", F.col("new_frame") - 4).join(df.withColumnRenamed("frame", "old_frame"), ["episode", "old_frame"])
    assert sorted((r.episode, r.old_frame) for r in pairs.collect()) == sorted((r.episode, r.old_frame) for r in other.collect())


def test_bins_invert_within_their_bin(spark, rng):
    xs = [(rng.gauss(0, 5),) for _ in range(500)]
    df = spark.createDataFrame(xs, "x double")
    edges = numeric.quantile_edges(df, ["x"], 16).filter("dim = 0").select("edges")
    got = df.crossJoin(edges).withColumn("bin", numeric.assign_bin(F.col("x"), F.col("edges"))).withColumn("middle", numeric.bin_middle(F.col("edges"), F.col("bin"))).collect()
    for r in got:
        assert r.edges[r.bin] <= r.x <= r.edges[r.bin + 1]
        assert r.edges[r.bin] <= r.middle <= r.edges[r.bin + 1]


def test_ensemble_of_equal_predictions_is_that_prediction(spark):
    df = spark.createDataFrame([(1, t, [2.5] * 4) for t in range(9)], "e int, t int, p array<double>")
    assert all(r.ensembled == pytest.approx(2.5) for r in windows.temporal_ensemble(df, ["e"], "t", "p", 4, 0.3).collect())


def test_ensemble_weighs_the_oldest_first(spark):
    df = spark.createDataFrame([(1, 0, [0.0, 10.0]), (1, 1, [4.0, 0.0])], "e int, t int, p array<double>")
    last = windows.temporal_ensemble(df, ["e"], "t", "p", 2, 0.5).orderBy("t").collect()[1].ensembled
    w = [1.0, 2.718281828459045**-0.5]
    assert last == pytest.approx((10 * w[0] + 4 * w[1]) / sum(w))


def test_nearest_code_ties_go_to_the_lowest(spark):
    book = spark.createDataFrame([(0, [0.0, 2.0]), (1, [1.0, 0.0]), (2, [-1.0, 0.0])], "code int, entry array<double>")
    x = spark.createDataFrame([(7, [0.0, 0.0])], "i int, v array<double>")
    r = quantize.nearest_code(x, book, "v", "code", "entry").first()
    assert (r.nearest, r.distance) == (1, 1.0)


def test_masks_stay_aligned(spark):
    df = spark.createDataFrame([("do it", "ok", [9, 1, 2, 3], [4, 5, 6, 7], [1, 2])], "instruction string, answer string, vision array<int>, delta array<int>, action array<int>")
    for kind in sequences.KINDS:
        seq = sequences.sequences(df, kind, per_frame=2).first().seq
        assert seq[0].token == sequences.BOS
        assert (seq[0].loss, seq[-1].loss) == (0.0, 1.0)
        if "delta" in kind:
            assert [t.token for t in seq if t.delta] == [4, 5, 6, 7]
        if "vision" in kind:
            assert [t.token for t in seq if t.vision] == [9, 1, sequences.END_OF_FRAME, 2, 3, sequences.END_OF_VISION]


def test_frames_are_sampled_evenly(spark):
    df = spark.createDataFrame([("x", [*range(10)])], "instruction string, vision array<int>")
    seq = sequences.sequences(df, "vision_text", per_frame=1, max_frames=4).first().seq
    assert [t.token for t in seq if t.vision and t.token < 100] == [0, 3, 6, 9]


def test_quirk_moves_the_loss_of_cut_sequences_only(spark):
    ids = [(list(range(20)),), (list(range(5)),)]
    df = spark.createDataFrame(ids, "t array<int>").withColumn("seq", F.transform("t", lambda x: F.struct(x.alias("token"), x.cast("float").alias("loss"))))
    pad = F.struct(F.lit(0).alias("token"), F.lit(0.0).cast("float").alias("loss"))
    plain = [r[0] for r in df.select(sequences.padded(F.col("seq"), 8, pad)[2]).collect()]
    early = [r[0] for r in df.select(sequences.padded(F.col("seq"), 8, pad, aligned=False)[2]).collect()]
    assert plain[0] == [float(x) for x in range(1, 9)]
    assert early[0] == [float(x) for x in range(2, 10)]
    assert early[1] == plain[1]


def test_last_write_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, n int, v string")
    assert sorted(map(tuple, joins.last_wins(df, ["k"], ["n"], ["v"]).collect())) == [("a", "y"), ("b", "z")]


def test_split_sizes(spark):
    rows = ['{"splits": [{"name": "train", "shardLengths": ["3", "4"]}]}', '{"splits": [{"name": "train", "numExamples": 9}]}', '{"splits": {"train": {"shardLengths": ["5"]}}}', '{"splits": []}', "not json", None]
    got = spark.createDataFrame([(r,) for r in rows], "info string").select(files.split_size(F.col("info"), "train").alias("n")).collect()
    assert [r.n for r in got] == [7, 9, 5, None, None, None]


@pytest.mark.parametrize(("given", "kind"), [("3", "int"), ("-2", "int"), ("2.5", "float"), ("1e3", "float"), (".5", "float"), ("TRUE", "bool"), ("x1", "str"), ("", "str")])
def test_kinds_of_values(spark, given, kind):
    assert spark.createDataFrame([(given,)], "v string").select(text.coerced_kind(F.col("v"))).first()[0] == kind


def test_bytes_that_are_no_text(spark):
    df = spark.createDataFrame([(bytearray(b"ab\xffc"),)], "raw binary")
    assert df.select(text.lossy(F.col("raw"))).first()[0] == "ab�c"


def test_last_rise(spark):
    cases = [([True, False, True, False, True], 3), ([False, True, True], None), ([True, True], None), ([True, False, True], 1), ([], None)]
    for mask, want in cases:
        df = spark.createDataFrame([(mask,)], "m array<boolean>")
        assert df.select(arrays.last_rise(F.col("m"))).first()[0] == want


def test_rotations_round_trip(spark):
    got = spark.range(1).select(
        F.degrees(numeric.angle(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(2.0)))),
        numeric.euler_to_axis_angle(F.lit(0.0), F.lit(0.4), F.lit(0.0)),
        numeric.unit(F.array(F.lit(0.0), F.lit(0.0))),
    ).first()
    assert got[0] == pytest.approx(90)
    assert got[1] == pytest.approx([0, 1, 0, 0.4])
    assert got[2] == [0.0, 0.0]


def test_package_is_shipped_once(spark):
    ship(spark)
    ship(spark)
    assert spark.range(4).mapInPandas(lambda batches: (b.assign(id=len(__import__("framewright").__name__)) for b in batches), "id long").first()[0] == len("framewright")
