"""Queries over positional windows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import windows as W
from .registry import FRAMES, Tables, query

ID = "concat_ws('|', 'events', episode::VARCHAR, frame::VARCHAR)"


@query("w1_future_frame_pairing", f"WITH {FRAMES} SELECT {ID} AS id, episode, frame, coalesce(lead(frame, 30) OVER w, max(frame) OVER (PARTITION BY episode))::INT AS future_frame, instruction FROM f WINDOW w AS (PARTITION BY episode ORDER BY frame)")
def w1(t: Tables) -> DataFrame:
    return W.future_frame(t.frames, ["episode"], 30).select(F.concat_ws("|", F.lit("events"), "episode", "frame").alias("id"), "episode", "frame", "future_frame", "instruction")


#: Frames with holes: every seventh event is missing.
HOLES = f"{FRAMES}, g AS (SELECT * FROM f WHERE event_id % 7 <> 0)"


def holes(t: Tables) -> DataFrame:
    return t.frames.filter("event_id % 7 <> 0")


@query("w2_exact_offset_pairs", f"WITH {HOLES}, p AS (SELECT episode, lag(frame, 3) OVER (PARTITION BY episode ORDER BY frame) AS old_frame, frame AS new_frame FROM g) SELECT * FROM p WHERE new_frame - old_frame = 3")
def w2(t: Tables) -> DataFrame:
    return W.exact_pairs(holes(t), ["episode"], 3).select("episode", "old_frame", "new_frame")


@query("w3_discontinuities", f"WITH {HOLES}, p AS (SELECT episode, frame, lag(frame) OVER (PARTITION BY episode ORDER BY frame) AS before FROM g) SELECT episode, count(*) AS n_frames, count(*) FILTER (WHERE frame <> before + 1) AS n_breaks FROM p GROUP BY episode")
def w3(t: Tables) -> DataFrame:
    return W.discontinuities(holes(t), ["episode"])


@query("w4_dense_order", "WITH p AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS n FROM lineitem) SELECT l_orderkey, bool_and(l_linenumber = n) AS is_dense, count(*) AS n_lines FROM p GROUP BY l_orderkey")
def w4(t: Tables) -> DataFrame:
    numbered = W.numbered_frames(t.lineitem.select("l_orderkey", "l_linenumber"), ["l_orderkey"], ["l_linenumber"])
    return numbered.groupBy("l_orderkey").agg(F.bool_and(F.col("l_linenumber") == F.col("frame") + 1).alias("is_dense"), F.count("*").alias("n_lines"))


@query("w5_missing_ranges", f"WITH {HOLES}, m AS (SELECT episode, frame FROM f WHERE frame NOT IN (SELECT g.frame FROM g WHERE g.episode = f.episode)), p AS (SELECT episode, frame, frame - row_number() OVER (PARTITION BY episode ORDER BY frame) AS k FROM m) SELECT episode, min(frame)::INT AS range_start, (max(frame) + 1)::INT AS range_end FROM p GROUP BY episode, k")
def w5(t: Tables) -> DataFrame:
    return W.missing_ranges(t.frames, holes(t), ["episode"], "frame")


@query("w6_record_ranges", f"WITH {HOLES}, p AS (SELECT episode, frame, frame - row_number() OVER (PARTITION BY episode ORDER BY frame) AS k FROM g) SELECT episode, min(frame)::INT AS range_start, (max(frame) + 1)::INT AS range_end FROM p GROUP BY episode, k")
def w6(t: Tables) -> DataFrame:
    return W.islands(holes(t), ["episode"], "frame")


@query("w7_greedy_chunks")
def w7(t: Tables) -> DataFrame:
    return W.greedy_chunks(holes(t), ["episode"], "frame", 5)


GRASP = f"{FRAMES}, g AS (SELECT *, value > 20 AS grasped, value > 60 AS lifted FROM f)"


def grasps(t: Tables) -> DataFrame:
    return t.frames.withColumns({"grasped": F.col("value") > 20, "lifted": F.col("value") > 60})


@query("w8_run_length", f"WITH {GRASP}, i AS (SELECT *, sum(CASE WHEN grasped THEN 0 ELSE 1 END) OVER (PARTITION BY episode ORDER BY frame) AS k FROM g), r AS (SELECT episode, frame, grasped, sum(CASE WHEN grasped THEN 1 ELSE 0 END) OVER (PARTITION BY episode, k ORDER BY frame)::INT AS run FROM i) SELECT episode, frame, grasped, run, run >= 5 AS held FROM r")
def w8(t: Tables) -> DataFrame:
    return W.runs_of(grasps(t), ["episode"], "frame", "grasped").select("episode", "frame", "grasped", "run", (F.col("run") >= 5).alias("held"))


@query("w9_latched_state", f"WITH {GRASP}, i AS (SELECT *, sum(CASE WHEN grasped THEN 0 ELSE 1 END) OVER (PARTITION BY episode ORDER BY frame) AS k FROM g) SELECT episode, frame, bool_or(grasped AND lifted) OVER (PARTITION BY episode, k ORDER BY frame) AS latched FROM i")
def w9(t: Tables) -> DataFrame:
    return W.latched(grasps(t), ["episode"], "frame", "grasped", "lifted").select("episode", "frame", "latched")


@query("w10_history_window", f"WITH {FRAMES}, h AS (SELECT episode, frame, list(event_id) OVER (PARTITION BY episode ORDER BY frame ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS h FROM f) SELECT episode, frame, array_to_string(h, ',') AS history, (4 - len(h))::INT AS n_pad FROM h")
def w10(t: Tables) -> DataFrame:
    return W.history(t.frames, ["episode"], "frame", "event_id", 4).select("episode", "frame", F.array_join(F.col("history").cast("array<string>"), ",").alias("history"), "n_pad")


@query("w11_temporal_ensemble", f"WITH {FRAMES}, h AS (SELECT episode, frame, list(value) OVER (PARTITION BY episode ORDER BY frame ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS h FROM f) SELECT episode, frame, round(list_sum([h[i] * (len(h) - i + 1) * exp(-0.1 * (i - 1)) FOR i IN generate_series(1, len(h))]) / list_sum([exp(-0.1 * (i - 1)) FOR i IN generate_series(1, len(h))]), 6) AS ensembled FROM h")
def w11(t: Tables) -> DataFrame:
    said = t.frames.withColumn("said", F.array(*(F.col("value") * (k + 1) for k in range(4))))
    return W.temporal_ensemble(said, ["episode"], "frame", "said", 4, 0.1).select("episode", "frame", F.round("ensembled", 6).alias("ensembled"))


@query("w12_sticky_action", f"WITH RECURSIVE {FRAMES}, m AS (SELECT episode, frame, value / 100 AS move FROM f), s AS (SELECT episode, frame, move, CASE WHEN abs(move) > 0.5 THEN 14 ELSE 0 END AS steps, move AS sticky FROM m WHERE frame = 0 UNION ALL SELECT m.episode, m.frame, m.move, CASE WHEN s.steps > 0 THEN s.steps - 1 WHEN abs(m.move) > 0.5 THEN 14 ELSE 0 END, CASE WHEN s.steps > 0 THEN s.sticky ELSE m.move END FROM s JOIN m ON m.episode = s.episode AND m.frame = s.frame + 1) SELECT episode, frame, move, sticky FROM s")
def w12(t: Tables) -> DataFrame:
    moves = t.frames.withColumn("move", F.col("value") / 100)
    return W.sticky_action(moves, ["episode"], "frame", "move", 0.5, 15)


@query("w13_difference_from_previous", f"WITH {FRAMES} SELECT episode, frame, round(coalesce(lag(value) OVER (PARTITION BY episode ORDER BY frame) - value, 0), 6) AS change FROM f")
def w13(t: Tables) -> DataFrame:
    before = F.lag("value").over(Window.partitionBy("episode").orderBy("frame"))
    return t.frames.select("episode", "frame", F.round(F.coalesce(before - F.col("value"), F.lit(0.0)), 6).alias("change"))


@query("w14_position_ids", f"WITH {GRASP} SELECT episode, frame, greatest(sum(grasped::INT) OVER (PARTITION BY episode ORDER BY frame) - 1, 0)::BIGINT AS position_id FROM g")
def w14(t: Tables) -> DataFrame:
    w = Window.partitionBy("episode").orderBy("frame").rowsBetween(Window.unboundedPreceding, 0)
    return grasps(t).select("episode", "frame", F.greatest(F.sum(F.col("grasped").cast("int")).over(w) - 1, F.lit(0)).alias("position_id"))


@query("w17_moving_average", f"WITH {FRAMES} SELECT episode, frame, round(avg(value) OVER (PARTITION BY episode ORDER BY frame ROWS BETWEEN 199 PRECEDING AND CURRENT ROW), 10) AS moving FROM f")
def w17(t: Tables) -> DataFrame:
    w = Window.partitionBy("episode").orderBy("frame").rowsBetween(-199, 0)
    return t.frames.select("episode", "frame", F.round(F.avg("value").over(w), 10).alias("moving"))


@query("w18_rank_ranges", f"WITH {FRAMES}, n AS (SELECT episode, count(*) AS n FROM f GROUP BY episode) SELECT episode, r::INT AS worker, (n * r // 8)::BIGINT AS range_start, (n * (r + 1) // 8)::BIGINT AS range_end FROM n, unnest(generate_series(0, 7)) AS s(r)")
def w18(t: Tables) -> DataFrame:
    counts = t.frames.groupBy("episode").agg(F.count("*").alias("n"))
    a, b = W.rank_ranges(F.col("n"), 8, F.col("worker"))
    return counts.withColumn("worker", F.explode(F.sequence(F.lit(0), F.lit(7)))).select("episode", "worker", a.alias("range_start"), b.alias("range_end"))


@query("a26_running_throughput", f"WITH {FRAMES} SELECT episode, frame, sum(abs(event_id)) OVER (PARTITION BY episode ORDER BY frame)::BIGINT AS total, round(avg(event_id) OVER (PARTITION BY episode ORDER BY frame ROWS BETWEEN 199 PRECEDING AND CURRENT ROW), 6) AS recent FROM f")
def a26(t: Tables) -> DataFrame:
    w = Window.partitionBy("episode").orderBy("frame")
    return t.frames.select("episode", "frame", F.sum("event_id").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("total"), F.round(F.avg("event_id").over(w.rowsBetween(-199, 0)), 6).alias("recent"))
