"""Queries over keyed joins: lineitem rows are labels and vision rows, orders the manifest."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import windows as W
from .registry import FRAMES, Tables, query
from .windows import HOLES, holes

KEYS = ["dataset", "episode", "frame"]


def labels(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_returnflag").alias("dataset"), F.col("l_orderkey").alias("episode"), F.col("l_linenumber").alias("frame"), F.col("l_partkey").alias("code"))


def vision(t: Tables) -> DataFrame:
    return t.lineitem.filter("l_linestatus = 'O'").select(F.col("l_returnflag").alias("dataset"), F.col("l_orderkey").alias("episode"), F.col("l_linenumber").alias("frame"), F.col("l_quantity").alias("vision"))


LV = "l AS (SELECT l_returnflag AS dataset, l_orderkey AS episode, l_linenumber AS frame, l_partkey AS code FROM lineitem), v AS (SELECT l_returnflag AS dataset, l_orderkey AS episode, l_linenumber AS frame, l_quantity AS vision FROM lineitem WHERE l_linestatus = 'O')"


@query("j1_canonical_join", f"WITH {LV} SELECT l.*, v.vision FROM l JOIN v USING (dataset, episode, frame)")
def j1(t: Tables) -> DataFrame:
    return J.canonical_join(labels(t), vision(t), KEYS, "drop")


@query("j2_manifest_lookup", "SELECT l_orderkey AS episode, l_linenumber AS frame, o_orderdate AS recorded, o_orderpriority AS source FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def j2(t: Tables) -> DataFrame:
    manifest = t.orders.select(F.col("o_orderkey").alias("episode"), F.col("o_orderdate").alias("recorded"), F.col("o_orderpriority").alias("source"))
    return J.canonical_join(t.lineitem.select(F.col("l_orderkey").alias("episode"), F.col("l_linenumber").alias("frame")), manifest, ["episode"])


@query("j3_file_identity_join", "SELECT c_name AS path, n_name AS dataset, c_custkey AS episode FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_name = concat('Customer#', lpad(c_custkey::VARCHAR, (length(c_name) - 9)::INT, '0'))")
def j3(t: Tables) -> DataFrame:
    stored = t.customer.withColumn("read", F.regexp_extract("c_name", "#0*(\\d+)$", 1).cast("long"))
    return stored.filter("read = c_custkey").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_name").alias("path"), F.col("n_name").alias("dataset"), F.col("c_custkey").alias("episode"))


@query("j4_join_with_miss_flag", f"WITH {LV} SELECT l.*, v.vision, v.vision IS NULL AS missed FROM l LEFT JOIN v USING (dataset, episode, frame)")
def j4(t: Tables) -> DataFrame:
    return J.canonical_join(labels(t), vision(t), KEYS, "count")


@query("j5_last_write_wins", "SELECT l_orderkey AS episode, arg_max(l_partkey, (l_shipdate, l_linenumber, l_partkey)) AS code FROM lineitem GROUP BY l_orderkey")
def j5(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_orderkey").alias("episode"), F.col("l_partkey").alias("code"), "l_shipdate", "l_linenumber")
    return J.last_wins(rows, ["episode"], ["l_shipdate", "l_linenumber", "code"], ["code"])


@query("j7_index_then_frames", f"WITH {LV} SELECT v.episode, v.frame, v.vision, o_custkey AS source FROM orders JOIN v ON v.episode = o_orderkey WHERE o_orderstatus = 'O' AND o_orderpriority LIKE '1%'")
def j7(t: Tables) -> DataFrame:
    index = t.orders.filter("o_orderstatus = 'O' AND o_orderpriority LIKE '1%'").select(F.col("o_orderkey").alias("episode"), F.col("o_custkey").alias("source"))
    return vision(t).join(index, "episode").select("episode", "frame", "vision", "source")


@query("j9_clamped_self_join", f"WITH {FRAMES} SELECT episode, event_id, coalesce(lead(event_id, 5) OVER (PARTITION BY episode ORDER BY frame), last_value(event_id) OVER (PARTITION BY episode ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS future_event FROM f")
def j9(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("episode").orderBy("frame")
    last = F.last("event_id").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return t.frames.select("episode", "event_id", F.coalesce(F.lead("event_id", 5).over(w), last).alias("future_event"))


@query("j10_exact_self_join", f"WITH {HOLES} SELECT a.episode, a.frame AS old_frame, b.frame AS new_frame FROM (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY frame) AS k FROM g) a JOIN (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY frame) AS k FROM g) b ON a.episode = b.episode AND b.k = a.k + 2 AND b.frame = a.frame + 2")
def j10(t: Tables) -> DataFrame:
    return W.exact_pairs(holes(t), ["episode"], 2).select("episode", "old_frame", "new_frame")


@query("j11_first_exact_pair", f"WITH {HOLES}, p AS (SELECT episode, lag(frame, 4) OVER (PARTITION BY episode ORDER BY frame) AS old_frame, frame AS new_frame FROM g) SELECT episode, min(old_frame)::INT AS old_frame, min(new_frame)::INT AS new_frame FROM p WHERE new_frame - old_frame = 4 GROUP BY episode")
def j11(t: Tables) -> DataFrame:
    return W.exact_pairs(holes(t), ["episode"], 4).groupBy("episode").agg(F.min("old_frame").alias("old_frame"), F.min("new_frame").alias("new_frame"))


@query("j12_next_file_clamped", f"WITH {FRAMES}, n AS (SELECT episode, count(*) AS n FROM f GROUP BY episode) SELECT f.episode, f.frame, least(f.frame + 6, n.n - 1)::BIGINT AS next_step, b.event_id AS next_event_id FROM f JOIN n USING (episode) JOIN f b ON b.episode = f.episode AND b.frame = least(f.frame + 6, n.n - 1)")
def j12(t: Tables) -> DataFrame:
    return J.neighbours_clamped(t.frames.select("episode", "frame", "event_id"), "episode", "frame", 6).select("episode", "frame", F.col("next_step").cast("long").alias("next_step"), "next_event_id")


@query("j13_pending_anti_join", "SELECT o_orderkey AS episode FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def j13(t: Tables) -> DataFrame:
    done = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("episode")).distinct()
    return J.pending(t.orders.select(F.col("o_orderkey").alias("episode")), done, ["episode"])


@query("j14_wanted_semi_join", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def j14(t: Tables) -> DataFrame:
    listed = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return J.wanted(t.lineitem.select("l_orderkey", "l_linenumber"), listed, ["l_orderkey"])


@query("j15_existence_after_repair", "SELECT count(*) AS n_missing FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def j15(t: Tables) -> DataFrame:
    return J.miss_count(t.orders.select(F.col("o_orderkey").alias("episode")), t.lineitem.select(F.col("l_orderkey").alias("episode")), ["episode"]).withColumnRenamed("n_missed", "n_missing")


@query("j18_zip_by_step", f"WITH {FRAMES} SELECT a.episode, a.frame, round(a.value - b.value, 6) AS error FROM f a JOIN (SELECT episode, frame - 1 AS frame, value FROM f) b USING (episode, frame)")
def j18(t: Tables) -> DataFrame:
    truth = t.frames.select("episode", (F.col("frame") - 1).alias("frame"), F.col("value").alias("truth"))
    return t.frames.join(truth, ["episode", "frame"]).select("episode", "frame", F.round(F.col("value") - F.col("truth"), 6).alias("error"))


@query("j19_parameter_grid", "SELECT x / 10.0::DOUBLE AS robot_x, y / 10.0::DOUBLE AS robot_y, r_regionkey AS variant FROM unnest(generate_series(0, 4)) AS a(x), unnest(generate_series(0, 4)) AS b(y), region")
def j19(t: Tables) -> DataFrame:
    x = t.spark.range(5).select((F.col("id") / 10.0).alias("robot_x"))
    y = t.spark.range(5).select((F.col("id") / 10.0).alias("robot_y"))
    return J.grid(x, y, t.region.select(F.col("r_regionkey").alias("variant")))


@query("j20_zip_batch_with_output", f"WITH {FRAMES} SELECT episode, frame, ((frame * 3 + 1) % 8)::INT AS code FROM f")
def j20(t: Tables) -> DataFrame:
    from ..operators.quantize import score_batches

    return score_batches(t.frames.select("episode", "frame"), lambda pdf: (pdf["frame"] * 3 + 1) % 8, "code int")


@query("j8_split_index_join", f"WITH {LV} SELECT v.episode, count(*) AS n_frames, min(o_custkey) AS source FROM orders JOIN v ON v.episode = o_orderkey WHERE o_orderstatus = 'O' GROUP BY v.episode")
def j8(t: Tables) -> DataFrame:
    """Index and frames of an episode meet in one partition: both sides are dealt by episode, and the count needs no shuffle more."""
    index = t.orders.filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("episode"), F.col("o_custkey").alias("source"))
    return vision(t).join(index, "episode").groupBy("episode").agg(F.count("*").alias("n_frames"), F.min("source").alias("source"))
