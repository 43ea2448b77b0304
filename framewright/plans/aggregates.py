"""Queries over aggregates. A label of an event is four codes from 0 to 7."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import quantize as V
from .registry import FRAMES, Tables, query

DELTA = "d AS (SELECT event_id, user_id AS episode, event_type AS instruction, [((event_id * 7 + k * 3) % 8)::INT FOR k IN generate_series(0, 3)] AS delta FROM events), e AS (SELECT event_id, episode, instruction, unnest(delta) AS code, generate_subscripts(delta, 1) - 1 AS position FROM d)"


def deltas(t: Tables) -> DataFrame:
    codes = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: ((F.col("event_id") * 7 + k * 3) % 8).cast("int"))
    return t.events.select("event_id", F.col("user_id").alias("episode"), F.col("event_type").alias("instruction"), codes.alias("delta"))


@query("a1_code_histogram", f"WITH {DELTA} SELECT c::INT AS code, (SELECT count(*) FROM e WHERE code = c) AS n FROM unnest(generate_series(0, 9)) AS s(c)")
def a1(t: Tables) -> DataFrame:
    return A.code_histogram(deltas(t), "delta", 10)


@query("a2_position_histogram", f"WITH {DELTA} SELECT position::INT AS position, code, count(*) AS n FROM e GROUP BY position, code")
def a2(t: Tables) -> DataFrame:
    return A.position_histogram(deltas(t), "delta")


@query("a3_code_percentage", f"WITH {DELTA} SELECT code, round(count(*) * 100.0 / (SELECT count(*) FROM e), 6)::DOUBLE AS percent FROM e GROUP BY code")
def a3(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    n = deltas(t).select(F.explode("delta").alias("code")).groupBy("code").agg(F.count("*").alias("n"))
    return n.select("code", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 6).cast("double").alias("percent"))


@query("a4_distinct_codes", f"WITH {DELTA} SELECT position::INT AS position, count(DISTINCT code) AS n_codes FROM e GROUP BY position")
def a4(t: Tables) -> DataFrame:
    return deltas(t).select(F.posexplode("delta").alias("position", "code")).groupBy("position").agg(F.count_distinct("code").alias("n_codes"))


@query("a5_partial_then_final", "SELECT l_returnflag, sum(l_partkey)::BIGINT AS total, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def a5(t: Tables) -> DataFrame:
    ranks = t.lineitem.groupBy("l_returnflag", (F.col("l_orderkey") % 8).alias("worker")).agg(F.sum("l_partkey").alias("s"), F.count("*").alias("c"))
    return ranks.groupBy("l_returnflag").agg(F.sum("s").alias("total"), F.sum("c").alias("n"))


@query("a6_expected_totals", "SELECT o_orderstatus, sum(l_linenumber)::BIGINT AS expected, count(DISTINCT o_orderkey) AS n_episodes FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderstatus")
def a6(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_linenumber").alias("expected"))
    return t.orders.join(per, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderstatus").agg(F.sum("expected").alias("expected"), F.count("*").alias("n_episodes"))


EPISODES = "x AS (SELECT l_orderkey, o_custkey AS stored, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, o_custkey)"


def episodes(t: Tables) -> DataFrame:
    sizes = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("size"))
    return t.orders.select("o_orderkey", F.col("o_custkey").alias("stored")).join(sizes, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")


@query("a7_collision_totals", f"WITH {EPISODES}, g AS (SELECT stored, count(*) AS k, sum(n) AS total, max(n) AS most FROM x GROUP BY stored) SELECT sum(total)::BIGINT AS n_expected, sum(most)::BIGINT AS n_unique, (sum(total) - sum(most))::BIGINT AS n_lost, count(*) FILTER (WHERE k > 1) AS n_collision_groups FROM g")
def a7(t: Tables) -> DataFrame:
    return A.collisions(episodes(t), ["stored"], "size")


@query("a8_collect_by_key", "SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS members FROM orders GROUP BY o_custkey")
def a8(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_list("o_orderkey")).cast("array<string>"), ",").alias("members"))


@query("a9_duplicates_in_group", "SELECT l_orderkey, count(*) AS n, count(DISTINCT l_suppkey) AS n_distinct FROM lineitem GROUP BY l_orderkey HAVING count(*) <> count(DISTINCT l_suppkey)")
def a9(t: Tables) -> DataFrame:
    return A.duplicates(t.lineitem, ["l_orderkey"], "l_suppkey")


@query("a10_set_equality", "SELECT l_orderkey, list_sort(list_distinct(list(l_returnflag))) = ['N'] AS only_n, min(l_returnflag) = max(l_returnflag) AS single FROM lineitem GROUP BY l_orderkey")
def a10(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg((F.sort_array(F.collect_set("l_returnflag")) == F.array(F.lit("N"))).alias("only_n"), (F.min("l_returnflag") == F.max("l_returnflag")).alias("single"))


@query("a11_dense_run_check", "SELECT l_orderkey, min(l_linenumber - 1)::BIGINT AS first_index, max(l_linenumber - 1)::BIGINT AS last_index, count(*) AS n, min(l_linenumber) = 1 AND max(l_linenumber) = count(*) AND count(DISTINCT l_linenumber) = count(*) AS is_dense FROM lineitem GROUP BY l_orderkey")
def a11(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", (F.col("l_linenumber").cast("long") - 1).alias("index"))
    return A.dense_runs(rows, ["l_orderkey"], "index").drop("n_distinct")


TRIALS = "r AS (SELECT lang AS task, source AS policy, quality AS success, toxic AS variant FROM labels JOIN documents USING (doc_id))"


def trials(t: Tables) -> DataFrame:
    return t.labels.join(t.documents.select("doc_id", "lang", "source"), "doc_id").select(F.col("lang").alias("task"), F.col("source").alias("policy"), F.col("quality").alias("success"), F.col("toxic").alias("variant"))


@query("a12_mean_of_variant_means", f"WITH {TRIALS}, m AS (SELECT task, variant, avg(success) AS m FROM r GROUP BY task, variant) SELECT task, round(avg(m), 6) AS mean FROM m GROUP BY task")
def a12(t: Tables) -> DataFrame:
    return A.mean_of_means(trials(t), ["task"], "variant", "success").select("task", F.round("mean", 6).alias("mean"))


@query("a13_mean_by_variant", f"WITH {TRIALS} SELECT variant, round(avg(success), 6) AS mean FROM r GROUP BY variant")
def a13(t: Tables) -> DataFrame:
    return trials(t).groupBy("variant").agg(F.round(F.avg("success"), 6).alias("mean"))


@query("a14_seed_average", "SELECT o_orderstatus, round(avg(o_orderkey % (seed + 5)), 6) AS mean FROM orders, unnest([0, 2, 4]) AS s(seed) GROUP BY o_orderstatus")
def a14(t: Tables) -> DataFrame:
    seeded = t.orders.select("o_orderstatus", "o_orderkey", F.explode(F.array(*map(F.lit, (0, 2, 4)))).alias("seed"))
    return seeded.groupBy("o_orderstatus").agg(F.round(F.avg(F.col("o_orderkey") % (F.col("seed") + 5)), 6).alias("mean"))


PERF = f"{TRIALS}, p AS (SELECT task, policy, avg(success)::DOUBLE AS sim, avg(1 - variant)::DOUBLE AS real FROM r GROUP BY task, policy)"


def perf(t: Tables) -> DataFrame:
    return trials(t).groupBy("task", "policy").agg(F.avg("success").alias("sim"), F.avg(1 - F.col("variant")).alias("real"))


@query("a15_pearson", f"WITH {PERF}, m AS (SELECT task, avg(sim) AS ms, avg(real) AS mr FROM p GROUP BY task), c AS (SELECT task, sim - ms AS s, real - mr AS r FROM p JOIN m USING (task)) SELECT task, round(CASE WHEN bool_and(s = r) THEN 1.0 ELSE sum(s * r) / (sqrt(sum(s * s) * sum(r * r)) + 1e-8) END, 6)::DOUBLE AS pearson FROM c GROUP BY task")
def a15(t: Tables) -> DataFrame:
    return A.pearson(perf(t), ["task"], "sim", "real").select("task", F.round("pearson", 6).alias("pearson"))


@query("a16_mean_maximum_rank_violation", f"WITH {PERF}, v AS (SELECT a.task, a.policy, max(CASE WHEN (a.sim > b.sim) <> (a.real > b.real) THEN abs(a.real - b.real) ELSE 0 END) AS v FROM p a JOIN p b ON a.task = b.task GROUP BY a.task, a.policy) SELECT task, round(avg(v), 6) AS mmrv FROM v GROUP BY task")
def a16(t: Tables) -> DataFrame:
    return A.mean_maximum_rank_violation(perf(t), ["task"], "policy", "sim", "real").select("task", F.round("mmrv", 6).alias("mmrv"))


@query("j16_rank_violation_pairs", f"WITH {PERF} SELECT a.task, a.policy, round(max(CASE WHEN (a.sim > b.sim) <> (a.real > b.real) THEN abs(a.real - b.real) ELSE 0 END), 6) AS violation FROM p a JOIN p b ON a.task = b.task GROUP BY a.task, a.policy")
def j16(t: Tables) -> DataFrame:
    from ..operators.joins import rank_violations

    return rank_violations(perf(t), "task", "policy", "sim", "real").withColumn("violation", F.round("violation", 6))


@query("j17_sim_real_alignment", f"WITH {TRIALS}, s AS (SELECT task, policy, avg(success) AS sim FROM r GROUP BY 1, 2), q AS (SELECT task, policy, avg(variant) AS real FROM r GROUP BY 1, 2) SELECT task, policy, round(sim - real, 6) AS gap FROM s JOIN q USING (task, policy)")
def j17(t: Tables) -> DataFrame:
    sim = trials(t).groupBy("task", "policy").agg(F.avg("success").alias("sim"))
    real = trials(t).groupBy("task", "policy").agg(F.avg("variant").alias("real"))
    return sim.join(real, ["task", "policy"]).select("task", "policy", F.round(F.col("sim") - F.col("real"), 6).alias("gap"))


@query("a17_kruskal_wallis")
def a17(t: Tables) -> DataFrame:
    return A.kruskal(trials(t), ["task"], "policy", "success")


@query("a17_kruskal_statistic", f"WITH {TRIALS}, k AS (SELECT task, policy, success, rank() OVER (PARTITION BY task ORDER BY success) AS lo, count(*) OVER (PARTITION BY task, success) AS t, count(*) OVER (PARTITION BY task) AS n FROM r), s AS (SELECT task, policy, sum(lo + (t - 1) / 2.0) AS rs, count(*) AS m, max(n) AS n FROM k GROUP BY task, policy), h AS (SELECT task, 12.0 / (max(n) * (max(n) + 1)) * sum(rs * rs / m) - 3 * (max(n) + 1) AS h, max(n)::DOUBLE AS n FROM s GROUP BY task), c AS (SELECT task, sum(t * t - 1)::DOUBLE AS c FROM k GROUP BY task) SELECT task, CASE WHEN 1 - c / (n * n * n - n) > 0 THEN round(h / (1 - c / (n * n * n - n)), 6)::DOUBLE ELSE 0 END::DOUBLE AS h FROM h JOIN c USING (task)")
def a17h(t: Tables) -> DataFrame:
    return A.kruskal(trials(t), ["task"], "policy", "success").select("task", F.round("h", 6).alias("h"))


@query("a18_trial_expansion", f"WITH {PERF} SELECT task, policy, array_to_string([CASE WHEN i <= round_even(10 * sim, 0) THEN 1 ELSE 0 END FOR i IN generate_series(1, 10)], '') AS trials FROM p")
def a18(t: Tables) -> DataFrame:
    return perf(t).select("task", "policy", F.array_join(A.expand_trials(F.lit(10), F.col("sim")).cast("array<string>"), "").alias("trials"))


@query("a20_codebook_perplexity", f"WITH {DELTA}, n AS (SELECT position, code, count(*) AS n FROM e GROUP BY position, code), p AS (SELECT position, n / sum(n) OVER (PARTITION BY position) AS p FROM n) SELECT position::INT AS position, round(exp(-sum(p * ln(p + 1e-10))), 6) AS perplexity FROM p GROUP BY position")
def a20(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    n = A.position_histogram(deltas(t), "delta")
    p = n.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("position")))
    return p.groupBy("position").agg(F.round(V.perplexity(F.col("p")), 6).alias("perplexity"))


@query("a21_dead_codes", f"WITH {DELTA} SELECT c::INT AS code, (SELECT count(*) FROM e WHERE code = c) < 5 AS is_dead FROM unnest(generate_series(0, 9)) AS s(c)")
def a21(t: Tables) -> DataFrame:
    return A.code_histogram(deltas(t), "delta", 10).select("code", (F.col("n") < 5).alias("is_dead"))


@query("a22_unique_per_batch", f"WITH {DELTA} SELECT event_id // 64 AS batch, count(DISTINCT code) AS n_codes FROM e GROUP BY 1")
def a22(t: Tables) -> DataFrame:
    return deltas(t).select(F.floor(F.col("event_id") / 64).alias("batch"), F.explode("delta").alias("code")).groupBy("batch").agg(F.count_distinct("code").alias("n_codes"))


@query("a23_masked_accuracy", "SELECT l_returnflag, round(sum(CASE WHEN l_linestatus = 'O' AND l_tax > 0.04 THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END), 0), 6) AS accuracy FROM lineitem GROUP BY l_returnflag")
def a23(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.round(A.masked_mean(F.col("l_linestatus") == "O", F.col("l_tax") > 0.04), 6).alias("accuracy"))


@query("a24_masked_token_distance", f"WITH {DELTA}, s AS (SELECT event_id, instruction, sum(abs(code - position) * (code % 2)) AS d FROM e GROUP BY event_id, instruction) SELECT instruction, round(avg(d), 6) AS distance FROM s GROUP BY instruction")
def a24(t: Tables) -> DataFrame:
    gaps = F.transform("delta", lambda x, k: F.abs(x - k) * (x % 2))
    rows = deltas(t).withColumn("d", F.aggregate(gaps, F.lit(0), lambda a, x: a + x))
    return rows.groupBy("instruction").agg(F.round(F.avg("d"), 6).alias("distance"))


@query("a25_eval_averages", "SELECT l_linestatus, round(avg(l_quantity), 6) AS quantity, round(avg(l_discount), 6) AS discount FROM lineitem GROUP BY l_linestatus")
def a25(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_linestatus").agg(*(F.round(F.avg(f"l_{c}"), 6).alias(c) for c in ("quantity", "discount")))


@query("a27_guarded_rate", f"WITH {FRAMES}, g AS (SELECT episode, count(*) AS n, date_diff('second', min(ts), max(ts)) AS s FROM f GROUP BY episode) SELECT episode, round(CASE WHEN s > 0 THEN n * 3600.0 / s ELSE 0 END, 6)::DOUBLE AS per_hour FROM g")
def a27(t: Tables) -> DataFrame:
    g = t.frames.groupBy("episode").agg(F.count("*").alias("n"), F.timestamp_diff("SECOND", F.date_trunc("second", F.min("ts")), F.date_trunc("second", F.max("ts"))).alias("s"))
    return g.select("episode", F.round(A.rate(F.col("n") * 3600.0, F.col("s")), 6).cast("double").alias("per_hour"))


@query("a28_ever_true", f"WITH {FRAMES} SELECT episode, bool_or(value > 95) AS ever FROM f GROUP BY episode")
def a28(t: Tables) -> DataFrame:
    return t.frames.groupBy("episode").agg(F.bool_or(F.col("value") > 95).alias("ever"))


@query("a29_conditional_count", f"WITH {FRAMES} SELECT episode, count(*) FILTER (WHERE value > 50) >= 5 AS lifted FROM f GROUP BY episode")
def a29(t: Tables) -> DataFrame:
    return t.frames.groupBy("episode").agg((F.count_if(F.col("value") > 50) >= 5).alias("lifted"))


@query("a30_trajectory_errors", f"WITH {FRAMES}, e AS (SELECT episode, avg(abs(value - 50)) AS error FROM f GROUP BY episode) SELECT round(avg(error), 6) AS error, count(*) FILTER (WHERE error > 25) AS n_warned FROM e")
def a30(t: Tables) -> DataFrame:
    per = t.frames.groupBy("episode").agg(F.avg(F.abs(F.col("value") - 50)).alias("e"))
    return per.agg(F.round(F.avg("e"), 6).alias("error"), F.count_if(F.col("e") > 25).alias("n_warned"))


@query("a31_token_extremes", f"WITH {DELTA} SELECT event_id, min(code) AS least, max(code) AS most FROM e GROUP BY event_id")
def a31(t: Tables) -> DataFrame:
    return deltas(t).select("event_id", F.array_min("delta").alias("least"), F.array_max("delta").alias("most"))


@query("a32_oriented_box", "WITH p AS (SELECT DISTINCT s_nationkey, round(s_acctbal / 100) AS x, (s_suppkey % 17)::DOUBLE AS y FROM supplier), c AS (SELECT s_nationkey, var_pop(x) AS xx, var_pop(y) AS yy, covar_pop(x, y) AS xy FROM p GROUP BY s_nationkey) SELECT s_nationkey, round((xx + yy) / 2 + sqrt(((xx - yy) / 2) * ((xx - yy) / 2) + xy * xy), 4) AS major, round((xx + yy) / 2 - sqrt(((xx - yy) / 2) * ((xx - yy) / 2) + xy * xy), 4) + 0 AS minor FROM c")
def a32(t: Tables) -> DataFrame:
    points = t.supplier.select("s_nationkey", F.round(F.col("s_acctbal") / 100).alias("x"), (F.col("s_suppkey") % 17).cast("double").alias("y")).distinct()
    return A.oriented_box(points, ["s_nationkey"], "x", "y").select("s_nationkey", F.round("major", 4).alias("major"), (F.round("minor", 4) + 0).alias("minor"))


@query("a33_miss_seen_counters", "SELECT count(*) AS seen, count(*) FILTER (WHERE l_linestatus = 'O') AS written, count(*) FILTER (WHERE l_linestatus <> 'O') AS missed FROM lineitem")
def a33(t: Tables) -> DataFrame:
    ok = F.col("l_linestatus") == "O"
    return t.lineitem.agg(F.count("*").alias("seen"), F.count_if(ok).alias("written"), F.count_if(~ok).alias("missed"))


@query("a34_global_code_usage", f"WITH {DELTA}, u AS (SELECT code, count(*) AS n FROM e GROUP BY code) SELECT event_id, sum(n)::BIGINT AS usage FROM e JOIN u USING (code) GROUP BY event_id")
def a34(t: Tables) -> DataFrame:
    rows = deltas(t).select("event_id", F.explode("delta").alias("code"))
    usage = rows.groupBy("code").agg(F.count("*").alias("n"))  # a row for each of eight codes
    return rows.join(F.broadcast(usage), "code").groupBy("event_id").agg(F.sum("n").alias("usage"))


@query("a35_squared_error_by_component", f"WITH {DELTA} SELECT position::INT AS position, round(avg((code - position) * (code - position)), 6) AS error FROM e GROUP BY position")
def a35(t: Tables) -> DataFrame:
    rows = deltas(t).select(F.posexplode("delta").alias("position", "code"))
    gap = F.col("code") - F.col("position")
    return rows.groupBy("position").agg(F.round(F.avg(gap * gap), 6).alias("error"))
