"""Queries over integrity audits of orders (manifest) and lineitem (frames)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audits as Q
from .aggregates import EPISODES, episodes
from .registry import Tables, query


@query("q1_key_mismatch", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 1000 <> o_custkey % 1000")
def q1(t: Tables) -> DataFrame:
    keyed = t.orders.withColumns({"a": F.col("o_orderkey") % 1000, "b": F.col("o_custkey") % 1000})
    return Q.key_mismatches(keyed, "a", "b").select("o_orderkey", "o_custkey")


@query("q2_lost_keys_by_group", f"WITH {EPISODES} SELECT stored, count(*) AS n, (sum(n) - max(n))::BIGINT AS n_lost FROM x GROUP BY stored HAVING count(*) > 1")
def q2(t: Tables) -> DataFrame:
    g = episodes(t).groupBy("stored").agg(F.count("*").alias("n"), (F.sum("size") - F.max("size")).alias("n_lost"))
    return g.filter("n > 1")


@query("q3_explained_versus_observed", f"WITH {EPISODES}, g AS (SELECT stored, sum(n) - max(n) AS lost FROM x GROUP BY stored), o AS (SELECT count(*) - count(DISTINCT (o_custkey, l_linenumber)) AS lost FROM lineitem JOIN orders ON l_orderkey = o_orderkey) SELECT sum(g.lost)::BIGINT AS explained, max(o.lost)::BIGINT AS observed, sum(g.lost) = max(o.lost) AS matches FROM g, o")
def q3(t: Tables) -> DataFrame:
    from ..operators.aggregates import collisions

    explained = collisions(episodes(t), ["stored"], "size").select(F.col("n_lost").alias("explained"))
    keys = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey", "l_linenumber").agg(F.count("*").alias("n"))
    observed = keys.agg((F.sum("n") - F.count("*")).alias("observed"))
    return explained.crossJoin(F.broadcast(observed)).withColumn("matches", F.col("explained") == F.col("observed"))  # a row each


@query("q4_episode_errors", "WITH g AS (SELECT l_orderkey, min(l_linenumber) AS lo, max(l_linenumber) AS hi, count(*) AS n, count(DISTINCT l_returnflag) AS flags, max(l_quantity) AS q, min(l_discount) AS d FROM lineitem GROUP BY l_orderkey) SELECT l_orderkey, concat_ws(',', CASE WHEN lo <> 1 THEN 'first' END, CASE WHEN hi <> n THEN 'dense' END, CASE WHEN flags > 1 THEN 'flags' END, CASE WHEN q > 49 THEN 'range' END, CASE WHEN n < 2 THEN 'short' END, CASE WHEN d < 0 THEN 'sign' END) AS errors FROM g")
def q4(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy("l_orderkey").agg(F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi"), F.count("*").alias("n"), F.count_distinct("l_returnflag").alias("flags"), F.max("l_quantity").alias("q"), F.min("l_discount").alias("d"))
    c = F.col
    found = Q.errors(first=c("lo") != 1, dense=c("hi") != c("n"), flags=c("flags") > 1, range=c("q") > 49, short=c("n") < 2, sign=c("d") < 0)
    return g.select("l_orderkey", F.array_join(found, ",").alias("errors"))


@query("q5_expected_cardinality", "WITH e AS (SELECT count(*) AS n, sum(o_orderkey % 7 + 1)::BIGINT AS m FROM orders) SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_episodes, max(m) AS expected_rows, max(n) AS expected_episodes, count(*) = max(m) AND count(DISTINCT l_orderkey) = max(n) AS passes FROM lineitem, e")
def q5(t: Tables) -> DataFrame:
    expected = t.orders.agg(F.count("*").alias("expected_episodes"), F.sum(F.col("o_orderkey") % 7 + 1).alias("expected_rows"))
    return Q.cardinality(t.lineitem, "l_orderkey", expected)


@query("q6_count_mismatch", "WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) SELECT o_orderkey, (o_orderkey % 7 + 1)::BIGINT AS expected, coalesce(n, 0) AS n_found FROM orders LEFT JOIN n ON o_orderkey = l_orderkey WHERE o_orderkey % 7 + 1 <> coalesce(n, 0)")
def q6(t: Tables) -> DataFrame:
    expected = t.orders.select("o_orderkey", (F.col("o_orderkey") % 7 + 1).alias("expected"))
    found = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return Q.count_mismatches(expected, found, ["o_orderkey"], "expected")


@query("q7_no_misses", "SELECT count(*) AS n_missed FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def q7(t: Tables) -> DataFrame:
    return Q.orphans(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), t.orders, ["o_orderkey"]).agg(F.count("*").alias("n_missed"))


@query("q8_repair_gate", "WITH n AS (SELECT l_orderkey, count(*) AS n, max(l_linenumber) AS m FROM lineitem GROUP BY l_orderkey) SELECT o_orderkey, n = m AND o_orderstatus <> 'P' AS repaired FROM orders JOIN n ON o_orderkey = l_orderkey")
def q8(t: Tables) -> DataFrame:
    n = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.max("l_linenumber").alias("m"))
    return t.orders.join(n, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", ((F.col("n") == F.col("m")) & (F.col("o_orderstatus") != "P")).alias("repaired"))


@query("q9_missing_ranks", "SELECT w::INT AS worker FROM unnest(generate_series(0, 31)) AS s(w) WHERE w NOT IN (SELECT n_nationkey FROM nation)")
def q9(t: Tables) -> DataFrame:
    workers = t.spark.range(32).select(F.col("id").cast("int").alias("worker"))
    return Q.orphans(workers, t.nation.select(F.col("n_nationkey").alias("worker")), ["worker"])


@query("q10_first_row_identity", "SELECT l_orderkey, arg_min(l_suppkey, (l_linenumber, l_partkey, l_suppkey)) AS stored, arg_min(l_partkey, (l_linenumber, l_partkey, l_suppkey)) AS source FROM lineitem GROUP BY l_orderkey")
def q10(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("stored"), F.col("l_partkey").alias("source"))
    return Q.first_rows(rows, ["l_orderkey"], F.struct("l_linenumber", "source", "stored")).select("l_orderkey", "stored", "source")


@query("q_pk_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def pk(t: Tables) -> DataFrame:
    return Q.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])
