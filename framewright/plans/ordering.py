"""Queries over sorts, limits and set operations. Limits here are the feature: top-k reports and caps."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrays
from .registry import FRAMES, Tables, query


@query("o1_multi_key_sort", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INT AS place FROM orders")
def o1(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")).alias("place"))


@query("o2_sort_in_group", "SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_partkey) AS parts FROM lineitem GROUP BY l_orderkey")
def o2(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_list("l_partkey")).cast("array<string>"), ",").alias("parts"))


@query("o3_top_ten", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def o3(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("o4_first_twenty_errors", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > 0.09 ORDER BY l_orderkey, l_linenumber LIMIT 20")
def o4(t: Tables) -> DataFrame:
    return t.lineitem.filter("l_discount > 0.09").select("l_orderkey", "l_linenumber").orderBy("l_orderkey", "l_linenumber").limit(20)


@query("o5_max_samples", "SELECT event_id FROM events ORDER BY event_id LIMIT 100")
def o5(t: Tables) -> DataFrame:
    return t.events.select("event_id").orderBy("event_id").limit(100)


@query("o6_cap_per_dataset", "SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE n <= 3")
def o6(t: Tables) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return t.orders.select("o_custkey", "o_orderkey", n.alias("n")).filter("n <= 3").drop("n")


@query("o7_cap_per_rank", "SELECT worker, o_orderkey FROM (SELECT o_orderkey % 8 AS worker, o_orderkey, row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey) AS n FROM orders) WHERE n <= 5")
def o7(t: Tables) -> DataFrame:
    rows = t.orders.select((F.col("o_orderkey") % 8).alias("worker"), "o_orderkey")
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("worker").orderBy("o_orderkey"))).filter("n <= 5").drop("n")


@query("o8_label_sample")
def o8(t: Tables) -> DataFrame:
    """Twenty labels by hash: any twenty would do, these are the same each time."""
    return t.events.select("event_id", "event_type").orderBy(F.xxhash64("event_id")).limit(20)


@query("o9_sorted_listing", "SELECT url, row_number() OVER (ORDER BY url, page_id) AS place FROM pages")
def o9(t: Tables) -> DataFrame:
    from ..operators.sequences import global_order

    return global_order(t.pages.select("url", "page_id"), ["url", "page_id"], "place").select("url", (F.col("place") + 1).alias("place"))


@query("o10_shuffle", "SELECT event_id, 0 AS epoch FROM events UNION ALL SELECT event_id, 1 FROM events")
def o10(t: Tables) -> DataFrame:
    from ..sources.files import epochs

    return epochs(t.events.select("event_id"), "event_id", 2, seed=7).select("event_id", "epoch")


@query("o11_uniform_subsample", f"WITH {FRAMES}, n AS (SELECT episode, count(*)::INT AS n FROM f GROUP BY episode), k AS (SELECT episode, n, i::INT AS i FROM n, unnest(generate_series(0, 7)) AS s(i)) SELECT episode, i, CASE WHEN i = 7 THEN n - 1 ELSE trunc(i * ((n - 1) / 7.0::DOUBLE))::INT END AS frame FROM k")
def o11(t: Tables) -> DataFrame:
    n = t.frames.groupBy("episode").agg(F.count("*").cast("int").alias("n"))
    return n.select("episode", F.posexplode(arrays.spread(F.col("n"), 8)).alias("i", "frame"))


@query("u1_last_wins_union", "SELECT k AS episode, arg_max(v, r) AS value FROM (SELECT o_custkey AS k, o_orderkey AS v, 0 * 1000000000 + o_orderkey AS r FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT o_custkey, o_orderkey, 1000000000 + o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY k")
def u1(t: Tables) -> DataFrame:
    from ..operators.joins import last_wins

    part = lambda s, k: t.orders.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("episode"), F.col("o_orderkey").alias("value"), F.lit(k).alias("source"))
    return last_wins(part("O", 0).unionByName(part("F", 1)), ["episode"], ["source", "value"], ["value"])


@query("u2_union_collisions", "SELECT k AS episode, count(*) AS n FROM (SELECT DISTINCT o_custkey AS k, 0 AS s FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT DISTINCT o_custkey, 1 FROM orders WHERE o_orderstatus = 'F') GROUP BY k HAVING count(*) > 1")
def u2(t: Tables) -> DataFrame:
    part = lambda s: t.orders.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("episode")).distinct()
    return part("O").unionByName(part("F")).groupBy("episode").agg(F.count("*").alias("n")).filter("n > 1")


@query("u3_set_difference", "SELECT c_custkey AS episode FROM customer EXCEPT SELECT o_custkey FROM orders")
def u3(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("episode")).subtract(t.orders.select(F.col("o_custkey").alias("episode")))


@query("u4_set_intersection", "SELECT c_custkey AS episode FROM customer WHERE c_custkey BETWEEN 10 AND 900 INTERSECT SELECT o_custkey FROM orders")
def u4(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_custkey").between(10, 900)).select(F.col("c_custkey").alias("episode")).intersect(t.orders.select(F.col("o_custkey").alias("episode")))


@query("u5_union_of_parts", "SELECT l_orderkey, l_linenumber FROM lineitem")
def u5(t: Tables) -> DataFrame:
    part = lambda k: t.lineitem.filter(F.pmod("l_orderkey", F.lit(2)) == k).select("l_orderkey", "l_linenumber")
    return part(0).unionByName(part(1))


@query("u6_union_of_variants", "SELECT l_returnflag, unnest([l_discount, l_tax]) AS x FROM lineitem")
def u6(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", F.explode(F.concat(F.array("l_discount"), F.array("l_tax"))).alias("x"))


@query("u7_denylist", "SELECT n_name FROM nation WHERE n_name NOT IN (SELECT n_name FROM nation WHERE n_nationkey < 5)")
def u7(t: Tables) -> DataFrame:
    return t.nation.join(t.nation.filter("n_nationkey < 5").select("n_name"), "n_name", "left_anti").select("n_name")


@query("u8_merge_equal_lengths", "SELECT l_orderkey, count(*) AS n, count(l_tax) = count(l_discount) AS same_length FROM lineitem GROUP BY l_orderkey")
def u8(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), (F.count("l_tax") == F.count("l_discount")).alias("same_length"))
