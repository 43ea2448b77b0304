"""Queries over discretization and vector quantization; the codebook is the first eight vectors."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric
from ..operators import quantize as V
from .registry import Tables, query

CODES = "c AS (SELECT vec_id AS code, embedding::DOUBLE[] AS entry FROM embeddings WHERE vec_id < 8), x AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), q AS (SELECT vec_id, code, list_sum([(v[i] - entry[i]) * (v[i] - entry[i]) FOR i IN generate_series(1, len(v))]) AS d FROM x, c), best AS (SELECT vec_id, arg_min(code, (d, code)) AS nearest, min(d) AS distance FROM q GROUP BY vec_id)"


def book(t: Tables) -> DataFrame:
    return t.embeddings.filter("vec_id < 8").select(F.col("vec_id").alias("code"), F.col("embedding").alias("entry"))


def nearest(t: Tables) -> DataFrame:
    return V.nearest_code(t.embeddings, book(t), "embedding", "code", "entry")


@query("f24_squared_distance", f"WITH {CODES} SELECT vec_id, round(d, 4) AS distance FROM q WHERE code = 0")
def f24(t: Tables) -> DataFrame:
    first = book(t).filter("code = 0").select(F.col("entry").cast("array<double>").alias("entry"))  # one row
    return t.embeddings.crossJoin(F.broadcast(first)).select("vec_id", F.round(V.squared_distance(F.col("embedding").cast("array<double>"), F.col("entry")), 4).alias("distance"))


@query("o12_nearest_code", f"WITH {CODES} SELECT vec_id, nearest FROM best")
def o12(t: Tables) -> DataFrame:
    return nearest(t).select("vec_id", "nearest")


@query("v2_quantize_difference", "WITH c AS (SELECT vec_id AS code, embedding::DOUBLE[] AS entry FROM embeddings WHERE vec_id < 8), p AS (SELECT vec_id, embedding::DOUBLE[] AS a, lead(embedding::DOUBLE[]) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings), q AS (SELECT vec_id, code, list_sum([((b[i] - a[i]) - entry[i]) * ((b[i] - a[i]) - entry[i]) FOR i IN generate_series(1, len(a))]) AS d FROM p, c WHERE b IS NOT NULL) SELECT vec_id, arg_min(code, (d, code)) AS nearest FROM q GROUP BY vec_id")
def v2(t: Tables) -> DataFrame:
    v = t.embeddings.withColumn("v", F.col("embedding").cast("array<double>"))
    pairs = v.withColumn("next", F.lead("v").over(Window.partitionBy("label").orderBy("vec_id"))).filter("next IS NOT NULL")
    change = pairs.select("vec_id", F.zip_with("next", "v", lambda b, a: b - a).alias("change"))
    return V.nearest_code(change, book(t), "change", "code", "entry").select("vec_id", "nearest")


PAIRS = "c AS (SELECT vec_id AS code, embedding::DOUBLE[] AS entry FROM embeddings WHERE vec_id < 8), p AS (SELECT vec_id, embedding::DOUBLE[] AS a, coalesce(lead(embedding::DOUBLE[]) OVER w, embedding::DOUBLE[]) AS b FROM embeddings WINDOW w AS (PARTITION BY label ORDER BY vec_id))"


@query("v1_label_pairs", f"WITH {PAIRS}, q AS (SELECT vec_id, part, code, list_sum([((b[i] - a[i]) - entry[i]) * ((b[i] - a[i]) - entry[i]) FOR i IN generate_series(16 * part + 1, 16 * part + 16)]) AS d FROM p, c, generate_series(0, 3) AS s(part)), n AS (SELECT vec_id, part, arg_min(code, (d, code)) AS code FROM q GROUP BY vec_id, part) SELECT vec_id, string_agg(code::VARCHAR, ',' ORDER BY part) AS codes FROM n GROUP BY vec_id")
def v1(t: Tables) -> DataFrame:
    """Four codes for each pair of a frame and the next of its group (its own at the end), by a broadcast model."""
    v = F.col("embedding").cast("array<double>")
    after = F.lead(v).over(Window.partitionBy("label").orderBy("vec_id"))
    pairs = t.embeddings.select("vec_id", v.alias("old"), F.coalesce(after, v).alias("new"))
    model = V.PairLabeler.of(book(t), "code", "entry", parts=4)
    return V.score_model(pairs, model, "codes array<long>").select("vec_id", F.array_join(F.col("codes").cast("array<string>"), ",").alias("codes"))


@query("v6_code_lookup", f"WITH {CODES} SELECT vec_id, nearest AS code, round(entry[1], 6) AS first FROM best JOIN c ON nearest = code")
def v6(t: Tables) -> DataFrame:
    codes = nearest(t).select("vec_id", F.col("nearest").alias("code"))
    return V.look_up(codes, book(t), "code").select("vec_id", "code", F.round(F.get("entry", F.lit(0)).cast("double"), 6).alias("first"))


@query("v4_replacement_candidates", f"WITH {CODES}, u AS (SELECT nearest, count(*) AS n FROM best GROUP BY nearest) SELECT code, coalesce(n, 0) AS n, coalesce(n, 0) < 20 AS replace FROM c LEFT JOIN u ON code = nearest")
def v4(t: Tables) -> DataFrame:
    used = nearest(t).groupBy(F.col("nearest").alias("code")).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return book(t).select("code").join(used, "code", "left").select("code", n.alias("n"), (n < 20).alias("replace"))


@query("v4_dead_code_replacement", f"WITH {CODES}, u AS (SELECT nearest, count(*) AS n FROM best GROUP BY nearest), k AS (SELECT code, coalesce(n, 0) AS n, coalesce(n, 0) < 200 AS dead FROM c LEFT JOIN u ON code = nearest), live AS (SELECT code, row_number() OVER (ORDER BY n DESC, code) - 1 AS r, count(*) OVER () AS m FROM k WHERE NOT dead), gone AS (SELECT code, row_number() OVER (ORDER BY code) - 1 AS r FROM k WHERE dead) SELECT k.code, coalesce(live.code, k.code) AS source FROM k LEFT JOIN gone USING (code) LEFT JOIN live ON gone.r % live.m = live.r")
def v4r(t: Tables) -> DataFrame:
    used = nearest(t).groupBy(F.col("nearest").alias("code")).agg(F.count("*").alias("n"))
    return V.replace_dead(book(t), used, "code", "entry", 200).select("code", "source")


EDGES = "q AS (SELECT list_distinct(quantile_cont(l_extendedprice, [i / 16.0::DOUBLE FOR i IN generate_series(0, 16)])) AS p, list_distinct(quantile_cont(l_quantity, [i / 16.0::DOUBLE FOR i IN generate_series(0, 16)])) AS n FROM lineitem), e AS (SELECT 0 AS dim, list_sort(p) AS edges FROM q UNION ALL SELECT 1, list_sort(n) FROM q)"


def edges(t: Tables) -> DataFrame:
    return numeric.quantile_edges(t.lineitem, ["l_extendedprice", "l_quantity"], 16)


@query("a19_quantile_edges", f"WITH {EDGES} SELECT dim, unnest([round(x, 4) FOR x IN edges]) AS edge FROM e")
def a19(t: Tables) -> DataFrame:
    return edges(t).select("dim", F.explode(F.transform("edges", lambda x: F.round(x, 4))).alias("edge"))


@query("f14_assign_bin", f"WITH {EDGES} SELECT l_orderkey, l_linenumber, least(greatest(len([x FOR x IN edges IF x <= l_quantity]) - 1, 0), len(edges) - 2)::INT AS bin FROM lineitem, e WHERE dim = 1")
def f14(t: Tables) -> DataFrame:
    one = numeric.quantile_edges(t.lineitem, ["l_quantity"], 16).select("edges")  # one row
    return t.lineitem.crossJoin(F.broadcast(one)).select("l_orderkey", "l_linenumber", numeric.assign_bin(F.col("l_quantity"), F.col("edges"), 17).alias("bin"))


@query("f15_bin_middle", f"WITH {EDGES} SELECT n_nationkey, round(coalesce((edges[n_nationkey + 1] + edges[n_nationkey + 2]) / 2, 1), 6) AS middle FROM nation, e WHERE dim = 1")
def f15(t: Tables) -> DataFrame:
    one = numeric.quantile_edges(t.lineitem, ["l_quantity"], 16).select("edges")  # one row
    return t.nation.crossJoin(F.broadcast(one)).select("n_nationkey", F.round(numeric.bin_middle(F.col("edges"), F.col("n_nationkey")), 6).alias("middle"))


@query("w15_shift_by_one", "SELECT vec_id, len(embedding) - 1 AS n, round(embedding[1]::DOUBLE, 6) AS first_input, round(embedding[2]::DOUBLE, 6) AS first_target FROM embeddings")
def w15(t: Tables) -> DataFrame:
    from ..functions.arrays import inputs, targets

    e = F.col("embedding")
    return t.embeddings.select("vec_id", F.size(inputs(e)).cast("long").alias("n"), F.round(F.get(inputs(e), F.lit(0)).cast("double"), 6).alias("first_input"), F.round(F.get(targets(e), F.lit(0)).cast("double"), 6).alias("first_target"))


@query("w16_last_mask_rise", "SELECT vec_id, list_max([j FOR j IN generate_series(1, 62) IF NOT (embedding[j + 1] > 0) AND embedding[j + 2] > 0])::INT AS rise FROM embeddings")
def w16(t: Tables) -> DataFrame:
    from ..functions.arrays import last_rise

    return t.embeddings.select("vec_id", last_rise(F.transform("embedding", lambda x: x > 0)).alias("rise"))
