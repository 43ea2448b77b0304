"""Queries over sources and sinks: tables are written in a source's format to the shared folder, then read by the operator."""

import numpy as np
import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import quantize
from ..sources import files, images, sinks
from .registry import Tables, query


def lines(t: Tables, value, name: str, df: DataFrame | None = None) -> str:
    path = sinks.scratch(t.spark, name)
    (t.events if df is None else df).select(value.alias("value")).write.text(path)
    return path


def event():
    return F.to_json(F.struct("event_id", "event_type", "value"))


@query("s1_jsonl_scan", "SELECT event_id, event_type, value FROM events")
def s1(t: Tables) -> DataFrame:
    blank = F.when(F.col("event_id") % 5 == 0, F.concat(event(), F.lit("\n"))).otherwise(event())
    return files.jsonl(t.spark, lines(t, blank, "jsonl"), "event_id long, event_type string, value double")


@query("s2_tolerant_jsonl", "SELECT event_id, event_type FROM events WHERE event_id % 10 <> 3")
def s2(t: Tables) -> DataFrame:
    broken = F.when(F.col("event_id") % 10 == 3, F.substring(event(), 1, 9)).otherwise(event())
    return files.jsonl_tolerant(t.spark, lines(t, broken, "tolerant"), "event_id long, event_type string, value double")[0].select("event_id", "event_type")


@query("s2_corrupt_lines", "SELECT count(*) AS n_corrupt FROM events WHERE event_id % 10 = 3")
def s2c(t: Tables) -> DataFrame:
    broken = F.when(F.col("event_id") % 10 == 3, F.substring(event(), 1, 9)).otherwise(event())
    return files.jsonl_tolerant(t.spark, lines(t, broken, "corrupt"), "event_id long, event_type string, value double")[1].agg(F.count("*").alias("n_corrupt"))


@query("s3_json_array", "SELECT n_nationkey, n_name FROM nation")
def s3(t: Tables) -> DataFrame:
    whole = t.nation.agg(F.to_json(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("v"))
    return files.json_array(t.spark, lines(t, F.col("v"), "array", whole), "n_nationkey int, n_name string")


@query("s5_epoch_shuffle", "SELECT conv_id, turn, e::INT AS epoch FROM conversations, unnest([0, 1]) AS s(e)")
def s5(t: Tables) -> DataFrame:
    keyed = t.conversations.select("conv_id", "turn", F.concat_ws("_", "conv_id", "turn").alias("k"))
    return files.epochs(keyed, "k", 2, seed=11).select("conv_id", "turn", "epoch")


@query("s6_split_scan", "SELECT count(*) AS n, sum(event_id)::BIGINT AS total FROM events")
def s6(t: Tables) -> DataFrame:
    """Splits of text files at any byte lose no line and repeat none."""
    path = lines(t, event(), "splits")
    return files.jsonl(t.spark, path, "event_id long, event_type string, value double").agg(F.count("*").alias("n"), F.sum("event_id").alias("total"))


@query("s7_ordered_chunks", "SELECT user_id, ntile(4) OVER (PARTITION BY user_id ORDER BY event_id)::INT AS chunk, event_id FROM events")
def s7(t: Tables) -> DataFrame:
    return t.events.select("user_id", F.ntile(4).over(Window.partitionBy("user_id").orderBy("event_id")).alias("chunk"), "event_id")


@query("s8_slice_scan", "SELECT o_orderkey FROM orders WHERE o_orderkey BETWEEN 100 AND 299")
def s8(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderkey").between(100, 299)).select("o_orderkey")


@query("s9_union_slices", "SELECT o_orderkey FROM orders WHERE (o_orderkey >= 100 AND o_orderkey < 300) OR (o_orderkey >= 1000 AND o_orderkey < 1400)")
def s9(t: Tables) -> DataFrame:
    """Slices become one table of wanted ordinals, and the read a semi join: one scan whatever their number."""
    slices = t.spark.createDataFrame([(100, 300), (1000, 1400)], "a long, b long")
    wanted = slices.select(F.explode(F.sequence("a", F.col("b") - 1)).alias("o_orderkey"))
    return t.orders.join(wanted, "o_orderkey", "left_semi").select("o_orderkey")


TREE = "tree AS (SELECT concat(n_name, '/', lower(c_mktsegment), '/1.0.', c_custkey % 3) AS dataset, min(c_custkey) AS k FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)"


def tree(t: Tables) -> DataFrame:
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.concat("n_name", F.lit("/"), F.lower("c_mktsegment"), F.lit("/1.0."), (F.col("c_custkey") % 3).cast("string"))
    return named.groupBy(key.alias("dataset")).agg(F.min("c_custkey").alias("k"))


def paths(t: Tables) -> DataFrame:
    marker = F.when(F.col("k") % 4 == 0, F.lit("notes.txt")).otherwise(F.lit("features.json"))
    return tree(t).select(F.concat(F.lit("file:/data/"), "dataset", F.lit("/"), marker).alias("path"))


@query("s10_discovery", f"WITH {TREE} SELECT dataset, string_split(dataset, '/')[1] AS \"group\", string_split(dataset, '/')[3] AS version FROM tree WHERE k % 4 <> 0")
def s10(t: Tables) -> DataFrame:
    return files.discover(paths(t), "file:/data")


@query("s11_discovery_filtered", f"WITH {TREE} SELECT dataset FROM tree WHERE k % 4 <> 0 AND contains(dataset, 'building')")
def s11(t: Tables) -> DataFrame:
    return files.discover(paths(t), "file:/data").filter(F.contains("dataset", F.lit("building"))).select("dataset")


@query("s12_crowded_groups", f"WITH {TREE} SELECT string_split(dataset, '/')[1] AS \"group\", count(*) AS n FROM tree WHERE k % 4 <> 0 GROUP BY 1 HAVING count(*) > 1")
def s12(t: Tables) -> DataFrame:
    return files.crowded_groups(files.discover(paths(t), "file:/data"))


@query("s13_split_metadata", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN -1 ELSE o_custkey + 5 END AS n FROM orders")
def s13(t: Tables) -> DataFrame:
    k = F.col("o_custkey").cast("string")
    layouts = [
        F.concat(F.lit('{"splits": [{"name": "train", "shardLengths": ["'), k, F.lit('", "5"]}]}')),
        F.concat(F.lit('{"splits": [{"name": "val"}, {"name": "train", "numExamples": '), (F.col("o_custkey") + 5).cast("string"), F.lit("}]}")),
        F.concat(F.lit('{"splits": {"train": {"shardLengths": ["5", "'), k, F.lit('"]}}}')),
        F.lit('{"splits": []}'),
    ]
    info = F.element_at(F.array(*layouts), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t.orders.select("o_orderkey", F.coalesce(files.split_size(info, "train"), F.lit(-1)).alias("n"))


@query("s14_ragged_csv", "WITH e AS (SELECT 0 AS dim, list_sort(list_distinct(list(l_tax))) AS e FROM lineitem UNION ALL SELECT 1, list_sort(list_distinct(list(l_quantity))) FROM lineitem) SELECT dim, i::INT AS edge_idx, e[i + 1] AS edge FROM e, unnest(generate_series(0, len(e) - 1)) AS s(i)")
def s14(t: Tables) -> DataFrame:
    """Also the sink of bin edges: a ragged table is written and read back."""
    sets = t.lineitem.agg(F.sort_array(F.collect_set("l_tax")).alias("a"), F.sort_array(F.collect_set("l_quantity")).alias("b"))
    edges = sets.select(F.explode(F.array(F.struct(F.lit(0).alias("dim"), F.col("a").alias("edges")), F.struct(F.lit(1).alias("dim"), F.col("b").alias("edges")))).alias("r")).select("r.*")
    sinks.bins_csv(edges, path := sinks.scratch(t.spark, "bins"), 64)
    return files.ragged_csv(t.spark, path)


@query("s15_numeric_suffix_order", "SELECT c_nationkey, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey)::INT AS place FROM customer")
def s15(t: Tables) -> DataFrame:
    number = F.regexp_extract("c_name", "(\\d+)", 1).cast("long")
    return t.customer.select("c_nationkey", "c_name", F.row_number().over(Window.partitionBy("c_nationkey").orderBy(number)).alias("place"))


@query("s16_valid_episodes", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) AND c_nationkey NOT IN (3, 7)")
def s16(t: Tables) -> DataFrame:
    marked = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.filter(~F.col("c_nationkey").isin(3, 7)).join(marked, "c_custkey", "left_semi").select("c_custkey")


@query("s17_clamped_length", "WITH a AS (SELECT l_orderkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) AS i, count(*) OVER (PARTITION BY l_orderkey) AS shape FROM lineitem) SELECT o_orderkey, least(o_custkey % 6 + 1, shape)::BIGINT AS n, l_quantity AS last FROM orders JOIN a ON o_orderkey = l_orderkey AND i = least(o_custkey % 6 + 1, shape)")
def s17(t: Tables) -> DataFrame:
    """A point read of an episode's stored array, no further than the array goes, whatever its metadata says."""
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity")))
    arrays = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.transform(rows, lambda x: x["l_quantity"]).alias("frames"))
    n = F.least(F.col("o_custkey") % 6 + 1, F.size("frames")).cast("long")
    return t.orders.join(arrays, "o_orderkey").select("o_orderkey", n.alias("n"), F.element_at("frames", n.cast("int")).alias("last"))


@query("s18_dataset_scan", "SELECT doc_id, lang, length(text) AS n FROM documents")
def s18(t: Tables) -> DataFrame:
    """A dataset's rows read as a stream, as they are read at once."""
    from ..streaming.stateful import run_to_table

    path = sinks.scratch(t.spark, "dataset")
    t.documents.select("doc_id", "lang", "text").write.json(path)
    rows = t.spark.readStream.schema("doc_id long, lang string, text string").option("maxFilesPerTrigger", 4).json(path)
    return run_to_table(rows.select("doc_id", "lang", F.length("text").cast("long").alias("n")), "dataset_stream")


@query("s22_image_decode", "SELECT n_nationkey, 6 AS height, 5 AS width, list_sum([(n_nationkey * 7 + p * 3) % 256 FOR p IN generate_series(0, 89)])::BIGINT AS total FROM nation")
def s22(t: Tables) -> DataFrame:
    """Images of a folder, written by the tasks that have their rows."""
    folder = sinks.scratch(t.spark, "images")

    def write(pdf: pd.DataFrame) -> pd.Series:
        filesystem, at = pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        filesystem.create_dir(at, recursive=True)
        for k in pdf["n_nationkey"].tolist():
            with filesystem.open_output_stream(f"{at}/frame_{k}.png") as out:
                out.write(images.encode(((k * 7 + np.arange(90) * 3) % 256).astype(np.uint8).reshape(6, 5, 3)))
        return pdf["n_nationkey"]

    quantize.score_batches(t.nation.select("n_nationkey"), write, "done long").write.format("noop").mode("overwrite").save()
    found = images.images(t.spark, folder, "*.png")
    total = F.udf(lambda x: sum(x), "long")  # a checksum of the decoded bytes, to compare with
    return found.select(F.regexp_extract("path", r"frame_(\d+)", 1).cast("long").alias("n_nationkey"), "height", "width", total("pixels").alias("total"))


RESULTS = "r AS (SELECT c_custkey, concat('runs/', c_mktsegment, '/', CASE WHEN c_custkey % 3 = 0 THEN 'success' WHEN c_custkey % 3 = 1 THEN 'failure' ELSE 'open' END, '_obj_', c_custkey, CASE WHEN c_custkey % 11 = 0 THEN '.txt' ELSE '.mp4' END) AS path FROM customer)"


@query("s19_result_files", f"WITH {RESULTS} SELECT path, CASE WHEN contains(path, 'success') THEN 1 ELSE 0 END AS success FROM r WHERE contains(path, 'BUILDING') AND contains(path, '_obj_') AND path LIKE '%.mp4' AND NOT contains(path, 'open')")
def s19(t: Tables) -> DataFrame:
    from ..functions.text import outcome

    word = F.when(F.col("c_custkey") % 3 == 0, "success").when(F.col("c_custkey") % 3 == 1, "failure").otherwise("open")
    end = F.when(F.col("c_custkey") % 11 == 0, ".txt").otherwise(".mp4")
    found = t.customer.select(F.concat(F.lit("runs/"), "c_mktsegment", F.lit("/"), word, F.lit("_obj_"), F.col("c_custkey").cast("string"), end).alias("path"))
    wanted = found.filter(F.col("path").endswith(".mp4") & F.contains("path", F.lit("BUILDING")) & F.contains("path", F.lit("_obj_")))
    return wanted.withColumn("success", outcome(F.substring_index("path", "/", -1))).filter("success IS NOT NULL")


@query("s20_log_parse", "SELECT event_id, event_id::DOUBLE AS first, (event_id + 1)::DOUBLE AS second, (event_id % 9)::DOUBLE AS err FROM events")
def s20(t: Tables) -> DataFrame:
    k = F.col("event_id")
    line = F.concat(F.lit("stiff: ["), k.cast("string"), F.lit(", "), (k + 1).cast("string"), F.lit("], err: "), (k % 9).cast("string"))
    read = t.spark.read.text(lines(t, line, "log")).select(*files.log_fields(F.col("value"), ["stiff", "err"]))
    first = F.get("stiff", F.lit(0))
    return read.select(first.cast("long").alias("event_id"), first.alias("first"), F.get("stiff", F.lit(1)).alias("second"), F.get("err", F.lit(0)).alias("err"))


@query("s21_gzip_json", "SELECT event_id, event_type FROM events")
def s21(t: Tables) -> DataFrame:
    t.events.select("event_id", "event_type").write.option("compression", "gzip").json(path := sinks.scratch(t.spark, "gz"))
    return files.jsonl(t.spark, path, "event_id long, event_type string")


@query("s23_episode_subset", "SELECT event_id FROM events WHERE user_id IN (1, 5, 9)")
def s23(t: Tables) -> DataFrame:
    return t.events.filter(F.col("user_id").isin(1, 5, 9)).select("event_id")


@query("s24_first_row_per_file", "SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def s24(t: Tables) -> DataFrame:
    from ..operators.audits import first_rows

    return first_rows(t.events.select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("k1_audited_publish", "SELECT o_orderkey, o_custkey FROM orders")
def k1(t: Tables) -> DataFrame:
    from ..operators.audits import gate, repeated_keys

    rows = t.orders.select("o_orderkey", "o_custkey")
    sinks.publish(rows, path := sinks.scratch(t.spark, "publish"), lambda d: gate(repeated_keys(d, ["o_orderkey"]), "repeated orders"))
    return files.jsonl(t.spark, path, "o_orderkey long, o_custkey long")


@query("k2_episode_overwrite", "SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN upper(n_name) || '!' ELSE n_name END AS n_name, n_regionkey FROM nation")
def k2(t: Tables) -> DataFrame:
    path = sinks.scratch(t.spark, "episodes")
    sinks.write_episodes(t.nation, path, ["n_regionkey"])
    again = t.nation.filter("n_regionkey = 1").withColumn("n_name", F.concat(F.upper("n_name"), F.lit("!")))
    sinks.write_episodes(again, path, ["n_regionkey"])
    return t.spark.read.schema("n_nationkey int, n_name string, n_regionkey int").parquet(path)


@query("k3_ordered_parts", "SELECT event_id, event_type FROM events")
def k3(t: Tables) -> DataFrame:
    sinks.write_ordered(t.events.select("event_id", "event_type"), path := sinks.scratch(t.spark, "ordered"), ["event_id"])
    return files.jsonl(t.spark, path, "event_id long, event_type string")


@query("k4_write_with_statistics", "SELECT count(*) AS n, sum(event_id)::BIGINT AS total FROM events")
def k4(t: Tables) -> DataFrame:
    seen = sinks.write_observed(t.events.select("event_id"), sinks.scratch(t.spark, "observed"), n=F.count(F.lit(1)), total=F.sum("event_id"))
    return t.spark.createDataFrame([(seen["n"], seen["total"])], "n long, total long")


@query("k5_compact_json", "SELECT concat('{\"n_nationkey\":', n_nationkey, ',\"n_name\":\"', n_name, '\"}') AS value FROM nation")
def k5(t: Tables) -> DataFrame:
    return sinks.compact_json(t.nation.select("n_nationkey", "n_name"))


@query("k7_run_summary", "SELECT count(*) AS n_labels, count(DISTINCT user_id) AS n_episodes, min(event_id) AS first_event, max(event_id) AS last_event FROM events")
def k7(t: Tables) -> DataFrame:
    summary = t.events.agg(F.count("*").alias("n_labels"), F.count_distinct("user_id").alias("n_episodes"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))
    summary.write.json(path := sinks.scratch(t.spark, "summary"))
    return files.jsonl(t.spark, path, "n_labels long, n_episodes long, first_event long, last_event long")


@query("k10_depth_quantized", "SELECT event_id, CASE WHEN value >= 0 AND value / 100 < 64 THEN trunc(value / 100 * 1024) END::INT AS depth, coalesce(value >= 0 AND value / 100 < 64, false) AS in_range FROM events")
def k10(t: Tables) -> DataFrame:
    depth = F.col("value") / 100
    in_range = F.coalesce((depth >= 0) & (depth < 64), F.lit(False))
    return t.events.select("event_id", F.when(in_range, (depth * 1024).cast("int")).alias("depth"), in_range.alias("in_range"))


@query("k11_prune_and_renumber", "SELECT l_orderkey, l_linenumber, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1)::INT AS episode FROM lineitem WHERE l_quantity > 10")
def k11(t: Tables) -> DataFrame:
    from ..operators.windows import numbered_frames

    return numbered_frames(t.lineitem.filter("l_quantity > 10").select("l_orderkey", "l_linenumber"), ["l_orderkey"], ["l_linenumber"], "episode")


@query("k12_stream_resume", "SELECT event_id, event_type FROM events")
def k12(t: Tables) -> DataFrame:
    """Two runs of a file stream with one checkpoint: the second run sees the new files only."""
    from ..streaming.resume import run_available

    source, out = sinks.scratch(t.spark, "stream"), sinks.scratch(t.spark, "stream-out")
    rows = t.events.select("event_id", "event_type")
    for k in (0, 1):
        rows.filter(F.pmod("event_id", F.lit(2)) == k).write.mode("append").json(source)
        run_available(t.spark, source, "event_id long, event_type string", out)
    return t.spark.read.schema("event_id long, event_type string").parquet(f"{out}/data")


@query("k13_append_results", "SELECT concat('mean ', r_regionkey) AS value FROM region UNION ALL SELECT concat('mean ', r_regionkey) FROM region")
def k13(t: Tables) -> DataFrame:
    path = sinks.scratch(t.spark, "append")
    row = t.region.select(F.concat(F.lit("mean "), F.col("r_regionkey").cast("string")).alias("value"))
    for _ in range(2):
        sinks.append_text(row, path)
    return t.spark.read.text(path)


@query("st_stream_pairs", "WITH f AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS k FROM events) SELECT a.user_id AS episode, a.event_id AS old_event, b.event_id AS new_event FROM f a JOIN f b ON a.user_id = b.user_id AND b.k = a.k + 3")
def st(t: Tables) -> DataFrame:
    """Pairs a fixed number of places apart, from a stream whose state is the last few rows of each episode."""
    from ..streaming.stateful import stream_pairs

    source = sinks.scratch(t.spark, "pairs")
    rows = t.events.select(F.col("user_id").alias("episode"), F.col("event_id").alias("event"))
    # one file for each half of time, so that pairs reach over micro-batches
    middle = rows.agg(F.median("event").cast("long").alias("m")).first()["m"]
    rows.filter(F.col("event") < (middle or 0)).coalesce(1).write.mode("append").json(source)
    rows.filter(F.col("event") >= (middle or 0)).coalesce(1).write.mode("append").json(source)
    out = stream_pairs(t.spark, source, 3)
    return out.select("episode", F.col("old").alias("old_event"), F.col("new").alias("new_event"))


@query("s4_stream_epochs", "SELECT event_id, e::INT AS epoch FROM events, unnest([0, 1, 2]) AS s(e)")
def s4(t: Tables) -> DataFrame:
    """A stream of JSON lines read to its end, wrapped for three epochs."""
    from ..streaming.resume import run_available

    source, out = sinks.scratch(t.spark, "wrap"), sinks.scratch(t.spark, "wrap-out")
    t.events.select("event_id").write.json(source)
    run_available(t.spark, source, "event_id long", out)
    return files.epochs(t.spark.read.schema("event_id long").parquet(f"{out}/data"), "event_id", 3, seed=5)


@query("k6_bins_csv", "SELECT 0 AS dim, count(DISTINCT l_discount) AS n_edges, min(l_discount) AS low, max(l_discount) AS high FROM lineitem")
def k6(t: Tables) -> DataFrame:
    edges = t.lineitem.agg(F.sort_array(F.collect_set("l_discount")).alias("edges")).select(F.lit(0).alias("dim"), "edges")
    sinks.bins_csv(edges, path := sinks.scratch(t.spark, "bins"), 32)
    return files.ragged_csv(t.spark, path).groupBy("dim").agg(F.count("*").alias("n_edges"), F.min("edge").alias("low"), F.max("edge").alias("high"))


@query("k8_failed_write_leaves_nothing", "SELECT n_nationkey FROM nation")
def k8(t: Tables) -> DataFrame:
    """A publish that its audit refuses leaves the rows that were there."""
    from ..operators.audits import AuditFailure

    path = sinks.scratch(t.spark, "refused")
    sinks.publish(t.nation.select("n_nationkey"), path, lambda d: None)

    def refuse(d: DataFrame) -> None:
        raise AuditFailure("refused")

    try:
        sinks.publish(t.nation.limit(1).select("n_nationkey"), path, refuse)
    except AuditFailure:
        pass
    return files.jsonl(t.spark, path, "n_nationkey int")


@query("k9_shared_cache", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def k9(t: Tables) -> DataFrame:
    """An intermediate table by episode in the shared folder, which later reads prune to what they need."""
    path = sinks.scratch(t.spark, "cache")
    sinks.write_episodes(t.events.select("event_id", "user_id"), path, ["user_id"])
    return t.spark.read.schema("event_id long, user_id long").parquet(path).groupBy("user_id").agg(F.count("*").alias("n"))


@query("st_resumed_episodes", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def st_resumed(t: Tables) -> DataFrame:
    """A stream that writes a folder for each episode; running it again changes nothing."""
    from ..streaming.resume import run_episodes

    source, out = sinks.scratch(t.spark, "episodes-in"), sinks.scratch(t.spark, "episodes-out")
    t.events.select("event_id", "user_id").coalesce(1).write.json(source)
    for _ in range(2):
        run_episodes(t.spark, source, "event_id long, user_id long", out, ["user_id"])
    return t.spark.read.schema("event_id long, user_id long").parquet(f"{out}/data").groupBy("user_id").agg(F.count("*").alias("n"))
