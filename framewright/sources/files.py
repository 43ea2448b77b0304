"""Reading files: JSON lines, arrays, ragged CSV, logs, listings, split metadata, epochs. Schemas are always given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, plain or compressed by suffix; blank lines are no rows; a row that doesn't parse fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def jsonl_tolerant(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, corrupt lines): lines that are no JSON are set apart, not lost."""
    parsed = spark.read.text(path).filter(F.trim("value") != "").select("value", F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    bad = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    return parsed.filter(~bad).select("r.*").drop("_corrupt"), parsed.filter(bad).select(F.col("value").alias("line"))


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One document that is an array of rows."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def ragged_csv(spark: SparkSession, path: str) -> DataFrame:
    """(dim, edge_idx, edge): a row of the file for each dimension, blanks at its end left out. Lines keep their order by file offset."""
    header = spark.read.option("header", True).csv(path)
    numbered = header.withColumn("_line", F.monotonically_increasing_id())
    cells = numbered.select("_line", F.posexplode(F.array(*(F.col(f"`{c}`").try_cast("double") for c in header.columns))).alias("edge_idx", "edge"))
    from ..operators.ordering import dense_number

    return dense_number(cells.filter("edge IS NOT NULL"), "_line", "dim").select("dim", "edge_idx", "edge")


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length) of all files below a folder; their contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "length")


def discover(files: DataFrame, root: str, marker: str = "features.json") -> DataFrame:
    """(dataset, group, version) of each folder group/name/version below root that has the marker file."""
    parts = F.split(F.substring_index("path", root.rstrip("/") + "/", -1), "/")
    found = files.select(parts.alias("p")).filter((F.size("p") == 4) & (F.get("p", F.lit(3)) == marker))
    return found.select(F.concat_ws("/", F.slice("p", 1, 3)).alias("dataset"), F.get("p", F.lit(0)).alias("group"), F.get("p", F.lit(2)).alias("version"))


def crowded_groups(datasets: DataFrame) -> DataFrame:
    """Groups with more than one dataset, which a build that wants one each must refuse."""
    return datasets.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1")


def split_size(info: Column, split: str) -> Column:
    """Examples in a split, of the metadata's three layouts: shard lengths, a count, or a map by name."""
    kind = "splits array<struct<name: string, shardLengths: array<string>, numExamples: bigint>>"
    listed = F.get(F.filter(F.from_json(info, kind)["splits"], lambda s: s["name"] == split), F.lit(0))
    total = lambda s: F.when(F.size(s) > 0, F.aggregate(s, F.lit(0).cast("long"), lambda a, x: a + x.cast("long")))
    mapped = F.from_json(info, "splits map<string, struct<shardLengths: array<string>, numExamples: bigint>>")["splits"]
    named = F.try_element_at(mapped, F.lit(split))
    return F.coalesce(total(listed["shardLengths"]), listed["numExamples"], total(named["shardLengths"]), named["numExamples"])


def log_fields(line: Column, keys: list[str]) -> list[Column]:
    """Fields of "key: [1.0, 2.0], other: 3" as arrays of numbers; a scalar is an array of one."""
    def one(k: str) -> Column:
        raw = F.regexp_extract(line, k + r":\s*(\[[^\]]*\]|[^,\s]+)", 1)
        return F.transform(F.filter(F.split(F.regexp_replace(raw, r"[\[\]]", " "), r"[,\s]+"), lambda x: x != ""), lambda x: x.try_cast("double")).alias(k)

    return [one(k) for k in keys]


def epochs(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The rows once for each epoch, each in an order of its own that the seed fixes."""
    each = df.crossJoin(F.broadcast(df.sparkSession.range(n).select(F.col("id").cast("int").alias("epoch"))))
    return each.orderBy("epoch", F.xxhash64(F.lit(seed), "epoch", key), key)


def flatten(df: DataFrame, separator: str = "/") -> DataFrame:
    """Nested structs as columns, names joined by a separator; the schema is walked when the plan is made."""
    def walk(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out = []
        for f in schema:
            at = (*path, f.name)
            out += walk(f.dataType, at) if isinstance(f.dataType, T.StructType) else [F.col(".".join(f"`{p}`" for p in at)).alias(separator.join(at))]
        return out

    return df.select(*walk(df.schema, ()))
