"""Queries over sequence building and packing; arrays are compared as joined strings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays
from ..operators import sequences as S
from .aggregates import DELTA, deltas
from .registry import FRAMES, Tables, query


def joined(a: Column) -> Column:
    return F.array_join(a.cast("array<string>"), ",")


def of(seq: str, part: str) -> Column:
    return joined(F.transform(seq, lambda x: x[part].cast("int")))


BYTES = "[(ascii(c))::INT FOR c IN string_split(instruction, '')]"
#: A training row: instruction text, two frames of two vision codes, four delta codes, two action codes.
ROWS = f"{DELTA}, s AS (SELECT event_id, instruction, [event_id::INT % 100, 11, 12, 13] AS v, delta AS dl, {BYTES} AS it FROM d)"


def rows(t: Tables) -> DataFrame:
    return deltas(t).select("event_id", "instruction", F.col("instruction").alias("answer"), F.array((F.col("event_id") % 100).cast("int"), *map(F.lit, (11, 12, 13))).alias("vision"), "delta", F.slice("delta", 1, 2).alias("action"))


def case(name: str, kind: str, tokens: str, loss: str) -> None:
    sql = f"WITH {ROWS} SELECT event_id, array_to_string({tokens}, ',') AS tokens, array_to_string({loss}, ',') AS loss FROM s"

    @query(name, sql)
    def run(t: Tables) -> DataFrame:
        return S.sequences(rows(t), kind, per_frame=2).select("event_id", of("seq", "token").alias("tokens"), of("seq", "loss").alias("loss"))


ZERO, ONE = "[0 FOR x IN it]", "[1 FOR x IN it]"
VISION = "[3] || v[1:2] || [8192] || v[3:4] || [8193, 4]"
case("t1_text_sequence", "text", "[1] || it || it || [2]", f"[0] || {ZERO} || {ONE} || [1]")
case("t2_vision_text_sequence", "vision_text", f"[1] || it || {VISION} || [2]", f"[0] || {ZERO} || [1, 1, 1, 1, 1, 1, 1, 1] || [1]")
case("t3_delta_sequence", "delta_vision_text", f"[1] || it || {VISION} || [5] || dl || [6] || [2]", f"[0] || {ZERO} || [0, 0, 0, 0, 0, 0, 0, 0] || [1, 1, 1, 1, 1, 1] || [1]")
case("t4_action_sequence", "vision_action", f"[1] || it || {VISION} || [7] || dl[1:2] || [8] || [2]", f"[0] || {ZERO} || [0, 0, 0, 0, 0, 0, 0, 0] || [1, 1, 1, 1] || [1]")
case("t5_delta_action_sequence", "delta_vision_action", f"[1] || it || {VISION} || [5] || dl || [6] || [7] || dl[1:2] || [8] || [2]", f"[0] || {ZERO} || [0, 0, 0, 0, 0, 0, 0, 0] || [1, 1, 1, 1, 1, 1, 1, 1, 1, 1] || [1]")


@query("t6_bos_eos", f"WITH {ROWS} SELECT event_id, 1 AS first_token, 2 AS last_token, 0 AS first_loss, 1 AS last_loss FROM s")
def t6(t: Tables) -> DataFrame:
    s = S.sequences(rows(t), "delta_text")
    part = lambda i, p: F.element_at("seq", i)[p].cast("int")
    return s.select("event_id", part(1, "token").alias("first_token"), part(-1, "token").alias("last_token"), part(1, "loss").alias("first_loss"), part(-1, "loss").alias("last_loss"))


STREAM = f"{DELTA}, s AS (SELECT event_id, code, position, row_number() OVER (ORDER BY event_id, position) - 1 AS g FROM e), n AS (SELECT count(*) AS total FROM e)"


@query("t8_concat_and_chunk", f"WITH {STREAM}, c AS (SELECT g // 96 AS chunk_id, string_agg(code::VARCHAR, ',' ORDER BY g) AS inputs FROM s GROUP BY 1), u AS (SELECT (g - 1) // 96 AS chunk_id, string_agg(code::VARCHAR, ',' ORDER BY g) AS targets FROM s WHERE g > 0 GROUP BY 1) SELECT chunk_id, inputs, targets FROM c JOIN u USING (chunk_id), n WHERE (chunk_id + 1) * 96 + 1 < total")
def t8(t: Tables) -> DataFrame:
    return S.concat_and_chunk(deltas(t), ["event_id"], "delta", 96).select("chunk_id", joined(F.col("inputs")).alias("inputs"), joined(F.col("targets")).alias("targets"))


#: Every byte of every turn.
@query("t14_text_packing", "WITH t AS (SELECT conv_id, turn, hex(encode(text)) AS h FROM conversations), b AS (SELECT conv_id, turn, i, ('0x' || substr(h, 2 * i - 1, 2))::INT AS code FROM t, unnest(generate_series(1, length(h) // 2)) AS g(i)), s AS (SELECT code, row_number() OVER (ORDER BY conv_id, turn, i) - 1 AS g FROM b), n AS (SELECT count(*) AS total FROM b) SELECT g // 32 AS chunk_id, string_agg(code::VARCHAR, ',' ORDER BY g) AS inputs FROM s, n GROUP BY g // 32, total HAVING (g // 32 + 1) * 32 + 1 < total")
def t14(t: Tables) -> DataFrame:
    turns = S.with_bytes(t.conversations.select("conv_id", "turn", "text"), "text", "seq")
    return S.concat_and_chunk(turns, ["conv_id", "turn"], "seq", 32).select("chunk_id", joined(F.col("inputs")).alias("inputs"))


@query("t9_pad_mode", f"WITH {ROWS}, q AS (SELECT event_id, ([1] || it || [5] || dl || [6] || [2] || [1 FOR x IN generate_series(1, 12)])[1:13] AS q, ([0] || {ZERO} || [1, 1, 1, 1, 1, 1, 1] || [0 FOR x IN generate_series(1, 12)])[2:13] AS loss FROM s) SELECT event_id, array_to_string(q[1:12], ',') AS inputs, array_to_string(q[2:13], ',') AS targets, array_to_string(loss, ',') AS loss FROM q")
def t9(t: Tables) -> DataFrame:
    s = S.sequences(rows(t), "delta_text")
    pad = F.element_at(S.tokens(S.literal([S.BOS]), 0.0), 1)
    a, b, c = S.padded(F.col("seq"), 12, pad)
    return s.select("event_id", joined(a).alias("inputs"), joined(b).alias("targets"), joined(c.cast("array<int>")).alias("loss"))


@query("t10_complete_batches", "WITH s AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS g FROM events), n AS (SELECT count(*) AS n FROM events) SELECT event_id, g // 48 AS batch_id, g % 48 AS row_in_batch FROM s, n WHERE (g // 48 + 1) * 48 <= n")
def t10(t: Tables) -> DataFrame:
    return S.batches_by_count(t.events.select("event_id"), ["event_id"], 48, keep_partial=False)


@query("t11_batches_by_count", "SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 48 AS batch_id, (row_number() OVER (ORDER BY event_id) - 1) % 48 AS row_in_batch FROM events")
def t11(t: Tables) -> DataFrame:
    return S.batches_by_count(t.events.select("event_id"), ["event_id"], 48, keep_partial=True)


@query("t13_sequence_shard", f"WITH {DELTA} SELECT event_id, array_to_string(delta[3:4], ',') AS part FROM d")
def t13(t: Tables) -> DataFrame:
    return deltas(t).select("event_id", joined(S.shard(F.col("delta"), 1, 2, 4)).alias("part"))


@query("t15_generation_split", f"WITH {DELTA} SELECT event_id, CASE WHEN delta[3] % 2 = 0 AND delta[4] % 2 = 1 THEN 2 WHEN delta[2] % 2 = 0 AND delta[3] % 2 = 1 THEN 1 END::INT AS rise, array_to_string(delta[1:3], ',') AS inputs, array_to_string(delta[2:4], ',') AS targets FROM d")
def t15(t: Tables) -> DataFrame:
    d = F.col("delta")
    return deltas(t).select("event_id", arrays.last_rise(F.transform(d, lambda x: x % 2 == 1)).alias("rise"), joined(arrays.inputs(d)).alias("inputs"), joined(arrays.targets(d)).alias("targets"))


@query("t16_prompt_assembly", f"WITH {ROWS} SELECT event_id, array_to_string(CASE WHEN len(it) < 6 THEN [0 FOR x IN generate_series(1, 6 - len(it))] || it ELSE it[len(it) - 5:len(it)] END || v || [5], ',') AS prompt FROM s")
def t16(t: Tables) -> DataFrame:
    r = rows(t)
    return r.select("event_id", joined(S.left_padded_prompt(S.code_points(F.col("instruction")), F.col("vision"), S.literal([5]), 6, 0)).alias("prompt"))


@query("t17_forced_end_of_frame", f"WITH {FRAMES} SELECT episode, frame, CASE WHEN (frame + 1) % 17 = 0 THEN 8192 ELSE (event_id % 50)::INT END::INT AS token FROM f")
def t17(t: Tables) -> DataFrame:
    return t.frames.select("episode", "frame", S.forced_end_of_frame((F.col("event_id") % 50).cast("int"), F.col("frame"), 16).alias("token"))


@query("t7_kind_dispatch", f"WITH {ROWS} SELECT event_id, 6 + len(it)::INT + len(it)::INT - 4 AS n_text, 8 + len(it)::INT + 2 AS n_vision FROM s")
def t7(t: Tables) -> DataFrame:
    """Each kind of dataset builds its own fields; lengths tell them apart."""
    r = rows(t)
    text = S.sequences(r, "text").select("event_id", F.size("seq").alias("n_text"))
    vision = S.sequences(r, "vision_text", per_frame=2).select("event_id", F.size("seq").alias("n_vision"))
    return text.join(vision, "event_id")


@query("t12_ordered_tokenization", f"WITH {ROWS} SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS place, len(it)::BIGINT AS n FROM s")
def t12(t: Tables) -> DataFrame:
    """Tokenized in parallel, numbered in the order of the input."""
    done = rows(t).select("event_id", F.size(S.code_points(F.col("instruction"))).cast("long").alias("n"))
    return S.global_order(done, ["event_id"], "place")
