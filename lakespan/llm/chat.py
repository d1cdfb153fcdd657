r"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; runs of turns with one role are merged under
one header by array aggregation; the pieces are concatenated. The template:

    ### role
    text</turn>text</turn>
    ### other role
    text</turn>

In texts a backslash becomes two, `</turn>` becomes `<\/turn>`, and each `#` with two more after it becomes
`#\`, so neither marker can occur inside; a backslash before any character stands for that character.
Roles are url-encoded. The loss mask has an element for each turn: how many characters of markup to skip,
how many characters of text follow, and whether those are trained on.

Defined cases: null texts and null roles are empty; null conv_id is a conversation of its own; turns are
ordered by turn (nulls first), role, text, and rows that repeat a turn all stay; an empty table gives no
conversation. A conversation is one value of the result, so its texts meet in one row by definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRAINED = "assistant"
OWN = "\\### Assistant: </turn> ok"


def escape(c: Column) -> Column:
    c = F.regexp_replace(c, r"\\", r"\\\\")
    c = F.regexp_replace(c, r"</turn>", r"<\\/turn>")
    return F.regexp_replace(c, r"#(?=##)", r"#\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def format_chats(turns: DataFrame, trained: str = TRAINED) -> DataFrame:
    """(conv_id, n_turns, formatted, mask): mask is an array of (skip, n_chars, loss), one for each turn."""
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    own = turns.select("conv_id", one.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # Where runs of one role begin, then each run as its role and its escaped texts.
    starts = F.expr("filter(sequence(1, size(turns)), i -> i = 1 or turns[i - 1].role <> turns[i - 2].role)")
    own = own.withColumn("starts", starts)
    runs = F.expr(
        "transform(starts, (a, k) -> named_struct('role', turns[a - 1].role, 'texts', "
        "transform(slice(turns, a, coalesce(get(starts, k + 1), size(turns) + 1) - a), t -> t.text)))"
    )
    own = own.withColumn("runs", runs)
    own = own.withColumn("runs", F.transform("runs", lambda r: F.struct(r["role"].alias("role"), F.concat(F.lit("### "), F.url_encode(r["role"]), F.lit("\n")).alias("head"), F.transform(r["texts"], escape).alias("texts"))))
    body = F.transform("runs", lambda r: F.concat(r["head"], F.array_join(F.transform(r["texts"], lambda t: F.concat(t, F.lit("</turn>"))), ""), F.lit("\n")))
    mask = F.flatten(
        F.transform(
            "runs",
            lambda r, k: F.transform(
                r["texts"],
                lambda t, j: F.struct(
                    F.when(j > 0, 7).otherwise(F.length(r["head"]) + F.when(k > 0, 8).otherwise(0)).cast("long").alias("skip"),
                    F.length(t).cast("long").alias("n_chars"),
                    (r["role"] == trained).alias("loss"),
                ),
            ),
        )
    )
    return own.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.array_join(body, "").alias("formatted"), mask.alias("mask"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """formatted with turns, an array of (role, text, raw) parsed from it; raw is the text as it stands there."""
    blocks = F.slice(F.split(F.concat(F.lit("\n"), "formatted"), r"\n### "), 2, 2**30)
    head = lambda b: F.substring_index(b, "\n", 1)
    parts = F.transform(blocks, lambda b: F.struct(F.url_decode(head(b)).alias("role"), F.split(F.substring(b, F.length(head(b)) + 2, F.length(b)), "</turn>").alias("texts")))
    out = formatted.withColumn("turns", parts)
    own = F.transform("turns", lambda b: F.transform(F.slice(b["texts"], 1, F.size(b["texts"]) - 1), lambda t: F.struct(b["role"].alias("role"), unescape(t).alias("text"), t.alias("raw"))))
    return out.withColumn("turns", F.flatten(own))


def digests(formatted: DataFrame) -> DataFrame:
    """The columns of the op8 query, read back from the formatted text and the mask."""
    back = read_chats(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    # The mask has an element for each turn; its length must be that of what the text holds there.
    fits = lambda t, m: F.length(t["raw"]).cast("long").eqNullSafe(m["n_chars"])
    fail = F.raise_error(F.lit("the mask is out of step with the text")).cast("string")
    loss = F.array_join(F.zip_with("turns", "mask", lambda t, m: F.when(fits(t, m), F.when(m["loss"], unescape(t["raw"])).otherwise("")).otherwise(fail)), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", OWN), (-7, 1, "assistant", OWN)], "conv_id long, turn long, role string, text string")
    return digests(format_chats(turns.unionByName(own)))


OP8_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (SELECT *, length(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'))
             + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0) AS n,
             lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       sum(n + 7 + CASE WHEN before IS DISTINCT FROM role THEN 6 + length(url_encode(role)) ELSE 0 END)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
