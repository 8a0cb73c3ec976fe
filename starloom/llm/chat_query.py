"""op7: every conversation, formatted and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm.chat import END, SEP, START, best_paths, formatted, parsed, tree_of_turns, unescaped
from starloom.llm.registry import query, table

CONTROL = "</s>[INST] ok [/INST]"

# The template adds its marks to each turn and a backslash to each control string.
SQL = rf"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{CONTROL}'
    UNION ALL SELECT -7, 1, 'assistant', '{CONTROL}'
), sizes AS (
    SELECT *, length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1-\2\3', 'g')) AS body
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(body + length(role) + {len(START) + len(SEP) + len(END)})::BIGINT AS formatted_chars
FROM sizes GROUP BY conv_id
"""


@query("op7_chat_reply_trees", SQL)
def op7_chat_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"
    )
    extra = spark.createDataFrame(
        [(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    chats = formatted(best_paths(tree_of_turns(turns.unionByName(extra))))
    turn = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = F.transform(
        "loss_spans",
        lambda s: unescaped(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))),
    )
    read = chats.withColumn("turns", parsed(F.col("formatted"))).withColumn("loss", F.array_join(masked, ""))
    return read.select(
        F.col("root.conv_id").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turn, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
