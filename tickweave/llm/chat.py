"""Preference formatting: the shared turns of a chosen and a rejected conversation once, then both completions, masked. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import row_salt, salted_join
from tickweave.plans.session import table


def format_preferences(turns: DataFrame) -> DataFrame:
    """One row per rendered turn: pair_id, part (prompt, chosen or rejected), turn, role, rendered, n_chars, loss, loss_start, loss_stop.

    turns: pair_id, side (chosen or rejected), turn, role, text. The prompt is the longest common turn prefix
    of the two sides, rendered once; what follows on each side is that side's completion. loss is 1 for
    the assistant's turns of completions, 0 elsewhere: prompt, system and user turns are masked. Of a turn with loss the characters from
    loss_start to loss_stop count, its text and the end mark; the header and the last newline don't (both are 0 without loss). A part's string is its rows'
    `rendered` in the order of turn (rows that tie: role, text).

    The prefix is found from a row of counts and hash sums for each turn number (two sums of 64-bit hashes: unlike turns would pass
    as equal with a chance of about 2^-128), so a conversation with
    a third of all rows is summed up before it is shuffled, is never gathered in one row or task, and its turns
    are joined with the prefix length under salts.

    A pair with one side only has no prompt. Null turn numbers read as -1, null roles and texts as empty; rows
    with null pair_id or side belong to no pair and are left out; repeated rows are repeated turns: they
    are common only if both sides have as many. An empty table gives an empty result.
    """
    rows = turns.filter("pair_id is not null and side in ('chosen', 'rejected')").select(
        "pair_id", "side", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    sign = F.when(F.col("side") == "chosen", 1).otherwise(-1)
    summed = lambda *seed: F.sum(F.xxhash64("role", "text", *seed).cast("decimal(20,0)") * sign)
    level = rows.groupBy("pair_id", "turn").agg(F.sum(sign).alias("n"), summed().alias("a"), summed(F.lit("second")).alias("b"))
    cut = level.groupBy("pair_id").agg(F.min(F.when((F.col("n") != 0) | (F.col("a") != 0) | (F.col("b") != 0), F.col("turn"))).alias("cut"))
    out = salted_join(rows, cut, "pair_id", row_salt())
    common = F.col("cut").isNull() | (F.col("turn") < F.col("cut"))
    loss = ~common & (F.col("role") == "assistant")
    rendered = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("<|end|>\n"))
    return out.filter(~common | (F.col("side") == "chosen")).select(
        "pair_id", F.when(common, "prompt").otherwise(F.col("side")).alias("part"), "turn", "role", rendered.alias("rendered"),
        F.length(rendered).cast("long").alias("n_chars"), F.when(loss, 1).otherwise(0).alias("loss"),
        F.when(loss, F.length("role") + 5).otherwise(0).cast("long").alias("loss_start"), F.when(loss, F.length(rendered) - 1).otherwise(0).cast("long").alias("loss_stop"),
    )


def op8_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """Conversations 2k (chosen) and 2k + 1 (rejected) are a pair k."""
    turns = table(spark, sf_dir, "conversations")
    return format_preferences(turns.select(F.shiftright("conv_id", 1).alias("pair_id"), F.when(F.col("conv_id").bitwiseAND(1) == 0, "chosen").when(F.col("conv_id").isNotNull(), "rejected").alias("side"), "turn", "role", "text"))


OP8_SQL = r"""
WITH r AS (SELECT conv_id >> 1 AS pair_id, CASE WHEN conv_id & 1 = 0 THEN 'chosen' ELSE 'rejected' END AS side, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT pair_id, turn, list_sort(list((role, text)) FILTER (side = 'chosen')) AS c, list_sort(list((role, text)) FILTER (side = 'rejected')) AS j FROM r GROUP BY ALL),
k AS (SELECT pair_id, min(turn) FILTER (c IS DISTINCT FROM j) AS cut FROM l GROUP BY ALL),
x AS (SELECT r.*, coalesce(turn < cut, TRUE) AS common, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered FROM r JOIN k USING (pair_id))
SELECT pair_id, CASE WHEN common THEN 'prompt' ELSE side END AS part, turn, role, rendered, CAST(length(rendered) AS BIGINT) AS n_chars, CASE WHEN NOT common AND role = 'assistant' THEN 1 ELSE 0 END AS loss,
  CAST(CASE WHEN NOT common AND role = 'assistant' THEN length('<|assistant|>' || chr(10)) ELSE 0 END AS BIGINT) AS loss_start, CAST(CASE WHEN NOT common AND role = 'assistant' THEN length(rendered) - 1 ELSE 0 END AS BIGINT) AS loss_stop
FROM x WHERE NOT common OR side = 'chosen'
"""
