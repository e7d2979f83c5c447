"""Exact dedup by progressive refinement: length, then prefix hash, then full hash. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import free_name, in_map, key_map, row_salt, salted_join
from tickweave.plans.session import table


def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _repeated(df: DataFrame, *key: str) -> DataFrame:
    """Bitmap rows of the keys that more than one row has."""
    return key_map(df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1"), *key)


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: dict[str, Column] | None = None, prefix: int = 256) -> DataFrame:
    """One row per row of docs: doc (its key), the carried columns, keep_id, group_size, kept.

    Rows whose normalised length nobody shares leave after the first step, those whose prefix nobody shares
    after the second; only the rest are hashed in full (SHA-256). Each step is a scan with a partial
    aggregation; what it leaves is a bitmap of fixed size, so no text is shuffled. The last join's keys may be
    hot (a third of all rows): its rows are salted, and the groups, a row each, stand once for each salt.

    Nulls: a null text counts as empty; a null key stays only if its group has no other. Rows with the smallest
    key of a group all stay if the row itself is repeated under one key. An empty table gives an empty result.
    """
    carry = carry or {}
    base = docs.select(F.col(key).alias("_doc"), normalised(F.col(text)).alias("_norm"), F.struct(*(c.alias(n) for n, c in carry.items()) if carry else [F.lit(0).alias("_")]).alias("_carry"))
    base = base.withColumns({"_len": F.length("_norm"), "_number": row_salt()})
    by_length = _repeated(base.select("_len"), "_len")

    def second(df):
        return in_map(df, by_length, "_m1", "_len").withColumn("_pre", F.when(F.col("_m1"), F.xxhash64(F.left("_norm", F.lit(prefix))))).drop("_m1")

    by_prefix = _repeated(second(base.select("_norm", "_len")).filter("_pre is not null").select("_len", "_pre"), "_len", "_pre")

    def third(df):
        return in_map(second(df), by_prefix, "_m2", "_len", "_pre").withColumn("_full", F.when(F.col("_m2") & F.col("_pre").isNotNull(), F.sha2("_norm", 256))).drop("_m2")

    groups = (
        third(base.select("_doc", "_norm", "_len")).filter("_full is not null")
        .groupBy(F.col("_full").alias("_key")).agg(F.min("_doc").alias("_keep"), F.count("*").alias("_n")).filter("_n > 1")
    )
    # rows that left early get a key of their own, so that they don't meet in one partition
    rows = third(base).select("_doc", "_carry", "_number", F.coalesce("_full", F.concat(F.lit("~"), F.col("_number").cast("string"))).alias("_key"))
    out = salted_join(rows, groups, "_key", F.col("_number"), "left")
    return out.select(
        F.col("_doc").alias("doc"), *(F.col("_carry")[n].alias(n) for n in carry),
        F.coalesce("_keep", "_doc").alias("keep_id"), F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("_n").isNull() | F.col("_doc").eqNullSafe(F.col("_keep"))).alias("kept"),
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the rows that repeat another's normalised text."""
    name = free_name(docs, "row_")
    out = exact_groups(docs, key, text, {name: F.struct(*(F.col(f"`{c}`") for c in docs.columns))})
    return out.filter("kept").select(f"`{name}`.*")


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = exact_groups(docs, carry={"text_sha256": F.sha2(normalised(F.col("text")), 256)})
    return out.select(F.col("doc").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


OP5_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
h AS (SELECT doc_id, sha256(t) AS text_sha256 FROM n),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM h GROUP BY 1)
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, keep_id IS NULL) AS kept, text_sha256 FROM h JOIN g USING (text_sha256)
"""
