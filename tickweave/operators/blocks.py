"""Ordered operators over long keys, a block of the order at a time, so that one key's rows are many tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Rows of a block over all keys, about; most blocks; bytes below which rows are one block without being counted.
ROWS, MOST, SMALL = 1 << 20, 4096, 32 << 20


def few(rows: DataFrame) -> bool:
    """Whether the rows are few by the optimizer's estimate, which runs nothing."""
    return int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= SMALL


def in_blocks(rows: DataFrame, key: str, number: Column, size: int | None = None) -> DataFrame:
    """rows with _k, a structure of the key (which is not null where the key is), and _block, from 0.

    Blocks are quantiles of `number`, a column that never falls along the order: about `size` rows of all keys are a block.

    Equal numbers are one block. Rows that are few by the optimizer's estimate (or by `size` rows) are one block; others are counted first, in a pass of their own
    that reads what `number` needs.
    """
    rows, bounds = rows.withColumn("_k", F.struct(F.col(key))), []
    at = F.coalesce(number.cast("double"), F.lit(float("-inf")))
    if size or not few(rows):
        size = size or ROWS
        steps = [k / MOST for k in range(1, MOST)]
        n, marks = rows.agg(F.count("*"), F.percentile_approx(at, steps, MOST * 10)).first()
        blocks = min(MOST, -(-n // size))
        bounds = sorted({marks[MOST * k // blocks - 1] for k in range(1, blocks)} - {float("-inf")}) if marks else []
    if not bounds:
        return rows.withColumn("_block", F.lit(0).cast("tinyint"))
    cut = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="_at", outputCol="_block", handleInvalid="keep")
    return cut.transform(rows.withColumn("_at", at)).withColumn("_block", F.col("_block").cast("int")).drop("_at")


def one_block(rows: DataFrame) -> bool:
    """Whether in_blocks made a single one, which it says by the column's type."""
    return rows.schema["_block"].dataType.simpleString() == "tinyint"


def within(order: str) -> WindowSpec:
    """A key's rows of one block in their order."""
    return Window.partitionBy("_k", "_block").orderBy(order)


def carry(rows: DataFrame, summary: Column, over: Callable[[str], Column], into: str = "_carry") -> DataFrame:
    """rows with what `over` makes of the summaries of the key's earlier blocks; null in the first.

    The summaries, a row a key and block, are aggregated where the rows are read, and then joined: the rows are shuffled once, by key and block, for this join and
    for windows of `within`; if the summaries are small enough to be broadcast, for the windows alone.
    """
    if one_block(rows):
        return rows.withColumn(into, F.lit(None).cast(rows.agg(summary).schema[0].dataType))
    ends = rows.groupBy("_k", F.col("_block").alias("_b")).agg(summary.alias("_s"))
    return with_ends(rows, ends.select("_k", "_b", over("_s").over(earlier()).alias(into)))


def earlier() -> WindowSpec:
    """A key's earlier blocks, in a table of a row for each key _k and block _b."""
    return Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)


def with_ends(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """rows with the other columns of ends, which has a row for each key _k and block _b."""
    ends = ends.withColumnRenamed("_k", "_key")
    return rows.join(ends, (F.col("_k") == F.col("_key")) & (F.col("_block") == F.col("_b")), "left").drop("_key", "_b")


def numbered(rows: DataFrame, key: str, order: str, number: Column, into: str, size: int | None = None) -> DataFrame:
    """rows with their place from 0 within the key."""
    rows = carry(in_blocks(rows, key, number, size), F.count("*"), F.sum)
    place = F.row_number().over(within(order)) - 1 + F.coalesce("_carry", F.lit(0))
    return rows.withColumn(into, place.cast("long")).drop("_carry", "_block", "_k")
