"""Gaps in update ids, and greedy admission under a sliding-window limit."""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.operators.blocks import earlier, in_blocks, one_block, with_ends, within
from tickweave.plans.session import ship


def gaps(diffs: DataFrame, symbol: str = "symbol", order: str = "seq", keep: tuple[str, ...] = (), size: int | None = None) -> DataFrame:
    """Rows whose first_update_id doesn't follow the row before: symbol, seq, expected_u, first_u, prev_u, and the columns of `keep`.

    order: whole numbers. A symbol's rows are dealt out by blocks of it, of about `size` rows. A block's first row looks at the last one of the block before: only
    the two ends of each block meet again, and no row is read twice.
    """
    rows = in_blocks(diffs.select(symbol, order, "first_update_id", "last_update_id", *keep), symbol, F.col(order), size)
    place = within(order)
    rows = rows.withColumn("prev_u", F.lag("last_update_id").over(place))
    gap = F.col("prev_u").isNotNull() & (F.col("first_update_id") != F.col("prev_u") + 1)
    if not one_block(rows):
        rows = rows.withColumns({"_head": F.row_number().over(place) == 1, "_tail": F.lead(F.lit(1)).over(place).isNull()}).filter(gap | F.col("_head") | F.col("_tail"))
        end = F.col("_head") | F.col("_tail")
        ends = Window.partitionBy("_k", F.when(end, -1).otherwise(F.col("_block"))).orderBy(order)
        rows = rows.withColumn("prev_u", F.when(F.col("_head"), F.lag("last_update_id").over(ends)).otherwise(F.col("prev_u")))
    return rows.filter(gap).select(symbol, order, F.col("first_update_id").alias("first_u"), "prev_u", *keep, (F.col("prev_u") + 1).alias("expected_u"))


def last_ids(diffs: DataFrame, symbol: str = "symbol", order: str = "seq") -> DataFrame:
    """The last row's id, whatever came before."""
    return diffs.groupBy(symbol).agg(F.max_by("last_update_id", order).alias("last_update_id"))


class Limiter:
    """Admits a call if fewer than limit admitted ones lie in (now - window, now]; rejected ones don't count."""

    def __init__(self, limit: int, window: int, admitted=()):
        self.limit, self.window, self.admitted = limit, window, deque(admitted)

    def admit(self, now: int) -> bool:
        while self.admitted and self.admitted[0] <= now - self.window:
            self.admitted.popleft()
        if len(self.admitted) >= self.limit:
            return False
        self.admitted.append(now)
        return True


def _segments(calls: DataFrame, key: str, at: str, window: int, size: int | None) -> DataFrame | None:
    """calls with _segment, the time of the last call that came after a silence of `window` or more: no earlier call is in force then. None if the calls are
    one block."""
    rows = in_blocks(calls, key, F.col(at), size)
    if one_block(rows):
        return None
    place = within(at)
    head = F.when(F.col(at) - F.lag(at).over(place) >= window, F.col(at))
    rows = rows.withColumn("_head", head).withColumn("_segment", F.max("_head").over(place.rowsBetween(Window.unboundedPreceding, 0)))
    # a block's first call may come after a silence, too; what stands before the block's first such call goes on with the segment of an earlier block
    ends = rows.groupBy("_k", F.col("_block").alias("_b")).agg(F.min(at).alias("_low"), F.max(at).alias("_high"), F.max("_head").alias("_last"))
    ends = ends.withColumn("_before", F.max("_high").over(earlier()))
    ends = ends.withColumn("_first", F.when(F.col("_before").isNull() | (F.col("_low") - F.col("_before") >= window), F.col("_low")))
    ends = ends.select("_k", "_b", "_first", F.max(F.coalesce("_last", "_first")).over(earlier()).alias("_carry"))
    return with_ends(rows, ends).withColumn("_segment", F.coalesce("_segment", "_first", "_carry")).select(*calls.columns, "_segment")


def admit(calls: DataFrame, key: str, at: str, limit: int = 100, window: int = 60_000_000_000, order: str | None = None, into: str = "admitted", size: int | None = None) -> DataFrame:
    """calls with `into`, per key in the order of at (then order).

    Sequential by nature, as a rejected call doesn't count. But behind a silence as long as the window nothing is in force, so a key's calls are cut there, and
    what lies between two silences is one task's, read in a stream with `limit` times held; a key without silences is one task's as a whole.
    Few calls are cut by key alone. Null times are rejected.
    """
    ship(calls.sparkSession)
    if into in calls.columns:
        raise ValueError(f"there is a column {into} already")
    rows = _segments(calls, key, at, window, size)
    cut = [key] if rows is None else [key, "_segment"]
    rows = calls if rows is None else rows

    def run(batches):
        last, limiter = object(), None
        for b in batches:
            out = []
            for *k, t in zip(*(b[c].astype(object).where(b[c].notna(), None) for c in cut), b[at], strict=True):
                if k != last:
                    last, limiter = k, Limiter(limit, window)
                out.append(not pd.isna(t) and limiter.admit(t))
            yield b[list(names)].assign(**{into: pd.Series(out, index=b.index, dtype=bool)})

    names = calls.columns
    by = [*cut, at] + ([order] if order else [])
    return rows.repartition(*cut).sortWithinPartitions(*by).mapInPandas(run, T.StructType([*calls.schema.fields, T.StructField(into, T.BooleanType())]))
