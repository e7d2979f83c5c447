"""Symbols at the end of a message: exact and heuristic match, routing, validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.operators.sbe import DIFF, header


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def with_symbol(frames: DataFrame, subscribed: list[str], payload: str = "payload", into: str = "symbol") -> DataFrame:
    """frames with the first subscribed symbol, in that order, that the message ends with (ASCII case aside), lower-cased; else 'unknown'.

    A tail is taken for each length that subscriptions have, where the byte before it fits, and looked up in a broadcast table of them (they
    come as a list of the driver's), so the plan grows with the lengths, not with the symbols.
    """
    lower = str.maketrans(_UPPER, _UPPER.lower())
    rank: dict[str, int] = {}
    for s in subscribed:
        rank.setdefault(s.translate(lower), len(rank))
    data, size, found, out = F.col(payload), F.length(payload), [], frames
    for n in sorted({len(s.encode()) for s in rank}):
        tail, hit = f"_tail{n}", f"_hit{n}"
        known = frames.sparkSession.createDataFrame([(s, (r, s)) for s, r in rank.items() if len(s.encode()) == n], f"{tail} string, {hit} struct<rank:int,symbol:string>")
        text = F.translate(F.substring(data, size - n + 1, F.lit(n)).cast("string"), _UPPER, _UPPER.lower())
        fits = (size > n) & (F.substring(data, size - n, F.lit(1)) == F.lit(bytearray([n])))
        out = out.withColumn(tail, F.when(fits, text)).join(F.broadcast(known), tail, "left")
        found.append(hit)
    first = F.array_min(F.array(*found))["symbol"] if found else F.lit(None)
    return out.select(*(c for c in frames.columns if c != into), F.coalesce(first, F.lit("unknown")).alias(into))


#: A length byte of 19 down to 2 and so many letters, digits or _, at the end of Latin-1 text. The earliest start is the longest.
_TAIL = "(?:" + "|".join(rf"\x{n:02X}[0-9A-Za-z_]{{{n}}}" for n in range(19, 1, -1)) + r")\z"


def match_heuristic(data: Column) -> Column:
    """The longest tail of 2 to 19 letters, digits or _ that its length byte precedes; else 'unknown'."""
    last = F.decode(F.substring(data, F.greatest(F.length(data) - 19, F.lit(1)), F.lit(20)), "ISO-8859-1")
    found = F.regexp_extract(last, _TAIL, 0)
    return F.when(F.length(found) > 0, F.substring(found, 2, 19)).otherwise(F.lit("unknown"))


def route(frames: DataFrame, subscribed: list[str], payload: str = "payload") -> DataFrame:
    """frames with symbol and error_class (null: good). Bad rows stay, marked, where a collector would drop them.

    Under 8 bytes is a format error; a depth diff whose block is too short is a message error, unless its symbol is
    unknown: such rows are kept unchecked.
    """
    data = F.col(payload)
    bad = (header(data)["template_id"] == DIFF.id) & (F.length(data) < 8 + DIFF.block) & (F.col("symbol") != "unknown")
    rows = with_symbol(frames, subscribed, payload).withColumn("symbol", F.when(F.length(data) >= 8, F.col("symbol")))
    return rows.withColumn("error_class", F.when(F.length(data) < 8, "format").when(bad, "sbe"))
