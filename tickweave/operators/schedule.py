"""File rotation, snapshot times, idle sessions, reconnect delays, subscriptions, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.operators.blocks import carry, earlier, in_blocks, one_block, with_ends, within

# Fixed values of the wire interface: stream names, with $symbol in place of the symbol.
STREAMS = ["$symbol@trade", "$symbol@bestBidAsk", "$symbol@depth", "$symbol@depth20"]


def rotated(records: DataFrame, folder: str, symbol: str = "symbol", at: str = "ts", order: str = "seq", size: int | None = None) -> DataFrame:
    """records with file_date, which never goes back along `order` (whole numbers), and file. A symbol's records are dealt out by blocks of the order."""
    rows = carry(in_blocks(records, symbol, F.col(order), size), F.max(F.to_date(at)), F.max)
    day = F.greatest(F.max(F.to_date(at)).over(within(order).rowsBetween(Window.unboundedPreceding, 0)), "_carry")
    out = rows.withColumn("file_date", F.date_format(day, "yyyyMMdd")).drop("_carry", "_block", "_k")
    return out.withColumn("file", F.concat(F.lit(folder + "/"), symbol, F.lit("_"), "file_date", F.lit(".zst")))


def snapshot_times(bounds: DataFrame, symbols: DataFrame, every: str = "interval 1 hour") -> DataFrame:
    """bounds: one row (start, stop). A row for each symbol (symbol, ordinal) and time, in both orders."""
    times = bounds.select(F.expr(f"sequence(start, stop, {every})").alias("_due"))
    return symbols.crossJoin(F.broadcast(times)).withColumn("due", F.explode("_due")).drop("_due")  # one row is broadcast


def idle_sessions(events: DataFrame, key: str, at: str, seconds: int = 60, size: int | None = None) -> DataFrame:
    """key, session, start, stop, n: a session ends where more than `seconds` pass to the next event.

    A key's events are dealt out by blocks of time and become the block's pieces of sessions there; what is shuffled again is pieces. A block's first piece goes on
    with the session before it if that is near enough, and the sessions of earlier blocks are counted from a row a block.
    """
    rows = in_blocks(events.select(key, at), key, F.unix_micros(F.col(at)), size)
    place = within(at)
    far = lambda a, b: F.unix_micros(F.col(a)) - F.unix_micros(F.col(b)) > seconds * 1_000_000
    rows = rows.withColumn("_before", F.lag(at).over(place))
    rows = rows.withColumn("_piece", F.sum(F.when(F.col("_before").isNull() | far(at, "_before"), 1).otherwise(0)).over(place.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = rows.groupBy("_k", "_block", "_piece").agg(F.min(at).alias("start"), F.max(at).alias("stop"), F.count("*").alias("n"))
    if one_block(rows):
        return pieces.select(F.col("_k")[key].alias(key), (F.col("_piece") - 1).alias("session"), "start", "stop", "n")
    blocks = pieces.groupBy("_k", F.col("_block").alias("_b")).agg(F.min("start").alias("_start"), F.max("stop").alias("_stop"), F.max("_piece").alias("_m"))
    blocks = blocks.withColumn("_last", F.max("_stop").over(earlier())).withColumn("_on", F.coalesce(~far("_start", "_last"), F.lit(False)).cast("int"))
    blocks = blocks.select("_k", "_b", "_on", F.coalesce(F.sum(F.col("_m") - F.col("_on")).over(earlier()), F.lit(0)).alias("_done"))
    pieces = with_ends(pieces, blocks)
    session = F.col("_done") + F.col("_piece") - 1 - F.col("_on")
    return pieces.groupBy(F.col("_k")[key].alias(key), session.alias("session")).agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("n").alias("n"))


# Fixed values of the socket's frames: what each kind of frame makes the collector do, and which kinds show that the connection lives.
ACTIONS = {"Binary": "record", "Text": "log", "Ping": "pong", "Close": "error"}
ACTIVITY = ("Binary", "Text", "Ping")


def frame_action(opcode: Column) -> Column:
    """What is done with a frame: record, log, pong, error, or ignore for any other kind."""
    out = F.lit("ignore")
    for name, action in ACTIONS.items():
        out = F.when(opcode == name, action).otherwise(out)
    return out


def binary_frames(frames: DataFrame, opcode: str = "opcode") -> DataFrame:
    """The frames that are data."""
    return frames.filter(F.col(opcode) == "Binary").drop(opcode)


def idle_timeouts(frames: DataFrame, connection: str, at: str, opcode: str, seconds: int = 60, check: int = 10) -> DataFrame:
    """connection, last_activity, timeout_at (micros) of the connections that time out; at: micros.

    A connection starts with its first frame. Every `check` seconds from then on it is looked whether more than `seconds` have passed since its
    last activity: a binary, text or ping frame; others are none. The first time that is so, it ends; a close frame ends it, too, and frames
    after an end are not looked at. After the last frame of a connection nothing shows that it was still open, so it times out.
    """
    start = F.min(at).over(Window.partitionBy(connection))
    rows = frames.select(connection, F.col(at).alias("_at"), F.col(opcode).alias("_op"), start.alias("_start"))
    marks = rows.filter(F.col("_op").isin(*ACTIVITY, "Close") | (F.col("_at") == F.col("_start")))
    following = F.lead("_at").over(Window.partitionBy(connection).orderBy("_at"))
    over, step = seconds * 1_000_000, check * 1_000_000
    tick = F.col("_start") + (F.floor((F.col("_at") + over - F.col("_start")) / step) + 1) * step
    marks = marks.withColumns({"_next": following, "_tick": tick})
    ends = marks.filter((F.col("_op") == "Close") | F.col("_next").isNull() | (F.col("_tick") < F.col("_next")))
    # the first end; of a close and what else stands at that time, the close
    first = ends.groupBy(connection).agg(F.min_by(F.struct("_op", "_at", "_tick"), F.struct(F.when(F.col("_op") == "Close", F.col("_at")).otherwise(F.col("_tick")), F.col("_op") != "Close")).alias("e"))
    return first.filter("e._op <> 'Close'").select(connection, F.col("e._at").alias("last_activity"), F.col("e._tick").alias("timeout_at"))


def backoff_ms(failures: Column, seed: Column) -> Column:
    """Delay before a retry: 100 ms doubled up to 7 times, 10 s at most, a quarter either way by the seed."""
    base = F.least(F.lit(100) * F.pow(F.lit(2), F.least(failures, F.lit(7))).cast("bigint"), F.lit(10000).cast("bigint"))
    reach = F.greatest(F.floor(base / 4), F.lit(1).cast("bigint"))
    return base + F.pmod(seed, 2 * reach + 1) - reach


def failures_in_row(sessions: DataFrame, key: str, order: str, seconds: str) -> DataFrame:
    """sessions with the failure count that its retry uses: one more than before, 0 after a session of over 30 s."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    long = F.col(seconds) > 30
    out = sessions.withColumn("_run", F.sum(F.when(long, 1).otherwise(0)).over(w))
    place = F.row_number().over(Window.partitionBy(key, "_run").orderBy(order))
    return out.withColumn("failures", F.when(F.col("_run") > 0, place - 1).otherwise(place)).drop("_run")


def subscription(symbols: list[str]) -> str:
    return "/".join(t.replace("$symbol", s.lower()) for s in symbols for t in STREAMS)


def subscription_path(symbols: DataFrame, order: str, symbol: str = "symbol") -> DataFrame:
    """One row: the streams of all symbols, by symbol, then stream."""
    names = F.array(*(F.concat(F.lower(symbol), F.lit(t.removeprefix("$symbol"))) for t in STREAMS))
    rows = symbols.groupBy().agg(F.array_sort(F.collect_list(F.struct(order, names.alias("names")))).alias("all"))
    return rows.select(F.array_join(F.flatten(F.transform("all", lambda x: x["names"])), "/").alias("path"))


def file_counts(records: DataFrame) -> DataFrame:
    """Per file: total, sbe, rest; files whose scan ended in an error are left out."""
    bad = F.max(F.col("error").isNotNull())
    out = records.groupBy("file").agg(F.count_if(F.col("error").isNull()).alias("total"), F.count_if(F.col("tag_byte") == 83).alias("sbe"), F.count_if(F.col("tag_byte") == 82).alias("rest"), bad.alias("_bad"))
    return out.filter("not _bad").drop("_bad")


def coin_symbol(coin: Column) -> Column:
    """A coin's symbol against the common quote."""
    return F.concat(coin, F.lit("usdt"))


def mapping_parts(mapping: Column) -> tuple[Column, Column]:
    """Exchange and path of exchange:path; what has no colon is both."""
    return F.substring_index(mapping, ":", 1), F.regexp_replace(mapping, "^[^:]*:", "")


def snapshot_url(base: str, symbol: Column, limit: int = 5000) -> Column:
    """The request for a symbol's order book."""
    return F.concat(F.lit(f"{base}/api/v3/depth?symbol="), F.upper(symbol), F.lit(f"&limit={limit}"))
