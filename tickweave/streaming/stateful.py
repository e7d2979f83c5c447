"""Streaming forms of the gap detector, the limiter, the idle timeout, the interleaved log and the snapshot trigger."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tickweave.operators.blocks import numbered
from tickweave.operators.schedule import ACTIVITY
from tickweave.operators.sequence import Limiter, admit
from tickweave.plans.session import ship
from tickweave.sources import framelog
from tickweave.streaming import processors


def _with_state(rows: DataFrame, key: str, processor: StatefulProcessor, out: str, mode: str = "None") -> DataFrame:
    """Rows of a stateful processor. Its code goes along by value, as the process that prepares its state doesn't have this package."""
    spark = rows.sparkSession
    ship(spark)
    cloudpickle.register_pickle_by_value(processors)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return rows.groupBy(key).transformWithStateInPandas(processor, out, "Append", mode)


def stream_gaps(diffs: DataFrame, reorder: int | None = None, consecutive: bool = False) -> DataFrame:
    """symbol, seq, expected_u, first_u, prev_u from a stream of symbol, seq, first_update_id, last_update_id.

    Each symbol's last id is its state. Without `reorder`, a symbol's rows of a micro-batch are sorted by seq and follow those of the batch before. With it, at most
    that many rows of a symbol wait in the state after a batch, and the first of them is placed when there are more; consecutive: seq counts a symbol's rows from 0,
    so a row whose predecessor was placed needn't wait. Within a batch rows may come in any order, as they do over a shuffle. A row that comes in a later batch than
    one behind it was placed is given with null expected_u and prev_u, and so is, if consecutive, a row whose seq was there.

    In memory are, of a symbol's rows of one batch, the runs of consecutive ones; if they aren't `consecutive`, or without `reorder`, 32 bytes a row.
    """
    return _with_state(diffs, "symbol", processors.Gaps(reorder, consecutive), "symbol string, seq long, expected_u long, first_u long, prev_u long")


def stream_admit(calls: DataFrame, limit: int, window: int) -> DataFrame:
    """key, at, admitted from a stream of key (string) and at (long). A micro-batch's calls of a key are taken in the order of at."""
    return _with_state(calls, "key", processors.Admit(limit, window), "key string, at long, admitted boolean")


def stream_idle(frames: DataFrame, seconds: int = 60) -> DataFrame:
    """connection, last_activity, timeout_at (micros) of connections without activity for `seconds`, from a stream of connection (string), at (micros), opcode.

    Activity (binary, text, ping) sets a timer of processing time, also at a connection's first frame, whatever it is; a close ends it. The timer fires
    without a further row, and after a restart. A connection that goes on after its timeout starts anew.
    """
    return _with_state(frames, "connection", processors.Idle(seconds, ACTIVITY), "connection string, last_activity long, timeout_at long", "ProcessingTime")


def stream_interleave(sbe: DataFrame, rest: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """symbol, seq, recv_nanos, tag_byte, payload: both streams (recv_nanos, symbol, tag_byte, payload) as one log, in the order of `interleave`.

    Rows wait until the watermark, `delay` behind the latest receipt, has passed them; numbers go on over batches. Rows that come behind the watermark (which begins
    at 1970) are dropped by Spark.
    """
    both = sbe.unionByName(rest).withColumn("_at", F.timestamp_micros(F.expr("recv_nanos div 1000"))).withWatermark("_at", delay)
    return _with_state(both, "symbol", processors.Interleave(), "symbol string, seq long, recv_nanos long, tag_byte int, payload binary", "EventTime")


def snapshot_rows(due: DataFrame, fetch, completed, at: str | None = None) -> DataFrame:
    """Admitted calls (symbol, admitted) as 'R' rows of what fetch(SYMBOL) gives; failed fetches, and calls whose admission is null, are left out.

    completed() gives the time of completion in nanos; with `at`, completed(time of the call) does.
    """
    ship(due.sparkSession)

    def run(frames):
        for f in frames:
            out = []
            calls = f[f["admitted"].fillna(False).astype(bool)]
            for s, t in zip(calls["symbol"], calls[at] if at else calls["symbol"], strict=True):
                try:
                    got = fetch(s.upper())
                except OSError:
                    continue
                out.append((completed(t) if at else completed(), s, 82, got))
            yield pd.DataFrame(out, columns=["recv_nanos", "symbol", "tag_byte", "payload"])

    return due.mapInPandas(run, "recv_nanos long, symbol string, tag_byte int, payload binary")


def recover(gaps: DataFrame, scheduled: DataFrame | None, fetch, completed, limit: int = 100, window: int = 60_000_000_000, at: str = "at") -> DataFrame:
    """'R' rows of the snapshots that gaps (symbol, at in nanos) ask for, and a schedule (the same columns) besides.

    All calls share one limiter, by time, then symbol; a rejected call is dropped, not tried again, and a failed one counts. Gaps are few,
    and the limiter's order is one for all symbols, so its calls are one task's, in a stream.
    """
    calls = gaps.select(F.lower("symbol").alias("symbol"), F.col(at).cast("long").alias("at"))
    if scheduled is not None:
        calls = calls.unionByName(scheduled.select(F.lower("symbol").alias("symbol"), F.col(at).cast("long").alias("at")))
    admitted = admit(calls.withColumn("_one", F.lit(0)), "_one", "at", limit, window, "symbol").drop("_one")
    return snapshot_rows(admitted, fetch, completed, "at")


def recover_live(gaps: DataFrame, folder: str, fetch: Callable[[str], bytes], checkpoint: str, symbols: Sequence[str] = (), every: float = 3600, limit: int = 100, window: float = 60, clock: Callable[[], int] = time.time_ns, trigger: str = "10 seconds") -> StreamingQuery:
    """A query that appends the snapshots that a stream of gaps (symbol, seq) asks for, and those of all `symbols` at its start and `every` seconds, to the frame log.

    Each batch first writes down which calls it makes, with the limiter's times, then fetches in tasks, then commits the rows under its number. So a batch
    that is run again makes the same calls, and none if it was committed. All calls share one limiter; at most `limit` rows of a batch can be admitted, so no more
    come to the driver. Scheduled calls come first; a rejected call is dropped.

    A schedule needs batches without new rows: gaps from an operator with processing-time timers have them; else they wait for the next row.
    """
    spark = gaps.sparkSession
    framelog.register(spark)
    sink, span = checkpoint, int(window * 10**9)
    where, root = framelog._open(folder)
    notes = f"{root}/_calls/{hashlib.sha256(sink.encode()).hexdigest()[:16]}"

    def calls_of(asked: list[str], number: int) -> list[str]:
        from pyarrow import fs

        where.create_dir(notes, recursive=True)
        there = sorted(i.base_name for i in where.get_file_info(fs.FileSelector(notes)) if i.base_name.endswith(".json"))
        name = f"{number:010d}.json"
        if name not in there:
            before = [n for n in there if n < name]
            held = framelog._json(where, f"{notes}/{before[-1]}") if before else {"admitted": [], "scheduled": None}
            now, limiter = clock(), Limiter(limit, span, held["admitted"])
            due = list(symbols) if held["scheduled"] is None or now >= held["scheduled"] + every * 10**9 else []
            calls = [s.lower() for s in [*due, *asked] if limiter.admit(now)]
            note = {"calls": calls, "admitted": list(limiter.admitted), "scheduled": now if due else held["scheduled"]}
            framelog._create(where, f"{notes}/{name}", json.dumps(note).encode())
            for n in before[:-1]:
                where.delete_file(f"{notes}/{n}")
        return framelog._json(where, f"{notes}/{name}")["calls"]

    def step(batch: DataFrame, number: int) -> None:
        # always read, or the state of what makes the gaps isn't committed
        asked = [r[0] for r in batch.select(F.lower("symbol").alias("symbol"), "seq").orderBy("seq", "symbol").limit(limit).collect()]
        if framelog.state_of(where, root).streams.get(sink, -1) >= number:
            return
        if calls := calls_of(asked, number):
            due = spark.createDataFrame([(s, True) for s in calls], "symbol string, admitted boolean").repartition(min(len(calls), 16))
            rows = snapshot_rows(due, fetch, clock)
            day = F.date_format(F.timestamp_micros(F.expr("recv_nanos div 1000")), "yyyyMMdd")
            rows.withColumn("file_date", day).write.format("framelog").option("sinkId", sink).option("batchId", number).mode("append").save(folder)

    return gaps.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(processingTime=trigger).start()


def interleave(sbe: DataFrame, rest: DataFrame, size: int | None = None) -> DataFrame:
    """One log of both kinds of rows (recv_nanos, symbol, tag_byte, payload): with tag, and seq, the place in the symbol's log from 0.

    The order is that of receipt (for snapshots: of completion); at one time messages stand before snapshots, equal rows in the
    order of their payloads. A symbol's rows are dealt out by blocks of time.
    """
    both = sbe.unionByName(rest).withColumn("_order", F.struct("recv_nanos", (F.col("tag_byte") == 82).alias("late"), "payload"))
    rows = numbered(both, "symbol", "_order", F.col("recv_nanos"), "seq", size)
    return rows.drop("_order").withColumn("tag", F.char("tag_byte"))


def stop(query: StreamingQuery) -> None:
    """Graceful end: what has arrived is processed and committed, then the query stops; a restart from its checkpoint goes on behind it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
