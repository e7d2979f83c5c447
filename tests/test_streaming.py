import json
import random
import struct
import time
from pathlib import Path

import pytest
import zstandard
from pyspark.sql import functions as F

from tickweave.operators import printed, sequence
from tickweave.sources import framelog
from tickweave.streaming import stateful


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Each partition has a state store of its own."""
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", held)


def run_in_steps(spark, tmp_path, steps, schema, transform, name):
    """All rows of transform over a stream whose micro-batches are steps."""
    folder = tmp_path / "in"
    folder.mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
    query = transform(stream).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / "state")).start()
    try:
        for i, rows in enumerate(steps):
            part = tmp_path / f"{i}.part"
            part.write_text("\n".join(rows))
            part.rename(folder / f"{i}.json")
            query.processAllAvailable()
        return spark.table(name).collect()
    finally:
        query.stop()


def test_stream_gaps_keep_the_last_id_over_batches(spark, tmp_path):
    row = lambda s, q, f, t: f'{{"symbol": "{s}", "seq": {q}, "first_update_id": {f}, "last_update_id": {t}}}'
    steps = [[row("a", 2, 4, 6), row("a", 1, 1, 3), row("b", 1, 9, 9)], [row("a", 3, 8, 9), row("b", 2, 10, 11)], [row("a", 4, 8, 9), row("a", 5, 10, 11)]]
    got = run_in_steps(spark, tmp_path, steps, "symbol string, seq long, first_update_id long, last_update_id long", stateful.stream_gaps, "gaps_out")
    assert sorted(map(tuple, got)) == [("a", 3, 7, 8, 6), ("a", 4, 10, 8, 9)]


def test_stream_limiter_keeps_its_window_over_batches(spark, tmp_path):
    row = lambda k, t: f'{{"key": "{k}", "at": {t}}}'
    steps = [[row("a", 0), row("a", 1), row("b", 5)], [row("a", 2), row("b", 6), row("a", 10)], [row("a", 11), row("a", 12)]]
    got = run_in_steps(spark, tmp_path, steps, "key string, at long", lambda s: stateful.stream_admit(s, 2, 10), "admit_out")
    assert sorted(map(tuple, got)) == [("a", 0, True), ("a", 1, True), ("a", 2, False), ("a", 10, True), ("a", 11, True), ("a", 12, False), ("b", 5, True), ("b", 6, True)]


def test_snapshot_rows_and_interleave(spark):
    def fetch(symbol):
        if symbol == "BAD":
            raise OSError("no answer")
        return symbol.encode()

    due = spark.createDataFrame([("a", True), ("b", False), ("bad", True)], "symbol string, admitted boolean")
    rest = stateful.snapshot_rows(due, fetch, lambda: 7)
    log = stateful.interleave(spark.createDataFrame([(3, "a", 83, b"m")], "recv_nanos long, symbol string, tag_byte int, payload binary"), rest)
    assert sorted((r.recv_nanos, r.symbol, r.tag, bytes(r.payload)) for r in log.collect()) == [(3, "a", "S", b"m"), (7, "a", "R", b"A")]


def test_pushdown_keeps_rows_and_errors(spark, tmp_path):
    row = lambda n, tag, p: framelog.ROW.pack(n, ord(tag), len(p)) + p
    z = zstandard.ZstdCompressor().compress
    (tmp_path / "a.zst").write_bytes(z(b"".join(row(n, "SR"[n % 2], b"x") for n in range(10))))
    (tmp_path / "b.zst").write_bytes(z(row(5, "S", b"y")))
    framelog.register(spark)
    log = spark.read.format("framelog").load(str(tmp_path))
    assert log.filter("recv_nanos >= 4 and recv_nanos < 8 and tag_byte = 83").count() == 3
    assert [r.file for r in log.filter(F.col("file") == str(tmp_path / "b.zst")).collect()] == [str(tmp_path / "b.zst")]
    with pytest.raises(Exception, match="ends within"):
        (tmp_path / "c.zst").write_bytes(z(row(1, "S", b"long")[:-2]))
        spark.read.format("framelog").option("mode", "FAILFAST").load(str(tmp_path)).filter("tag_byte = 82").count()


def test_printed_odd_records(spark):
    head = lambda block, t: struct.pack("<HHHH", block, t, 1, 0)
    rows = [(1, 83, b"abc"), (2, 83, head(9, 7) + b"\2ab"), (3, 83, head(90, 10001)), (4, 88, b"zz"), (5, 82, None), (6, 82, b'{"bids": [7, ["1", 2]], "asks": 3}'), (7, 83, head(4, 10000) + b"1234"), (8, None, None), (9, 83, head(4, 10003) + b"1234")]
    got = {r.recv_nanos: r.line for r in printed.printed(spark.createDataFrame(rows, "recv_nanos long, tag_byte int, payload binary"), ["recv_nanos"]).collect()}
    assert got == {
        1: "[1] S <too short: 3 bytes>", 2: "[2] S template=7 ab block_len=9 total=11b", 3: "[3] S BEST_BID_ASK unknown block_len=90 total=8b", 4: "[4] unknown tag: 0x58, payload_len=2",
        5: "[5] R <invalid JSON>", 6: "[6] R SNAPSHOT lastUpdateId=0 bids=2 asks=0\n  Bids:\n    1 @ ?", 9: "[9] S DEPTH_DIFF unknown block_len=4 total=12b",
    }


def test_recovery_shares_one_limiter(spark):
    def fetch(symbol):
        if symbol == "B":
            raise OSError("no answer")
        return symbol.encode()

    gaps = spark.createDataFrame([("a", 10), ("b", 20), ("a", 30), ("a", 111)], "symbol string, at long")
    due = spark.createDataFrame([("C", 25)], "symbol string, at long")
    rows = stateful.recover(gaps, due, fetch, lambda t: t + 1, 2, 100).collect()
    # b's failed call counts; c and a at 30 are over the limit; at 111 that of 10 is out of the window
    assert sorted((r.recv_nanos, r.symbol, r.tag_byte, bytes(r.payload)) for r in rows) == [(11, "a", 82, b"A"), (112, "a", 82, b"A")]
    assert stateful.recover(gaps.limit(0), None, fetch, lambda t: t).count() == 0
    null = spark.createDataFrame([("a", None)], "symbol string, admitted boolean")
    assert stateful.snapshot_rows(null, fetch, lambda: 1).count() == 0


def test_log_replays_as_a_stream(spark, tmp_path):
    framelog.register(spark)
    folder = str(tmp_path / "log")
    rows = lambda ns: spark.createDataFrame([("a", "20240101", n, 83, bytes([n]), n) for n in ns], "symbol string, file_date string, recv_nanos long, tag_byte int, payload binary, seq long")
    framelog.write_log(rows([1, 2]), folder)
    query = spark.readStream.format("framelog").load(folder).writeStream.format("memory").queryName("replayed").option("checkpointLocation", str(tmp_path / "state")).start()
    query.processAllAvailable()
    framelog.write_log(rows([3]), folder)
    stateful.stop(query)
    assert sorted((r.recv_nanos, bytes(r.payload)) for r in spark.table("replayed").collect()) == [(1, b"\1"), (2, b"\2"), (3, b"\3")]


def in_batches(rows, rnd, most):
    """Rows as JSON, cut at random into batches of `most` at most."""
    out = [[]]
    for r in rows:
        if len(out[-1]) >= rnd.randint(1, most):
            out.append([])
        out[-1].append(json.dumps(r))
    return out


@pytest.mark.parametrize("consecutive", [True, False])
def test_stream_gaps_over_shuffled_batches(spark, tmp_path, consecutive):
    """Rows that come in other batches than their neighbours are placed; the result is that of the batch form."""
    rnd = random.Random(4)
    rows = []
    for s in "ab":
        at = 0
        for k in range(120):
            at += 1 if rnd.random() < 0.8 else rnd.randint(-2, 4)
            rows.append({"symbol": s, "seq": k * (1 if consecutive else 5), "first_update_id": at, "last_update_id": at})
    want = sequence.gaps(spark.createDataFrame([tuple(r.values()) for r in rows], "symbol string, seq long, first_update_id long, last_update_id long")).select("symbol", "seq", "expected_u", "first_u", "prev_u").collect()
    moved = sorted(rows, key=lambda r: r["seq"] // (1 if consecutive else 5) + rnd.randint(0, 9))
    if not consecutive:  # rows that push the last ones out of the buffer
        moved += [{"symbol": s, "seq": 10_000 + k, "first_update_id": 10**6 + k, "last_update_id": 10**6 + k} for k in range(25) for s in "ab"]
    schema = "symbol string, seq long, first_update_id long, last_update_id long"
    got = run_in_steps(spark, tmp_path, in_batches(moved, rnd, 40), schema, lambda s: stateful.stream_gaps(s, 20, consecutive), f"shuffled_{consecutive}")
    assert sorted(tuple(r) for r in got if r.first_u < 10**6) == sorted(map(tuple, want)) and len(want) > 20


@pytest.mark.parametrize("consecutive", [True, False])
def test_stream_gaps_of_a_batch_in_any_order(spark, tmp_path, consecutive):
    """A shuffle gives a batch's rows in any order, so far more of them than the buffer has may come before an earlier one; none is late for that."""
    rnd = random.Random(7)
    rows = [{"symbol": "a", "seq": k * (1 if consecutive else 3), "first_update_id": k + k // 97, "last_update_id": k + k // 97} for k in range(2000)]
    want = [(r["seq"], r["first_update_id"] - 1, r["first_update_id"], r["first_update_id"] - 2) for r in rows if r["first_update_id"] % 98 == 0 and r["seq"]]
    rnd.shuffle(rows)
    rest = [] if consecutive else [[json.dumps({"symbol": "a", "seq": 10_000 + k, "first_update_id": 10**6 + k, "last_update_id": 10**6 + k}) for k in range(9)]]
    schema = "symbol string, seq long, first_update_id long, last_update_id long"
    got = run_in_steps(spark, tmp_path, [[json.dumps(r) for r in rows], *rest], schema, lambda s: stateful.stream_gaps(s, 8, consecutive), f"any_order_{consecutive}")
    assert sorted(tuple(r)[1:] for r in got if r.first_u < 10**6) == want and len(want) == 20


def test_stream_gaps_names_rows_that_come_too_late(spark, tmp_path):
    row = lambda q: json.dumps({"symbol": "a", "seq": q, "first_update_id": q, "last_update_id": q})
    steps = [[row(k) for k in (1, 2, 3, 4)], [row(0), row(5)]]
    got = run_in_steps(spark, tmp_path, steps, "symbol string, seq long, first_update_id long, last_update_id long", lambda s: stateful.stream_gaps(s, 2), "too_late")
    assert [tuple(r) for r in got] == [("a", 0, None, 0, None)]


def test_stream_interleave_equals_batch(spark, tmp_path):
    rnd = random.Random(6)
    rows = [{"recv_nanos": 10**9 * k + rnd.choice([0, 1, 999]), "symbol": rnd.choice("ab"), "tag_byte": 82 if rnd.random() < 0.3 else 83, "payload": rnd.choice(["eA==", "eQ=="])} for k in range(1, 61) for _ in range(3)]
    schema = "recv_nanos long, symbol string, tag_byte int, payload binary"
    both = spark.createDataFrame([json.dumps(r) for r in rows], "string").select(F.from_json("value", schema).alias("r")).select("r.*")
    want = stateful.interleave(both.filter("tag_byte = 83"), both.filter("tag_byte = 82")).select("symbol", "seq", "recv_nanos", "tag_byte", "payload").collect()
    moved = sorted(rows, key=lambda r: r["recv_nanos"] + rnd.randint(0, 4) * 10**9)
    steps = in_batches(moved, rnd, 30) + [[json.dumps({"recv_nanos": 10**13 + k, "symbol": s, "tag_byte": 83, "payload": "eA=="}) for s in "ab"] for k in range(2)]
    got = run_in_steps(spark, tmp_path, steps, schema, lambda s: stateful.stream_interleave(s.filter("tag_byte = 83"), s.filter("tag_byte = 82"), "6 seconds"), "interleaved")
    assert sorted(map(str, (r for r in got if r.recv_nanos < 10**13))) == sorted(map(str, want)) and len(want) == 180


def wait_for(done, seconds=60):
    end = time.time() + seconds
    while not done():
        assert time.time() < end, "it didn't happen"
        time.sleep(0.3)


def test_a_silent_connection_times_out_without_a_row(spark, tmp_path):
    """The timer fires though nothing more comes, and after a restart, too; a close and a pong don't count as activity."""
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    at = lambda c, t, op: json.dumps({"connection": c, "at": t, "opcode": op})

    def start():
        frames = spark.readStream.schema("connection string, at long, opcode string").json(str(folder))
        return stateful.stream_idle(frames, 3).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="300 milliseconds").start()

    found = lambda: sorted((r.connection, r.last_activity) for r in spark.read.schema("connection string, last_activity long, timeout_at long").parquet(out).collect()) if Path(out).exists() else []
    (folder / "0.json").write_text("\n".join([at("a", 1, "Binary"), at("a", 9, "Pong"), at("b", 2, "Text"), at("b", 5, "Close"), at("c", 3, "Pong")]))
    query = start()
    wait_for(lambda: found() == [("a", 1), ("c", 3)])
    query.stop()
    (folder / "1.json").write_text("\n".join([at("a", 20, "Ping"), at("d", 21, "Binary")]))
    query = start()
    wait_for(lambda: sum(p["numInputRows"] for p in query.recentProgress) >= 2)
    query.stop()
    query = start()  # nothing more comes
    try:
        wait_for(lambda: found() == [("a", 1), ("a", 20), ("c", 3), ("d", 21)])
    finally:
        query.stop()


def test_live_recovery_fetches_and_writes_once(spark, tmp_path):
    """From a replayed log to 'R' rows in the log, schedule and gaps under one limiter; a batch that is run again does nothing new."""
    log, calls, now = str(tmp_path / "log"), tmp_path / "calls", tmp_path / "now"
    calls.mkdir()
    now.write_text("1000")
    framelog.register(spark)
    kind = "symbol string, file_date string, recv_nanos long, tag_byte int, payload binary, seq long"
    put = lambda ids: framelog.write_log(spark.createDataFrame([("aaa", "20240101", 5, 83, f"{a} {b}".encode(), k) for k, (a, b) in enumerate(ids)], kind), str(tmp_path / "in"))

    def fetch(symbol):
        (calls / f"{symbol}-{time.time_ns()}").touch()
        if symbol == "BAD":
            raise OSError("no answer")
        return symbol.encode()

    def run():
        ids = F.split(F.col("payload").cast("string"), " ")
        diffs = spark.readStream.format("framelog").load(str(tmp_path / "in")).select(F.lit("aaa").alias("symbol"), "seq", ids[0].cast("long").alias("first_update_id"), ids[1].cast("long").alias("last_update_id"))
        query = stateful.recover_live(stateful.stream_gaps(diffs), log, fetch, str(tmp_path / "state"), ["AAA", "bad"], every=50e-9, limit=4, window=100e-9, clock=lambda: int(now.read_text()), trigger="100 milliseconds")
        stateful.stop(query)

    done = lambda: sorted((r.recv_nanos, bytes(r.payload)) for r in spark.read.format("framelog").load(log).collect() if r.error is None) if Path(log).exists() else []
    put([(0, 0), (1, 1), (5, 5)])
    run()  # scheduled calls of both symbols, and a gap; one fetch fails
    assert done() == [(1000, b"AAA")] * 2 and len(list(calls.iterdir())) == 3
    now.write_text("1010")
    put([(6, 6), (9, 9), (20, 20), (30, 30)])
    run()  # three gaps, of which the limiter admits one; the failed call has counted
    assert done() == [(1000, b"AAA")] * 2 + [(1010, b"AAA")] and len(list(calls.iterdir())) == 4
    for p in (tmp_path / "state" / "commits").glob("*1*"):
        p.unlink()  # Spark hasn't heard that the batch ended
    now.write_text("1040")
    run()
    assert len(done()) == 3 and len(list(calls.iterdir())) == 4
    now.write_text("1110")
    put([(40, 40)])
    run()  # the schedule is due, and of four admitted calls three are out of the window
    assert len(list(calls.iterdir())) == 7 and len(done()) == 5


def test_live_recovery_of_a_batch_in_any_order(spark, tmp_path):
    """The calls are those of the first gaps by seq, however a shuffle has mixed the batch's rows."""
    rnd, log, folder = random.Random(3), str(tmp_path / "log"), tmp_path / "in"
    rows = [{"symbol": s, "seq": k, "first_update_id": k + k // n, "last_update_id": k + k // n} for s, n in (("a", 50), ("b", 80)) for k in range(1000)]
    rnd.shuffle(rows)
    folder.mkdir()
    (folder / "0.json").write_text("\n".join(map(json.dumps, rows)))
    stream = spark.readStream.schema("symbol string, seq long, first_update_id long, last_update_id long").json(str(folder))
    gaps = stateful.stream_gaps(stream, 8, True)
    stateful.stop(stateful.recover_live(gaps, log, lambda s: s.encode(), str(tmp_path / "state"), limit=4, clock=lambda: 7000, trigger="0 seconds"))
    got = sorted(bytes(r.payload) for r in spark.read.format("framelog").load(log).collect())
    assert got == [b"A"] * 3 + [b"B"]  # at 50, 80, 100, 150; rows taken for late ones would be half of each
