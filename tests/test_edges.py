import struct

import zstandard
from pyspark.sql import functions as F

from tickweave.operators import rest, sbe, schedule, sequence, symbols
from tickweave.sources import framelog


def depth(entries, stride=16, count=None, symbol=b"btcUSDT"):
    group = lambda n, e: struct.pack("<HH", stride, n) + b"".join(struct.pack("<qq", *x).ljust(stride, b"\0") for x in e)
    head = struct.pack("<HHHH", 18, 10002, 1, 0) + struct.pack("<qqbb", 1, 2, -8, 3)
    return head + group(count or len(entries), entries) + (group(0, []) + bytes([len(symbol)]) + symbol if count is None else b"")


def trades(declared, held, block=18):
    head = struct.pack("<HHHH", block, 10000, 1, 0) + struct.pack("<qqbb", 5, 6, -2, 0) + b"\0" * (block - 18)
    return head + struct.pack("<HI", 99, declared) + b"".join(struct.pack("<qqqB", i, -i, i * 2, i % 2) for i in range(held))


def frames(spark, payloads):
    return spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "seq long, payload binary")


def test_decoders_on_odd_messages(spark):
    rows = sbe.decode(frames(spark, [trades(6, 4), trades(2, 2, 24), trades(0, 0)]), sbe.TRADES).orderBy("seq").collect()
    assert [(r.declared_trades, len(r.trades)) for r in rows] == [(6, 4), (2, 2), (0, 0)]
    assert rows[0].trades[3].price == -3
    rows = sbe.decode(frames(spark, [depth([(1, 2), (-3, 4)], 24), depth([(1, 2)], count=3), depth([])]), sbe.SNAPSHOT).orderBy("seq").collect()
    assert [tuple(x) for x in rows[0].bids] == [(1, 2), (-3, 4)] and rows[0].asks == [] and rows[0].price_exp == -8
    assert rows[1].bids is None and "bids" in rows[1].decode_error
    assert rows[2].bids == [] and rows[2].decode_error is None


def test_routing(spark):
    rows = symbols.route(frames(spark, [depth([]), b"short", depth([], symbol=b"other")]), ["BTCusdt"]).orderBy("seq").collect()
    assert [(r.symbol, r.error_class) for r in rows] == [("btcusdt", None), (None, "format"), ("unknown", None)]
    rows = frames(spark, [depth([]), depth([], symbol=b"a_1"), depth([], symbol=b"x" * 20)]).select(symbols.match_heuristic(F.col("payload"))).collect()
    assert [r[0] for r in rows] == ["btcUSDT", "a_1", "unknown"]


def test_rest_of_odd_bodies(spark):
    bodies = [b'{"lastUpdateId": 18446744073709551615, "bids": [["1.5", 2], "x", ["3", "4"]], "asks": 7}', b"{", b'{"code": 1}']
    rows = rest.decode_rest(frames(spark, bodies)).orderBy("seq").collect()
    assert [int(r.last_update_id) for r in rows] == [2**64 - 1, 0, 0]
    assert rows[0].bids == [["1.5", "?"], ["3", "4"]] and rows[0].n_bids == 3 and rows[0].n_asks == 0
    assert [r.valid for r in rows] == [True, False, True]


def test_gaps_and_limiter(spark):
    diffs = spark.createDataFrame([("a", i, f, t) for i, (f, t) in enumerate([(1, 3), (4, 6), (8, 9), (8, 9), (10, 11)])], "symbol string, seq long, first_update_id long, last_update_id long")
    assert [(r.seq, r.expected_u) for r in sequence.gaps(diffs).orderBy("seq").collect()] == [(2, 7), (3, 10)]
    limiter = sequence.Limiter(100, 60)
    assert [limiter.admit(0) for _ in range(101)] == [True] * 100 + [False] and limiter.admit(60)


def test_frame_log_files(spark, tmp_path):
    row = lambda n, tag, p: framelog.ROW.pack(n, ord(tag), len(p)) + p
    z = zstandard.ZstdCompressor().compress
    (tmp_path / "a.zst").write_bytes(z(row(1, "S", b"x") + row(2, "R", b"")) + z(row(3, "X", b"zz")))
    (tmp_path / "b.zst").write_bytes(z(row(1, "S", b"x") + b"\1\2\3"))
    (tmp_path / "c.zst").write_bytes(z(row(1, "S", b"x") + row(2, "S", b"long")[:-2]))
    framelog.register(spark)
    rows = spark.read.format("framelog").load(str(tmp_path)).collect()
    by = lambda f: [(r.seq, r.tag_byte, r.error is None) for r in rows if r.file.endswith(f)]
    assert by("a.zst") == [(0, 83, True), (1, 82, True), (2, 88, True)]
    assert by("b.zst") == [(0, 83, True)]
    assert by("c.zst") == [(0, 83, True), (1, None, False)]


def test_snapshots_of_many_symbols(spark):
    bounds = spark.sql("select timestamp'2024-01-01 00:30:00' as start, timestamp'2024-01-01 02:45:00' as stop")
    rows = schedule.snapshot_times(bounds, spark.range(10_500).select(F.concat(F.lit("s"), "id").alias("symbol")))
    assert rows.count() == 31_500 and rows.distinct().count() == 31_500
    assert schedule.snapshot_times(bounds.limit(0), spark.range(3)).count() == 0


def test_frame_log_commits(spark, tmp_path):
    framelog.register(spark)
    folder = f"file://{tmp_path}/log"
    kind = "symbol string, file_date string, recv_nanos long, tag_byte int, payload binary, seq long"
    row = lambda s, d, n: (s, d, n, 83, b"p", n)
    read = lambda: sorted((r.file.rpartition("/")[2], r.seq, r.recv_nanos) for r in spark.read.format("framelog").load(folder).collect())
    framelog.write_log(spark.createDataFrame([row("a", "20240101", 2), row("a", "20240101", 1), row("b", "20240102", 5)], kind), folder)
    framelog.write_log(spark.createDataFrame([row("a", "20240101", 9)], kind), folder)
    both = [("a_20240101.zst", 0, 1), ("a_20240101.zst", 1, 2), ("a_20240101.zst", 2, 9), ("b_20240102.zst", 0, 5)]
    assert read() == both
    # parts that no manifest names, and drafts, are not there
    part = next((tmp_path / "log").glob("a_20240101.zst.*"))
    (tmp_path / "log" / ("a_20240101.zst." + "0" * 32)).write_bytes(part.read_bytes())
    (tmp_path / "log" / ".a_20240101.zst.draft").write_bytes(b"x")
    (tmp_path / "log" / "_commits" / "0000000009.json.draft").write_bytes(b"{")
    assert read() == both
    # a file of a collector's comes before the parts
    (tmp_path / "log" / "b_20240102.zst").write_bytes(zstandard.ZstdCompressor().compress(framelog.ROW.pack(4, 83, 0)))
    assert read()[3:] == [("b_20240102.zst", 0, 4), ("b_20240102.zst", 1, 5)]
    # overwriting replaces the logs that are written, not others
    framelog.write_log(spark.createDataFrame([row("a", "20240101", 7)], kind), folder, "overwrite")
    assert read() == [("a_20240101.zst", 0, 7), ("b_20240102.zst", 0, 4), ("b_20240102.zst", 1, 5)]
    framelog.write_log(spark.createDataFrame([], kind), folder)
    assert len(read()) == 3


def test_blocks_of_one_key(spark):
    """Results don't depend on where blocks are cut."""
    diffs = spark.createDataFrame([("a", i, 3 * i + (i % 7 == 0), 3 * i + 2) for i in range(60)] + [(None, 5, 1, 2), (None, 6, 9, 9)], "symbol string, seq long, first_update_id long, last_update_id long")
    want = sequence.gaps(diffs).collect()
    assert len(want) == 9 and sorted(map(str, want)) == sorted(map(str, sequence.gaps(diffs, size=4).collect()))
    days = spark.sql("select 'a' as symbol, id as seq, timestamp'2024-01-05 23:00:00' + make_dt_interval(0, id * 7 % 31) as ts from range(50)")
    want = schedule.rotated(days, "/x").collect()
    assert sorted(map(str, want)) == sorted(map(str, schedule.rotated(days, "/x", size=3).collect()))
    seen, last = {r.seq: r for r in want}, ""
    for i in range(50):
        assert seen[i].file_date == max(last, seen[i].ts.strftime("%Y%m%d"))
        last = seen[i].file_date
    events = spark.sql("select 1 as k, timestamp'2024-01-01 00:00:00' + make_dt_interval(0, id * id, 0) as t from range(10)")
    by = lambda b: sorted((r.session, str(r.start), str(r.stop), r.n) for r in schedule.idle_sessions(events, "k", "t", 8 * 3600, size=b).collect())
    assert by(1) == by(3) == by(4) == by(None) and [x[3] for x in by(3)] == [5, 1, 1, 1, 1, 1]


def test_idle_timeouts(spark):
    s = 1_000_000
    rows = [(1, 0, "Binary"), (1, 65 * s, "Pong"), (1, 200 * s, "Binary"), (2, 0, "Pong"), (2, 5 * s, "Ping"), (2, 65 * s, "Text"), (2, 70 * s, "Close"), (3, 1 * s, "Text"), (3, 61 * s, "Binary")]
    got = schedule.idle_timeouts(spark.createDataFrame(rows, "c int, at long, opcode string"), "c", "at", "opcode").collect()
    # looked at each 10 s from the start, over 60 s; a pong is no activity; at exactly 60 s nothing happens; the close ends 2
    assert sorted(map(tuple, got)) == [(1, 0, 70 * s), (3, 61 * s, 131 * s)]


def test_many_symbols(spark):
    payloads = [depth([], symbol=b"S7"), depth([], symbol=b"s1999"), depth([], symbol=b"zz"), b"", b"\2s7"]
    rows = symbols.with_symbol(frames(spark, payloads), [f"s{i}" for i in range(2000)]).orderBy("seq").collect()
    assert [r.symbol for r in rows] == ["s7", "s1999", "unknown", "unknown", "s7"]
    # of two that fit, the first subscribed
    both = frames(spark, [b"\4\1ab" + b"c", b"\3abc", b"\4\3abc"])
    assert [r.symbol for r in symbols.with_symbol(both, ["\3abc", "ABC", "nothing"]).orderBy("seq").collect()] == ["unknown", "abc", "\3abc"]
    assert [r.symbol for r in symbols.with_symbol(both, []).collect()] == ["unknown"] * 3


def test_blocks_shuffle_rows_once(spark):
    """With broadcasts off, the rows are shuffled by key and block alone; the other shuffles are of ends, of a row a block, or of pieces of sessions."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    rows = spark.range(0, 20_000, 1, 4).selectExpr("concat('s', id % 3) as symbol", "id as seq", "id as first_update_id", "id as last_update_id", "timestamp_micros(id * 1000000) as ts")
    try:
        for k, v in zip(held, ("-1", "false"), strict=True):
            spark.conf.set(k, v)
        for out, joins, most in ((sequence.gaps(rows, size=2000), 0, 2), (schedule.rotated(rows, "/x", size=2000), 1, 4), (schedule.idle_sessions(rows, "symbol", "ts", size=2000), 1, 4)):
            plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
            shuffles = [k for k, x in enumerate(plan) if "- Exchange " in x]
            of_rows = [k for k in shuffles if "Range" in " ".join(plan[k + 1 : k + 4]) and "HashAggregate" not in plan[k + 1]]
            assert len(of_rows) == 1 and len(shuffles) <= most and sum("SortMergeJoin" in x for x in plan) == joins, "\n".join(plan)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_blocks_follow_rows_not_values(spark):
    """Orders of any density make blocks of about as many rows; nulls come first, and equal numbers stay together."""
    from tickweave.operators.blocks import in_blocks

    rows = spark.range(10_000).selectExpr("case when id % 100 = 0 then null when id < 9000 then id else id * 1000000000000 end as n")
    blocks = in_blocks(rows, "n", F.col("n"), 1000).groupBy("_block").agg(F.count("*").alias("n"), F.min("n").alias("low"), F.max("n").alias("high")).orderBy("_block").collect()
    assert len(blocks) >= 9 and max(b.n for b in blocks) < 1300
    assert all(a.high < b.low for a, b in zip(blocks, blocks[1:]))
    same = in_blocks(spark.range(5000).selectExpr("id div 4000 as n"), "n", F.col("n"), 100)
    assert same.select("_block", "n").distinct().count() == 2
    assert in_blocks(rows.limit(0), "n", F.col("n"), 5).count() == 0


def test_admission_is_cut_at_silences(spark):
    """Keys with and without silences, ties, nulls and repeated calls: the same as one deque a key, by many tasks for one key."""
    import random

    rnd = random.Random(8)
    rows = [("dense", k // 3, k) for k in range(400)] + [(rnd.choice(["a", None]), rnd.randint(0, 5000), k) for k in range(600)] + [("edge", 10 * k, k) for k in range(50)] + [("a", None, 7), (None, None, 8)]
    calls = spark.createDataFrame(rows, "key string, at long, n int")

    def want(limit, window):
        out, limiters = [], {}
        for key, at, n in sorted(rows, key=lambda r: (r[0] or "", r[1] is not None, r[1] or 0, r[2])):
            limiter = limiters.setdefault(key, sequence.Limiter(limit, window))
            out.append((key, at, n, at is not None and limiter.admit(at)))
        return sorted(map(str, out))

    for limit, window in ((1, 10), (2, 9), (3, 40), (5, 11)):
        for size in (None, 50, 7):
            got = sequence.admit(calls, "key", "at", limit, window, "n", size=size)
            assert sorted(str(tuple(r)) for r in got.collect()) == want(limit, window), (limit, window, size)
    held = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        one = spark.range(0, 4000).selectExpr("'k' as key", "(id div 10) * 1000 + id % 10 as at")
        parts = sequence.admit(one, "key", "at", 3, 100, size=500).rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", held)
    assert sum(n > 0 for n in parts) == 8 and max(parts) < 1000


def test_layouts_of_odd_messages(spark):
    """Blocks, groups and data that don't fit are named; newer senders' further fields are skipped; unsigned and text fields keep their values."""
    from tickweave.operators import layouts
    from tickweave.plans.registry import ORDER_SCHEMA

    t = layouts.parse_schema(ORDER_SCHEMA)["order"]
    block = struct.pack("<QbqI", 2**64 - 1, -2, -5, 0)[:17] + b"ab\0c"
    head = lambda n, v: struct.pack("<HHHH", n, 20001, 1, v)
    lines = struct.pack("<HH", 5, 2) + struct.pack("<BiBi", 1, -7, 2, 9)
    whole = head(21, 0) + block + lines + b"\x02hi"
    newer = head(30, 2) + block + struct.pack("<I", 77) + b"xxxxx" + struct.pack("<HH", 8, 1) + struct.pack("<BiB2s", 3, 4, 1, b"zz") + b"\0"
    odd = [whole, newer, whole[:-1], head(21, 0) + block + lines[:-1], head(21, 0) + block[:-1], head(20, 0) + block, head(21, 1) + block + lines + b"\0", whole[:8], head(21, 0) + block + struct.pack("<HH", 0, 3) + b"\0", head(21, 0) + block + struct.pack("<HH", 0, 0) + b"\0", whole[:7], None, head(21, 0)[:2] + b"\0\0" + whole[4:]]
    rows = layouts.decode(frames(spark, odd), t).orderBy("seq").collect()
    assert [(r.seq, r.decode_error) for r in rows] == [(0, None), (1, None), (2, "priority cut short"), (3, "lines cut short"), (4, "block too short"), (5, "block too short"), (6, "block too short"), (7, "block too short"), (8, "lines cut short"), (9, None)]
    assert (int(rows[0].key), rows[0].total, rows[0].code, rows[0].venue, rows[0].customer, rows[0].priority) == (2**64 - 1, -5, "ab", "main", None, "hi")
    assert [tuple(x) for x in rows[0].lines] == [(1, -7, None), (2, 9, None)] and [tuple(x) for x in rows[1].lines] == [(3, 4, 1)] and rows[1].customer == 77
    assert [len(rows[2].lines), rows[3].lines, rows[4].key, rows[9].lines] == [2, None, None, []]
    text = [r.line for r in layouts.printed(frames(spark, odd[:4]), t, "{key} {total*exponent} {customer} {#lines}", {"lines": "  {qty*exponent}"}).orderBy("seq").collect()]
    assert text == [f"{2**64 - 1} -0.050000 - 2\n  -0.070000\n  0.090000", f"{2**64 - 1} -0.050000 77 1\n  0.040000", "order: priority cut short", "order: lines cut short"]
    import pytest

    with pytest.raises(ValueError, match="isn't in the layout"):
        layouts.printed(frames(spark, odd[:1]), t, "", {"lines": "{price}"})
    with pytest.raises(ValueError, match="not supported"):
        layouts.parse_schema('<s><message name="m" id="1"><field name="x" id="1" type="strange"/></message></s>')
    assert layouts.decode(spark.createDataFrame([], "seq long, payload binary"), t).count() == 0
