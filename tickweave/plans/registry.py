"""Named queries over the driver's tables, with DuckDB SQL that gives the same rows.

The tables are encoded into messages first, and each query works on the bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.functions.binary import hex_le, scaled, scaled_exact, var_string
from tickweave.operators import layouts, printed, rest, sbe, schedule, sequence, symbols
from tickweave.operators.blocks import numbered
from tickweave.plans.session import fresh_path, saved, table
from tickweave.sources import framelog
from tickweave.streaming import stateful

SUBSCRIBED = ["CLICK", "View", "purchase"]
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


#: What the queries read: messages made of the tables, written once for an application and folder.
FRAMES: dict = {}
_HELD: dict = {}


def _changed(spark, d: str) -> int:
    """When a table in the folder was last written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(d)
    return max((s.getModificationTime() for s in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)), default=0)


def frames(make):
    """A builder of messages, which runs once for an application, a folder as it was last written, and its further arguments."""

    def held(spark, d, *args) -> DataFrame:
        key = (spark.sparkContext.applicationId, d, _changed(spark, d), make.__name__, *args)
        if key not in _HELD:
            _HELD[key] = make(spark, d, *args)
        return _HELD[key]

    FRAMES[make.__name__] = held
    return held


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def _lines(spark, d) -> DataFrame:
    """lineitem with integer prices and quantities."""
    n = lambda c, k: F.round(F.col(c) * k).cast("bigint")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", n("l_extendedprice", 100).alias("price"), n("l_quantity", 1).alias("qty"), (F.col("l_returnflag") == "R").cast("int").alias("maker"), "l_linestatus", "l_partkey", "l_suppkey")


@frames
def trade_frames(spark, d) -> DataFrame:
    """One trades message for each order, entries in a full order."""
    entry = F.struct(F.col("l_linenumber").cast("bigint").alias("id"), "price", "qty", F.col("maker").alias("is_buyer_maker"))
    rows = _lines(spark, d).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    exp = {"price_exp": F.lit(-2), "qty_exp": F.lit(0)}
    symbol = F.concat(F.lit("SYM"), (F.col("l_orderkey") % 5).cast("string"))
    return saved(rows.select(F.col("l_orderkey").alias("seq"), sbe.encode(sbe.TRADES, {"event_time_us": F.col("l_orderkey"), "transact_time_us": -F.col("l_orderkey"), **exp}, {"trades": F.col("e")}, symbol).alias("payload")), "frames")


@frames
def depth_frames(spark, d, t: sbe.Template) -> DataFrame:
    level = F.struct("price", "qty")
    side = lambda s: F.array_sort(F.collect_list(F.when(F.col("l_linestatus") == s, level)))
    rows = _lines(spark, d).groupBy("l_orderkey").agg(side("O").alias("b"), side("F").alias("a"))
    k = F.col("l_orderkey")
    values = {"event_time_us": k * 1000, "book_update_id": k, "first_update_id": k, "last_update_id": k + 1, "price_exp": F.lit(-2), "qty_exp": F.lit(0)}
    return saved(rows.select(k.alias("seq"), sbe.encode(t, values, {"bids": F.col("b"), "asks": F.col("a")}, F.lit("book")).alias("payload")), "frames")


@frames
def best_frames(spark, d) -> DataFrame:
    v = F.round(F.col("value") * 100).cast("bigint")
    values = {"event_time_us": F.unix_micros(F.col("ts").cast("timestamp")), "book_update_id": F.col("event_id"), "price_exp": F.lit(-2), "qty_exp": F.lit(0), "bid_price": v, "bid_qty": F.col("user_id"), "ask_price": v + 1, "ask_qty": -F.col("user_id")}
    return saved(table(spark, d, "events").select(F.col("event_id").alias("seq"), "event_type", sbe.encode(sbe.BEST, values, symbol=F.col("event_type")).alias("payload")), "frames")


_SQL_LINES = "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS id, CAST(round(l_extendedprice * 100) AS BIGINT) AS price, CAST(round(l_quantity) AS BIGINT) AS qty, CAST(l_returnflag = 'R' AS INT) AS is_buyer_maker, l_linestatus FROM lineitem"


@query("trades_by_symbol", f"SELECT 'SYM' || (l_orderkey % 5) AS symbol, count(*) AS n_trades, CAST(sum(price * qty) AS BIGINT) AS notional FROM ({_SQL_LINES}) GROUP BY 1")
def trades_by_symbol(spark, d):
    frames = trade_frames(spark, d).withColumn("symbol", symbols.match_heuristic(F.col("payload")))
    t = sbe.decode(frames, sbe.TRADES, only=("trades",)).select("symbol", F.explode("trades").alias("t"))
    return t.groupBy("symbol").agg(F.count("*").alias("n_trades"), F.sum(F.col("t.price") * F.col("t.qty")).alias("notional"))


@query("trades_decode", f"SELECT l_orderkey AS seq, l_orderkey AS event_time_us, -l_orderkey AS transact_time_us, -2 AS price_exp, id, price, qty, is_buyer_maker, count(*) OVER (PARTITION BY l_orderkey) AS declared FROM ({_SQL_LINES})")
def trades_decode(spark, d):
    t = sbe.decode(trade_frames(spark, d), sbe.TRADES)
    return t.select("seq", "event_time_us", "transact_time_us", "price_exp", F.col("declared_trades").alias("declared"), F.explode("trades").alias("t")).select("*", "t.*").drop("t")


@query("trades_first5", f"SELECT l_orderkey AS seq, n > 5 AS has_more, CAST(pos - 1 AS INT) AS pos, price, qty FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY id, price, qty, is_buyer_maker) AS pos, count(*) OVER (PARTITION BY l_orderkey) AS n FROM ({_SQL_LINES})) WHERE pos <= 5")
def trades_first5(spark, d):
    return sbe.first_n(sbe.decode(trade_frames(spark, d), sbe.TRADES).select("seq", "declared_trades", "trades"), "trades").select("seq", "has_more", "pos", "entry.price", "entry.qty")


@query("bba_decode", "SELECT event_id AS seq, epoch_us(ts) AS event_time_us, event_id AS book_update_id, -2 AS price_exp, 0 AS qty_exp, CAST(round(value * 100) AS BIGINT) AS bid_price, user_id AS bid_qty, CAST(round(value * 100) AS BIGINT) + 1 AS ask_price, -user_id AS ask_qty FROM events")
def bba_decode(spark, d):
    return sbe.decode(best_frames(spark, d).drop("event_type"), sbe.BEST).drop("decode_error")


def _depth(ids: str) -> str:
    return f"SELECT l_orderkey AS seq, l_orderkey * 1000 AS event_time_us, {ids}, CASE WHEN l_linestatus = 'O' THEN 'bid' ELSE 'ask' END AS side, price, qty, count(*) OVER (PARTITION BY l_orderkey, l_linestatus) AS declared FROM ({_SQL_LINES})"


def _sides(rows: DataFrame, ids: list[str]) -> DataFrame:
    one = lambda g, s: rows.select("seq", "event_time_us", *ids, F.lit(s).alias("side"), F.col(f"declared_{g}").alias("declared"), F.explode(g).alias("e"))
    return one("bids", "bid").unionByName(one("asks", "ask")).select("*", "e.price", "e.qty").drop("e")


@query("depth_snapshot_decode", _depth("l_orderkey AS book_update_id"))
def depth_snapshot_decode(spark, d):
    return _sides(sbe.decode(depth_frames(spark, d, sbe.SNAPSHOT), sbe.SNAPSHOT), ["book_update_id"])


@query("depth_diff_decode", _depth("l_orderkey AS first_update_id, l_orderkey + 1 AS last_update_id"))
def depth_diff_decode(spark, d):
    return _sides(sbe.decode(depth_frames(spark, d, sbe.DIFF), sbe.DIFF), ["first_update_id", "last_update_id"])


@query("fixed_point_scale", "SELECT o_orderkey, m * power(10.0::DOUBLE, -2::DOUBLE) AS price, (m // 100)::VARCHAR || '.' || lpad((m % 100)::VARCHAR, 2, '0') || repeat('0', 16) AS exact FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS m FROM orders)")
def fixed_point_scale(spark, d):
    m, e = F.round(F.col("o_totalprice") * 100).cast("bigint"), F.lit(-2)
    return table(spark, d, "orders").select("o_orderkey", scaled(m, e).alias("price"), scaled_exact(m, e).cast("string").alias("exact"))


@query("fixed_point_exponents", "SELECT o_orderkey, m * (1.0::DOUBLE / power(10.0::DOUBLE, CAST(o_orderkey % 9 AS DOUBLE))) AS price FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) * CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END AS m FROM orders)")
def fixed_point_exponents(spark, d):
    m = F.round(F.col("o_totalprice") * 100).cast("bigint") * F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(-1)
    return table(spark, d, "orders").select("o_orderkey", scaled(m, -(F.col("o_orderkey") % 9)).alias("price"))


@query("var_string", "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS text FROM customer")
def var_string_decode(spark, d):
    full = F.unhex(F.concat(F.lit("ABCD"), hex_le(F.octet_length("c_name"), 1), F.hex(F.col("c_name").cast("binary"))))
    cut = F.when(F.col("c_custkey") % 5 == 0, F.substring(full, F.lit(1), F.length(full) - 1)).otherwise(full)
    return table(spark, d, "customer").select("c_custkey", var_string(cut, F.lit(2)).alias("text"))


@query("launch_symbols", "SELECT n_nationkey, lower(n_name) || 'usdt' AS symbol, CASE WHEN n_nationkey % 3 = 0 THEN n_name ELSE 'exch' || n_regionkey END AS exchange, CASE WHEN n_nationkey % 3 = 0 THEN n_name ELSE 'a:' || n_name END AS path, 'http://host/api/v3/depth?symbol=' || upper(n_name) || 'USDT&limit=5000' AS request FROM nation")
def launch_symbols(spark, d):
    mapping = F.when(F.col("n_nationkey") % 3 == 0, F.col("n_name")).otherwise(F.concat(F.lit("exch"), F.col("n_regionkey").cast("string"), F.lit(":a:"), "n_name"))
    exchange, path = schedule.mapping_parts(mapping)
    symbol = schedule.coin_symbol(F.lower("n_name"))
    return table(spark, d, "nation").select("n_nationkey", symbol.alias("symbol"), exchange.alias("exchange"), path.alias("path"), schedule.snapshot_url("http://host", symbol).alias("request"))


@query("header_dispatch", "SELECT CASE WHEN event_id % 50 = 0 THEN 'short' ELSE coalesce(list_extract(['trades', 'best_bid_ask', 'depth_snapshot', 'depth_diff'], CAST(event_id % 5 + 1 AS INT)), 'other') END AS kind, count(*) AS n FROM events GROUP BY 1")
def header_dispatch(spark, d):
    e = table(spark, d, "events")
    head = F.concat(hex_le(F.lit(0), 2), hex_le(F.col("event_id") % 5 + 10000, 2), hex_le(F.lit(1), 2), hex_le(F.lit(0), 2))
    data = F.unhex(F.when(F.col("event_id") % 50 == 0, F.substring(head, 1, 14)).otherwise(head))
    return e.select(data.alias("payload")).groupBy(sbe.kind(F.col("payload")).alias("kind")).agg(F.count("*").alias("n"))


@query("symbol_exact", "SELECT event_id AS seq, CASE WHEN lower(event_type) IN ('click', 'view', 'purchase') THEN lower(event_type) ELSE 'unknown' END AS symbol FROM events")
def symbol_exact(spark, d):
    return symbols.with_symbol(best_frames(spark, d), SUBSCRIBED).select("seq", "symbol")


@query("symbol_heuristic", "SELECT event_id AS seq, event_type AS symbol FROM events")
def symbol_heuristic(spark, d):
    return best_frames(spark, d).select("seq", symbols.match_heuristic(F.col("payload")).alias("symbol"))


@query("symbol_unknown", "SELECT lower(event_type) NOT IN ('click', 'view', 'purchase') AS unknown, count(*) AS n FROM events GROUP BY 1")
def symbol_unknown(spark, d):
    return symbols.route(best_frames(spark, d), SUBSCRIBED).groupBy((F.col("symbol") == "unknown").alias("unknown")).agg(F.count("*").alias("n"))


@query("frame_validity", "SELECT coalesce(CASE WHEN o_orderkey % 50 < 5 THEN 'format' WHEN o_orderkey % 50 < 9 THEN 'sbe' END, 'good') AS class, count(*) AS n FROM (SELECT o_orderkey FROM orders) GROUP BY 1")
def frame_validity(spark, d):
    values = {"event_time_us": F.col("o_orderkey"), "first_update_id": F.col("o_orderkey"), "last_update_id": F.col("o_orderkey"), "price_exp": F.lit(0), "qty_exp": F.lit(0)}
    none = F.array().cast("array<struct<price:bigint,qty:bigint>>")
    full = sbe.encode(sbe.DIFF, values, {"bids": none, "asks": none}, F.lit("click"))
    r = F.col("o_orderkey") % 50
    tail = F.unhex(F.concat(F.lit("05"), F.hex(F.lit("click").cast("binary"))))
    cut = F.when(r < 5, F.substring(full, 1, 7)).when(r < 9, F.concat(F.substring(full, 1, 20), tail)).otherwise(full)
    rows = symbols.route(table(spark, d, "orders").select(cut.alias("payload")), SUBSCRIBED)
    return rows.groupBy(F.coalesce("error_class", F.lit("good")).alias("class")).agg(F.count("*").alias("n"))


@frames
def rest_frames(spark, d) -> DataFrame:
    side = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("l_linestatus") == s, F.struct("l_linenumber", "price", "qty")))), lambda x: F.array(x["price"].cast("string"), x["qty"].cast("string")))
    rows = _lines(spark, d).groupBy("l_orderkey").agg(side("O").alias("bids"), side("F").alias("asks"))
    body = F.to_json(F.struct(F.col("l_orderkey").alias("lastUpdateId"), "bids", "asks"))
    return saved(rows.select(F.col("l_orderkey").alias("seq"), F.when(F.col("l_orderkey") % 10 == 0, F.lit('{"code": -1003, "msg": "limit"}')).when(F.col("l_orderkey") % 10 == 1, F.lit("<html>")).otherwise(body).cast("binary").alias("payload")), "frames")


@query("rest_decode", f"SELECT l_orderkey AS seq, l_orderkey % 10 <> 1 AS valid, CASE WHEN l_orderkey % 10 > 1 THEN l_orderkey ELSE 0 END AS last_update_id, CAST(CASE WHEN l_orderkey % 10 > 1 THEN count(*) FILTER (l_linestatus = 'O') ELSE 0 END AS INT) AS n_bids, CAST(CASE WHEN l_orderkey % 10 > 1 THEN count(*) FILTER (l_linestatus = 'F') ELSE 0 END AS INT) AS n_asks FROM ({_SQL_LINES}) GROUP BY l_orderkey")
def rest_decode(spark, d):
    return rest.decode_rest(rest_frames(spark, d)).select("seq", "valid", F.col("last_update_id").cast("bigint").alias("last_update_id"), "n_bids", "n_asks")


@query("rest_first5", f"SELECT l_orderkey AS seq, CAST(pos - 1 AS INT) AS pos, price::VARCHAR AS price, qty::VARCHAR AS qty FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY id, price, qty) AS pos FROM ({_SQL_LINES}) WHERE l_linestatus = 'O' AND l_orderkey % 10 > 1) WHERE pos <= 5")
def rest_first5(spark, d):
    return rest.decode_rest(rest_frames(spark, d), first=5).select("seq", F.posexplode("bids").alias("pos", "x")).select("seq", "pos", F.col("x")[0].alias("price"), F.col("x")[1].alias("qty"))


@query("rest_levels", f"SELECT l_orderkey AS seq, CASE WHEN l_linestatus = 'O' THEN 'bid' ELSE 'ask' END AS side, CAST(row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY id, price, qty) - 1 AS INT) AS pos, price::VARCHAR AS price, qty::VARCHAR AS qty FROM ({_SQL_LINES}) WHERE l_orderkey % 10 > 1")
def rest_levels(spark, d):
    sides = F.array(F.struct(F.lit("bid").alias("side"), F.col("bids").alias("levels")), F.struct(F.lit("ask").alias("side"), F.col("asks").alias("levels")))
    rows = rest.decode_rest(rest_frames(spark, d)).select("seq", F.inline(sides)).select("seq", "side", F.posexplode("levels").alias("pos", "x"))
    return rows.select("seq", "side", "pos", F.col("x")[0].alias("price"), F.col("x")[1].alias("qty"))


@frames
def diff_frames(spark, d) -> DataFrame:
    """A run of updates for each event type, with a message in 97 missing."""
    rows = numbered(table(spark, d, "events").select("event_type", "event_id"), "event_type", "event_id", F.col("event_id"), "rn")
    rows = rows.withColumn("rn", F.col("rn") + 1).filter("event_id % 97 <> 0")
    none = F.array().cast("array<struct<price:bigint,qty:bigint>>")
    values = {"event_time_us": F.col("event_id"), "first_update_id": 3 * F.col("rn") - 2, "last_update_id": 3 * F.col("rn"), "price_exp": F.lit(0), "qty_exp": F.lit(0)}
    return saved(rows.select(F.col("event_id").alias("seq"), sbe.encode(sbe.DIFF, values, {"bids": none, "asks": none}, F.col("event_type")).alias("payload")), "frames")


_SQL_DIFFS = "SELECT event_type AS symbol, event_id AS seq, 3 * rn - 2 AS first_u, 3 * rn AS last_u FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events) WHERE event_id % 97 <> 0"


def decoded_diffs(spark, d) -> DataFrame:
    return sbe.decode(diff_frames(spark, d).withColumn("symbol", symbols.match_heuristic(F.col("payload"))), sbe.DIFF, only=("first_update_id", "last_update_id"))


@query("gap_detect", f"SELECT symbol, seq, first_u, prev_u, prev_u + 1 AS expected_u FROM (SELECT *, lag(last_u) OVER (PARTITION BY symbol ORDER BY seq) AS prev_u FROM ({_SQL_DIFFS})) WHERE first_u <> prev_u + 1")
def gap_detect(spark, d):
    return sequence.gaps(decoded_diffs(spark, d))


@query("gap_recovery", f"""
WITH RECURSIVE g AS (SELECT lower(symbol) AS symbol, seq * 1000 AS due FROM (SELECT *, lag(last_u) OVER (PARTITION BY symbol ORDER BY seq) AS prev_u FROM ({_SQL_DIFFS})) WHERE first_u <> prev_u + 1),
c AS (SELECT *, row_number() OVER (ORDER BY due, symbol) AS rn FROM g),
s AS (SELECT symbol, due, rn, TRUE AS admitted, CAST(NULL AS BIGINT) AS a, due AS b FROM c WHERE rn = 1
  UNION ALL
  SELECT c.symbol, c.due, c.rn, coalesce(s.a <= c.due - 400000, TRUE), CASE WHEN coalesce(s.a <= c.due - 400000, TRUE) THEN s.b ELSE s.a END, CASE WHEN coalesce(s.a <= c.due - 400000, TRUE) THEN c.due ELSE s.b END
  FROM s JOIN c ON c.rn = s.rn + 1)
SELECT due + 5 AS recv_nanos, symbol, 82 AS tag_byte, upper(symbol) AS body FROM s WHERE admitted AND symbol <> 'view'""")
def gap_recovery(spark, d):
    """Gaps ask for snapshots under one limiter (2 calls in 400 microseconds); those of one symbol fail."""

    def fetch(symbol):
        if symbol == "VIEW":
            raise OSError("no answer")
        return symbol.encode()

    found = sequence.gaps(decoded_diffs(spark, d)).select("symbol", (F.col("seq") * 1000).alias("at"))
    rows = stateful.recover(found, None, fetch, lambda t: t + 5, 2, 400_000)
    return rows.select("recv_nanos", "symbol", "tag_byte", F.col("payload").cast("string").alias("body"))


@query("last_update_id", f"SELECT symbol, arg_max(last_u, seq) AS last_update_id FROM ({_SQL_DIFFS}) GROUP BY 1")
def last_update_id(spark, d):
    return sequence.last_ids(decoded_diffs(spark, d))


@query("throttle_admit", """
WITH RECURSIVE c AS (SELECT user_id, event_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
s AS (SELECT user_id, event_id, t, rn, TRUE AS admitted, CAST(NULL AS BIGINT) AS a, t AS b FROM c WHERE rn = 1
  UNION ALL
  SELECT c.user_id, c.event_id, c.t, c.rn, coalesce(s.a <= c.t - 21600000000, TRUE), CASE WHEN coalesce(s.a <= c.t - 21600000000, TRUE) THEN s.b ELSE s.a END, CASE WHEN coalesce(s.a <= c.t - 21600000000, TRUE) THEN c.t ELSE s.b END
  FROM s JOIN c ON c.user_id = s.user_id AND c.rn = s.rn + 1)
SELECT user_id, event_id, t, admitted FROM s""")
def throttle_admit(spark, d):
    calls = table(spark, d, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return sequence.admit(calls, "user_id", "t", 2, 21_600_000_000, "event_id")


@query("rotation_files", "SELECT symbol, seq, '/log/' || symbol || '_' || strftime(max(CAST(ts AS DATE)) OVER (PARTITION BY symbol ORDER BY seq ROWS UNBOUNDED PRECEDING), '%Y%m%d') || '.zst' AS file FROM (SELECT event_type AS symbol, event_id + CASE WHEN event_id % 10 = 0 THEN 500 ELSE 0 END AS s0, event_id, ts, (event_id + CASE WHEN event_id % 10 = 0 THEN 500 ELSE 0 END) * 100000 + event_id AS seq FROM events)")
def rotation_files(spark, d):
    late = F.col("event_id") + F.when(F.col("event_id") % 10 == 0, 500).otherwise(0)
    rows = table(spark, d, "events").select(F.col("event_type").alias("symbol"), "ts", (late * 100000 + F.col("event_id")).alias("seq"))
    return schedule.rotated(rows, "/log").select("symbol", "seq", "file")


def _records(spark, d) -> DataFrame:
    """Rows to be logged: of three tags, a log a symbol."""
    rows = best_frames(spark, d).withColumn("symbol", symbols.match_heuristic(F.col("payload")))
    return rows.select("symbol", F.lit("20240101").alias("file_date"), "seq", (F.col("seq") * 1000 + 7).alias("recv_nanos"), F.when(F.col("seq") % 10 == 0, 82).when(F.col("seq") % 10 == 1, 88).otherwise(83).alias("tag_byte"), "payload")


@frames
def written_log(spark, d) -> str:
    path = fresh_path(spark, "framelog")
    framelog.write_log(_records(spark, d), path)
    return path


def _written(spark, d) -> DataFrame:
    framelog.register(spark)
    return spark.read.format("framelog").load(written_log(spark, d))


@query("framelog_roundtrip", "SELECT event_type AS symbol, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS seq, event_id * 1000 + 7 AS recv_nanos, CASE event_id % 10 WHEN 0 THEN 82 WHEN 1 THEN 88 ELSE 83 END AS tag_byte, event_id AS book_update_id FROM events")
def framelog_roundtrip(spark, d):
    """The log is written and read back."""
    path = fresh_path(spark, "framelog")
    framelog.write_log(_records(spark, d), path)
    rows = spark.read.format("framelog").load(path)
    return sbe.decode(rows.withColumn("symbol", symbols.match_heuristic(F.col("payload"))), sbe.BEST, only=("book_update_id",)).select("symbol", "seq", "recv_nanos", "tag_byte", "book_update_id")


@query("file_counts", "SELECT event_type || '_20240101.zst' AS file, count(*) AS total, count(*) FILTER (event_id % 10 > 1) AS sbe, count(*) FILTER (event_id % 10 = 0) AS rest FROM events GROUP BY 1")
def file_counts(spark, d):
    return schedule.file_counts(_written(spark, d)).withColumn("file", F.element_at(F.split("file", "/"), -1))


@query("tag_filter", "SELECT event_type AS symbol, event_id * 1000 + 7 AS recv_nanos FROM events WHERE event_id % 10 = 0 AND event_id >= 1000")
def tag_filter(spark, d):
    rows = _written(spark, d).filter((F.col("tag_byte") == 82) & (F.col("recv_nanos") >= 1_000_000) & F.col("error").isNull())
    return rows.select(symbols.match_heuristic(F.col("payload")).alias("symbol"), "recv_nanos")


_SQL_LOGGED = "event_id * 1000 + 7 AS recv_nanos, CASE event_id % 10 WHEN 0 THEN 82 WHEN 1 THEN 88 ELSE 83 END AS tag_byte FROM events"


@query("log_commits", f"SELECT event_type AS symbol, row_number() OVER (PARTITION BY event_type ORDER BY event_id % 3, event_id) - 1 AS seq, {_SQL_LOGGED}")
def log_commits(spark, d):
    """Three commits to the same logs, one behind the other."""
    rows, path = _records(spark, d), fresh_path(spark, "commits")
    for k in range(3):
        framelog.write_log(rows.filter(F.col("seq") % 3 == k), path)
    out = spark.read.format("framelog").load(path)
    return out.select(symbols.match_heuristic(F.col("payload")).alias("symbol"), "seq", "recv_nanos", "tag_byte")


@query("log_stream", f"SELECT event_type AS symbol, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS seq, {_SQL_LOGGED}")
def log_stream(spark, d):
    """The log replayed as a stream into another log, each batch a commit, and that read back."""
    framelog.register(spark)
    path, symbol = fresh_path(spark, "streamed"), F.regexp_extract("file", r"([^/]+)_\d{8}\.zst$", 1)
    stream = spark.readStream.format("framelog").option("offsets", fresh_path(spark, "offsets")).load(written_log(spark, d))
    rows = stream.select(symbol.alias("symbol"), F.lit("20240101").alias("file_date"), "recv_nanos", "tag_byte", "payload")
    rows.writeStream.format("framelog").option("path", path).option("checkpointLocation", fresh_path(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    out = spark.read.format("framelog").load(path)
    return out.select(symbols.match_heuristic(F.col("payload")).alias("symbol"), "seq", "recv_nanos", "tag_byte")


@query("log_compacted", f"SELECT event_type AS symbol, row_number() OVER (PARTITION BY event_type ORDER BY event_id % 3, event_id) - 1 AS seq, {_SQL_LOGGED}")
def log_compacted(spark, d):
    """Three commits, their parts made one a log, and that read by many tasks, a few zstd frames each."""
    rows, path = _records(spark, d), fresh_path(spark, "compacted")
    for k in range(3):
        framelog.write_log(rows.filter(F.col("seq") % 3 == k), path, frameBytes="16384")
    framelog.compact(spark, path)
    out = spark.read.format("framelog").option("splitBytes", "32768").load(path)
    return out.select(symbols.match_heuristic(F.col("payload")).alias("symbol"), "seq", "recv_nanos", "tag_byte")


@query("log_days", "SELECT event_type || '_' || strftime(ts, '%Y%m%d') || '.zst' AS file, event_id FROM events WHERE ts >= (SELECT CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) - INTERVAL 2 DAY FROM events)")
def log_days(spark, d):
    """A log a symbol and day; only parts, and frames of them, that may hold the last days' rows are opened."""
    at = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    rows = table(spark, d, "events").select(F.col("event_type").alias("symbol"), F.date_format("ts", "yyyyMMdd").alias("file_date"), F.col("event_id").alias("seq"), at.alias("recv_nanos"), F.lit(83).alias("tag_byte"), F.col("event_id").cast("string").cast("binary").alias("payload"))
    path, last = fresh_path(spark, "days"), rows.agg(F.max("recv_nanos")).first()[0] or 0
    framelog.write_log(rows, path)
    out = spark.read.format("framelog").load(path).filter(F.col("recv_nanos") >= last // 86_400_000_000_000 * 86_400_000_000_000 - 2 * 86_400_000_000_000)
    return out.select(F.element_at(F.split("file", "/"), -1).alias("file"), F.col("payload").cast("string").cast("long").alias("event_id"))


@frames
def update_log(spark, d) -> str:
    """The updates as a log a symbol."""
    rows = diff_frames(spark, d).withColumn("symbol", symbols.match_heuristic(F.col("payload")))
    path = fresh_path(spark, "updates")
    framelog.write_log(rows.select("symbol", F.lit("20240101").alias("file_date"), "seq", F.col("seq").alias("recv_nanos"), F.lit(83).alias("tag_byte"), "payload"), path)
    return path


def _streamed_gaps(spark, d) -> DataFrame:
    """Gaps of the replayed log, as a stream: seq is the place in the symbol's log."""
    framelog.register(spark)
    rows = spark.readStream.format("framelog").option("offsets", fresh_path(spark, "offsets")).load(update_log(spark, d))
    rows = sbe.decode(rows.select("seq", "payload").withColumn("symbol", symbols.match_heuristic(F.col("payload"))), sbe.DIFF, only=("first_update_id", "last_update_id"))
    return stateful.stream_gaps(rows, reorder=1 << 14, consecutive=True)


_SQL_LOGGED_GAPS = f"SELECT symbol, seq, first_u, prev_u, prev_u + 1 AS expected_u FROM (SELECT *, lag(last_u) OVER (PARTITION BY symbol ORDER BY seq) AS prev_u FROM (SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY seq) - 1 AS seq, first_u, last_u FROM ({_SQL_DIFFS}))) WHERE first_u <> prev_u + 1"


@query("gap_stream", _SQL_LOGGED_GAPS)
def gap_stream(spark, d):
    """From a replayed log through the state store to files."""
    path, gaps = fresh_path(spark, "gaps"), _streamed_gaps(spark, d)
    gaps.writeStream.format("parquet").option("path", path).option("checkpointLocation", fresh_path(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(gaps.schema).parquet(path).select("symbol", "seq", F.col("first_u"), "prev_u", "expected_u")


@query("recovery_stream", f"SELECT 7000 AS recv_nanos, lower(symbol) AS symbol, 82 AS tag_byte, upper(symbol) AS body FROM (SELECT * FROM ({_SQL_LOGGED_GAPS}) ORDER BY seq, lower(symbol) LIMIT 40) WHERE lower(symbol) <> 'view'")
def recovery_stream(spark, d):
    """From a replayed log to the snapshots in another, under a limit of 40 calls; those of one symbol fail, and count."""

    def fetch(symbol):
        if symbol == "VIEW":
            raise OSError("no answer")
        return symbol.encode()

    path = fresh_path(spark, "recovered")
    query_ = stateful.recover_live(_streamed_gaps(spark, d), path, fetch, fresh_path(spark, "state"), limit=40, clock=lambda: 7000, trigger="0 seconds")
    stateful.stop(query_)
    rows = spark.read.format("framelog").load(path)
    return rows.select("recv_nanos", F.regexp_extract("file", r"([^/]+)_\d{8}\.zst$", 1).alias("symbol"), "tag_byte", F.col("payload").cast("string").alias("body"))


_SQL_ROTATED = "SELECT event_type AS symbol, seq, recv_nanos, event_type || '_' || strftime(max(day) OVER (PARTITION BY event_type ORDER BY seq ROWS UNBOUNDED PRECEDING), '%Y%m%d') || '.zst' AS file FROM (SELECT event_type, epoch_us(ts) * 1000 AS recv_nanos, CAST(ts AS DATE) AS day, (event_id + CASE WHEN event_id % 10 = 0 THEN 500 ELSE 0 END) * 100000 + event_id AS seq FROM events)"


@query("rotated_log", f"SELECT file, row_number() OVER (PARTITION BY file ORDER BY seq) - 1 AS seq, recv_nanos, 'm' || seq AS payload FROM ({_SQL_ROTATED})")
def rotated_log(spark, d):
    """Late records over midnights: rotation, the sink, and the log read back."""
    late = F.col("event_id") + F.when(F.col("event_id") % 10 == 0, 500).otherwise(0)
    rows = table(spark, d, "events").select(F.col("event_type").alias("symbol"), "ts", (late * 100000 + F.col("event_id")).alias("seq"))
    rows = schedule.rotated(rows, "/log").select("symbol", "file_date", "seq", (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("recv_nanos"), F.lit(83).alias("tag_byte"), F.concat(F.lit("m"), F.col("seq").cast("string")).cast("binary").alias("payload"))
    path = fresh_path(spark, "rotated")
    framelog.write_log(rows, path)
    return spark.read.format("framelog").load(path).select(F.element_at(F.split("file", "/"), -1).alias("file"), "seq", "recv_nanos", F.col("payload").cast("string").alias("payload"))


@query("interleaved_log", """
SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY recv_nanos, tag = 'R') - 1 AS seq, recv_nanos, tag FROM (
  SELECT event_type AS symbol, event_id * 1000 AS recv_nanos, 'S' AS tag FROM events
  UNION ALL SELECT event_type, (event_id + event_id % 3 * 7) * 1000 + CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id END, 'R' FROM events WHERE event_id % 10 = 0)""")
def interleaved_log(spark, d):
    e = best_frames(spark, d).withColumnRenamed("event_type", "symbol")
    messages = e.select((F.col("seq") * 1000).alias("recv_nanos"), "symbol", F.lit(83).alias("tag_byte"), "payload")
    done = (F.col("seq") + F.col("seq") % 3 * 7) * 1000 + F.when(F.col("seq") % 4 == 0, 0).otherwise(F.col("seq"))
    snapshots = e.filter("seq % 10 = 0").select(done.alias("recv_nanos"), "symbol", F.lit(82).alias("tag_byte"), F.lit("{}").cast("binary").alias("payload"))
    return stateful.interleave(messages, snapshots).select("symbol", "seq", "recv_nanos", "tag")


@query("subscription_url", "SELECT string_agg(lower(r_name) || s.t, '/' ORDER BY r_regionkey, s.i) AS path FROM region, (VALUES (0, '@trade'), (1, '@bestBidAsk'), (2, '@depth'), (3, '@depth20')) s(i, t)")
def subscription_url(spark, d):
    return schedule.subscription_path(table(spark, d, "region").select("r_regionkey", F.col("r_name").alias("symbol")), "r_regionkey")


@query("snapshot_schedule", "SELECT symbol, due FROM (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS due FROM events), (SELECT DISTINCT upper(event_type) AS symbol FROM events)")
def snapshot_schedule(spark, d):
    e = table(spark, d, "events")
    return schedule.snapshot_times(e.agg(F.min("ts").alias("start"), F.max("ts").alias("stop")), e.select(F.upper("event_type").alias("symbol")).distinct()).select("symbol", "due")


@query("idle_sessions", "SELECT user_id, session, min(ts) AS start, max(ts) AS stop, count(*) AS n FROM (SELECT *, CAST(sum(coalesce(CAST(g > 3600000000 AS INT), 0)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS g FROM events)) GROUP BY 1, 2")
def idle_sessions(spark, d):
    e = table(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp"))
    out = schedule.idle_sessions(e, "user_id", "t", 3600)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "stop")})


_SQL_FRAMES = "SELECT event_id, user_id, epoch_us(ts) AS micros, CASE WHEN event_id % 50 = 7 THEN 'Close' ELSE list_extract(['Binary', 'Text', 'Ping', 'Pong', 'Continuation'], CAST(event_id % 5 + 1 AS INT)) END AS opcode FROM events"


def _socket_frames(spark, d) -> DataFrame:
    kinds = F.array(*(F.lit(x) for x in ("Binary", "Text", "Ping", "Pong", "Continuation")))
    opcode = F.when(F.col("event_id") % 50 == 7, "Close").otherwise(F.get(kinds, (F.col("event_id") % 5).cast("int")))
    return table(spark, d, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"), opcode.alias("opcode"))


@query("opcode_actions", f"SELECT CASE opcode WHEN 'Binary' THEN 'record' WHEN 'Text' THEN 'log' WHEN 'Ping' THEN 'pong' WHEN 'Close' THEN 'error' ELSE 'ignore' END AS action, count(*) AS n FROM ({_SQL_FRAMES}) GROUP BY 1")
def opcode_actions(spark, d):
    return _socket_frames(spark, d).groupBy(schedule.frame_action(F.col("opcode")).alias("action")).agg(F.count("*").alias("n"))


@query("opcode_filter", f"SELECT event_id, user_id, micros FROM ({_SQL_FRAMES}) WHERE opcode = 'Binary'")
def opcode_filter(spark, d):
    return schedule.binary_frames(_socket_frames(spark, d))


@query("idle_timeouts", f"""
WITH f AS (SELECT *, min(micros) OVER (PARTITION BY user_id) AS start FROM ({_SQL_FRAMES})),
m AS (SELECT *, lead(micros) OVER (PARTITION BY user_id ORDER BY micros) AS following, start + ((micros + 36000000000 - start) // 6000000000 + 1) * 6000000000 AS tick FROM f WHERE opcode IN ('Binary', 'Text', 'Ping', 'Close') OR micros = start),
e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN opcode = 'Close' THEN micros ELSE tick END, opcode <> 'Close') AS place FROM m WHERE opcode = 'Close' OR following IS NULL OR tick < following)
SELECT user_id, micros AS last_activity, tick AS timeout_at FROM e WHERE place = 1 AND opcode <> 'Close'""")
def idle_timeouts(spark, d):
    return schedule.idle_timeouts(_socket_frames(spark, d), "user_id", "micros", "opcode", 36000, 6000)


@query("backoff_schedule", "SELECT event_id, base + (event_id % (2 * (base // 4) + 1)) - base // 4 AS delay FROM (SELECT event_id, least(100 * CAST(power(2, least(event_id % 12, 7)) AS BIGINT), 10000) AS base FROM events)")
def backoff_schedule(spark, d):
    return table(spark, d, "events").select("event_id", schedule.backoff_ms(F.col("event_id") % 12, F.col("event_id")).alias("delay"))


@query("reconnect_failures", "SELECT user_id, event_id, CASE WHEN run > 0 THEN place - 1 ELSE place END AS failures FROM (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY event_id) AS place FROM (SELECT user_id, event_id, sum(CAST(value > 30 AS INT)) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM events))")
def reconnect_failures(spark, d):
    out = schedule.failures_in_row(table(spark, d, "events").select("user_id", "event_id", "value"), "user_id", "event_id", "value")
    return out.select("user_id", "event_id", F.col("failures").cast("bigint").alias("failures"))


def _printed(frames: DataFrame, tag: int = 83) -> DataFrame:
    return printed.printed(frames.select("seq", F.col("seq").alias("recv_nanos"), F.lit(tag).alias("tag_byte"), "payload"), ["seq"])


def _cents(c: str) -> str:
    return f"({c} // 100)::VARCHAR || '.' || lpad(({c} % 100)::VARCHAR, 2, '0') || '0000'"


@query("print_best", f"SELECT event_id AS seq, '[' || event_id || '] S BEST_BID_ASK ' || event_type || ' bid=' || {_cents('m')} || ' ask=' || {_cents('(m + 1)')} || ' t=' || epoch_us(ts) AS line FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS m FROM events)")
def print_best(spark, d):
    return _printed(best_frames(spark, d))


@query("print_trades", f"""
SELECT l_orderkey AS seq, '[' || l_orderkey || '] S TRADES SYM' || (l_orderkey % 5) || ' trades=' || count(*) || ' t=' || l_orderkey
  || string_agg(CASE WHEN pos <= 5 THEN chr(10) || '  trade id=' || id || ' price=' || {_cents('price')} || ' qty=' || qty || '.000000 buyer_maker=' || is_buyer_maker ELSE '' END, '' ORDER BY pos)
  || CASE WHEN count(*) > 5 THEN chr(10) || '  ...' ELSE '' END AS line
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY id, price, qty, is_buyer_maker) AS pos FROM ({_SQL_LINES})) GROUP BY l_orderkey""")
def print_trades(spark, d):
    return _printed(trade_frames(spark, d))


def _side_lines(status: str, label: str) -> str:
    return f"""chr(10) || '  {label} (' || count(*) FILTER (l_linestatus = '{status}') || '):' || coalesce(string_agg(chr(10) || '    ' || {_cents('price')} || ' @ ' || qty || '.000000', '' ORDER BY pos) FILTER (l_linestatus = '{status}' AND pos <= 5), '')
  || CASE WHEN count(*) FILTER (l_linestatus = '{status}') > 5 THEN chr(10) || '    ...' ELSE '' END"""


@query("print_depth", f"""
SELECT l_orderkey AS seq, '[' || l_orderkey || '] S DEPTH_DIFF book t=' || (l_orderkey * 1000) || ' uid=' || l_orderkey || '-' || (l_orderkey + 1) || {_side_lines('O', 'diffBids')} || {_side_lines('F', 'diffAsks')} AS line
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY price, qty) AS pos FROM ({_SQL_LINES})) GROUP BY l_orderkey""")
def print_depth(spark, d):
    return _printed(depth_frames(spark, d, sbe.DIFF))


def _json_lines(status: str, label: str) -> str:
    return f"chr(10) || '  {label}:' || coalesce(string_agg(chr(10) || '    ' || price || ' @ ' || qty, '' ORDER BY pos) FILTER (l_linestatus = '{status}' AND pos <= 5), '')"


@query("print_rest", f"""
SELECT l_orderkey AS seq, '[' || l_orderkey || '] R ' || CASE l_orderkey % 10 WHEN 0 THEN 'SNAPSHOT lastUpdateId=0 bids=0 asks=0' WHEN 1 THEN '<invalid JSON>' ELSE
  'SNAPSHOT lastUpdateId=' || l_orderkey || ' bids=' || count(*) FILTER (l_linestatus = 'O') || ' asks=' || count(*) FILTER (l_linestatus = 'F') || {_json_lines('O', 'Bids')} || {_json_lines('F', 'Asks')} END AS line
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY id, price, qty) AS pos FROM ({_SQL_LINES})) GROUP BY l_orderkey""")
def print_rest(spark, d):
    return _printed(rest_frames(spark, d), 82)


#: A template that only this text knows: its second version has the customer, and a flag of the lines, besides.
ORDER_SCHEMA = """<messageSchema xmlns="http://fixprotocol.io/2016/sbe" id="1" version="1"><types>
<type name="mantissa" primitiveType="int64"/><type name="short" primitiveType="char" length="4"/><enum name="flag" encodingType="uint8"><validValue name="R">1</validValue></enum>
<composite name="groupSizeEncoding"><type name="blockLength" primitiveType="uint16"/><type name="numInGroup" primitiveType="uint16"/></composite>
<composite name="text8"><type name="length" primitiveType="uint8"/><type name="varData" primitiveType="uint8" length="0"/></composite></types>
<message name="order" id="20001"><field name="key" id="1" type="uint64"/><field name="exponent" id="2" type="int8"/><field name="total" id="3" type="mantissa"/><field name="code" id="4" type="short"/>
<field name="venue" id="8" type="short" presence="constant">main</field><field name="customer" id="5" type="uint32" sinceVersion="1"/>
<group name="lines" id="6"><field name="number" id="1" type="uint8"/><field name="qty" id="2" type="int32"/><field name="returned" id="3" type="flag" sinceVersion="1"/></group>
<data name="priority" id="7" type="text8"/></message></messageSchema>"""


@frames
def order_frames(spark, d) -> DataFrame:
    """Orders as messages: those with even keys by the first version."""
    t = layouts.parse_schema(ORDER_SCHEMA)["order"]
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("number"), F.round("l_quantity").cast("int").alias("qty"), (F.col("l_returnflag") == "R").cast("int").alias("returned")))).alias("lines"))
    none = F.array().cast("array<struct<number:int,qty:int,returned:int>>")
    rows = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("lines", F.coalesce("lines", none))
    values = {"key": F.col("o_orderkey"), "exponent": F.lit(-2), "total": F.round(F.col("o_totalprice") * 100).cast("bigint"), "code": F.substring("o_orderpriority", 1, 3), "customer": F.col("o_custkey")}
    both = [layouts.encode(t, values, {"lines": F.col("lines")}, {"priority": F.col("o_orderpriority")}, v) for v in (0, 1)]
    return saved(rows.select(F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderkey") % 2 == 0, both[0]).otherwise(both[1]).alias("payload")), "frames")


_SQL_ORDERS = "SELECT o_orderkey AS seq, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS total, o_orderpriority AS priority, CASE WHEN o_orderkey % 2 = 1 THEN o_custkey END AS customer FROM orders"


@query("layout_decode", f"SELECT seq, o_orderkey AS key, total, left(priority, 3) AS code, 'main' AS venue, CAST(customer AS BIGINT) AS customer, priority, l_linenumber AS number, CAST(round(l_quantity) AS INT) AS qty, CASE WHEN seq % 2 = 1 THEN CAST(l_returnflag = 'R' AS INT) END AS returned FROM ({_SQL_ORDERS}) LEFT JOIN lineitem ON l_orderkey = seq")
def layout_decode(spark, d):
    """A fifth template, given as a schema's text."""
    rows = layouts.decode(order_frames(spark, d), layouts.parse_schema(ORDER_SCHEMA)["order"]).filter("decode_error is null")
    return rows.select("seq", F.col("key").cast("bigint").alias("key"), "total", "code", "venue", "customer", "priority", F.explode_outer("lines").alias("x")).select("*", "x.*").drop("x")


@query("layout_print", f"""SELECT seq, 'ORDER ' || seq || ' ' || priority || ' total=' || {_cents('total')} || ' customer=' || coalesce(customer::VARCHAR, '-') || ' lines=' || count(l_orderkey)
  || coalesce(string_agg(CASE WHEN pos <= 5 THEN chr(10) || '  #' || l_linenumber || ' x ' || CAST(round(l_quantity) AS INT) ELSE '' END, '' ORDER BY pos) FILTER (l_orderkey IS NOT NULL), '') || CASE WHEN count(l_orderkey) > 5 THEN chr(10) || '  ...' ELSE '' END AS line
FROM ({_SQL_ORDERS}) LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, round(l_quantity), l_returnflag = 'R') AS pos FROM lineitem) ON l_orderkey = seq GROUP BY seq, priority, total, customer""")
def layout_print(spark, d):
    t = layouts.parse_schema(ORDER_SCHEMA)["order"]
    return layouts.printed(order_frames(spark, d), t, "ORDER {key} {priority} total={total*exponent} customer={customer} lines={#lines}", {"lines": "  #{number} x {qty}"})


@query("print_counts", "SELECT event_type || '_20240101.zst' AS file, '--- total: ' || count(*) || ' records (' || count(*) FILTER (event_id % 10 > 1) || ' SBE stream, ' || count(*) FILTER (event_id % 10 = 0) || ' REST snapshot) ---' AS line FROM events GROUP BY 1")
def print_counts(spark, d):
    return printed.counts_line(file_counts(spark, d)).select("file", "line")
