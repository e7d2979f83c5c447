"""Printed form of frame log records: one text a record, its lines joined by newlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions.binary import scaled, six_decimals
from tickweave.operators import rest, sbe, symbols
from tickweave.plans.session import ship

# Fixed values of the printed form: names by template, and all texts, whole.
NAMES = {sbe.TRADES: "TRADES", sbe.BEST: "BEST_BID_ASK", sbe.SNAPSHOT: "DEPTH_SNAPSHOT", sbe.DIFF: "DEPTH_DIFF"}
TEXTS = {
    "trades": "[{}] S TRADES {} trades={} t={}", "trade": "  trade id={} price={} qty={} buyer_maker={}", "more trades": "  ...",
    "best": "[{}] S BEST_BID_ASK {} bid={} ask={} t={}",
    "snapshot": "[{}] S DEPTH_SNAPSHOT {} t={} uid={}", "diff": "[{}] S DEPTH_DIFF {} t={} uid={}-{}", "level": "    {} @ {}", "more levels": "    ...",
    "snapshot bids": "  snapshotBids ({}):", "snapshot asks": "  snapshotAsks ({}):", "diff bids": "  diffBids ({}):", "diff asks": "  diffAsks ({}):",
    "known": "[{}] S {} {} block_len={} total={}b", "unknown": "template={}", "short": "[{}] S <too short: {} bytes>", "tag": "[{}] unknown tag: 0x{}, payload_len={}",
    "rest": "[{}] R SNAPSHOT lastUpdateId={} bids={} asks={}", "invalid": "[{}] R <invalid JSON>", "rest bids": "  Bids:", "rest asks": "  Asks:",
    "counts": "--- total: {} records ({} SBE stream, {} REST snapshot) ---",
}
SHOWN = 5


def _text(pattern: str, *values: Column) -> Column:
    """pattern with each {} replaced by a value."""
    parts = pattern.split("{}")
    return F.concat(F.lit(parts[0]), *(x for v, p in zip(values, parts[1:], strict=True) for x in (v.cast("string"), F.lit(p))))


def _number(v: Column, m: Column, exponent: str) -> Column:
    return six_decimals(scaled(v, m[exponent]))


def _lines(first: Column, *more: Column) -> Column:
    """Arrays of text after a first line, as one text; a null array adds none."""
    none = F.array().cast("array<string>")
    return F.array_join(F.concat(F.array(first), *(F.coalesce(m, none) for m in more)), "\n")


def _dots(declared: Column, text: str) -> Column:
    return F.when(declared > SHOWN, F.array(F.lit(text)))


def _heads(t: sbe.Template, m: Column) -> Column:
    at = (F.col("_nanos"), F.col("_symbol"))
    if t is sbe.TRADES:
        return _text(TEXTS["trades"], *at, m["declared_trades"], m["event_time_us"])
    if t is sbe.BEST:
        return _text(TEXTS["best"], *at, _number(m["bid_price"], m, "price_exp"), _number(m["ask_price"], m, "price_exp"), m["event_time_us"])
    if t is sbe.SNAPSHOT:
        return _text(TEXTS["snapshot"], *at, m["event_time_us"], m["book_update_id"])
    return _text(TEXTS["diff"], *at, m["event_time_us"], m["first_update_id"], m["last_update_id"])


def _entries(t: sbe.Template, m: Column) -> list[Column]:
    if t is sbe.TRADES:
        one = lambda x: _text(TEXTS["trade"], x["id"], _number(x["price"], m, "price_exp"), _number(x["qty"], m, "qty_exp"), x["is_buyer_maker"])
        return [F.transform(F.slice(m["trades"], 1, SHOWN), one), _dots(m["declared_trades"], TEXTS["more trades"])]
    out = []
    for group in t.groups:
        declared = m[f"declared_{group}"]
        level = lambda x: _text(TEXTS["level"], _number(x["price"], m, "price_exp"), _number(x["qty"], m, "qty_exp"))
        label = TEXTS[f"{'snapshot' if t is sbe.SNAPSHOT else 'diff'} {group}"]
        out += [F.array(_text(label, declared)), F.transform(F.slice(m[group], 1, SHOWN), level), _dots(declared, TEXTS["more levels"])]
    return out


def _message_line(kind: Column, size: Column) -> Column:
    """By kind; null for trades that are too short for their fixed fields."""
    name = F.lit(None).cast("string")
    for t, text in NAMES.items():
        name = F.when(F.col("_head")["template_id"] == t.id, text).otherwise(name)
    name = F.coalesce(name, _text(TEXTS["unknown"], F.col("_head")["template_id"]))
    bare = _text(TEXTS["known"], F.col("_nanos"), name, F.col("_symbol"), F.col("_head")["block_length"], size)
    line = F.when(kind == "short", _text(TEXTS["short"], F.col("_nanos"), size)).when(kind == "other", bare)
    for t in NAMES:
        m = F.col(f"_{t.name}")
        cut = F.coalesce(m["decode_error"] == "block too short", F.lit(False))
        line = line.when((kind == t.name) & ~cut, _lines(_heads(t, m), *_entries(t, m)))
        if t is not sbe.TRADES:
            line = line.when(kind == t.name, bare)
    return line


def _snapshot_line() -> Column:
    head = _text(TEXTS["rest"], F.col("_nanos"), F.col("last_update_id"), F.col("n_bids"), F.col("n_asks"))
    level = lambda x: _text(TEXTS["level"], x[0], x[1])
    sides = [F.when(F.col(f"has_{s}"), F.concat(F.array(F.lit(TEXTS[f"rest {s}"])), F.transform(s, level))) for s in ("bids", "asks")]
    return F.when(F.col("valid"), _lines(head, *sides)).otherwise(_text(TEXTS["invalid"], F.col("_nanos")))


def printed(records: DataFrame, keys: list[str]) -> DataFrame:
    """keys and line of records (recv_nanos, tag_byte, payload, keys), in one pass.

    Messages and snapshots print their head and the first five entries of each group; a known template whose block
    doesn't fit, and an unknown one, print their sizes; trades too short for their fixed fields print nothing. Depth groups
    that are cut short print their label and declared count only. A null payload counts as empty; a null tag prints nothing.
    """
    ship(records.sparkSession)
    data, tag, kind = F.col("_data"), F.col("_tag"), F.col("_kind")
    rows = records.filter("tag_byte is not null").select(F.struct(*keys).alias("_keys"), F.col("recv_nanos").alias("_nanos"), F.col("tag_byte").alias("_tag"), F.coalesce("payload", F.unhex(F.lit(""))).alias("_data"))
    head = sbe.header(data)
    rows = rows.withColumns({"_kind": F.when(tag == 83, sbe.kind(data)), "_head": F.struct(*(c.alias(n) for n, c in head.items())), "_symbol": symbols.match_heuristic(data), "_size": F.length(data)})
    rows = rows.withColumns({f"_{t.name}": sbe.message(t, F.when(kind == t.name, data)) for t in NAMES} | {"_body": F.when(tag == 82, data)})
    rows = rest.decode_rest(rows.drop("_data"), "_body", SHOWN)
    strange = _text(TEXTS["tag"], F.col("_nanos"), F.lpad(F.lower(F.hex("_tag")), 2, "0"), F.col("_size"))
    line = F.when(tag == 83, _message_line(kind, F.col("_size"))).when(tag == 82, _snapshot_line()).otherwise(strange)
    return rows.select("_keys.*", line.alias("line")).filter("line is not null")


def counts_line(counts: DataFrame) -> DataFrame:
    """Rows of schedule.file_counts with the line that closes a file."""
    return counts.withColumn("line", _text(TEXTS["counts"], F.col("total"), F.col("sbe"), F.col("rest")))
