"""Binary messages: encoders and decoders of the templates, by a registry of their layouts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.functions.binary import hex_le, le
from tickweave.plans.session import ship

# Fixed values of the wire format: template ids, field order and widths (negative: signed).
HEADER = [("block_length", 2), ("template_id", 2), ("schema_id", 2), ("version", 2)]


@dataclass(frozen=True)
class Template:
    name: str
    id: int
    fields: tuple[tuple[str, int], ...]
    groups: tuple[str, ...] = ()
    entry: tuple[tuple[str, int], ...] = ()
    count_bytes: int = 2
    fixed_stride: bool = False  # entries follow each other at their own width, whatever the wire says

    @property
    def block(self) -> int:
        return sum(abs(n) for _, n in self.fields)

    @property
    def width(self) -> int:
        return sum(abs(n) for _, n in self.entry)


_EXP = (("price_exp", -1), ("qty_exp", -1))
_LEVEL = (("price", -8), ("qty", -8))
TRADES = Template("trades", 10000, (("event_time_us", -8), ("transact_time_us", -8), *_EXP), ("trades",), (("id", -8), *_LEVEL, ("is_buyer_maker", 1)), 4, True)
BEST = Template("best_bid_ask", 10001, (("event_time_us", -8), ("book_update_id", -8), *_EXP, ("bid_price", -8), ("bid_qty", -8), ("ask_price", -8), ("ask_qty", -8)))
SNAPSHOT = Template("depth_snapshot", 10002, (("event_time_us", -8), ("book_update_id", -8), *_EXP), ("bids", "asks"), _LEVEL)
DIFF = Template("depth_diff", 10003, (("event_time_us", -8), ("first_update_id", -8), ("last_update_id", -8), *_EXP), ("bids", "asks"), _LEVEL)
TEMPLATES = {t.id: t for t in (TRADES, BEST, SNAPSHOT, DIFF)}


def encode(t: Template, values: dict[str, Column], groups: dict[str, Column] | None = None, symbol: Column | None = None) -> Column:
    """A message as BINARY. groups: arrays of structs with the entry's fields."""
    parts = [hex_le(F.lit(v), n) for v, n in ((t.block, 2), (t.id, 2), (1, 2), (0, 2))]
    parts += [hex_le(values[name], abs(n)) for name, n in t.fields]
    for g in t.groups:
        rows = groups[g]
        body = F.array_join(F.transform(rows, lambda x: F.concat(*(hex_le(x[name], abs(n)) for name, n in t.entry))), "")
        parts += [hex_le(F.lit(t.width), 2), hex_le(F.size(rows), t.count_bytes), body]
    parts += [hex_le(F.octet_length(symbol), 1), F.hex(symbol.cast("binary"))]
    return F.unhex(F.concat(*parts))


def header(data: Column) -> dict[str, Column]:
    """Header fields; null for under 8 bytes."""
    out, at = {}, 0
    for name, n in HEADER:
        out[name] = F.when(F.length(data) >= 8, le(data, at, n)).cast("int")
        at += n
    return out


def kind(data: Column) -> Column:
    """Name of the template; 'short' under 8 bytes, 'other' for an unknown id or a block that doesn't fit."""
    h = header(data)
    out = F.when(F.length(data) < 8, "short").when(F.length(data) < 8 + h["block_length"], "other")
    for t in TEMPLATES.values():
        out = out.when(h["template_id"] == t.id, t.name)
    return out.otherwise("other")


def _kind(t: Template, only: tuple[str, ...] | None = None) -> T.StructType:
    one = lambda fields: [T.StructField(n, T.IntegerType() if abs(w) == 1 else T.LongType()) for n, w in fields]
    groups = [f for g in t.groups for f in (T.StructField(f"declared_{g}", T.LongType()), T.StructField(g, T.ArrayType(T.StructType(one(t.entry)))))]
    every = [*one(t.fields), *groups, T.StructField("decode_error", T.StringType())]
    return T.StructType([f for f in every if only is None or f.name in only])


def _integers(flat: np.ndarray, at: np.ndarray, n: int, signed: bool) -> np.ndarray:
    """The n-byte little-endian integers at these places of flat, all within it."""
    return flat[at[:, None] + np.arange(n)].reshape(-1).view(f"<{'i' if signed else 'u'}{n}")


def _fields(fields, flat: np.ndarray, at: np.ndarray, stop: np.ndarray) -> list[pa.Array]:
    """Arrays of the fields that follow each other from `at`; null where they reach over `stop`."""
    out = []
    for _, n in fields:
        over = at + abs(n) > stop
        v = _integers(flat, np.where(over, 0, at), abs(n), n < 0)
        out.append(pa.array(v.astype(np.int32 if abs(n) == 1 else np.int64), mask=over if over.any() else None))
        at = at + abs(n)
    return out


def read_messages(t: Template, payload: pa.Array, only: tuple[str, ...] | None = None) -> pa.Array:
    """A struct for each payload, null for null ones; fields as _kind names them. Groups are not looked at if `only` has neither them nor the error.

    Works on the bytes of the whole batch: each field, and each entry of all groups, is gathered at once.
    """
    n = len(payload)
    payload = payload.cast(pa.binary())
    raw = payload.buffers()
    offsets = np.frombuffer(raw[1], np.int32, n + 1, payload.offset * 4).astype(np.int64)
    flat = np.concatenate([np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8), np.zeros(8, np.uint8)])
    start, stop = offsets[:-1], offsets[1:]
    null = payload.is_null().to_numpy(zero_copy_only=False)
    arrays = _fields(t.fields, flat, start + 8, stop)
    error = np.where(stop - start < 8 + t.block, "block too short", None).astype(object)
    head = stop - start >= 2
    at = np.where(head, start + 8 + _integers(flat, np.where(head, start, 0), 2, False), stop)
    wanted = _kind(t, only).names
    names = [n for n, _ in t.fields]
    for g in t.groups if only is None or not set(only) <= set(names) else ():
        c = t.count_bytes
        has = at + 2 + c <= stop
        declared = np.where(has, _integers(flat, np.where(has, at + 2, 0), c, False).astype(np.int64), 0)
        step = np.full(n, t.width) if t.fixed_stride else np.where(has, _integers(flat, np.where(has, at, 0), 2, False).astype(np.int64), 0)
        first = at + 2 + c
        room = stop - first
        k = np.minimum(declared, np.where(room < t.width, 0, np.where(step <= 0, declared, (room - t.width) // np.maximum(step, 1) + 1)))
        if not t.fixed_stride:
            short = np.equal(error, None) & (~has | (k < declared))
            error[short] = f"{g} cut short"
        absent = null if t.fixed_stride else ~np.equal(error, None)
        k = np.where(absent, 0, k)
        ends = np.cumsum(k)
        row = np.repeat(np.arange(n), k)
        place = first[row] + (np.arange(len(row)) - (ends - k)[row]) * step[row]
        values = pa.StructArray.from_arrays(_fields(t.entry, flat, place, stop[row]), names=[x for x, _ in t.entry])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values, mask=pa.array(absent))
        arrays += [pa.array(declared), lists]
        at = np.where(has, first + declared * step, stop)
        names += [f"declared_{g}", g]
    held = dict(zip([*names, "decode_error"], [*arrays, pa.array(error, pa.string())], strict=True))
    return pa.StructArray.from_arrays([held[n] for n in wanted], names=wanted, mask=pa.array(null))


def message(t: Template, data: Column, only: tuple[str, ...] | None = None) -> Column:
    """The decoded struct of a template's payload, in Arrow batches; null for null. only: fields of it."""

    def read(payload: pa.Array) -> pa.Array:
        from tickweave.operators.sbe import read_messages

        return read_messages(t, payload, only)

    return F.arrow_udf(read, _kind(t, only))(data)


def decode(frames: DataFrame, t: Template, payload: str = "payload", only: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of one template: frames' other columns, fixed fields, declared_<group>, <group> arrays, decode_error.

    Trades keep what fits, with the declared count. A depth group that is cut short is null from there on, with an error.
    The message is one column: filters on other columns pass below it. only: the fields to read, where not all are wanted.
    """
    ship(frames.sparkSession)
    rest = [c for c in frames.columns if c != payload]
    held = "_message"
    while held in rest:
        held += "_"
    rows = frames.filter(kind(F.col(payload)) == t.name).withColumn(held, message(t, F.col(payload), only))
    return rows.select(*rest, *(F.col(held)[n].alias(n) for n in _kind(t, only).names))


def first_n(frames: DataFrame, group: str, n: int = 5) -> DataFrame:
    """Entries by place, the first n of each group; has_more says whether more were declared."""
    rest = [c for c in frames.columns if c not in (group, f"declared_{group}")]
    return frames.select(*rest, (F.col(f"declared_{group}") > n).alias("has_more"), F.posexplode(F.slice(group, 1, n)).alias("pos", "entry"))
