"""Message layouts from an SBE schema: templates that are given as data are encoded, decoded, validated and printed without code of their own.

A layout has fixed fields, repeating groups and variable data. Later versions append fields to the block and to group entries: what the sender's version, or its
block, doesn't have is null, and what a newer sender's block has besides is skipped.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.functions.binary import hex_le, le, scaled, six_decimals
from tickweave.plans.session import ship

# Fixed values of the schema language: primitive types by numpy's names, and Spark's types for them.
PRIMITIVES = {"char": "S", "int8": "<i1", "int16": "<i2", "int32": "<i4", "int64": "<i8", "uint8": "<u1", "uint16": "<u2", "uint32": "<u4", "uint64": "<u8", "float": "<f4", "double": "<f8"}
_SPARK = {"S": T.StringType(), "<u8": T.DecimalType(20, 0), "<f4": T.FloatType(), "<f8": T.DoubleType()}
HEAD = 8


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # of PRIMITIVES
    size: int
    offset: int
    since: int = 0

    @property
    def spark(self) -> T.DataType:
        return _SPARK.get(self.kind) or (T.LongType() if self.size > 4 or self.kind == "<u4" else T.IntegerType())


@dataclass(frozen=True)
class Group:
    name: str
    fields: tuple[Field, ...]
    length_bytes: int
    count_bytes: int


@dataclass(frozen=True)
class Layout:
    name: str
    id: int
    fields: tuple[Field, ...]
    groups: tuple[Group, ...] = ()
    data: tuple[tuple[str, int], ...] = ()  # name, bytes of the length
    constants: tuple[tuple[str, str], ...] = ()
    version: int = 0

    @property
    def kind(self) -> T.StructType:
        one = lambda fields: [T.StructField(f.name, f.spark) for f in fields]
        groups = [T.StructField(g.name, T.ArrayType(T.StructType(one(g.fields)))) for g in self.groups]
        return T.StructType([*one(self.fields), *groups, *(T.StructField(n, T.StringType()) for n, _ in self.data), T.StructField("decode_error", T.StringType())])


def size_of(fields: tuple[Field, ...], version: int | None = None) -> int:
    """Bytes of a block with the fields of a version."""
    return max((f.offset + f.size for f in fields if version is None or f.since <= version), default=0)


def parse_schema(text: str) -> dict[str, Layout]:
    """Layouts by name of an SBE schema (XML). Groups within groups, and composites other than those of groups and variable data, are refused."""
    root = ET.fromstring(text)
    strip = lambda e: e.tag.rpartition("}")[2]
    types: dict[str, tuple[str, int]] = {n: (k, 1 if n == "char" else int(k[2])) for n, k in PRIMITIVES.items()}
    pairs: dict[str, list[int]] = {}
    for e in (x for block in root if strip(block) == "types" for x in block):
        if strip(e) == "type":
            kind, size = types[e.get("primitiveType")]
            n = int(e.get("length", 1))
            if n != 1 and kind != "S":
                raise ValueError(f"type {e.get('name')}: arrays of {e.get('primitiveType')} are not supported")
            types[e.get("name")] = (kind, size * n)
        elif strip(e) in ("enum", "set"):
            types[e.get("name")] = types[e.get("encodingType")]
        elif strip(e) == "composite":
            pairs[e.get("name")] = [types[t.get("primitiveType")][1] for t in e if strip(t) == "type"]

    def fields(parent) -> tuple[tuple[Field, ...], tuple[tuple[str, str], ...]]:
        out, constants, at = [], [], 0
        for e in parent:
            if strip(e) != "field":
                continue
            if e.get("presence") == "constant":
                constants.append((e.get("name"), e.get("valueRef", "").rpartition(".")[2] or (e.text or "").strip()))
                continue
            if e.get("type") not in types:
                raise ValueError(f"field {e.get('name')}: type {e.get('type')} is not supported")
            kind, size = types[e.get("type")]
            at = int(e.get("offset", at))
            out.append(Field(e.get("name"), kind, size, at, int(e.get("sinceVersion", 0))))
            at += size
        return tuple(out), tuple(constants)

    layouts = {}
    for m in (x for x in root if strip(x) == "message"):
        groups = []
        for g in (x for x in m if strip(x) == "group"):
            if any(strip(x) in ("group", "data") for x in g):
                raise ValueError(f"group {g.get('name')}: groups and data within groups are not supported")
            length, count = pairs[g.get("dimensionType", "groupSizeEncoding")][:2]
            groups.append(Group(g.get("name"), fields(g)[0], length, count))
        own, constants = fields(m)
        data = tuple((d.get("name"), pairs[d.get("type")][0]) for d in m if strip(d) == "data")
        layouts[m.get("name")] = Layout(m.get("name"), int(m.get("id")), own, tuple(groups), data, constants, int(root.get("version", 0)))
    return layouts


# ---- writing


def _block(fields: tuple[Field, ...], value, version: int) -> list[Column]:
    """Hexadecimal texts of a block; places without a field are zeros."""
    out, at = [], 0
    for f in sorted((f for f in fields if f.since <= version), key=lambda f: f.offset):
        if f.kind in ("<f4", "<f8"):
            raise ValueError(f"field {f.name}: floating point is not written")
        out.append(F.lit("00" * (f.offset - at)))
        out.append(F.rpad(F.hex(value(f.name).cast("binary")), F.lit(2 * f.size), F.lit("00")) if f.kind == "S" else hex_le(value(f.name), f.size))
        at = f.offset + f.size
    return out


def _entry_hex(g: Group, version: int):
    return lambda x: F.concat(F.lit(""), *_block(g.fields, x.__getitem__, version))


def encode(t: Layout, values: dict[str, Column], groups: dict[str, Column] | None = None, data: dict[str, Column] | None = None, version: int | None = None) -> Column:
    """A message as BINARY, with the fields of a version (by default the schema's). groups: arrays of structs; data: texts."""
    version = t.version if version is None else version
    parts = [hex_le(F.lit(v), 2) for v in (size_of(t.fields, version), t.id, 1, version)] + _block(t.fields, lambda n: values[n], version)
    for g in t.groups:
        rows = groups[g.name]
        body = F.array_join(F.transform(rows, _entry_hex(g, version)), "")
        parts += [hex_le(F.lit(size_of(g.fields, version)), g.length_bytes), hex_le(F.size(rows), g.count_bytes), body]
    for name, n in t.data:
        parts += [hex_le(F.octet_length(data[name]), n), F.hex(data[name].cast("binary"))]
    return F.unhex(F.concat(*parts))


# ---- reading


def _column(f: Field, flat: np.ndarray, at: np.ndarray, there: np.ndarray) -> pa.Array:
    """A field at these places of flat; null where it isn't there."""
    if not len(at):
        return pa.array([], _arrow(f))
    raw = flat[np.where(there, at + f.offset, 0)[:, None] + np.arange(f.size)]
    if f.kind == "S":
        texts = [bytes(x).split(b"\0")[0].decode("utf-8", "replace") for x in raw]
        return pa.array(texts, pa.string(), mask=~there)
    v = np.ascontiguousarray(raw).reshape(-1).view(f.kind)
    if f.kind == "<u8":
        return pa.array(v, pa.uint64(), mask=~there).cast(pa.decimal128(20, 0))
    return pa.array(v, mask=~there).cast(_arrow(f))


def _arrow(f: Field) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(f.spark)


def read_layout(t: Layout, payload: pa.Array) -> pa.StructArray:
    """A struct (t.kind) for each payload, null for null ones, by numpy over the whole batch.

    decode_error names the first thing that doesn't fit: the block, a group or data; that and what follows it are null.
    """
    n = len(payload)
    payload = payload.cast(pa.binary())
    raw = payload.buffers()
    offsets = np.frombuffer(raw[1], np.int32, n + 1, payload.offset * 4).astype(np.int64)
    flat = np.concatenate([np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8), np.zeros(64, np.uint8)])
    start, stop = offsets[:-1], offsets[1:]

    def number(at: np.ndarray, size: int, there: np.ndarray) -> np.ndarray:
        got = flat[np.where(there, at, 0)[:, None] + np.arange(size)].astype(np.int64)
        return np.where(there, (got << (8 * np.arange(size))).sum(1), 0)

    headed = stop - start >= HEAD
    block, version = number(start, 2, headed), number(start + 6, 2, headed)
    error = np.full(n, None, object)
    least = np.array([size_of(t.fields, v) for v in range(t.version + 1)])[np.minimum(version, t.version)]
    error[~headed | (block < least) | (start + HEAD + block > stop)] = "block too short"
    good = np.equal(error, None)
    arrays = [_column(f, flat, start + HEAD, good & (version >= f.since) & (f.offset + f.size <= block)) for f in t.fields]
    at = start + HEAD + block
    for g in t.groups:
        head = g.length_bytes + g.count_bytes
        there = good & (at + head <= stop)
        step, count = number(at, g.length_bytes, there), number(at + g.length_bytes, g.count_bytes, there)
        first = at + head
        least = np.array([size_of(g.fields, v) for v in range(t.version + 1)])[np.minimum(version, t.version)]
        fits = there & ((count == 0) | ((step >= least) & (step > 0) & (count <= (stop - first) // np.maximum(step, 1))))
        error[good & ~fits] = f"{g.name} cut short"
        good = fits
        count = np.where(good, count, 0)
        ends = np.cumsum(count)
        row = np.repeat(np.arange(n), count)
        place = first[row] + (np.arange(len(row)) - (ends - count)[row]) * step[row]
        entry = [_column(f, flat, place, (version[row] >= f.since) & (f.offset + f.size <= step[row])) for f in g.fields]
        values = pa.StructArray.from_arrays(entry, names=[f.name for f in g.fields])
        arrays.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values, mask=pa.array(~good)))
        at = first + count * step
    for name, size in t.data:
        there = good & (at + size <= stop)
        length = number(at, size, there)
        good = there & (at + size + length <= stop)
        error[np.equal(error, None) & ~good] = f"{name} cut short"
        arrays.append(pa.array([flat[a : a + k].tobytes().decode("utf-8", "replace") if g else None for a, k, g in zip((at + size).tolist(), length.tolist(), good.tolist(), strict=True)], pa.string()))
        at = at + size + length
    return pa.StructArray.from_arrays([*arrays, pa.array(error, pa.string())], names=t.kind.names, mask=payload.is_null())


def message(t: Layout, data: Column) -> Column:
    """The decoded struct of a layout's payload, in Arrow batches."""

    def read(payload: pa.Array) -> pa.Array:
        from tickweave.operators.layouts import read_layout

        return read_layout(t, payload)

    return F.arrow_udf(read, t.kind)(data)


def _of(frames: DataFrame, t: Layout, payload: str) -> DataFrame:
    """frames of the layout's id, with the message as one column."""
    ship(frames.sparkSession)
    data = F.col(payload)
    return frames.filter((F.length(data) >= HEAD) & (le(data, 2, 2) == t.id)).withColumn("_message", message(t, data))


def decode(frames: DataFrame, t: Layout, payload: str = "payload") -> DataFrame:
    """Rows of one layout: frames' other columns, fields, groups as arrays of structs, data as text, constants, decode_error."""
    rest = [c for c in frames.columns if c != payload]
    constants = [F.lit(v).alias(n) for n, v in t.constants]
    return _of(frames, t, payload).select(*rest, *(F.col("_message")[n].alias(n) for n in t.kind.names), *constants)


def _filled(pattern: str, value) -> Column:
    """pattern with {name} replaced by a field's value, {name*exponent} by its value at that field's power of ten with six decimals, and {#name} by a group's size."""
    parts = re.split(r"\{([^{}]+)\}", pattern)
    out = [F.lit(parts[0])]
    for spec, text in zip(parts[1::2], parts[2::2], strict=True):
        name, _, exponent = spec.partition("*")
        one = F.size(value(name[1:])) if name[0] == "#" else six_decimals(scaled(value(name), value(exponent))) if exponent else value(name)
        out += [F.coalesce(one.cast("string"), F.lit("-")), F.lit(text)]
    return F.concat(*out)


def _entry(pattern: str, fields: set[str], m: Column):
    """The line of a group's entry, as a function of one."""
    return lambda x: _filled(pattern, lambda n: x[n] if n in fields else m[n])


def printed(frames: DataFrame, t: Layout, head: str, entries: dict[str, str] | None = None, shown: int = 5, payload: str = "payload") -> DataFrame:
    """frames' other columns and line: the pattern `head` filled in, and for each group of `entries` a line for each of its first `shown` entries.

    Patterns are data, too: {name}, {name*exponent}, {#group}. Entries see the message's fields besides their own. A message with an error prints that.
    """
    rest = [c for c in frames.columns if c != payload]
    m = F.col("_message")
    own = set(t.kind.names)
    lines = [F.array(_filled(head, lambda n: m[n]))]
    for name, pattern in (entries or {}).items():
        fields = {f.name for g in t.groups if g.name == name for f in g.fields}
        if not fields or not set(re.findall(r"[\w]+", " ".join(re.findall(r"\{([^{}]+)\}", pattern)))) <= fields | own:
            raise ValueError(f"no group {name}, or a name in its pattern that isn't in the layout")
        lines.append(F.transform(F.slice(m[name], 1, shown), _entry(pattern, fields, m)))
        lines.append(F.when(F.size(m[name]) > shown, F.array(F.lit("  ..."))).otherwise(F.array().cast("array<string>")))
    text = F.array_join(F.concat(*lines), "\n")
    return _of(frames, t, payload).select(*rest, F.when(m["decode_error"].isNull(), text).otherwise(F.concat(F.lit(f"{t.name}: "), m["decode_error"])).alias("line"))
