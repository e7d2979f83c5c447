"""Shared by the operators: word rules and an Arrow map that appends a struct column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tickweave.plans.session import ship

#: ASCII letters lower-cased, other ASCII but digits to a space; all bytes of non-ASCII characters stay.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: The same set as a regular expression, for lower-cased text.
WORD_RE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of WORD_RE after lower-casing A-Z; null has none."""
    return text.translate(WORD_BYTES).split() if text else []


def free_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _pieces(batches, at: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Record batches whose texts have about `limit` bytes, each of one row at least."""
    for b in batches:
        n, start = b.num_rows, 0
        if not n:
            continue
        size = b.column(at).nbytes
        step = max(1, min(n, int(n * limit / max(size, 1))))
        while start < n:
            yield b.slice(start, step)
            start += step


def annotate(df: DataFrame, name: str, kind: T.StructType, make: Callable[[], Callable], text: str = "text", limit: int = 16 << 20) -> DataFrame:
    """df with a struct column `name`.

    make() is called once a task and gives f(texts as bytes or None) -> one sequence for each field of `kind`.
    No rows move between tasks; f sees texts of about `limit` bytes at a time.
    """
    ship(df.sparkSession)
    at = df.columns.index(text)
    types = [(f.name, to_arrow_type(f.dataType)) for f in kind.fields]

    def run(batches):
        f = make()
        for b in _pieces(batches, at, limit):
            got = f(b.column(at).cast(pa.binary()).to_pylist())
            arrays = [x if isinstance(x, pa.Array) else pa.array(x, type=t) for x, (_, t) in zip(got, types, strict=True)]
            col = pa.StructArray.from_arrays(arrays, fields=[pa.field(n, t) for n, t in types])
            yield pa.RecordBatch.from_arrays([*b.columns, col], names=[*b.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, kind, True)]))


def cells(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns that the operators read, as doc_id and text."""
    return df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))


def row_salt() -> Column:
    """A salt that differs between all rows, repeated ones too: their numbers, which are the same again when a scan's task is run again."""
    return F.monotonically_increasing_id()


def salted_join(rows: DataFrame, groups: DataFrame, key: str, salt: Column, how: str = "inner", salts: int = 16) -> DataFrame:
    """rows joined with groups, which has one row a key, so that a key with many rows goes to `salts` tasks.

    salt: of rows, a column that differs between the rows of a key. The salts spread what fits a few tasks; a key that is larger still is split
    further when it is read: both sides are shuffled for this sort-merge join alone, so adaptive execution cuts a skewed partition of rows.
    """
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int"))
    right = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


#: Bits of a key map; 2^26 are 2,048 rows of 4,096 bytes, so at most 8 MB are broadcast at any input size.
MAP_BITS = 1 << 26
_ROW_BITS = 8 * 4096


def bit_rows(slots: DataFrame) -> DataFrame:
    """_row, _bits (4,096 bytes) of a table with a column slot."""
    return (
        slots.select((F.col("slot") / _ROW_BITS).cast("int").alias("_row"), (F.col("slot") % _ROW_BITS).alias("bit"))
        .groupBy("_row").agg(F.bitmap_construct_agg("bit").alias("_bits"))
    )


def key_map(keys: DataFrame, *key: str) -> DataFrame:
    """A bitmap of fixed size in which the keys' hashes are set."""
    return bit_rows(keys.select(F.pmod(F.xxhash64(*key), F.lit(MAP_BITS)).alias("slot")))


def in_map(df: DataFrame, maps: DataFrame, flag: str, *key: str) -> DataFrame:
    """df with a boolean: false if the key isn't in the map; true may be a false alarm, which only costs work."""
    bit = F.col("_slot") % _ROW_BITS
    byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    joined = df.withColumn("_slot", F.pmod(F.xxhash64(*key), F.lit(MAP_BITS))).withColumn("_row", (F.col("_slot") / _ROW_BITS).cast("int")).join(F.broadcast(maps), "_row", "left")
    return joined.withColumn(flag, F.col("_bits").isNotNull() & (F.getbit(byte, (bit % 8).cast("int")) == 1)).drop("_slot", "_row", "_bits")
