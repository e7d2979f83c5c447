"""Column builders for little-endian binary fields, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _swap(h: Column, n: int) -> Column:
    return F.concat(*(F.substring(h, 2 * k - 1, 2) for k in range(n, 0, -1)))


def le(data: Column, offset: Column | int, n: int, signed: bool = False) -> Column:
    """The n-byte integer at a zero-based offset, as BIGINT; null where the bytes don't reach."""
    off = F.lit(offset) if isinstance(offset, int) else offset
    h = _swap(F.hex(F.substring(data, (off + 1).cast("int"), F.lit(n))), n)
    v = F.conv(h, 16, -10 if n == 8 else 10).cast("bigint")
    if signed and n < 8:
        v = F.when(v >= 1 << (8 * n - 1), v - (1 << (8 * n))).otherwise(v)
    return F.when(F.length(data) >= off + n, v)


def hex_le(value: Column, n: int) -> Column:
    """Hexadecimal text of value's n low bytes, least first."""
    return _swap(F.right(F.lpad(F.hex(value.cast("bigint")), 16, "0"), F.lit(2 * n)), n)


def var_string(data: Column, offset: Column) -> Column:
    """A length byte and its bytes as text; empty if they don't fit."""
    n = le(data, offset, 1)
    return F.when(F.length(data) >= offset + 1 + n, F.substring(data, (offset + 2).cast("int"), n.cast("int")).cast("string")).otherwise(F.lit(""))


def scaled(mantissa: Column, exponent: Column) -> Column:
    """mantissa times ten to the exponent, in DOUBLE; a negative power is the reciprocal, as pow(10, -5) isn't the double nearest to it."""
    power = F.pow(F.lit(10.0), F.abs(exponent).cast("double"))
    return mantissa.cast("double") * F.when(exponent < 0, F.lit(1.0) / power).otherwise(power)


def scaled_exact(mantissa: Column, exponent: Column) -> Column:
    """The same as DECIMAL(38,18) for exponents 0 to -18; null for others."""
    cases = F.when(exponent == 0, mantissa.cast("decimal(38,18)"))
    for k in range(1, 19):
        cases = cases.when(exponent == -k, (mantissa.cast("decimal(19,0)") * F.expr(f"cast('1E-{k}' as decimal(18,18))")).cast("decimal(38,18)"))
    return cases


def six_decimals(v: Column) -> Column:
    """Text with six decimals, rounded as the exact binary value is."""
    return F.regexp_replace(F.format_number(v, 6), ",", "")

