"""Change-log wire encodings and their conversion to logical column types.

The connector's default encodings (public documentation of the connector):

* ``DATE``         integer days since 1970-01-01
* ``TIMESTAMP(3)`` integer milliseconds since 1970-01-01 00:00:00 UTC
* ``DECIMAL``      ``{"scale": n, "value": base64 of the big-endian two's-complement integer}``

``encoding="iso"`` covers producers that write dates, timestamps and decimals as text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONNECT = "connect"
ISO = "iso"

_WIRE_DECIMAL = T.StructType(
    [T.StructField("scale", T.IntegerType()), T.StructField("value", T.StringType())]
)
_TWO_POW_64 = "18446744073709551616"
_MOST_MILLIS = (2**63 - 1) // 1000

# No decimal has more digits; a scale beyond that is damage.
_MOST_SCALE = 76


def _check(encoding: str) -> None:
    if encoding not in (CONNECT, ISO):
        raise ValueError(f"encoding must be {CONNECT!r} or {ISO!r}, got {encoding!r}")


def wire_schema(schema: T.StructType, encoding: str = CONNECT) -> T.StructType:
    """Schema the JSON row image is parsed with."""
    _check(encoding)
    if encoding == ISO:
        return T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    return T.StructType([T.StructField(f.name, _wire_type(f.dataType)) for f in schema])


def _wire_type(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.DateType):
        return T.IntegerType()
    if isinstance(dtype, T.TimestampType):
        return T.LongType()
    if isinstance(dtype, T.DecimalType):
        return _WIRE_DECIMAL
    return dtype


def decode(value: Column, dtype: T.DataType, encoding: str = CONNECT) -> Column:
    """Convert one parsed wire column to its logical type; anything unreadable becomes NULL."""
    _check(encoding)
    if encoding == CONNECT:
        if isinstance(dtype, T.DateType):
            return F.date_from_unix_date(value)
        if isinstance(dtype, T.TimestampType):
            # Beyond this a timestamp has no microseconds that fit, and the call would fail.
            return F.when(value.between(-_MOST_MILLIS, _MOST_MILLIS), F.timestamp_millis(value))
        if isinstance(dtype, T.DecimalType):
            return decode_decimal(value.getField("value"), value.getField("scale"), dtype)
    return value


def decode_decimal(encoded: Column, scale: Column, dtype: T.DecimalType) -> Column:
    """Base64 two's-complement bytes and a scale to an exact decimal.

    The bytes are sign-extended to 128 bits and read as two 64-bit halves, so every number a Spark
    decimal can hold is exact. Longer or malformed input gives NULL.
    """
    digits = F.hex(F.try_to_binary(encoded, F.lit("base64")))
    negative = F.substring(digits, 1, 1) >= "8"
    padded = F.lpad(digits, 32, F.when(negative, F.lit("F")).otherwise(F.lit("0")))
    high = F.conv(F.substring(padded, 1, 16), 16, 10).cast("decimal(20,0)")
    low = F.conv(F.substring(padded, 17, 16), 16, 10).cast("decimal(20,0)")
    shift = F.lit(_TWO_POW_64).cast("decimal(20,0)")
    signed_high = (high - F.when(negative, shift).otherwise(F.lit(0).cast("decimal(20,0)"))).cast(
        "decimal(20,0)"
    )
    unscaled = F.try_add(F.try_multiply(signed_high, shift), low)
    sane = scale.between(-_MOST_SCALE, _MOST_SCALE)
    text = F.concat(unscaled.cast("string"), F.lit("E"), F.when(sane, -scale).cast("string"))
    fits = (F.length(digits) > 0) & (F.length(digits) <= 32)
    return F.when(fits, text.try_cast(dtype))


def encode(value: Column, dtype: T.DataType, encoding: str = CONNECT) -> Column:
    """Inverse of :func:`decode` for producers of change records."""
    _check(encoding)
    if encoding == CONNECT:
        if isinstance(dtype, T.DateType):
            return F.unix_date(value)
        if isinstance(dtype, T.TimestampType):
            return F.unix_millis(value)
        if isinstance(dtype, T.DecimalType):
            return _encode_decimal(value, dtype)
    return value


def _encode_decimal(value: Column, dtype: T.DecimalType) -> Column:
    if dtype.precision > 18:
        raise ValueError("decimals above 18 digits are decoded but not encoded")
    typed = value.cast(dtype)
    factor = F.lit(str(10**dtype.scale)).cast(f"decimal({dtype.scale + 1},0)")
    digits = F.lpad(F.hex((typed * factor).cast("long")), 16, "0")
    return F.when(
        typed.isNotNull(),
        F.struct(
            F.lit(dtype.scale).alias("scale"), F.base64(F.unhex(digits)).alias("value")
        ),
    )
