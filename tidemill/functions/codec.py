"""Cell value encoding: UTF-8 strings and big-endian integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions.columns import as_column


def encode_string(c: Column | str) -> Column:
    return F.encode(as_column(c).cast("string"), "UTF-8")


def encode_long(c: Column | str) -> Column:
    """8 bytes, big-endian, two's complement."""
    return F.unhex(F.lpad(F.hex(as_column(c).cast("long")), 16, "0"))


def encode_int(c: Column | str) -> Column:
    """4 bytes, big-endian, two's complement (``hex`` of a negative number
    has 16 digits, of which the last 8 count)."""
    digits = F.lpad(F.hex(as_column(c).cast("int").cast("long")), 16, "0")
    return F.unhex(F.substring(digits, 9, 8))


def decode_string(c: Column | str) -> Column:
    return F.decode(as_column(c), "UTF-8")


def decode_long(c: Column | str) -> Column:
    return F.conv(F.hex(as_column(c)), 16, -10).cast("long")


def decode_int(c: Column | str) -> Column:
    unsigned = F.conv(F.hex(as_column(c)), 16, 10).cast("long")
    return F.when(unsigned >= 1 << 31, unsigned - (1 << 32)).otherwise(unsigned).cast("int")


ENCODERS = {"string": encode_string, "int": encode_int, "long": encode_long}
DECODERS = {"string": decode_string, "int": decode_int, "long": decode_long}
