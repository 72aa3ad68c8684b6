"""Plain columns packed into MySQL cell bytes, as input for the decoding queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cdcflow.functions.decode import DIGITS_PER_GROUP, DIGITS_TO_BYTES


def big_endian(n: Column, size: int) -> Column:
    """The low ``size`` bytes of a number, negative ones in two's complement."""
    return F.substring(F.unhex(F.lpad(F.hex(n.cast("bigint")), 16, "0")), 9 - size, size)


# The lower half of every byte.
LOW_HALVES = 0x0F0F0F0F0F0F0F0F


def little_endian(n: Column, size: int) -> Column:
    """The same, lowest byte first: hex digits turned round, after the two of each byte have changed places."""
    n = n.cast("bigint")
    swapped = F.shiftright(n, 4).bitwiseAND(LOW_HALVES).bitwiseOR(F.shiftleft(n.bitwiseAND(LOW_HALVES), 4))
    return F.substring(F.unhex(F.reverse(F.lpad(F.hex(swapped), 16, "0"))), 1, size)


def prefixed(data: Column, prefix_bytes: int) -> Column:
    """Bytes behind their little-endian length."""
    return F.concat(little_endian(F.octet_length(data), prefix_bytes), data)


def packed_decimal(value: Column, precision: int, scale: int) -> Column:
    """A DECIMAL(precision, scale) column in its packed form."""
    digits = F.lpad(F.translate(F.abs(value).cast(f"decimal({precision},{scale})").cast("string"), ".", ""), precision, "0")
    whole, left = divmod(precision - scale, DIGITS_PER_GROUP)
    full, right = divmod(scale, DIGITS_PER_GROUP)
    start, groups = 1, []
    for n in [left, *[DIGITS_PER_GROUP] * (whole + full), right]:
        if n:
            size, group = DIGITS_TO_BYTES[n], F.substring(digits, start, n).cast("bigint")
            # The first bit of all, which no group of digits reaches, is set.
            groups.append(F.lpad(F.hex(group if groups else group + (1 << (8 * size - 1))), 2 * size, "0"))
            start += n
    text = F.concat(*groups)
    inverse = F.translate(text, "0123456789ABCDEF", "FEDCBA9876543210")
    return F.unhex(F.when(value < 0, inverse).otherwise(text))


def packed_date(d: Column) -> Column:
    return little_endian(F.year(d) * 512 + F.month(d) * 32 + F.dayofmonth(d), 3)


def packed_datetime(ts: Column) -> Column:
    """Old DATETIME: decimal digits YYYYMMDDhhmmss."""
    day = (F.year(ts).cast("bigint") * 100 + F.month(ts)) * 100 + F.dayofmonth(ts)
    return little_endian(((day * 100 + F.hour(ts)) * 100 + F.minute(ts)) * 100 + F.second(ts), 8)


def packed_fraction(micros: Column, fsp: int) -> Column:
    size = (fsp + 1) // 2
    return big_endian(F.call_function("div", micros, F.lit(100 ** (3 - size))), size)


def packed_datetime_v2(ts: Column, fsp: int) -> Column:
    day = (F.year(ts).cast("bigint") * 13 + F.month(ts)) * 32 + F.dayofmonth(ts)
    whole = ((day * 32 + F.hour(ts)) * 64 + F.minute(ts)) * 64 + F.second(ts)
    return F.concat(big_endian(whole + (1 << 39), 5), packed_fraction(F.unix_micros(ts.cast("timestamp")) % 1_000_000, fsp))


def packed_timestamp_v2(ts: Column, fsp: int) -> Column:
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.concat(big_endian(F.call_function("div", micros, F.lit(1_000_000)), 4), packed_fraction(micros % 1_000_000, fsp))


def packed_time_v2(seconds: Column) -> Column:
    """TIME without fraction, of a signed number of seconds."""
    size = F.abs(seconds)
    clock = (F.call_function("div", size, F.lit(3600)) * 64 + F.call_function("div", size, F.lit(60)) % 60) * 64 + size % 60
    return big_endian(F.when(seconds < 0, -clock).otherwise(clock) + (1 << 23), 3)


def packed_time(seconds: Column) -> Column:
    """Old TIME: decimal digits hhmmss."""
    hms = F.call_function("div", seconds, F.lit(3600)) * 10000 + F.call_function("div", seconds, F.lit(60)) % 60 * 100
    return little_endian(hms + seconds % 60, 3)
