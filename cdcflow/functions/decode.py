"""Packed MySQL cell bytes to typed values, with Spark column functions only.

Sizes and metadata are ints where a table's column is decoded on its own, and columns where the
cells of many table columns are mixed; both build the same expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.functions.values import utf8_text

# Fixed values of the MySQL row format.
DIGITS_PER_GROUP = 9
MAX_DIGITS, MAX_SCALE = 65, 30
DIGITS_TO_BYTES = [0, 1, 1, 2, 2, 3, 3, 4, 4, 4]
TYPE_CODES = {"ENUM": 247, "SET": 248, "VAR_STRING": 253, "STRING": 254, "GEOMETRY": 255}
INTEGER_BYTES = {"TINY": 1, "SHORT": 2, "INT24": 3, "LONG": 4, "LONGLONG": 8}
VARIABLE_TEXT = ["VARCHAR", "VAR_STRING"]
BLOBS = ["BLOB", "GEOMETRY", "JSON"]
OTHER_TYPES = [
    "BIT", "FLOAT", "DOUBLE", "NEWDECIMAL", "DATE", "TIME", "TIME_V2", "TIMESTAMP", "TIMESTAMP_V2",
    "DATETIME", "DATETIME_V2", "YEAR", "STRING", "ENUM", "SET",
]
NUMBER_TYPES = [*INTEGER_BYTES, "FLOAT", "DOUBLE", "DATE", "TIME", "TIMESTAMP", "DATETIME", "YEAR", "ENUM", "SET"]
KNOWN_TYPES = [*INTEGER_BYTES, *VARIABLE_TEXT, *BLOBS, *OTHER_TYPES]

Size = int | Column


def _col(n: Size) -> Column:
    return n if isinstance(n, Column) else F.lit(n)


def _per_size(size: Size, choices: list[int], build: Callable[[int], Column]) -> Column:
    """``build`` for a fixed size, or one branch per possible size."""
    if not isinstance(size, Column):
        return build(size)
    out = F.when(size == choices[0], build(choices[0]))
    for n in choices[1:]:
        out = out.when(size == n, build(n))
    return out


# -- integers ---------------------------------------------------------------------------------


def uint_be(raw: Column, start: Size, length: Size) -> Column:
    """Unsigned big-endian number of up to 7 bytes; ``start`` counts from 1."""
    return F.conv(F.hex(F.substring(raw, _col(start), _col(length))), 16, 10).cast("bigint")


def _backwards(raw: Column, start: int, size: int) -> Column:
    return F.concat(*[F.substring(raw, start + i, 1) for i in reversed(range(size))])


def uint_le(raw: Column, start: int, size: int) -> Column:
    """Unsigned little-endian number of up to 7 bytes."""
    return F.conv(F.hex(_backwards(raw, start, size)), 16, 10).cast("bigint")


def _signed64(raw: Column) -> Column:
    """Up to 8 big-endian bytes as a long, the upper half of 8 bytes negative."""
    return F.conv(F.hex(raw), 16, -10).cast("bigint")


def number_le(raw: Column) -> Column:
    """All bytes of a cell, at most 8, as a little-endian number; 8 bytes may come out negative."""
    return _signed64(_backwards(raw, 1, 8))


def fold_sign(v: Column, size: int) -> Column:
    """Unsigned number of ``size`` bytes to the signed one with the same bits."""
    return F.when(v >= 1 << (8 * size - 1), v - (1 << (8 * size))).otherwise(v) if size < 8 else v


def enum_label(ordinal: Column, labels: Column) -> Column:
    """Label of a 1-based ordinal; null for the empty value 0."""
    return F.when(ordinal > 0, F.try_element_at(labels, ordinal.cast("int")))


def set_labels(mask: Column, labels: Column) -> Column:
    """Labels whose bit is set, in declared order."""
    return F.filter(labels, lambda _, i: F.call_function("shiftright", mask, i).bitwiseAND(1) == 1)


def signed_le(raw: Column, size: int) -> Column:
    """Signed little-endian integer of 1 to 8 bytes."""
    return fold_sign(number_le(raw), size)


def bits(raw: Column) -> Column:
    """BIT column as a number; a 64th bit becomes the sign."""
    return _signed64(raw)


def year_value(v: Column) -> Column:
    """Year of the one-byte number stored for it."""
    return v + 1900


# -- floating point and decimals --------------------------------------------------------------


def _ieee(negative: Column, exponent: Column, mantissa: Column, mantissa_bits: int, bias: int) -> Column:
    scale = lambda e: F.pow(F.lit(2.0), e - (bias + mantissa_bits))
    special = F.when(mantissa == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    size = (
        F.when(exponent == 2 * bias + 1, special)
        .when(exponent == 0, mantissa.cast("double") * scale(F.lit(1)))
        .otherwise((mantissa + (1 << mantissa_bits)).cast("double") * scale(exponent))
    )
    return F.when(negative, -size).otherwise(size)


def float_value(v: Column) -> Column:
    """The float whose 32 bits are this number; scaling by a power of two is exact."""
    exponent, mantissa = F.shiftright(v, 23).bitwiseAND(255), v.bitwiseAND((1 << 23) - 1)
    return _ieee(F.shiftright(v, 31) == 1, exponent, mantissa, 23, 127).cast("float")


def double_value(v: Column) -> Column:
    """The double whose 64 bits are this number."""
    exponent, mantissa = F.shiftright(v, 52).bitwiseAND(2047), v.bitwiseAND((1 << 52) - 1)
    return _ieee(v < 0, exponent, mantissa, 52, 1023)


def _negative(packed: Column) -> Column:
    return F.substring(packed, 1, 1) < "8"


def _unmasked(packed: Column) -> Column:
    """Hex digits with the inverted sign bit put right, and all bits of negative numbers."""
    inverse = F.translate(packed, "0123456789ABCDEF", "FEDCBA9876543210")
    plain = F.when(_negative(packed), inverse).otherwise(packed)
    first = F.translate(F.substring(plain, 1, 1), "0123456789ABCDEF", "89ABCDEF01234567")
    return F.concat(first, F.substr(plain, F.lit(2)))


def _group(packed: Column, start: Size, size: Size, digits: Size) -> Column:
    """The decimal digits of one big-endian group of bytes."""
    group = F.substr(packed, _col(start * 2 + 1), _col(size * 2))
    return F.lpad(F.conv(group, 16, 10), digits, "0")


def _signed_text(negative: Column, integer: Column, fraction: Column, scale: Column) -> Column:
    integer = F.ltrim(integer, F.lit("0"))
    integer = F.when(integer == "", "0").otherwise(integer)
    plain = F.when(scale > 0, F.concat(integer, F.lit("."), fraction)).otherwise(integer)
    return F.when(negative & plain.rlike("[1-9]"), F.concat(F.lit("-"), plain)).otherwise(plain)


def decimal_text(raw: Column, precision: int, scale: int) -> Column:
    """Plain text of a packed decimal of any MySQL precision (up to 65 digits).

    The digits are cut into groups of nine from the point outwards, each group big-endian.
    """
    packed = F.hex(raw)
    digits, start = _unmasked(packed), 0
    sides = []
    for count, lead_first in ((precision - scale, True), (scale, False)):
        full, part = divmod(count, DIGITS_PER_GROUP)
        sizes = [DIGITS_PER_GROUP] * full
        sizes = [part, *sizes] if lead_first else [*sizes, part]
        texts = [F.lit("")]
        for n in filter(None, sizes):
            texts.append(_group(digits, start, DIGITS_TO_BYTES[n], n))
            start += DIGITS_TO_BYTES[n]
        sides.append(F.concat(*texts))
    return _signed_text(_negative(packed), *sides, F.lit(scale))


def _mixed_decimals(cells: DataFrame) -> DataFrame:
    """Add ``decimal_text`` where precision and scale differ by row (``meta`` is scale * 256 + precision).

    With the whole part padded to the widest decimal, its groups lie at fixed places in all rows.
    """
    is_decimal = F.col("mysql_type") == "NEWDECIMAL"
    most_whole, most_fraction = MAX_DIGITS // DIGITS_PER_GROUP + 1, MAX_SCALE // DIGITS_PER_GROUP
    whole, scale = F.col("_whole"), F.col("_scale")
    bytes_of = lambda n: F.call_function("div", n, F.lit(DIGITS_PER_GROUP)) * 4 + F.element_at(
        F.array(*map(F.lit, DIGITS_TO_BYTES)), n % DIGITS_PER_GROUP + 1
    )
    staged = cells.withColumns(
        {
            "_packed": F.when(is_decimal, F.hex("raw")),
            "_scale": F.when(is_decimal, F.shiftright("meta", 8)),
            "_whole": F.when(is_decimal, F.col("meta").bitwiseAND(255) - F.shiftright("meta", 8)),
        }
    )
    staged = staged.withColumns({"_digits": _unmasked(F.col("_packed")), "_point": (bytes_of(whole) * 2).cast("int")})
    staged = staged.withColumns(
        {
            "_left": F.lpad(F.substr("_digits", F.lit(1), F.col("_point")), 8 * most_whole, "0"),
            "_right": F.substr("_digits", F.col("_point") + 1),
        }
    )
    groups_right = F.call_function("div", scale, F.lit(DIGITS_PER_GROUP)).cast("int")
    tail = scale % DIGITS_PER_GROUP
    one = lambda text, i: _group(F.col(text), 4 * i, 4, DIGITS_PER_GROUP)
    left = [
        F.when(whole > DIGITS_PER_GROUP * (most_whole - 1 - i), one("_left", i)).otherwise("") for i in range(most_whole)
    ]
    right = [F.when(groups_right > i, one("_right", i)).otherwise("") for i in range(most_fraction)]
    last = F.lpad(F.conv(F.substr("_right", groups_right * 8 + 1), 16, 10), tail, "0")
    present = F.col("_packed").isNotNull()
    staged = staged.withColumns(
        {
            "_left": F.when(present, F.concat(*left)),
            "_right": F.when(present, F.concat(*right, F.when(tail > 0, last).otherwise(""))),
        }
    )
    text = _signed_text(_negative(F.col("_packed")), F.col("_left"), F.col("_right"), scale)
    return staged.withColumn("decimal_text", F.when(present, text)).drop(
        "_packed", "_scale", "_whole", "_digits", "_point", "_left", "_right"
    )


def decimal_value(raw: Column, precision: int, scale: int) -> Column:
    """Packed decimal as DECIMAL; one wider than Spark's 38 digits stays text."""
    text = decimal_text(raw, precision, scale)
    return text.cast(f"decimal({precision},{scale})") if precision <= 38 else text


# -- dates and times --------------------------------------------------------------------------


@dataclass(frozen=True)
class TimeOptions:
    """How dates and times come out.

    ``zero_date`` stands in for dates with a zero part. ``zone`` reads TIMESTAMP_V2 as a wall
    clock there. ``micros`` keeps the digits below a millisecond, which are cut otherwise.
    """

    zero_date: str | None = None
    zone: str | None = None
    micros: bool = False


def _digits(v: Column, low: int, width: int) -> Column:
    """Decimal digits of a long: ``width`` of them above the lowest ``low``."""
    cut = F.call_function("div", v, F.lit(10**low)) if low else v
    return (cut % 10**width).cast("int")


def _kept(micros: Column, opts: TimeOptions) -> Column:
    return micros if opts.micros else micros - micros % 1000


def _fraction_bytes(fsp: Size) -> Column:
    return F.call_function("div", _col(fsp) + 1, F.lit(2)).cast("int")


def _by_bytes(n: Column, values: list[int]) -> Column:
    """The value for 0, 1, 2 or 3 fraction bytes."""
    return F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), n + 1)


def fraction_micros(raw: Column, start: Size, fsp: Size) -> Column:
    """Microseconds stored behind a packed time of ``fsp`` fractional digits."""
    n = _fraction_bytes(fsp)
    stored = F.when(n > 0, uint_be(raw, start, n)).otherwise(0)
    return stored * _by_bytes(n, [100**3, 100**2, 100, 1])


def _hms(hour: Column, minute: Column, second: Column) -> Column:
    return hour * 3600 + minute * 60 + second


def _day(year: Column, month: Column, day: Column) -> Column:
    """Date of its parts, null if one is zero; a day past the month's end runs on into the next."""
    y, m, d = (p.cast("int") for p in (year, month, day))
    first = F.make_date(F.nullif(y, F.lit(0)), F.nullif(m, F.lit(0)), F.lit(1))
    return F.date_add(first, F.nullif(d, F.lit(0)) - 1)


def _moment(date: Column, seconds: Column, micros: Column, opts: TimeOptions) -> Column:
    """Wall clock of a date, or what stands for a zero date."""
    us = (F.unix_date(date).cast("bigint") * 86_400 + seconds) * 1_000_000 + _kept(micros, opts)
    return F.coalesce(
        F.timestamp_micros(us).cast("timestamp_ntz"),
        F.when(seconds.isNotNull(), F.lit(opts.zero_date).cast("timestamp_ntz")),
    )


def _date_parts(v: Column) -> tuple[Column, ...]:
    """DATE number: 5 bits day, 4 bits month, the rest year."""
    return F.shiftright(v, 9), F.shiftright(v, 5).bitwiseAND(15), v.bitwiseAND(31)


def _datetime_parts(v: Column) -> tuple[tuple[Column, ...], Column]:
    """Old DATETIME number, the decimal digits YYYYMMDDhhmmss, as date parts and seconds of the day."""
    return (_digits(v, 10, 4), _digits(v, 8, 2), _digits(v, 6, 2)), _hms(_digits(v, 4, 2), _digits(v, 2, 2), _digits(v, 0, 2))


def _datetime_v2_parts(v: Column) -> tuple[tuple[Column, ...], Column]:
    """DATETIME bits: sign, 17 of year * 13 + month, 5 day, 5 hour, 6 minute, 6 second."""
    cut = lambda shift, width: F.shiftright(v, shift).bitwiseAND((1 << width) - 1)
    date = (F.call_function("div", cut(22, 17), F.lit(13)), cut(22, 17) % 13, cut(17, 5))
    return date, _hms(cut(12, 5), cut(6, 6), cut(0, 6))


def _time_seconds(v: Column) -> Column:
    """Old TIME number, the signed decimal digits hhmmss, as seconds."""
    size = F.abs(v)
    seconds = _hms(_digits(size, 4, 3), _digits(size, 2, 2), _digits(size, 0, 2))
    return F.when(v < 0, -seconds).otherwise(seconds)


def date_value(v: Column, opts: TimeOptions = TimeOptions()) -> Column:
    """DATE of its number."""
    return F.coalesce(_day(*_date_parts(v)), F.when(v.isNotNull(), F.lit(opts.zero_date).cast("date")))


def time_micros(v: Column) -> Column:
    """Old TIME of its number."""
    return _time_seconds(v).cast("bigint") * 1_000_000


def time_v2_micros(raw: Column, fsp: Size, opts: TimeOptions = TimeOptions()) -> Column:
    """TIME with fraction: 10 bits hour, 6 minute, 6 second, then the fraction.

    The stored number, fraction included, is offset by half its range, so a negative time is the
    distance below that.
    """
    n = _fraction_bytes(fsp)
    stored = uint_be(raw, 1, n + 3) - _by_bytes(n, [1 << 23, 1 << 31, 1 << 39, 1 << 47])
    size = F.abs(stored)
    clock = F.call_function("shiftright", size, n * 8)
    seconds = (
        F.shiftright(clock, 12).bitwiseAND(1023) * 3600
        + F.shiftright(clock, 6).bitwiseAND(63) * 60
        + clock.bitwiseAND(63)
    )
    fraction = (size - F.call_function("shiftleft", clock, n * 8)) * _by_bytes(n, [100**3, 100**2, 100, 1])
    micros = seconds * 1_000_000 + _kept(fraction, opts)
    return F.when(stored < 0, -micros).otherwise(micros)


def timestamp_value(v: Column) -> Column:
    """Old TIMESTAMP number: seconds."""
    return F.timestamp_seconds(v)


def timestamp_v2_value(raw: Column, fsp: Size, opts: TimeOptions = TimeOptions()) -> Column:
    """TIMESTAMP with fraction: 4 big-endian bytes of seconds, then the fraction."""
    micros = _kept(fraction_micros(raw, 5, fsp), opts)
    ts = F.timestamp_micros(uint_be(raw, 1, 4) * 1_000_000 + micros)
    return F.to_utc_timestamp(ts, opts.zone) if opts.zone else ts


def datetime_value(v: Column, opts: TimeOptions = TimeOptions()) -> Column:
    """Old DATETIME of its number."""
    date, seconds = _datetime_parts(v)
    return _moment(_day(*date), seconds, F.lit(0).cast("bigint"), opts)


def datetime_v2_value(raw: Column, fsp: Size, opts: TimeOptions = TimeOptions()) -> Column:
    """DATETIME with fraction: 5 big-endian bytes, then the fraction."""
    date, seconds = _datetime_v2_parts(uint_be(raw, 1, 5))
    return _moment(_day(*date), seconds, fraction_micros(raw, 6, fsp), opts)


def as_long(ts: Column, micros: bool = False) -> Column:
    """A date or time as epoch milliseconds, or microseconds."""
    return F.unix_micros(ts.cast("timestamp")) if micros else F.unix_millis(ts.cast("timestamp"))


# -- text and bytes ---------------------------------------------------------------------------


def payload(raw: Column, prefix_bytes: Size, sizes: list[int] = [1, 2, 3, 4]) -> Column:  # noqa: B006
    """The bytes behind a little-endian length prefix of 1 to 4 bytes."""
    return _per_size(
        prefix_bytes, sizes, lambda n: F.substring(raw, F.lit(1 + n), uint_le(raw, 1, n).cast("int"))
    )


def text_prefix(max_length: Column) -> Column:
    """Size of the length prefix of CHAR and VARCHAR cells."""
    return F.when(max_length < 256, 1).otherwise(2)


def expand_string_meta(cells: DataFrame) -> DataFrame:
    """Real type and length of STRING cells, whose ``meta`` also stands for ENUM, SET and long CHAR."""
    high, low = F.shiftright("meta", 8), F.col("meta").bitwiseAND(255)
    packed = (F.col("mysql_type") == "STRING") & (F.col("meta") >= 256)
    long_char = high.bitwiseAND(0x30) != 0x30
    code = F.when(long_char, high.bitwiseOR(0x30)).otherwise(high)
    name = F.when(code == TYPE_CODES["STRING"], "STRING")
    for type_name, value in TYPE_CODES.items():
        name = name.when(long_char & (code == value), type_name)
    name = name.when(code.isin(TYPE_CODES["ENUM"], TYPE_CODES["SET"]), F.when(code == TYPE_CODES["ENUM"], "ENUM").otherwise("SET"))
    name = name.when(~long_char, "STRING").otherwise(F.concat(F.lit("CODE_"), code.cast("string")))
    length = low.bitwiseOR(F.when(long_char, F.shiftleft(high.bitwiseAND(0x30).bitwiseXOR(0x30), 4)).otherwise(0))
    is_string = F.col("mysql_type") == "STRING"
    return cells.withColumns(
        {
            "mysql_type": F.when(packed, name).otherwise(F.col("mysql_type")),
            "length": F.when(packed, length).when(is_string, F.col("meta")).otherwise(F.col("length")),
        }
    )


# -- one table's columns ----------------------------------------------------------------------


def cell_value(raw: Column, mysql_type: str, meta: int = 0, times: TimeOptions = TimeOptions()) -> Column:
    """One column's cells, typed. The type is looked up here, not per row; an unknown one is an error.

    ``meta`` is as in ``raw_cell``; for STRING it may stand for ENUM, SET or a long CHAR.
    """
    number = number_le(raw)
    high, low = meta >> 8, meta & 255
    if mysql_type == "STRING" and meta >= 256:
        long_char = high & 0x30 != 0x30
        code = high | 0x30 if long_char else high
        names = {v: k for k, v in TYPE_CODES.items()}
        if long_char or names.get(code) in ("ENUM", "SET"):
            mysql_type = names.get(code, f"CODE_{code}")
        meta = low | (((high & 0x30) ^ 0x30) << 4 if long_char else 0)
    if mysql_type in INTEGER_BYTES:
        size = INTEGER_BYTES[mysql_type]
        return fold_sign(number, size).cast("bigint" if size == 8 else "int")
    if mysql_type in BLOBS:
        return payload(raw, meta)
    if mysql_type in (*VARIABLE_TEXT, "STRING"):
        return utf8_text(payload(raw, 1 if meta < 256 else 2))
    by_type: dict[str, Callable[[], Column]] = {
        "BIT": lambda: bits(raw),
        "YEAR": lambda: year_value(number).cast("int"),
        "ENUM": lambda: number.cast("int"),
        "SET": lambda: number,
        "FLOAT": lambda: float_value(number),
        "DOUBLE": lambda: double_value(number),
        "NEWDECIMAL": lambda: decimal_value(raw, low, high),
        "DATE": lambda: date_value(number, times),
        "TIME": lambda: time_micros(fold_sign(number, 3)),
        "TIME_V2": lambda: time_v2_micros(raw, meta, times),
        "TIMESTAMP": lambda: timestamp_value(number),
        "TIMESTAMP_V2": lambda: timestamp_v2_value(raw, meta, times),
        "DATETIME": lambda: datetime_value(number, times),
        "DATETIME_V2": lambda: datetime_v2_value(raw, meta, times),
    }
    if mysql_type not in by_type:
        raise ValueError(f"unsupported type {mysql_type}")
    return by_type[mysql_type]()


def decode_columns(
    df: DataFrame, types: dict[str, tuple[str, int]], times: TimeOptions = TimeOptions()
) -> DataFrame:
    """Replace a table's packed columns by typed ones; ``types`` gives (MySQL type, meta) by name."""
    return df.withColumns({name: cell_value(F.col(name), *type_, times) for name, type_ in types.items()})


# -- all cells in one pass --------------------------------------------------------------------


def unknown_cells(cells: DataFrame) -> DataFrame:
    """Cells of a type that cannot be decoded."""
    return expand_string_meta(cells).where(~F.col("mysql_type").isin(KNOWN_TYPES))


def decode_cells(
    cells: DataFrame,
    times: TimeOptions = TimeOptions(),
    integers_as_bytes: bool = False,
    text_as_bytes: bool = False,
    on_unknown: str = "error",
) -> DataFrame:
    """Add typed columns to raw cells, one of them filled per row by the cell's type.

    Null cells give nulls. An unknown type raises, or is left out with ``on_unknown='skip'``
    (see ``unknown_cells``).
    """
    cells = expand_string_meta(cells)
    kind, raw, meta, length = (F.col(c) for c in ("mysql_type", "raw", "meta", "length"))
    known = kind.isin(KNOWN_TYPES)
    if on_unknown == "skip":
        cells = cells.where(known)
    else:
        error = F.raise_error(F.concat(F.lit("unsupported type "), kind)).cast("boolean")
        cells = cells.where(F.when(known, True).otherwise(error))

    is_fraction_date = kind.isin("DATETIME_V2", "TIMESTAMP_V2")
    number_bytes = (
        F.when(kind.isin(NUMBER_TYPES), _backwards(raw, 1, 8))
        .when(kind == "BIT", raw)
        .when(kind == "DATETIME_V2", F.substring(raw, 1, 5))
        .when(kind == "TIMESTAMP_V2", F.substring(raw, 1, 4))
    )
    fraction_at = F.when(kind == "DATETIME_V2", 6).otherwise(5)
    # Step by step, as later columns refer to earlier ones many times.
    staged = _mixed_decimals(cells).withColumns(
        {
            "_n": _signed64(number_bytes),
            "_us": F.when(is_fraction_date, fraction_micros(raw, fraction_at, meta)).otherwise(0),
            "_time_v2": F.when(kind == "TIME_V2", time_v2_micros(raw, meta, times)),
        }
    )
    v, us = F.col("_n"), F.col("_us")
    old, new = _datetime_parts(v), _datetime_v2_parts(v)
    part = lambda i: (
        F.when(kind == "DATE", _date_parts(v)[i]).when(kind == "DATETIME", old[0][i]).when(kind == "DATETIME_V2", new[0][i])
    )
    staged = staged.withColumns(
        {
            "_date": _day(part(0), part(1), part(2)),
            "_seconds": F.when(kind == "DATETIME", old[1])
            .when(kind == "DATETIME_V2", new[1])
            .when(kind == "TIME", _time_seconds(fold_sign(v, 3))),
        }
    )
    date, seconds = F.col("_date"), F.col("_seconds")

    integers = F.when(kind == "YEAR", year_value(v)).when(kind.isin("ENUM", "SET", "BIT"), v)
    as_bytes = F.when(kind.isin(BLOBS), payload(raw, meta))
    if integers_as_bytes:
        as_bytes = as_bytes.when(kind.isin(*INTEGER_BYTES), raw)
    else:
        for type_name, size in INTEGER_BYTES.items():
            integers = integers.when(kind == type_name, fold_sign(v, size))

    chars = F.when(
        (kind == "STRING") | kind.isin(VARIABLE_TEXT),
        payload(raw, text_prefix(F.when(kind == "STRING", length).otherwise(meta)), [1, 2]),
    )
    if text_as_bytes:
        as_bytes, text = F.coalesce(as_bytes, chars), F.lit(None).cast("string")
    else:
        text = utf8_text(chars)

    stamp = F.timestamp_micros(v * 1_000_000 + _kept(us, times))
    shifted = F.to_utc_timestamp(stamp, times.zone) if times.zone else stamp
    zero_date = F.when((kind == "DATE") & v.isNotNull(), F.lit(times.zero_date).cast("date"))
    return staged.withColumns(
        {
            "int_value": integers,
            "double_value": F.when(kind == "FLOAT", float_value(v).cast("double")).when(kind == "DOUBLE", double_value(v)),
            "date_value": F.when(kind == "DATE", F.coalesce(date, zero_date)),
            "time_us": F.when(kind == "TIME", seconds * 1_000_000).when(kind == "TIME_V2", F.col("_time_v2")),
            "ts_value": F.when(kind == "TIMESTAMP", stamp).when(kind == "TIMESTAMP_V2", shifted),
            "datetime_value": F.when(kind.isin("DATETIME", "DATETIME_V2"), _moment(date, seconds, us, times)),
            "text_value": text,
            "bytes_value": as_bytes,
        }
    ).drop("_n", "_us", "_time_v2", "_date", "_seconds")


def cell_text(micros: bool = False) -> Column:
    """Emitted text of a decoded cell: date-times as epoch ms, bytes as UTF-8, times as microseconds."""
    return F.coalesce(
        F.col("int_value").cast("string"),
        F.col("decimal_text"),
        F.col("double_value").cast("string"),
        F.col("date_value").cast("string"),
        as_long(F.col("datetime_value"), micros).cast("string"),
        as_long(F.col("ts_value"), micros).cast("string"),
        F.col("time_us").cast("string"),
        F.col("text_value"),
        utf8_text(F.col("bytes_value")),
    )


def row_images(decoded: DataFrame, by: list[str]) -> DataFrame:
    """The cells of each row as one map of text by column; a row has no more cells than its table columns."""
    cell = F.struct("column_name", cell_text().alias("text"))
    return decoded.groupBy(*by).agg(F.map_from_entries(F.collect_list(cell)).alias("image"))
