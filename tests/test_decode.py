"""Cells packed by an encoder of its own, in plain Python."""

import datetime as dt
import decimal
import math
import struct

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdcflow.functions import decode as D
from cdcflow.plans import packing as K

CELL = "event_id bigint, row_seq int, column_name string, mysql_type string, meta int, length int, raw binary"
PART_BYTES = [0, 1, 1, 2, 2, 3, 3, 4, 4, 4]


def cells(spark, *items):
    """(mysql_type, meta, length, raw) as a frame, numbered."""
    data = [(i, 0, "c", t, m, n, None if raw is None else bytearray(raw)) for i, (t, m, n, raw) in enumerate(items)]
    return spark.createDataFrame(data, CELL)


def decoded(spark, column, *items, **options):
    out = D.decode_cells(cells(spark, *items), **options).orderBy("event_id")
    return [r[0] for r in out.select(column).collect()]


def pack_decimal(text, precision, scale):
    d = decimal.Decimal(text)
    digits = str(abs(int(d.scaleb(scale, decimal.Context(prec=70))))).rjust(precision, "0")
    whole, fraction = digits[: precision - scale], digits[precision - scale :]
    out = b""
    lead = len(whole) % 9
    for part in [whole[:lead], *[whole[i : i + 9] for i in range(lead, len(whole), 9)]]:
        out += int(part).to_bytes(PART_BYTES[len(part)], "big") if part else b""
    for i in range(0, len(fraction), 9):
        part = fraction[i : i + 9]
        out += int(part).to_bytes(PART_BYTES[len(part)], "big")
    out = bytes([out[0] ^ 0x80]) + out[1:]
    return bytes(b ^ 0xFF for b in out) if d < 0 else out


def pack_time_v2(micros, fsp):
    n = (fsp + 1) // 2
    unit = 10 ** (6 - 2 * n)
    seconds, us = divmod(abs(micros), 1_000_000)
    clock = (seconds // 3600) << 12 | (seconds // 60 % 60) << 6 | seconds % 60
    number = (clock << (8 * n)) + us // unit
    return ((1 << (23 + 8 * n)) + (-number if micros < 0 else number)).to_bytes(3 + n, "big")


def pack_datetime_v2(t, fsp):
    n = (fsp + 1) // 2
    day = ((t.year * 13 + t.month) << 5 | t.day) << 17
    number = 1 << 39 | day | t.hour << 12 | t.minute << 6 | t.second
    return number.to_bytes(5, "big") + (t.microsecond // 10 ** (6 - 2 * n)).to_bytes(n, "big")


@pytest.mark.parametrize("name, size", D.INTEGER_BYTES.items())
def test_integers(spark, name, size):
    top = 1 << (8 * size - 1)
    values = [0, 1, -1, top - 1, -top, 42]
    packed = [(name, 0, 0, v.to_bytes(size, "little", signed=True)) for v in values]
    assert decoded(spark, "int_value", *packed) == values


def test_bits_year_enum_set(spark):
    got = decoded(
        spark, "int_value",
        ("BIT", (1 << 8) | 1, 0, b"\x01\x02"), ("YEAR", 0, 0, b"\x7c"), ("ENUM", 0, 2, b"\x00\x01"),
        ("SET", 0, 8, b"\xff" * 8), ("STRING", (247 << 8) | 1, 0, b"\x03"), ("STRING", (248 << 8) | 2, 0, b"\x05\x00"),
    )
    assert got == [258, 2024, 256, -1, 3, 5]


def test_labels(spark):
    labels = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    df = spark.createDataFrame([(0,), (1,), (3,), (5,)], "n bigint")
    got = [tuple(r) for r in df.select(D.enum_label(F.col("n"), labels), D.set_labels(F.col("n"), labels)).collect()]
    assert got == [(None, []), ("a", ["a"]), ("c", ["a", "b"]), (None, ["a", "c"])]


def test_floats(spark):
    values = [0.0, -0.0, 1.5, -2.25e-300, 5e-324, -5e-324, 1.7976931348623157e308, 2.2250738585072014e-308, math.inf, -math.inf, math.nan]
    got = decoded(spark, "double_value", *[("DOUBLE", 0, 0, struct.pack("<d", v)) for v in values])
    assert [struct.pack("<d", v) for v in got] == [struct.pack("<d", v) for v in values]
    singles = [0.0, -0.0, 3.140000104904175, 1.401298464324817e-45, 3.4028234663852886e38, -math.inf]
    assert decoded(spark, "double_value", *[("FLOAT", 0, 0, struct.pack("<f", v)) for v in singles]) == singles


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, width=64), min_size=20, max_size=200))
def test_any_double(spark, values):
    got = decoded(spark, "double_value", *[("DOUBLE", 0, 0, struct.pack("<d", v)) for v in values])
    assert [struct.pack("<d", v) for v in got] == [struct.pack("<d", v) for v in values]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.data())
def test_any_decimal(spark, data):
    items, texts = [], []
    for _ in range(60):
        precision = data.draw(st.integers(1, 65))
        scale = data.draw(st.integers(0, min(30, precision)))
        number = data.draw(st.integers(-(10**precision) + 1, 10**precision - 1))
        exact = decimal.Context(prec=70)
        value = decimal.Decimal(number).scaleb(-scale, exact)
        texts.append(f"{value:.{scale}f}" if scale else str(value))
        items.append(("NEWDECIMAL", scale << 8 | precision, 0, pack_decimal(value, precision, scale)))
    assert decoded(spark, "decimal_text", *items) == texts


@pytest.mark.parametrize("precision, scale, text", [(10, 2, "-1234.56"), (8, 8, "0.00000001"), (38, 10, "-9999999999999999999999999999.9999999999"), (20, 0, "12345678901234567890"), (65, 30, "-1." + "0" * 29 + "5"), (5, 2, "0.00")])
def test_decimal_of_one_column(spark, precision, scale, text):
    df = spark.createDataFrame([(bytearray(pack_decimal(text, precision, scale)),)], "raw binary")
    assert df.select(D.decimal_text(F.col("raw"), precision, scale)).first()[0] == text
    value = df.select(D.decimal_value(F.col("raw"), precision, scale)).first()[0]
    assert value == (decimal.Decimal(text) if precision <= 38 else text)


def test_dates(spark):
    pack = lambda y, m, d: (y << 9 | m << 5 | d).to_bytes(3, "little")
    items = [("DATE", 0, 0, pack(*p)) for p in [(2024, 2, 29), (9999, 12, 31), (0, 0, 0), (2024, 0, 1), (1000, 1, 1)]]
    days = [dt.date(2024, 2, 29), dt.date(9999, 12, 31), None, None, dt.date(1000, 1, 1)]
    assert decoded(spark, "date_value", *items) == days
    filled = decoded(spark, "date_value", *items, times=D.TimeOptions(zero_date="1970-01-01"))
    assert filled[2] == filled[3] == dt.date(1970, 1, 1)


@pytest.mark.parametrize("fsp", range(7))
def test_times(spark, fsp):
    unit = 10 ** (6 - 2 * ((fsp + 1) // 2))
    values = [0, 1_000_000, -1_000_000, -(838 * 3600 + 59 * 60 + 59) * 1_000_000, 45_296_123_456, -10_000, -990_000, 1]
    values = [int(v / unit) * unit for v in values]
    items = [("TIME_V2", fsp, 0, pack_time_v2(v, fsp)) for v in values]
    assert decoded(spark, "time_us", *items, times=D.TimeOptions(micros=True)) == values
    in_ms = [(abs(v) // 1000 * 1000) * (-1 if v < 0 else 1) for v in values]
    assert decoded(spark, "time_us", *items) == in_ms


def test_old_times(spark):
    pack = lambda n: n.to_bytes(3, "little", signed=True)
    got = decoded(spark, "time_us", *[("TIME", 0, 0, pack(n)) for n in (0, 123456, -8385959)])
    assert got == [0, 45_296_000_000, -(838 * 3600 + 59 * 60 + 59) * 1_000_000]


@pytest.mark.parametrize("fsp", range(7))
def test_datetimes(spark, fsp):
    unit = 10 ** (6 - 2 * ((fsp + 1) // 2))
    moments = [dt.datetime(2024, 2, 29, 23, 59, 58, 123456), dt.datetime(1583, 1, 1), dt.datetime(9999, 12, 31, 1, 2, 3)]
    cut = lambda t: t.replace(microsecond=t.microsecond // unit * unit)
    items = [("DATETIME_V2", fsp, 0, pack_datetime_v2(cut(t), fsp)) for t in moments]
    assert decoded(spark, "datetime_value", *items, times=D.TimeOptions(micros=True)) == [cut(t) for t in moments]
    ms = lambda t: cut(t).replace(microsecond=cut(t).microsecond // 1000 * 1000)
    assert decoded(spark, "datetime_value", *items) == [ms(t) for t in moments]


def test_zero_datetimes(spark):
    zero = [("DATETIME_V2", 0, 0, (1 << 39).to_bytes(5, "big")), ("DATETIME", 0, 0, bytes(8)), ("DATETIME", 0, 0, None)]
    assert decoded(spark, "datetime_value", *zero) == [None, None, None]
    filled = decoded(spark, "datetime_value", *zero, times=D.TimeOptions(zero_date="2000-01-01 00:00:00"))
    assert filled == [dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 1), None]


def test_timestamps(spark):
    seconds = 1_700_000_000
    items = [
        ("TIMESTAMP", 0, 0, seconds.to_bytes(4, "little")),
        ("TIMESTAMP_V2", 0, 0, seconds.to_bytes(4, "big")),
        ("TIMESTAMP_V2", 6, 0, seconds.to_bytes(4, "big") + (123456).to_bytes(3, "big")),
    ]
    as_us = lambda **o: [
        r[0] for r in D.decode_cells(cells(spark, *items), **o).orderBy("event_id").select(F.unix_micros("ts_value")).collect()
    ]
    assert as_us() == [seconds * 10**6, seconds * 10**6, seconds * 10**6 + 123_000]
    assert as_us(times=D.TimeOptions(micros=True))[2] == seconds * 10**6 + 123_456
    shifted = as_us(times=D.TimeOptions(zone="Asia/Shanghai"))
    assert shifted[:2] == [seconds * 10**6, 1_699_971_200 * 10**6]


def test_text_and_bytes(spark):
    long_text = ("é" * 200).encode()
    got = decoded(
        spark, "text_value",
        ("VARCHAR", 255, 0, b"\x02hi"), ("VARCHAR", 256, 0, len(long_text).to_bytes(2, "little") + long_text),
        ("STRING", (254 << 8) | 10, 0, b"\x03abc"), ("STRING", 20, 0, b"\x01x"), ("STRING", (0xEE << 8) | 0x2C, 0, b"\x02\x00ok"),
        ("VAR_STRING", 10, 0, b"\x00"), ("VARCHAR", 10, 0, None),
    )
    assert got == ["hi", "é" * 200, "abc", "x", "ok", "", None]
    blobs = [(t, n, 0, (3).to_bytes(n, "little") + b"\x00\x01\x02") for t, n in (("BLOB", 1), ("GEOMETRY", 4), ("JSON", 2), ("BLOB", 3))]
    assert decoded(spark, "bytes_value", *blobs) == [bytearray(b"\x00\x01\x02")] * 4
    assert decoded(spark, "bytes_value", ("VARCHAR", 9, 0, b"\x02hi"), text_as_bytes=True) == [bytearray(b"hi")]
    assert decoded(spark, "bytes_value", ("LONG", 0, 0, b"\x01\x02\x03\x04"), integers_as_bytes=True) == [bytearray(b"\x01\x02\x03\x04")]


def test_unknown_type(spark):
    items = [("WRONG", 0, 0, b"\x01"), ("TINY", 0, 0, b"\x01")]
    with pytest.raises(Exception, match="unsupported type WRONG"):
        decoded(spark, "int_value", *items)
    assert decoded(spark, "int_value", *items, on_unknown="skip") == [1]
    assert rows(D.unknown_cells(cells(spark, *items)), "mysql_type") == [("WRONG",)]


def test_one_column_at_a_time_agrees(spark):
    """``cell_value`` and ``decode_cells`` give the same for every type."""
    ts = dt.datetime(2024, 2, 29, 23, 59, 58, 123000)
    items = [
        *[(name, 0, 0, (-5).to_bytes(size, "little", signed=True)) for name, size in D.INTEGER_BYTES.items()],
        ("BIT", 257, 0, b"\x01\x02"), ("YEAR", 0, 0, b"\x7c"), ("ENUM", 0, 1, b"\x02"), ("SET", 0, 2, b"\x05\x00"),
        ("DOUBLE", 0, 0, struct.pack("<d", 1.5)), ("FLOAT", 0, 0, struct.pack("<f", -2.5)),
        ("NEWDECIMAL", (2 << 8) | 10, 0, pack_decimal("-1234.56", 10, 2)),
        ("DATE", 0, 0, (2024 << 9 | 2 << 5 | 29).to_bytes(3, "little")), ("TIME", 0, 0, (123456).to_bytes(3, "little")),
        ("TIME_V2", 3, 0, pack_time_v2(-5_120_000, 3)), ("TIMESTAMP", 0, 0, (1_700_000_000).to_bytes(4, "little")),
        ("TIMESTAMP_V2", 0, 0, (1_700_000_000).to_bytes(4, "big")), ("DATETIME", 0, 0, (20240229235958).to_bytes(8, "little")),
        ("DATETIME_V2", 3, 0, pack_datetime_v2(ts, 3)), ("STRING", (254 << 8) | 10, 0, b"\x03abc"),
        ("STRING", (247 << 8) | 1, 0, b"\x03"), ("STRING", (0xEE << 8) | 0x2C, 0, b"\x02\x00ok"), ("STRING", 20, 0, b"\x01x"),
        ("VARCHAR", 300, 0, b"\x02\x00hi"), ("VAR_STRING", 9, 0, b"\x01h"), ("BLOB", 2, 0, b"\x01\x00z"),
    ]
    mixed = D.decode_cells(cells(spark, *items)).orderBy("event_id").select(D.cell_text()).collect()
    df = spark.createDataFrame([tuple(bytearray(i[3]) for i in items)], ", ".join(f"c{n} binary" for n in range(len(items))))
    typed = D.decode_columns(df, {f"c{n}": (i[0], i[1]) for n, i in enumerate(items)})
    from cdcflow.functions.values import stringify

    assert list(stringify(typed).first()) == [r[0] for r in mixed]
    with pytest.raises(ValueError, match="unsupported type WRONG"):
        D.cell_value(F.col("raw"), "WRONG")


def test_row_images(spark):
    data = [(1, 0, "a", "TINY", 0, 0, bytearray(b"\x01")), (1, 0, "b", "TINY", 0, 0, None), (1, 1, "a", "TINY", 0, 0, bytearray(b"\x02"))]
    out = D.row_images(D.decode_cells(spark.createDataFrame(data, CELL)), ["event_id", "row_seq"])
    assert sorted((r["row_seq"], r["image"]) for r in out.collect()) == [(0, {"a": "1", "b": None}), (1, {"a": "2"})]


def test_packed_numbers(spark):
    """Bytes of whole numbers in both orders, and decimals of every number of leading digits with their sign bit."""
    some = [0, 1, -1, 15, 16, 255, 256, -256, 0x0123456789ABCDEF, -(2**63), 2**63 - 1]
    df = spark.createDataFrame([(n,) for n in [*some, None]], "n bigint")
    for size in (1, 2, 3, 4, 8):
        got = df.select("n", K.little_endian(F.col("n"), size).alias("little"), K.big_endian(F.col("n"), size).alias("big")).collect()
        for r in got:
            whole = None if r.n is None else (r.n % 2**64).to_bytes(8, "little")
            assert (r.little, r.big) == ((None, None) if whole is None else (whole[:size], whole[:size][::-1]))
    for precision in range(1, 20):
        top = decimal.Decimal("9" * precision).scaleb(-min(2, precision - 1))
        scale = min(2, precision - 1)
        values = spark.createDataFrame([(v,) for v in (top, -top, *map(decimal.Decimal, (0, 1, -1)), None)], f"v decimal({precision},{scale})")
        packed = values.select("v", K.packed_decimal(F.col("v"), precision, scale).alias("raw"))
        for r in packed.select("v", D.decimal_value(F.col("raw"), precision, scale).alias("back"), F.length("raw").alias("size"), F.hex("raw").alias("hex")).collect():
            assert r.back == r.v
            assert r.v is None or (r.hex[0] >= "8") == (r.v >= 0)
