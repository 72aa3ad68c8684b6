import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from cdcflow import schema as S
from cdcflow.config import CaptureOptions, flat_properties, split_list, table_names
from cdcflow.functions import conditions as C
from cdcflow.functions import values as V


def one(spark, ddl, value, expr):
    return spark.createDataFrame([(value,)], f"v {ddl}").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "ddl, value, text",
    [
        ("binary", bytearray("é".encode()), "é"),
        ("timestamp_ntz", dt.datetime(2024, 1, 1, 0, 0, 0, 1999), "1704067200001"),
        ("bigint", 7, "7"),
        ("decimal(10,8)", decimal.Decimal("0.00000001"), "0.00000001"),
        ("boolean", True, "true"),
        ("string", None, None),
        ("timestamp_ntz", None, None),
    ],
)
def test_value_text(spark, ddl, value, text):
    df = spark.createDataFrame([(value,)], f"v {ddl}")
    assert V.stringify(df).first()[0] == text


def test_keys(spark):
    keys = spark.createDataFrame([("app.t",), ("app",), ("a.b.c",), ("",)], "k string")
    assert [r[0] for r in keys.select(V.table_of_key(F.col("k"))).collect()] == ["t", "", "", ""]
    assert keys.select(V.table_key(F.lit("db"), F.lit("t"))).first()[0] == "db.t"
    assert one(spark, "string", "x-y", lambda v: V.table_of_key(v, "-")) == "y"


def test_times(spark):
    assert one(spark, "string", "2024-01-02 03:04:05.678", lambda v: F.unix_millis(V.parse_time(v))) % 1000 == 678
    assert one(spark, "string", "2024-01-02 03:04:05", lambda v: F.unix_millis(V.parse_time(v))) == 1_704_164_645_000
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        one(spark, "string", "2024/01/02", V.parse_time)
    shifted = one(spark, "bigint", 1_700_000_000_000, lambda v: F.unix_millis(V.wall_clock_as_local(F.timestamp_millis(v), "Asia/Shanghai")))
    assert shifted == 1_699_971_200_000
    moment = dt.datetime(2024, 1, 1, 1, 2, 3, 4)
    assert one(spark, "timestamp_ntz", moment, lambda v: V.truncate_second(v).cast("timestamp_ntz")) == moment.replace(microsecond=0)
    assert one(spark, "timestamp_ntz", None, V.truncate_second) is None


def test_has_text(spark):
    data = [(None, None), ("", " \t\n"), (" a", None), (None, "b")]
    df = spark.createDataFrame(data, "a string, b string")
    assert [r[0] for r in df.select(V.has_text(F.col("a"), F.col("b"))).collect()] == [False, False, True, True]


def test_file_number(spark):
    df = spark.createDataFrame([("bin.999999",), ("bin.1000000",), ("host.bin.000007",)], "f string")
    assert [r[0] for r in df.select(V.file_number(F.col("f"))).collect()] == [999_999, 1_000_000, 7]


@pytest.mark.parametrize(
    "kind, text, value",
    [
        ("integer", "12", 12),
        ("Long", "-9000000000", -9_000_000_000),
        ("double", "1.5", 1.5),
        ("boolean", "TrUe", True),
        ("boolean", "1", False),
        ("boolean", "yes", False),
        ("bytes", "é", bytearray("é".encode())),
        ("byte", "5", "5"),
        ("object", "x", "x"),
        ("integer", None, None),
        ("boolean", None, None),
    ],
)
def test_parse_declared(spark, kind, text, value):
    assert one(spark, "string", text, lambda v: S.parse_declared(v, kind)) == value


def test_bad_declared(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "string", "1x", lambda v: S.parse_declared(v, "integer"))
    with pytest.raises(ValueError, match="unknown column type"):
        S.declared_type("money")
    assert one(spark, "string", "1700000000000", lambda v: F.unix_millis(S.parse_declared(v, "date"))) == 1_700_000_000_000


def test_node_schemas(spark):
    declared = [{"name": "a", "type": "long"}, {"name": "b", "type": "string", "outputable": False}]
    assert S.node_inputs(declared).names == ["a", "b"]
    assert S.node_outputs(declared).names == ["a"]
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    assert S.project_declared(df, ["b", "none", "a"], declared).dtypes == [("b", "string"), ("a", "bigint")]
    assert S.resolve_columns(["Id", "b "], [" ID", "B"]) == ["Id", "b "]
    with pytest.raises(ValueError, match="no such column: c"):
        S.resolve_columns(["a"], ["c"])


def test_lists():
    assert table_names("app.a, b,,app.c") == ["a", "b", "c"]
    assert split_list(None) == []


def test_options():
    properties = {
        "address": "jdbc:mysql://h:3306/shop?x=1", "tableName": "shop.orders,items", "outputColumns": "id, at",
        "primaryKeyColumns": "id", "updateTimeColumn": "at", "timezoneZero": "TRUE", "binlogFileName": "bin.7",
        "binlogPosition": "55", "binlogTimestamp": "99", "limit": "10",
    }
    options = CaptureOptions.from_properties(properties)
    assert options.db_tables == ["shop.orders", "shop.items"]
    assert (options.start_file, options.start_position, options.start_timestamp_ms) == ("bin.7", 55, 99)
    assert options.shift_to_local and options.page_size == 10 and options.output_columns == ["id", "at"]
    resumed = CaptureOptions.from_properties(properties, saved={"binlogFileName": "bin.9", "gtid": "u:1-3"})
    assert (resumed.start_file, resumed.start_position, resumed.start_timestamp_ms) == ("bin.9", 0, None)
    assert resumed.gtid_set == "u:1-3"


def test_nested_options():
    options = CaptureOptions.from_json('{"jdbcUrl":"jdbc:mysql://h/shop","tableName":"t","a":{"b":[1,{"c":2}]}}')
    assert options.db_tables == ["shop.t"]
    assert flat_properties({"a": {"b": [1, {"c": 2}]}, "d": None}) == {"a.b[0]": 1, "a.b[1].c": 2, "d": None}


def test_conditions(spark):
    df = spark.createDataFrame([(1, "x"), (5, "y"), (None, "x")], "n int, s string")
    spec = {"logicType": "or", "conditions": [
        {"name": "n", "funcName": "ge", "funcArgs": [{"type": "integer", "value": "5"}]},
        {"name": "s", "funcName": "startswith", "funcArgs": [{"value": "x"}]},
    ]}
    assert [r[0] for r in df.select(C.condition(spec)).collect()] == [True, True, True]
    spec["logicType"] = "and"
    assert [r[0] for r in df.select(C.condition(spec)).collect()] == [False, False, False]
    assert [r[0] for r in df.select(C.condition({"expr": "n > 1"})).collect()] == [False, True, False]
    column = {"conditions": [{"funcName": "eq", "funcArgs": [{"value": "$s"}, {"value": "y"}]}]}
    assert [r[0] for r in df.select(C.condition(column)).collect()] == [False, True, False]
    for bad in ({}, {"logicType": "xor", "conditions": spec["conditions"]}):
        with pytest.raises(ValueError):
            C.condition(bad)
    with pytest.raises(ValueError, match="function kind"):
        C.call("eq", [], "OTHER")


def test_registered_function(spark):
    spark.udf.register("twice", lambda v: v * 2, "int")
    df = spark.createDataFrame([(4,)], "n int")
    assert df.select(C.derived("m", "twice", ["$n"], kind="PRIVATE")).first()["m"] == 8


def test_bytes_that_are_not_utf8_do_not_end_a_job(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb"),)], "v binary")
    assert df.select(V.utf8_text(F.col("v"))).first()[0] == "a\ufffdb"


def test_wide_blanks_are_blank(spark):
    df = spark.createDataFrame([("\u3000 \t",), ("\u3000x",), (None,)], "v string")
    assert [r[0] for r in df.select(V.has_text(F.col("v"))).collect()] == [False, True, False]
