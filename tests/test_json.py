import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdcflow.functions.json_flat import flatten_json, json_properties


def flat(spark, body):
    df = spark.createDataFrame([(body,)], "body string")
    return {r["path"]: r["value"] for r in flatten_json(df, "body").collect()}


@pytest.mark.parametrize(
    "body, expected",
    [
        ('{"a":{"b":1,"c":{"d":true}}}', {"a.b": "1", "a.c.d": "true"}),
        ('{"a":[1,"x",null,{"b":2}]}', {"a[0]": "1", "a[1]": "x", "a[2]": "", "a[3].b": "2"}),
        ('[1,[2,[3]]]', {"[0]": "1", "[1][0]": "2", "[1][1][0]": "3"}),
        ('{"a":null,"b":"","c":{},"d":[],"e":[{}]}', {"a": "", "b": ""}),
        ('{"a":"[1,2]","b":["[1,2]","{\\"k\\":{\\"l\\":3}}","{bad"]}', {"a": "[1,2]", "b[0][0]": "1", "b[0][1]": "2", "b[1].k.l": "3", "b[2]": "{bad"}),
        ('{"a":1,"a":2}', {"a": "2"}),
        ('{"a":{"b":1},"a.b":2}', {"a.b": "2"}),
        ("plain text", {"": "plain text"}),
        ('"quoted"', {"": '"quoted"'}),
        ("", {"": ""}),
        ("{broken", {"": "{broken"}),
        ("42", {"": "42"}),
        ("{}", {}),
        ("[]", {}),
        (' {"a":1}', {"a": "1"}),
    ],
)
def test_flatten(spark, body, expected):
    assert flat(spark, body) == expected


def test_null_document_gives_no_row(spark):
    assert flat(spark, None) == {}


@pytest.mark.parametrize("levels", [1, 12, 40])
def test_any_depth(spark, levels):
    body = '{"a":' * levels + "[1,{}]" + "}" * levels
    assert flat(spark, body) == {".".join("a" * levels) + "[0]": "1"}


def test_escaped_json_text_inside_arrays(spark):
    inner = '{"k":{"l":[3]}}'.replace("{", "\\u007b").replace("[", "\\u005b").replace('"', '\\"')
    assert flat(spark, f'["{inner}"]') == {"[0].k.l[0]": "3"}


def test_deeper_than_the_parser_goes(spark):
    body = "[" * 5000 + "]" * 5000
    assert flat(spark, body) == {"": body}


def test_properties_are_sorted(spark):
    df = spark.createDataFrame([('{"b":{"z":1,"a":2},"a":3}',)], "body string")
    pairs = df.select(F.map_entries(json_properties(F.col("body")))).first()[0]
    assert [tuple(p) for p in pairs] == [("a", "3"), ("b.a", "2"), ("b.z", "1")]


def expected(value, path=""):
    if isinstance(value, dict):
        out = {}
        for k, v in value.items():
            out |= expected(v, f"{path}.{k}" if path else k)
        return out
    if isinstance(value, list):
        out = {}
        for i, v in enumerate(value):
            out |= expected(v, f"{path}[{i}]")
        return out
    return {path: "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)}


NAMES = st.text("abc", min_size=1, max_size=2)
SCALARS = st.none() | st.booleans() | st.integers(-(10**12), 10**12) | st.text("xyz ", max_size=4)
TREES = st.recursive(SCALARS, lambda t: st.lists(t, max_size=3) | st.dictionaries(NAMES, t, max_size=3), max_leaves=8)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(NAMES, TREES, max_size=3), min_size=10, max_size=40))
def test_any_document(spark, documents):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "id int, body string")
    got = {}
    for r in flatten_json(df, "body", ["id"]).collect():
        got.setdefault(r["id"], {})[r["path"]] = r["value"]
    assert [got.get(i, {}) for i in range(len(documents))] == [expected(d) for d in documents]
