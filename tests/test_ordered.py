"""Chunked running values against brute force, with one key holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from cdcflow.operators.ordered import last_value, running_sum

RANDOM = random.Random(5)
DATA = [
    ("hot" if RANDOM.random() < 0.6 else RANDOM.choice("abcd"), i, RANDOM.choice([None, None, f"v{i}"]), RANDOM.randint(-3, 9))
    for i in range(600)
]


def frame(spark):
    df = spark.createDataFrame(DATA, "k string, i bigint, v string, n int")
    return df.withColumns({"coarse": F.floor(F.col("i") / 100), "fine": F.floor(F.col("i") / 10)})


@pytest.mark.parametrize("chunks", [[], ["fine"], ["coarse", "fine"]])
def test_running_sum(spark, chunks):
    got = {r["i"]: r["s"] for r in running_sum(frame(spark), ["k"], chunks, ["i"], F.col("n"), "s").collect()}
    totals, expected = {}, {}
    for k, i, _, n in DATA:
        totals[k] = totals.get(k, 0) + n
        expected[i] = totals[k]
    assert got == expected


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("chunks", [[], ["fine"], ["coarse", "fine"]])
def test_last_value(spark, chunks, inclusive):
    out = last_value(frame(spark), ["k"], chunks, ["i"], F.col("v"), "last", inclusive)
    got = {r["i"]: r["last"] for r in out.collect()}
    seen, expected = {}, {}
    for k, i, v, _ in DATA:
        before = seen.get(k)
        seen[k] = v or before
        expected[i] = seen[k] if inclusive else before
    assert got == expected


def test_without_keys(spark):
    out = running_sum(frame(spark), [], ["coarse", "fine"], ["i"], F.lit(1), "place")
    assert [r["place"] for r in out.orderBy("i").collect()] == list(range(1, 601))


def test_null_key_raises(spark):
    df = spark.createDataFrame([(None, 1, 0), ("a", 2, 0)], "k string, i int, chunk int")
    with pytest.raises(Exception, match="null in"):
        running_sum(df, ["k"], ["chunk"], ["i"], F.lit(1), "n").collect()
