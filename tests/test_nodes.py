import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from cdcflow import sinks
from cdcflow.operators import nodes as N
from cdcflow.operators.joins import equi_join, lookup_join
from cdcflow.session import shared_dir


def frame(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, None)], "n int, s string")


def test_two_way_filter_splits_all_rows(spark):
    passed, failed = N.two_way_filter(frame(spark), F.col("n") > 1)
    assert rows(passed) == [(2, "b"), (3, None)]
    assert rows(failed) == [(1, "a"), (None, "c")]


def test_route_filter(spark):
    targets = [{"type": "true", "uuid": "x"}, {"type": "true", "uuid": "y"}, {"type": "false", "uuid": "z"}, {"type": "?", "uuid": "w"}]
    out = N.route_filter(frame(spark), {"expr": "n = 2"}, targets)
    assert sorted(out) == ["x", "y", "z"]
    assert rows(out["x"]) == rows(out["y"]) == [(2, "b")] and out["z"].count() == 3


def test_merge(spark):
    other = spark.createDataFrame([("z", 9, True)], "s string, n int, more boolean")
    assert (9, "z", True) in rows(N.merge(frame(spark), other)) and N.merge(frame(spark), other).count() == 5


def test_flat_map_process_and_parallelism(spark):
    df = N.flat_map(frame(spark).where("s is not null"), F.array("s", F.upper("s")), "v")
    assert [r["v"] for r in df.orderBy("v").collect()] == ["A", "B", "C", "a", "b", "c"]
    assert N.process(frame(spark), lambda d: d, parallelism=3).rdd.getNumPartitions() == 3

    def double(batches):
        for pdf in batches:
            yield pdf.assign(m=pdf["n"] * 2)

    assert rows(N.process_batches(frame(spark).dropna(), double, "n int, s string, m int")) == [(1, "a", 2), (2, "b", 4)]


def test_sort(spark):
    assert [r["n"] for r in N.sort(frame(spark), ["n"]).collect()] == [None, 1, 2, 3]
    assert [r["s"] for r in N.sort(frame(spark), ["s"], descending=["s"]).collect()] == ["c", "b", "a", None]


def test_sort_cuts_through_a_key_of_many_rows(spark):
    df = spark.range(0, 100_000, 1, 4).select(F.lit("same").alias("k"), "id")
    sizes = [len(p) for p in N.sort(df, ["k"]).rdd.glom().map(lambda p: p).collect()]
    assert sum(sizes) == 100_000 and max(sizes) < 40_000


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti", "right", "right_outer", "full", "outer"])
def test_salted_joins_change_nothing(spark, how):
    left = spark.range(200).select(F.when(F.col("id") > 3, F.col("id") % 3).alias("k"), "id")
    right = spark.createDataFrame([(0, "x"), (0, "y"), (2, "z"), (7, "w"), (None, "n")], "k bigint, v string")
    assert rows(equi_join(left, right, ["k"], how, salt=5)) == rows(equi_join(left, right, ["k"], how))


def test_salt_spreads_one_key(spark):
    from cdcflow.operators.joins import row_salt

    df = spark.range(1000).select(F.lit(1).alias("k"), "id")
    counts = [r["count"] for r in df.groupBy(row_salt(df, 8).alias("s")).count().collect()]
    assert len(counts) == 8 and max(counts) < 200


def test_salt_spreads_equal_rows(spark):
    from cdcflow.operators.joins import row_salt

    df = spark.range(0, 6400, 1, 64).select(F.lit(1).alias("k"))
    counts = [r["count"] for r in df.groupBy(row_salt(df, 4).alias("s")).count().collect()]
    assert len(counts) == 4 and max(counts) < 3200


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_hot_keys_are_cut_in_every_kind(spark, how):
    """A key of most left rows: no task of the join gets more than a part of them."""
    left = spark.range(0, 80_000, 1, 8).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(5).alias("k"), "id")
    right = spark.createDataFrame([(k, str(k)) for k in (10, 20, 100_001) + (() if how == "left_anti" else (5,))], "k bigint, v string")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        sizes = equi_join(left, right, ["k"], how, salt=16).groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) > 70_000 and max(r["count"] for r in sizes) < 40_000
    finally:
        for key in settings:
            spark.conf.unset(key)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_lookup_rows_do_not_depend_on_the_plan(spark, how):
    left, right = spark.range(100).withColumn("a", F.col("id") % 3), spark.range(95, 105).withColumn("b", F.col("id"))
    expected = rows(left.join(right, ["id"], how))
    for limit in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            assert rows(lookup_join(left, right, ["id"], how)) == expected
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_aggregate(spark):
    assert N.aggregate(frame(spark), [], n=F.count("*")).first()["n"] == 4
    assert rows(N.aggregate(frame(spark).fillna("x"), ["s"], n=F.sum("n")).where("s = 'x'")) == [("x", 3)]
    assert plan(N.aggregate(frame(spark), ["s"], n=F.count("*"))).count("HashAggregate") == 2


def test_route(spark):
    df = N.route(frame(spark), [(F.col("n") >= 2, "high"), (F.col("n") >= 1, "low")], "none")
    assert rows(df, "n", "_route_path") == [(1, "low"), (2, "high"), (3, "high"), (None, "none")]
    path = shared_dir(spark, "routes")
    sinks.write_routes(df, path)
    assert rows(spark.read.parquet(f"{path}/_route_path=high"), "n") == [(2,), (3,)]


def test_data_quality(spark):
    rules = {"has_n": F.col("n").isNotNull(), "big": F.col("n") > 1}
    assert rows(N.data_quality(frame(spark), rules)) == [("big", 2, 2), ("has_n", 3, 1)]
    from pyspark.sql import Observation

    seen = Observation("q")
    N.observe_quality(frame(spark), seen, rules).count()
    assert seen.get == {"rows": 4, "has_n": 3, "big": 2}


def test_typed_columns(spark):
    df = spark.createDataFrame([("1", "2.50", "true", "2024-01-02", "x", "y")], "a string, b string, c string, d string, e string, f string")
    out = df.select(*sinks.typed_columns(df, [4, 3, 16, 91, 0, 1111]))
    assert [t for _, t in out.dtypes] == ["int", "string", "boolean", "date", "string", "string"]
    assert out.first()["b"] == "2.50" and out.first()["e"] is None and out.first()["f"] == "y"
    with pytest.raises(ValueError, match="1 types for 6 columns"):
        sinks.typed_columns(df, [4])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(*sinks.typed_columns(df, [12, 12, 12, 12, 4, 12])).collect()


def test_json_rows(spark):
    assert [r[0] for r in sinks.json_rows(frame(spark)).collect()][2:] == ['{"s":"c"}', '{"n":3}']


def test_custom_table_function(spark):
    from pyspark.sql.functions import udtf

    @udtf(returnType="part string, size int")
    class Parts:
        def eval(self, text: str):
            for part in (text or "").split("-"):
                yield part, len(part)

    df = spark.createDataFrame([(1, "a-bc"), (2, "d")], "id int, s string")
    assert rows(N.flat_map_with(df, Parts, "s"), "id", "part", "size") == [(1, "a", 1), (1, "bc", 2), (2, "d", 1)]
