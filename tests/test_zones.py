"""Pages by zone maps: the same rows as by a scan, from few files."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from cdcflow.operators import paging as P
from cdcflow.operators import zones as Z
from cdcflow.session import shared_dir

ORDER = ["at", "a", "b"]


@pytest.fixture(scope="module")
def laid_out(spark):
    """Keys of two columns; one time in five is null, and many are equal."""
    draw = random.Random(6)
    values = [(i // 7, i % 7, draw.choice([None, *[draw.randrange(40) for _ in range(4)]]), f"v{i}") for i in range(2_000)]
    df = spark.createDataFrame(values, "a bigint, b bigint, t int, v string")
    df = df.withColumn("at", F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("t") * 1000).cast("timestamp_ntz")).drop("t")
    path = shared_dir(spark, "zones")
    Z.lay_out(df, path, ORDER, rows_per_zone=50)
    return df, path


def files(df):
    return len({f.rsplit("/", 2)[1] for f in df.inputFiles()})


def test_the_map_covers_all_rows(spark, laid_out):
    df, path = laid_out
    zones = Z.zone_map(spark, path)
    assert zones.agg(F.sum("_rows")).first()[0] == 2_000
    assert zones.select("_zone").distinct().count() == 40
    assert zones.where("not _timed").agg(F.sum("_rows")).first()[0] == df.where("at is null").count()


@pytest.mark.parametrize("page_size", [1, 60, 300])
def test_pages_after_progress(spark, laid_out, page_size):
    df, path = laid_out
    progress, seen, total = None, 0, 0
    for _ in range(200 if page_size > 1 else 4):
        page = Z.zoned_keyset_page(spark, path, "at", ["a", "b"], progress, page_size)
        want = P.keyset_page(df, "at", ["a", "b"], progress, page_size)
        got = rows(page.select(*df.columns))
        assert got == rows(want)
        if not got:
            break
        assert files(page) <= page_size // 30 + 5
        progress, total, seen = P.page_progress(want, "at", ["a", "b"], progress), total + len(got), seen + 1
    assert page_size == 1 or total == 2_000


@pytest.mark.parametrize("saved", [{"aNonTime": "100", "bNonTime": "3"}, {"a": "200", "b": "1", "at": "1700000010000"}])
def test_pages_after_half_of_the_progress(spark, laid_out, saved):
    df, path = laid_out
    page = Z.zoned_keyset_page(spark, path, "at", ["a", "b"], saved, 80)
    assert rows(page.select(*df.columns)) == rows(P.keyset_page(df, "at", ["a", "b"], saved, 80))
    assert files(page) <= 9


@pytest.mark.parametrize("offset,size", [(0, 10), (37, 100), (399, 3), (1_234, 60), (1_990, 50), (2_000, 5), (5_000, 5)])
def test_deep_pages(spark, laid_out, offset, size):
    df, path = laid_out
    page = Z.zoned_offset_page(spark, path, ORDER, offset, size)
    want = df.orderBy(F.asc_nulls_first("at"), "a", "b").collect()[offset : offset + size]
    assert [tuple(r) for r in page.select(*df.columns).collect()] == [tuple(r) for r in want]
    if offset < 2_000:
        assert files(page) <= size // 50 + 4


def test_deep_pages_by_key_alone_and_of_nothing(spark):
    path, empty = shared_dir(spark, "keys"), shared_dir(spark, "empty")
    Z.lay_out(spark.range(1_000), path, ["id"], 100)
    assert [r[0] for r in Z.zoned_offset_page(spark, path, ["id"], 455, 5).collect()] == [455, 456, 457, 458, 459]
    assert files(Z.zoned_offset_page(spark, path, ["id"], 455, 5)) <= 3
    Z.lay_out(spark.range(0).withColumn("at", F.lit(None).cast("timestamp")), empty, ["at", "id"], 100)
    assert Z.zoned_keyset_page(spark, empty, "at", ["id"], None, 5).count() == 0
    assert Z.zoned_offset_page(spark, empty, ["at", "id"], 0, 5).count() == 0


def test_small_zones_share_folders(spark):
    """Neither files nor shuffle partitions grow with the number of zones; equal rows may lie in several zones."""
    df = spark.range(3_000).selectExpr("id div 30 k", "id")
    path = shared_dir(spark, "small")
    Z.lay_out(df, path, ["k"], rows_per_zone=4)
    assert Z.zone_map(spark, path).count() == 750
    assert len({f.rsplit("/", 2)[1] for f in spark.read.parquet(f"{path}/rows").inputFiles()}) == 1
    page = Z.zoned_offset_page(spark, path, ["k"], 1_490, 40)
    assert sorted(r["k"] for r in page.collect()) == [49] * 10 + [50] * 30
