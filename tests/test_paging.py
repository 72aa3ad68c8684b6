import datetime as dt
import random

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from cdcflow.config import CaptureOptions
from cdcflow.operators import paging as G
from cdcflow.sources import tables as T

DAY = dt.datetime(2024, 1, 1)
RANDOM = random.Random(3)
ROWS = [(i, None if i % 5 == 0 else DAY + dt.timedelta(days=RANDOM.randint(0, 6))) for i in range(1, 101)]
ORDER = sorted(ROWS, key=lambda r: (r[1] is not None, r[1] or DAY, r[0]))


def table(spark):
    return spark.createDataFrame(ROWS, "id int, at timestamp_ntz").repartition(4)


def ids(df):
    return [r["id"] for r in df.collect()]


def test_pages_cover_the_table_in_order(spark):
    pages = [(ids(page), saved) for page, saved in G.keyset_pages(lambda: table(spark), "at", ["id"], page_size=17)]
    assert [i for page, _ in pages for i in page] == [r[0] for r in ORDER]
    assert pages[0][1] == {"idNonTime": str(ORDER[16][0])}
    assert [len(p) for p, _ in pages] == [17] * 5 + [15]


def test_resume_in_the_middle(spark):
    _, saved = next(iter(G.keyset_pages(lambda: table(spark), "at", ["id"], page_size=40)))
    assert ids(G.keyset_page(table(spark), "at", ["id"], saved, 1000)) == [r[0] for r in ORDER[40:]]


def test_progress_has_one_form(spark):
    ms = int((DAY + dt.timedelta(days=3)).replace(tzinfo=dt.UTC).timestamp() * 1000)
    for text in (str(ms), f"{ms}.000", str(DAY + dt.timedelta(days=3))):
        saved = {"id": "50", "at": text, "idNonTime": "95"}
        expected = [i for i, at in ORDER if (at is None and i > 95) or (at and (at, i) > (DAY + dt.timedelta(days=3), 50))]
        assert ids(G.keyset_page(table(spark), "at", ["id"], saved, 1000)) == expected


@pytest.mark.parametrize("micros", [0, 1, 999_999, -1, -1_000_001, 1_700_000_000_123_456])
def test_progress_keeps_every_microsecond(spark, micros):
    df = spark.range(1).select(F.timestamp_micros(F.lit(micros)).alias("t"))
    text = df.select(G.progress_text(F.col("t"), df.schema["t"].dataType)).first()[0]
    assert df.where(F.col("t") == G.saved_value(text, df.schema["t"].dataType)).count() == 1


def test_late_rows_without_time_come_next(spark):
    saved = {"id": "100", "at": "2030-01-01 00:00:00", "idNonTime": "90"}
    assert ids(G.keyset_page(table(spark), "at", ["id"], saved)) == [95, 100]


def test_saved_without_keys(spark):
    with pytest.raises(ValueError, match="neither"):
        G.keyset_page(table(spark), "at", ["id"], {"other": "1"})


def test_composite_key_is_lexicographic(spark):
    data = [(a, b, DAY) for a in (1, 2, 3) for b in (1, 2, 3)]
    df = spark.createDataFrame(data, "a int, b int, at timestamp_ntz")
    page = G.keyset_page(df, "at", ["a", "b"], {"a": "1", "b": "2", "at": str(DAY)})
    assert [(r["a"], r["b"]) for r in page.collect()] == [(1, 3), (2, 1), (2, 2), (2, 3), (3, 1), (3, 2), (3, 3)]


def test_scan_stops_at_the_log(spark):
    stop = DAY + dt.timedelta(days=2)
    stop_ms = int(stop.replace(tzinfo=dt.UTC).timestamp() * 1000)
    got = [i for page, _ in G.keyset_pages(lambda: table(spark), "at", ["id"], page_size=30, stop_after_ms=stop_ms) for i in ids(page)]
    assert got == [r[0] for r in ORDER if r[1] is None or r[1] <= stop]


def test_keyset_page_is_a_top_n(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    saved = {"o_orderkey": "5", "o_orderdate": "1998-01-01 00:00:00", "o_orderkeyNonTime": "0"}
    text = plan(G.keyset_page(orders.select("o_orderkey", "o_orderdate"), "o_orderdate", ["o_orderkey"], saved))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert "GreaterThan(o_orderdate,1998-01-01T00:00)" in text


@pytest.mark.parametrize("offset, size", [(0, 10), (7, 20), (55, 30), (95, 10), (200, 5)])
def test_offset_pages(spark, offset, size):
    page = G.offset_page(table(spark), "id", offset, size, rows_per_chunk=9)
    assert sorted(ids(page)) == list(range(1, 101))[offset : offset + size]
    assert G.next_offset(offset, page) == offset + max(0, min(size, 100 - offset))


def test_sharded_scan(spark):
    for name in ("shard_1", "shard_2", "shard_2_old", "my_shard_1"):
        spark.createDataFrame([(name,)], "v string").createOrReplaceTempView(name)
    out = T.sharded_scan(spark, r"select v from ${shard_\d+} where v is not null")
    assert sorted(tuple(r) for r in out.collect()) == [("shard_1", "shard_1"), ("shard_2", "shard_2")]
    for bad in ("select 1", "select * from ${nothing_like_this}"):
        with pytest.raises(ValueError):
            T.sharded_scan(spark, bad)


def test_sequence(spark):
    assert [r[0] for r in T.sequence(spark, 1, 10).orderBy("value").collect()] == list(range(1, 11))


def test_jdbc_options(spark):
    options = CaptureOptions("app", ["t"], ["id"], ["ID"], "AT", jdbc={"url": "jdbc:mysql://h/app", "user": "u", "password": "p"})
    assert T.jdbc_options(options, table="t")["dbtable"] == "t"
    assert T.jdbc_options(options, query="select 1")["query"] == "select 1"
    with pytest.raises(ValueError):
        T.jdbc_options(options)
    assert T.key_columns(table(spark), options) == (["id"], "at")


def test_spread(spark):
    assert T.spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == 8
    wide = spark.range(0, 100, 1, 20)
    assert T.spread(wide) is wide


def test_spread_grows_with_the_bytes(spark, tmp_path, monkeypatch):
    """A task's share of costly rows doesn't grow with the table."""
    spark.range(0, 200_000, 1, 9).selectExpr("id", "sha2(cast(id as string), 256) v").write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    monkeypatch.setattr(T, "SPREAD_BYTES", size // 40)
    assert table.rdd.getNumPartitions() < 40 <= T.spread(table).rdd.getNumPartitions() <= 42
    assert rows(T.spread(table).selectExpr("count(*)", "sum(id)")) == [(200_000, 199_999 * 100_000)]
