"""Physical plans: what is read, what is shuffled, what is shared."""

import re

import pytest
from helpers import plan

import __spark_entry__ as entry_file
from cdcflow.operators.paging import rows_after


def query(spark, data, name):
    return entry_file.queries()[name](spark, data)


def columns_read(text):
    return [set(re.findall(r"(\w+):", part.split(">")[0])) for part in text.split("ReadSchema: struct<")[1:]]


@pytest.mark.parametrize(
    "name, columns",
    [
        ("word_count", {"text"}),
        ("keyed_agg", {"l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice"}),
        ("first_event_time", {"event_id", "ts", "user_id"}),
        ("latest_offsets", {"event_id", "ts", "user_id", "event_type"}),
        ("route", {"event_id", "event_type", "value"}),
        ("data_quality", {"text", "lang", "n_chars"}),
    ],
)
def test_only_needed_columns_are_read(spark, data, name, columns):
    assert columns_read(plan(query(spark, data, name))) == [columns]


@pytest.mark.parametrize("name", ["emit_after_images", "capture_from_properties", "provenance", "filter_false", "route", "op_codes", "rows_after_progress", "table_scan_as_text"])
def test_row_by_row_queries_do_not_shuffle(spark, data, name):
    assert "Exchange" not in plan(query(spark, data, name))


@pytest.mark.parametrize("name", ["flatten_nested_json", "json_properties", "decode_table_columns", "decode_mixed_cells"])
def test_costly_row_work_is_only_spread(spark, data, name):
    text = plan(query(spark, data, name))
    assert text.count("Exchange") == text.count("Exchange RoundRobinPartitioning") == 1
    assert "Python" not in text


@pytest.mark.parametrize("name", ["keyed_agg", "word_count", "data_quality"])
def test_grouping_is_partial_first(spark, data, name):
    text = plan(query(spark, data, name))
    assert "partial_" in text and text.count("hashpartitioning") == 1


@pytest.mark.parametrize("name", ["running_word_count", "effective_image"])
def test_chunk_rows_are_shuffled_once(spark, data, name):
    df = query(spark, data, name)
    df.collect()
    final = plan(df).split("== Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("FileScan") == 2


def test_filters_reach_the_scan(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet").select("o_orderkey", "o_orderdate")
    saved = {"o_orderkey": "700", "o_orderdate": "1996-03-01 00:00:00"}
    pushed = plan(orders.where(rows_after(orders, "o_orderdate", ["o_orderkey"], saved))).split("PushedFilters: ")[1]
    assert "GreaterThan(o_orderdate,1996-03-01T00:00)" in pushed and "And(EqualTo(o_orderdate" in pushed
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan(query(spark, data, "dynamic_filter"))


@pytest.mark.parametrize("name", ["images_from_cells", "decode_mixed_cells"])
def test_cells_are_packed_ahead_of_the_generator(spark, data, name):
    """Spark generates no code for what a generator works out itself in so long a plan."""
    generate = [line for line in plan(query(spark, data, name)).splitlines() if "Generate inline" in line]
    assert generate and not any("hex(" in line for line in generate)
