import dataclasses

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from cdcflow import sinks
from cdcflow.config import CaptureOptions
from cdcflow.operators import changelog as C
from cdcflow.operators.joins import equi_join
from cdcflow.operators import progress as P
from cdcflow.plans.capture import capture, snapshot_then_log
from cdcflow.schema import CHANGE_EVENT, COLUMN_CATALOG, ROW_EVENT, TABLE_MAP
from cdcflow.session import shared_dir
from cdcflow.sources.changes import parse_records, read_changes, unreadable_records
from cdcflow.sources.tables import column_catalog

UUID = "3e11fa47-71ca-11e1-9e33-c80aa9429562"


def event(pos, op="insert", table="app.a", file="bin.000001", seq=0, ts=None, gtid=None, before=None, after=None):
    return (table, op, before or {}, after or {}, file, pos, seq, pos if ts is None else ts, gtid)


def log(spark, *events):
    return spark.createDataFrame(list(events), CHANGE_EVENT)


def test_filters(spark):
    df = log(spark, event(10), event(20, "delete"), event(30, "update", table="app.b"), event(40, "other"))
    assert rows(C.only_tables(df, ["app.b"]), "binlog_pos") == [(30,)]
    assert rows(C.only_changes(df), "binlog_pos") == [(10,), (30,)]
    assert rows(C.only_changes(df, include_deletes=True), "binlog_pos") == [(10,), (20,), (30,)]
    assert rows(C.from_timestamp(df, 30), "binlog_pos") == [(30,), (40,)]
    assert C.from_timestamp(df, None).count() == 4


def test_position_compares_file_numbers(spark):
    files = ["bin.999998", "bin.999999", "bin.1000000"]
    df = log(spark, *[event(p, file=f) for f in files for p in (4, 100)])
    got = rows(C.from_position(df, "bin.999999", 100), "binlog_file", "binlog_pos")
    assert set(got) == {("bin.1000000", 4), ("bin.1000000", 100), ("bin.999999", 100)} and len(got) == 3
    assert C.from_position(df, None).count() == 6


def test_transaction_sets(spark):
    gtids = [f"{UUID}:{n}" for n in (1, 5, 6, 9)] + [None, "other:2"]
    df = log(spark, *[event(i, gtid=g) for i, g in enumerate(gtids)])
    assert rows(C.outside_txn_set(df, f"{UUID}:1-5"), "binlog_pos") == [(2,), (3,), (4,), (5,)]
    assert rows(C.outside_txn_set(df, f"{UUID}:1-5:9, other:1-2"), "binlog_pos") == [(2,), (4,)]
    assert C.outside_txn_set(df, None).count() == 6
    for bad in (f"{UUID}:x", "  ,"):
        with pytest.raises(ValueError):
            C.outside_txn_set(df, bad)


def test_table_ids_follow_the_newest_map(spark):
    maps = [(1, "app.a", "bin.000001", 5, 0), (2, "app.b", "bin.000001", 6, 0), (1, "app.c", "bin.000003", 50, 0)]
    places = [("bin.000001", 4), ("bin.000001", 10), ("bin.000002", 10), ("bin.000003", 49), ("bin.000003", 51), ("bin.000010", 1)]
    events = [(i, "insert", None, None, f, p, 0, 0, None) for i in (1, 2) for f, p in places]
    got = C.resolve_table_ids(spark.createDataFrame(events, ROW_EVENT), spark.createDataFrame(maps, TABLE_MAP))
    names = {(r["table_id"], r["binlog_file"], r["binlog_pos"]): r["db_table"] for r in got.collect()}
    assert [names[(1, *p)] for p in places] == [None, "app.a", "app.a", "app.a", "app.c", "app.c"]
    assert [names[(2, *p)] for p in places] == [None] + ["app.b"] * 5


def named(spark, events):
    catalog = spark.createDataFrame(
        [("app", "a", "y", 1, "string"), ("app", "a", "x", 0, "string"), ("app", "b", "only", 0, "string")], COLUMN_CATALOG
    )
    data = [(t, op, b, a, i) for i, (t, op, b, a) in enumerate(events)]
    names = "db_table string, op string, before_cells array<string>, after_cells array<string>, id int"
    good, bad = C.named_images(spark.createDataFrame(data, names), catalog)
    return {r["id"]: (r["before"], r["after"]) for r in good.collect()}, sorted(r["id"] for r in bad.collect())


def test_named_images(spark):
    good, bad = named(
        spark,
        [
            ("app.a", "insert", None, ["1", None]),
            ("app.a", "delete", ["1", "2"], None),
            ("app.a", "update", ["1", "2"], ["3", "4", "extra"]),
            ("app.a", "insert", None, ["1"]),
            ("app.a", "insert", None, ["1", "2", "3"]),
            ("app.a", "update", ["1", "2"], ["3"]),
            ("app.b", "insert", None, ["z"]),
            ("app.unregistered", "insert", None, ["z"]),
            ("app.a", "query", None, None),
        ],
    )
    assert good == {
        0: ({}, {"x": "1", "y": None}),
        1: ({"x": "1", "y": "2"}, {}),
        2: ({"x": "1", "y": "2"}, {"x": "3", "y": "4"}),
        6: ({}, {"only": "z"}),
    }
    assert bad == [3, 4, 5, 8]


def test_images_and_codes(spark):
    events = [event(i, op, before={"v": "b"}, after={"v": "a"}) for i, op in enumerate(["insert", "update", "delete", "query"])]
    df = log(spark, *events).withColumn("image", C.effective_image())
    got = [tuple(r) for r in df.orderBy("binlog_pos").select(F.col("image")["v"], C.op_code()).collect()]
    assert got == [("a", 1), ("a", 2), ("b", 3), (None, None)]


def test_emit(spark):
    df = log(spark, event(1, after={"id": "7", "at": "99"}))
    assert rows(C.emit(df, ["at", "none", "id"], keep=["db_table"])) == [("app.a", "99", None, "7")]
    typed = df.withColumn("after", F.struct(F.lit(7).alias("id"), F.timestamp_millis(F.lit(99)).alias("at")))
    assert rows(C.emit(typed, ["at", "id"])) == [("99", "7")]
    assert rows(C.emit(typed, ["none", "id"], missing="null")) == [(None, "7")]
    with pytest.raises(ValueError, match="no such column: none"):
        C.emit(typed, ["none"])


def test_envelope(spark):
    out = C.with_envelope(spark.range(3), route="r")
    got = out.collect()
    assert len({r["_uuid"] for r in got}) == 3
    assert {r["_route_path"] for r in got} == {"r"} and all(r["_emit_time"] > 1_700_000_000_000 for r in got)


def test_fixture_of_nine_columns(spark):
    """The output shape the job's consumers rely on: field 7 is epoch ms, field 8 an id."""
    names = [f"c{i}" for i in range(7)] + ["changed", "id"]
    after = F.struct(*[F.lit(n).alias(n) for n in names[:7]], F.timestamp_millis(F.lit(1_700_000_000_123)).alias("changed"), F.lit(42).alias("id"))
    options = CaptureOptions(database="app", tables=["a"], output_columns=names)
    row = capture(log(spark, event(1)).withColumn("after", after), options).first()
    assert (row[7], row[8]) == ("1700000000123", "42")


def test_latest_offsets(spark):
    df = log(
        spark,
        event(900, file="bin.000009", after={"id": "1", "at": "5"}),
        event(4, file="bin.000010", after={"id": "2", "at": " "}),
        event(4, file="bin.000010", seq=1, ts=77, gtid="g:1", after={"id": "3", "at": "6"}),
        event(8, table="app.b", after={"id": "9"}),
    )
    got = {r["db_table"]: r for r in P.latest_offsets(df, ["id"], "at").collect()}
    assert got["app.a"]["info"] == {"id": "3", "at": "6"}
    assert (got["app.a"]["binlog_file"], got["app.a"]["event_ts_ms"], got["app.a"]["gtid"]) == ("bin.000010", 77, "g:1")
    assert got["app.b"]["info"] == {"idNonTime": "9"}
    saved = P.saved_progress(P.latest_offsets(df, ["id"], "at"), "app.a")
    assert saved == {"id": "3", "at": "6", "binlogFileName": "bin.000010", "binlogPosition": "4", "binlogTimestamp": "77", "gtid": "g:1"}
    assert P.saved_progress(P.latest_offsets(df, ["id"], "at"), "app.none") == {}


def test_merge_offsets_keeps_the_furthest(spark):
    first = P.latest_offsets(log(spark, event(5, after={"id": "1"}), event(5, table="app.b", after={"id": "2"})), ["id"], None)
    later = P.latest_offsets(log(spark, event(1, file="bin.000002", after={"id": "7"})), ["id"], None)
    got = {r["db_table"]: r["info"]["idNonTime"] for r in P.merge_offsets(first, later).collect()}
    assert got == {"app.a": "7", "app.b": "2"}


def test_hand_over_includes_both_ends(spark):
    snapshot = spark.createDataFrame([(1, 100), (2, 200), (3, 201), (4, None)], "id int, ms int")
    snapshot = snapshot.select("id", F.timestamp_millis("ms").alias("at"))
    df = log(spark, *[event(ts, ts=ts, table="app.a", after={"id": str(ts), "at": str(ts)}) for ts in (199, 200, 201)])
    options = CaptureOptions(database="app", tables=["a"], output_columns=["id", "at"], update_time="at")
    both = snapshot_then_log(snapshot, df, options, 200)
    assert sorted(r["id"] for r in both.collect()) == [1, 2, 4, 200, 201]


def test_backlog(spark):
    levels = spark.createDataFrame(list(enumerate([10, 81, 80, 79, 95, 90, 3])), "t int, n int")
    got = [(r["t"], r["state"]) for r in P.backlog_alerts(levels, "t", "n", capacity=100).orderBy("t").collect()]
    assert got == [(1, "alert"), (2, "recovered"), (4, "alert"), (5, "alert"), (6, "recovered")]


def test_fan_out_of_a_hot_table(spark):
    df = log(spark, *[event(i) for i in range(50)], event(99, table="app.b"))
    handlers = spark.createDataFrame([("app.a", "x"), ("app.a", "y"), ("app.c", "z")], "db_table string, handler string")
    small = rows(P.fan_out(df, handlers), "binlog_pos", "handler")
    spread = rows(equi_join(df, handlers, ["db_table"], salt=4), "binlog_pos", "handler")
    assert spread == small and len(small) == 100


def test_days_do_not_depend_on_the_session_zone(spark):
    path, at = shared_dir(spark, "zones"), 1_700_000_000_000
    sinks.land_changes(log(spark, event(1, ts=at)), path)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert C.from_timestamp(spark.read.parquet(path), at).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_json_records(spark):
    body = '{"db_table":"app.a","op":"insert","after":{"id":"1"},"binlog_file":"bin.1","binlog_pos":4,"row_seq":0,"event_ts_ms":5}'
    df = spark.createDataFrame([(bytearray(body.encode()),)], "value binary")
    row = parse_records(df).first()
    assert (row["db_table"], row["after"], row["binlog_pos"], row["gtid"]) == ("app.a", {"id": "1"}, 4, None)


def test_unreadable_records_are_kept_apart(spark):
    good = '{"db_table":"app.a","op":"insert"}'
    sent = [good, '{"db_table":"app', "", "[", '{"binlog_pos":"x"}', None]
    df = spark.createDataFrame([(t,) for t in sent], "value string")
    assert [r["db_table"] for r in parse_records(df).collect()] == ["app.a"]
    assert sorted(r[0] or "" for r in unreadable_records(df).collect()) == sorted(t or "" for t in sent[1:])
    with pytest.raises(Exception, match="(?i)malformed"):
        parse_records(df, strict=True).collect()


def test_zone_shift_is_never_skipped(spark):
    options = CaptureOptions("app", ["a"], ["id", "at"], shift_to_local=True)
    df = log(spark, event(1, table="app.a", after={"id": "1", "at": "28800000"}), event(2, table="app.a", after={"id": "x", "at": "x"}))
    with pytest.raises(ValueError, match="no zone"):
        capture(df, options)
    with pytest.raises(ValueError, match="zoned columns"):
        capture(df, options, zone="Asia/Shanghai")
    options = dataclasses.replace(options, zone="Asia/Shanghai", zoned_columns=["at"])
    assert rows(capture(df, options)) == [("1", "0"), ("x", "x")]


def test_landed_log_prunes_and_pushes_filters(spark):
    day = 86_400_000
    path = shared_dir(spark, "landed")
    sinks.land_changes(log(spark, *[event(i, table=f"app.{t}", ts=i * day) for i in range(3) for t in "abc"]), path)
    landed = spark.read.parquet(path)
    df = C.from_position(C.from_timestamp(C.only_tables(landed, ["app.b"]), day), "bin.000001", 1)
    df = C.only_changes(df).select("binlog_pos")
    text = plan(df)
    folders = text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "(db_table" in folders and "(event_date" in folders
    assert "GreaterThanOrEqual(event_ts_ms,86400000)" in text and "In(op, [insert,update])" in text
    assert "gtid" not in text.split("ReadSchema: ")[1].split(">")[0]
    assert rows(df) == [(1,), (2,)]


def test_reads_landed_formats(spark):
    df = log(spark, event(1, after={"id": "1"}), event(2, "delete", before={"id": "1"}))
    for fmt in ("parquet", "json", "orc"):
        path = shared_dir(spark, fmt)
        df.write.format(fmt).save(path)
        assert rows(read_changes(spark, path, fmt)) == rows(df)


def test_column_catalog(spark):
    catalog = column_catalog(spark.createDataFrame([], "b int, a string"), "db", "t")
    assert rows(catalog) == [("db", "t", "a", 1, "string"), ("db", "t", "b", 0, "int")]
