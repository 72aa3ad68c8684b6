"""Streams with state: the same as in batch, whatever the batches, and after every restart."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from cdcflow.config import CaptureOptions
from cdcflow.operators import changelog as C
from cdcflow.operators import nodes as N
from cdcflow.operators import progress as P
from cdcflow.operators.text import running_word_count
from cdcflow.session import shared_dir
from cdcflow.sources.changes import stream_changes
from cdcflow.streaming import backlog, jobs, names, running
from cdcflow.streaming.manifest import Manifest, committed
from cdcflow.streaming.scan import scan_job, scanned


def run_parts(spark, parts, start, name):
    """Land frames one after another and run a stream to its end after each."""
    work = shared_dir(spark, name)
    for part in parts:
        part.write.mode("append").parquet(f"{work}/in")
        start(stream_changes(spark, f"{work}/in", schema=part.schema), f"{work}/out", f"{work}/check").awaitTermination()
    return f"{work}/out"


# -- running word counts ------------------------------------------------------------------------


def test_running_words_equal_the_batch(spark):
    draw = random.Random(1)
    lines = [(i, draw.choice([None, "", "the " * draw.randrange(50), " ".join(draw.choice("abcde") for _ in range(9))])) for i in range(120)]
    frame = lambda some: spark.createDataFrame(some, "id bigint, text string").repartition(4)
    manifests = []

    def start(stream, path, checkpoint):
        manifests.append(Manifest(spark, path, fanout=2))
        return committed(running.running_words(stream, "text", "id"), manifests[-1], lambda b, _: {"append": {"rows": b}}, checkpoint)

    run_parts(spark, [frame(lines[:40]), frame(lines[40:41]), frame(lines[41:])], start, "running")
    want = running_word_count(frame(lines), "text", "id").select("id", "pos", "word", "n")
    assert rows(manifests[-1].read("rows").select("id", "pos", "word", "n")) == rows(want)


def test_a_frequent_word_is_shuffled_as_few_rows(spark):
    batch = spark.range(2_000).selectExpr("id line", "cast(1 as int) pos", "'the' word").coalesce(2)
    grouped = batch.mapInArrow(running._by_word, running._PLACES)
    assert grouped.count() <= 4
    assert grouped.selectExpr("sum(size(lines))").first()[0] == 2_000


def test_rare_words_share_states(spark, monkeypatch):
    """Far fewer states than words, and totals that go on over micro-batches."""
    monkeypatch.setattr(running, "_BUCKETS", 4)
    lines = [(i, f"w{i} w{i % 90} the w{i} x{i // 2}") for i in range(180)]
    frame = lambda some: spark.createDataFrame(some, "id bigint, text string").repartition(3)
    jobs_seen, manifests = [], []

    def start(stream, path, checkpoint):
        manifests.append(Manifest(spark, path))
        jobs_seen.append(committed(running.running_words(stream, "text", "id"), manifests[-1], lambda b, _: {"append": {"rows": b}}, checkpoint))
        return jobs_seen[-1]

    run_parts(spark, [frame(lines[:70]), frame(lines[70:])], start, "rare")
    want = running_word_count(frame(lines), "text", "id").select("id", "pos", "word", "n")
    assert rows(manifests[-1].read("rows").select("id", "pos", "word", "n")) == rows(want)
    assert jobs_seen[-1].lastProgress["stateOperators"][0]["numRowsTotal"] <= 4


# -- names of row events ------------------------------------------------------------------------


def events(spark, *places):
    return spark.createDataFrame([(t, f"bin.{f:06}", p, f"e{t}-{f}-{p}") for t, f, p in places], "table_id bigint, binlog_file string, binlog_pos bigint, body string")


def maps(spark, *places):
    return spark.createDataFrame([(t, f"bin.{f:06}", p, name) for t, f, p, name in places], "table_id bigint, binlog_file string, binlog_pos bigint, db_table string")


def resolved(spark, path):
    return rows(names.named_rows(spark, path).select("body", "db_table").union(names.waiting(spark, path).select("body", "db_table")))


def test_names_equal_the_batch(spark):
    draw = random.Random(2)
    log = [(draw.randrange(3), f, p) for f in range(1, 5) for p in range(0, 400, 4)]
    named = [(t, f, p - 1, f"app.t{t}_{(f * 400 + p) // 150}") for t, f, p in log if draw.random() < 0.1]
    cut = [0, 90, 91, 250, 400]
    inside = lambda xs, lo, hi: [x for x in xs if lo <= (x[1] - 1) * 100 + (x[2] + 1) // 4 < hi]
    parts = [names.one_log(events(spark, *inside(log, a, b)), maps(spark, *(inside(named, a, b) or [(9, 1, 0, "x")]))) for a, b in zip(cut, cut[1:])]
    path = run_parts(spark, parts, names.resolve_names, "names")
    want = C.resolve_table_ids(events(spark, *log), maps(spark, *named)).select("body", "db_table")
    assert resolved(spark, path) == rows(want)


def test_late_maps_and_late_events(spark):
    parts = [
        names.one_log(events(spark, (1, 1, 50), (2, 1, 60)), maps(spark, (2, 1, 55, "app.b"))),
        names.one_log(events(spark, (2, 1, 90)), maps(spark, (2, 1, 80, "app.b2"), (7, 1, 1, "app.x"))),
        names.one_log(events(spark, (2, 1, 70)), maps(spark, (1, 1, 40, "app.a"), (2, 1, 85, "app.b2"))),  # late: an event, a map
        names.one_log(events(spark, (3, 2, 5)), maps(spark, (3, 2, 6, "app.c"))),  # a map behind its event
    ]
    path = run_parts(spark, parts, names.resolve_names, "late")
    want = {"e1-1-50": "app.a", "e2-1-60": "app.b", "e2-1-90": "app.b2", "e2-1-70": "app.b", "e3-2-5": None}
    assert dict(resolved(spark, path)) == want and len(resolved(spark, path)) == 5
    assert rows(names.waiting(spark, path).select("body")) == [("e3-2-5",)]
    state = names.first_of_runs(Manifest(spark, path).read("maps"))
    assert rows(state.where("table_id = 2").select("binlog_pos", "db_table")) == [(55, "app.b"), (80, "app.b2")]


# -- backlog ------------------------------------------------------------------------------------

START = datetime(2024, 1, 1)


def samples(spark, *values):
    return spark.createDataFrame([(q, START + timedelta(seconds=s), n) for q, s, n in values], "queue string, at timestamp_ntz, n bigint")


def alerts(spark, parts, **how):
    def start(stream, path, checkpoint):
        return committed(backlog.backlog_states(stream, "queue", "at", "n", 10, **how), Manifest(spark, path), lambda b, _: {"append": {"rows": b}}, checkpoint)

    return Manifest(spark, run_parts(spark, parts, start, "backlog")).read("rows").select("queue", "at", "n", "state")


def test_backlog_states_equal_the_batch(spark):
    draw = random.Random(4)
    values = [(draw.choice("ab"), s, draw.choice([2, 8, 9, 10])) for s in range(200)]
    shuffled = [v for i in range(0, 200, 50) for v in draw.sample(values[i : i + 50], 50)]
    got = alerts(spark, [samples(spark, *shuffled[:100]), samples(spark, *shuffled[100:101]), samples(spark, *shuffled[101:])], delay="60 seconds")
    flushed = alerts(spark, [samples(spark, *values[:77]), samples(spark, *values[77:])])
    of = lambda q: P.backlog_alerts(samples(spark, *[v for v in values if v[0] == q]), "at", "n", 10)
    want = rows(of("a").union(of("b")).select("queue", "at", "n", "state"))
    assert rows(flushed) == want
    upto = START + timedelta(seconds=139)  # the last minute still waits
    assert rows(got) == [r for r in want if r[1] <= upto]


def test_samples_behind_the_watermark_and_nulls_are_left_out(spark):
    empty = spark.createDataFrame([("a", None, 99), (None, START, 99), ("a", START, None)], "queue string, at timestamp_ntz, n bigint")
    got = alerts(spark, [samples(spark, ("a", 10, 9), ("a", 20, 9)).union(empty), samples(spark, ("a", 15, 1), ("a", 30, 1), ("a", 40, 1))])
    seconds = [((r["at"] - START).seconds, r["state"]) for r in got.orderBy("at").collect()]
    assert seconds == [(10, "alert"), (20, "alert"), (30, "recovered")]


# -- quality counts -----------------------------------------------------------------------------


def test_quality_counts_equal_the_batch_and_repeat_nothing(spark, monkeypatch):
    values = spark.createDataFrame([(i if i % 7 else None, "x" * (i % 3)) for i in range(60)], "n int, s string")
    rules = {"has_n": F.col("n").isNotNull(), "long": F.length("s") > 1}
    parts = [values.where("n < 20"), values.where("n >= 20"), values.where("n is null")]
    start = lambda stream, path, checkpoint: jobs.check_quality(stream, rules, path, checkpoint)
    path = run_parts(spark, parts, start, "quality")
    assert rows(jobs.quality_counts(spark, path)) == rows(N.data_quality(values, rules))
    assert rows(Manifest(spark, path).read("rows")) == rows(values)

    # A batch that wrote its rows and counts but failed before its commit runs again under the same id.
    work = shared_dir(spark, "again")
    parts[0].write.parquet(f"{work}/in")
    run = lambda: jobs.check_quality(stream_changes(spark, f"{work}/in", schema=values.schema), rules, f"{work}/out", f"{work}/check").awaitTermination()
    from cdcflow import files

    def fail(*_):
        raise OSError("killed before the commit")

    with monkeypatch.context() as m:
        m.setattr(files, "write_text", fail)
        with pytest.raises(Exception, match="killed"):
            run()
    assert jobs.quality_counts(spark, f"{work}/out").count() == 0
    run()
    assert rows(jobs.quality_counts(spark, f"{work}/out")) == rows(N.data_quality(parts[0], rules))


def test_another_checkpoint_is_an_error(spark):
    work = shared_dir(spark, "other")
    spark.range(3).write.parquet(f"{work}/in")
    run = lambda check: jobs.check_quality(stream_changes(spark, f"{work}/in", schema=spark.range(1).schema), {"a": F.col("id") > 1}, f"{work}/out", f"{work}/{check}")
    run("one").awaitTermination()
    with pytest.raises(Exception, match="was written with the checkpoint"):
        run("two").awaitTermination()


# -- scan job -----------------------------------------------------------------------------------

SCAN = CaptureOptions("app", ["t"], ["id", "at", "v"], ["id"], "at", page_size=7)


def stock(spark, n, start=0):
    at = "case when id % 4 = 0 then null else timestamp_millis(1700000000000 + (id % 5) * 1000) end"
    return spark.range(start, start + n).selectExpr("id", f"cast({at} as timestamp_ntz) at", "concat('v', id) v")


def test_scan_job_pages_through_a_table(spark):
    table, path = stock(spark, 40), shared_dir(spark, "scan")
    progress = scan_job(lambda: table, SCAN, path)
    got = scanned(spark, path).collect()
    want = [str(r["id"]) for r in table.orderBy(F.asc_nulls_first("at"), "id").collect()]
    assert sorted(r["id"] for r in got) == sorted(want)
    for page in range(6):
        assert sorted(r["id"] for r in got if r["page"] == page) == sorted(want[7 * page : 7 * page + 7])
    assert progress == {"id": "39", "at": "1700000004000", "idNonTime": "36"}
    assert scan_job(lambda: table, SCAN, path) == progress and scanned(spark, path).count() == 40


def test_scan_job_killed_anywhere_loses_and_repeats_nothing(spark, monkeypatch):
    from cdcflow import files

    table, path = stock(spark, 40), shared_dir(spark, "killed")
    real, turn = files.write_text, [0]

    def sometimes(*args):
        turn[0] += 1
        if turn[0] % 2:
            raise OSError("killed before the commit")
        real(*args)
        if turn[0] % 4 == 0:
            raise OSError("killed after the commit")

    monkeypatch.setattr(files, "write_text", sometimes)
    for _ in range(60):
        try:
            scan_job(lambda: table, SCAN, path)
            break
        except OSError:
            continue
    assert turn[0] > 8
    assert rows(scanned(spark, path).select("id")) == sorted(((str(i),) for i in range(40)), key=repr)


def test_rows_that_come_during_a_page_are_read_once(spark):
    path, seen = shared_dir(spark, "growing"), [0]

    def read():
        seen[0] += 1
        return stock(spark, min(60, 20 + 3 * seen[0]))

    scan_job(read, SCAN, path)
    got = [r["id"] for r in scanned(spark, path).collect()]
    assert len(got) == len(set(got))


def test_scan_job_waits_and_looks_again(spark, monkeypatch):
    from dataclasses import replace

    import cdcflow.streaming.scan as scan

    path, waits, size = shared_dir(spark, "waits"), [], [10]

    def sleep(seconds):
        waits.append(seconds)
        size[0] += 5

    monkeypatch.setattr(scan, "sleep", sleep)
    at = "cast(timestamp_millis(1700000000000 + id) as timestamp_ntz) at"
    progress = scan_job(
        lambda: spark.range(size[0]).selectExpr("id", at, "'' v"), replace(SCAN, wait_ms=60_000), path, stop=lambda: len(waits) >= 2
    )
    assert len(waits) >= 2 and all(30 < w <= 60 for w in waits)
    got = scanned(spark, path)
    assert got.groupBy("page").count().agg(F.max("count")).first()[0] <= 7
    assert got.count() == got.select("id").distinct().count() == int(progress["id"]) + 1 >= 20


def test_scan_job_leaves_later_times_to_the_log(spark):
    table, path = stock(spark, 40), shared_dir(spark, "upto")
    scan_job(lambda: table, SCAN, path, stop_after_ms=1700000001000)
    want = table.where("at is null or at <= timestamp_ntz '2023-11-14 22:13:21'")
    assert rows(scanned(spark, path).select("id")) == rows(want.select(F.col("id").cast("string")))


def test_scan_job_looks_at_the_table_once_for_many_pages(spark, monkeypatch):
    """Pages over several zones, ended by equal rows, in the number of commits that doubling takes."""
    import cdcflow.streaming.scan as scan

    monkeypatch.setattr(scan, "ROWS_PER_ZONE", 150)
    draw, path, looks = random.Random(4), shared_dir(spark, "many"), [0]
    places = [(draw.choice([None, *range(40)]), draw.randrange(20)) for _ in range(900)]
    made = [(key, None if t is None else datetime(2024, 1, 1) + timedelta(seconds=t), f"v{i}") for i, (t, key) in enumerate(places)]
    table = spark.createDataFrame(made, "id bigint, at timestamp_ntz, v string")

    def read():
        looks[0] += 1
        return table

    scan_job(read, SCAN, path)
    assert looks[0] <= 4
    want, page, size, last = {}, 0, 0, None
    for t, key, v in sorted(((t is not None, t or 0), key, f"v{i}") for i, (t, key) in enumerate(places)):
        if size >= 7 and (t, key) != last:
            page, size = page + 1, 0
        want[v], size, last = page, size + 1, (t, key)
    assert {r["v"]: r["page"] for r in scanned(spark, path).collect()} == want
    assert page > 60 and len(Manifest(spark, path).newest()["tables"]["rows"]["parts"]) < 15


# -- dynamic filter of two streams --------------------------------------------------------------


def timed(spark, *values):
    at = [(k, None if s is None else START + timedelta(seconds=s), f"{k}{s}") for k, s in values]
    return spark.createDataFrame(at, "k string, at timestamp_ntz, v string").selectExpr("k", "cast(at as timestamp) at", "v")


def filtered(spark, batches, **how):
    """Rows and keys landed batch after batch, the stream started again for each."""
    work = shared_dir(spark, "filter")
    for some, keys in batches:
        some.write.mode("append").parquet(f"{work}/rows")
        keys.write.mode("append").parquet(f"{work}/keys")
        left, right = (stream_changes(spark, f"{work}/{n}", schema=some.schema) for n in ("rows", "keys"))
        found = N.dynamic_filter_stream(left, right, ["k"], "at", "at", **how)
        committed(found, Manifest(spark, f"{work}/out"), lambda b, _: {"append": {"rows": b}}, f"{work}/check").awaitTermination()
    return [r["v"] for r in Manifest(spark, f"{work}/out").read("rows").orderBy("v").collect()]


def test_a_filter_of_two_streams_equals_the_batch(spark):
    draw = random.Random(8)
    row_values = [(draw.choice("abcdefgh"), s) for s in range(0, 300, 3)]
    key_values = [(draw.choice("abcdefgh"), s) for s in range(0, 300, 20)] * 2
    part = lambda xs, lo, hi: timed(spark, *[x for x in xs if lo <= x[1] < hi])
    got = filtered(spark, [(part(row_values, i, i + 100), part(key_values, i, i + 100)) for i in (0, 100, 200)], before="30 seconds", after="30 seconds", delay="60 seconds")
    want = [f"{k}{s}" for k, s in row_values if any(k == q and abs(s - t) <= 30 for q, t in key_values)]
    assert got == sorted(want)


def test_late_and_unmatched_rows_of_two_streams(spark):
    batches = [
        (timed(spark, ("a", 10), ("b", 20), (None, 5), ("a", None)), timed(spark, ("z", 15), (None, 5))),
        (timed(spark, ("c", 500)), timed(spark, ("a", 30), ("z", 500))),  # the key comes after its row
        (timed(spark, ("d", 600), ("b", 21)), timed(spark, ("b", 20), ("d", 600), ("c", 520), ("z", 600))),  # b: row and key too late
    ]
    got = filtered(spark, batches, before="40 seconds", after="40 seconds", delay="60 seconds")
    assert got == ["a10", "c500", "d600"]
