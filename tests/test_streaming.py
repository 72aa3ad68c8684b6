import random
import shutil

import pytest
from helpers import plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_changelog import event, log

from cdcflow.config import CaptureOptions
from cdcflow.operators import changelog as C
from cdcflow.operators import progress as P
from cdcflow.operators import text
from cdcflow.operators.text import running_word_count, word_count, word_rows
from cdcflow.plans.capture import capture, capture_stream, read_captured
from cdcflow.session import shared_dir
from cdcflow.sources.changes import stream_changes, stream_lines
from cdcflow.streaming import jobs
from cdcflow.streaming.manifest import Manifest

OPTIONS = CaptureOptions(database="app", tables=["a", "b"], output_columns=["id", "at"], primary_key=["id"], update_time="at")


def add(df, path, name):
    """One more input file."""
    scratch = shared_dir(df.sparkSession, "one")
    df.coalesce(1).write.parquet(scratch)
    import glob
    import os

    os.makedirs(path, exist_ok=True)
    shutil.copy(glob.glob(f"{scratch}/part-*")[0], f"{path}/{name}.parquet")


def batches(spark):
    make = lambda lo, hi: log(
        spark,
        *[
            event(i, ["insert", "update", "delete"][i % 3], table=f"app.{'abc'[i % 7 % 3]}", after={"id": str(i), "at": str(i * 10)})
            for i in range(lo, hi)
        ],
    )
    return make(0, 40), make(40, 55), make(55, 90)


def test_capture_restarts_without_loss_or_repeats(spark):
    work = shared_dir(spark, "restart")
    source, out, check = (f"{work}/{n}" for n in ("in", "out", "check"))
    all_events = None
    for i, part in enumerate(batches(spark)):
        add(part, source, f"p{i}")
        all_events = part if all_events is None else all_events.unionByName(part)
        stream = stream_changes(spark, source, files_per_batch=1)
        capture_stream(stream, OPTIONS, out, check).awaitTermination()
        assert rows(read_captured(spark, out)) == rows(capture(all_events, OPTIONS))
        wanted = P.latest_offsets(C.only_changes(C.only_tables(all_events, OPTIONS.db_tables)), ["id"], "at")
        assert rows(jobs.read_offsets(spark, out)) == rows(wanted)


def test_a_repeated_batch_changes_nothing(spark):
    first, second, _ = batches(spark)
    path = f"{shared_dir(spark, 'offsets')}/o"
    manifest = Manifest(spark, path)
    save = lambda part, i: manifest.commit(i, replace={"offsets": jobs.later_offsets(part, ["id"], "at", manifest.read("offsets"))})
    assert jobs.read_offsets(spark, path).count() == 0
    assert save(first, 0)
    assert rows(jobs.read_offsets(spark, path)) == rows(P.latest_offsets(first, ["id"], "at"))
    assert save(second, 1)
    once = rows(jobs.read_offsets(spark, path))
    assert not save(second, 1) and not save(first, 0)
    assert rows(jobs.read_offsets(spark, path)) == once == rows(P.latest_offsets(first.unionByName(second), ["id"], "at"))


def test_emit_stream(spark):
    work = shared_dir(spark, "emit")
    for i, part in enumerate(batches(spark)):
        add(part, f"{work}/in", f"p{i}")
    out = C.emit(C.only_changes(stream_changes(spark, f"{work}/in")), ["id"])
    jobs.emit_stream(out, f"{work}/out", f"{work}/check").awaitTermination()
    assert spark.read.parquet(f"{work}/out").count() == 60


LINES = ["To be, or not to be,--that is the question:--", "", "  BE été be2 ", "the"]
COUNTS = {"to": 2, "be": 3, "or": 1, "not": 1, "that": 1, "is": 1, "the": 2, "question": 1, "t": 1, "be2": 1}


def test_word_count(spark):
    df = spark.createDataFrame([(t,) for t in LINES], "text string")
    assert {r["word"]: r["n"] for r in word_count(df, "text").collect()} == COUNTS


def test_running_word_count(spark):
    df = spark.createDataFrame(list(enumerate(LINES * 5)), "id bigint, text string")
    got = running_word_count(df, "text", "id", lines_per_chunk=3).orderBy("id", "pos").collect()
    seen = {}
    for r in got:
        seen[r["word"]] = seen.get(r["word"], 0) + 1
        assert r["n"] == seen[r["word"]]
    assert seen == {w: 5 * n for w, n in COUNTS.items()}


def test_word_stream_continues_its_totals(spark):
    work = shared_dir(spark, "lines")
    lines = spark.createDataFrame([(t,) for t in LINES], "value string")
    for n in (1, 2):
        lines.write.mode("append").text(f"{work}/in")
        jobs.count_words(stream_lines(spark, f"{work}/in"), "value", f"{work}/out", f"{work}/check").awaitTermination()
        got = {r["word"]: r["n"] for r in jobs.current_word_counts(spark, f"{work}/out").collect()}
        assert got == {w: n * c for w, c in COUNTS.items()}


def test_handlers_get_batches(spark):
    work = shared_dir(spark, "handlers")
    add(batches(spark)[0], f"{work}/in", "p")
    seen = []
    stream = stream_changes(spark, f"{work}/in").where(F.col("db_table") == "app.a")
    jobs.each_batch(stream, lambda df, i: seen.append((i, df.count())), f"{work}/check").awaitTermination()
    wanted = batches(spark)[0].where("db_table = 'app.a'").count()
    assert seen == [(0, wanted)]
    by_table = jobs.by_table({"app.a": [lambda df, i: seen.append(df.count())] * 2, "app.z": [lambda df, i: seen.append(df.count())]})
    jobs.each_batch(stream_changes(spark, f"{work}/in"), by_table, f"{work}/check2").awaitTermination()
    assert seen[1:] == [wanted, wanted, 0]


def test_shared_dir(spark, monkeypatch):
    settings = {"spark.checkpoint.dir": "hdfs://shared/place", "spark.master": "yarn"}
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: settings.get(key, default))
    assert shared_dir(spark, "x").startswith("hdfs://shared/place/cdcflow-x-")
    del settings["spark.checkpoint.dir"]
    with pytest.raises(ValueError, match="shared by the cluster"):
        shared_dir(spark, "x")


def test_running_word_count_shuffles_lines_and_chunk_words(spark, monkeypatch):
    """No row is shuffled for each word; slices, shared ids, odd texts and ids far apart give what a window gives."""
    monkeypatch.setattr(text, "_AT_ONCE", 40)
    draw = random.Random(4)
    some = ["", None, "  a b", "b", "ÉAKé k_9 İx", "a,b;a", "z " * 30, "-", "日本 a 日本"]
    lines = [(draw.choice([i, i // 4, -i, i * 10**6]), draw.choice(some)) for i in range(300)]
    df = spark.createDataFrame(lines, "id bigint, text string").repartition(3)
    tokens = word_rows(df, "text", ["id"])
    before = Window.partitionBy("word").orderBy("id", "pos").rowsBetween(Window.unboundedPreceding, 0)
    want = tokens.withColumn("n", F.count("*").over(before))
    got = running_word_count(df, "text", "id", lines_per_chunk=10)
    assert rows(got, "id", "pos", "word", "n") == rows(want, "id", "pos", "word", "n")
    assert "Window [count" not in plan(got) and "posexplode" not in plan(got)


def test_running_word_count_needs_ids(spark):
    lines = spark.createDataFrame([(1, "a b"), (None, " - "), (None, None)], "id bigint, text string")
    assert rows(running_word_count(lines, "text", "id"), "word", "n") == [("a", 1), ("b", 1)]
    with pytest.raises(Exception, match="null in"):
        running_word_count(lines.union(spark.createDataFrame([(None, "c")], lines.schema)), "text", "id").collect()
