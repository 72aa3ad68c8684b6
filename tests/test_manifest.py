"""Commits of several tables as one step: failures half way, repeats, merging, clean-up."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from cdcflow import files
from cdcflow.session import shared_dir
from cdcflow.streaming.manifest import Manifest


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_files(spark):
    folder = shared_dir(spark, "files")
    assert files.names(spark, folder) == []
    files.write_text(spark, f"{folder}/a", "déjà")
    assert files.read_text(spark, f"{folder}/a") == "déjà"
    with pytest.raises(FileExistsError):
        files.write_text(spark, f"{folder}/a", "other")
    assert files.names(spark, folder) == ["a"] and files.read_text(spark, f"{folder}/a") == "déjà"
    files.remove(spark, f"{folder}/a")
    files.remove(spark, f"{folder}/a")
    assert files.names(spark, folder) == []


def test_a_batch_that_fails_half_way_is_not_seen(spark, monkeypatch):
    manifest = Manifest(spark, shared_dir(spark, "half"))
    assert manifest.read("rows") is None and not manifest.has(0)
    assert manifest.commit(0, {"rows": frame(spark, 1)}, {"offsets": frame(spark, 10)}, {"a": 1})

    def fail(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(files, "write_text", fail)
        with pytest.raises(OSError):
            manifest.commit(1, {"rows": frame(spark, 2, 3)}, {"offsets": frame(spark, 20)})
    with pytest.raises(Exception, match="half"):
        manifest.commit(1, {"rows": frame(spark, 2).select(F.raise_error(F.lit("half")).cast("int").alias("v"))})
    assert rows(manifest.read("rows")) == [(1,)] and rows(manifest.read("offsets")) == [(10,)]
    assert manifest.commit(1, {"rows": frame(spark, 2)}, {"offsets": frame(spark, 20)}, {"b": 2})
    assert rows(manifest.read("rows")) == [(1,), (2,)] and rows(manifest.read("offsets")) == [(20,)]
    assert not manifest.commit(1, {"rows": frame(spark, 2)})
    assert not manifest.commit(0, {"rows": frame(spark, 2)})
    assert rows(Manifest(spark, manifest.path).read("rows")) == [(1,), (2,)]
    assert manifest.newest()["note"] == {"a": 1, "b": 2}


def test_a_reader_keeps_its_version_for_one_more_commit(spark):
    manifest = Manifest(spark, shared_dir(spark, "reader"), fanout=2)
    manifest.commit(0, {"rows": frame(spark, 0)}, {"last": frame(spark, 0)})
    version = manifest.newest()
    before, last = manifest.read("rows", version), manifest.read("last", version)
    manifest.commit(1, {"rows": frame(spark, 1)}, {"last": frame(spark, 1)})  # merges both folders
    assert rows(before) == rows(last) == [(0,)]


@pytest.mark.parametrize("fanout", [2, 3])
def test_folders_stay_few(spark, fanout):
    manifest = Manifest(spark, shared_dir(spark, "many"), fanout, {"totals": lambda df: df.groupBy().agg(F.max("v").alias("v"))})
    most = 0
    for i in range(14):
        manifest.commit(i, {"rows": frame(spark, i), "totals": frame(spark, i)}, {"offsets": frame(spark, i)})
        levels = [p["level"] for p in manifest.newest()["tables"]["rows"]["parts"]]
        assert all(levels.count(level) < fanout for level in levels)
        most = max(most, *(len(files.names(spark, f"{manifest.path}/{t}")) for t in ("rows", "totals", "offsets")))
        assert len(files.names(spark, f"{manifest.path}/versions")) <= 2
    assert rows(manifest.read("rows")) == sorted(((i,) for i in range(14)), key=repr)
    assert manifest.read("totals").agg(F.max("v")).first()[0] == 13
    assert rows(manifest.read("offsets")) == [(13,)]
    assert most <= 2 * fanout * 4  # the levels of two versions


def test_other_columns_are_an_error(spark):
    manifest = Manifest(spark, shared_dir(spark, "columns"))
    manifest.commit(0, {"rows": frame(spark, 1)})
    with pytest.raises(ValueError, match="other columns"):
        manifest.commit(1, {"rows": spark.createDataFrame([("x",)], "v string")})
    assert rows(manifest.read("rows")) == [(1,)]
    with pytest.raises(ValueError, match="two folders"):
        Manifest(spark, manifest.path, 1)


def test_rows_made_after_those_before_them(spark):
    manifest = Manifest(spark, shared_dir(spark, "later"))
    first = frame(spark, 1, 2)
    manifest.commit(0, {"rows": first, "sum": lambda: manifest.spark.read.parquet(f"{manifest.path}/rows/0-0-0").agg(F.sum("v").cast("int").alias("v"))})
    assert rows(manifest.read("sum")) == [(3,)]
