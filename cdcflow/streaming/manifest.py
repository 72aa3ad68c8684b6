"""Tables that gain rows batch by batch, all of them or none: a manifest names the folders that count.

A batch writes its folders first and then one small file, the manifest's next version, which names them together with the
folders of earlier batches. Readers go by the newest version, so they never see rows without the offsets or totals that
belong to them, nor a batch that failed half way. A batch that comes again after a restart is recognised by its id.

Folders of a table are merged by level, ``fanout`` at a time, so that their number grows with the logarithm of the
number of batches and each row is written again as often. Folders that neither the newest version nor the one before it names
are removed: a reader has until the second commit after its version to finish. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cdcflow import files

_VERSIONS = "versions"
Rows = DataFrame | Callable[[], DataFrame]
Merge = Callable[[DataFrame], DataFrame]


class Manifest:
    """The committed state of the tables under one folder."""

    def __init__(self, spark: SparkSession, path: str, fanout: int = 8, merge: Mapping[str, Merge] | None = None):
        """``merge`` makes one folder's rows of several folders' for the tables it names, such as one total a word."""
        if fanout < 2:
            raise ValueError("merging needs at least two folders at a time")
        self.spark, self.path, self.fanout, self.merge = spark, path.rstrip("/"), fanout, dict(merge or {})

    def newest(self) -> dict:
        """The newest version: batch (-1 before the first), tables, note."""
        versions = self._versions()
        if not versions:
            return {"batch": -1, "tables": {}, "note": {}}
        return json.loads(files.read_text(self.spark, f"{self.path}/{_VERSIONS}/{versions[-1]}"))

    def has(self, batch_id: int) -> bool:
        return self.newest()["batch"] >= batch_id

    def read(self, table: str, version: dict | None = None) -> DataFrame | None:
        """A table's committed rows; none if nothing was ever committed to it. A ``version`` read before keeps several tables in step."""
        found = (version or self.newest())["tables"].get(table)
        if found is None:
            return None
        schema = T.StructType.fromJson(found["schema"])
        folders = [f"{self.path}/{part['folder']}" for part in found["parts"]]
        return self.spark.read.schema(schema).parquet(*folders)

    def commit(
        self, batch_id: int, append: Mapping[str, Rows] | None = None, replace: Mapping[str, DataFrame] | None = None, note: Mapping | None = None
    ) -> bool:
        """Add rows to some tables and replace others, with a note (a JSON object laid over the last one), as one step.

        A function instead of rows is called when those named before it are written. False, and nothing done, if the batch
        is there already.
        """
        before = self.newest()
        if before["batch"] >= batch_id:
            return False
        tables = dict(before["tables"])
        for table, rows in (append or {}).items():
            rows = rows if isinstance(rows, DataFrame) else rows()
            parts = [*(tables[table]["parts"] if table in tables else []), self._write(table, rows, batch_id, batch_id, 0)]
            schema = rows.schema if table not in tables else T.StructType.fromJson(tables[table]["schema"])
            if [(f.name, f.dataType) for f in rows.schema] != [(f.name, f.dataType) for f in schema]:
                raise ValueError(f"{table} has other columns: {rows.schema.simpleString()}")
            tables[table] = {"schema": schema.jsonValue(), "parts": self._merged(table, parts, schema)}
        for table, rows in (replace or {}).items():
            tables[table] = {"schema": rows.schema.jsonValue(), "parts": [self._write(table, rows, batch_id, batch_id, 0)]}
        after = {"batch": batch_id, "tables": tables, "note": before["note"] | dict(note or {})}
        files.write_text(self.spark, f"{self.path}/{_VERSIONS}/{batch_id:020d}.json", json.dumps(after))
        self._clean(before, after)
        return True

    def _merged(self, table: str, parts: list[dict], schema: T.StructType) -> list[dict]:
        level = 0
        while len(same := [p for p in parts if p["level"] == level]) >= self.fanout:
            rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/{p['folder']}" for p in same])
            rows = self.merge.get(table, lambda df: df.hint("rebalance"))(rows)
            one = self._write(table, rows, same[0]["first"], same[-1]["last"], level + 1)
            parts = [p for p in parts if p["level"] != level] + [one]
            level += 1
        return parts

    def _write(self, table: str, rows: DataFrame, first: int, last: int, level: int) -> dict:
        folder = f"{table}/{first}-{last}-{level}"
        rows.write.mode("overwrite").parquet(f"{self.path}/{folder}")
        return {"folder": folder, "first": first, "last": last, "level": level}

    def _versions(self) -> list[str]:
        return [name for name in files.names(self.spark, f"{self.path}/{_VERSIONS}") if not name.startswith(".")]

    def _clean(self, before: dict, after: dict) -> None:
        named = {p["folder"] for version in (before, after) for table in version["tables"].values() for p in table["parts"]}
        for table in after["tables"]:
            for name in files.names(self.spark, f"{self.path}/{table}"):
                if f"{table}/{name}" not in named:
                    files.remove(self.spark, f"{self.path}/{table}/{name}")
        for name in self._versions()[:-2]:
            files.remove(self.spark, f"{self.path}/{_VERSIONS}/{name}")


def committed(
    rows: DataFrame, manifest: Manifest, make: Callable[[DataFrame, dict], dict], checkpoint: str, mode: str = "append", once: bool = True
) -> StreamingQuery:
    """Commit each micro-batch. ``make`` gets its rows, read once, and the version before it, and gives ``commit``'s arguments.

    Batch ids are the checkpoint's, so another checkpoint on the same manifest is an error.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        before = manifest.newest()
        if before["note"].get("checkpoint", checkpoint) != checkpoint:
            raise ValueError(f"{manifest.path} was written with the checkpoint {before['note']['checkpoint']}")
        if before["batch"] >= batch_id:
            return
        kept = batch.persist()
        try:
            manifest.commit(batch_id, note={"checkpoint": checkpoint}, **make(kept, before))
        finally:
            kept.unpersist()

    writer = rows.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
