"""Allow and block rules for URLs, looked up in a sorted array of digests that tasks map into memory.

The rules' 64-bit xxhash digests stand in one sorted array, their full strings in another file beside it. Each URL is probed
with its host and every parent domain, and every path beginning as long as some rule's path. Probes are hashed and found by a
vectorised binary search; a hit counts only if the stored string is the probe, so a collision can't judge a URL. Of the rules
that fit, the longest wins.

The files go to every executor through Spark, also to one that starts later. Their size is that of the rules.

Nulls and odd rows: a null url, or one without ``://``, has an empty host and path and gets the default verdict; ids may be
null or repeat; other columns are ignored; an empty frame gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import io
import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.llm.frames import pick, tidy
from cdcflow.session import shared_dir

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _write(spark: SparkSession, path: str, data: bytes) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(data)
    finally:
        out.close()


def publish_rules(spark: SparkSession, rules: dict[str, str]) -> tuple[str, str]:
    """Write the sorted digests and the strings to the shared folder, and have Spark bring them to executors; their names."""
    words = sorted(((xxhash.xxh64_intdigest(rule.encode()), rule.encode(), verdict == ALLOW) for rule, verdict in rules.items()))
    table = np.array([(d, 0, len(w), allow) for d, w, allow in words], [("digest", "<u8"), ("at", "<u8"), ("length", "<u4"), ("allow", "?")])
    table["at"] = np.concatenate([[0], np.cumsum(table["length"])[:-1]]) if len(table) else 0
    buffer = io.BytesIO()
    np.save(buffer, table)
    parts = {"digests": buffer.getvalue(), "strings": b"".join(w for _, w, _ in words) or b"\0"}
    stamp = hashlib.sha256(parts["digests"] + parts["strings"]).hexdigest()[:24]
    names = tuple(f"rules-{stamp}.{kind}" for kind in parts)
    if not getattr(spark.sparkContext, "_published_rules", {}).get(stamp):
        folder = shared_dir(spark, "rules")
        for name, data in zip(names, parts.values(), strict=True):
            _write(spark, f"{folder}/{name}", data)
            spark.sparkContext.addFile(f"{folder}/{name}")
        spark.sparkContext._published_rules = getattr(spark.sparkContext, "_published_rules", {}) | {stamp: True}
    return names


@functools.lru_cache(maxsize=4)
def _mapped(digests: str, strings: str) -> tuple[np.ndarray, mmap.mmap]:
    with open(SparkFiles.get(strings), "rb") as f:
        return np.load(SparkFiles.get(digests), mmap_mode="r"), mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)


def _probes(host: str, path: str, path_lengths: list[int], longest: int) -> Iterator[str]:
    """The host's suffixes that can be a rule's host, each with the path's beginnings."""
    at = 0
    if len(host) > longest:
        at = host.find(".", len(host) - longest - 1) + 1
        if not at:
            return
    while True:
        for n in path_lengths:
            if n <= len(path):
                yield host[at:] + path[:n]
        at = host.find(".", at) + 1
        if not at:
            return


def judge_urls(pages: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """id, host, path, rule, verdict for each row. A rule is ``host/path``; it fits its host and all subdomains."""
    names = publish_rules(pages.sparkSession, rules)
    lengths = sorted({len(rule) - rule.index("/") for rule in rules})
    longest = max((rule.index("/") for rule in rules), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, strings = _mapped(*names)
        for batch in batches:
            rows, probes = [], []
            for row, (host, path) in enumerate(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)):
                for probe in _probes(host, path, lengths, longest) if host else ():
                    rows.append(row)
                    probes.append(probe.encode())
            found, allow = [None] * batch.num_rows, [None] * batch.num_rows
            keys = np.fromiter(map(xxhash.xxh64_intdigest, probes), np.uint64, len(probes))
            first, end = np.searchsorted(table["digest"], keys, "left"), np.searchsorted(table["digest"], keys, "right")
            for i in np.flatnonzero(end > first):
                for rule in table[first[i] : end[i]]:
                    at, n = int(rule["at"]), int(rule["length"])
                    if strings[at : at + n] == probes[i] and (found[rows[i]] is None or n > len(found[rows[i]])):
                        found[rows[i]], allow[rows[i]] = probes[i], bool(rule["allow"])
            verdict = [default if a is None else ALLOW if a else BLOCK for a in allow]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("host"), batch.column("path"), pa.array([f and f.decode() for f in found], pa.string()), pa.array(verdict, pa.string())],
                ["id", "host", "path", "rule", "verdict"],
            )

    base = pick(pages, id=id_col, url=url_col).select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    id_type = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(tidy(run), f"id {id_type}, host string, path string, rule string, verdict string")
