"""The registered queries without SQL, column by column against plain Python, and the pipeline's stages."""

import hashlib
import os
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cdcflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def test_op1(spark, texts):
    got = QUERIES["op1_sharding"](spark, DATA).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    slots = defaultdict(list)
    for r in got:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    assert max(map(len, slots.values())) - min(len(slots.get(i, [])) for i in range(16)) <= 1


def test_op5(spark, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op5_packing"](spark, DATA).collect():
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids, at = [*whole.encode(text, add_special_tokens=False).ids, 0], 0
        for start, length, crc, total in sorted(pieces[doc_id]):
            part = b"".join(i.to_bytes(4, "little") for i in ids[start : start + length])
            assert (start, crc, total) == (at, zlib.crc32(part), len(ids))
            at += length
        assert at == len(ids)
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024
    assert sorted(sequences) == list(range(len(sequences)))


def test_op6(spark, texts):
    got = QUERIES["op6_quality"](spark, DATA).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_op7_spans(spark, texts):
    got = QUERIES["op7_line_dedup"](spark, DATA).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        raw = texts[r["doc_id"]].encode()
        kept, at = b"", 0
        for start, end in sorted((s["start"], s["end"]) for s in r["removed"]):
            kept, at = kept + raw[at:start], end
        kept += raw[at:]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(raw), len(raw) - len(kept), len(r["removed"]))
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_op9_against_all_windows(spark, texts):
    seen, raws = Counter(), {i: t.encode() for i, t in texts.items()}
    windows = lambda raw: (raw[k : k + 400] for k in range(len(raw) - 399))
    for raw in raws.values():
        seen.update(hash(w) for w in windows(raw))
    for r in QUERIES["op9_suffix_dedup"](spark, DATA).collect():
        raw = raws[r["doc_id"]]
        gone = bytearray(len(raw))
        for k, w in enumerate(windows(raw)):
            if seen[hash(w)] > 1:
                gone[k : k + 400] = b"\1" * 400
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(raw), sum(gone), spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_stages_remove_what_the_one_before_saved(spark, tmp_path, texts):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names, left = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        done = stage(spark, docs, DATA)
        assert not [path for path in left if os.path.exists(path)]
        done.write.parquet(f"{tmp_path}/{i}")
        left = list(corpus_pipeline._tables_before)
        assert all(os.path.exists(path) for path in left)
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == names
    assert {r[0] for r in docs.select("doc_id").distinct().collect()} <= set(texts)
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 1024
    assert corpus_pipeline.run(spark, DATA).count() == docs.count()
