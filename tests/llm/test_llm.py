"""The operators against plain Python on small inputs, odd rows included."""

import collections
import hashlib
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cdcflow.llm import imatch, line_dedup, metric_search, mixing, ngram_join, packing, quality, sharding, suffix_dedup, url_filter
from cdcflow.llm.components import components
from cdcflow.llm.deep_shallow import sort_strings
from cdcflow.llm.queries import QUERIES, SPECIAL_TOKENS, SQL

DATA = "/root/testdata/sf0.001"
TOKENS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, SPECIAL_TOKENS)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = con.execute(SQL[name])
    columns = sorted(c[0] for c in want.description)
    want = con.execute(f"select {', '.join(f'\"{c}\"' for c in columns)} from ({SQL[name]})").fetchall()
    got = QUERIES[name](spark, DATA)
    assert sorted(got.columns) == columns
    assert sorted(map(repr, values(got, *columns))) == sorted(map(repr, want))


def test_shards(odd, none):
    size = sharding.text_size(F.col("text"))
    got = values(sharding.shards(odd, size, 4, bucket_bytes=50_000), "shard", "slot", "row.doc_id", "row.shard")
    assert sorted(str(r[2]) for r in got) == sorted(str(r[0]) for r in odd.select("doc_id").collect())
    for shard in range(4):
        slots = sorted(r[1] for r in got if r[0] == shard)
        assert slots == list(range(len(slots))) and len(slots) in (len(got) // 4, len(got) // 4 + 1)
    assert values(sharding.shards(odd, size, 4, bucket_bytes=50_000), "shard", "slot", "row.doc_id", "row.shard") == got
    assert sharding.shards(none, size).count() == 0


def test_mix(odd, none):
    got = values(mixing.mix(odd, shards=4, block_words=64), "row.doc_id", "row.source", "row.text", "size", "source_size", "target", "pieces")
    assert len(got) == odd.count()
    taken, targets = collections.Counter(), {}
    for _, source, text, size, _, target, pieces in got:
        assert size == len([w for w in (text or "").translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w])
        words = sum(p["words"] for p in pieces)
        assert words <= 2 * size
        taken[source] += words
        targets[source] = target
    assert all(abs(taken[s] - t) <= 0.5 for s, t in targets.items())
    assert sorted(map(repr, values(mixing.mix(odd, shards=4, block_words=64), "row.doc_id", "pieces"))) == sorted(repr((r[0], r[6])) for r in got)
    assert mixing.mix(none).count() == 0
    rows = mixing.mixed_rows(mixing.mix(odd, shards=4, block_words=64)).select("row.text")
    assert sum(len(t.split()) for (t,) in values(rows, "text")) == sum(taken.values())


def test_mix_is_dealt_and_written_by_shard(spark):
    docs = [(k, " ".join(f"w{k}x{i}" for i in range(4)), source) for k, source in enumerate(["a"] * 300 + ["b"] * 150 + ["c"] * 90 + [None] * 60)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string").withColumn("n_chars", F.length("text"))
    dealt, targets = collections.defaultdict(set), {}
    for source, target, pieces in values(mixing.mix(df, shards=5, block_words=16), "row.source", "target", "pieces"):
        targets[source] = target
        for p in pieces:
            dealt[p["shard"], source].add(p["block"])
    sources = ["a", "b", "c", None]
    quotas = np.array([-(-round(targets[s]) // 16) for s in sources])
    for shard in range(5):
        assert [len(dealt[shard, s]) for s in sources] == mixing.split_quotas(quotas, shard, 5, 5).tolist()
    want = [r[2] for r in sorted(values(mixing.mixed_rows(mixing.mix(df)), "_shard", "_key", "row.doc_id"))]
    written = values(corpus_pipeline.source_mix(spark, df, DATA), F.input_file_name(), "doc_id")
    assert [r[1] for r in sorted(written, key=lambda r: r[0].rsplit("/", 1)[1])] == want
    pieces = values(QUERIES["op2_mixing"](spark, DATA), "taken", "pieces")
    assert all(sum(p["words"] for p in of) == n and all(0 <= p["shard"] < 16 for p in of) for n, of in pieces)


def test_targets_and_tree(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 50)], "source string, source_size bigint")
    got = {r[0]: r[1] for r in values(mixing.targets(sizes), "source", "target")}
    left, cap = {"a": 5.0, "b": 2.0, "c": 1.0, None: 5.0}, {"a": 20.0, "b": 2000.0, "c": 2000.0, None: 100.0}
    budget, want = 1.5 * 2060, {}
    while True:
        level = budget / sum(left.values())
        over = [s for s in left if level * left[s] > cap[s]]
        if not over:
            break
        for s in over:
            want[s] = cap[s]
            budget -= cap[s]
            del left[s]
    want |= {s: level * w for s, w in left.items()}
    assert got == pytest.approx(want)
    quotas = np.array([7, 0, 30, 4])
    assert (sum(mixing.split_quotas(quotas, k, 5, 1) for k in range(5)) == quotas).all()


def test_similar_texts(spark, odd, none):
    draw = np.random.default_rng(4)
    base = [f"v{i}" for i in draw.integers(0, 5000, 120)]
    docs = []
    for i in range(90):
        text = list(base)
        for at in draw.integers(0, 120, i % 5):
            text[at] = f"n{i}"
        docs.append((i, " ".join(text)))
    docs += [(100 + i, " ".join(f"z{x}" for x in draw.integers(0, 9000, 60))) for i in range(20)]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in docs}
    links = {i: [j for j in sets if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in sets}
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    for unit in (8, 256):  # tiles, and one unit for each bucket
        got = {r[0]: r[1] for r in values(ngram_join.similar_texts(df, unit_texts=unit).rows, "doc_id", "n_links")}
        assert got == {i: len(v) for i, v in links.items()}
    assert ngram_join.similar_texts(none).rows.count() == 0
    kept = ngram_join.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(map(str, (r[0] for r in values(kept, "doc_id")))) == sorted(map(str, [1, 4, 6, 7, None, 8]))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (None, 5), (7, 7)]
    got = dict(values(components(spark.createDataFrame(edges, "a bigint, b bigint")), "node", "label"))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_metric_search(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [float(x) for x in draw.normal(size=6)]) for i in range(900)]
    rows += [(900 + i, [0.5] * 6) for i in range(400)] + [(2000, None), (2001, [None] * 6), (2002, [float("nan")] * 6), (None, [1.0] * 6), (0, rows[0][1]), (3000, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = metric_search.top_by_inner_product(df, df.where("vec_id % 100 = 0"), tree_rows=500)
    ints = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in rows if i is not None and v and None not in v and not np.isnan(v).any()}
    want = []
    for q in (i for i in ints if i % 100 == 0):
        near = sorted((-int(ints[q] @ x), i) for i, x in ints.items() if i != q and len(x) == len(ints[q]))[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(near)]
    assert sorted(values(found, "query_id", "rank", "id", "score")) == sorted(want)
    assert metric_search.top_by_inner_product(df.where("vec_id < 0"), df.where("vec_id < 0")).count() == 0


def test_empty_vectors_meet_one_another(spark):
    df = spark.createDataFrame([(i, []) for i in range(700)] + [(1000, [1.0]), (1001, [2.0])], "vec_id bigint, embedding array<float>")
    got = values(metric_search.top_by_inner_product(df, df.where("vec_id in (0, 300, 1000)"), tree_rows=200), "query_id", "rank", "id", "score")
    want = [(q, k + 1, i, 0) for q in (0, 300) for k, i in enumerate([i for i in range(12) if i != q][:10])]
    assert sorted(got) == sorted([*want, (1000, 1, 1001, 2 * 1024 * 1024)])


def test_packing(spark, odd, none):
    from tokenizers import Tokenizer

    pieces = packing.token_pieces(odd, *TOKENS).cache()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = collections.defaultdict(list)
    for doc_id, start, ids, total in values(pieces, "id", "start", "ids", "doc_tokens"):
        got[doc_id, total].append((start, ids))
    for doc_id, text in {(r[0], r[1]) for r in values(odd, "doc_id", "text")}:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        parts = sorted(set(got[doc_id, len(ids)]))
        assert np.frombuffer(b"".join(p for _, p in parts), "<u4").tolist() == ids
    packed = values(packing.pack(pieces, group_rows=3), "length", "sequence_id", "offset")
    assert len(packed) == pieces.count()
    windows = collections.defaultdict(list)
    for length, sequence, offset in packed:
        windows[sequence].append((offset, length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(packing.token_pieces(none, *TOKENS)).count() == 0


def test_best_fit_decreasing_by_counts():
    draw = np.random.default_rng(1)
    for window in (16, 100):
        lengths = draw.integers(1, window + 1, 500).tolist()
        rooms = []
        for n in sorted(lengths, reverse=True):
            fit = min((r for r in rooms if r >= n), default=None)
            if fit is None:
                rooms.append(window - n)
            else:
                rooms[rooms.index(fit)] -= n
        counts = collections.Counter(lengths)
        steps = packing.best_fit_decreasing(counts, window)
        filled = collections.Counter()
        for k, (length, first, opened, each, _) in enumerate(steps.tolist()):
            end = steps[k + 1][1] if k + 1 < len(steps) and steps[k + 1][0] == length else counts[length]
            for piece in range(first, end):
                filled[opened + (piece - first) // each] += length
        assert sorted(window - f for f in filled.values()) == sorted(rooms)


def test_quality_learns(spark, odd, none):
    good = [(i, "the quiet river runs by the old mill " * (1 + i % 9), 1) for i in range(80)]
    bad = [(100 + i, "win*** cash$$$ now### free&&& " * (1 + i % 7), 0) for i in range(80)]
    df = spark.createDataFrame([*good, *bad], "doc_id bigint, text string, quality int")
    model = quality.train(df, df.where("doc_id % 5 > 0"))
    scores = values(quality.score(df.where("doc_id % 5 = 0"), model), "row.quality", "score")
    assert min(s for q, s in scores if q == 1) > max(s for q, s in scores if q == 0)
    assert len(values(quality.score(odd, model), "score")) == odd.count() and quality.score(none, model).count() == 0
    assert quality.train(df, df.where("quality = 1")) is None
    assert {s for (s,) in values(quality.score(odd, None), "score")} == {0.5}


def test_gradients_match_differences():
    draw = np.random.default_rng(0)
    p = {"embedding": draw.normal(size=(257, quality.EMBEDDING)), "filters": draw.normal(size=(quality.TAPS, 2 * quality.EMBEDDING, quality.FILTERS)), "bias": np.zeros(quality.FILTERS), "weights": draw.normal(size=2 * quality.FILTERS), "intercept": np.zeros(1)}
    block, of = draw.integers(0, 256, (5, quality.CHUNK)).astype(np.uint16), np.array([0, 0, 1, 1, 2])
    label, weight = np.array([1, 0, 1]), np.ones(3)

    def loss():
        model = quality.Model(p["embedding"], p["filters"], p["bias"], p["weights"], 0.0)
        value = np.maximum(np.concatenate([quality._responses(model, block)]).max(axis=1) + p["bias"], 0)
        z = quality._features(value, of) @ p["weights"] + p["intercept"]
        return float(np.mean(np.log1p(np.exp(-z)) * (label == 1) + np.log1p(np.exp(z)) * (label == 0)))

    got = quality._gradients(p, block, of, label, weight)
    for name, at in (("weights", 3), ("bias", 2), ("filters", (1, 5, 4)), ("embedding", (int(block[0, 7]), 3))):
        kept, step = p[name][at], 1e-5
        p[name][at] = kept + step
        up = loss()
        p[name][at] = kept - step
        slope = (up - loss()) / (2 * step)
        p[name][at] = kept
        assert got[name][at] == pytest.approx(slope, rel=0.02, abs=2e-3)


def test_line_dedup(spark, odd, none):
    passage = "Alpha beta gamma delta epsilon zeta eta. Theta iota kappa lambda mu nu xi omicron. Pi rho sigma tau upsilon phi chi psi omega."
    docs = [(3, f"Own words here.\n{passage}\nMore own words."), (1, f"Before it. {passage.upper()} After it."), (2, "Own words here.\nNothing else."), (4, f"{passage} {passage}")]
    got = {r[0]: r[1:] for r in values(line_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string")), "row.doc_id", "kept", "removed")}
    assert got[1] == (docs[1][1], []) and got[2] == (docs[2][1], [])
    assert got[3][0] == "\nMore own words." and got[4][0].strip() == ""
    for doc_id, text in docs:
        raw, at, kept = text.encode(), 0, b""
        for s in got[doc_id][1]:
            kept, at = kept + raw[at : s["start"]], s["end"]
        assert (kept + raw[at:]).decode() == got[doc_id][0]
    assert line_dedup.remove_repeats(none).count() == 0
    many = spark.createDataFrame(docs + [(5 + i, f"{passage}\nTail {i}.") for i in range(40)], "doc_id bigint, text string")
    cold, hot = (values(line_dedup.remove_repeats(many, hot_units=n), "row.doc_id", "kept") for n in (1, 1000))
    assert sorted(cold) == sorted(hot) and all(kept == f"\nTail {i - 5}." for i, kept in hot if i >= 5)
    assert len(values(line_dedup.remove_repeats(odd), "kept", "row.key")) == odd.count()


def without_repeats(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [kept for _, kept in sorted(values(line_dedup.remove_repeats(df), "row.doc_id", "kept"))]


@pytest.mark.parametrize("kind", ["lower", "capitals", "no spaces"])
def test_line_dedup_of_passages_inside_sentences(spark, kind):
    draw = np.random.default_rng(3)
    letters, sep = ("\u6f22\u5b57\u4eee\u540d\u4e2d\u6587", "") if kind == "no spaces" else ("abcdef", " ")
    word = lambda: "".join(draw.choice(list(letters), 7))
    run = lambda n: [word().capitalize() if kind == "capitals" and i % 9 == 4 else word() for i in range(n)]
    passages = [run(60) for _ in range(8)]
    hosts = [(run(k + 3), run(2 * k + 4)) for k in range(16)]
    texts = [sep.join([*a, *passages[k % 8], *b]) for k, (a, b) in enumerate(hosts)]
    kept = without_repeats(spark, texts)
    assert kept[:8] == texts[:8]
    edge = 15  # words, the most that may stay on a side
    for (a, b), text in zip(hosts[8:], kept[8:], strict=True):
        assert text.startswith(sep.join(a)) and text.endswith(sep.join(b))
        if sep:
            assert len(text.split()) <= len(a) + len(b) + 2 * edge
        else:
            assert len(text) <= 7 * (len(a) + len(b)) + 2 * edge


def test_line_dedup_of_short_lines(spark):
    shared = ["All rights reserved by the people who wrote it.", "Contents", "\u6771\u4eac\u90fd", "\u00dcber uns"]
    texts = ["\n".join([f"only{k} here{k}", *shared, f"last{k}"]) for k in range(3)] + ["a\nmenu\nb\nmenu\nc", shared[0], f"Not a line: {shared[0]}"]
    kept = without_repeats(spark, texts)
    assert kept == [texts[0], "only1 here1\n\nlast1", "only2 here2\n\nlast2", "a\nmenu\nb\n\nc", "", texts[5]]


def test_line_dedup_keeps_neighbours_that_repeat_in_different_documents(spark):
    pieces = [" ".join(f"{name}{i}" for i in range(8)).capitalize() + "." for name in ("p", "q", "r")]
    texts = [f"Start{k} here. {piece} End{k} there." for k, piece in enumerate(pieces)] + ["Own. " + " ".join(pieces) + " Tail."]
    assert without_repeats(spark, texts) == texts


def test_imatch(odd, none):
    got = values(imatch.fingerprint_edits(odd, range_bytes=20_000), "doc_id", "n_chars", "edited_sha256", "fingerprint", "near_edited", "near_next")
    rows = [(r[0], r[1] or "") for r in values(odd, "doc_id", "text")]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for k, (doc_id, text) in enumerate(rows):
        half = len(text) // 2
        edit = text[: len(text) - half] + rows[(k + 1) % len(rows)][1][:half]
        want.append((doc_id, len(text), hashlib.sha256(edit.encode()).hexdigest()))
    assert sorted(map(repr, (r[:3] for r in got))) == sorted(map(repr, want))
    prints = {r[0]: r[3] for r in got}
    assert prints[1] == prints[2] and prints[4] == prints[5] == prints[6] and prints[7] != prints[1]
    assert all(0 <= r[4] <= 1 and 0 <= r[5] <= 1 for r in got)
    assert imatch.fingerprint_edits(none).count() == 0


def test_imatch_splits_an_id_of_many_rows_and_null_ids(spark):
    docs = [(7 if k % 3 == 0 else None if k % 3 == 1 else k, f"t{k} " * 60) for k in range(300)] + [(7, "same " * 60)] * 5
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    hashed = values(df.select("doc_id", "text", F.xxhash64("text").alias("h")), "doc_id", "text", "h")
    hashed.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    want = []
    for k, (doc_id, text, _) in enumerate(hashed):
        half = len(text) // 2
        edit = text[: len(text) - half] + hashed[(k + 1) % len(hashed)][1][:half]
        want.append((doc_id, len(text), hashlib.sha256(edit.encode()).hexdigest()))
    done = imatch.fingerprint_edits(df, range_bytes=3_000)
    assert sorted(map(repr, values(done, "doc_id", "n_chars", "edited_sha256"))) == sorted(map(repr, want))
    per_task = [n for (n,) in values(done.groupBy(F.spark_partition_id()).count(), "count")]
    assert max(per_task) <= 40


def repeated(texts, n):
    count = collections.Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    for t in texts:
        spans = suffix_dedup.merged([(i, i + n) for i in range(len(t) - n + 1) if count[t[i : i + n]] > 1])
        at, kept = 0, b""
        for a, b in spans:
            kept, at = kept + t[at:a], b
        yield kept + t[at:], spans


@pytest.mark.parametrize("group, hot", [(2000, 1000), (1, 1000), (2000, 1)])
def test_suffix_dedup(spark, odd, none, group, hot):
    draw = np.random.default_rng(8)
    pick = lambda n: bytes(draw.integers(97, 100, n).astype(np.uint8)).decode()
    a, b = pick(90), pick(70)
    texts = [a + pick(50), pick(30) + a, b + b, pick(20) + a[10:80] + pick(9), "x" * 200, pick(300), "", None, pick(39), a + b, a + b]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r[0]: (bytes(r[1]), [(s["start"], s["end"]) for s in r[2]]) for r in values(suffix_dedup.remove_repeated_strings(df, length=40, gram=8, group_anchors=group, hot_contexts=hot), "row.doc_id", "kept", "removed")}
    assert got == dict(enumerate(repeated([(t or "").encode() for t in texts], 40)))
    done = values(suffix_dedup.remove_repeated_strings(odd), "row.text", "kept")
    assert collections.Counter(bytes(k) for _, k in done) == collections.Counter(k for k, _ in repeated([(r[0] or "").encode() for r in values(odd, "text")], 400))
    assert suffix_dedup.remove_repeated_strings(none).count() == 0


def test_deep_shallow_sorting():
    draw = np.random.default_rng(3)
    base = draw.integers(1, 4, 200)
    strings = np.stack([np.concatenate([base[: draw.integers(0, 200)], draw.integers(1, 4, 200)])[:200] for _ in range(80)]).astype(np.uint16)
    strings[5] = strings[40]
    order, shared = sort_strings(strings)
    rows = [strings[i].tolist() for i in order]
    assert sorted(order.tolist()) == list(range(80)) and rows == sorted(rows)
    for k in range(1, 80):
        assert shared[k] == next((i for i in range(200) if rows[k][i] != rows[k - 1][i]), 200)


def test_url_filter(spark):
    rules = {"net/": "block", "example.net/en/": "allow", "a.example.net/en/x": "block"}
    urls = ["http://Example.NET/en/q", "https://a.example.net/en/xy?z", "http://example.net", "http://bexample.net/en/", "ftp://net/", None, "no scheme", "x://q/#a://net/", "http://a.NET/en/\u00e9#f", ""]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").selectExpr("*", "url host", "url rule", "1 id")
    got = {r[0]: r[1:] for r in values(url_filter.judge_urls(df, rules), "id", "host", "path", "rule", "verdict")}
    assert got[0] == ("example.net", "/en/q", "example.net/en/", "allow") and got[1][2:] == ("a.example.net/en/x", "block")
    assert got[2] == ("example.net", "", None, "allow") and got[3][2:] == ("net/", "block") and got[4][2:] == ("net/", "block")
    assert got[5] == got[6] == got[9] == ("", "", None, "allow") and got[7] == ("q", "/", None, "allow") and got[8][1:] == ("/en/\u00e9", "net/", "block")
    assert url_filter.judge_urls(df.where("page_id < 0"), rules).count() == 0


def test_only_hosts_no_longer_than_the_longest_rule_are_looked_up(spark):
    rules = {"net/": "block", "example.net/en/": "allow"}
    probes = lambda host: [p for p in url_filter._probes(host, "/en/x", [1, 4], len("example.net"))]
    assert probes("example.net") == ["example.net/", "example.net/en/", "net/", "net/en/"]
    assert probes("a.example.net") == probes("xx.example.net") == probes("example.net")
    assert probes("aexample.net") == ["net/", "net/en/"] and probes("a" * 50) == [] and len(probes("." * 1_000_000)) == 24
    urls = ["x://" + "a." * 500_000 + "example.net/en/", "x://" + "." * 1_000_000 + "net/", "x://" + "b" * 1_000_000 + "net/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    judged = {r[0]: r[1:] for r in values(url_filter.judge_urls(df, rules), "id", "rule", "verdict")}
    assert judged == {0: ("example.net/en/", "allow"), 1: ("net/", "block"), 2: (None, "allow")}


def test_crc_of_ids(spark):
    pieces = packing.token_pieces(spark.createDataFrame([(1, "a b c")], "doc_id int, text string"), *TOKENS).select("ids", F.crc32("ids").alias("crc"))
    row = pieces.first()
    assert row["crc"] == zlib.crc32(bytes(row["ids"]))
