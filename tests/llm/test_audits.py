"""The filter audit, the line runs and the Merkle manifest against plain Python, odd rows included."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdcflow.llm import filter_audit, line_runs, merkle


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# -- filter audit -------------------------------------------------------------------------------


def fails_of(rows):
    """The five outcomes of (doc_id, text) rows, one after another."""
    least = {}
    for doc_id, text in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    for doc_id, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        yield (
            len(words) < 50,
            100 * len(set(words)) < 65 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            bool(re.search(r"[#$%&*|]", text)),
            doc_id is not None and doc_id > least[text],
        )


def audited(rows, good, toxic):
    """(doc_id, text, part) rows through every order, filter by filter."""
    outcomes = list(fails_of([r[:2] for r in rows]))
    out = {}
    for part in {r[2] or "" for r in rows}:
        here = [(r[0], f) for r, f in zip(rows, outcomes) if (r[2] or "") == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = here
            for step, letter in enumerate(order, 1):
                i = "ABCDE".index(letter)
                removed, kept = [x for x in left if x[1][i]], [x for x in left if not x[1][i]]
                shapley[letter] += len(removed)
                out[part, "".join(order), step] = [
                    len(kept), len(removed), sum(f[i] for _, f in here) - len(removed), sum(f[i] and sum(f) == 1 for _, f in here),
                    sum(d in good for d, _ in removed), sum(d in toxic for d, _ in removed),
                ]
                left = kept
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def check_audit(spark, docs, labels):
    rows = values(docs, "doc_id", "text", "source")
    good = {r[0] for r in values(labels, "doc_id", "quality") if r[1] == 1 and r[0] is not None}
    toxic = {r[0] for r in values(labels, "doc_id", "toxic") if r[1] == 1 and r[0] is not None}
    got = values(filter_audit.audit(docs, labels), "part", "filter_order", "step", *filter_audit._COUNTS)
    assert {r[:3]: r[3:] for r in got} == audited(rows, good, toxic)
    assert len(got) == len({r[:3] for r in got})


def test_audit_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, None), (6, 1, 1), (None, 1, 1), (99, 1, 1)], "doc_id bigint, quality int, toxic int"
    )
    check_audit(spark, odd, labels)
    assert filter_audit.audit(none, labels).count() == 0
    check_audit(spark, odd, labels.where("doc_id > 1000"))


def test_audit_of_random_rows(spark):
    draw = random.Random(3)
    texts = [" ".join(draw.choice(["one", "Two", "THREE", "four#", f"w{draw.randrange(999)}"]) for _ in range(draw.choice([0, 40, 60, 90]))) for _ in range(40)]
    rows = [(draw.choice([None, draw.randrange(200), draw.randrange(200)]), draw.choice([None, *texts]), draw.choice([None, "", "x", "y"])) for _ in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, i % 2, i % 3) for i in range(0, 200, 2)], "doc_id bigint, quality int, toxic int")
    check_audit(spark, docs, labels)


def test_contraction_of_one_code():
    counts = np.zeros((3, 1, 32), np.int64)
    counts[:, 0, 0b00101] = 7, 2, 1  # fails A and C only
    found = filter_audit.contract(counts)
    at = filter_audit.ORDERS.index("CABDE") * 5
    assert found["removed"][0, at : at + 5].tolist() == [7, 0, 0, 0, 0]
    assert found["redundant"][0, at : at + 5].tolist() == [0, 7, 0, 0, 0]
    assert found["kept"][0, at : at + 5].tolist() == [0, 0, 0, 0, 0]
    assert found["shapley"][0, at : at + 5].tolist() == [420, 420, 0, 0, 0]
    assert found["good_lost"][0, at] == 2 and found["toxic_lost"][0, at] == 1 and not found["unique_fails"].any()


# -- line runs ----------------------------------------------------------------------------------


def lines_dropped(rows, least_docs, least_chars):
    strip = " \t\n\x0b\x0c\r"
    small = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs, last = Counter(), {}
    key = lambda line: line.strip(strip).translate(small)
    for doc_id, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= least_chars:
                docs[k] += 1
                last[k] = doc_id if last.get(k) is None else last[k] if doc_id is None else max(last[k], doc_id)
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if docs[key(line)] < least_docs or doc_id == last[key(line)]]
        yield doc_id, text, len(lines), len(lines) - len(kept), "\n".join(kept)


@pytest.mark.parametrize("batches", [1, 3, 6])
def test_line_runs(spark, odd, none, batches):
    draw = random.Random(batches)
    pool = [f"\t{'Line' if i % 2 else 'LINE'} number {i % 30} of some that are very commonÉ " for i in range(60)] + ["short", "", "  ", "x" * 39, "X" * 40, "x" * 40 + "\x0b"]
    rows = [
        (draw.choice([None, draw.randrange(60), i]), draw.choice([None, "\n".join(draw.choice(pool) for _ in range(draw.randrange(12)))]), i % 3) for i in range(200)
    ]
    rows += [(500, pool[0], 0), (500, pool[0], 0), (501, "tail\n" * 30_000 + pool[1], 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lines int").selectExpr("*", "lines h1", "lines number", "lines batch", "lines row", "lines k1")
    got = values(line_runs.drop_common_lines(docs, batches=batches), "row.doc_id", "row.text", "n_lines", "n_dropped", "kept")
    want = list(lines_dropped([r[:2] for r in rows], 5, 40))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[3] for r in got) > 100
    kept = values(line_runs.drop_common_lines(odd, least_docs=2, least_chars=3, batches=batches), "row.doc_id", "row.text", "n_lines", "n_dropped", "kept")
    assert sorted(kept, key=repr) == sorted(lines_dropped(values(odd, "doc_id", "text"), 2, 3), key=repr)
    assert line_runs.drop_common_lines(none, batches=batches).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_all_ids_null_keep_their_lines(spark):
    docs = spark.createDataFrame([(None, "a line that is long enough to be a key of its own")] * 7, "doc_id bigint, text string")
    assert {r[0] for r in values(line_runs.drop_common_lines(docs), "n_dropped")} == {0}


def test_runs_merge_by_level_and_leave_out_settled_keys(spark):
    runs = line_runs.LineRuns(spark, least_docs=5, fanout=2, buckets=4)
    batch = lambda keys, n, last: spark.createDataFrame([(k, k, n, last) for k in keys], "h1 bigint, h2 bigint, n bigint, last bigint")
    shape = lambda: {level: len(names) for level, names in runs.levels.items() if names}
    try:
        runs.add(batch(range(0, 10), 6, 400))
        assert shape() == {0: 1}
        runs.add(batch(range(5, 15), 3, 300))
        assert shape() == {1: 1}
        runs.add(batch(range(0, 15), 3, 200))
        assert shape() == {0: 1, 1: 1}
        assert {r[0] for r in values(spark.table(runs.levels[0][0]), "h1")} == set(range(10, 15))  # the others are settled
        want = {k: (6, 400) for k in range(10)} | {k: (6, 300) for k in range(10, 15)}
        assert {r[0]: r[1:] for r in values(runs.merged(), "h1", "n", "last")} == want
        runs.add(batch([99], 1, 100))
        assert shape() == {2: 1}
        merge = runs.merged()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in merge
    finally:
        runs.close()


def test_runs_join_without_a_shuffle_of_their_own(spark):
    runs = line_runs.LineRuns(spark, buckets=8)
    entries = spark.range(100).selectExpr("id h1", "id h2", "id last").groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("last").alias("last"))
    try:
        runs.add(entries)
        known = spark.table(runs.levels[0][0]).withColumnRenamed("n", "n0").drop("last").hint("merge")
        plan = entries.join(known, ["h1", "h2"], "left")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1  # of the batch's partial counts
    finally:
        runs.close()


# -- Merkle manifest ----------------------------------------------------------------------------


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def folded(nodes):
    """The root over nodes, and for each of them its siblings on the way there as (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            first = at[i] // 8 * 8
            p.append(("".join(nodes[first : at[i]]), "".join(nodes[at[i] + 1 : first + 8])))
            at[i] //= 8
        nodes = [H("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def manifest_of(rows):
    parts = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        parts[row[1]].append(row)
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {name: folded([r[2] for r in parts[name]]) for name in names}
    root, upper = folded([trees[name][0] for name in names])
    out = []
    for name, above in zip(names, upper):
        subroot, paths = trees[name]
        for (doc_id, _, leaf, changed), path in zip(parts[name], paths):
            node = leaf if changed is None else changed
            for left, right in path + above:
                node = H(left + node + right)
            out.append((doc_id, leaf, subroot, root, H("".join(a + b for a, b in path + above)), node))
    return out


MANIFEST = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 8, None: 9}, {"\U0001f600": 1, "￮": 513, "": 2, None: 1}, {f"l{i:02}": i for i in range(1, 12)}, {"a": 600, "b": 4700}])
def test_manifest(spark, sizes):
    draw = random.Random(len(sizes))
    rows = [(draw.choice([None, draw.randrange(10_000), i]), part, H(f"{part}{i}"), draw.choice([None, H(f"c{i}")])) for part, n in sizes.items() for i in range(n)]
    got = values(merkle.manifest(spark.createDataFrame(rows, "id bigint, part string, node string, changed string").repartition(3)), *MANIFEST)
    want = manifest_of(rows)
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_manifest_of_equal_rows_and_none(spark):
    rows = [(1, "a", H("x"), None)] * 50 + [(1, "a", H("y"), None)] * 3
    df = spark.createDataFrame(rows, "id bigint, part string, node string, changed string")
    assert sorted(values(merkle.manifest(df), *MANIFEST), key=repr) == sorted(manifest_of(rows), key=repr)
    assert merkle.manifest(df.where("id > 1")).count() == 0


def test_a_version_shares_all_but_its_path():
    leaves = [H(str(i)) for i in range(70)]
    tree = merkle.Block(leaves, 3)
    before = [list(level) for level in tree.levels]
    copied = tree.version(13, H("new"))
    assert tree.levels == before and len(copied) == 4
    assert copied[-1] == merkle.Block(leaves[:13] + [H("new")] + leaves[14:], 3).top != tree.top
    assert tree.version(13, leaves[13])[-1] == tree.top
    assert merkle.go_on(leaves[13], tree.siblings(13)) == tree.top


def test_leaf_digest(odd):
    rows = odd.select("doc_id", "text", merkle.leaf_digest(F.col("doc_id"), F.col("text")).alias("leaf"), merkle.small_letters(F.col("text")).alias("small")).collect()
    for r in rows:
        fields = [None if v is None else str(v) for v in (r["doc_id"], r["text"])]
        assert r["leaf"] == H("".join("-" if f is None else f"{len(f.encode())}:{f}" for f in fields))
        assert r["small"] == (r["text"] and re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))
