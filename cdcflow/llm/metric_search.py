"""Exact top-k search by inner product over M-trees.

Vectors are dealt evenly into trees of bounded size. A tree is bulk-loaded: routing vectors are drawn, every vector goes to
its nearest one, and so on down to leaves of one page. A page's entries keep their distance to the page's routing vector
and, above the leaves, a covering radius. One more coordinate, sqrt(M - |x|^2) with M the greatest squared length in the
tree (0 for a query), makes the nearest vector the one of greatest inner product. A query visits pages best first; an entry
whose stored distances show, by the triangle inequality, that it can't be near enough is passed over without a computation.
Scores are exact whole numbers, and pruning leaves room for rounding, so results are exact.

Trees are written pages. Queries meet them in blocks, and each block returns at most k rows per query and tree.

Nulls and odd rows: vectors that are null or hold null or non-finite components, and rows without an id, take no part; rows
equal in id and vector count once; a query meets vectors of its own length, an empty one empty ones with score 0; other columns are ignored; a query sees no row of
its own id; with fewer than k candidates all are returned; an empty frame gives an empty result.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcflow.llm.frames import pick, saved

TREE_ROWS = 16_384
QUERY_BLOCK = 2_048
PAGE_ENTRIES = 256
FANOUT = 32
_SLACK = 1e-7


def scaled(vector: Column, scale: int = 1024) -> Column:
    """Components as floor(scale * x)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def _usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    usable = pick(df, id=id_col, v=vector_col).where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)
    return usable.select("id", scaled(F.col("v")).alias("v"), F.size("v").alias("dim"))


def _lifted(x: np.ndarray, most: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(most - (x * x).sum(axis=1), 0))[:, None]], axis=1)


def build_pages(x: np.ndarray, seed: int = 0, page: int = PAGE_ENTRIES, fanout: int = FANOUT) -> list[dict]:
    """Pages of an M-tree over the rows of ``x``; the first is the root.

    rows: the entries' vectors; parent: their distance to the page's routing vector; radius, child: above leaves.
    """
    most = float((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0))
    points, draw, pages = _lifted(x, most), np.random.default_rng(seed), []

    def add(rows: np.ndarray, centre: int | None) -> tuple[int, float]:
        """Make a page for ``rows`` below the routing row ``centre``; its number and covering radius."""
        number = len(pages)
        pages.append({})
        far = np.zeros(len(rows)) if centre is None else np.linalg.norm(points[rows] - points[centre], axis=1)
        if len(rows) <= page:
            pages[number] = {"rows": rows, "parent": far, "radius": np.zeros(0), "child": np.zeros(0, np.int64)}
            return number, float(far.max(initial=0))
        routes = rows[draw.choice(len(rows), fanout, replace=False)]
        gaps = ((points[rows] ** 2).sum(axis=1)[:, None] - 2 * points[rows] @ points[routes].T) + (points[routes] ** 2).sum(axis=1)[None, :]
        nearest = gaps.argmin(axis=1)
        if (nearest == nearest[0]).all():  # equal vectors: any even split
            nearest = np.arange(len(rows)) % fanout
        made = [(routes[k], *add(rows[nearest == k], routes[k])) for k in range(fanout) if (nearest == k).any()]
        entry = np.array([r for r, _, _ in made])
        pages[number] = {
            "rows": entry,
            "parent": np.zeros(len(made)) if centre is None else np.linalg.norm(points[entry] - points[centre], axis=1),
            "radius": np.array([radius for _, _, radius in made]),
            "child": np.array([child for _, child, _ in made]),
        }
        return number, float(far.max(initial=0))

    add(np.arange(len(x)), None)
    return pages


class Tree:
    """Pages of one tree, ready to be searched."""

    def __init__(self, table: pa.Table, dim: int):
        table = table.sort_by("page")
        self.pages = []
        self.most = table["most"][0].as_py()
        for row in table.select(["vectors", "ids", "parent", "radius", "child"]).to_pylist():
            vectors = np.frombuffer(row["vectors"], "<i8").reshape(len(row["ids"]), dim)
            ids = np.array(row["ids"], np.int64)
            self.pages.append((vectors, _lifted(vectors, self.most), ids, np.array(row["parent"]), np.array(row["radius"]), np.array(row["child"], np.int64)))

    def nearest(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k greatest (score, id), ties to the smaller id; best first."""
        base = float((q.astype(np.float64) ** 2).sum()) + self.most
        point = np.append(q.astype(np.float64), 0.0)
        best: list[tuple[int, int]] = []  # heap of (score, -id)
        slack = _SLACK * (1 + math.sqrt(base))
        reach = math.inf
        waiting = [(0.0, 0, 0.0)]  # bound, page, the query's distance to its routing vector
        while waiting:
            bound, number, above = heapq.heappop(waiting)
            if bound > reach:
                break
            vectors, points, ids, parent, radius, child = self.pages[number]
            inner = len(child) > 0
            near = np.arange(len(ids)) if number == 0 else np.flatnonzero(np.abs(above - parent) - (radius if inner else 0) <= reach)
            if not len(near):
                continue
            if inner:
                gap = np.linalg.norm(points[near] - point, axis=1)
                low = np.maximum(gap - radius[near], 0)
                for i in np.flatnonzero(low <= reach):
                    heapq.heappush(waiting, (max(bound, float(low[i])), int(child[near[i]]), float(gap[i])))
                continue
            scores = vectors[near] @ q
            if len(best) == k:
                wanted = scores >= best[0][0]
                near, scores = near[wanted], scores[wanted]
            if len(scores) > 2 * k:  # ties stay in
                cut = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                near, scores = near[scores >= cut], scores[scores >= cut]
            for score, i in zip(scores.tolist(), ids[near].tolist(), strict=True):
                if i == query_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (score, -i))
                elif (score, -i) > best[0]:
                    heapq.heapreplace(best, (score, -i))
            if len(best) == k:
                reach = math.sqrt(max(base - 2 * best[0][0], 0)) + slack
        return [(score, -i) for score, i in sorted(best, reverse=True)]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), dim)


_PAGE_TYPE = "dim int, tree int, page int, most double, ids array<bigint>, vectors binary, parent array<double>, radius array<double>, child array<bigint>"


def build_trees(vectors: DataFrame, id_col: str, vector_col: str, tree_rows: int = TREE_ROWS) -> DataFrame:
    """The pages of all trees, written to the shared folder."""
    points = _usable(vectors, id_col, vector_col).dropDuplicates(["id", "v"])
    trees = max(1, math.ceil(vectors.count() / tree_rows))
    placed = points.withColumn("tree", F.pmod(F.xxhash64("id", "v"), F.lit(trees)).cast("int"))

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dim, tree = key[0].as_py(), key[1].as_py()
        ids, x = table["id"].to_numpy(), _matrix(table["v"], dim)
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        most = float((x.astype(np.float64) ** 2).sum(axis=1).max())
        pages = build_pages(x, seed=tree)
        return pa.table(
            {
                "dim": pa.array([dim] * len(pages), pa.int32()),
                "tree": pa.array([tree] * len(pages), pa.int32()),
                "page": pa.array(range(len(pages)), pa.int32()),
                "most": [most] * len(pages),
                "ids": pa.array([ids[p["rows"]] for p in pages], pa.list_(pa.int64())),
                "vectors": pa.array([x[p["rows"]].astype("<i8").tobytes() for p in pages], pa.binary()),
                "parent": pa.array([p["parent"] for p in pages], pa.list_(pa.float64())),
                "radius": pa.array([p["radius"] for p in pages], pa.list_(pa.float64())),
                "child": pa.array([p["child"] for p in pages], pa.list_(pa.int64())),
            }
        )

    grouped = placed.select("dim", "tree", F.col("id").cast("bigint").alias("id"), "v").groupBy("dim", "tree")
    return saved(grouped.applyInArrow(build, _PAGE_TYPE), "trees")


def top_by_inner_product(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", tree_rows: int = TREE_ROWS
) -> DataFrame:
    """query_id, rank, id, score: each query's ``k`` best, ties to the smaller id."""
    pages = build_trees(vectors, id_col, vector_col, tree_rows)
    asked = _usable(queries, id_col, vector_col).dropDuplicates(["id", "v"])
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))
    trees = pages.where("page = 0").select(F.col("dim").alias("tree_dim"), F.col("tree").alias("tree_no"))  # a row for each tree
    met = asked.join(trees, asked.dim == trees.tree_dim).select(
        F.col("tree_dim").alias("q_dim"), F.col("tree_no").alias("q_tree"), F.col("block").alias("q_block"), F.col("id").cast("bigint").alias("id"), "v"
    )
    held = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(key: tuple[pa.Scalar, ...], page_table: pa.Table, query_table: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "query": [], "id": [], "score": []}
        if page_table.num_rows and query_table.num_rows:
            dim = key[0].as_py()
            tree = Tree(page_table, dim)
            points = _matrix(query_table["v"], dim)
            for query_id, q in zip(query_table["id"].to_pylist(), points, strict=True):
                mark = xxhash.xxh64_intdigest(q.tobytes()) - 2**63  # Python's own hash differs by process
                for score, i in tree.nearest(query_id, q, k):
                    out["query_id"].append(query_id)
                    out["query"].append(mark)
                    out["id"].append(i)
                    out["score"].append(score)
        return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})

    found = held.groupBy("dim", "tree", "block").cogroup(met.groupBy("q_dim", "q_tree", "q_block")).applyInArrow(search, "query_id bigint, query bigint, id bigint, score bigint")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
