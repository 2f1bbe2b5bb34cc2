"""Nearest neighbours by inner product over vantage-point trees, one per shard of the vectors.

Inner products become distances by one more component: a vector x of the shard becomes
(x, sqrt(M^2 - |x|^2)) with M the largest norm, a query q becomes (q, 0), and then
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x: the nearest point has the largest inner product, and the triangle
inequality holds.  A tree node splits its points at the median rank of the distance to a vantage
point.  A subtree whose distances lie in [a, b] holds nothing closer than max(d - b, a - d) for a
query at distance d; it is skipped when ``factor`` times that bound exceeds the query's 20th best
distance so far.  Factor 1 is exact; a larger factor prunes more and may miss neighbours.

Shards are cut by a hash of the key, so copies of one vector spread; a tree is a row of bounded
size.  Queries go in bounded blocks, one row for each block and shard; all queries of a block walk a
tree together, node by node, so distances are matrix products.  Each (block, shard) gives k rows a
query; the best k of these are the result.  Nothing is collected or broadcast but one norm.

Vectors that are null or empty, have null or non-finite components or are zero take no part, nor do
vectors of another length than the most common one.  Scores are double-precision sums over the
original components in one fixed order; ties go to the smaller id.  Rows with a null id take no part.
Repeated ids are rows of their own, and a query is compared with every row of another id.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.session import cut_lineage

K = 20
SHARD_ROWS = 8192
BLOCK_QUERIES = 1024
LEAF = 256
FACTOR = 1.0


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


class Tree:
    """Vantage-point tree over rows of a matrix, as arrays.

    ``order`` lists the rows so that a node is a range of it: [vantage point, near half, far half];
    a node is (lo, hi, near end, distance range of the near half, of the far half)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top: float, leaf: int = LEAF):
        self.ids, self.vectors = ids, vectors
        norms = np.einsum("ij,ij->i", vectors, vectors)
        self.points = np.concatenate([vectors, np.sqrt(np.maximum(top - norms, 0.0))[:, None]], axis=1)
        self.order = np.arange(len(ids))
        self.nodes: list[tuple] = []
        self._build(0, len(ids), leaf)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "points"} | {"last": self.points[:, -1]}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.points = np.concatenate([self.vectors, self.last[:, None]], axis=1)

    def _build(self, lo: int, hi: int, leaf: int) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if hi - lo <= leaf:
            self.nodes[at] = (lo, hi)
            return at
        rows = self.order[lo:hi]
        pick = int(np.argmax(distances(self.points[rows[:1]], self.points[rows])[0]))  # far from some point: near the rim
        rows[0], rows[pick] = rows[pick], rows[0]
        d = distances(self.points[rows[:1]], self.points[rows[1:]])[0]
        by = np.argsort(d, kind="stable")
        rows[1:], d = rows[1:][by], d[by]
        half = len(d) // 2
        near = self._build(lo + 1, lo + 1 + half, leaf)
        far = self._build(lo + 1 + half, hi, leaf)
        self.nodes[at] = (lo, hi, near, far, d[0], d[half - 1], d[half], d[-1])
        return at

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, row, exact score) of each query's k best rows of another id.

        Scores of a block are matrix products; rows within rounding of the k-th best are scored again,
        in one order of summation, before ids decide ties."""
        n, dim = queries.shape
        points = np.concatenate([queries, np.zeros((n, 1))], axis=1)
        best = np.full((n, k), -np.inf)  # of the approximate scores, falling
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        reach = np.einsum("ij,ij->i", queries, queries)
        top = float(np.einsum("j,j->", self.points[0], self.points[0])) if len(self.ids) else 0.0
        slack = 1e-9 * (1 + np.sqrt(reach * top))

        def visit(rows: np.ndarray, who: np.ndarray) -> None:
            scores = queries[who] @ self.vectors[rows].T
            scores[query_ids[who][:, None] == self.ids[rows][None, :]] = -np.inf
            both = np.concatenate([best[who], scores], axis=1)
            best[who] = -np.sort(-(np.partition(both, -k, axis=1)[:, -k:] if both.shape[1] > k else both), axis=1)[:, :k]
            a, b = np.nonzero(scores >= (best[who][:, -1] - slack[who])[:, None])
            keep = scores[a, b] > -np.inf
            found.append((who[a[keep]], rows[b[keep]], scores[a, b][keep]))

        stack = [(0, np.arange(n), np.zeros(n))] if len(self.ids) else []
        while stack:
            at, who, bound = stack.pop()
            limit = np.sqrt(np.maximum(reach[who] + top - 2 * (best[who][:, -1] - slack[who]), 0.0))
            who = who[~(factor * bound > limit + 1e-7)]
            if not len(who):
                continue
            node = self.nodes[at]
            if len(node) == 2:
                visit(self.order[node[0] : node[1]], who)
                continue
            lo, _, near, far, a, b, c, e = node
            visit(self.order[lo : lo + 1], who)
            d = distances(points[who], self.points[self.order[lo : lo + 1]])[:, 0]
            to_near, to_far = np.maximum(np.maximum(d - b, a - d), 0.0), np.maximum(np.maximum(d - e, c - d), 0.0)
            first = to_near <= to_far
            stack.append((far, who[first], to_far[first]))
            stack.append((near, who[~first], to_near[~first]))
            stack.append((near, who[first], to_near[first]))
            stack.append((far, who[~first], to_far[~first]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        q, r, s = (np.concatenate(x) for x in zip(*found))
        keep = s >= best[q, -1] - slack[q]
        q, r = q[keep], r[keep]
        exact = np.concatenate([np.sum(queries[q[i : i + 65536]] * self.vectors[r[i : i + 65536]], axis=1) for i in range(0, len(q), 65536)]) if len(q) else np.empty(0)
        by = np.lexsort((self.ids[r], -exact, q))
        q, r, exact = q[by], r[by], exact[by]
        starts = np.r_[0, np.flatnonzero(np.diff(q)) + 1] if len(q) else np.empty(0, np.int64)
        nth = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)])) if len(q) else np.empty(0, np.int64)
        take = nth < k
        return q[take], r[take], exact[take]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of two matrices."""
    d = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0.0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (size["n"] if size else 0))


def nearest(df: DataFrame, is_query: Column, k: int = K, factor: float = FACTOR, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = SHARD_ROWS, block: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of every query row; ``is_query`` is a condition on vec_id."""
    rows = vectors(df, id_col, vec_col)
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(is_query.cast("long")).alias("q"), F.max(squares).alias("top")).first()
    n, n_queries, top = sizes["n"], sizes["q"] or 0, (sizes["top"] or 0.0) * (1 + 1e-12)
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_queries // block))
    out = "query_id long, rank int, vec_id long, score double"

    def build(part: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(part["vec_id"].to_numpy(), _matrix(part["v"]), top)
        return pd.DataFrame({"shard": [part["shard"].iloc[0]], "tree": [pickle.dumps(tree, protocol=5)]})

    spread = lambda salt, parts: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(parts))
    trees = rows.withColumn("shard", spread(1, shards)).groupBy("shard").applyInPandas(build, "shard long, tree binary")
    trees = cut_lineage(trees, "vp-trees")

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        held = (part["vec_id"].to_numpy(), _matrix(part["v"]))
        return pd.DataFrame({"block": [part["block"].iloc[0]], "queries": [pickle.dumps(held, protocol=5)]})

    asked = rows.where(is_query).withColumn("block", spread(2, blocks)).groupBy("block").applyInPandas(pack, "block long, queries binary")
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>")))

    def search(parts):
        for part in parts:
            for b, q, t in zip(part["block"], part["queries"], part["tree"]):
                ids, held = pickle.loads(q)
                tree = pickle.loads(t)
                a, r, score = tree.search(ids, held, k, factor)
                yield pd.DataFrame({"query_id": ids[a], "asker": (b << 32) + a, "vec_id": tree.ids[r], "score": score, "row": r.astype(np.int64)})

    pairs = asked.join(trees, "shard").repartition(max(1, shards * blocks), "shard", "block")
    near = pairs.select("block", "queries", "tree").mapInPandas(search, "query_id long, asker long, vec_id long, score double, row long")
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id", "row")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).selectExpr("query_id", "rank", "vec_id", "score")
