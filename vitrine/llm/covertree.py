"""Exact top-k inner products by dual cover trees.

Vectors are quantised to whole numbers. Queries and candidates are dealt into
blocks of bounded size; for every pair of a query block and a candidate block,
a cover tree is built over each side and both are descended together. A pair
of nodes is pruned when no inner product between their points can reach the
worst kth score that the queries of the node still have: by the covering radii
r of the two nodes, <q, x> <= <a, b> + |a| r_x + |b| r_q + r_q r_x for centres a
and b. Scores of pairs that survive are exact. The k best of each pair of
blocks meet in one ranking per query.

Defined cases: vectors that are null or hold a null or a component that is not
finite take no part, nor do rows without an id; only vectors of the query's
length are candidates; rows that repeat id and vector count once, and a row of
the query's id is never its candidate; ties go to the smaller id; a query with
fewer candidates gets them all; an empty table gives no rows. Scores must fit a
long; components are exact below 2^31 after quantising.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitrine.llm.common import stored

TOP_K = 20
SCALE = 64
QUERY_EVERY = 20
QUERY_BLOCK = 1024
BLOCK = 4096
LEAF = 64


class CoverTree:
    """Nodes in arrays. A node's centre is one of its points, its children cover
    its points within half of its radius where that divides them, and a node of
    at most ``LEAF`` points, or of equal points, is a leaf. Points are ordered so
    that a node holds the slice [begin, end)."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.points = points.astype(np.float64)
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.slices: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        todo = [(0, len(points), 0, -1)] if len(points) else []
        while todo:
            begin, end, pick, parent = todo.pop()
            own = self.order[begin:end]
            gap = np.sqrt(((self.points[own] - self.points[own[pick]]) ** 2).sum(1))
            node = len(self.centre)
            self.centre.append(self.points[own[pick]])
            self.radius.append(float(gap.max()))
            self.slices.append((begin, end))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if end - begin <= LEAF or not self.radius[node]:
                continue
            # Centres that are over half the radius apart, farthest first. Centres with
            # few points give theirs to the others, so that leaves stay worth a scan.
            limit = max(2, (end - begin) // LEAF)
            heads, gaps, best = [pick], [gap], gap
            while best.max() > self.radius[node] / 2 and len(heads) < limit:
                heads.append(int(best.argmax()))
                gaps.append(np.sqrt(((self.points[own] - self.points[own[heads[-1]]]) ** 2).sum(1)))
                best = np.minimum(best, gaps[-1])
            away = np.stack(gaps)
            sizes = np.bincount(away.argmin(0), minlength=len(heads))
            kept = np.flatnonzero(sizes >= LEAF // 4)
            nearest = away[kept].argmin(0) if len(kept) > 1 else None
            if nearest is None:
                # No two centres divide the points well: halve them between the first
                # centre and the farthest, at the median.
                kept = np.array([0, 1])
                lean = np.argsort(away[0] - away[1], kind="stable")
                nearest = np.zeros(len(own), np.int64)
                nearest[lean[len(own) // 2 :]] = 1
            by = np.argsort(nearest, kind="stable")
            self.order[begin:end] = own[by]
            at = begin
            for h, size in enumerate(np.bincount(nearest, minlength=len(kept)).tolist()):
                if size:
                    cell = by[at - begin : at - begin + size]
                    todo.append((at, at + size, int(away[kept[h]][cell].argmin()), node))
                at += size
        self.points = self.points[self.order]
        self.centres = np.array(self.centre).reshape(len(self.centre), -1)
        self.radii = np.array(self.radius)
        self.norms = np.sqrt((self.centres**2).sum(1))


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers: floats while they are exact, else longs."""
    reach = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    return (a @ b.T).astype(np.int64) if reach < 2**53 else a.astype(np.int64) @ b.astype(np.int64).T


def dual_tree_top_k(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, candidate place, score) of each query's k best, own id excluded."""
    q, x = CoverTree(queries), CoverTree(points)
    qid, xid = query_ids[q.order], ids[x.order]
    lowest = -(1 << 62)  # below every score
    scores = np.full((len(qid), k), lowest, np.int64)
    places = np.full((len(qid), k), -1, np.int64)
    slack = 1e-9

    def bound(a: int, nodes: np.ndarray) -> np.ndarray:
        reach = x.centres[nodes] @ q.centres[a] + q.norms[a] * x.radii[nodes] + x.norms[nodes] * q.radii[a] + q.radii[a] * x.radii[nodes]
        return reach + slack * (1 + np.abs(reach))

    def worst(a: int) -> int:
        begin, end = q.slices[a]
        return int(scores[begin:end, -1].min())

    def scan(a: int, nodes: np.ndarray) -> None:
        """Score a group of queries against the points of some leaves."""
        begin, end = q.slices[a]
        at = np.concatenate([np.arange(*x.slices[n]) for n in nodes])
        got = _exact(q.points[begin:end], x.points[at])
        got[qid[begin:end, None] == xid[None, at]] = lowest
        able = (got >= np.maximum(scores[begin:end, -1:], lowest + 1)).any(0)
        if not able.any():
            return
        at, got = at[able], got[:, able]
        all_scores = np.concatenate([scores[begin:end], got], axis=1)
        all_places = np.concatenate([places[begin:end], np.broadcast_to(at, got.shape)], axis=1)
        # The kth best by score, ties by smaller id.
        all_ids = np.where(all_places >= 0, xid[all_places], np.iinfo(np.int64).max)
        by = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        scores[begin:end] = np.take_along_axis(all_scores, by, 1)
        places[begin:end] = np.take_along_axis(all_places, by, 1)

    # Depth first over the query tree. A frontier of candidate nodes comes down from
    # the parent; nodes that cannot reach the group's worst kth score are pruned.
    todo = [(0, np.array([0]))] if len(qid) and len(xid) else []
    while todo:
        a, frontier = todo.pop()
        frontier = frontier[bound(a, frontier) >= worst(a)]
        # Candidate nodes that are wide beside the query node are opened first.
        wide = np.array([bool(x.children[n]) and x.radii[n] >= q.radii[a] for n in frontier], bool)
        while wide.any():
            opened = np.array([c for n in frontier[wide] for c in x.children[n]])
            frontier = np.concatenate([frontier[~wide], opened[bound(a, opened) >= worst(a)]]).astype(np.int64)
            wide = np.array([bool(x.children[n]) and x.radii[n] >= q.radii[a] for n in frontier], bool)
        if q.children[a]:
            todo += [(c, frontier) for c in q.children[a]]
            continue
        # A group of queries: the most promising nodes first, then more at a time.
        take = 16
        while len(frontier):
            reach = bound(a, frontier)
            keep = np.flatnonzero(reach >= worst(a))
            frontier = frontier[keep[np.argsort(-reach[keep], kind="stable")]]
            some, frontier, take = frontier[:take], frontier[take:], 4 * take
            leaves = np.array([n for n in some if not x.children[n]], np.int64)
            inner = np.array([c for n in some for c in x.children[n]], np.int64)
            if len(leaves):
                scan(a, leaves)
            frontier = np.concatenate([inner, frontier])
    row, col = np.nonzero(scores > lowest)
    return q.order[row], x.order[places[row, col]], scores[row, col]


def quantised(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of each component as double; null unless all are finite."""
    good = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    return F.when(good, F.transform(embedding, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("double")))


def top_k(vectors: DataFrame, query: Column, k: int = TOP_K, scale: int = SCALE, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows that ``query`` holds for, the k
    rows with the highest inner product. ``vectors`` has vec_id and embedding."""
    rows = vectors.select("vec_id", quantised(F.col("embedding"), scale).alias("v"), query.alias("is_query")).filter("v IS NOT NULL AND vec_id IS NOT NULL").distinct()
    rows = stored(rows.withColumn("dim", F.size("v")), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    # Ceil keeps blocks bounded: their number grows with the rows.
    n_blocks, q_blocks = max(1, -(-size["n"] // block)), max(1, -(-size["q"] // query_block))
    spread = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")
    cells = F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))
    left = rows.filter("is_query").select("dim", spread(q_blocks).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("xb"), "vec_id", "v")
    right = rows.select("dim", cells.alias("qb"), spread(n_blocks).alias("xb"), "vec_id", "v")

    def pair(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        qid, xid = a["vec_id"].to_numpy(np.int64), b["vec_id"].to_numpy(np.int64)
        qs, xs, score = dual_tree_top_k(np.stack(a["v"]), qid, np.stack(b["v"]), xid, k)
        return pd.DataFrame({"query_id": qid[qs], "vec_id": xid[xs], "score": score})

    key = ["dim", "qb", "xb"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(pair, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_cover_tree(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % QUERY_EVERY == 0)


_Q = f"SELECT vec_id, [floor({SCALE}.0 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
OP3_SQL = f"""
WITH e AS (SELECT DISTINCT * FROM ({_Q})),
s AS (SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v::DOUBLE[], x.v::DOUBLE[])::BIGINT AS score
  FROM e q JOIN e x ON q.vec_id <> x.vec_id AND len(q.v) = len(x.v) WHERE q.vec_id % {QUERY_EVERY} = 0),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {TOP_K}
"""
