"""Nearest neighbours by inner product with a vantage-point tree per shard.

Inner products become distances: with one more component sqrt(m - |x|^2), m the largest squared norm of the table, all
candidates have the same norm, and the nearest by Euclidean distance is the largest inner product.  A node splits its
points by the median distance to a vantage point; the triangle inequality bounds what the far side can hold.  The far
side is skipped if that bound exceeds ``factor`` times the distance of the k-th best found: 1 is exact, less prunes more.

Candidates go to shards by hash of their id, queries to every shard in blocks; a task builds the tree of its shard once and
streams the queries past it, so memory is one shard and one block.  The k best by shard are merged by a group-limited window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import materialize

#: Candidates for each shard, about.
SHARD = 4096
LEAF = 64
#: Share of the exact bound that pruning uses.
FACTOR = 0.8
#: Queries searched together.
BLOCK = 1024


class VPTree:
    """Vantage-point tree over the rows of ``x`` (float64) with ids, all lifted to the squared norm ``largest``."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, largest: float, leaf: int = LEAF):
        self.flat, self.ids, self.largest, self.leaf = x, ids, largest, leaf
        self.x = np.column_stack((x, np.sqrt(np.maximum(largest - (x * x).sum(axis=1), 0.0))))
        self.rng = np.random.default_rng(7)
        self.root = self._build(np.arange(len(x)))

    def _build(self, points: np.ndarray):
        """A leaf is an array of rows; a node is (vantage row, radius, inside, outside)."""
        if len(points) <= self.leaf:
            return points
        spread, best, dist = -1.0, 0, points
        for v in self.rng.choice(points, 4):
            d = np.sqrt(((self.x[points] - self.x[v]) ** 2).sum(axis=1))
            if (wide := float(d.std())) > spread:
                spread, best, dist = wide, int(v), d
        radius = float(np.median(dist))
        inside = dist <= radius
        if inside.all():  # half the points or more are at the largest distance
            inside = dist < radius
            if not inside.any():
                return points  # all of them at one distance
            radius = float(dist[inside].max())
        return best, radius, self._build(points[inside]), self._build(points[~inside])

    def search(self, q: np.ndarray, own: np.ndarray, k: int, factor: float):
        """For each query row its k best rows (-1: none) by inner product, then id, less those with the id in ``own``."""
        n, dim = q.shape
        rows, best = np.full((n, k), -1), np.full((n, k), -np.inf)
        ids = np.full((n, k), np.iinfo(np.int64).max)
        lifted = np.column_stack((q, np.zeros(n)))
        q_sq = (q * q).sum(axis=1)

        def leaf(points, who):
            got = np.einsum("qd,pd->qp", q[who], self.flat[points])
            got[own[who, None] == self.ids[points]] = -np.inf
            some = got.max(axis=1) >= best[who].min(axis=1)
            who, got = who[some], got[some]
            if not len(who):
                return
            wide = (len(who), len(points))
            got = np.concatenate((best[who], got), axis=1)
            row = np.concatenate((rows[who], np.broadcast_to(points, wide)), axis=1)
            key = np.concatenate((ids[who], np.broadcast_to(self.ids[points], wide)), axis=1)
            pick = np.lexsort((key, -got), axis=1)[:, :k]
            best[who], rows[who], ids[who] = (np.take_along_axis(c, pick, 1) for c in (got, row, key))

        def visit(node, who):
            if not len(who):
                return
            if isinstance(node, np.ndarray):
                leaf(node, who)
                return
            v, radius, inside, outside = node
            d = np.sqrt(((lifted[who] - self.x[v]) ** 2).sum(axis=1))
            first = d <= radius
            visit(inside, who[first])
            visit(outside, who[~first])
            worst = np.sqrt(np.maximum(q_sq[who] + self.largest - 2 * best[who].min(axis=1), 0.0))
            near = np.abs(d - radius) <= factor * worst + 1e-7
            visit(outside, who[first & near])
            visit(inside, who[~first & near])

        visit(self.root, np.arange(n))
        rows[np.isinf(best)] = -1
        return rows


def usable(vector: Column) -> Column:
    """True for vectors that are not null, not zero, and hold finite components only."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    embeddings: DataFrame, every: int = 20, k: int = 20, factor: float = FACTOR, shard: int = SHARD
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: of each row whose vec_id is divisible by ``every``, the k nearest others.

    Rows whose vector is not usable() or whose vec_id is null take no part, on either side.  Rows that repeat vec_id and
    vector count once; vectors are compared with those of their own length.  Ties go to the smaller vec_id.  Empty
    table: no rows.  Shards are of a fixed size about, at any table size.
    """
    rows = (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
        .where(usable(F.col("v")) & F.col("vec_id").isNotNull())
        .select("vec_id", F.transform("v", lambda x: x.cast("double")).alias("v"), F.size("v").alias("dim"))
        .dropDuplicates(["vec_id", "v"])
    )
    rows = materialize(rows, "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    known = rows.agg(F.count("*").alias("n"), F.max(norm).alias("m")).first()
    shards, largest = max(1, -(-known["n"] // shard)), float(known["m"] or 0.0)

    candidates = rows.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), "dim", F.lit(0).alias("side"), "vec_id", "v"
    )
    queries = rows.where(F.col("vec_id") % every == 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "dim", F.lit(1).alias("side"), "vec_id", "v"
    )
    both = candidates.unionAll(queries).repartition("shard", "dim").sortWithinPartitions("shard", "dim", "side", "vec_id")

    def found(tree, q_ids, q):
        got = tree.search(q, q_ids, k, factor)
        who, at = np.nonzero(got >= 0)
        hit = got[who, at]
        score = (q[who] * tree.flat[hit]).sum(axis=1)
        return pa.RecordBatch.from_arrays(
            [pa.array(q_ids[who]), pa.array(tree.ids[hit]), pa.array(score)], ["query_id", "vec_id", "score"]
        )

    def run(batches):
        at, parts, tree = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            shard_, dim, side, vec_id = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            new = np.flatnonzero((np.diff(shard_) != 0) | (np.diff(dim) != 0) | (np.diff(side) != 0)) + 1
            for s, e in zip([0, *new], [*new, b.num_rows]):
                v = b.column(4).slice(s, e - s).flatten().to_numpy().reshape(e - s, -1)
                if (here := (int(shard_[s]), int(dim[s]))) != at:
                    at, parts, tree = here, [], None
                if side[s] == 0:
                    parts.append((vec_id[s:e], v))
                    continue
                if parts:
                    ids, x = (np.concatenate(c) for c in zip(*parts))
                    tree, parts = VPTree(x, ids, largest), []
                if tree is not None:
                    for i in range(s, e, BLOCK):
                        j = min(i + BLOCK, e)
                        yield found(tree, vec_id[i:j], v[i - s : j - s])

    near = both.mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
