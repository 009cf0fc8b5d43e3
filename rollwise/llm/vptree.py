"""Operator 6, approximate nearest neighbours with vantage-point trees per shard.

Vectors are dealt to shards of about ``shard_rows`` by their id; a task builds one tree per shard
and streams the queries past it. Largest inner product becomes nearest distance by one more
coordinate sqrt(M^2 - |x|^2), M the longest vector, which a query has as zero; the tree splits
at the median distance from a vantage point. A side is searched unless the triangle inequality,
with the current k-th distance scaled by ``factor``, rules it out, or its largest possible inner
product, q.v + |q| times the side's reach around the vantage point v and |q| times its longest
vector, is below the current k-th. Both hold for vectors of any lengths: factor one, the
default, is exact. Smaller factors search less, but lose most neighbours where lengths differ,
as every query is then far from every point. Equal vectors of a shard are one tree point with their ids, so large groups
of copies cost nothing and ties between them are exact. Scores of what is found are computed
anew, in double precision on the original vectors; the shards' lists are merged in Spark.

Every vector is indexed. Queries are sent to each shard in groups of ``query_rows``, so no task
holds more than a shard and a batch of queries.

Defined cases: vectors that are null or zero, or hold null or non-finite components, take no
part, nor do rows with a null id; vectors only meet vectors of their own length; a repeated row
(equal id and vector) is one query and one candidate, and candidates never include rows with
the query's id; ties go to the smaller id; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollwise.llm.common import stage

SHARD_ROWS = 4096
QUERY_ROWS = 50_000
LEAF_ROWS = 128
FACTOR = 1.0
#: found beside the k asked for, so that scores equal but for their last digits are ranked exactly
SPARE = 4
ROUNDING = 1e-12
K = 20


class VantageTree:
    """Tree over the rows of ``points`` for largest inner product."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS, longest: float | None = None) -> None:
        self.points = points
        square = np.einsum("ij,ij->i", points, points)
        self.reach2 = max(float(square.max(initial=0.0)), (longest or 0.0) ** 2)
        self.extra = np.sqrt(np.maximum(self.reach2 - square, 0.0))
        self.length = np.sqrt(square)
        self.leaf_rows = leaf_rows
        #: (vantage, radius, near child, far child, near bounds, far bounds), or (rows of a leaf,);
        #: the bounds of a side are its longest gap to the vantage point and its longest vector
        self.nodes: list[tuple] = []
        self.visited = 0
        self.root = self._build(np.arange(len(points)), np.random.default_rng(len(points)))

    def _build(self, rows: np.ndarray, rng: np.random.Generator) -> int:
        if len(rows) > self.leaf_rows:
            v = int(rows[rng.integers(len(rows))])
            gap = self.points[rows] - self.points[v]
            d = np.sqrt(np.einsum("ij,ij->i", gap, gap) + (self.extra[rows] - self.extra[v]) ** 2)
            radius = float(np.median(d))
            near = d <= radius
            if 0 < near.sum() < len(rows):
                away = np.sqrt(np.einsum("ij,ij->i", gap, gap))
                bounds = [(float(away[side].max()), float(self.length[rows[side]].max())) for side in (near, ~near)]
                self.nodes.append((v, radius, self._build(rows[near], rng), self._build(rows[~near], rng), *bounds))
                return len(self.nodes) - 1
        self.nodes.append((rows,))
        return len(self.nodes) - 1

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, score) arrays of shape (queries, k), best first; row -1 where there are fewer."""
        own = np.einsum("ij,ij->i", queries, queries)
        q2, long = own + self.reach2, np.sqrt(own) * (1 + 1e-9)
        score = np.full((len(queries), k), -np.inf)
        row = np.full((len(queries), k), -1)
        edge = 1e-6 * np.sqrt(self.reach2)  # distances are roots of differences, so their rounding errors are not small

        def kth(at: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(q2[at] - 2 * score[at, -1], 0.0))

        def visit(node: int, at: np.ndarray) -> None:
            if not len(at):
                return
            if len(self.nodes[node]) == 1:
                rows = self.nodes[node][0]
                got = queries[at] @ self.points[rows].T
                self.visited += got.size
                better = got.max(axis=1) >= score[at, -1]
                at, got = at[better], got[better]
                both = np.concatenate([score[at], got], axis=1)
                who = np.concatenate([row[at], np.broadcast_to(rows, got.shape)], axis=1)
                # by score, ties to the smaller row
                top = np.argsort(who, axis=1)
                top = np.take_along_axis(top, np.argsort(-np.take_along_axis(both, top, 1), axis=1, kind="stable")[:, :k], 1)
                score[at], row[at] = np.take_along_axis(both, top, 1), np.take_along_axis(who, top, 1)
                return
            v, radius, near, far, near_bounds, far_bounds = self.nodes[node]
            dot = queries[at] @ self.points[v]
            d = np.sqrt(np.maximum(q2[at] - 2 * dot, 0.0))
            inside = d <= radius

            def may_hold(bounds: tuple[float, float]) -> np.ndarray:
                return np.minimum(dot + long[at] * bounds[0], long[at] * bounds[1]) + ROUNDING * long[at] * np.sqrt(self.reach2) >= score[at, -1]

            visit(near, at[inside & may_hold(near_bounds)])
            visit(far, at[~inside & may_hold(far_bounds)])
            slack = factor * kth(at) + edge
            visit(far, at[inside & (d + slack >= radius) & may_hold(far_bounds)])
            visit(near, at[~inside & (d - slack <= radius) & may_hold(near_bounds)])

        if len(self.points):
            visit(self.root, np.arange(len(queries)))
        return row, score


def _shard_search(ids: np.ndarray, vectors: np.ndarray, k: int, factor: float, longest: float):
    """A function from (query ids, query vectors) to (query, vec_id, score) rows of one shard."""
    points, where = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((ids, where.ravel()))
    groups = np.split(ids[order], np.flatnonzero(np.diff(where.ravel()[order])) + 1)
    groups = [np.unique(g)[: k + 1] for g in groups]  # one id more, for the query's own
    by_id = np.argsort([g[0] for g in groups], kind="stable")  # so that ties between rows go to the smaller id
    points, groups = points[by_id], [groups[i] for i in by_id.tolist()]
    tree = VantageTree(points, longest=longest)

    def find(query_ids: np.ndarray, queries: np.ndarray):
        rows, _ = tree.search(queries, min(k + 1 + SPARE, len(points)), factor)
        out = []
        for q, found in enumerate(rows):
            found = found[found >= 0]
            exact = (points[found] * queries[q]).sum(axis=1)
            who = [groups[i] for i in found.tolist()]
            score = np.repeat(exact, [len(g) for g in who])
            cand = np.concatenate(who) if who else np.zeros(0, np.int64)
            use = cand != query_ids[q]
            cand, score = cand[use], score[use]
            best = np.lexsort((cand, -score))[:k]
            out.append((np.full(len(best), q), cand[best], score[best]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    return find


def _identity(vectors: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each whole vector, which tells apart different vectors under one id."""
    factors = np.random.default_rng(6).integers(1 << 63, size=vectors.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    bits = (vectors + 0.0).view(np.uint64)
    bits = bits ^ (bits >> np.uint64(29))
    return ((bits * factors) ^ ((bits * factors) >> np.uint64(31))).sum(axis=1, dtype=np.uint64).view(np.int64)


def _usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v, dim) of the rows that take part."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    v = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    return v.filter(F.col("vec_id").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))


def nearest(
    rows: DataFrame,
    every: int = 20,
    k: int = K,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of every vector whose id is divisible by ``every``."""
    spark = rows.sparkSession
    good = _usable(rows)
    is_query = F.col("vec_id") % every == 0
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    sizes = stage(
        good.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"), F.max(norm).alias("longest")), "vptree-sizes"
    ).select(
        "dim",
        F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"),
        F.greatest(F.ceil(F.col("q") / query_rows).cast("int"), F.lit(1)).alias("groups"),
        F.col("longest") * (1 + 1e-12),
    ).toDF("dim", "shards", "groups", "longest")
    sized = good.join(F.broadcast(sizes), "dim")  # one row per vector length
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    pick = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(n)).cast("int")
    common = ["dim", "shard", "grp", "kind", "vec_id", "v", "longest"]
    index = sized.withColumns({"shard": pick("shards", 1), "kind": F.lit(0)}).withColumn("grp", upto("groups")).select(*common)
    asked = sized.filter(is_query).withColumns({"grp": pick("groups", 2), "kind": F.lit(1)}).withColumn("shard", upto("shards")).select(*common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, find, last = [], None, None
        for b in batches:
            if not b.num_rows:
                continue
            head = np.stack([b.column(i).to_numpy() for i in range(4)], axis=1).astype(np.int64)
            ids, longest = b.column(4).to_numpy(), b.column(6).to_numpy()
            vectors = b.column(5)
            flat, offset = vectors.flatten().to_numpy(zero_copy_only=False), vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
            cuts = np.flatnonzero((head[1:] != head[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
                dim, shard, grp, kind = head[lo].tolist()
                if last != (dim, shard, grp):
                    held, find, last = [], None, (dim, shard, grp)
                part = ids[lo:hi], flat[offset[lo] : offset[hi]].reshape(hi - lo, dim)
                if kind == 0:
                    held.append(part)
                    continue
                if find is None:
                    find = _shard_search(*(np.concatenate(x) for x in zip(*held, strict=True)), k, factor, float(longest[lo])) if held else False
                    held = []
                if find:
                    q, cand, score = find(*part)
                    same = pa.array(_identity(part[1])[q])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part[0][q]), same, pa.array(cand), pa.array(score)], names=["query_id", "same", "vec_id", "score"]
                    )

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.union(asked).repartition(parts, "dim", "shard", "grp").sortWithinPartitions("dim", "shard", "grp", "kind")
    found = dealt.mapInArrow(run, "query_id long, same long, vec_id long, score double").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id", "same").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
