"""Nearest neighbours against brute force: exact at factor one, recall at the registered factor."""

import numpy as np
from pyspark.sql import functions as F

from rollwise.llm import vptree
from tests.conftest import SF_MID


def brute(ids, vectors, every, k):
    out = {}
    for i, q in zip(ids, vectors):
        if i % every == 0:
            s = [float((v * q).sum()) for v in vectors]
            best = sorted((-x, j) for x, j in zip(s, ids) if j != i)[:k]
            out[i] = [(j, -x) for x, j in best]
    return out


def collect(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_exact_with_ties_copies_and_bad_rows(spark):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((700, 6)).astype(np.float32) * rng.uniform(0.2, 3, (700, 1)).astype(np.float32)
    vectors[100:260] = vectors[7]
    vectors[300:310] = 0
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    rows[320] = (320, None, 1)
    rows[321] = (321, [1.0, None, 2.0, 3.0, 4.0, 5.0], 1)
    rows[322] = (322, [float("nan")] * 6, 1)
    rows[323] = (323, [float("inf")] + [1.0] * 5, 1)
    rows += [(None, vectors[1].tolist(), 1), (900, [1.0, 2.0], 1), (901, [2.0, 1.0], 1), (902, [], 1), rows[40], rows[41]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    good = [i for i in range(700) if not (300 <= i < 310 or 320 <= i < 324)]
    want = brute(good, vectors[good].astype(float), 20, 20)
    want[900] = [(901, 4.0)]
    got = collect(vptree.nearest(df, factor=1.0, shard_rows=150, query_rows=10))
    assert got.keys() == want.keys()
    for q in want:
        assert [j for j, _ in got[q]] == [j for j, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)
    assert vptree.nearest(df.limit(0)).count() == 0


def test_ties_between_different_vectors_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(5)
    vectors = rng.choice([-1.0, 1.0], (600, 12))
    ids = rng.permutation(600).tolist()
    rows = [(i, v.tolist()) for i, v in zip(ids, vectors)]
    got = collect(vptree.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), shard_rows=170, query_rows=9))
    assert got == brute(ids, vectors, 20, 20)


def test_two_vectors_under_one_id(spark):
    """Different vectors of one id, equal in sum, are two queries with a list each."""
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [3.0, 0.0]), (2, [0.0, 3.0])]
    out = vptree.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in out) == [(1, 1, 3.0), (1, 2, 3.0), (2, 1, 0.0), (2, 2, 0.0)]


def test_recall_on_embeddings(spark):
    df = spark.read.parquet(f"{SF_MID}/embeddings.parquet").withColumn("score", F.lit("clash"))
    rows = df.orderBy("vec_id").collect()
    want = brute([r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float), 20, 20)
    got = collect(vptree.nearest(df, shard_rows=250))
    hits = [len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / len(want[q]) for q in want]
    assert got.keys() == want.keys() and np.mean(hits) == 1


def test_pruning_skips_work_on_clustered_points():
    rng = np.random.default_rng(1)
    points = (rng.standard_normal((20, 8))[:, None] * 5 + rng.standard_normal((20, 200, 8)) * 0.1).reshape(-1, 8)
    tree = vptree.VantageTree(points)
    rows, _ = tree.search(points[::40], 10, 1.0)
    exact = np.argsort(-(points[::40] @ points.T), axis=1, kind="stable")[:, :10]
    assert (np.sort(rows) == np.sort(exact)).all() and tree.visited < 0.6 * 100 * len(points)


def test_registered_factor_finds_all_with_unequal_norms_and_one_outlier():
    rng = np.random.default_rng(2)
    unit = rng.standard_normal((4000, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    for stretch in (np.ones(4000), np.r_[2.0, np.ones(3999)], np.r_[50.0, np.ones(3999)], rng.lognormal(0, 0.3, 4000)):
        points = unit * stretch[:, None]
        tree = vptree.VantageTree(points, longest=float(stretch.max()))
        rows, _ = tree.search(points[::40], 20, vptree.FACTOR)
        exact = np.argsort(-(points[::40] @ points.T), axis=1, kind="stable")[:, :20]
        assert (np.sort(rows) == np.sort(exact)).all()
