"""Whitening against exact sums and numpy's eigenvectors of the covariance."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from rollwise.llm import whitening
from rollwise.llm.common import read
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, component string"


def whole(v):
    return None if v is None or any(c is None or not math.isfinite(c) for c in v) else [math.floor(256 * float(np.float32(c))) for c in v]


def expect(rows):
    """(vec_id, x) of the rows taking part, n, exact sums, covariance of the distinct vectors."""
    kept = [(i, x) for i, v, *_ in rows if (x := whole(v)) is not None]
    dim = max((len(x) for _, x in kept), default=0)
    kept = [(i, x + [0] * (dim - len(x))) for i, x in kept]
    fit = sorted({tuple(x) for _, x in kept})
    a = np.array(fit, float).reshape(len(fit), dim)
    return kept, len(fit), [sum(c) for c in zip(*fit)], np.cov(a.T, bias=True).reshape(dim, dim) if len(fit) else np.zeros((dim, dim)), a


def verify(out, rows, wanted=4):
    kept, n, sums, cov, a = expect(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    some = min(wanted, int((values > 1e-13 * np.trace(cov)).sum()))
    assert len(out) == some * len(kept) and {r["component"] for r in out} <= set(range(1, some + 1))
    deviation = defaultdict(list)
    for i, x in kept:
        deviation[i].append(sum((n * c - s) ** 2 for c, s in zip(x, sums)))
    got = defaultdict(list)
    for r in out:
        assert r["n"] == n and r["identity_error"] < 1e-9
        got[r["component"], r["vec_id"]].append((r["deviation"], r["whitened"]))
        assert abs(r["explained"] / (values[r["component"] - 1] / np.trace(cov)) - 1) < 1e-10
    for (_, i), x in got.items():
        assert sorted(d for d, _ in x) == sorted(deviation[i])
    by = {i: np.array(x) for i, x in kept}
    return some, values, vectors, {k: v for k, v in got.items()}, by, np.array(sums) / max(n, 1)


def test_table_matches_eigenvectors(spark):
    df = read(spark, SF_SMALL, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    some, values, vectors, got, by, mean = verify(whitening.whiten(df).collect(), rows)
    assert some == 4
    for k in range(4):
        want = np.array([(by[i] - mean) @ vectors[:, k] / math.sqrt(values[k]) for i in sorted(by)])
        have = np.array([got[k + 1, i][0][1] for i in sorted(by)])
        assert np.abs(have - np.sign(have @ want) * want).max() < 1e-8


def test_odd_rows(spark):
    r = random.Random(2)
    rows = [(i, [r.gauss(0, 2 ** -(j % 9)) for j in range(12)], "x") for i in range(200)]
    rows += [(i, [0.25] * 12, "x") for i in range(300, 420)] + [rows[0], rows[0], (0, rows[5][1], "x"), (None, rows[7][1], "x")]
    rows += [(500, None, "x"), (501, [1.0, None], "x"), (502, [float("nan")] * 12, "x"), (503, [float("inf")] + [0.0] * 11, "x"), (504, [1.0, -2.0], "x"), (505, [], "x"), (506, [-0.0] * 12, "x")]
    rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], k) for i, v, k in rows]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    some, values, vectors, got, by, mean = verify(out, rows)
    assert some == 4 and len(got[1, 0]) == 4 and len(got[1, None]) == 1


@pytest.mark.parametrize("kind", ["equal eigenvalues", "low rank", "wide", "large"])
def test_hard_spectra(spark, kind):
    if kind == "equal eigenvalues":  # plus and minus each unit vector: a multiple of the identity
        rows = [(2 * j + s, [float((1, -1)[s]) * (i == j) for i in range(6)]) for j in range(6) for s in (0, 1)]
    elif kind == "low rank":
        rows = [(i, [float(i), 2.0 * i, 0.0, 3.0, float(i % 2)]) for i in range(40)]
    elif kind == "wide":
        g = np.random.default_rng(0)
        rows = [(i, [float(np.float32(c)) for c in g.standard_normal(40)]) for i in range(9)]
    else:  # entries beyond 16 bits, deviations near the end of a long
        rows = [(i, [float(2**12 * i + j) for j in range(3)] + [float(i % 3)]) for i in range(50)]
    df = spark.createDataFrame([(*x, "k") for x in rows], SCHEMA)
    some, *_ = verify(whitening.whiten(df).collect(), rows)
    assert some == {"equal eigenvalues": 4, "low rank": 2, "wide": 4, "large": 2}[kind]


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float(2.0**40 * (i + 1)), 1.0 * i]) for i in range(4)]
    out = whitening.whiten(spark.createDataFrame([(*x, "k") for x in rows], SCHEMA)).collect()
    assert out and all(r["deviation"] is None and r["n"] == 4 for r in out)


def test_ends_early_only_when_proved(spark):
    g = np.random.default_rng(1)
    a = g.standard_normal((400, 30)) * np.array([40, 30, 20, 10] + [0.1] * 26)
    rows = [(i, [float(np.float32(c)) for c in x], "k") for i, x in enumerate(a)]
    fit = whitening.FitList(whitening.whole_vectors(spark.createDataFrame(rows, SCHEMA)))
    c = whitening.Components(fit)
    values = np.linalg.eigvalsh(expect(rows)[3])[::-1]
    assert c.steps < 30 and np.abs(c.values / values[:4] - 1).max() < 1e-12


def test_nothing_to_whiten(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "k"), (2, [1.0, 2.0], "k"), (3, None, None)], SCHEMA)
    assert whitening.whiten(df).collect() == []
    empty = whitening.whiten(df.limit(0))
    assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(df.filter("vec_id = 3")).collect() == []
