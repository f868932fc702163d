"""Whitening against whole-number brute force and a plain eigendecomposition."""

import random
from fractions import Fraction

import numpy as np
import pytest
from quillmark.llm import whitening
from quillmark.llm.queries import op13_whiten
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, component string, n string"


def brute(rows):
    """n, S, covariance (fractions), and the whole-number vectors by id."""
    x = {}
    for vec_id, v in rows:
        if v is not None and all(c is not None and np.isfinite(c) for c in v):
            x.setdefault(vec_id, []).append([int(np.floor(256.0 * float(np.float32(c)))) for c in v])
    dims = max((len(v) for vs in x.values() for v in vs), default=0)
    x = {k: [v + [0] * (dims - len(v)) for v in vs] for k, vs in x.items()}
    fit = sorted({tuple(v) for vs in x.values() for v in vs})
    n = len(fit)
    s = [sum(v[i] for v in fit) for i in range(dims)]
    cov = [[Fraction(sum((n * v[i] - s[i]) * (n * v[j] - s[j]) for v in fit), n**3) for j in range(dims)] for i in range(dims)]
    return x, n, s, cov


def check(df, rows, k=4):
    x, n, s, cov = brute(rows)
    got = {}
    for r in df.collect():
        got.setdefault(r["vec_id"], []).append(r)
    dims = len(s)
    assert {i: len(v) for i, v in got.items()} == {i: len(v) * min(k, dims) for i, v in x.items()}
    v = np.array([[float(c) for c in row] for row in cov])
    values = np.linalg.eigvalsh(v)[::-1]
    w = {}
    for i, vs in x.items():
        assert sorted(r["deviation"] for r in got[i]) == sorted(d for y in vs for d in [min(2**63 - 1, sum((n * c - t) ** 2 for c, t in zip(y, s, strict=True)))] * min(k, dims))
        for r in got[i]:
            assert r["n"] == n and r["identity_error"] <= 1e-4
            assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-4)
        if len(vs) == 1:
            w[tuple(vs[0])] = [r["whitened"] for r in sorted(got[i], key=lambda r: r["component"])]
    fit = np.array(list(w))
    whitened = np.array(list(w.values()))
    if len(w) == n:
        centred = fit - np.array(s) / n
        assert np.abs(whitened.T @ whitened / n - np.eye(min(k, dims))).max() < 1e-6
        direction = np.linalg.lstsq(centred, whitened, rcond=None)[0]
        for j in range(min(k, dims)):
            assert np.allclose(v @ direction[:, j], values[j] * direction[:, j], rtol=1e-6, atol=1e-6 * np.abs(v @ direction[:, j]).max())


def test_small_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check(op13_whiten(spark, SMALL), rows)


def test_awkward_rows(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) * (1 + j) for j in range(6)]) for i in range(90)]
    rows += [(200, None), (201, [None] * 6), (202, [float("nan")] * 6), (203, [1.0, float("inf"), 0.0, 0.0, 0.0, 0.0]), (None, [0.5] * 6), (204, [0.25] * 3)]
    rows += [(7, rows[7][1]), (300, rows[8][1])] + [(400 + i, [3.0] * 6) for i in range(50)]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    out = op13_like(df)
    check(out, rows)
    assert out.where("vec_id is null").count() == 4
    assert out.groupBy("vec_id", "component").count().where("count > 1").select("vec_id").distinct().collect()[0][0] == 7


def op13_like(df):
    return whitening.whiten(df, components=4, block_rows=64)


def test_scales(spark):
    """A dimension 100,000 times larger, and numbers beyond 64 bits of product."""
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * 1e5, rng.gauss(0, 1), rng.gauss(3, 1)]) for i in range(60)]
    check(op13_like(spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA)), rows)
    huge = [(0, [1e15, 1.0]), (1, [-1e15, 2.0]), (2, [3.0, 5.0])]
    x, n, s, _ = brute(huge)
    out = op13_like(spark.createDataFrame([(i, v, "", "") for i, v in huge], SCHEMA))
    assert {r["deviation"] for r in out.collect()} == {min(2**63 - 1, sum((n * c - t) ** 2 for c, t in zip(v[0], s, strict=True))) for v in x.values()}
    beyond = spark.createDataFrame([(0, [1e30], "", ""), (1, [-1e30], "", "")], SCHEMA)
    assert {r["x"][0] for r in whitening.whole_numbers(beyond).collect()} == {-(2**63), 9223372036854774784}
    assert sorted(round(r["whitened"], 6) for r in op13_like(beyond).collect()) == [-1.0, 1.0]


def test_little_variance(spark):
    one = op13_like(spark.createDataFrame([(1, [0.5, 1.0], "", ""), (2, [0.5, 1.0], "", "")], SCHEMA)).collect()
    assert len(one) == 4 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one} == {(1, 0, 0.0, 0.0, 0.0)}
    dependent = op13_like(spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0], "", "") for i in range(9)], SCHEMA))
    got = {r["component"]: r for r in dependent.where("vec_id = 8").collect()}
    assert got[1]["explained"] == pytest.approx(1) and got[2]["whitened"] == got[3]["whitened"] == 0 and got[1]["identity_error"] < 1e-9
    assert op13_like(spark.createDataFrame([], SCHEMA)).count() == 0
    assert op13_like(spark.createDataFrame([(1, [], "", ""), (2, None, "", "")], SCHEMA)).count() == 0
    with pytest.raises(ValueError, match="dimensions"):
        whitening.whiten(spark.createDataFrame([(1, [0.0] * 9, "", "")], SCHEMA), max_dims=8)


def test_planes_and_products():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(-(2**63), 2**63 - 1, (70, 2)), rng.integers(-5, 6, (70, 2))], axis=1)
    x[:, 3] = 4
    low, high = x.min(0), x.max(0)
    bits = np.array([(int(h) - int(m)).bit_length() for m, h in zip(low, high, strict=True)])
    limbs = np.zeros((int(2 * bits.max() + 64) // 32 + 1, 5, 5), np.int64)
    for part in (x[:1], x[1:]):
        whitening.scatter(whitening.planes(part, low, bits), bits, limbs)
    shifted = np.concatenate([x.astype(object) - low.astype(object), np.ones((70, 1), object)], axis=1)
    for i in range(5):
        for j in range(i, 5):
            assert sum(int(limbs[k, i, j]) << 32 * k for k in range(len(limbs))) == int((shifted[:, i] * shifted[:, j]).sum())
