"""Whitening against numpy's eigenvectors of the covariance and Python's integers."""

import math

import numpy as np
import pytest

from weftline.llm import whitening


def rows(seed=3, n=500, dims=12):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, dims)) @ np.diag(np.linspace(1, 0.05, dims)) @ rng.normal(size=(dims, dims)) * 0.2 + rng.normal(size=dims)
    out = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(mixed)]
    out += [(900, None, 0), (901, [], 0), (902, [math.nan] * dims, 0), (903, [None, *[0.0] * (dims - 1)], 0), (904, [math.inf, *[0.0] * (dims - 1)], 0), (905, [1.0, 2.0], 0)]
    return out + [(None, out[3][1], 0), out[4], out[4]]


def sound(rows, dims=12):
    return [(i, v) for i, v, *_ in rows if v and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("vectors")
    spark.createDataFrame(rows(), "vec_id long, embedding array<float>, label int").repartition(37).write.parquet(str(path / "embeddings.parquet"))
    return str(path)


def test_query_against_plain_version(spark, folder):
    kept = sound(rows())
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in kept], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = np.array((n * x - sums) / n, dtype=float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    got = whitening.op11_whitening(spark, folder).collect()
    assert len(got) == 8 * n
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    signs = {}
    for k in range(1, 9):
        want = sorted(((-1 if i is None else i), int(((n * row - sums) ** 2).sum()), float(c @ axes[:, k - 1] / math.sqrt(values[k - 1]))) for (i, _), row, c in zip(kept, x, centred, strict=True))
        have = sorted((-1 if r.vec_id is None else r.vec_id, r.deviation, r.whitened) for r in by[k])
        signs[k] = math.copysign(1, have[5][2] * want[5][2])
        assert [h[:2] for h in have] == [w[:2] for w in want]
        assert np.allclose([h[2] * signs[k] for h in have], [w[2] for w in want], atol=1e-9)
        assert all(r.n == n and abs(r.explained - values[k - 1] / values.sum()) < 1e-9 and r.identity_error < 1e-9 for r in by[k])


def test_jacobi_keeps_small_values_accurate():
    rng = np.random.default_rng(5)
    left, right = (np.linalg.qr(rng.normal(size=(9, 9)))[0] for _ in range(2))
    scaled = rng.normal(size=(9, 9)) @ np.diag(10.0 ** -np.arange(0, 18, 2))
    axes, lengths = whitening.one_sided_jacobi(scaled)
    assert np.allclose(axes @ axes.T, np.eye(9), atol=1e-13)
    # columns of very different lengths: the least value is the determinant over the others
    assert abs(np.prod(lengths) / abs(np.linalg.det(scaled)) - 1) < 1e-9
    even = left @ np.diag([5, 5, 3, 2, 1, 1e-3, 1e-5, 0, 0]) @ right
    assert np.allclose(whitening.one_sided_jacobi(even)[1], [5, 5, 3, 2, 1, 1e-3, 1e-5, 0, 0], atol=1e-14)
    assert whitening.one_sided_jacobi(np.array([[3.0], [4.0]]))[1] == [5]


def test_without_rows_or_variance(spark, tmp_path):
    schema = "vec_id long, embedding array<double>, label int"
    for name, data in (("none", []), ("bad", [(1, None, 0), (2, [math.nan], 0)]), ("one", [(1, [0.5, 0.25], 0)]), ("equal", [(1, [0.5, 0.25], 0)] * 3), ("line", [(i, [float(i), 2.0 * i, 0.0], 0) for i in range(6)])):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / name / "embeddings.parquet"))
        got = whitening.op11_whitening(spark, str(tmp_path / name)).collect()
        if name in ("none", "bad"):
            assert got == []
        elif name == "line":
            assert [r.whitened is None for r in sorted(got, key=lambda r: r.component)] == [False] * 6 + [True] * 12
            assert all(r.identity_error < 1e-12 for r in got)
        else:
            assert len(got) == 2 * len(data) and all((r.deviation, r.whitened, r.explained, r.identity_error) == (0, None, None, None) for r in got)


def test_huge_entries_and_clashing_names(spark):
    data = [(1e300, -1e300), (-1e300, 2.0), (float(1 << 39), 1.0), (0.0, 0.0)]
    vectors = spark.createDataFrame([(i, list(v), 1) for i, v in enumerate(data)], "`whitening.x` long, `a``b` array<double>, dims int")
    model = whitening.fit(vectors, "a`b")
    x = [[max(-whitening.MOST, min(whitening.MOST, math.floor(1024 * max(-1e15, min(1e15, c))))) + 100000 for c in v] for v in data]
    assert model.n == 4 and model.sums == [sum(c) for c in zip(*x, strict=True)]
    got = whitening.transform(vectors, model, "a`b", "w").collect()
    assert all(r["w"].deviation is None for r in got)  # beyond a long
    assert whitening.identity_error(vectors, model, "a`b") < 1e-6
