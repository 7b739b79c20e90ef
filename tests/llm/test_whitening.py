import math

import numpy as np
import pytest

from snapstats.llm import spectrum, whitening
from snapstats.llm.queries import QUERIES


def brute(rows):
    """{(id, component): (n, deviation, |whitened|, explained)} and the grid vectors, by numpy's solver."""
    usable = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    grid = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in usable]
    fit = sorted({tuple(x) for _, x in grid})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array(fit, float) - np.array(sums) / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[: whitening.COMPONENTS]
    out = {}
    for i, x in grid:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        for k, j in enumerate(order, 1):
            if values[j] > 1e-12 * np.trace(cov):
                w = (np.array(x) - np.array(sums) / n) @ vectors[:, j] / math.sqrt(values[j])
                out.setdefault((i, k), []).append((n, deviation, abs(w), values[j] / np.trace(cov)))
    return out


def check(frame, rows, near=1e-7):
    got, signs = {}, {}
    for r in frame.collect():
        got.setdefault((r["vec_id"], r["component"]), []).append((r["n"], r["deviation"], abs(r["whitened"]), r["explained"]))
        assert r["identity_error"] <= 1e-4
        signs.setdefault(r["component"], []).append(r["whitened"])
    want = brute(rows)
    assert got.keys() == want.keys()
    for key, each in want.items():
        for g, w in zip(sorted(got[key]), sorted(each), strict=True):
            assert g[:2] == w[:2]
            assert g[2] == pytest.approx(w[2], abs=near) and g[3] == pytest.approx(w[3], rel=1e-9)
    return signs


def test_whitening_of_embeddings(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(QUERIES["op13_whitening"](spark, sf_dir), rows)


def test_odd_vectors(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=5).tolist()) for i in range(40)]
    rows = good + [(3, good[3][1]), (None, good[5][1]), (None, [0.5] * 5), (50, None), (51, [1.0, None, 0, 0, 0]), (52, [math.nan, 0, 0, 0, 0]),
                   (53, [0, 0, math.inf, 0, 0]), (54, [1e300, 0, 0, 0, 0]), (55, []), (56, [-100.0, 100.0, 0.0, 1.0, 2.0])]
    other = [(60, [1.0, 2.0]), (61, [1.0] * 6)]
    make = lambda r: spark.createDataFrame([(i, v and [c if c is None else float(c) for c in v], 7, 7) for i, v in r], "vec_id int, embedding array<double>, component int, n int").repartition(3)
    known = [r for r in rows if r[0] != 54]
    signs = check(whitening.whiten(make(rows + other)), known, 1e-6)
    assert set(signs) == {1, 2, 3, 4, 5}
    for empty in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        assert whitening.whiten(make(empty)).count() == 0
    flat = [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)]  # one direction only
    check(whitening.whiten(make(flat)), flat, 1e-6)


def test_deviations_are_exact():
    rows = np.array([[2**40, -(2**40)], [1, 2], [2**30, 5]])
    sums = [3, -7]
    for n in (1, 1000, 2**35):
        want = [(n * a - 3) ** 2 + (n * b + 7) ** 2 for a, b in rows.tolist()]
        for keep in ([0, 1, 2], [1], [1, 2]):
            assert whitening.deviations(rows[keep], n, sums) == [w if w < 2**63 else None for w in (want[k] for k in keep)]


def matrices():
    rng = np.random.default_rng(6)
    for size in (1, 2, 7, 40):
        a = rng.normal(size=(size, size))
        yield a @ a.T
        yield a + a.T
        q = np.linalg.qr(a)[0]
        yield q @ np.diag(np.repeat([5.0, 1.0], [size // 2, size - size // 2])) @ q.T  # many equal eigenvalues
        yield q @ np.diag(1.0 + 1e-9 * np.arange(size)) @ q.T  # very close ones
        yield q @ np.diag(10.0 ** -np.arange(size)) @ q.T
    yield np.zeros((4, 4))
    yield np.eye(5) * 3
    yield np.array([[0.0, 1.0], [1.0, 0.0]])


def test_counts_and_leading_pairs():
    for matrix in matrices():
        want = np.sort(np.linalg.eigvalsh(matrix))[::-1]
        scale = max(abs(want).max(), 1e-300)
        for shift in (0.123, -2.5, 1.7, want[0] * 1.01 + 0.01):
            assert spectrum.count_above(matrix, shift) == (want > shift).sum()
        values, vectors = spectrum.leading(matrix, 16)
        k = len(values)
        assert k == min(16, len(matrix))
        assert np.abs(values - want[:k]).max() <= 1e-12 * scale * len(matrix)
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() <= 1e-10
        assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-9 * scale
