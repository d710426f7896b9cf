"""Whitening against numpy's eigenvectors and exact Python integers."""

import math
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, x int"


def plain(rows, k=16):
    """{id: [(component, n, deviation, whitened, explained)]} by numpy over the fit list."""
    kept = [
        (i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v])
        for i, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - fit.sum(axis=0) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = defaultdict(list)
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        white = (np.array(x) - np.array(sums) / n) @ vectors
        for c in range(len(values)):
            out[i].append((c + 1, n, deviation, white[c] / math.sqrt(values[c]), values[c] / centred.var(axis=0).sum()))
    return out


def check(got, want):
    by_id = defaultdict(list)
    for r in got:
        by_id[r["vec_id"]].append(r)
    assert {i: len(r) for i, r in by_id.items()} == {i: len(r) for i, r in want.items()}
    signs = {}
    for i, rows in by_id.items():
        for r, (c, n, deviation, white, explained) in zip(sorted(rows, key=lambda r: r["component"]), want[i], strict=True):
            assert (r["component"], r["n"], int(r["deviation"])) == (c, n, deviation)
            assert r["explained"] == pytest.approx(explained, rel=1e-9)
            if abs(white) > 1e-3:
                signs.setdefault(c, math.copysign(1, white * r["whitened"]))
            assert r["whitened"] * signs.get(c, 1) == pytest.approx(white, abs=1e-8)
            assert 0 <= r["identity_error"] < 1e-9


def test_given_vectors(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op13_embedding_whitening"](spark, sf)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(got.collect(), plain([(r[0], r[1]) for r in rows]))


def test_odd_rows_and_repeated_rows(spark):
    random = np.random.default_rng(3)
    vectors = (random.standard_normal((60, 5)) * [5, 3, 2, 1, 0.5]).tolist()
    rows = list(enumerate(vectors)) + [(100 + i, vectors[0]) for i in range(200)]
    odd = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0]), (903, [math.nan] * 5), (904, [math.inf, 0.0, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], SCHEMA)
    got = whitening.whiten(frame.repartition(7)).collect()
    assert {r["n"] for r in got} == {len({tuple(np.floor(64 * np.float32(v))) for v in vectors})}
    check(got, plain(rows))
    twice = spark.createDataFrame([(None, vectors[1], 1), (None, vectors[1], 1), (3, vectors[2], 1), (4, vectors[3], 1)], SCHEMA)
    assert [r["vec_id"] for r in whitening.whiten(twice, components=1).collect()].count(None) == 2


def test_no_rows_one_vector_and_lengths(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0], 1), (2, [0.5, 1.0], 1)], SCHEMA)).collect()
    assert len(one) == 4
    assert {(r["n"], int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"]) for r in one} == {(1, 0, None, 0.0, 0.0)}
    with pytest.raises(ValueError, match=r"lengths: \[1, 2\]"):
        whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0], 1), (2, [0.5], 1)], SCHEMA))


def test_deviation_beyond_a_long(spark):
    rows = [(1, [1e14, -1e14], 1), (2, [-1e14, 0.0], 1), (3, [2e13, 1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x int")
    got = whitening.whiten(frame).collect()
    xs = [[math.floor(64 * c) + 1000000 for c in v] for _, v, _ in rows]
    sums = [sum(c) for c in zip(*xs, strict=True)]
    want = {i + 1: sum((3 * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for i, x in enumerate(xs)}
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == want


@pytest.mark.parametrize("kind", ["random", "equal", "split", "low rank", "wilkinson"])
def test_components_of_close_eigenvalues(kind):
    d = 21
    random = np.random.default_rng(5)
    q = np.linalg.qr(random.standard_normal((d, d)))[0]
    matrix = {
        "random": q @ np.diag(np.arange(d) + 1.0) @ q.T,
        "equal": q @ np.diag([4.0] * 6 + [4.0 + 1e-13] * 2 + [1.0] * 13) @ q.T,
        "split": np.diag([3.0] * 7 + list(range(14))),
        "low rank": q[:, :3] @ q[:, :3].T * 1e12,
        "wilkinson": np.diag(np.abs(np.arange(d) - 10.0)) + np.diag([1.0] * (d - 1), 1) + np.diag([1.0] * (d - 1), -1),
    }[kind]
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.leading_components(matrix, 12)
    want = np.linalg.eigvalsh(matrix)[::-1][:12]
    norm = abs(want).max()
    assert np.allclose(values, want, rtol=0, atol=1e-13 * d * norm)
    assert np.allclose(vectors.T @ vectors, np.eye(12), atol=1e-12)
    assert np.allclose(matrix @ vectors, vectors * values, atol=1e-12 * d * norm)
