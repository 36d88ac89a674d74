import math
import random

import numpy as np
import pytest

from tallyward.llm.whitening import whiten

SCHEMA = "vec_id bigint, embedding array<float>"


def _check(rows, got, components):
    """Against one matrix in numpy; equal ids are told apart by their values."""
    x = np.floor(np.array([v for _, v in rows], dtype="float32").astype(float) * 64).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    centred = (n * x - total) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(components)])
    want = sorted(
        (i is not None, i or 0, int(((n * a - total) ** 2).sum()), c + 1, round(float(z), 6))
        for (i, _), a, b in zip(rows, x, centred @ vectors / np.sqrt(values))
        for c, z in enumerate(b)
    )
    shown = sorted((r.vec_id is not None, r.vec_id or 0, r.deviation, r.component, round(r.whitened, 6)) for r in got)
    assert [w[:4] for w in want] == [s[:4] for s in shown]
    assert np.allclose([w[4] for w in want], [s[4] for s in shown], atol=1e-5)
    parts = {r.component: r.explained for r in got}
    assert np.allclose([parts[c + 1] for c in range(components)], values / (centred**2).sum() * n, rtol=1e-9)
    assert {r.n for r in got} == {n} and all(r.identity_error < 1e-9 for r in got)


@pytest.mark.parametrize(("n", "width"), [(700, 40), (50, 6)])
def test_whitening(spark, n, width):
    draw = np.random.default_rng(n)
    made = draw.normal(size=(n, width)) @ draw.normal(size=(width, width))
    rows = [(k, [float(v) for v in row]) for k, row in enumerate(made.astype("float32"))]
    got = whiten(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    _check(rows, got, min(32, width))


def test_several_row_blocks(spark, monkeypatch):
    from tallyward.llm import whitening

    monkeypatch.setattr(whitening, "BLOCK", 64)
    draw = random.Random(5)
    rows = [(k, [draw.gauss(0, 1) for _ in range(4)]) for k in range(500)]
    rows = [(k, [float(np.float32(v)) for v in vector]) for k, vector in rows]
    _check(rows, whiten(spark.createDataFrame(rows, SCHEMA)).collect(), 4)


def test_edges(spark):
    good = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.0, 5.0]), (2, [-3.5, 0.25])]
    bad = [(3, None), (4, [None, 1.0]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]), (7, [3.0]), (8, []), (9, [1e30, 0.0])]
    frame = spark.createDataFrame(good + bad, SCHEMA).selectExpr("*", "'x' AS index", "'x' AS vector", "'x' AS n", "'x' AS _own")
    _check(good, whiten(frame).collect(), 2)


def test_nothing_to_whiten(spark):
    none = spark.createDataFrame([], SCHEMA)
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for frame in (none, same):
        got = whiten(frame)
        assert got.columns == names and got.collect() == []


def test_one_direction(spark):
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 0.0]) for k in range(9)], SCHEMA)
    got = whiten(line).collect()
    assert {r.component for r in got} == {1} and math.isclose(got[0].explained, 1)


def test_deviation_beyond_64_bits(spark):
    far = spark.createDataFrame([(1, [1e9]), (2, [-1e9])], "vec_id bigint, embedding array<double>")
    assert {r.deviation for r in whiten(far).collect()} == {None}
