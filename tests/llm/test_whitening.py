import math
import random
from fractions import Fraction

import numpy as np
import pytest

from civic_spark.llm import queries, whitening

NAN, INF = float("nan"), float("inf")


def exact(table):
    """(n, sums, {position: deviation}, covariance) of usable (id, vector) rows, in whole numbers."""
    xs = [tuple(math.floor(Fraction(c) * 256) for c in v) for _, v in table]
    fit = sorted(set(xs))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(x, sums)) for x in xs]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    return n, deviations, xs, sums, centred.T @ centred / n


def check(rows, table, k=4):
    n, deviations, xs, sums, v = exact(table)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    want = sorted((i, j + 1, n, dev) for (i, _), dev in zip(table, deviations) for j in range(min(k, len(v))))
    assert sorted((r.vec_id, r.component, r.n, r.deviation) for r in rows) == want
    by = {(r.vec_id, r.component): r for r in rows}
    for j in range(min(k, len(v))):
        assert {r.explained for r in rows if r.component == j + 1} == {rows_j.explained for rows_j in rows if rows_j.component == j + 1}
        first = by[table[0][0], j + 1]
        assert first.explained == pytest.approx(values[j] / v.trace(), rel=1e-9)
        w = np.array([float(Fraction(a * n - s, n)) for x in xs for a, s in zip(x, sums)]).reshape(len(xs), -1) @ vectors[:, j] / math.sqrt(values[j])
        got = np.array([by[i, j + 1].whitened for i, _ in table])
        sign = np.sign((got * w).sum())
        assert np.allclose(got * sign, w, rtol=1e-7, atol=1e-7)
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-9


def test_eigen_matches_lapack():
    rng = np.random.default_rng(1)
    for d, rank in ((1, 1), (2, 2), (5, 5), (9, 4), (33, 33), (64, 20)):
        b = rng.normal(size=(d, rank)) * 10.0 ** rng.integers(-4, 5, rank)
        a = b @ b.T
        vectors, values = whitening.eigen(a, d)
        want = np.linalg.eigvalsh(a)[::-1]
        assert np.allclose(values, np.maximum(want, 0), rtol=1e-10, atol=want[0] * 1e-13)
        used = values > 0
        assert np.allclose(vectors[:, used].T @ vectors[:, used], np.eye(used.sum()), atol=1e-10)
        assert np.allclose(vectors * values @ vectors.T, a, rtol=1e-10, atol=want[0] * 1e-12)
    assert whitening.eigen(np.zeros((3, 3)), 2)[1].tolist() == [0, 0]
    graded = np.diag([1e12, 1.0, 1e-10])
    assert whitening.eigen(graded, 2)[1].tolist() == pytest.approx([1e12, 1.0], rel=1e-14)


def frame(spark, table, kind="array<double>"):
    return spark.createDataFrame([(v and [c if c is None else float(c) for c in v], i, "s", 7) for i, v in table], f"embedding {kind}, vec_id long, x string, w int").repartition(3)


def test_odd_vectors(spark):
    rng = random.Random(4)
    table = [(i, [rng.gauss(m, s) for m, s in ((0, 1), (5, 0.1), (-3, 2), (0.5, 7), (0, 0.01), (1000, 3))]) for i in range(60)]
    table += [(100 + i, table[7][1]) for i in range(40)] + [(200, [-0.0] * 6), (201, [-0.001] * 6), (202, table[8][1])]
    dropped = [(300, None), (301, [1.0, None, 0, 0, 0, 0.0]), (302, [NAN] * 6), (303, [0.0, INF, 0, 0, 0, 0]), (304, [-INF] + [0.0] * 5)]
    check(whitening.whiten(frame(spark, table + dropped)).collect(), table)


def test_short_vectors_wide_numbers_and_null_ids(spark):
    rng = random.Random(5)
    table = [(i, [rng.uniform(-2e15, 2e15) for _ in range(3)]) for i in range(20)]
    n, deviations, *_ = exact(table)
    rows = whitening.whiten(frame(spark, table)).collect()
    assert {r.vec_id: r.deviation for r in rows} == {i: None for i, _ in table} and min(deviations) >= 1 << 63
    assert rows[0].identity_error < 1e-9 and len(rows) == 60
    huge = whitening.whiten(frame(spark, [(1, [1e308, -1e308]), (2, [0.0]), (None, []), (2, [3.0, 1.0])])).collect()
    assert sorted((r.vec_id or 0, r.component) for r in huge) == [(0, 1), (0, 2), (1, 1), (1, 2)] + [(2, k) for k in (1, 1, 2, 2)]
    assert {r.n for r in huge} == {3}


def test_degenerate_tables(spark):
    one = whitening.whiten(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(one, key=lambda r: (r.component, r.vec_id))] == [
        (1, 1, 0, None, 0.0, 0.0)] * 2 + [(2, 1, 0, None, 0.0, 0.0)] * 2
    line = whitening.whiten(frame(spark, [(k, [float(k), 2.0 * k]) for k in range(5)])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line)
    assert {round(r.explained, 12) for r in line if r.component == 1} == {1.0} and line[0].identity_error < 1e-12
    empty = whitening.whiten(frame(spark, [(1, None), (2, [])]).limit(0))
    assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_whitening_query(spark, sf):
    rows = queries.op13_embedding_whitening(spark, f"/root/testdata/{sf}").collect()
    table = [(r.vec_id, r.embedding) for r in queries.table(spark, f"/root/testdata/{sf}", "embeddings").collect()]
    check(rows, table)
