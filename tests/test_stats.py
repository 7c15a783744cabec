"""M1 / M2 against a numpy brute force; M3 / M4 and O5 sanity."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from civic_spark.operators import sorting, stats


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    n = 400
    x1 = rng.normal(size=n)
    x2 = rng.integers(0, 5, size=n).astype(float)
    g = rng.choice(["a", "b", "c"], size=n)
    eff = {"a": 0.0, "b": 1.5, "c": -0.7}
    y = 2.0 + 0.8 * x1 - 0.3 * x2 + np.array([eff[v] for v in g]) + rng.normal(scale=0.5, size=n)
    p = 1 / (1 + np.exp(-(-0.5 + 1.2 * x1 + 0.2 * x2)))
    yb = (rng.random(n) < p).astype(float)
    rows = [(float(a), float(b), str(c), float(d), float(e)) for a, b, c, d, e in zip(x1, x2, g, y, yb)]
    rows.append((None, 1.0, "a", 1.0, 0.0))                      # dropped like glm / lm drop NA rows
    return spark.createDataFrame(rows, "x1 double, x2 double, g string, y double, yb double"), (x1, x2, g, y, yb)


def test_linear_regression_with_factor_matches_least_squares(data):
    df, (x1, x2, g, y, _) = data
    out = {r.term: r for r in stats.linear_regression(df, "y", ["x1", "x2"], ["g"]).collect()}
    X = np.column_stack([np.ones_like(x1), x1, x2, (g == "b").astype(float), (g == "c").astype(float)])
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ beta
    sigma2 = resid @ resid / (len(y) - X.shape[1])
    se = np.sqrt(np.diag(sigma2 * np.linalg.inv(X.T @ X)))
    names = ["(Intercept)", "x1", "x2", "gb", "gc"]
    assert set(out) == set(names)
    for name, b, s in zip(names, beta, se):
        assert out[name].estimate == pytest.approx(b, rel=1e-6, abs=1e-8)
        assert out[name].std_error == pytest.approx(s, rel=1e-5)


def test_logistic_regression_matches_irls(data):
    df, (x1, x2, _, _, yb) = data
    out = {r.term: r for r in stats.logistic_regression(df, "yb", ["x1", "x2"]).collect()}
    X = np.column_stack([np.ones_like(x1), x1, x2])
    beta = np.zeros(3)
    for _ in range(50):
        mu = 1 / (1 + np.exp(-X @ beta))
        w = mu * (1 - mu)
        beta = beta + np.linalg.solve(X.T @ (X * w[:, None]), X.T @ (yb - mu))
    mu = 1 / (1 + np.exp(-X @ beta))
    se = np.sqrt(np.diag(np.linalg.inv(X.T @ (X * (mu * (1 - mu))[:, None]))))
    for name, b, s in zip(["(Intercept)", "x1", "x2"], beta, se):
        assert out[name].estimate == pytest.approx(b, rel=1e-5)
        assert out[name].std_error == pytest.approx(s, rel=1e-4)


def test_aliased_terms_and_two_factors(spark):
    rng = np.random.default_rng(11)
    n = 500
    x, g, h = rng.normal(size=n) + 1e4, rng.integers(8, 12, n), rng.choice(["p", "q", "r"], n)
    y = 3 * x + 0.5 * g + (h == "q") + rng.normal(size=n)
    yb = (rng.random(n) < 1 / (1 + np.exp(-(x - 1e4) + (h == "r")))).astype(float)
    df = spark.createDataFrame([(float(a), float(2 * a + 1), int(b), str(c), float(d), float(e), 7.0) for a, b, c, d, e in zip(x, g, h, y, yb)],
                               "x double, twice double, g int, h string, y double, yb double, constant double")
    terms = ["(Intercept)", "x", "twice", "constant", "g9", "g10", "g11", "hq", "hr"]
    X = np.column_stack([np.ones(n), x, *[(g == k).astype(float) for k in (9, 10, 11)], h == "q", h == "r"]).astype(float)
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ beta
    se = np.sqrt(np.diag(resid @ resid / (n - X.shape[1]) * np.linalg.inv(X.T @ X)))
    out = stats.linear_regression(df, "y", ["x", "twice", "constant"], ["g", "h"]).collect()
    assert [r.term for r in out] == terms
    got = {r.term: r for r in out}
    for t in ("twice", "constant"):
        assert (got[t].estimate, got[t].std_error, got[t].statistic, got[t].p_value) == (None,) * 4
    kept = [t for t in terms if t not in ("twice", "constant")]
    for t, b, s in zip(kept, beta, se):
        assert got[t].estimate == pytest.approx(b, rel=1e-6, abs=1e-6) and got[t].std_error == pytest.approx(s, rel=1e-5)
    logit = {r.term: r for r in stats.logistic_regression(df, "yb", ["x", "constant"], ["h"]).collect()}
    Z = np.column_stack([np.ones(n), x - 1e4, h == "q", h == "r"]).astype(float)
    b = np.zeros(4)
    for _ in range(30):
        mu = 1 / (1 + np.exp(-Z @ b))
        b = b + np.linalg.solve(Z.T @ (Z * (mu * (1 - mu))[:, None]), Z.T @ (yb - mu))
    assert logit["constant"].estimate is None
    for t, v in zip(("x", "hq", "hr"), b[1:]):
        assert logit[t].estimate == pytest.approx(v, rel=1e-6)


def test_tail_probabilities_and_empty_models(spark):
    # quartiles and tails of Student's t, by numerical integration of its density
    import math
    for df in (1, 2, 5, 30, 400):
        u = np.linspace(0, math.pi / 2, 200_001)          # t = tan(u): finite range
        c = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
        f = np.zeros_like(u)
        f[:-1] = c * (1 + np.tan(u[:-1]) ** 2 / df) ** (-(df + 1) / 2) / np.cos(u[:-1]) ** 2
        for t in (0.0, 0.3, 1.0, 2.5, 8.0):
            inside = np.trapezoid(np.where(u <= math.atan(t), f, 0), u)
            assert stats.t_two_sided(t, df) == pytest.approx(1 - 2 * inside, abs=2e-4)
    empty = spark.createDataFrame([(None, 1.0)], "y double, x double")
    assert stats.linear_regression(empty, "y", ["x"]).count() == 0 and stats.logistic_regression(empty, "y", ["x"]).count() == 0
    two = stats.linear_regression(spark.createDataFrame([(1.0, 0.0), (3.0, 1.0)], "y double, x double"), "y", ["x"]).collect()
    assert [(round(r.estimate, 9), r.std_error, r.p_value) for r in two] == [(1.0, None, None), (2.0, None, None)]


def test_histogram_and_frequency(data):
    df, _ = data
    h = stats.histogram_density(df, ["g"], "x1", 0.5).collect()
    for grp in ("a", "b", "c"):
        assert sum(r.density * 0.5 for r in h if r.g == grp) == pytest.approx(1.0)
    f = stats.relative_frequency(df, [], "g").collect()
    assert sum(r.prop for r in f) == pytest.approx(1.0)


def test_hash_sample_is_deterministic(spark):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    a = {r.o_orderkey for r in sorting.hash_sample(o, 0.25, ["o_orderkey"], seed=1789).collect()}
    b = {r.o_orderkey for r in sorting.hash_sample(o.repartition(7), 0.25, ["o_orderkey"], seed=1789).collect()}
    assert a == b and 0.22 < len(a) / o.count() < 0.28


def test_exact_sample(spark):
    df = spark.range(3001).select("id", (F.col("id") % 7).alias("k"), F.lit("x").alias("__v"))
    for f in (0.0, 0.25, 1 / 3, 0.5, 0.9999, 1.0):
        assert sorting.sample_exact(df, f, ["id"], 5).count() == round(f * 3001)
    small = {r.id for r in sorting.sample_exact(df, 0.1, ["id"], 5).collect()}
    large = {r.id for r in sorting.sample_exact(df.repartition(9), 0.4, ["id"], 5).collect()}
    assert small < large and small != {r.id for r in sorting.sample_exact(df, 0.1, ["id"], 6).collect()}
    # keys that repeat tie at the cut
    tied = sorting.sample_exact(df, 0.3, ["k"], 5)
    assert tied.count() == 900 and sorted(r["count"] for r in tied.groupBy("k").count().collect())[-1] == 429
    assert sorted(r.id for r in tied.collect()) == sorted(r.id for r in sorting.sample_exact(df.repartition(4), 0.3, ["k"], 5).collect())
    assert sorting.sample_exact(df.limit(0), 0.5, ["id"]).count() == 0
