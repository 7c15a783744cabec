"""Statistical operators (M1–M4).

M1 / M2 return the coefficient table R's ``summary()`` prints: estimate, std.
error, t / z value, p value.  Rows with a NULL in any formula column are dropped
first, as ``glm`` / ``lm`` do.  Factors take R's treatment coding: the first
level in order is the baseline.

No design matrix is built.  Grouped by the factors, sums of products of the
numeric columns hold every cross product of the model, whatever the number of
rows; only these (of the order of the squared number of terms) reach the driver.
The logit first groups equal design rows, with counts and successes, into a
written table, and each Newton step is one such aggregate over it.  Numeric
columns are centred before they are multiplied.  A term that depends on earlier
ones is found by its pivot and has NULL estimates, R's NA.

M3 / M4 are plain aggregates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

TABLE = "term string, estimate double, std_error double, statistic double, p_value double"
#: Smallest share of a column's own square that earlier columns may leave.
ALIASED = 1e-10
MAX_STEPS, DEVIANCE_CHANGE = 25, 1e-8


def _complete(df: DataFrame, label: str, features: Sequence[str], factors: Sequence[str]) -> DataFrame:
    """Formula columns without NULL, numbers as double."""
    return df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in (label, *features)],
                     *[F.col(f"`{f}`").cast("string").alias(f) for f in factors]).dropna()


def _level_order(level: str) -> tuple:
    """Numbers by value, then texts."""
    try:
        return (0, float(level), level)
    except ValueError:
        return (1, 0.0, level)


class _Design:
    """Terms of a model, and its cross products from sums by factor cell."""

    def __init__(self, features: Sequence[str], factors: Sequence[str], means: Sequence[float]) -> None:
        self.features, self.factors, self.means = list(features), list(factors), list(means)
        self.levels: dict[str, list[str]] = {}

    def centred(self) -> list[Column]:
        return [F.col(f"`{c}`") - F.lit(float(m)) for c, m in zip(self.features, self.means)]

    def cells(self, df: DataFrame, weight: Column, response: Column, also: Column | None = None) -> list:
        """Per factor cell: sums of weight, weight * x, weight * x * x, response, response * x, and of ``also``."""
        x = self.centred()
        sums = [F.sum(weight).alias("w"), F.sum(response).alias("r"), F.sum(F.lit(0.0) if also is None else also).alias("also")]
        for i, a in enumerate(x):
            sums += [F.sum(weight * a).alias(f"w{i}"), F.sum(response * a).alias(f"r{i}")]
            sums += [F.sum(weight * a * b).alias(f"w{i}_{j}") for j, b in enumerate(x[i:], i)]
        return df.groupBy(*[f"`{f}`" for f in self.factors]).agg(*sums).collect()

    def learn_levels(self, cells: list) -> None:
        self.levels = {f: sorted({c[f] for c in cells}, key=_level_order)[1:] for f in self.factors}

    @property
    def terms(self) -> list[str]:
        return ["(Intercept)", *self.features, *[f"{f}{v}" for f, vs in self.levels.items() for v in vs]]

    def cross_products(self, cells: list) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(self.terms), len(self.features)
        place = {(f, v): i for i, (f, v) in enumerate(((f, v) for f, vs in self.levels.items() for v in vs), k + 1)}
        gram, right = np.zeros((n, n)), np.zeros(n)
        for c in cells:
            ones = [0, *[place[f, c[f]] for f in self.factors if (f, c[f]) in place]]
            gram[np.ix_(ones, ones)] += c["w"]
            right[ones] += c["r"]
            for i in range(k):
                gram[ones, i + 1] += c[f"w{i}"]
                gram[i + 1, ones] += c[f"w{i}"]
                right[i + 1] += c[f"r{i}"]
                for j in range(i, k):
                    gram[i + 1, j + 1] += c[f"w{i}_{j}"]
                    if i < j:
                        gram[j + 1, i + 1] += c[f"w{i}_{j}"]
        return gram, right

    def predictor(self, beta: np.ndarray) -> Column:
        """Linear predictor of a row; ``beta`` is for centred columns, with 0 for aliased terms."""
        value = F.lit(float(beta[0]))
        for b, x in zip(beta[1:], self.centred()):
            value = value + F.lit(float(b)) * x
        at = len(self.features) + 1
        for f, levels in self.levels.items():
            if levels:
                effects = F.create_map(*[x for i, v in enumerate(levels) for x in (F.lit(v), F.lit(float(beta[at + i])))])
                value = value + F.coalesce(F.try_element_at(effects, F.col(f"`{f}`")), F.lit(0.0))
            at += len(levels)
        return value

    def table(self, spark, beta: np.ndarray, inverse: np.ndarray, kept: np.ndarray, scale: float, p_value) -> DataFrame:
        """Coefficients of the uncentred columns with their errors; NULL for aliased terms."""
        back = np.eye(len(beta))
        back[0, 1:len(self.means) + 1] = [-m for m in self.means]
        estimates, cov = back @ beta, back @ inverse @ back.T * scale
        rows = []
        for i, term in enumerate(self.terms):
            if not kept[i]:
                rows.append((term, None, None, None, None))
                continue
            error = math.sqrt(max(cov[i, i], 0.0)) if math.isfinite(scale) else None
            t = float(estimates[i]) / error if error else None
            rows.append((term, float(estimates[i]), error, t, p_value(t) if t is not None else None))
        return spark.createDataFrame(rows, TABLE)


def _inverse(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(inverse over the kept terms, kept): terms are swept in order; a pivot lost to earlier terms drops its term."""
    size = np.sqrt(np.maximum(gram.diagonal(), 0))
    size[size == 0] = 1
    a = gram / np.outer(size, size)
    own = gram.diagonal() / size ** 2
    kept = np.zeros(len(a), bool)
    for i in range(len(a)):
        if a[i, i] <= ALIASED * max(own[i], np.finfo(float).tiny):
            continue
        kept[i] = True
        pivot, row, col = a[i, i], a[i].copy(), a[:, i].copy()
        a -= np.outer(col, row) / pivot
        a[i], a[:, i], a[i, i] = row / pivot, -col / pivot, 1 / pivot
    inverse = np.where(np.outer(kept, kept), a, 0.0) / np.outer(size, size)
    return (inverse + inverse.T) / 2, kept


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction, for x below (a + 1) / (a + b + 2)."""
    tiny = 1e-300
    guard = lambda v: v if abs(v) > tiny else tiny
    c, d = 1.0, 1 / guard(1 - (a + b) * x / (a + 1))
    total = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d, c = 1 / guard(1 + even * d), guard(1 + even / c)
        total *= d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d, c = 1 / guard(1 + odd * d), guard(1 + odd / c)
        total *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * total / a


def t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) of Student's t."""
    x = df / (df + t * t)
    if x >= 1:
        return 1.0
    a, b = df / 2, 0.5
    return _beta_fraction(a, b, x) if x < (a + 1) / (a + b + 2) else 1 - _beta_fraction(b, a, 1 - x)


def linear_regression(df: DataFrame, label: str, features: Sequence[str], factors: Sequence[str] = ()) -> DataFrame:
    """M2: ``lm(y ~ x + as.factor(f))`` coefficient table, from normal equations of centred columns."""
    spark, data = df.sparkSession, _complete(df, label, features, factors)
    first = data.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate((label, *features))]).first()
    if first["n"] == 0:
        return spark.createDataFrame([], TABLE)
    middle = first["m0"]
    design = _Design(features, factors, [first[f"m{i + 1}"] for i in range(len(features))])
    y = F.col(f"`{label}`") - F.lit(float(middle))
    cells = design.cells(data, F.lit(1.0), y)
    design.learn_levels(cells)
    gram, right = design.cross_products(cells)
    inverse, kept = _inverse(gram)
    beta = inverse @ right
    rss = data.agg(F.sum((y - design.predictor(beta)) ** 2)).first()[0]
    rest = first["n"] - int(kept.sum())
    beta[0] += middle
    return design.table(spark, beta, inverse, kept, rss / rest if rest > 0 else math.nan, lambda t: t_two_sided(t, rest))


def logistic_regression(df: DataFrame, label: str, features: Sequence[str], factors: Sequence[str] = ()) -> DataFrame:
    """M1: ``glm(y ~ x..., family = binomial())`` coefficient table.

    Newton steps run until the deviance settles, 25 at most (R's rule); the errors come from the last information
    matrix."""
    spark, data = df.sparkSession, _complete(df, label, features, factors)
    rows = cut_lineage(data.groupBy(*[f"`{c}`" for c in (*features, *factors)]).agg(F.count(F.lit(1)).alias("__n"), F.sum(f"`{label}`").alias("__y")))
    first = rows.agg(F.sum("__n").alias("n"), F.sum("__y").alias("y"), *[(F.sum(F.col(f"`{c}`") * F.col("__n")) / F.sum("__n")).alias(f"m{i}")
                                                                       for i, c in enumerate(features)]).first()
    if not first["n"]:
        return spark.createDataFrame([], TABLE)
    design = _Design(features, factors, [first[f"m{i}"] for i in range(len(features))])
    design.learn_levels(rows.select(*[f"`{f}`" for f in factors]).distinct().collect() if factors else [])
    beta = np.zeros(len(design.terms))
    share = min(max(first["y"] / first["n"], 1e-9), 1 - 1e-9)
    beta[0] = math.log(share / (1 - share))
    n, y, before = F.col("__n"), F.col("__y"), math.inf
    for _ in range(MAX_STEPS):
        mu = 1 / (1 + F.exp(-F.col("__eta")))
        log_odds = F.col("__eta")
        stepped = rows.withColumn("__eta", design.predictor(beta))
        # -2 log likelihood; log(1 + e^eta) without overflow
        deviance = 2 * (n * (F.greatest(log_odds, F.lit(0.0)) + F.log1p(F.exp(-F.abs(log_odds)))) - y * log_odds)
        cells = design.cells(stepped, n * mu * (1 - mu), y - n * mu, deviance)
        gram, right = design.cross_products(cells)
        inverse, kept = _inverse(gram)
        beta, now = beta + inverse @ right, sum(c["also"] for c in cells)
        if abs(now - before) / (abs(now) + 0.1) < DEVIANCE_CHANGE:
            break
        before = now
    return design.table(spark, beta, inverse, kept, 1.0, lambda z: math.erfc(abs(z) / math.sqrt(2)))


def histogram_density(df: DataFrame, groups: Sequence[str], value: str, bin_width: float,
                      name: str = "density") -> DataFrame:
    """M3: density of ``value`` by group as a fixed-width histogram:
    ``count / (group_total * bin_width)`` per bin (bin = lower edge)."""
    b = (F.floor(F.col(value) / bin_width) * bin_width).alias("bin")
    h = df.filter(F.col(value).isNotNull()).groupBy(*groups, b).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*groups)) if groups else h.agg(F.sum("n")).scalar()
    return h.withColumn(name, F.try_divide(F.col("n"), total * F.lit(bin_width)))


def relative_frequency(df: DataFrame, groups: Sequence[str], value: str, name: str = "prop") -> DataFrame:
    """M4: ``stat_count(y = ..prop..)`` — share of each value within its group."""
    c = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"))
    if not groups:
        return c.withColumn(name, F.try_divide(F.col("n"), c.agg(F.sum("n")).scalar()))
    w = Window.partitionBy(*groups)
    return c.withColumn(name, F.try_divide(F.col("n"), F.sum("n").over(w)))
