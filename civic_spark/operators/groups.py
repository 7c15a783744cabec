"""Whole-group filters (F7–F10) and group-level values broadcast to rows.

Design: the group flag is computed with an **aggregate** (partial aggregation
before the shuffle, so a hot group collapses map-side) and attached back with
a null-safe semi / anti / left join.  A window over the group would have to
sort the whole group in one task; the aggregate + join form lets AQE split a
skewed join partition instead.  ``strategy='window'`` keeps the single-pass
window form for inputs whose groups are known to be small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import null_keys


def _attached(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column], keep: Column | None, how: str,
              rows: Column | None = None) -> DataFrame:
    """``df`` joined with its groups' ``aggs`` (over the rows where ``rows``, of the groups where ``keep``).

    The keys are made non-null once, before the aggregate: aggregate and join
    then hash the same plain columns, so the groups are shuffled once (partial
    rows) and the large side once."""
    keyed, names = null_keys(df, keys)
    source = keyed if rows is None else keyed.filter(rows)
    groups = source.groupBy(*names).agg(*[v.alias(k) for k, v in aggs.items()])
    if keep is not None:
        groups = groups.filter(keep).select(*names)
    return keyed.join(groups, names, how).select(*df.columns, *(aggs if how == "left" else ()))


def with_group_values(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column],
                      strategy: str = "join") -> DataFrame:
    """``group_by(keys) %>% mutate(name = agg)`` — every row gets
    the aggregate of its group."""
    if strategy == "window":
        w = Window.partitionBy(*keys)
        return df.withColumns({k: v.over(w) for k, v in aggs.items()})
    return _attached(df, keys, aggs, None, "left")


def keep_groups_any(df: DataFrame, keys: Sequence[str], pred: Column, strategy: str = "join") -> DataFrame:
    """keep whole groups in which any row satisfies ``pred``."""
    if strategy == "window":
        w = Window.partitionBy(*keys)
        d = df.withColumn("__f", F.max(F.coalesce(pred, F.lit(False)).cast("int")).over(w))
        return d.filter(F.col("__f") == 1).drop("__f")
    return _attached(df, keys, {"__n": F.count_if(pred)}, F.col("__n") > 0, "left_semi", rows=pred)


def drop_groups_any(df: DataFrame, keys: Sequence[str], pred: Column, strategy: str = "join") -> DataFrame:
    """``mutate(f = !any(pred)) %>% filter(f)`` — drop groups where any row
    satisfies ``pred``.  R's ``any`` is NA when no row is TRUE but one is NA;
    ``!NA`` is NA and the filter drops it: such groups go as well."""
    bad = F.coalesce(pred, F.lit(True))
    if strategy == "window":
        w = Window.partitionBy(*keys)
        d = df.withColumn("__f", F.max(bad.cast("int")).over(w))
        return d.filter(F.col("__f") == 0).drop("__f")
    return _attached(df, keys, {"__n": F.count_if(bad)}, F.col("__n") > 0, "left_anti", rows=bad)


def keep_groups_single_value(df: DataFrame, keys: Sequence[str], col: str, strategy: str = "join") -> DataFrame:
    """F8: keep groups with exactly one distinct value of ``col`` (NULL is a
    value, as in R's ``n_distinct``).  Uses min/max instead of a distinct
    count, so it stays an algebraic aggregate."""
    c = F.col(col)
    aggs = {"__mn": F.min(c), "__mx": F.max(c), "__nn": F.count(c), "__n": F.count(F.lit(1))}
    ok = (F.col("__mn").eqNullSafe(F.col("__mx"))) & ((F.col("__nn") == 0) | (F.col("__nn") == F.col("__n")))
    if strategy == "window":
        w = Window.partitionBy(*keys)
        d = df.withColumns({k: v.over(w) for k, v in aggs.items()})
        return d.filter(ok).drop(*aggs)
    return _attached(df, keys, aggs, ok, "left_semi")


def keep_groups_exactly_one(df: DataFrame, keys: Sequence[str], pred: Column, strategy: str = "join") -> DataFrame:
    """keep groups with exactly one row satisfying ``pred``
    (``filter(sum(pred, na.rm=T) == 1)``)."""
    if strategy == "window":
        w = Window.partitionBy(*keys)
        d = df.withColumn("__f", F.count_if(pred).over(w))
        return d.filter(F.col("__f") == 1).drop("__f")
    return _attached(df, keys, {"__n": F.count_if(pred)}, F.col("__n") == 1, "left_semi")


def value_of_unique_row(df: DataFrame, keys: Sequence[str], pred: Column, cols: dict[str, str],
                        strategy: str = "join") -> DataFrame:
    """``x[position == 'prefeito']`` — the value of the (unique) matching row
    spread to its group.  Uniqueness comes from F10 upstream."""
    return with_group_values(df, keys, {k: F.max(F.when(pred, F.col(v))) for k, v in cols.items()}, strategy)
