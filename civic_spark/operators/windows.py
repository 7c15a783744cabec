"""Window operators.

Plain ordered windows (``sequence_number``, ``running_sum``, ``lag_lead``) need a
whole group in one task and are kept for groups that are bounded by the domain.
Where a group can be large, ``scan.ordered_scan`` gives the same values from
range-partitioned rows; W2, W9 and W10 below use it.  ``top2_relative_gap`` uses
a partial group limit, W11 / W13 never use an unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import group_places, ordered_scan
from .sorting import order_key


def _w(keys: Sequence[str], order: Sequence = ()) -> Window:
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys])
    return w.orderBy(*[order_key(o) for o in order]) if order else w


def first_row_flag(df: DataFrame, keys: Sequence[str], order: Sequence, name: str = "first_value") -> DataFrame:
    """``if_else(row_number() == 1, 1, 0)`` with an explicit order."""
    out = ordered_scan(df, keys, order, seq={name: 0})
    return out.withColumn(name, (F.col(name) == 1).cast("int"))


def sequence_number(df: DataFrame, keys: Sequence[str], order: Sequence, name: str = "seq",
                    offset: int = 0) -> DataFrame:
    """``row_number() - 1`` (prior terms) when ``offset=-1``."""
    return df.withColumn(name, F.row_number().over(_w(keys, order)) + offset)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence, value: Column, name: str,
                poison: bool = True) -> DataFrame:
    """``cumsum(x)`` in group order.  With ``poison`` a NULL makes this and
    every later value NULL, as R's ``cumsum`` does."""
    w = _w(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = F.sum(value).over(w)
    if poison:
        s = F.when(F.max(value.isNull().cast("int")).over(w) == 0, s)
    return df.withColumn(name, s)


def lag_lead(df: DataFrame, keys: Sequence[str], order: Sequence, cols: dict[str, tuple[str, int]]) -> DataFrame:
    """``{out: (col, k)}``; ``k > 0`` is ``lag(col, k)``, ``k < 0``
    is ``lead(col, -k)``, over an explicit order."""
    w = _w(keys, order)
    return df.withColumns({o: (F.lag(c, k) if k > 0 else F.lead(c, -k)).over(w) for o, (c, k) in cols.items()})


def top2_relative_gap(df: DataFrame, keys: Sequence[str], value: str, order: Sequence, name: str) -> DataFrame:
    """``(v[rn == 1] - v[rn == 2]) / v[rn == 2]`` per group.

    The ``row_number() <= 2`` filter becomes a ``WindowGroupLimit`` that runs
    partially *before* the shuffle: each map task forwards at most two rows
    per group, so even a huge group costs two rows per task."""
    w = _w(keys, order)
    top = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= 2)
    g = top.groupBy(*keys).agg(F.max(F.when(F.col("__rn") == 1, F.col(value))).alias("__v1"),
                               F.max(F.when(F.col("__rn") == 2, F.col(value))).alias("__v2"))
    return g.select(*keys, F.try_divide(F.col("__v1") - F.col("__v2"), F.col("__v2")).alias(name))


def limit_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, k: Column | int, name: str = "place",
                    size: str = "group_size") -> DataFrame:
    """``slice(1:k)`` per group; ``k`` may depend on the data, also on the
    group's size (column ``size``).  Keeps each row's place and the size of
    what is left of its group, so W10 needs no further pass."""
    out = group_places(df, keys, order, name, "__end")
    out = out.withColumn(size, F.col(name) + F.col("__end") - 1).drop("__end")
    limit = k if isinstance(k, Column) else F.lit(k)
    return out.withColumn("__k", limit).filter(F.col(name) <= F.col("__k")).withColumn(size, F.least(size, "__k")).drop("__k")


def last_two_flags(df: DataFrame, keys: Sequence[str] = (), order: Sequence = (), last: str = "last_seat",
                   runner: str = "runner_up", *, place: str | None = None, size: str | None = None) -> DataFrame:
    """``row_number() == n() - 1`` and ``row_number() == n()``, from the
    columns ``place`` and ``size`` where a limit has left them."""
    if place is None:
        out = group_places(df, keys, order, "__rn", "__end")
        return (out.withColumns({last: (F.col("__end") == 2).cast("int"), runner: (F.col("__end") == 1).cast("int")})
                .drop("__rn", "__end"))
    rn, n = F.col(place), F.col(size)
    return df.withColumns({last: (rn == n - 1).cast("int"), runner: (rn == n).cast("int")})


def group_min_boundary(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Per-row minimum of the row's group (``local`` 0/1).  The minima are
    a partial aggregate, one row per group, joined back null-safely: Spark
    broadcasts that table when it measures it small, so the large side is not
    shuffled on a column with few values."""
    from .joins import left_join

    mins = df.groupBy(group).agg(F.min(value).alias(name))
    return left_join(df, mins, group)


def share_within(df: DataFrame, keys: Sequence[str], count_col: str, name: str = "share") -> DataFrame:
    """``n / sum(n)`` within groups of an aggregated table."""
    return df.withColumn(name, F.try_divide(F.col(count_col), F.sum(count_col).over(_w(keys))))


def share_of_total(df: DataFrame, count_col: str, name: str = "pct", scale: float = 100.0) -> DataFrame:
    """``prop.table(n) * 100`` — the grand total is a scalar subquery
    (computed once with partial aggregation), never a window without a
    partition key and never a cross join."""
    tot = df.agg(F.sum(count_col)).scalar()
    return df.withColumn(name, F.try_multiply(F.try_divide(F.col(count_col), tot), F.lit(scale)))
