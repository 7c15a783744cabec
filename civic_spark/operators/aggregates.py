"""Aggregate operators.

Every aggregate here is an algebraic / declarative Spark aggregate, so Spark
plans a partial (map-side) aggregation before the shuffle: a hot group key
(one municipality or party holding a third of the rows) is collapsed to one
row per map task before it reaches the reducer.

R semantics reproduced:
* ``sum(x)`` poisons on NA (A1) — ``sum_poison``; ``sum(x, na.rm=T)`` is 0 on
  an empty / all-NA group (A2) — ``sum_skip``.
* ``mean``/``sd`` of an empty selection is NaN in R; here NULL (engine policy).
* ``n_distinct`` counts NA as a value (A7).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._col import as_col
from .sorting import order_key


# ---------------------------------------------------------------- expressions

def sum_poison(c) -> Column:
    """A1: group sum that is NULL when any input is NULL (R ``sum``)."""
    col = as_col(c)
    return F.when(F.count(F.lit(1)) == F.count(col), F.sum(col))


def sum_skip(c) -> Column:
    """A2: group sum skipping NULL; empty / all-NULL group gives 0."""
    col = as_col(c)
    return F.coalesce(F.sum(col), F.lit(0))


def n_distinct(c, few: bool = False) -> Column:
    """Distinct count where NULL counts as one value (R ``n_distinct``).

    ``few``: the domain of ``c`` is small (a flag, a code), so its values are
    kept as a set in the one aggregate; otherwise Spark plans a second one."""
    col = as_col(c)
    n = F.size(F.collect_set(col)) if few else F.count_distinct(col)
    return n + F.max(col.isNull().cast("int"))


def count_if(p: Column, poison: bool = False) -> Column:
    """Conditional count.  ``poison=True`` reproduces R's ``sum(p)`` without
    ``na.rm``: any NULL predicate makes the result NULL."""
    n = F.count_if(p)
    if poison:
        return F.when(F.count(F.lit(1)) == F.count(p), n)
    return n


def share_if(p: Column, q: Column | None = None, poison: bool = True) -> Column:
    """``sum(p) / sum(q)`` (``q`` defaults to all rows); empty → NULL."""
    den = F.count(F.lit(1)) if q is None else count_if(q, poison)
    return F.try_divide(count_if(p, poison), den)


def sum_if(x, p: Column) -> Column:
    """``sum(x[p], na.rm=T)`` (0 on an empty selection)."""
    return F.coalesce(F.sum(F.when(p, as_col(x))), F.lit(0))


def mean_if(x, p: Column) -> Column:
    """A10: ``mean(x[p], na.rm=T)``; empty selection → NULL."""
    return F.avg(F.when(p, as_col(x)))


def sd_if(x, p: Column) -> Column:
    """``sd(x[p], na.rm=T)``; fewer than two values → NULL."""
    return F.stddev_samp(F.when(p, as_col(x)))


def any_(p: Column) -> Column:
    """``any(p)`` — true if any true; NULL only when no true and some NULL."""
    return F.bool_or(p)


def string_agg_sorted(c, sep: str = " / ", poison: bool = True, distinct: bool = False) -> Column:
    """``stri_c(x, collapse=sep)`` with a stable (sorted) order; NULL when
    any element is NULL (``poison``) as in R.  Group sizes are small (parties
    of one coalition), so the collected list is bounded."""
    col = as_col(c)
    txt = F.array_join(F.array_sort(F.collect_set(col) if distinct else F.collect_list(col)), sep)
    if poison:
        return F.when(F.count(F.lit(1)) == F.count(col), txt)
    return txt


def string_agg_sorted_over(c, w, sep: str = " / ", poison: bool = True) -> Column:
    """A13 as a window value: every row gets its group's sorted member list."""
    col = as_col(c)
    txt = F.array_join(F.array_sort(F.collect_list(col).over(w)), sep)
    if poison:
        return F.when(F.count(F.lit(1)).over(w) == F.count(col).over(w), txt)
    return txt


def proportion(p: Column) -> Column:
    """``mean(p)`` of a logical (NULL p skipped like SQL avg)."""
    return F.avg(p.cast("int"))


def pct_ratio(a: Column, b: Column) -> Column:
    """``sum(a & b) / sum(b) * 100``."""
    return F.try_multiply(F.try_divide(F.count_if(a & b), F.count_if(b)), F.lit(100.0))


def quota(votes, seats) -> Column:
    """Electoral quota ``sum(votes) / mean(seats)``."""
    return F.try_divide(F.sum(as_col(votes)), F.avg(as_col(seats)))


# ---------------------------------------------------------------- DataFrame ops

def group_agg(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """A3: ``group_by_at(keys) %>% summarise(...)`` with named outputs."""
    return df.groupBy(*keys).agg(*[v.alias(k) for k, v in aggs.items()])


def collapse_sum(df: DataFrame, measures: Sequence[str], keys: Sequence[str] | None = None,
                 *, poison: bool = True, drop: Sequence[str] = ()) -> DataFrame:
    """Sum ``measures`` over every other column (minus ``drop``),
    e.g. collapsing electoral zones.  ``poison`` selects R's ``sum`` vs
    ``sum(na.rm=T)``."""
    if keys is None:
        keys = [c for c in df.columns if c not in measures and c not in drop]
    fn = sum_poison if poison else sum_skip
    return df.groupBy(*keys).agg(*[fn(m).alias(m) for m in measures])


def sum_all(df: DataFrame, keys: Sequence[str], na_rm: bool = True) -> DataFrame:
    """A4: ``summarise_all(sum, na.rm=T)`` over every non-key column."""
    fn = sum_skip if na_rm else sum_poison
    return df.groupBy(*keys).agg(*[fn(c).alias(c) for c in df.columns if c not in keys])


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n", sort: bool = False) -> DataFrame:
    """``count(keys, sort=)``."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    if sort:
        from .sorting import arrange
        out = arrange(out, "-" + name, *keys)
    return out


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """``distinct(keys, .keep_all=TRUE)`` with an explicit order.

    The order is made total by appending every remaining column, so the
    result does not depend on file or partition order.  Planned as a
    partial ``WindowGroupLimit`` before the shuffle, i.e. a hot key sends at
    most one row per map task to the reducer."""
    from pyspark.sql import Window

    named = {o.lstrip("-") for o in order if isinstance(o, str)}
    rest = [c for c in df.columns if c not in keys and c not in named]
    ocols = [order_key(o) for o in order] + [order_key(c) for c in rest]
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*ocols)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``distinct(cols)`` (hash aggregate with map-side combine)."""
    return (df if cols is None else df.select(*cols)).distinct()


def having_count(df: DataFrame, keys: Sequence[str], op: str, threshold: int | Column, name: str = "n") -> DataFrame:
    """Group counts filtered by a threshold (``count %>% filter(n < k)``)."""
    n = F.col(name)
    cond = {"<": n < threshold, "<=": n <= threshold, ">": n > threshold, ">=": n >= threshold,
            "==": n == threshold}[op]
    return count_by(df, keys, name).filter(cond)


def reaggregate_duplicates(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
                           fill_first: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """A18 (+ A14): within ``keys``, missing ``fill_first`` attributes take the
    group's first non-NULL value (in ``order``, then value); rows that then
    agree in keys and attributes are summed into one.  Rows of a group with
    different attributes stay apart.  Other columns come from the first row.

    The fill values are one partial aggregate per group, attached by a
    null-safe join; the sum needs no further exchange, as it is grouped by the
    same keys and more."""
    from .groups import with_group_values

    others = [c for c in df.columns if c not in keys and c not in measures and c not in fill_first]
    if fill_first:
        first = {f"__f{i}": F.min(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("__v")))) for i, c in enumerate(fill_first)}
        df = with_group_values(df, keys, first)
        df = df.withColumns({c: F.coalesce(F.col(c), F.col(f"__f{i}")["__v"]) for i, c in enumerate(fill_first)}).drop(*first)
    aggs = [sum_poison(m).alias(m) for m in measures]
    if others:
        aggs.append(F.min(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                                   *[F.col(c).alias(f"__{c}") for c in others])).alias("__one"))
    out = df.groupBy(*keys, *fill_first).agg(*aggs)
    out = out.withColumns({c: F.col("__one")[f"__{c}"] for c in others})
    return out.select(*keys, *[c for c in (*measures, *fill_first, *others)])


def effective_number(df: DataFrame, group: Sequence[str], member: str, weight: Column | None = None,
                     name: str = "effective_number") -> DataFrame:
    """Effective number of members per group, ``1 / Σ share²``.

    Two-level aggregation (member totals, then group sum of squared shares):
    both levels combine map-side, so a hot group costs one row per task."""
    w = F.lit(1) if weight is None else weight
    per = df.groupBy(*group, member).agg(F.sum(w).alias("__w"))
    tot = per.groupBy(*group).agg(F.sum("__w").alias("__tot"), F.sum(F.col("__w") * F.col("__w")).alias("__sq"))
    return tot.select(*group, F.try_divide(F.col("__tot") * F.col("__tot"), F.col("__sq")).alias(name))


def flagged_difference(df: DataFrame, keys: Sequence[str], value: str, first_flag: Column,
                       second_flag: Column, name: str = "difference") -> DataFrame:
    """``x[first] - x[second]`` per group; NULL when either row is absent."""
    return df.groupBy(*keys).agg(
        (F.max(F.when(first_flag, F.col(value))) - F.max(F.when(second_flag, F.col(value)))).alias(name))


def split_summary(df: DataFrame, keys: Sequence[str], side: Column, side_name: str,
                  aggs: dict[str, Column]) -> DataFrame:
    """One summary per side of a split (e.g. government / opposition),
    done as a single ``groupBy(keys + side)`` instead of two passes + union."""
    return df.withColumn(side_name, side).groupBy(*keys, side_name).agg(*[v.alias(k) for k, v in aggs.items()])
