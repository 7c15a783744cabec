"""Sorting, top-k and sampling (O1–O5) with R's ordering rules.

R's ``arrange`` puts NA last in both directions; Spark's ascending default
puts NULL first, so every key is turned into ``asc_nulls_last`` /
``desc_nulls_last`` explicitly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_key(o) -> Column:
    """Column name / ``F.desc(...)`` / Column → an NA-last sort expression.

    Plain names sort ascending; pass ``'-name'`` for descending.  A Column is
    used as given (build it with ``asc`` / ``desc`` below for NA-last)."""
    if isinstance(o, str):
        if o.startswith("-"):
            return F.col(f"`{o[1:]}`").desc_nulls_last()
        return F.col(f"`{o}`").asc_nulls_last()
    return o


def asc(c) -> Column:
    """Ascending, NA last (R)."""
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def desc(c) -> Column:
    """Descending, NA last (R)."""
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_last()


def arrange(df: DataFrame, *order, position: str | None = None) -> DataFrame:
    """O1 / O2: global multi-key sort, NA last (range-partitioned by Spark).

    ``position`` adds each row's place in that order, from 1, numbered across
    the ranges; ``order`` must then tell all rows apart."""
    if position is None:
        return df.orderBy(*[order_key(o) for o in order])
    from .scan import with_position

    return with_position(df, *order, name=position).orderBy(position)


def arrange_within(df: DataFrame, keys: Sequence[str], *order, position: str | None = None) -> DataFrame:
    """O3: rows of a group next to each other and sorted.  Rows are dealt by
    ranges of (keys, order), so a large group takes several tasks.
    ``position`` adds each row's place in its group, from 1."""
    by = [order_key(o) for o in [*keys, *order]]
    if position is None:
        return df.orderBy(*by)
    from .scan import ordered_scan

    return ordered_scan(df, keys, order, seq={position: 0}).orderBy(*[order_key(k) for k in keys], position)


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """``arrange(...) %>% slice(1:k)`` → ``TakeOrderedAndProject`` (each
    task keeps its k best rows; only k × tasks rows reach the final merge)."""
    return df.orderBy(*[order_key(o) for o in order]).limit(k)


def _draw(key_cols: Sequence[str], seed: int) -> Column:
    """52 hash bits of a row's key: the first 13 hex digits of an md5 over seed and key, which any SQL engine can repeat."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in key_cols])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")


def sample_exact(df: DataFrame, fraction: float, key_cols: Sequence[str], seed: int = 0) -> DataFrame:
    """Exactly ``round(fraction * n)`` rows (half to even, as R rounds), those with the least hash of their key.

    No sort of the table: counts by the leading 13 hash bits tell the cell that holds the cut, and each further 13 bits
    are counted in that cell alone, so a level brings at most 8,192 counts to the driver.  Rows that tie at the cut (one
    key repeated) are taken in the order of their columns."""
    cell, levels = 13, 4
    d = df.withColumn("__draw", _draw(key_cols, seed))
    total = df.count()
    need, low = round(fraction * total), 0
    if need >= total:
        return df
    if need <= 0:
        return df.limit(0)
    for level in range(levels):
        shift = cell * (levels - 1 - level)
        inside = d if level == 0 else d.filter((F.col("__draw") >= low) & (F.col("__draw") < low + (1 << (shift + cell))))
        counts = sorted(inside.groupBy(F.shiftright(F.col("__draw") - low, shift).alias("c")).count().collect())
        for c, n in counts:
            if need <= n:
                low += c << shift
                break
            need -= n
        if need == n:                                        # the cut falls between two cells
            return d.filter(F.col("__draw") < low + (1 << shift)).drop("__draw")
    ties = d.filter(F.col("__draw") == low).orderBy(*key_cols, F.xxhash64(*df.columns)).limit(need)
    return d.filter(F.col("__draw") < low).unionByName(ties).drop("__draw")


def hash_sample(df: DataFrame, fraction: float, key_cols: Sequence[str], seed: int = 0) -> DataFrame:
    """O5, deterministic: keep rows whose key hash falls under ``fraction``.

    Independent of partitioning and re-execution (a lost task recomputes the
    same rows).  The draw is the first 52 bits of an md5 over seed and key, so
    any fraction down to 2^-52 is exact and any SQL engine can repeat it."""
    return df.filter(_draw(key_cols, seed) < int(fraction * (1 << 52)))
