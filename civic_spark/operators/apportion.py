"""Proportional-seat quotients: last seat vs runner-up (D8 core; A20 X14 W9 W10 A24).

Given one row per (place, list) with the list's votes, the number of seats of
the place and a side flag (government / opposition), compute per place:

* quotient rows ``votes / d`` for ``d = 1 .. seats`` (only lists that reached
  the quota, as the reference filters before expanding),
* the first ``seats + 1`` rows in the chosen order,
* the last seat (next-to-last retained row) and the runner-up (last row),
* ``flip``: 1 when last seat and runner-up are on different sides,
* ``quotient_margin = (q_last - q_runner) / total`` where ``total`` sums the
  list votes over the retained rows (Q6: a list counts once per retained row).

Order (Q5): the reference sorts by divisor first, then quotient descending —
``order='round_first'`` (default, kept); ``order='highest_average'`` sorts by
quotient only (D'Hondt order).  Ties are broken by list name, then side.

Scale: nothing is expanded by the number of seats.  By divisor, the retained
rows are whole rounds of the ranked lists and one part of a round, so the last
two are found by arithmetic.  By highest average, every quotient of at least
(sum of votes) / seats is among the first ``seats``, so only the next ``lists +
1`` divisors of each list are laid out.  A place's window holds its lists (at
most ``lists * (lists + 1)`` rows), whatever its seats.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quotient_rows(df: DataFrame, seats: str, votes: str, name: str = "divisor") -> DataFrame:
    """One row per divisor ``1..seats`` with its quotient ``votes / divisor``; no row without a seat."""
    n = F.col(seats).cast("int")
    divisors = F.when(n >= 1, F.sequence(F.lit(1), F.greatest(n, F.lit(1))))
    return df.withColumn(name, F.explode(divisors)).withColumn("quotient", F.col(votes) / F.col(name))


def marginal_seat(df: DataFrame, place: Sequence[str], list_col: str, votes: str, seats: str, side: str,
                  quota: str | None = None, order: str = "round_first") -> DataFrame:
    """Per place: ``flip``, ``quotient_margin``, ``total_vote``, ``n_rows``.

    Places whose retained rows are fewer than two have no next-to-last row:
    the reference yields an empty summary there (Q26); such places are kept
    only when ``n_rows >= 2``."""
    d = df if quota is None else df.filter(F.col(votes) >= F.col(quota))
    d = d.select(*place, F.col(list_col).alias("__l"), F.col(votes).alias("__v"), F.col(seats).cast("int").alias("__s"),
                 F.col(side).alias("__side")).filter(F.col("__s") >= 1)
    if order not in ("round_first", "highest_average"):
        raise ValueError(order)
    g = _by_round(d, place) if order == "round_first" else _by_average(d, place)
    sl, sr = F.col("__sl"), F.col("__sr")
    return g.filter(F.col("n_rows") >= 2).select(
        *place,
        F.when(sl != sr, 1).when(sl == sr, 0).alias("mayor_opposition_flip"),
        F.try_divide(F.col("__ql") - F.col("__qr"), F.col("total_vote")).alias("quotient_margin"),
        F.col("total_vote"),
        F.col("n_rows").cast("long").alias("n_rows"),
    )


def _by_round(d: DataFrame, place: Sequence[str]) -> DataFrame:
    whole = Window.partitionBy(*place)
    ranked = whole.orderBy(F.col("__v").desc_nulls_last(), F.col("__l").asc_nulls_last(), F.col("__side").asc_nulls_last())
    lists = F.count(F.lit(1)).over(whole)
    d = d.withColumns({"__i": F.row_number().over(ranked) - 1, "__m": lists,
                       "__n": F.least(F.col("__s") + 1, lists * F.col("__s"))})

    def pick(row: Column) -> tuple[Column, Column]:
        """Quotient and side of the given retained row (from 1)."""
        here = F.col("__i") == (row - 1) % F.col("__m")
        divisor = F.floor((row - 1) / F.col("__m")) + 1
        return F.max(F.when(here, F.try_divide(F.col("__v"), divisor.cast("int")))), F.max(F.when(here, F.col("__side")))

    (ql, sl), (qr, sr) = pick(F.col("__n") - 1), pick(F.col("__n"))
    times = F.floor(F.col("__n") / F.col("__m")) + (F.col("__i") < F.col("__n") % F.col("__m")).cast("int")
    return d.groupBy(*place).agg(F.max("__n").alias("n_rows"), F.sum(F.when(times > 0, F.col("__v") * times)).alias("total_vote"),
                                 ql.alias("__ql"), qr.alias("__qr"), sl.alias("__sl"), sr.alias("__sr"))


def _by_average(d: DataFrame, place: Sequence[str]) -> DataFrame:
    whole = Window.partitionBy(*place)
    # Without votes all quotients are equal and divisors decide, as if all lists had the same.
    weight = F.when(F.sum("__v").over(whole) > 0, F.col("__v")).otherwise(F.lit(1))
    d = d.withColumn("__w", weight)
    sure = F.coalesce(F.floor(F.try_divide(F.col("__w") * F.col("__s"), F.sum("__w").over(whole))), F.lit(0))
    d = d.withColumns({"__sure": F.least(sure, F.col("__s")).cast("int"), "__m": F.count(F.lit(1)).over(whole)})
    d = d.withColumn("__before", F.sum("__sure").over(whole))
    held = d.groupBy(*place).agg(F.sum(F.when(F.col("__sure") > 0, F.col("__v") * F.col("__sure"))).alias("__held"))
    # Two sure divisors are laid out as well: the last retained rows may be sure ones.
    first = F.greatest(F.col("__sure") - 1, F.lit(1))
    last = F.least(F.col("__sure") + F.col("__m") + 1, F.col("__s"))
    rows = d.filter(first <= last).withColumn("__d", F.explode(F.sequence(first, last)))
    rows = rows.withColumn("__q", F.try_divide(F.col("__v"), F.col("__d")))
    laid = F.count_if(F.col("__d") <= F.col("__sure")).over(whole)
    ranked = whole.orderBy(F.col("__q").desc_nulls_last(), F.col("__d").asc(), F.col("__l").asc_nulls_last(), F.col("__side").asc_nulls_last())
    rows = rows.withColumns({"__rn": F.row_number().over(ranked) + F.col("__before") - laid, "__laid": laid})
    rows = rows.filter(F.col("__rn") <= F.col("__s") + 1).withColumn("__n", F.max("__rn").over(whole))
    is_last, is_run = F.col("__rn") == F.col("__n") - 1, F.col("__rn") == F.col("__n")
    extra = F.sum(F.when(F.col("__d") > F.col("__sure"), F.col("__v")))
    g = rows.groupBy(*place).agg(
        F.max("__n").alias("n_rows"), extra.alias("__extra"),
        F.max(F.when(is_last, F.col("__q"))).alias("__ql"), F.max(F.when(is_run, F.col("__q"))).alias("__qr"),
        F.max(F.when(is_last, F.col("__side"))).alias("__sl"), F.max(F.when(is_run, F.col("__side"))).alias("__sr"))
    total = F.when(F.col("__held").isNull(), F.col("__extra")).otherwise(F.col("__held") + F.coalesce("__extra", F.lit(0)))
    return g.join(held, list(place)).withColumn("total_vote", total)
