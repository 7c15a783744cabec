"""Ordered values over range-partitioned rows: a segmented prefix scan.

An ordered window holds a whole group in one task.  Here the rows are range partitioned by (keys, order), so a group of
any size lies across as many partitions as its rows need:

1. the sorted rows are written once to the shared folder with their partition and place, which pins the ranges;
2. within a partition a window by (partition, keys) numbers and sums the rows of each group;
3. only a partition's first and last group can go on in its neighbours.  Their totals and edge rows (two per partition)
   are summed along the group, and every partition gets what its first group brings from before and its last group
   still has to come;
4. one join on (partition, keys) adds these carries; both sides hash the same columns.

No task holds more than one partition, whatever the keys.  ``order`` must tell the rows of a group apart; rows that tie
share a partition.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import null_keys
from .sorting import order_key

PART, POS = "__part", "__pos"


def _ranged(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Rows in global order, written with their partition (``__part``) and a number that rises in that order (``__pos``)."""
    spark = df.sparkSession
    by = [order_key(o) for o in [*keys, *order]]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ranged-{uuid.uuid4().hex}"
    ranged = ranged.withColumns({PART: F.spark_partition_id(), POS: F.monotonically_increasing_id()})
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence, *, seq: dict[str, int] | None = None,
                 seq_from_end: dict[str, int] | None = None, sums: dict[str, tuple[Column, bool]] | None = None,
                 shifts: dict[str, tuple[str, int]] | None = None) -> DataFrame:
    """Adds, in ``order`` (names, ``-name`` for descending; NA last) within ``keys`` (none: the whole table):

    * ``seq = {name: offset}``: place in the group, from 1, plus the offset;
    * ``seq_from_end``: the same, counted from the last row;
    * ``sums = {name: (value, poison)}``: running sum; a NULL makes this and every later value NULL with ``poison`` (R's
      ``cumsum``) and counts as 0 without;
    * ``shifts = {name: (column, 1 | -1)}``: the previous (lag) or next (lead) row's value."""
    seq, seq_from_end, sums, shifts = seq or {}, seq_from_end or {}, sums or {}, shifts or {}
    if any(abs(k) != 1 for _, k in shifts.values()):
        raise ValueError("shifts reach one row back or ahead")
    vals = {f"__v{i}": v for i, (v, _) in enumerate(sums.values())}
    wide = df.withColumns({**vals, "__all": F.lit(0)}) if not keys else df.withColumns(vals)
    wide, by = null_keys(wide, list(keys) or ["__all"])
    rows = _ranged(wide, keys, order)

    whole = Window.partitionBy(PART, *by)
    inner = whole.orderBy(POS)
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = {"__rn": F.row_number().over(inner)}
    if seq_from_end:
        cols["__cnt"] = F.count(F.lit(1)).over(whole)
    for v in vals:
        cols[f"{v}_s"] = F.coalesce(F.sum(v).over(upto), F.lit(0))
        cols[f"{v}_n"] = F.count_if(F.col(v).isNull()).over(upto)
    for out, (c, k) in shifts.items():
        cols[out] = (F.lag(c, 1) if k > 0 else F.lead(c, 1)).over(inner)
    leads = any(k < 0 for _, k in shifts.values())
    if leads:
        cols["__more"] = F.lead(F.lit(1), 1).over(inner).isNotNull()
    scanned = rows.withColumns(cols).join(_carries(rows, by, list(vals), sorted({c for c, _ in shifts.values()})), [PART, *by], "left")

    result = {}
    before = lambda c: F.coalesce(F.col(c), F.lit(0))
    for name, offset in seq.items():
        result[name] = (before("__c_before") + F.col("__rn") + offset).cast("long")
    for name, offset in seq_from_end.items():
        result[name] = (before("__c_after") + F.col("__cnt") - F.col("__rn") + 1 + offset).cast("long")
    for (name, (_, poison)), v in zip(sums.items(), vals):
        total = before(f"{v}_before") + F.col(f"{v}_s")
        result[name] = F.when(before(f"{v}_nulls") + F.col(f"{v}_n") == 0, total) if poison else total
    for out, (c, k) in shifts.items():
        edge = F.col("__rn") == 1 if k > 0 else ~F.col("__more")
        result[out] = F.when(edge, F.col("__prev" if k > 0 else "__next")[c]).otherwise(F.col(out))
    new = [c for c in [*seq, *seq_from_end, *sums, *shifts]]
    return scanned.withColumns(result).select(*[c for c in df.columns if c not in new], *new)


def _carries(rows: DataFrame, by: list[str], vals: list[str], srcs: list[str]) -> DataFrame:
    """Per partition and edge group: totals before and after it in the whole group, and the rows next to it.

    Two rows per partition: a group's rows meet only as these, so a group in every partition is still a short list."""
    totals = [F.count(F.lit(1)).alias("__c"), F.min(POS).alias("__first"), F.max(POS).alias("__last")]
    for v in vals:
        totals += [F.coalesce(F.sum(v), F.lit(0)).alias(f"{v}_t"), F.count_if(F.col(v).isNull()).alias(f"{v}_z")]
    part = Window.partitionBy(PART)
    sized = (rows.groupBy(PART, *by).agg(*totals)
             .withColumns({"__head": F.min("__first").over(part), "__tail": F.max("__last").over(part)})
             .filter("__first = __head OR __last = __tail").drop("__head", "__tail"))
    if srcs:
        at = rows.select(POS, F.struct(*srcs).alias("__row"))
        sized = (sized.join(at.select(F.col(POS).alias("__first"), F.col("__row").alias("__first_row")), "__first")
                 .join(at.select(F.col(POS).alias("__last"), F.col("__row").alias("__last_row")), "__last"))
    order = Window.partitionBy(*by).orderBy(PART)
    past, future = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    out = {"__c_before": F.sum("__c").over(past), "__c_after": F.sum("__c").over(future)}
    for v in vals:
        out |= {f"{v}_before": F.sum(f"{v}_t").over(past), f"{v}_nulls": F.sum(f"{v}_z").over(past)}
    if srcs:
        out |= {"__prev": F.lag("__last_row", 1).over(order), "__next": F.lead("__first_row", 1).over(order)}
    return sized.select(PART, *by, *[c.alias(n) for n, c in out.items()])


def with_position(df: DataFrame, *order, name: str = "position") -> DataFrame:
    """O1 / O2: the row's place in the whole table in ``order``, from 1.

    A row's place in its range is known when the ranges are written, so only the sizes of the ranges are summed."""
    rows = _ranged(df, [], order)
    ends = rows.groupBy(PART).agg(F.min(POS).alias("__start"), F.count(F.lit(1)).alias("__size"), F.lit(0).alias("__all"))
    past = Window.partitionBy("__all").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = ends.select(PART, (F.coalesce(F.sum("__size").over(past), F.lit(0)) - F.col("__start") + 1).alias("__off"))
    place = F.col(POS) + F.col("__off")
    return rows.join(offsets, PART).withColumn(name, place).select(*[c for c in df.columns if c != name], name)


def group_places(df: DataFrame, keys: Sequence[str], order: Sequence, first: str = "place",
                 last: str = "place_from_end") -> DataFrame:
    """Every row's place in its group from both ends; their sum less 1 is the group's size."""
    return ordered_scan(df, keys, order, seq={first: 0}, seq_from_end={last: 0})
