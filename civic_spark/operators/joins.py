"""Join operators.

R's ``left_join`` matches NA to NA; SQL ``=`` does not.  ``left_join`` therefore
defaults to ``null_safe=True``.  A nullable key is compared as two plain
columns, its value with a stand-in for NULL and a NULL flag (``null_keys``), so
the join is an ordinary equi-join and shares its partitioning with aggregates
and windows on the same columns.  The lagged self-join (J9) came from SQL in
the reference and keeps ``=``.

No join carries a broadcast hint: Spark broadcasts a side from file statistics
or, at run time, from its measured size, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_keys(df: DataFrame, keys: Sequence[str], prefix: str = "__nk") -> tuple[DataFrame, list[str]]:
    """Adds plain columns that are equal exactly where ``keys`` are equal or both NULL.

    A nullable key gives two columns: its value with a stand-in for NULL, and
    a flag.  Returns the frame and the names of the added columns."""
    cols: dict[str, Column] = {}
    for i, k in enumerate(keys):
        c, field = F.col(f"`{k}`"), _field(df, k)
        if field is not None and not field.nullable:
            cols[f"{prefix}{i}"] = c
            continue
        stand_in = _stand_in(field.dataType if field is not None else T.StringType())
        if stand_in is None:
            raise TypeError(f"{k}: no null-safe key for {field.dataType}")
        cols[f"{prefix}{i}"] = F.coalesce(c, stand_in)
        cols[f"{prefix}{i}n"] = c.isNull()
    return df.withColumns(cols), list(cols)


def _field(df: DataFrame, name: str) -> T.StructField | None:
    return next((f for f in df.schema.fields if f.name == name), None)


def _stand_in(kind: T.DataType) -> Column | None:
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.lit(0).cast(kind)
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.lit("1970-01-01").cast(kind)
    return None


def _key_list(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def left_join(left: DataFrame, right: DataFrame, on, right_on=None, *, null_safe: bool = True,
              how: str = "left", right_prefix: str | None = None) -> DataFrame:
    """J1–J3 (and any equi-join): join on ``on`` (left names) = ``right_on``.

    Output columns: all left columns, then the right non-key columns
    (optionally prefixed: J4 role prefixes, J5 collision handling).
    ``how`` may be any Spark join type; semi / anti return left columns only.
    Keys whose type has no NULL stand-in (arrays, structs) are compared with
    ``<=>``.
    """
    lkeys = _key_list(on)
    rkeys = lkeys if right_on is None else _key_list(right_on)
    if len(lkeys) != len(rkeys):
        raise ValueError("key lists differ in length")
    rest = [c for c in right.columns if c not in rkeys]
    semi = how in ("left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti")
    clash = sorted({f"{right_prefix}{c}" if right_prefix else c for c in rest} & set(left.columns))
    if clash and not semi:
        raise ValueError(f"right columns {clash} already exist on the left; pass right_prefix or drop them")
    tmp = [f"__rk{i}" for i in range(len(rkeys))]
    sel = [F.col(f"`{k}`").alias(t) for k, t in zip(rkeys, tmp)]
    sel += [F.col(f"`{c}`").alias(f"{right_prefix}{c}" if right_prefix else c) for c in rest]
    r = right.select(*sel)
    conds, lnew, rnew = [], {}, {}
    for i, (lk, t) in enumerate(zip(lkeys, tmp)):
        lf, rf, c = _field(left, lk), _field(r, t), left[f"`{lk}`"]
        nullable = null_safe and (lf.nullable or rf.nullable)
        a, b = (_stand_in(f.dataType) for f in (lf, rf))
        if not nullable:
            conds.append(c == r[t])
        elif a is None or b is None or lf.dataType != rf.dataType:
            conds.append(c.eqNullSafe(r[t]))
        else:
            lnew |= {f"__lv{i}": F.coalesce(F.col(f"`{lk}`"), a), f"__ln{i}": F.col(f"`{lk}`").isNull()}
            rnew |= {f"__rv{i}": F.coalesce(F.col(t), b), f"__rn{i}": F.col(t).isNull()}
            conds += [F.col(f"__lv{i}") == F.col(f"__rv{i}"), F.col(f"__ln{i}") == F.col(f"__rn{i}")]
    if lnew:
        left, r = left.withColumns(lnew), r.withColumns(rnew)
    out = left.join(r, conds, how)
    return out.drop(*lnew) if semi else out.drop(*tmp, *lnew, *rnew)


def right_join(left: DataFrame, right: DataFrame, on, *, null_safe: bool = True) -> DataFrame:
    """``right_join`` written as a left join with the sides swapped."""
    return left_join(right, left, on, null_safe=null_safe)


#: Shares of a wide key, so that a table with few wide keys still spreads over many tasks.
WIDE_SHARES = 32


def two_tier_lookup(df: DataFrame, lookup: DataFrame, local_keys: Sequence[str], wide_keys: Sequence[str],
                    fill: dict[str, str], choose_wide: Column, *, dedupe_order: Sequence[str] | None = None) -> DataFrame:
    """Fill ``fill`` columns from ``lookup`` on the local key, or on the key
    without the municipality, choosing the wide match where ``choose_wide``.

    ``fill = {target_column: lookup_column}``.  Original non-NULL values win
    (``coalesce(original, chosen)``).  A row's tier is known before the join,
    so both lookups are one table keyed by tier and key, met in one join: the
    rows are shuffled once.  Wide keys can be few (a party, a type), so wide
    rows are dealt over ``WIDE_SHARES`` shares and the wide lookup, which is
    small, is repeated in each.  The lookup keeps its first row per key (A15),
    so the join cannot fan out; that shares the join's partitioning."""
    from .aggregates import keep_first

    vals = list(dict.fromkeys(fill.values()))
    order = list(dedupe_order or vals)
    only_local = [k for k in local_keys if k not in wide_keys]
    tier, share = "__tier", "__share"

    def keyed(d: DataFrame, wide: Column) -> tuple[DataFrame, list[str]]:
        """Key columns that are never NULL; a wide row's are the same whatever its local-only keys."""
        cols = {}
        for i, k in enumerate(local_keys):
            value = F.when(~wide, F.col(f"`{k}`")) if k in only_local else F.col(f"`{k}`")
            cols[f"__k{i}"] = F.coalesce(value, _stand_in(d.schema[k].dataType))
            cols[f"__k{i}n"] = value.isNull()
        return d.withColumns(cols), [tier, share, *cols]

    local = lookup.withColumns({tier: F.lit(0), share: F.lit(0)})
    shares = lookup.withColumn(tier, F.lit(1)).withColumn(share, F.explode(F.sequence(F.lit(0), F.lit(WIDE_SHARES - 1))))
    table, on = keyed(local.unionByName(shares), F.col(tier) == 1)
    table = keep_first(table, on, order).select(*on, *[F.col(v).alias(f"__val_{v}") for v in vals])

    wide = F.coalesce(choose_wide, F.lit(False))
    rows = df.withColumns({tier: wide.cast("int"), share: F.when(wide, F.pmod(F.xxhash64(*df.columns), F.lit(WIDE_SHARES)).cast("int")).otherwise(0)})
    rows, on = keyed(rows, F.col(tier) == 1)
    out = rows.join(table, on, "left")
    filled = {t: F.coalesce(F.col(t) if t in df.columns else F.lit(None), F.col(f"__val_{v}")) for t, v in fill.items()}
    return out.withColumns(filled).drop(*on, *[f"__val_{v}" for v in vals])


def split_join_union(df: DataFrame, branches: Iterable[tuple[Column, DataFrame, Sequence[str]]], *,
                     null_safe: bool = True) -> DataFrame:
    """Split rows by a predicate, join each part on its own key, rebind.

    Each branch is ``(predicate, right, keys)``; the union is by name with
    missing columns filled.  Rows matching no predicate are dropped, as in
    the reference's three filters."""
    parts = [left_join(df.filter(p), r, list(k), null_safe=null_safe) for p, r, k in branches]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def lagged_self_join(df: DataFrame, right: DataFrame, keys: Sequence[str], year: str, lag: int,
                     take: dict[str, str]) -> DataFrame:
    """Attach columns of the same entity ``lag`` years earlier.

    ``take = {output_name: right_column}``.  Plain ``=`` (SQL rule: NULL keys
    never match).  Years are compared as integers on both sides."""
    r = right.select(F.col(year).try_cast("int").alias("__ry"), *[F.col(k).alias(f"__rk_{k}") for k in keys],
                     *[F.col(src).alias(out) for out, src in take.items()])
    cond = [(F.col(year).try_cast("int") - lag) == F.col("__ry")]
    cond += [F.col(k) == F.col(f"__rk_{k}") for k in keys]
    return df.join(r, cond, "left").drop("__ry", *[f"__rk_{k}" for k in keys])


def exclude_values_in(df: DataFrame, values: DataFrame, on, values_on=None) -> DataFrame:
    """Drop rows whose key appears in a derived set, with R's ``%in%``
    rule: NULL keys are kept unless the set holds a NULL (a null-safe
    ``left_anti`` join)."""
    return left_join(df, values.distinct(), on, values_on, how="left_anti", null_safe=True)


def value_list(values: DataFrame, column: str) -> Column:
    """The distinct values of a domain column (states, parties) as a sorted
    array, delivered as a scalar subquery: a partial aggregate, no eager job.
    For lists that every matching row is copied over, so their length is the
    factor by which the result grows."""
    return values.agg(F.array_sort(F.collect_set(column))).scalar()


def fan_out(df: DataFrame, key: str, value, targets: DataFrame) -> DataFrame:
    """Rows with ``key == value`` (e.g. national ``br``) are copied once per
    target value (one column, e.g. the 27 states); other rows pass through.

    The target list arrives as a scalar subquery and the matching rows explode
    over it: no join, and only the matching rows grow."""
    arr = value_list(targets, targets.columns[0])
    hit = df.filter(F.col(key) == value).withColumn(key, F.explode(arr))
    keep = df.filter(~F.coalesce(F.col(key) == value, F.lit(False)))
    return keep.unionByName(hit.select(*df.columns))


def dedupe_then_join(left: DataFrame, right: DataFrame, on, order: Sequence[str], **kw) -> DataFrame:
    """Keep one right row per key (first in ``order``) so the join is 1:1."""
    from .aggregates import keep_first

    keys = _key_list(kw.get("right_on") or on)
    return left_join(left, keep_first(right, keys, order), on, **kw)


def shifted_key_join(left: DataFrame, right: DataFrame, on: Sequence[str], year: str, shift: int,
                     **kw) -> DataFrame:
    """Join ``left.year`` with ``right.year + shift`` (e.g. a state election
    in y against the municipal one in y − 2)."""
    r = right.withColumn(year, F.col(year) + shift)
    return left_join(left, r, [*on, year], **kw)
