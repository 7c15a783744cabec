"""Schema-driven column helpers.

All helpers build **one** ``select`` from ``df.schema`` at plan time — never a
chain of ``withColumn`` calls — so the plan stays flat however many columns a
feed has.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import fold_lower

# --- fixed values: text sentinels that mean "missing" in the raw feeds ---
SENTINELS = ("#NE#", "#NULO#", "#nulo", "")
# --- end of fixed values ---


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def map_columns(df: DataFrame, cols: Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply ``fn`` to the named columns in one projection, order preserved."""
    todo = set(cols)
    return df.select(*[(fn(F.col(f"`{c}`")).alias(c) if c in todo else F.col(f"`{c}`")) for c in df.columns])


def map_strings(df: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    """``mutate_if(is.character, fn)``."""
    return map_columns(df, string_columns(df), fn)


def map_matching(df: DataFrame, fn: Callable[[Column], Column], starts: str | None = None,
                 ends: str | None = None, contains: str | None = None, regex: str | None = None) -> DataFrame:
    """P10: ``mutate_at(vars(starts_with/contains(...)), fn)``."""
    return map_columns(df, select_names(df.columns, starts, ends, contains, regex), fn)


def select_names(names: Iterable[str], starts=None, ends=None, contains=None, regex=None) -> list[str]:
    out = []
    for n in names:
        if starts is not None and n.startswith(starts):
            out.append(n)
        elif ends is not None and n.endswith(ends):
            out.append(n)
        elif contains is not None and contains in n:
            out.append(n)
        elif regex is not None and re.search(regex, n):
            out.append(n)
    return out


def drop_matching(df: DataFrame, starts=None, ends=None, contains=None, regex=None) -> DataFrame:
    """P5: ``select(-starts_with(...))`` and friends."""
    return df.drop(*select_names(df.columns, starts, ends, contains, regex))


def names_not_matching(df: DataFrame, regex: str) -> list[str]:
    """keys = every column whose name does not match ``regex``."""
    return [c for c in df.columns if not re.search(regex, c)]


def leading_then_sorted(df: DataFrame, *lead: str) -> DataFrame:
    """Columns alphabetical, then the named leaders first."""
    rest = sorted(c for c in df.columns if c not in lead)
    return df.select(*[F.col(f"`{c}`") for c in (*lead, *rest)])


def rename_with(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """Rename every column by a function (metadata only)."""
    return df.toDF(*[fn(c) for c in df.columns])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """``rename(new = old)`` given as ``{new: old}``."""
    return df.withColumnsRenamed({old: new for new, old in mapping.items()})


def project(df: DataFrame, mapping: dict[str, Column | str]) -> DataFrame:
    """``transmute(new = expr)`` — keeps only the listed outputs."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])


def na_sentinels(df: DataFrame, sentinels: Iterable[str] = SENTINELS, cols: Iterable[str] | None = None) -> DataFrame:
    """table-wide ``t[t == '#NE#' | ...] <- NA`` over text columns."""
    s = list(sentinels)
    target = string_columns(df) if cols is None else list(cols)
    return map_columns(df, target, lambda c: F.when(c.isin(s), F.lit(None).cast("string")).otherwise(c))


def clean_text(df: DataFrame) -> DataFrame:
    """P9 with X1 + X2: fold accents and lower-case every text column."""
    return map_strings(df, fold_lower)


def rotate_when(df: DataFrame, cond: Column, moves: dict[str, str]) -> DataFrame:
    """For rows where ``cond`` holds, column ``new`` takes the value of ``old``
    (``moves = {new: old}``); all moves read the *original* values, as the
    reference's ``filter + rename + rebind`` does, but in a single pass."""
    exprs = []
    for c in df.columns:
        if c in moves:
            exprs.append(F.when(cond, F.col(moves[c])).otherwise(F.col(c)).alias(c))
        else:
            exprs.append(F.col(f"`{c}`"))
    return df.select(*exprs)


def with_constant(df: DataFrame, **values) -> DataFrame:
    """Constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})
