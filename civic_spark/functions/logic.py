"""Conditional, null and numeric expressions with R's semantics.

R and SQL disagree on NULL in five places; each has one helper here:

* ``if_else(p, a, b)``: NULL condition → NULL (``otherwise`` would pick ``b``).
* ``case_when``: NULL condition falls through (same as SQL ``CASE``).
* ``not_in``: ``!(x %in% s)`` keeps NULL x (SQL ``NOT IN`` drops it).
* poisoning sums live in ``operators.aggregates``.
* NA-last ordering lives in ``operators.sorting``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import as_col


def lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def case_when(*branches, default=None) -> Column:
    """``case_when(c1 ~ v1, c2 ~ v2, TRUE ~ default)``."""
    if not branches:
        raise ValueError("case_when needs at least one branch")
    cond, val = branches[0]
    out = F.when(cond, lit_or_col(val))
    for cond, val in branches[1:]:
        out = out.when(cond, lit_or_col(val))
    if default is not None:
        out = out.otherwise(lit_or_col(default))
    return out


def if_else(cond: Column, yes, no) -> Column:
    """Two-branch conditional where a NULL condition yields NULL."""
    return F.when(cond, lit_or_col(yes)).when(~cond, lit_or_col(no))


def flag(cond: Column) -> Column:
    """``if_else(cond, 1, 0)`` as an int flag (NULL when cond is NULL)."""
    return if_else(cond, 1, 0)


def cycle_flag(year, modulus: int = 4, remainder: int = 0) -> Column:
    """1 when ``year %% modulus == remainder`` (local election years)."""
    y = as_col(year).try_cast("int")
    return if_else(y % modulus == remainder, 1, 0)


def empty_to(c, other) -> Column:
    """``if_else(c == '', other, c)`` (a NULL ``c`` stays NULL)."""
    col = as_col(c)
    return if_else(col == "", as_col(other), col)


def try_int(c) -> Column:
    """Cast to int; bad text → NULL (R's ``as.integer`` gives NA)."""
    return as_col(c).try_cast("int")


def try_long(c) -> Column:
    return as_col(c).try_cast("long")


def decimal_comma(c, precision: int = 18, scale: int = 2) -> Column:
    """``'1.234,50'``-style or ``'1,50'`` text → decimal; bad → NULL."""
    txt = F.regexp_replace(as_col(c).cast("string"), ",", ".")
    return txt.try_cast(f"decimal({precision},{scale})")


def pmax(*cols) -> Column:
    """Row-wise max ignoring NULL (``pmax(..., na.rm=TRUE)``)."""
    return F.greatest(*[as_col(c) for c in cols])


def replace_na(c, value) -> Column:
    """NULL default."""
    return F.coalesce(as_col(c), lit_or_col(value))


def is_na(c) -> Column:
    """X20."""
    return as_col(c).isNull()


def sentinel_to_null(c, value) -> Column:
    """``ifelse(x == -1, NA, x)``."""
    return F.nullif(as_col(c), lit_or_col(value))


def not_in(c, values) -> Column:
    """``!(x %in% values)`` — a NULL ``x`` is *kept* (R semantics)."""
    return ~F.coalesce(as_col(c).isin(list(values)), F.lit(False))


def in_seq(c, start: int, stop: int, step: int) -> Column:
    """membership in an arithmetic sequence (``x %in% seq(a, b, s)``)."""
    return as_col(c).isin(list(range(start, stop + 1, step)))


def parse_dmy(c) -> Column:
    """Day-first date text → date; accepts ``/``, ``-`` and ``.``; bad → NULL."""
    txt = F.regexp_replace(as_col(c), "[-.]", "/")
    return F.try_to_date(txt, "d/M/yyyy")
