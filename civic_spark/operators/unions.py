"""Set operators (U1–U4): union by name with missing columns filled."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T


def bind_rows(*dfs: DataFrame) -> DataFrame:
    """``bind_rows`` / ``rbindlist(fill=TRUE)``.

    Column types must agree before a union (a string/int clash raises under
    ANSI); ``cast_to`` harmonises them first."""
    items = [d for d in dfs if d is not None]
    out = items[0]
    for d in items[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def bind_all(dfs: Iterable[DataFrame]) -> DataFrame:
    return bind_rows(*list(dfs))


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns present in ``schema`` to its types (try_cast), keeping others."""
    types = {f.name: f.dataType for f in schema.fields}
    from pyspark.sql import functions as F
    return df.select(*[(F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`"))
                       for c in df.columns])


def split_repair_union(df: DataFrame, pred: Column, repair: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """U4: ``filter(!p) %>% bind_rows(filter(p) %>% repair)`` — used only where
    the repair must aggregate; a per-row repair should be one ``when`` pass."""
    from pyspark.sql import functions as F
    keep = df.filter(~F.coalesce(pred, F.lit(False)))
    return bind_rows(keep, repair(df.filter(pred)))
