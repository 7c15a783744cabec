"""Sinks (S19–S21).

Parquet partitioned by ``election_year`` is the engine's stage boundary
(partition pruning for year filters downstream).  CSV (optionally gzip,
Latin-1, ``;`` and decimal comma) is offered for parity with the reference's
exports.  Writes go to a shared folder; each task writes its own file, so a
lost executor only re-runs its tasks.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, partition_by: Iterable[str] = (), mode: str = "overwrite") -> None:
    """Engine default sink."""
    w = df.write.mode(mode)
    parts = list(partition_by)
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


def write_delimited(df: DataFrame, path: str, *, sep: str = ",", header: bool = True, gzip: bool = False,
                    encoding: str = "UTF-8", decimal_comma: bool = False, mode: str = "overwrite") -> None:
    """Delimited sink, optionally gzip-compressed, Latin-1, with
    decimal commas for fractional columns."""
    out = df
    if decimal_comma:
        frac = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType))]
        out = df.select(*[(F.regexp_replace(F.col(c).cast("string"), r"\.", ",").alias(c) if c in frac else F.col(c))
                          for c in df.columns])
    w = (out.write.mode(mode).option("sep", sep).option("header", str(header).lower())
         .option("encoding", encoding))
    if gzip:
        w = w.option("compression", "gzip")
    w.csv(path)


def write_split(df: DataFrame, outputs: dict[str, Column], base: str, *, fmt: str = "parquet", column: str = "output",
                mode: str = "overwrite", **options) -> dict[str, str]:
    """One table → several filtered outputs (e.g. local / state-federal), in one pass over it.

    A row goes to every output whose predicate holds, as the filters of the
    reference do; all outputs are partitions of one write.  Returns each
    output's folder, which reads back as a table of its own."""
    names = F.filter(F.array(*[F.when(pred, F.lit(name)) for name, pred in outputs.items()]), lambda n: n.isNotNull())
    w = df.withColumn(column, F.explode(names)).write.mode(mode).partitionBy(column).format(fmt)
    w.options(**options).save(base)
    return {name: f"{base.rstrip('/')}/{column}={name}" for name in outputs}
