"""Landed files to raw datasets, feed by feed and year by year (D0a–D0f).

Files lie in ``{base}/{feed}/{year}/`` (membership: ``{base}/membership/``, one file per party and state), plain or
gzip.  Each feed is written to ``{out}/{feed}`` as Parquet with one partition per file year.  Partitions are overwritten
one by one, so ``land_feed(..., years=[2012])`` rebuilds 2012 and leaves the other years' files as they are.  Every row
keeps its source file, and the manifest lists the files that gave no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.unions import bind_all
from ..sources import readers, schemas
from . import raw

YEAR = "ANO_ARQUIVO"


@dataclass(frozen=True)
class Feed:
    """How a feed's files are read: its canonical columns, positional names by year (None: the file's header), separator,
    encoding, years, and columns that the file's name holds."""

    schema: T.StructType
    years: tuple[int, ...] = ()
    names: Callable[[int], Sequence[str] | None] = lambda year: None
    sep: str = ";"
    encoding: str = readers.LATIN1
    from_name: Mapping[str, str] = field(default_factory=dict)
    layout: Callable[[DataFrame], DataFrame] | None = None


LOCAL, FEDERAL = tuple(range(2000, 2017, 4)), tuple(range(2002, 2015, 4))
FEEDS: dict[str, Feed] = {
    "votes_local": Feed(schemas.ELECTION_RAW, LOCAL),
    "votes_fed_state": Feed(schemas.ELECTION_RAW, FEDERAL),
    "party_local": Feed(schemas.PARTY_RAW, LOCAL),
    "party_fed_state": Feed(schemas.PARTY_RAW, FEDERAL),
    "details_local": Feed(schemas.DETAILS_RAW, LOCAL),
    "details_fed_state": Feed(schemas.DETAILS_RAW, FEDERAL),
    "candidate_local": Feed(schemas.CANDIDATE_RAW, LOCAL, schemas.candidate_names_for_year, layout=raw.candidate_layout),
    "candidate_fed_state": Feed(schemas.CANDIDATE_RAW, (1998, *FEDERAL), schemas.candidate_names_for_year, layout=raw.candidate_layout),
    "coalition": Feed(schemas.COALITION_RAW, tuple(sorted(LOCAL + FEDERAL))),
    "membership": Feed(schemas.MEMBERSHIP_RAW, from_name={
        "file_party": r"filiados_(.+)_[A-Za-z]{2}\.", "file_state": r"_([A-Za-z]{2})\.[^/]*$"}),
}


def typed_layout(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The canonical columns by name (any case), typed; then every other column as it came."""
    by_name = {c.lower(): c for c in df.columns}
    cols, taken = [], set()
    for f in schema.fields:
        source = by_name.get(f.name.lower())
        value = F.col(f"`{source}`") if source else F.lit(None)
        taken.add(source)
        if source and isinstance(f.dataType, T.DecimalType):
            value = F.regexp_replace(value, ",", ".")
        cols.append((value.try_cast(f.dataType) if source else value.cast(f.dataType)).alias(f.name))
    return df.select(*cols, *[F.col(f"`{c}`") for c in df.columns if c not in taken])


def _paths(base: str, name: str, years: Sequence[int]) -> dict[int, str]:
    """Folder of each year; the membership register has one folder (year 0)."""
    root = f"{base.rstrip('/')}/{name}"
    return {y: f"{root}/{y}" for y in years} if years else {0: root}


def land_feed(spark: SparkSession, base: str, name: str, out: str, years: Iterable[int] | None = None,
              feed: Feed | None = None) -> DataFrame:
    """Writes one feed's dataset, or only the partitions of ``years``; returns its file status.

    Gzip files come as one partition each, so feeds that hold any are spread out before the write."""
    feed = feed or FEEDS[name]
    known = feed.years
    years = list(known) if years is None else [y for y in years if y in known]
    if known and not years:
        raise ValueError(f"{name}: no such year")
    paths = _paths(base, name, years)
    manifest = readers.file_manifest(spark, list(paths.values()))
    parts = raw.scan_years(spark, paths, {y: feed.names(y) for y in paths}, sep=feed.sep, encoding=feed.encoding, year_column=YEAR)
    table = bind_all(parts)
    table = (feed.layout or (lambda t: typed_layout(t, feed.schema)))(table)
    table = table.withColumns({c: F.regexp_extract("_source_file", pattern, 1) for c, pattern in feed.from_name.items()})
    if not manifest.filter(F.lower("_source_file").endswith(".gz")).isEmpty():
        table = readers.repartition_after_gzip(table)
    path = f"{out.rstrip('/')}/{name}"
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(path)
    landed = _landed(spark, out, name, feed).filter(F.col(YEAR).isin(*paths))
    return readers.file_status(landed, data_column=feed.schema.fieldNames()[0], manifest=manifest)


def land_all(spark: SparkSession, base: str, out: str, feeds: Iterable[str] | None = None,
             years: Iterable[int] | None = None) -> dict[str, DataFrame]:
    """``land_feed`` for every feed (of ``feeds``), each over those of ``years`` that it has; returns their file status."""
    years = None if years is None else set(years)
    status = {}
    for name in feeds or FEEDS:
        own = None if years is None or not FEEDS[name].years else sorted(years & set(FEEDS[name].years))
        if own != []:
            status[name] = land_feed(spark, base, name, out, own)
    return status


def _landed(spark: SparkSession, out: str, name: str, feed: Feed | None = None) -> DataFrame:
    """Years landed apart may hold different extra columns, so schemas are merged; a feed that gave no row is empty."""
    path = f"{out.rstrip('/')}/{name}"
    if readers.file_manifest(spark, path).filter(F.col("_source_file").endswith(".parquet")).isEmpty():
        feed = feed or FEEDS[name]
        own = [*feed.schema.fields, *[T.StructField(c, T.StringType()) for c in ("_corrupt_record", "_source_file", *feed.from_name)]]
        return spark.createDataFrame([], T.StructType([*own, T.StructField(YEAR, T.IntegerType())]))
    return spark.read.option("mergeSchema", "true").parquet(path)


def dataset(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A landed dataset without its bookkeeping columns."""
    return _landed(spark, out, name).drop("_corrupt_record", "_source_file")


def raw_tables(spark: SparkSession, out: str, municipality_dim: DataFrame, feeds: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The landed datasets (of ``feeds``) as ``runner.build_all`` takes them: both levels of candidates, parties and
    tallies bound."""
    parts: dict[str, list[DataFrame]] = {}
    for name in feeds or FEEDS:
        kind = name.split("_")[0]
        parts.setdefault(name if kind == "votes" else kind, []).append(dataset(spark, out, name))
    return {"municipality_dim": municipality_dim} | {k: bind_all(v) for k, v in parts.items()}


def missing_membership_files(parties: DataFrame, states: DataFrame, status: DataFrame) -> DataFrame:
    """D0f / S18: party x state pairs whose membership file is not there or gave no row."""
    got = FEEDS["membership"].from_name
    loaded = status.filter("rows > 0").select(F.lower(F.regexp_extract("_source_file", got["file_party"], 1)).alias("party"),
                                              F.lower(F.regexp_extract("_source_file", got["file_state"], 1)).alias("state"))
    return raw.missing_membership_files(parties, states, loaded)
