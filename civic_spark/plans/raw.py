"""Raw yearly feeds bound into one table per feed (D0a–D0f).

The reference downloads one archive per year (and per state for the party
membership register), reads every headerless ``;`` file with all columns as
text, names the columns by position (two layouts by year) and binds them.
Here the files are already landed (download is out of scope, see README):
one multi-path scan per layout, positional names applied as metadata, the
year taken from the path, malformed rows kept aside instead of failing, and
a per-file status table so that unreadable inputs are visible (S2, S6, S12,
S14, S17, U2).  ``landing.py`` drives these scans from a registry of feeds.  The membership register also gets the party × state coverage
grid of files that are missing (S18).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.unions import bind_all
from ..sources import readers


def bind_yearly(spark: SparkSession, paths_by_year: Mapping[int, str | Sequence[str]],
                names_by_year: Mapping[int, Sequence[str]] | Sequence[str], *, sep: str = ";",
                header: bool = False, encoding: str = readers.LATIN1,
                year_column: str = "ANO_ARQUIVO") -> tuple[DataFrame, DataFrame]:
    """Scan each year's files as text with that year's positional names (or,
    where a year maps to ``None``, the file's own header) and bind them with
    missing columns filled.  A file that cannot be read (a truncated gzip, say)
    gives the rows before its defect and no error; ``file_status`` lists every
    landed file, also those that gave none.  Returns ``(table, file_status)``."""
    parts = scan_years(spark, paths_by_year, names_by_year, sep=sep, header=header, encoding=encoding,
                       year_column=year_column)
    table = bind_all(parts)
    paths = [p for v in paths_by_year.values() for p in ([v] if isinstance(v, str) else v)]
    status = readers.file_status(table, manifest=readers.file_manifest(spark, paths))
    return table.drop("_corrupt_record"), status


def scan_years(spark: SparkSession, paths_by_year: Mapping[int, str | Sequence[str]],
               names_by_year: Mapping[int, Sequence[str]] | Sequence[str] | None, *, sep: str = ";", header: bool = False,
               encoding: str = readers.LATIN1, year_column: str = "ANO_ARQUIVO") -> list[DataFrame]:
    """One scan per year: its columns as text, ``_corrupt_record``, ``_source_file`` and the year."""
    parts = []
    for year, paths in paths_by_year.items():
        names = names_by_year.get(year) if isinstance(names_by_year, Mapping) else names_by_year
        if names is None:
            # Later years carry their own header row; every column still read as text
            reader = (spark.read.option("sep", sep).option("header", "true").option("encoding", encoding)
                      .option("nullValue", "").option("mode", "PERMISSIVE")
                      .option("columnNameOfCorruptRecord", "_corrupt_record").option("ignoreCorruptFiles", "true"))
            df = reader.csv(paths if isinstance(paths, str) else list(paths))
            if "_corrupt_record" not in df.columns:
                df = df.withColumn("_corrupt_record", F.lit(None).cast("string"))
            df = df.withColumn("_source_file", F.col("_metadata.file_path"))
        else:
            df = readers.scan_delimited(spark, paths, readers.all_string_schema(names), sep=sep, header=header,
                                        encoding=encoding, corrupt_column="_corrupt_record",
                                        path_column="_source_file", skip_unreadable_files=True)
        parts.append(df.withColumn(year_column, F.lit(year)))
    return parts


def bind_candidates(spark: SparkSession, paths_by_year: Mapping[int, str | Sequence[str]], **kw
                    ) -> tuple[DataFrame, DataFrame]:
    """D0d: the yearly candidate files, named by position per year (S12) and
    mapped to the one layout that D4 reads (``candidate_layout``)."""
    from ..sources.schemas import candidate_names_for_year

    table, status = bind_yearly(spark, paths_by_year, {y: candidate_names_for_year(y) for y in paths_by_year}, **kw)
    return candidate_layout(table), status


def candidate_layout(table: DataFrame) -> DataFrame:
    """The columns that D4 reads, typed, then every other column as it came.

    The 2012 names fill the names of the other years; a column that no year
    brings is a typed NULL.  2012 files hold no age on election day:
    ``IDADE_DATA_ELEICAO`` is there the age on taking office."""
    from ..sources.schemas import CANDIDATE_2012_SOURCES, CANDIDATE_RAW

    cols = []
    for f in CANDIDATE_RAW.fields:
        found = [F.col(n) for n in (f.name, CANDIDATE_2012_SOURCES.get(f.name)) if n in table.columns]
        value = F.coalesce(*found) if found else F.lit(None)
        if f.dataType.typeName() == "decimal":
            value = F.regexp_replace(value.cast("string"), ",", ".")
        cols.append(value.try_cast(f.dataType).alias(f.name))
    return table.select(*cols, *[c for c in table.columns if c not in CANDIDATE_RAW.fieldNames()])


def missing_membership_files(parties: DataFrame, states: DataFrame, loaded: DataFrame) -> DataFrame:
    """Party × state pairs with no landed membership file."""
    return readers.coverage_grid(parties.select("party"), states.select("state"), loaded, ["party", "state"])
