"""Scans of the raw yearly feeds.

* explicit ``StructType`` per feed (never ``inferSchema``);
* Latin-1 / UTF-8 decoding, ``;`` or ``,`` delimiters, header or positional
  names, decimal-comma numbers, empty string as NULL;
* gzip files are not splittable: each is one task, so multi-file scans are
  repartitioned right after the scan (``repartition_after_gzip``);
* one multi-path scan replaces the reference's per-file loop + bind
  (``scan_many``); the year / source file is recovered from the path;
* unreadable rows are kept in ``_corrupt_record`` (PERMISSIVE) instead of
  failing the job; a per-file status table is derived from them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalise_name

LATIN1 = "ISO-8859-1"


def all_string_schema(names: Iterable[str]) -> T.StructType:
    """Every column as text (ids keep their leading zeros)."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def scan_delimited(spark: SparkSession, paths, schema: T.StructType, *, sep: str = ",",
                   header: bool = True, encoding: str = "UTF-8", corrupt_column: str | None = None,
                   path_column: str | None = None, repartition: int | None = None,
                   skip_unreadable_files: bool = False) -> DataFrame:
    """Delimited scan with an explicit schema.

    ``nullValue=''`` maps empty fields to NULL (``na.strings = ""``).  When
    ``corrupt_column`` is given, malformed rows land there instead of failing
    (S17).  ``skip_unreadable_files`` skips files that cannot be read at all
    (a truncated gzip, say), as the reference's ``tryCatch`` did; the file
    status table shows which files contributed rows.  ``path_column`` records
    the source file (S6 / S14).
    """
    sch = schema
    if corrupt_column:
        sch = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType(), True)])
    reader = (spark.read.schema(sch)
              .option("sep", sep).option("header", str(header).lower())
              .option("encoding", encoding).option("nullValue", "").option("emptyValue", "")
              .option("quote", '"').option("escape", '"')
              .option("mode", "PERMISSIVE"))
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if skip_unreadable_files:
        reader = reader.option("ignoreCorruptFiles", "true")
    df = reader.csv(paths if isinstance(paths, str) else list(paths))
    if path_column:
        df = df.withColumn(path_column, F.col("_metadata.file_path"))
    if repartition:
        df = df.repartition(repartition)
    return df


def repartition_after_gzip(df: DataFrame, n: int | None = None) -> DataFrame:
    """Gzip input arrives as one partition per file; spread it out."""
    n = n or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n)


def year_from_path(path_col: str = "_source_file", pattern: str = r"(\d{4})") -> F.Column:
    """The election year taken from the file name, not file order."""
    return F.regexp_extract(F.regexp_extract(F.col(path_col), r"([^/]*)$", 1), pattern, 1).try_cast("int")


def scan_many(spark: SparkSession, base: str, glob: str, schema: T.StructType, **kw) -> DataFrame:
    """One scan over every file matching ``glob`` under ``base``."""
    return scan_delimited(spark, f"{base.rstrip('/')}/{glob}", schema, path_column="_source_file", **kw)


def normalise_header(df: DataFrame) -> DataFrame:
    """Header names stripped of quotes, lower-cased, unaccented,
    whitespace / dots to ``_`` — a metadata-only rename."""
    return df.toDF(*[normalise_name(c) for c in df.columns])


def adapt_layout(df: DataFrame, mapping: Mapping[str, str | None], canonical: T.StructType) -> DataFrame:
    """One yearly layout → the canonical layout.

    ``mapping = {canonical_name: source_name or None}``; missing sources become
    typed NULLs; every column is cast (``try_cast``) to the canonical type, so
    the later union never meets a type clash."""
    out = []
    for f in canonical.fields:
        src = mapping.get(f.name)
        if src is None or src not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            c = F.col(f"`{src}`")
            if isinstance(f.dataType, T.DecimalType):
                c = F.regexp_replace(c.cast("string"), ",", ".")
            out.append(c.try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def inline_table(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """Small literal table (parameter data such as inline coalition rows)."""
    return spark.createDataFrame(rows, schema)


def coverage_grid(a: DataFrame, b: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Every (a × b) cell not present in ``loaded`` — e.g. the party ×
    state membership files that could not be fetched.  ``b`` is a domain list
    (states): its values are exploded onto each distinct ``a`` value, then
    cells already loaded are anti-joined."""
    from ..operators.joins import left_join, value_list

    bcol = b.columns[0]
    grid = a.distinct().withColumn(bcol, F.explode(value_list(b, bcol)))
    return left_join(grid, loaded.select(*keys).distinct(), keys, how="left_anti")


def file_manifest(spark: SparkSession, paths, path_column: str = "_source_file") -> DataFrame:
    """Every file under ``paths`` (files, folders or patterns) with its size; contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(paths if isinstance(paths, str) else list(paths)))
    return files.select(F.col("_metadata.file_path").alias(path_column), F.col("length").alias("bytes"))


def file_status(df: DataFrame, path_column: str = "_source_file", corrupt_column: str = "_corrupt_record",
                data_column: str | None = None, manifest: DataFrame | None = None) -> DataFrame:
    """Per-file row, malformed-row and filled-first-field counts (what the
    reference's ``tryCatch`` silently skipped).  A data column is always read
    as well: Spark does not scan the corrupt-record column on its own.  With a
    ``manifest``, every file in it has a row, with 0 rows where it gave none."""
    data_column = data_column or next(c for c in df.columns if c not in (path_column, corrupt_column))
    read = df.groupBy(path_column).agg(F.count(F.lit(1)).alias("rows"),
                                       F.count(F.col(corrupt_column)).alias("malformed_rows"),
                                       F.count(F.col(data_column)).alias("first_field_filled"))
    if manifest is None:
        return read
    counts = ("rows", "malformed_rows", "first_field_filled")
    return manifest.join(read, path_column, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
