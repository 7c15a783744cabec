"""Incremental landing of raw feed files (the D0 bind, run as a stream).

The reference re-reads and re-binds every yearly file on each run.  Here a
file-source Structured Streaming query picks up only files not seen before
(the source log lives in the checkpoint), cleans them with the same batch
functions, and appends them to a Parquet table partitioned by year.  With
``trigger(availableNow=True)`` it processes the backlog and stops, so it runs
as a scheduled batch job with exactly-once output; an executor lost mid-way
only re-runs its tasks, and a failed run resumes from the checkpoint.

Checkpoints and outputs must be on shared storage (the cluster's
``spark.checkpoint.dir`` by default).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from ..sources import readers


def stream_feed(spark: SparkSession, source_dir: str, schema: T.StructType, *, sep: str = ";",
                header: bool = True, encoding: str = readers.LATIN1, max_files_per_trigger: int | None = None
                ) -> DataFrame:
    """A streaming DataFrame over the delimited files landing in ``source_dir``."""
    r = (spark.readStream.schema(schema).option("sep", sep).option("header", str(header).lower())
         .option("encoding", encoding).option("nullValue", "").option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(source_dir).withColumn("_source_file", F.input_file_name())


def land(stream: DataFrame, target: str, *, transform: Callable[[DataFrame], DataFrame] | None = None,
         partition_by: tuple[str, ...] = ("election_year",), checkpoint: str | None = None,
         available_now: bool = True):
    """Append cleaned micro-batches to ``target`` (Parquet, partitioned).

    ``transform`` is any batch cleaning function of this package (it must be
    row-wise: sentinels, renames, folding, typing).  Returns the started
    query; with ``available_now`` the caller may ``awaitTermination()``."""
    spark = stream.sparkSession
    if checkpoint is None:
        checkpoint = ensure_checkpoint_dir(spark).rstrip("/") + "/ingest-" + target.strip("/").replace("/", "_")
    out = transform(stream) if transform else stream
    w = (out.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
         .outputMode("append").partitionBy(*[p for p in partition_by if p in out.columns]))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def windowed_totals(spark: SparkSession, source_dir: str, glob: str, schema: T.StructType, ts: str,
                    window: str, keys: list[str], value: str, target: str | None = None) -> DataFrame:
    """Event-time window totals computed by a streaming query over the files
    matching ``glob`` in ``source_dir`` (``trigger(availableNow)``).

    Each micro-batch rewrites the complete result table in shared storage
    through ``foreachBatch`` — nothing is collected on the driver — and the
    finished table is returned as a batch DataFrame.  The state holds one row
    per (window, key): bounded by the time span, not by the input size."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    target = target or f"{base}/windowed-{uuid.uuid4().hex}"
    src = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(source_dir)
    agg = (src.groupBy(F.window(ts, window).alias("__w"), *keys)
              .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias(value))
              .select(F.col("__w.start").alias("window_start"), *keys, "n", value))

    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(target)

    q = (agg.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", f"{target}-checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(target)
