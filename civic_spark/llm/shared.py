"""Helpers of several operators: written intermediate results, distributed ranks, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civic_spark.session import cut_lineage, ensure_checkpoint_dir


def written(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives lost executors and pins what was computed."""
    return cut_lineage(df)


def parquet(df: DataFrame) -> DataFrame:
    """Written to the shared folder as Parquet and read again: pinned, narrow to read, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one operator in the shared folder, each dropped as soon as the tables made from it are written."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
        self.held: list[tuple[DataFrame, str]] = []

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{len(self.held)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((out, path))
        return out

    def together(self, tables: list[DataFrame]) -> DataFrame:
        """The rows of tables of one schema, read by one scan."""
        paths = [p for t, p in self.held if any(t is x for x in tables)]
        return self.spark.read.schema(tables[0].schema).parquet(*paths)

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that no later job reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in (p for t, p in self.held if any(t is x for x in tables)):
            path = jvm.org.apache.hadoop.fs.Path(path)
            path.getFileSystem(conf).delete(path, True)


def global_rank(df: DataFrame, order: list[Column | str], weight: Column | None = None, rank: str = "rank",
                store: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """Adds the sum of ``weight`` (default 1) over all rows that precede the row in ``order``, from 0."""
    return global_sums(df, order, {rank: F.lit(1) if weight is None else weight}, store)


def global_sums(df: DataFrame, order: list[Column | str], sums: dict[str, Column],
                store: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """Adds, under each name, the sum of its weight over all rows that precede the row in ``order``, from 0.

    Rows are range partitioned, ranked within their partition, and shifted by the weight of the partitions before:
    no task sees more than its range, and only one row per partition meets in the offsets.  ``order`` must tell all
    rows apart.
    """
    part = "__part"
    weights = {f"__w{k}": w.cast("long") for k, w in enumerate(sums.values())}
    ranged = store(df.withColumns(weights).repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = ranged.groupBy(part).agg(*[F.sum(w).alias(f"{w}_size") for w in weights])
    offsets = sizes.select(part, *[(F.sum(f"{w}_size").over(upto) - F.col(f"{w}_size")).alias(f"{w}_before") for w in weights])
    own = {f"{w}_own": F.sum(w).over(inside) - F.col(w) for w in weights}
    total = {name: F.col(f"{w}_own") + F.col(f"{w}_before") for name, w in zip(sums, weights, strict=True)}
    helpers = [f"{w}{end}" for w in weights for end in ("", "_own", "_before")]
    return ranged.withColumns(own).join(offsets, part).withColumns(total).drop(part, *helpers)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected ``links`` (u, v); component is its smallest node.

    Alternating large-star and small-star rounds: each is a minimum per node (combined before the shuffle) joined
    back to the edges, so a node with very many neighbours never forms a group in memory; AQE splits its join
    partition.  Edges are checkpointed each round; the loop ends when they are stars around their smallest nodes.
    """
    edges = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct())
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(smallest.withColumnRenamed("m", "v")).distinct())
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """True if every greater end has one edge and is no smaller end: then the smaller ends name the components."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per_node.where("up > 1 or (up = 1 and down = 1)").isEmpty()
