"""Mixing sources to target weights, with DataFrame functions only.

1. Words of each document are counted where it is read; only one row per source and task is shuffled.
2. Sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1, ...  The mix has as many words as the corpus.  A
   target stops at ``MOST`` times its source's size; what is over goes to the other sources by weight, until none is
   above.  Each round of this is one aggregate over the table of sources.
3. A source's rate is target / size.  A document is emitted floor(rate) times, plus once more if its coin, a hash of
   seed and id, is under the fraction.  Rates are joined by source; a hot source is split by the adaptive skew join.

Defined results: null and empty texts have size 0; a null source is a source; rows that repeat an id share a coin; a
source without words has target 0 and none of its documents is taken; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civic_spark.llm.shared import global_rank, written

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 20240601
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def coin(doc_id: Column, seed: int = SEED) -> Column:
    """Uniform in [0, 1): the first 52 bits of an md5 of id and seed, the same in every run."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def rates(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_rank(totals, [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = written(ranked.select("source", "source_size", weight.alias("weight"),
                                  (F.col("source_size") * most).alias("most")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, above = 0.0, None
    while True:
        full = F.lit(False) if above is None else F.col("most") < F.lit(level) * F.col("weight")
        got = table.agg(F.sum(F.when(full, F.col("most")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight"))),
                        F.sum(F.when(full, 1).otherwise(0))).first()
        if not got[1] or got[2] == above:
            break
        above, level = got[2], (total - got[0]) / got[1]
    target = F.least(F.col("most").cast("double"), F.lit(float(level)) * F.col("weight"))
    return (table.withColumn("target", target)
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
            .select("source", "source_size", "target", "rate"))


def copies(rate: Column, doc_id: Column, seed: int = SEED) -> Column:
    whole = F.floor(rate)
    return (whole + (coin(doc_id, seed) < rate - whole).cast("int")).cast("int")


def mixture(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every document."""
    sizes = written(docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")))
    plan = rates(sizes).withColumnRenamed("source", "__source")
    joined = sizes.join(plan, F.col("source").eqNullSafe(F.col("__source")))
    return (joined.withColumn("copies", copies(F.col("rate"), F.col("doc_id"), seed))
            .select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns as they were, plus ``copy`` (1, 2, ...)."""
    sizes = docs.select(F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    plan = rates(sizes).select(F.col("source").alias("__source"), F.col("rate").alias("__rate"))
    names = [c for c in docs.columns if c != "copy"]
    return (docs.join(plan, docs["source"].cast("string").eqNullSafe(F.col("__source")))
            .withColumn("__copies", copies(F.col("__rate"), docs["doc_id"], seed)).where("__copies > 0")
            .select(*names, F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("copy")))


#: DuckDB: the same mix; the level is found in closed form over the sources sorted by cap / weight.
ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 3 * source_size AS most,
         coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM totals),
level AS (
  SELECT l AS level FROM (
    SELECT ((SELECT sum(source_size) FROM totals) - spent)::DOUBLE / open_weight AS l, * FROM filled)
  WHERE l * weight <= most ORDER BY most / weight, source NULLS LAST LIMIT 1),
plan AS (SELECT source, source_size, least(most::DOUBLE, level * weight) AS target FROM filled, level),
drawn AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, CASE WHEN p.source_size > 0 THEN p.target / p.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null') || ':{SEED}'), 1, 13))::BIGINT / {float(1 << 52)!r} AS coin
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (floor(rate) + (coin < rate - floor(rate))::INT)::INT AS copies,
       ((floor(rate) + (coin < rate - floor(rate))::INT) * size)::BIGINT AS taken
FROM drawn
"""
