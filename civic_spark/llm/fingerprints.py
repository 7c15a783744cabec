r"""Document fingerprints by consistent weighted sampling, with DataFrame functions only.

A text is its words `[^\x20\x09-\x0D]+`, each weighted by how often it occurs.  For sample k and a term of weight w,
with r, c ~ Gamma(2, 1) and b ~ U(0, 1) drawn by term and k alone: t = floor(ln w / r + b), a = c exp(-r (t - b + 1)).
The term and t of the least a are the sample; two texts agree in a sample with probability equal to their generalised
Jaccard similarity, sum of least over sum of largest weights (Ioffe 2010).  As a depends on nothing but term, t and k,
its value names the sample: a text keeps ``SAMPLES`` minima, and its fingerprint is 16 bits of a hash of each.

Draws.  A Gamma(2, 1) variable is the sum of two Gamma(1, 1) ones; by the duplication formula it is also twice the
square root of a Gamma(1, 1) times a Gamma(3/2, 1) one, so its logarithm is a sum too; and the sum of two uniform
variables modulo 1 is uniform.  So r, ln c and b of a term are sums of two rows of fixed tables (``TABLE`` rows each,
broadcast; their size does not depend on the data) picked by two halves of its hash.  The three are fixed-point
numbers of ``BITS`` bits in one long, so that one addition adds all three; the rest is generated code.

Plan.  Texts are shuffled once by (id, text hash) and once more as the heads that edits borrow; terms are counted and
minima taken within that partitioning, without a further exchange.

Defined results: a null text is empty; a text without words has one term, the empty one; rows that repeat an id are
ordered by a hash of their texts; rows repeated in full are one document in the order and come out as often as they
go in; null ids come first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civic_spark.llm.shared import global_rank, written

SAMPLES = 64
TABLE = 4096
#: Fixed point: bits of a field, the units of r, ln c and b, and what is added to each half of ln c.
BITS = 20
R_UNIT, C_UNIT, B_UNIT = 2.0 ** -15, 2.0 ** -15, 2.0 ** -20
C_LOW = 20.0
WORD = r"[^\x20\x09-\x0D]+"
DOC, NEXT = ["doc", "tkey"], ["next_doc", "next_tkey"]
NO_ID = -(1 << 63)


def _uniform(*parts: Column) -> Column:
    """In (0, 1), from 52 bits of a hash."""
    return (F.xxhash64(*parts).bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float(1 << 52))


def draw_table(spark, which: int) -> DataFrame:
    """Table ``which`` (0 or 1) of draws: row h{which}, array p{which} of SAMPLES packed draws r, c, b.

    r: Gamma(1, 1).  c: half the logarithm of a Gamma(1, 1) (table 0) or Gamma(3/2, 1) variable (table 1: exponential
    plus half a squared normal one), from -C_LOW up.  b: uniform.  A field has BITS bits and one for the carry.
    """
    h = F.col("id")
    u = lambda salt, k: _uniform(F.lit(10 * which + salt), h, k)
    exponential = lambda salt, k: -F.log(u(salt, k))
    if which == 0:
        log_c = lambda k: F.log(exponential(2, k)) / 2
    else:
        squared = lambda k: 2 * exponential(4, k) * F.pow(F.cos(u(5, k) * F.lit(2 * math.pi)), 2)
        log_c = lambda k: F.log(exponential(2, k) + squared(k) / 2) / 2
    top = (1 << BITS) - 1

    def field(value: Column, unit: float, at: int) -> Column:
        return F.shiftleft(F.least(F.greatest(F.floor(value / F.lit(unit)), F.lit(0)), F.lit(top)), at * (BITS + 1))

    def packed(k: Column) -> Column:
        return field(exponential(1, k), R_UNIT, 2) + field(log_c(k) + C_LOW, C_UNIT, 1) + field(u(3, k), B_UNIT, 0)

    each = F.sequence(F.lit(0), F.lit(SAMPLES - 1))
    return written(spark.range(TABLE).select(h.alias(f"h{which}"), F.transform(each, packed).alias(f"p{which}")))


def sampled(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fingerprint) of rows (keys, text); ``keys`` must tell rows apart and should be how rows are partitioned."""
    found = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    found = F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("")))
    words = texts.select(*keys, F.explode(found).alias("word"))
    terms = words.select(*keys, F.xxhash64("word").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("n"))
    rows = terms.select(*keys, F.log(F.col("n").cast("double")).alias("lw"), F.col("term").bitwiseAND(F.lit(TABLE - 1)).alias("h0"),
                        F.shiftrightunsigned("term", 32).bitwiseAND(F.lit(TABLE - 1)).alias("h1"))
    spark = texts.sparkSession
    rows = rows.join(F.broadcast(draw_table(spark, 0)), "h0").join(F.broadcast(draw_table(spark, 1)), "h1")
    least = []
    for k in range(SAMPLES):
        both = F.col("p0")[k] + F.col("p1")[k]
        r = (F.shiftrightunsigned(both, 2 * (BITS + 1)) + 1) * F.lit(R_UNIT)
        c = F.shiftrightunsigned(both, BITS + 1).bitwiseAND(F.lit((2 << BITS) - 1)) * F.lit(C_UNIT)
        b = both.bitwiseAND(F.lit((1 << BITS) - 1)) * F.lit(B_UNIT)
        t = F.floor(F.col("lw") / r + b)
        least.append(F.min(c - r * (t - b + 1)).alias(f"a{k}"))
    minima = rows.groupBy(*keys).agg(*least)
    digits = [F.lpad(F.lower(F.hex(F.xxhash64(f"a{k}").bitwiseAND(F.lit(0xFFFF)))), 4, "0") for k in range(SAMPLES)]
    return minima.select(*keys, F.concat(*digits).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two fingerprints."""
    equal = [(F.substring(a, 4 * k + 1, 4) == F.substring(b, 4 * k + 1, 4)).cast("int") for k in range(SAMPLES)]
    return sum(equal[1:], equal[0]) / F.lit(float(SAMPLES))


def successors(docs: DataFrame) -> DataFrame:
    """(doc, tkey, n_chars, times, next_doc, next_tkey): every document and the one after it, the last before the first."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = (docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("tkey"),
                       F.length(text).cast("long").alias("n_chars"))
           .groupBy(*DOC).agg(F.min("n_chars").alias("n_chars"), F.count("*").alias("times")))
    ranked = written(global_rank(own, ["doc", "tkey"]))
    count = ranked.count()
    after = ranked.select(F.pmod(F.col("rank") - 1, F.lit(max(count, 1))).alias("rank"), F.col("doc").alias("next_doc"), F.col("tkey").alias("next_tkey"))
    return written(ranked.join(after, "rank").drop("rank"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row of ``docs``."""
    order = successors(docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = (docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("tkey"), text.alias("text"))
             .groupBy(*DOC).agg(F.first("text").alias("text")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    heads = (whole.withColumnsRenamed(dict(zip(DOC, NEXT, strict=True))).join(order, NEXT)
             .select(*DOC, "n_chars", F.substring(F.col("text"), F.lit(1), half).alias("head")))
    both = whole.join(heads, DOC)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.col("head"))
    versions = both.select(*DOC, F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text")),
                                                   F.struct(F.lit(1).alias("which"), edited.alias("text")))).alias("v"))
    prints = sampled(versions.select(*DOC, "v.which", "v.text"), [*DOC, "which"])
    shas = both.select(*DOC, F.lit(2).alias("which"), F.sha2(edited, 256).alias("fingerprint"))
    rows = written(prints.unionByName(shas))
    pick = lambda k, name: F.max(F.when(F.col("which") == k, F.col("fingerprint"))).alias(name)
    one = rows.groupBy(*DOC).agg(pick(0, "fingerprint"), pick(1, "edited_fingerprint"), pick(2, "edited_sha256"))
    following = rows.where("which = 0").select(F.col("doc").alias("next_doc"), F.col("tkey").alias("next_tkey"), F.col("fingerprint").alias("next_fingerprint"))
    out = order.join(one, DOC).join(following, NEXT)
    return (out.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
            .select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next")))
