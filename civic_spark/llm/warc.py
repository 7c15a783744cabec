r"""WARC fixity audit with Merkle trees.

Records of an archive, in order, are hashed (SHA-256 of the whole record); ``FANOUT`` neighbours make a node whose
hash covers the hashes and offset range of its children, up to one root.  Two replicas are compared root to root; where
nodes differ, only their children are compared, down to the records: a sound subtree is never opened.

Order and offsets come from a distributed prefix sum (range partitions and their totals), so no task sees more than its
range; a node gathers at most ``FANOUT`` rows.

Defined results: null urls and payloads are empty; rows that repeat an id are ordered by url and payload; null ids come
first; a record that one replica lacks is ``missing`` or ``extra``; an empty archive has no nodes and equals another
empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civic_spark.llm.shared import global_rank, written

FANOUT = 64
CRLF = "\r\n"


def record(page_id: Column, url: Column, payload: Column) -> Column:
    """A WARC/1.1 resource record."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: resource{CRLF}WARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(f">{CRLF}WARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "),
        F.octet_length(body).cast("string"), F.lit(CRLF + CRLF), body, F.lit(CRLF + CRLF))


def archive(pages: DataFrame) -> DataFrame:
    """(page_id, seq, offset, length): the layout of the archive of ``pages`` (page_id, url, html), in order of id."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), record(F.col("page_id"), F.col("url"), F.col("html")).alias("r"))
    rows = own.select("page_id", F.sha2("r", 256).alias("digest"), F.octet_length("r").cast("long").alias("length"))
    # Rows repeated in full are told apart by their number, counted within one id and digest.
    rows = rows.groupBy("page_id", "digest").agg(F.min("length").alias("length"), F.count("*").alias("times"))
    rows = rows.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times")
    order = [F.col("page_id").asc_nulls_first(), "digest", "time"]
    placed = global_rank(rows, order, weight=F.col("length"), rank="offset")
    return written(global_rank(placed, order, rank="seq"))


def tree(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels (node, digest, start, stop) from the records (seq, digest, offset, length) up to one root."""
    level = written(leaves.select(F.col("seq").alias("node"), "digest", F.col("offset").alias("start"), (F.col("offset") + F.col("length")).alias("stop")))
    levels, rows = [level], level.count()
    while rows > 1:
        child = F.struct("node", "digest", "start", "stop")
        text = F.transform(F.array_sort(F.collect_list(child)), lambda c: F.concat_ws(":", c["node"].cast("string"), c["digest"], c["start"].cast("string"), c["stop"].cast("string")))
        level = written(level.groupBy(F.floor(F.col("node") / fanout).cast("long").alias("above")).agg(
            F.sha2(F.array_join(text, "\n"), 256).alias("digest"), F.min("start").alias("start"), F.max("stop").alias("stop"))
            .withColumnRenamed("above", "node"))
        levels.append(level)
        rows = level.count()
    return levels


def differences(a: list[DataFrame], b: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(seq, digest_a, digest_b): records that differ, found by opening differing nodes only.

    Trees of unequal height are compared from the lower one's root level; nodes beside it exist in one tree only.
    """
    height = min(len(a), len(b))
    suspects = None
    for k in range(height - 1, -1, -1):
        left, right = (x[k].select("node", F.struct("digest", "start", "stop").alias(name)) for x, name in ((a, "a"), (b, "b")))
        if suspects is not None:
            parent = F.floor(F.col("node") / fanout).cast("long")
            open_nodes = suspects.select(F.col("node").alias("parent"))
            left = left.withColumn("parent", parent).join(open_nodes, "parent", "left_semi").drop("parent")
            right = right.withColumn("parent", parent).join(open_nodes, "parent", "left_semi").drop("parent")
        suspects = written(left.join(right, "node", "full").where(~F.col("a").eqNullSafe(F.col("b"))))
    return suspects.select(F.col("node").alias("seq"), F.col("a.digest").alias("digest_a"), F.col("b.digest").alias("digest_b"),
                           F.coalesce("a.start", "b.start").alias("offset"),
                           (F.coalesce("a.stop", "b.stop") - F.coalesce("a.start", "b.start")).alias("length"))


def audit(original: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(seq, offset, length, digest_a, digest_b, status) of every record that the two replicas don't share.

    Both have (seq, offset, length, digest).
    """
    found = differences(tree(original, fanout), tree(replica, fanout), fanout)
    status = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("corrupt")
    return found.select("seq", "offset", "length", "digest_a", "digest_b", status.alias("status"))


def damaged(page_id: Column, html: Column) -> tuple[Column, Column]:
    """(payload, lost) of a replica for drills: by a hash of the id a character is changed, or the record is lost."""
    draw = F.substring(F.md5(F.concat(F.lit("replica:"), F.coalesce(page_id.cast("string"), F.lit("")))), 1, 2)
    html = F.coalesce(html, F.lit(""))
    middle = F.floor(F.length(html) / 2).cast("int")
    bad = F.concat(F.substring(html, F.lit(1), middle), F.lit("~"), F.substring(html, middle + 2, F.length(html)))
    return F.when(draw.isin("00", "01"), bad).otherwise(html), draw == "02"


def drill(pages: DataFrame) -> DataFrame:
    """(page_id, seq, offset, length, digest_a, digest_b, status): audit of the archive of ``pages`` against the
    replica that ``damaged`` makes of it.  The replica keeps the layout: a copy is read at its original's offset."""
    page_id, url, html = pages["page_id"], pages["url"], pages["html"]
    payload, lost = damaged(page_id, html)
    replica = pages.select(page_id.cast("long").alias("p"), F.sha2(record(page_id, url, html), 256).alias("digest"),
                           F.sha2(record(page_id, url, payload), 256).alias("now"), lost.alias("lost")).distinct()
    both = written(archive(pages).join(replica, "digest").where(F.col("page_id").eqNullSafe(F.col("p"))).drop("p", "time"))
    found = audit(both, both.where("not lost").drop("digest").withColumnRenamed("now", "digest"))
    return found.join(both.select("page_id", "seq"), "seq").select("page_id", *found.columns)


#: DuckDB: the same records, offsets and damage, compared record by record.
ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
         substr(md5('replica:' || coalesce(page_id::VARCHAR, '')), 1, 2) AS draw FROM pages),
q AS (
  SELECT *, CASE WHEN draw IN ('00', '01') THEN substr(html, 1, length(html) // 2) || '~' || substr(html, length(html) // 2 + 2)
            ELSE html END AS copy FROM p),
r AS (
  SELECT page_id, draw,
    'WARC/1.1' || n || 'WARC-Type: resource' || n || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || n
      || 'WARC-Target-URI: ' || url || n || 'Content-Type: text/html' || n || 'Content-Length: ' || strlen(html)::VARCHAR || n || n
      || html || n || n AS a,
    'WARC/1.1' || n || 'WARC-Type: resource' || n || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || n
      || 'WARC-Target-URI: ' || url || n || 'Content-Type: text/html' || n || 'Content-Length: ' || strlen(copy)::VARCHAR || n || n
      || copy || n || n AS b
  FROM q, (SELECT chr(13) || chr(10) AS n)),
d AS (
  SELECT page_id, draw, sha256(a) AS da, sha256(b) AS db, strlen(a)::BIGINT AS length,
         (row_number() OVER w - 1)::BIGINT AS seq, (sum(strlen(a)) OVER w - strlen(a))::BIGINT AS "offset"
  FROM r WINDOW w AS (ORDER BY page_id NULLS FIRST, sha256(a) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT page_id, seq, "offset", length, da AS digest_a, CASE WHEN draw <> '02' THEN db END AS digest_b,
       CASE WHEN draw = '02' THEN 'missing' ELSE 'corrupt' END AS status
FROM d WHERE draw = '02' OR da <> db
"""
