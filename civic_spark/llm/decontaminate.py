r"""Benchmark decontamination by a distributed positional inverted index, with DataFrame functions only.

Words are runs of digits, a-z and characters above U+007F after lower-casing A-Z.

1. Index.  One pass over the documents writes the postings (term, document, position) of every term that benchmark
   items use, and one sentinel posting per document that holds its word count.  A term's frequency is a count over it.
2. Items.  Items with the same words are searched once.  A window is ``size`` consecutive words of an item (a shorter
   item is one window).  Each window is looked up by its ``SEEDS`` rarest terms in the corpus; neighbouring windows
   mostly share them.  A window with a term that the corpus lacks cannot occur.
3. Alignments.  Each posting of a rare term, shifted by the term's offset in the item, says where the item would begin
   in the document.  Where the shifted lists of all rare terms of a window meet, the item is aligned: (document, item,
   shift), one row however many of its windows point there.
4. Intersection.  An alignment expects term j at shift + j.  Joining what is expected with the postings gives the
   matched positions; runs of at least ``size`` consecutive ones are exact occurrences, and their words are hit.
   ``proximity_matches`` uses the same index for all terms of an item within a span, in any order.

Nothing grows with the square of a passage's frequency: a passage that a third of the documents share gives one
alignment per document.  Seeds and benchmark documents are broadcast only below a checked number of rows.

Defined results: null and empty texts have no words and no hits; items without words occur nowhere; items that repeat
share their occurrences; repeated rows and ids are each reported by their own text; null item ids are left out of
``items_sha256`` and counted in ``n_items``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civic_spark.llm.shared import written
from civic_spark.session import ensure_checkpoint_dir

SIZE = 13
#: Rare terms of a window whose postings must meet.
SEEDS = 3
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
#: Rows up to which a table is broadcast; larger ones are joined by a shuffle.
SMALL = 200_000
KEY = ["doc", "tkey"]
NO_ID = -(1 << 63)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text.cast("string"), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """``df`` (already written) marked for broadcast if it has at most ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def item_classes(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written tables (class, j, term, n) of the distinct word sequences, and (class, item_id)."""
    own = items.select(F.col("item_id"), words(F.col("text")).alias("w")).where("size(w) > 0")
    own = written(own.select("item_id", "w", F.sha2(F.array_join("w", " "), 256).alias("class")))
    one = own.groupBy("class").agg(F.first("w").alias("w"))
    terms = one.select("class", F.size("w").alias("n"), F.posexplode("w").alias("j", "term"))
    return written(terms), written(own.select("class", F.col("item_id").cast("string").alias("item_id")).distinct())


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings table (doc, tkey, term, pos), stored as Parquet in the shared folder; term '' holds the word count."""
    text = F.col("text").cast("string")
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("tkey"),
                      F.posexplode(F.array_append(F.coalesce(words(text), F.array().cast("array<string>")), F.lit(""))).alias("pos", "word"))
    spark = docs.sparkSession
    vocabulary = written(terms.select(F.col("term").alias("word")).union(spark.range(1).select(F.lit(""))).distinct())
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/postings-{uuid.uuid4().hex}"
    own.join(_small(vocabulary), "word").select(*KEY, F.col("word").alias("term"), "pos").write.parquet(path)
    return spark.read.parquet(path)


def seeds(terms: DataFrame, index: DataFrame, size: int = SIZE) -> DataFrame:
    """(class, seed, of, k, j, term): per set ``seed`` of the rarest terms of a window, its ``of`` terms and their places."""
    frequency = written(index.groupBy("term").agg(F.count("*").alias("df")))
    known = terms.join(frequency, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    ahead = Window.partitionBy("class").orderBy("j").rowsBetween(0, size - 1)
    words_ahead = known.withColumn("w", F.array_sort(F.collect_list(F.struct("df", "j", "term")).over(ahead)))
    windows = words_ahead.where((F.col("j") <= F.col("n") - size) | ((F.col("n") < size) & (F.col("j") == 0)))
    rare = F.slice("w", 1, SEEDS).alias("rare")
    sets = windows.where(F.col("w")[0]["df"] > 0).select("class", rare).distinct()
    return sets.select("class", F.xxhash64("class", "rare").alias("seed"), F.size("rare").alias("of"), F.posexplode("rare").alias("k", "r")).select(
        "class", "seed", "of", "k", "r.j", "r.term")


def alignments(index: DataFrame, start: DataFrame) -> DataFrame:
    """(doc, tkey, class, shift) where the shifted postings of all terms of a seed meet."""
    lists = index.where("term <> ''").join(start, "term").select(*KEY, "class", "seed", "of", (F.col("pos") - F.col("j")).alias("shift"), "k")
    met = lists.groupBy(*KEY, "class", "seed", "of", "shift").agg(F.bit_or(F.expr("shiftleft(1, k)")).alias("met"))
    return met.where(F.bit_count("met") == F.col("of")).select(*KEY, "class", "shift").distinct()


def occurrences(docs: DataFrame, items: DataFrame, size: int = SIZE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(hits, members, index): words hit as (doc, tkey, pos, class); (class, item_id); the postings."""
    terms, members = item_classes(items)
    index = build_index(docs, terms)
    start = _small(written(seeds(terms, index, size)))
    aligned = written(alignments(index, start))
    expected = aligned.join(_small(terms), "class").select(*KEY, "class", "shift", "j", "n", "term", (F.col("shift") + F.col("j")).alias("pos"))
    inside = _small(written(aligned.select(*KEY).distinct()))
    near = index.where("term <> ''").join(inside, KEY, "left_semi")
    matched = expected.where("pos >= 0").join(near.distinct(), [*KEY, "term", "pos"])
    one = Window.partitionBy(*KEY, "class", "shift")
    runs = (matched.withColumn("island", F.col("j") - F.row_number().over(one.orderBy("j")))
            .withColumn("run", F.count("*").over(Window.partitionBy(*KEY, "class", "shift", "island"))))
    hits = written(runs.where(F.col("run") >= F.least(F.lit(size), F.col("n"))).select(*KEY, "pos", "class").distinct())
    return hits, members, index


def proximity_matches(docs: DataFrame, items: DataFrame, span: int) -> DataFrame:
    """(doc_id, item_id, start): stretches of at most ``span`` words that begin with a term of the item and hold all
    its distinct terms in any order, found from the postings of the item's rarest term."""
    terms, members = item_classes(items)
    index = build_index(docs, terms).where("term <> ''")
    wanted = written(terms.select("class", "term").distinct())
    frequency = index.groupBy("term").agg(F.count("*").alias("df"))
    rare = (wanted.join(frequency, "term").groupBy("class").agg(F.min_by("term", F.struct("df", "term")).alias("term"),
                                                                F.count("*").alias("known")))
    sizes = wanted.groupBy("class").agg(F.count("*").alias("distinct_terms"))
    rare = rare.join(sizes, "class").where("known = distinct_terms").select("class", "term", "distinct_terms")
    centre = index.join(rare, "term").select(*KEY, "class", "distinct_terms", F.col("pos").alias("centre"))
    starts = centre.select(*KEY, "class", "distinct_terms",
                           F.explode(F.sequence(F.greatest(F.lit(0), F.col("centre") - (span - 1)), F.col("centre"))).alias("start")).distinct()
    places = starts.select("*", F.explode(F.sequence(F.col("start"), F.col("start") + (span - 1))).alias("pos"))
    held = places.join(index.distinct(), [*KEY, "pos"]).join(wanted, ["class", "term"])
    full = held.groupBy(*KEY, "class", "distinct_terms", "start").agg(
        F.count_distinct("term").alias("held"), F.min("pos").alias("first")).where("held = distinct_terms and first = start")
    return full.join(members, "class").select(F.col("doc").alias("doc_id"), "item_id", "start").distinct()


def contamination(docs: DataFrame, items: DataFrame, size: int = SIZE, share: int = 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, tkey) per row of ``docs``.

    Contaminated: any word is hit and the words hit are at least 1 / ``share`` of all.
    """
    hits, members, index = occurrences(docs, items, size)
    counted = hits.groupBy(*KEY).agg(F.count_distinct("pos").alias("n_hit"))
    named = (hits.select(*KEY, "class").distinct().join(members, "class").groupBy(*KEY)
             .agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("ids")))
    sizes = index.where("term = ''").select(*KEY, F.col("pos").cast("long").alias("n_words"))
    found = written(counted.join(named, KEY))
    out = sizes.join(_small(found), KEY, "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_words", n_hit.alias("n_hit"),
                      F.coalesce("n_items", F.lit(0)).alias("n_items"),
                      F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"),
                      ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"), "tkey")


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = SIZE, share: int = 20) -> DataFrame:
    """``docs`` without contaminated rows, all columns as they were."""
    bad = written(contamination(docs, items, size, share).where("contaminated").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("__doc"), F.col("tkey").alias("__tkey")).distinct())
    same = ((F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)) == F.col("__doc"))
            & (F.xxhash64(docs["text"].cast("string")) == F.col("__tkey")))
    return docs.join(_small(bad), same, "left_anti")


#: DuckDB: every 13-word window of a document looked up among the windows of the items.
ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS win, least(13, len(w)) AS n
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
starts AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, lengths WHERE len(w) >= n)),
found AS (SELECT doc_id, s, starts.n, item_id FROM starts JOIN windows ON starts.win = windows.win AND starts.n = windows.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
