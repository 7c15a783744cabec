"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded buckets, star-shaped candidates.

1. Sketch (one pass, no shuffle of text).  A text's distinct word shingles are 64-bit hashes.  Their range is cut
   into ``BINS`` equal bins and the least hash of each bin is kept: one hash per shingle, not one per shingle and bin.
   An empty bin borrows from the first non-empty bin of its own fixed probe order (optimal densification), so short
   texts collide as often as their similarity says.  ``ROWS`` bins make a band; a band's values are its bucket key.
2. Texts with equal shingle sets form a class, and only its smallest id goes on: thousands of copies cost one row.
3. Candidates of a bucket form stars: every member with the bucket's smallest id, so a bucket of m members gives
   m - 1 pairs.  Sizes that rule the similarity out are dropped (lossless).  Pairs are confirmed on full sets.
4. Repair.  A star can miss a link between two members that are both unlike its hub.  In a bucket whose members are
   still in different components, every pair across components has a member outside the bucket's largest component;
   those members are held against all members of other components.  So no pair that shares a bucket goes unexamined
   unless it is already connected.  A pair is emitted only if its parity sketches allow the similarity: each shingle
   flips one of ``PARITY`` bits, so differing bits never outnumber differing shingles, and the test loses no link.

With 40 bands of 6 rows, a pair at similarity 0.8 shares no bucket with probability (1 - 0.8**6)**40 = 5e-6.

Defined results: a null text, an empty text and a text without words have an empty set and link with nothing; a row
with a null id links with nothing, its component is null and it is kept; rows that repeat an id are one node, each
row with its own set size; extra columns are ignored by ``near_duplicates``.  ``drop_near_duplicates`` decides by text
instead, whatever the ids: see there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civic_spark.llm.arrow_text import BASE, SPACE_WORDS, hashed_texts, mix, shingles
from civic_spark.llm.shared import connected_components, global_rank, written

BANDS, ROWS = 40, 6
BINS = BANDS * ROWS
SKETCH = "n_shingles long, class_a long, class_b long, bands array<long>, parity array<long>"
CLASS = ["class_a", "class_b", "n_shingles"]
#: What tells texts apart when documents are dropped: the id, which may be null, and 128 bits of a hash of the text.
TEXT = ["__id", "__text_a", "__text_b"]
#: Bits of the parity sketch.
PARITY = 512
#: First value of each bin; bin i holds hashes h with i = floor(h * BINS / 2**64).
EDGES = np.array([-(-(i << 64) // BINS) for i in range(BINS)], dtype=np.uint64)


def probe_orders() -> np.ndarray:
    """Row i: the order in which bin i, if empty, asks the others."""
    seeds = mix(np.arange(1, BINS * BINS + 1, dtype=np.uint64)).reshape(BINS, BINS)
    return np.argsort(seeds, axis=1, kind="stable").astype(np.int16)


PROBES = probe_orders()


def signature(hashes: np.ndarray) -> np.ndarray:
    """One-permutation signature of sorted distinct hashes (not empty), densified."""
    first = np.searchsorted(hashes, EDGES)
    after = np.append(first[1:], len(hashes))
    full = first < after
    sig = hashes[np.minimum(first, len(hashes) - 1)]
    empty = np.flatnonzero(~full)
    if len(empty):
        order = PROBES[empty, :32]
        hit = full[order]
        found = hit.any(axis=1)
        lender = order[np.arange(len(empty)), hit.argmax(axis=1)]
        if not found.all():
            rest = PROBES[empty[~found]]
            lender[~found] = rest[np.arange(len(rest)), full[rest].argmax(axis=1)]
        sig[empty] = sig[lender]
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band."""
    acc = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        acc = acc * np.uint64(BASE) + sig.reshape(BANDS, ROWS)[:, k]
    return mix(acc)


def _class(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set: two sums of differently mixed hashes."""
    with np.errstate(over="ignore"):
        a = np.add.reduce(mix(hashes), dtype=np.uint64)
        b = np.add.reduce(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def parity(hashes: np.ndarray) -> np.ndarray:
    """Parity, per bit, of the number of shingles that fall on it, as 64-bit words."""
    bit = mix(hashes ^ np.uint64(0x5BD1E995)) % np.uint64(PARITY)
    odd = (np.bincount(bit.astype(np.int64), minlength=PARITY) & 1).astype(bool)
    return np.packbits(odd).view(np.int64)


def _sketches(size: int):
    """Sketches of the last column's texts, beside the other columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, b, keys, odd, at = [], [], [], [], [], [0]
            for _, words in hashed_texts(batch.column(batch.num_columns - 1), SPACE_WORDS, lower=True):
                s = shingles(words, size)
                n.append(len(s))
                if len(s):
                    x, y = _class(s)
                    keys.append(band_keys(signature(s)).view(np.int64))
                    odd.append(parity(s))
                else:
                    x = y = 0
                a.append(x)
                b.append(y)
                at.append(at[-1] + (BANDS if len(s) else 0))
            none = np.zeros(0, np.int64)
            bands = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate([none, *keys])))
            bits = pa.ListArray.from_arrays(pa.array([x * (PARITY // 64) // BANDS for x in at], pa.int32()),
                                            pa.array(np.concatenate([none, *odd])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), bands, bits],
                names=[*batch.schema.names[:-1], "n_shingles", "class_a", "class_b", "bands", "parity"])
    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(w, size).tobytes() for _, w in hashed_texts(batch.column(1), SPACE_WORDS, lower=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "items"])
    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            left, right = batch.column(2), batch.column(3)
            for k in range(batch.num_rows):
                a = np.frombuffer(left[k].as_buffer(), np.uint64)
                b = np.frombuffer(right[k].as_buffer(), np.uint64)
                both = np.concatenate((a, b))
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[k] = 100 * shared >= percent * (len(a) + len(b) - shared)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["u", "v"])
    return run


def shingle_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(doc_id, items): the full sets, as sorted 64-bit hashes, of the documents named by ``ids`` (doc_id)."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(ids, "doc_id")
    return texts.mapInArrow(_sets(size), "doc_id long, items binary")


def confirmed_links(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full shingle sets reach ``percent`` Jaccard similarity."""
    left = pairs.join(sets.select(F.col("doc_id").alias("v"), F.col("items").alias("b")), "v")
    both = left.join(sets.select(F.col("doc_id").alias("u"), F.col("items").alias("a")), "u")
    return both.select("u", "v", "a", "b").mapInArrow(_confirm(percent), "u long, v long").distinct()


def _size_fits(percent: int):
    small, large = F.least("n_u", "n_v"), F.greatest("n_u", "n_v")
    return small * 100 >= large * percent


def _parity_fits(percent: int):
    """False only if so many parity bits differ that the sets differ too much."""
    bits = sum(F.bit_count(F.col("parity_u")[k].bitwiseXOR(F.col("parity_v")[k])) for k in range(PARITY // 64))
    return bits * (100 + percent) <= (F.col("n_u") + F.col("n_v")) * (100 - percent)


def _across(members: DataFrame, sketches: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of a bucket that are in different components and whose sizes and parities allow a link."""
    own = (members.join(labels.select(F.col("node").alias("v"), "component"), "v", "left")
           .withColumn("component", F.coalesce("component", "v")))
    parts = own.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = (parts.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("main"))
            .where("parts > 1").select("key", F.col("main.component").alias("main")))
    odd = sketches.select(F.col("doc_id").alias("v"), F.col("n_shingles").alias("n_v"), F.col("parity").alias("parity_v"))
    split = written(own.join(main, "key").join(odd, ["v", "n_v"]))
    outside = split.where("component <> main").select("key", *[F.col(c).alias(n) for c, n in (
        ("v", "u"), ("n_v", "n_u"), ("parity_v", "parity_u"), ("component", "component_u"))])
    # Two members outside meet twice; the order of their ids picks one.
    pairs = (split.join(outside, "key").where("component <> component_u and (component = main or u < v)")
             .where(_size_fits(percent) & _parity_fits(percent)))
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, component) after further links between nodes."""
    if links.isEmpty():
        return labels
    name = lambda end: labels.select(F.col("node").alias(end), F.col("component").alias(f"{end}_component"))
    between = (links.join(name("u"), "u", "left").join(name("v"), "v", "left")
               .select(F.coalesce("u_component", "u").alias("u"), F.coalesce("v_component", "v").alias("v")))
    merged = written(connected_components(between)).select(F.col("node").alias("part"), F.col("component").alias("whole"))
    old = labels.join(merged, F.col("component") == F.col("part"), "left").select("node", F.coalesce("whole", "component").alias("component"))
    # A node without a link so far is named by the merge alone.
    new = merged.join(labels.select(F.col("node").alias("part")), "part", "left_anti").select(F.col("part").alias("node"), F.col("whole").alias("component"))
    return written(old.unionByName(new))


def _linked(one: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """(node, component) of the nodes that have links; ``one`` has a row (doc_id, n_shingles, bands, parity) per node.

    ``sets_of`` gives the full sets (doc_id, items) of the nodes in a column ``doc_id``.
    """
    rows = one.select(F.col("doc_id").alias("v"), F.col("n_shingles").alias("n_v"), F.explode("bands").alias("key"))
    hubs = rows.groupBy("key").agg(F.min(F.struct("v", "n_v")).alias("hub"), F.count("*").alias("m")).where("m > 1")
    buckets = written(rows.join(hubs, "key")
                      .select("key", "v", "n_v", F.col("hub.v").alias("u"), F.col("hub.n_v").alias("n_u")))
    pairs = written(buckets.where(F.col("u") != F.col("v")).where(_size_fits(percent)).select("u", "v").distinct())
    sets = written(sets_of(buckets.select(F.col("v").alias("doc_id")).distinct()))
    links = written(confirmed_links(sets, pairs, percent))
    labels = written(connected_components(links))
    more = written(_across(buckets.select("key", "v", "n_v"), one, labels, percent))
    found = written(confirmed_links(sets, more, percent))
    return _merged(labels, found)


def near_duplicates(docs: DataFrame, *, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): connected components of near-duplicate texts.

    ``docs`` has ``doc_id`` and ``text``.  ``kept`` marks the smallest id of each component.
    """
    sketch = written(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                     .mapInArrow(_sketches(shingle_words), f"doc_id long, {SKETCH}"))
    classed = sketch.where("doc_id is not null and n_shingles > 0")
    classes = classed.groupBy(*CLASS).agg(F.min("doc_id").alias("node"))
    # A class's own sketch is that of its smallest id; a repeated id may bring another set, hence the class keys.
    one = (classed.join(classes.withColumnRenamed("node", "doc_id"), ["doc_id", *CLASS])
           .dropDuplicates(["doc_id", "class_a", "class_b"]))
    labels = _linked(one, lambda ids: shingle_sets(docs, ids, shingle_words), percent)
    named = classes.join(labels, "node", "left").select(*CLASS, F.coalesce("component", "node").alias("found"))
    nodes = classed.select("doc_id", *CLASS)
    linked = nodes.join(named, CLASS).select("doc_id", "n_shingles", F.col("found").alias("component_id"))
    alone = (sketch.where("doc_id is null or n_shingles = 0")
             .select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns ``TEXT``."""
    text = F.col("text").cast("string")
    return docs.withColumns(dict(zip(TEXT, (F.col("doc_id").cast("long"), F.xxhash64(text), F.xxhash64(F.lit(1), text)), strict=True)))


def _same_text(a: DataFrame, b: DataFrame) -> Column:
    return a["__id"].eqNullSafe(b["__id"]) & (a["__text_a"] == b["__text_a"]) & (a["__text_b"] == b["__text_b"])


def drop_near_duplicates(docs: DataFrame, *, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row per near-duplicate component, all columns as they were.

    Texts link by their words alone, so rows that repeat an id, with one text or several, and rows without an id are
    compared like any others.  A component's row is that of the smallest id, null after all others, then of the least
    text hash; among rows of one id and text, the one whose columns come first as JSON.  Texts without words are no
    copies of anything: all their rows stay.
    """
    texts = _keyed(docs).select(*TEXT, F.col("text").cast("string").alias("text"))
    sketch = written(texts.mapInArrow(_sketches(shingle_words), f"__id long, __text_a long, __text_b long, {SKETCH}"))
    worded = sketch.where("n_shingles > 0")
    first = F.min(F.struct(F.col("__id").isNull().alias("no_id"), *TEXT))
    heads = worded.groupBy(*CLASS).agg(first.alias("head")).select(*CLASS, "head.*")
    # A class is a node, numbered in the order of its first text.
    nodes = written(global_rank(heads, ["no_id", *TEXT], rank="node"))
    own = nodes.select(F.col("node").alias("doc_id"), *TEXT)
    one = worded.join(own, _same_text(worded, own)).select("doc_id", "n_shingles", "bands", "parity").dropDuplicates(["doc_id"])

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = own.join(ids, "doc_id")
        found = texts.join(wanted, _same_text(texts, wanted)).select(*[wanted[c] for c in TEXT], "doc_id", "text")
        return (found.groupBy(*TEXT, "doc_id").agg(F.first("text").alias("text")).select("doc_id", "text")
                .mapInArrow(_sets(shingle_words), "doc_id long, items binary"))

    labels = _linked(one, sets_of, percent)
    kept = written(nodes.join(labels, "node", "left").where("component is null or component = node").select(*TEXT))
    times = worded.groupBy(*TEXT).agg(F.count("*").alias("times"))
    lost = written(times.join(kept, _same_text(times, kept), "left_anti").select(*TEXT))
    several = times.where("times > 1")
    several = written(several.join(kept, _same_text(several, kept), "left_semi").select(*TEXT))
    rows = _keyed(docs)
    if several.isEmpty():
        return rows.join(lost, _same_text(rows, lost), "left_anti").select(*docs.columns)
    gone = lost.unionByName(several)
    row = F.struct(*docs.columns)
    again = rows.join(several, _same_text(rows, several), "left_semi")
    again = again.groupBy(*TEXT).agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
    return rows.join(gone, _same_text(rows, gone), "left_anti").select(*docs.columns).unionByName(again)
