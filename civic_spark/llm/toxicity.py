"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier on hashed text features is trained in numpy from confirmed toxic texts (positives) and unlabelled
ones, which hold both kinds.  With class prior p and logistic loss, the risk estimated from positives P and unlabelled
U is ``p E_P[l(z)] + max(0, E_U[l(-z)] - p E_P[l(-z)])``: the second part is the risk on clean texts, corrected for
the toxic ones hidden in U, and cannot be below 0; a step that finds it negative undoes it (Kiryo et al. 2017).

Training uses a bounded sample, drawn by a hash of the id: ``MAX_POSITIVE`` and ``MAX_UNLABELLED`` texts.  The prior is
the share of toxic rows among all labelled training rows.  Every text is scored, whole, where it is read.

Features of a text: presence of each word and of the first 4 to 7 bytes of each longer word, hashed to
``FEATURES``; the model keeps those that are more frequent in positives than in unlabelled texts beyond chance, and of
which, by the prior, toxic texts hold the larger part; the logarithm of their number is one more input.

Defined results: a text without features (null, empty) gets the score of an empty text; labels that repeat a document
count as toxic if any is; null labels don't count; with no positive or no unlabelled text every score is the prior
(0 without labels).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civic_spark.llm.arrow_text import ALNUM_WORDS, CHUNK, LOWER, hash_words, mix, text_buffers, words_at

FEATURES = 1 << 20
MAX_POSITIVE, MAX_UNLABELLED = 3000, 9000
THRESHOLD = 0.7
#: Features under which a text's length does not matter.
SHORT = 128
#: Bytes of the prefixes of words that are features beside the words.
PREFIXES = (4, 5, 6, 7)


def _features(text: np.ndarray) -> np.ndarray:
    """Sorted distinct feature numbers of one text (lower-cased bytes), in segments of bounded size."""
    found, at = [np.zeros(0, np.int32)], 0
    while at < len(text):
        end = min(at + CHUNK, len(text))
        if end < len(text):
            stops = np.flatnonzero(~ALNUM_WORDS[text[at:end]])
            end = at + int(stops[-1]) + 1 if len(stops) else end
        buf = text[at:end]
        starts, ends = words_at(buf, ALNUM_WORDS)
        for width in (0, *PREFIXES):
            longer = ends - starts > width
            a = starts[longer]
            b = ends[longer] if not width else a + width
            h = mix(hash_words(buf, a, b) ^ np.uint64(width)) % np.uint64(FEATURES)
            found.append(np.unique(h.astype(np.int32)))
        at = end
    return np.unique(np.concatenate(found))


def text_features(col: pa.Array) -> Iterator[np.ndarray]:
    data, at = text_buffers(col)
    for k in range(len(at) - 1):
        yield _features(LOWER[data[at[k]:at[k + 1]]])


@dataclass
class Model:
    """Weights of the kept features; an empty model scores the prior."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    length: float = 0.0

    def score(self, features: np.ndarray) -> float:
        if len(self.features):
            at = np.searchsorted(self.features, features)
            at[at == len(self.features)] = 0
            found = self.features[at] == features
            z = self.bias + self.length * _length(features) + float(self.weights[at[found]].sum())
        else:
            z = self.bias
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -60, 60))))


def _length(features: np.ndarray) -> float:
    """How much a text says: a long one holds any given word more easily.  Short and empty texts count alike."""
    return float(np.log(max(len(features), SHORT))) - 6.0


def _logit(p: float) -> float:
    p = min(max(p, 1e-12), 1 - 1e-12)
    return float(np.log(p / (1 - p)))


def _counts(rows: list[np.ndarray]) -> np.ndarray:
    """Texts that hold each feature."""
    out = np.zeros(FEATURES, np.int64)
    for r in rows:
        out[r] += 1
    return out


def _screened(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, least: int = 4, z: float = 4.0,
              purity: float = 0.65) -> np.ndarray:
    """Features more frequent in positives beyond chance, of which toxic texts hold at least ``purity`` by the prior."""
    n1, n0 = len(positive), len(unlabelled)
    c1, c0 = _counts(positive), _counts(unlabelled)
    pooled = (c1 + c0) / (n1 + n0)
    spread = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / n1 + 1 / n0))
    toxic_share = prior * (c1 / n1) / ((c0 + 1) / n0)
    return np.flatnonzero((c1 >= least) & ((c1 / n1 - c0 / n0) / spread > z) & (toxic_share >= purity)).astype(np.int32)


def _sparse(rows: list[np.ndarray], kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and column of every kept feature present."""
    cols, own = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, r in enumerate(rows):
        _, _, at = np.intersect1d(r, kept, assume_unique=True, return_indices=True)
        cols.append(at.astype(np.int64))
        own.append(np.full(len(at), k, np.int64))
    return np.concatenate(own), np.concatenate(cols)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, *, steps: int = 600, rate: float = 0.05,
          decay: float = 2e-4) -> Model:
    """Full-batch Adam on the non-negative risk; deterministic."""
    if not positive or not unlabelled or not 0 < prior < 1:
        return Model(np.zeros(0, np.int32), np.zeros(0), _logit(prior))
    kept = _screened(positive, unlabelled, prior)
    (rp, cp), (ru, cu) = _sparse(positive, kept), _sparse(unlabelled, kept)
    n, m, d = len(positive), len(unlabelled), len(kept)
    lp, lu = np.array([_length(r) for r in positive]), np.array([_length(r) for r in unlabelled])
    w = np.zeros(d + 2)
    w[d] = _logit(prior)
    first, second = np.zeros(d + 2), np.zeros(d + 2)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60)))
    for t in range(1, steps + 1):
        zp = w[d] + w[d + 1] * lp + np.bincount(rp, w[cp], n)
        zu = w[d] + w[d + 1] * lu + np.bincount(ru, w[cu], m)
        clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        up, uu = prior * sigmoid(zp) / n, sigmoid(zu) / m
        if clean >= 0:
            gp, gu = -prior * sigmoid(-zp) / n - up, uu
        else:  # the corrected risk has gone negative: step back out of it
            gp, gu = up, -uu
        words = np.bincount(cp, gp[rp], d) + np.bincount(cu, gu[ru], d)
        grad = np.concatenate((words, [gp.sum() + gu.sum(), gp @ lp + gu @ lu]))
        grad[:d] += decay * w[:d]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        w -= rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    return Model(kept, w[:d], float(w[d]), float(w[d + 1]))


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = list(text_features(batch.column(1)))
        at = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))],
                                         names=["positive", "features"])


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Model from the training rows (not held out) of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = own.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    order = [F.xxhash64(F.lit(8), "doc_id"), "doc_id"]
    toxic = own.where("toxic = 1").select("doc_id").join(ids, "doc_id").orderBy(*order).limit(max_positive)
    other = ids.orderBy(F.xxhash64(F.lit(9), "doc_id"), "doc_id").limit(max_unlabelled)
    sample = toxic.withColumn("positive", F.lit(True)).union(other.withColumn("positive", F.lit(False)))
    # At most max_positive + max_unlabelled ids: bounded by parameters, so the texts stay where they are read.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(sample), "doc_id").select("positive", "text")
    got = texts.mapInArrow(_feature_rows, "positive boolean, features array<int>").toArrow()
    mark = np.asarray(got.column("positive").combine_chunks().to_numpy(zero_copy_only=False), dtype=bool)
    rows = [np.asarray(x.values, dtype=np.int32) for x in got.column("features")]
    order_by = sorted(range(len(rows)), key=lambda k: (mark[k], len(rows[k]), zlib.crc32(rows[k])))
    return train([rows[k] for k in order_by if mark[k]], [rows[k] for k in order_by if not mark[k]], float(share or 0.0))


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([model.score(f) for f in text_features(batch.column(batch.num_columns - 1))], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], names=[*batch.schema.names[:-1], "score"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scorer(model), "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the texts that score ``threshold`` or more, all columns as they were.

    The score is computed next to the text, in one pass: whole rows go through as one struct.
    """
    model = fit(docs, labels)
    kept = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    inner = kept.schema["row"].dataType.simpleString()
    scored = kept.mapInArrow(_scorer(model), f"row {inner}, score double")
    return scored.where(F.col("score") < threshold).select(*[F.col("row")[c].alias(c) for c in docs.columns])
