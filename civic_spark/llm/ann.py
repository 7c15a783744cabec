"""Approximate nearest neighbours by cosine: probed lists, scanned adaptively over blocks of rotated dimensions.

Equal vectors are one class, so copies are compared once; a class keeps its ``top + 1`` least ids, which are all that a
result of ``top`` rows besides the query's own can hold.  Unit vectors are rotated at random and kept in lists around
centroids; every class is in the index.  Centroids, the share of each list and the number of lists to probe come from a
sample of at most ``SAMPLE`` classes in order of their hash: the lists probed are the fewest that hold ``TARGET`` of the
sample's own true neighbours, which are farther than those among all rows, so the estimate is on the safe side.

The scan of a list compares a block of queries with a block of vectors, ``COLUMNS`` dimensions at a time.  After t of d
dimensions d/t times the partial squared distance estimates the whole one; a candidate is abandoned as soon as that is
over (1 + EPSILON / sqrt(t))^2 times the query's squared threshold, a test that rejects a true neighbour with negligible
probability.  Thresholds come from the part that holds the nearest list, which is searched first; the other parts follow,
and within a part the best so far bound what comes next.  What survives all
dimensions and is still among a query's best in its part is scored by the exact measure on the original vectors, in
double precision with correctly rounded sums.

Work is dealt by parts of the index: neighbouring lists, or a shard of a large list, of about ``SHARD`` numbers at most,
and by shares of ``ASKED`` queries.  A query travels once to each part that has a list it probes.  A task holds the
vectors of its part, and its queries come by in blocks; single-precision vectors are kept and sent as such.

Defined results: vectors that are null, zero, or hold null or non-finite entries take no part; shorter vectors count as
followed by zeros; equal scores come in order of id, null ids last; a null id is never a query; rows that repeat an id
are rows of their own (each a candidate of the other); with fewer candidates than ``top`` all are returned; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from civic_spark.llm.shared import Scratch, parquet
from civic_spark.llm.whitening import usable

SAMPLE, MAX_LISTS, LIST_ROWS = 32_768, 4_096, 256
TARGET, TRIALS, SEED = 0.98, 512, 12
COLUMNS, EPSILON = 16, 2.1
BLOCK, SHARD, ASKED = 512, 1 << 23, 1 << 18
#: Parts of a small index, if it has as many lists.
PARTS = 64
#: Pairs are compared by products of whole blocks until so small a share is left.
DENSE = 1 / 32
#: Candidates of a block of queries that wait for their exact scores.
WAITING = 1 << 16
#: Rows of the sample compared with all of it at once.
TRIED = 32
#: Rounding of single-precision squared distances of unit vectors.
SLACK = 1e-5


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by powers of two first, so that no square leaves the range of doubles."""
    v = v * 2.0 ** -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1].astype(float) if v.size else v
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine in double precision: sums of products are rounded once."""
    a, b = (x * 2.0 ** -float(np.frexp(np.abs(x).max())[1]) for x in (a, b))
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


def vectors_of(rows: DataFrame, vector: str, row_id: str) -> tuple[DataFrame, np.dtype, int]:
    """(id, v) of all rows, the type of the numbers, and the length of the longest usable vector."""
    kind = "float" if getattr(rows.schema[vector].dataType, "elementType", None) == FloatType() else "double"
    own = rows.select(F.col(row_id).cast("long").alias("id"), F.col(vector).cast(f"array<{kind}>").alias("v")).where(F.col("v").isNotNull())
    least, d = own.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if least != d:
        zero = F.forall("v", lambda c: c == 0)
        d = own.where(usable(F.col("v"))).where(~zero).agg(F.max(F.size("v"))).first()[0]
    return own, np.dtype("f4" if kind == "float" else "f8"), d or 0


def packed(own: DataFrame, kind: np.dtype, d: int) -> DataFrame:
    """(id, hash, v) of usable rows: v is the bytes of ``d`` numbers, zeros without sign."""
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(2)
            at, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            count = lambda of: np.diff(np.concatenate([[0], np.cumsum(of)])[at])
            good = column.is_valid().to_numpy(zero_copy_only=False) & (count(~np.isfinite(values)) == 0) & (count(values != 0) > 0)
            v = np.zeros((int(good.sum()), d), kind)
            length = np.diff(at)
            v[np.arange(d)[None, :] < length[good][:, None]] = values[at[0]:at[-1]][np.repeat(good, length)]
            v += 0
            good = pa.array(good)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(good), b.column(1).filter(good), _packed(v)], names=["id", "hash", "v"])

    double = F.col("v").cast("array<double>")
    hashed = F.xxhash64(F.concat(double, F.array_repeat(F.lit(0.0), F.lit(d) - F.size("v"))))
    return own.select("id", hashed.alias("hash"), "v").mapInArrow(clean, "id long, hash long, v binary")


def _packed(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    n, rows = len(rows), np.ascontiguousarray(rows)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(rows.strides[0])), pa.py_buffer(rows)])


def _unpacked(column: pa.Array, kind: np.dtype) -> np.ndarray:
    """Rows of the same number of bytes."""
    at, n = np.frombuffer(column.buffers()[1], np.int32)[column.offset:], len(column)
    return np.frombuffer(column.buffers()[2], kind, (at[n] - at[0]) // kind.itemsize, at[0]).reshape(n, -1)


def classes_of(own: DataFrame, top: int) -> DataFrame:
    """(key, hash, v, ids) of (id, hash, v): equal vectors once, with their least ids, nulls last."""
    order = Window.partitionBy("v").orderBy(F.asc_nulls_last("id"))
    least = own.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top + 1)
    ids = F.transform(F.collect_list(F.struct("id")).over(order.rowsBetween(0, top)), lambda s: s["id"])
    first = least.withColumn("ids", ids).where(F.col("place") == 1)
    return first.select(F.monotonically_increasing_id().alias("key"), "hash", "v", "ids")


@dataclass(frozen=True)
class Index:
    """What places vectors and queries: bounded by dimension and ``MAX_LISTS``."""

    rotation: np.ndarray
    centroids: np.ndarray
    probes: int
    sampled: np.ndarray
    shards: np.ndarray
    parts: np.ndarray

    def rotate(self, v: np.ndarray) -> np.ndarray:
        return unit(v.astype(float)) @ self.rotation

    def lists_of(self) -> dict[int, np.ndarray]:
        """The lists of every part."""
        out: dict[int, list[int]] = {}
        for one, (part, shards) in enumerate(zip(self.parts.tolist(), self.shards.tolist())):
            for k in range(part, part + shards):
                out.setdefault(k, []).append(one)
        return {k: np.array(v) for k, v in out.items()}

    def nearness(self, rotated: np.ndarray) -> np.ndarray:
        return rotated @ self.centroids.T

    def ranked(self, rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lists of every query, nearest first, and how many of them to probe: enough to hold some sampled vectors too."""
        order = np.argsort(-self.nearness(rotated), axis=1, kind="stable")
        enough = (np.cumsum(self.sampled[order], axis=1) < 32).sum(axis=1) + 1
        return order, np.maximum(self.probes, np.minimum(enough, len(self.centroids)))


def closest(rotated: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of every row; no more than ``BLOCK`` rows of products are held at once."""
    parts = [(rotated[k:k + BLOCK] @ centroids.T).argmax(axis=1) for k in range(0, len(rotated), BLOCK)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def sample(classes: DataFrame, total: int) -> list[pa.Array]:
    """The first ``SAMPLE`` classes in order of their hash; of many classes only those of small hashes are sorted."""
    cut = int(2 * SAMPLE / max(total, 1) * 2 ** 64) - 2 ** 63
    few = lambda df: df.select("hash", "v").orderBy("hash", "v").limit(SAMPLE).select("v").toArrow().column(0).chunks
    if cut < 2 ** 63:
        chunks = few(classes.where(F.col("hash") < F.lit(cut)))
        if sum(len(c) for c in chunks) == SAMPLE:
            return chunks
    return few(classes)


def fit(classes: DataFrame, total: int, top: int, kind: np.dtype, d: int) -> Index:
    """Index parameters from a sample of classes, on the driver: at most ``SAMPLE`` vectors, and products of few rows at once."""
    chunks = sample(classes, total)
    rotation = np.linalg.qr(np.random.default_rng(SEED).normal(size=(d, d)))[0]
    x = np.empty((sum(len(c) for c in chunks), d))
    at = 0
    while chunks:
        c = _unpacked(chunks.pop(0), kind)
        for start in range(0, len(c), BLOCK):
            part = c[start:start + BLOCK]
            x[at:at + len(part)] = unit(part.astype(float)) @ rotation
            at += len(part)
    lists = max(1, min(math.isqrt(total), total // LIST_ROWS, MAX_LISTS))
    centroids = x[:lists].copy()
    for _ in range(8):
        of = closest(x, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, of, x)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centroids = np.where(length > 0, sums / np.where(length > 0, length, 1), centroids)
    of = closest(x, centroids)
    sampled = np.bincount(of, minlength=lists)
    needed = [_places(x, of, centroids, start, min(start + TRIED, TRIALS, len(x)), top) for start in range(0, min(TRIALS, len(x)), TRIED)]
    needed = np.sort(np.concatenate(needed)) + 1
    probes = int(needed[math.ceil(TARGET * len(needed)) - 1]) if len(needed) else 1
    rows = total * sampled / len(x)
    most = max(BLOCK, SHARD // d)
    shards = np.maximum(1, np.round(rows / most)).astype(np.int64)
    return Index(rotation, centroids, min(probes, lists), sampled, shards, parts_of(neighbouring(centroids), rows, shards, min(most, total / PARTS)))


def neighbouring(centroids: np.ndarray) -> list[int]:
    """An order of the lists in which near ones are close: halves along the line between two far centroids."""
    def halves(own: np.ndarray) -> list[int]:
        if len(own) < 3:
            return own.tolist()
        c = centroids[own]
        one = c[np.argmin(c @ c.mean(axis=0))]
        along = np.argsort(c @ (one - c[np.argmin(c @ one)]), kind="stable")
        return halves(own[along[:len(own) // 2]]) + halves(own[along[len(own) // 2:]])

    return halves(np.arange(len(centroids)))


def parts_of(order: list[int], rows: np.ndarray, shards: np.ndarray, room: float) -> np.ndarray:
    """The part of every list, that of its first shard if it has several: lists fill a part up to ``room`` rows."""
    parts, part, held = np.zeros(len(order), np.int64), -1, math.inf
    for one in order:
        if shards[one] > 1 or held + rows[one] > room:
            part, held = part + 1, 0
        parts[one] = part
        held += rows[one]
        if shards[one] > 1:
            part, held = part + int(shards[one]) - 1, math.inf
    return parts


def _places(x: np.ndarray, of: np.ndarray, centroids: np.ndarray, start: int, stop: int, top: int) -> np.ndarray:
    """How many lists are nearer than that of each true neighbour of the rows from ``start`` to ``stop``."""
    tried = x[start:stop]
    place = np.empty((len(tried), len(centroids)), np.int64)
    np.put_along_axis(place, np.argsort(-(tried @ centroids.T), axis=1, kind="stable"), np.arange(len(centroids))[None, :], axis=1)
    near = tried @ x.T
    near[np.arange(len(tried)), np.arange(start, stop)] = -2
    best = np.argsort(np.negative(near, out=near), axis=1)[:, :min(top, max(len(x) - 1, 0))]
    return np.take_along_axis(place, of[best], axis=1).ravel()


def _columns(rotated: np.ndarray) -> bytes:
    """Single-precision column blocks, one after the other."""
    r = rotated.astype(np.float32)
    return b"".join(np.ascontiguousarray(r[:, c:c + COLUMNS]).tobytes() for c in range(0, r.shape[1], COLUMNS))


def _column_blocks(data: bytes, n: int, d: int) -> list[np.ndarray]:
    out, at = [], 0
    for c in range(0, d, COLUMNS):
        width = min(COLUMNS, d - c)
        out.append(np.frombuffer(data, np.float32, n * width, at).reshape(n, width))
        at += 4 * n * width
    return out


DEALT = "part int, share int, list int, key long, least long, threshold double, wanted binary, vector binary"


def build(classes: DataFrame, index: Index, kind: np.dtype) -> DataFrame:
    """The index: every class in its list and part."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            of = closest(index.rotate(_unpacked(b.column(2), kind)), index.centroids)
            part = index.parts[of] + b.column(0).to_numpy(zero_copy_only=False) % index.shards[of]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(of, pa.int32()), *b.columns], names=["part", "list", "key", "ids", "vector"])

    return classes.select("key", "ids", "v").mapInArrow(assign, "part int, list int, key long, ids array<long>, vector binary")


def _probed(queries: DataFrame, index: Index, kind: np.dtype, shares: int, first: bool) -> DataFrame:
    """Queries (key, v, threshold) for the parts that have lists they probe: those of the nearest list, or all others."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = index.lists_of()
        for b in batches:
            for start in range(0, len(b), BLOCK):
                part = b.slice(start, BLOCK)
                key, v, threshold = part.column(0).to_numpy(zero_copy_only=False), _unpacked(part.column(1), kind), part.column(2).to_numpy(zero_copy_only=False)
                order, probes = index.ranked(index.rotate(v))
                place = np.empty_like(order)
                np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], axis=1)
                probed, near = place < probes[:, None], order[:, 0]
                home, last = index.parts[near], index.parts[near] + index.shards[near]
                for k, own in lists.items():
                    at_home = (home <= k) & (k < last)
                    wanted = probed[:, own]
                    of = np.flatnonzero(wanted.any(axis=1) & (at_home == first))
                    if len(of):
                        n = len(of)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, k), pa.int32()), pa.array(key[of] % shares, pa.int32()), pa.nulls(n, pa.int32()), pa.array(key[of]), pa.nulls(n, pa.int64()),
                             pa.array(threshold[of]), _packed(np.packbits(wanted[of], axis=1)), _packed(v[of])],
                            names=["part", "share", "list", "key", "least", "threshold", "wanted", "vector"])

    return queries.select("key", "v", "threshold").mapInArrow(probe, DEALT)


def surviving(q: list[np.ndarray], x: list[np.ndarray], limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, vector, squared distance) of the pairs that no test abandons, and the number of dimensions in which pairs
    not yet abandoned were compared.

    q and x are column blocks; ``limit`` is every query's squared threshold.  While many pairs are left, whole blocks are
    multiplied, which costs less than to pick the pairs.
    """
    d, t = sum(b.shape[1] for b in x), 0
    allowed = lambda t: limit * ((1 + EPSILON / math.sqrt(t)) ** 2 * t / d if t < d else 1.0) + SLACK
    partial, stays, left, read = None, None, len(limit) * len(x[0]), 0
    at = 0
    while at < len(x) and (at == 0 or left > DENSE * partial.size):
        qb, xb = q[at], x[at]
        squares = lambda m: (m * m).sum(1)[:, None]
        one = lambda m: np.ones((len(m), 1), m.dtype)
        gap = np.concatenate([-2 * qb, squares(qb), one(qb)], axis=1) @ np.concatenate([xb, one(xb), squares(xb)], axis=1).T
        partial = gap if at == 0 else np.add(partial, gap, out=partial)
        at, t, read = at + 1, t + xb.shape[1], read + left * xb.shape[1]
        within = partial <= allowed(t).astype(partial.dtype)[:, None]
        stays = within if stays is None else np.logical_and(stays, within, out=stays)
        left = int(np.count_nonzero(stays))
    at_q, at_x = np.divmod(np.flatnonzero(stays), len(x[0]))
    partial = partial[at_q, at_x]
    for qb, xb in zip(q[at:], x[at:], strict=True):
        gap = qb[at_q] - xb[at_x]
        partial = partial + (gap * gap).sum(1)
        read, t = read + gap.size, t + xb.shape[1]
        keeps = partial <= allowed(t)[at_q]
        at_q, at_x, partial = at_q[keeps], at_x[keeps], partial[keeps]
    return at_q, at_x, partial, read


@dataclass
class _Block:
    """Vectors of one list, at most ``BLOCK``."""

    key: np.ndarray
    least: np.ndarray
    no_id: np.ndarray
    v: np.ndarray
    columns: list[np.ndarray]


def _scaled(v: np.ndarray) -> tuple[list[float], float]:
    """The vector times a power of two, and the sum of its squares: what ``cosine`` computes of either side."""
    v = v.astype(float)
    v = v * 2.0 ** -float(np.frexp(np.abs(v).max())[1])
    return v.tolist(), math.fsum((v * v).tolist())


def _blocks(rows: pa.Table, index: Index, kind: np.dtype) -> dict[int, list[_Block]]:
    """The blocks of every list of a part."""
    d = len(index.rotation)
    rows = rows.combine_chunks()
    column = lambda name: rows[name].chunk(0)
    one, key, least = column("list").to_numpy(), column("key").to_numpy(), column("least")
    no_id, least = least.is_null().to_numpy(zero_copy_only=False), least.fill_null(0).to_numpy()
    v = _unpacked(column("vector"), kind)
    by_list = np.lexsort((key, one))
    cuts = np.flatnonzero(np.diff(one[by_list], prepend=-1, append=-1))
    out: dict[int, list[_Block]] = {}
    for start, stop in zip(cuts, cuts[1:]):
        for k in range(start, stop, BLOCK):
            own = by_list[k:min(k + BLOCK, stop)]
            columns = _column_blocks(_columns(index.rotate(v[own])), len(own), d)
            out.setdefault(int(one[own[0]]), []).append(_Block(key[own], least[own], no_id[own], v[own], columns))
    return out


FOUND = "q long, key long, least long, score double, own boolean"


def _search(q: np.ndarray, threshold: np.ndarray, wanted: np.ndarray, lists: np.ndarray, blocks: dict[int, list[_Block]], index: Index, top: int) -> list[tuple]:
    """(query, key, least, score, own) of the ``top + 1`` best classes of every query in one part, within its threshold."""
    n, d = len(q), len(index.rotation)
    y, limit = _column_blocks(_columns(index.rotate(q)), n, d), threshold.copy()
    best = np.full((n, top + 1), np.inf, np.float32)
    waiting, waits, scored = [], 0, {}  # (query, vector, distance, block) of candidates; (far, no id, least, key, own) by query
    sides: dict[int, tuple[list[float], float]] = {}

    def settle() -> None:
        """Exact scores of the candidates that may still be among the best; of these the ``top + 1`` best stay."""
        nonlocal waiting, waits
        for at_q, at_x, distance, block in waiting:
            near = distance <= best[at_q, top] + 2 * SLACK
            for i, j in zip(at_q[near].tolist(), at_x[near].tolist()):
                if i not in sides:
                    sides[i] = _scaled(q[i])
                (a, aa), (b, bb) = sides[i], _scaled(block.v[j])
                score = math.fsum(map(mul, a, b)) / math.sqrt(aa * bb)
                scored.setdefault(i, []).append((-score, bool(block.no_id[j]), int(block.least[j]), int(block.key[j]), a == b and bool((q[i] == block.v[j]).all())))
        for i, found in scored.items():
            scored[i] = sorted(found)[:top + 1]
        waiting, waits = [], 0

    for k, one in enumerate(lists.tolist()):
        rows = np.flatnonzero(wanted[:, k])
        own = [b[rows] for b in y] if len(rows) else []
        for block in blocks.get(one, []) if len(rows) else []:
            if np.isinf(limit[rows]).any() and len(block.key) > top:  # the best among a few vectors already bounds what can be a result
                seeds = sum((a * a).sum(1)[:, None] + (c[:64] * c[:64]).sum(1)[None, :] - 2 * (a @ c[:64].T) for a, c in zip(own, block.columns, strict=True))
                limit[rows] = np.minimum(limit[rows], np.partition(seeds, top, axis=1)[:, top] + SLACK)
            at_q, at_x, distance, _ = surviving(own, block.columns, limit[rows])
            if not len(at_q):
                continue
            order = np.lexsort((distance, at_q))
            at_q, at_x, distance = at_q[order], at_x[order], distance[order]
            rank = np.arange(len(at_q)) - np.searchsorted(at_q, at_q)
            few = rank <= top
            new = np.full((len(rows), top + 1), np.inf, np.float32)
            new[at_q[few], rank[few]] = distance[few]
            best[rows] = np.sort(np.concatenate([best[rows], new], axis=1), axis=1)[:, :top + 1]
            limit[rows] = np.minimum(limit[rows], best[rows, top] + SLACK)
            near = distance <= best[rows[at_q], top] + 2 * SLACK
            waiting.append((rows[at_q[near]], at_x[near], distance[near], block))
            waits += int(near.sum())
            if waits > WAITING:
                settle()
    settle()
    return [(i, *found) for i, own in scored.items() for found in own]


def _scan(dealt: DataFrame, index: Index, kind: np.dtype, top: int) -> DataFrame:
    """(q, key, least, score, own): of every part, each query's ``top + 1`` best classes within its threshold.

    Rows come by part and share, the index before the queries.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, place, held, blocks = index.lists_of(), None, [], {}
        for b in batches:
            at = np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)] + [b.column(2).is_valid().to_numpy(zero_copy_only=False)], axis=1)
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(b)] if len(b) else []
            for start, stop in zip(cuts, cuts[1:]):
                part, share, indexed = (int(c) for c in at[start])
                if (part, share) != place:
                    place, held, blocks = (part, share), [], {}
                own = b.slice(start, stop - start)
                if indexed:
                    held.append(own.select(["list", "key", "least", "vector"]))
                    continue
                if held:
                    blocks, held = _blocks(pa.Table.from_batches(held), index, kind), []
                for k in range(0, len(own), BLOCK):
                    some = own.slice(k, BLOCK)
                    key, n = some.column(3).to_numpy(), len(lists[part])
                    wanted = np.unpackbits(_unpacked(some.column(6), np.dtype(np.uint8)), axis=1, count=n).astype(bool)
                    found = _search(_unpacked(some.column(7), kind), some.column(5).to_numpy(), wanted, lists[part], blocks, index, top)
                    q, far, no_id, least, of, same = zip(*found) if found else [()] * 6
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[list(q)], pa.int64()), pa.array(of, pa.int64()), pa.array([None if no else i for no, i in zip(no_id, least)], pa.int64()),
                         pa.array([-f for f in far], pa.float64()), pa.array(same, pa.bool_())], names=["q", "key", "least", "score", "own"])

    return dealt.mapInArrow(scan, FOUND)


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("least"), "key")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top + 1).drop("place")


def nearest(rows: DataFrame, is_query: Column, top: int = 5, vector: str = "embedding", row_id: str = "vec_id") -> DataFrame:
    """(query_id, rank, <row_id>, score): the ``top`` rows nearest to each row for which ``is_query`` (over ``id``) holds."""
    raw, kind, d = vectors_of(rows, vector, row_id)
    scratch = Scratch(rows.sparkSession)
    classes = scratch.write(classes_of(packed(raw, kind, d), top))
    total = classes.count()
    if total == 0:
        return rows.sparkSession.createDataFrame([], f"query_id long, rank int, {row_id} long, score double")
    index = fit(classes, total, top, kind, d)
    placed = parquet(build(classes, index, kind))
    scratch.drop(classes)
    asking = packed(raw.where(is_query & F.col("id").isNotNull()), kind, d)
    asked = parquet(asking.select("v").distinct().select(F.monotonically_increasing_id().alias("key"), "v"))
    members = parquet(asking.join(asked, "v").select("id", F.col("key").alias("q")))
    shares = max(1, -(-asked.count() // ASKED))
    spread = lambda df: df.repartition(max(1, -(-total // (64 * BLOCK))), "key")
    each = F.explode(F.sequence(F.lit(0), F.lit(shares - 1))) if shares > 1 else F.lit(0)
    vectors = placed.select("part", each.alias("share"), "list", "key", F.col("ids")[0].alias("least"), F.lit(None).cast("double").alias("threshold"), F.lit(None).cast("binary").alias("wanted"), "vector")
    dealt = lambda queries, first: (vectors.unionByName(_probed(spread(queries), index, kind, shares, first)).repartition("part", "share")
                                    .sortWithinPartitions("part", "share", F.col("list").isNull()))
    search = lambda queries, first: _scan(dealt(queries, first), index, kind, top)

    home = parquet(_best(search(asked.withColumn("threshold", F.lit(float("inf"))), True), top))
    bound = home.groupBy("q").agg(F.when(F.count("*") > top, 2 - 2 * F.min("score")).otherwise(float("inf")).alias("threshold"))
    further = asked.join(bound.withColumnRenamed("q", "key"), "key", "left").withColumn("threshold", F.coalesce("threshold", F.lit(float("inf"))))
    best = _best(home.unionByName(search(further, False)), top)

    entries = best.join(placed.select("key", "ids"), "key").select("q", "own", "score", F.explode("ids").alias("id"))
    entry = F.struct((-F.col("score")).alias("far"), F.col("id").isNull().alias("no_id"), "id", "own")
    lists = entries.groupBy("q").agg(F.sort_array(F.collect_list(entry)).alias("near"))
    mine = F.array_position(F.transform("near", lambda e: F.coalesce(e["own"] & (e["id"] == F.col("query_id")), F.lit(False))), True)
    others = F.slice(F.filter("near", lambda e, k: k != F.col("mine") - 1), 1, top)
    return (members.withColumnRenamed("id", "query_id").join(lists, "q").withColumn("mine", mine)
            .select("query_id", F.posexplode(others).alias("k", "e"))
            .select("query_id", (F.col("k") + 1).cast("int").alias("rank"), F.col("e.id").alias(row_id), (-F.col("e.far")).alias("score")))
