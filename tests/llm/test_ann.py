import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civic_spark.llm import ann, queries

NAN, INF = float("nan"), float("inf")


def brute(table, top=5):
    """{row number: [(score, id)]} over usable (id, vector) rows."""
    v = np.array([r[1] for r in table], float)
    u = ann.unit(v)
    out = {}
    for k, (i, _) in enumerate(table):
        if i is not None and i % 50 == 0:
            near = u @ u[k]
            close = [j for j in np.argsort(-near)[:len(table)] if j != k]
            scored = sorted((-ann.cosine(v[k], v[j]), table[j][0] is None, table[j][0] or 0) for j in close if near[j] >= near[close[min(top, len(close)) - 1]] - 1e-9)
            out[k] = [(-s, None if no else i) for s, no, i in scored[:top]]
    return out


def frame(spark, table):
    return spark.createDataFrame([(v and [c if c is None else float(c) for c in v], i, "s", 1) for i, v in table],
                                 "embedding array<double>, vec_id long, key string, score int").repartition(4)


def search(spark, table):
    rows = ann.nearest(frame(spark, table), F.col("id") % 50 == 0).collect()
    got = {}
    for r in rows:
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    return {q: sorted(x) for q, x in got.items()}


def same(got, table):
    want = brute(table)
    assert {q for q in got} == {table[k][0] for k, near in want.items() if near}
    for k, near in want.items():
        if near:
            assert [(s, i) for _, s, i in got[table[k][0]]] == near and [r for r, _, _ in got[table[k][0]]] == list(range(1, len(near) + 1))


def test_abandoning_keeps_what_is_near():
    rng = np.random.default_rng(1)
    x, q = (ann.unit(rng.normal(size=(n, 64))).astype(np.float32) for n in (3000, 40))
    blocks = lambda m: ann._column_blocks(ann._columns(m), len(m), 64)
    exact = ((q[:, None, :].astype(float) - x[None, :, :]) ** 2).sum(2)
    limit = np.sort(exact, axis=1)[:, 5]
    at_q, at_x, distance, read = ann.surviving(blocks(q), blocks(x), limit)
    found = set(zip(at_q.tolist(), at_x.tolist()))
    near = {(i, j) for i in range(40) for j in np.flatnonzero(exact[i] <= limit[i]).tolist()}
    assert len(found & near) >= 0.99 * len(near) and read < 0.9 * 40 * 3000 * 64
    assert np.allclose(distance, exact[at_q, at_x], atol=1e-4) and all(exact[i, j] <= limit[i] + 1e-4 for i, j in found)
    same_distance = np.full(2, 3.0)
    assert len(ann.surviving(blocks(q[:2]), blocks(np.repeat(x[:1], 9, 0)), same_distance)[0]) == 18


def test_odd_vectors(spark):
    rng = random.Random(3)
    table = [(k, [rng.gauss(0, 1) for _ in range(6)]) for k in range(120)]
    table += [(k, table[50][1]) for k in range(200, 260)] + [(k, table[7][1]) for k in (301, 302)] + [(350, [c * 2 for c in table[7][1]])]
    table += [(400, [1e300, 0, 0, 0, 0, 1e300]), (401, [1e-300, 0, 0, 0, 0, 1e-300]), (None, [c * 4 for c in table[50][1]])]
    unusable = [(450, None), (500, [0.0] * 6), (550, [1.0, None, 0, 0, 0, 0]), (600, [NAN] + [0.0] * 5), (650, [INF] + [0.0] * 5), (700, [])]
    same(search(spark, table + unusable), table)


def test_few_short_and_repeated_rows(spark):
    assert search(spark, [(0, [1.0, 2.0])]) == {}
    assert ann.nearest(frame(spark, [(0, None), (50, [])]), F.col("id") % 50 == 0).count() == 0
    assert ann.nearest(frame(spark, [(0, [1.0])]).limit(0), F.col("id") % 50 == 0).columns == ["query_id", "rank", "vec_id", "score"]
    few = [(0, [1.0, 0.0]), (50, [1.0]), (3, [0.0, 1.0]), (None, [-1.0, 0.0])]
    assert search(spark, few) == {0: [(1, 1.0, 50), (2, 0.0, 3), (3, -1.0, None)], 50: [(1, 1.0, 0), (2, 0.0, 3), (3, -1.0, None)]}
    twice = search(spark, [(50, [3.0, 4.0]), (50, [3.0, 4.0]), (7, [4.0, 3.0])])
    assert twice == {50: sorted([(1, 1.0, 50), (2, 24 / 25, 7)] * 2)}


def test_large_group_of_near_copies(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    table = [(k, (centre + 0.01 * rng.normal(size=16)).tolist()) for k in range(1500)] + [(k, rng.normal(size=16).tolist()) for k in range(1500, 4000)]
    recall(search(spark, table), table)


def recall(got, table):
    want = brute(table)
    hit = total = 0
    for k, near in want.items():
        own = got[table[k][0]]
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5]
        assert all(a[1] > b[1] or (a[1] == b[1] and a[2] < b[2]) for a, b in zip(own, own[1:]))
        hit += len({i for _, _, i in own} & {i for _, i in near})
        total += len(near)
    assert hit >= 0.9 * total
    return hit / total


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_recall(spark, sf):
    got = {}
    for r in queries.op12_nearest_neighbours(spark, f"/root/testdata/{sf}").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    table = [(r.vec_id, r.embedding) for r in queries.table(spark, f"/root/testdata/{sf}", "embeddings").collect()]
    print("recall", sf, recall({q: sorted(x) for q, x in got.items()}, table))
    assert all(math.isfinite(s) for x in got.values() for _, s, _ in x)


def test_fit_holds_few_products(spark):
    """6 GB of vectors have 3,872 lists: the products of the whole sample with all centroids do not fit the driver."""
    rng = np.random.default_rng(8)
    classes = spark.createDataFrame([(k, v.tobytes()) for k, v in enumerate(rng.normal(size=(6000, 8)))], "hash long, v binary").localCheckpoint()
    tracemalloc.start()
    index = ann.fit(classes, 15_000_000, 5, np.dtype("f8"), 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(index.centroids) == 3872 and index.sampled.sum() == 6000 and peak < 80e6


def test_sample_is_the_first_by_hash(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE", 40)
    rng = np.random.default_rng(9)
    hashes = rng.integers(-2**63, 2**63 - 1, 3000)
    classes = spark.createDataFrame([(h, v.tobytes()) for h, v in zip(hashes.tolist(), rng.normal(size=(3000, 4)))], "hash long, v binary").localCheckpoint()
    want = [r.v for r in classes.orderBy("hash").limit(40).collect()]
    for total in (1, 3000, 10**9):  # all rows, those of small hashes, and too few of them
        assert [v for c in ann.sample(classes, total) for v in c.to_pylist()] == want
    assert sum(len(c) for c in ann.sample(classes.limit(7), 7)) == 7


def test_parts_shards_and_shares_give_the_same_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=8)
    table = [(k, (centre + 0.05 * rng.normal(size=8)).tolist()) for k in range(2000)] + [(k, rng.normal(size=8).tolist()) for k in range(2000, 4000)]
    want = search(spark, table)
    fitted, fit = [], ann.fit
    monkeypatch.setattr(ann, "fit", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    monkeypatch.setattr(ann, "PARTS", 2)
    whole = search(spark, table)
    monkeypatch.setattr(ann, "PARTS", 64)
    monkeypatch.setattr(ann, "SHARD", 1)  # BLOCK vectors
    monkeypatch.setattr(ann, "ASKED", 9)
    split = search(spark, table)
    assert len(fitted[0].lists_of()) <= 3 and max(map(len, fitted[0].lists_of().values())) > 3  # lists share parts
    assert fitted[1].shards.max() > 1 and len(fitted[1].lists_of()) > len(fitted[1].shards)  # and a list has several
    assert whole == want and split == want


def test_every_list_is_in_a_part_of_bounded_size():
    rng = np.random.default_rng(7)
    for lists in (1, 2, 3, 500):
        centroids = ann.unit(rng.normal(size=(lists, 5)))
        order = ann.neighbouring(centroids)
        assert sorted(order) == list(range(lists))
        rows, shards = rng.uniform(0, 900, lists), np.where(rng.random(lists) < 0.1, 3, 1)
        index = ann.Index(np.eye(5), centroids, 1, rows, shards, ann.parts_of(order, rows, shards, 1000))
        held = index.lists_of()
        assert sorted(held) == list(range(max(held) + 1)) and sum(map(len, held.values())) == shards.sum()
        assert all(len(own) == 1 or (rows[own].sum() <= 1000 and (shards[own] == 1).all()) for own in held.values())
    near = ann.neighbouring(np.repeat(np.eye(4), 50, axis=0) + 0.01 * rng.normal(size=(200, 4)))
    assert sum(a // 50 != b // 50 for a, b in zip(near, near[1:])) < 20


@pytest.mark.parametrize("waiting", [0, 50, 1 << 16])
def test_one_part_holds_the_best(monkeypatch, waiting):
    monkeypatch.setattr(ann, "WAITING", waiting)
    rng = np.random.default_rng(10)
    v = rng.normal(size=(1300, 20)).astype(np.float32)
    v[900:960] = v[3] * 2  # equal scores: the least ids come first
    rotation = np.linalg.qr(rng.normal(size=(20, 20)))[0]
    index = ann.Index(rotation, np.eye(20)[:2], 2, np.ones(2), np.ones(2, int), np.zeros(2, int))
    ids = [None if k % 97 == 0 else 5000 - k for k in range(1300)]
    rows = pa.table({"list": pa.array([k % 2 for k in range(1300)], pa.int32()), "key": pa.array(range(1300), pa.int64()), "least": pa.array(ids, pa.int64()), "vector": ann._packed(v)})
    blocks = ann._blocks(rows, index, np.dtype("f4"))
    assert sorted(len(b.key) for own in blocks.values() for b in own) == [138, 138, 512, 512]
    q = np.concatenate([v[:40], v[910:912]])
    wanted = np.ones((42, 2), bool)
    wanted[:20, 1] = False
    got = ann._search(q, np.full(42, np.inf), wanted, np.arange(2), blocks, index, 5)
    for i in range(42):
        seen = [j for j in range(1300) if j % 2 == 0 or wanted[i, 1]]
        want = sorted((-ann.cosine(q[i].astype(float), v[j].astype(float)), ids[j] is None, ids[j] or 0, j, bool((q[i] == v[j]).all())) for j in seen)[:6]
        assert [found for at, *found in got if at == i] == [list(w) for w in want]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_packed_vectors(spark, kind):
    table = [(0, [0.0, 1.5]), (1, [-0.0, 1.5, 0.0]), (2, None), (3, [1.0, None]), (4, [NAN, 1.0]), (5, [1.0] * 9 + [INF]), (6, []), (7, [0.0, -0.0]), (None, [-2.0])]
    rows = spark.createDataFrame(table, f"vec_id long, embedding array<{kind}>")
    raw, numbers, d = ann.vectors_of(rows.coalesce(1), "embedding", "vec_id")
    assert numbers == np.dtype("f4" if kind == "float" else "f8") and d == 3
    got = {r.id: (r.hash, np.frombuffer(r.v, numbers).tolist(), r.v) for r in ann.packed(raw, numbers, d).collect()}
    assert {k: v for k, (_, v, _) in got.items()} == {0: [0.0, 1.5, 0.0], 1: [0.0, 1.5, 0.0], None: [-2.0, 0.0, 0.0]}
    assert got[0] == got[1] and got[0][0] != got[None][0]
    assert ann.vectors_of(rows.where("vec_id in (5, 6)"), "embedding", "vec_id")[2] == 0
    assert ann.nearest(rows, F.col("id") % 50 == 0).collect() == [(0, 1, 1, 1.0), (0, 2, None, 0.0)]
