import random

import pytest
from pyspark.sql import functions as F

from civic_spark.llm import minhash, suffix_dedup
from civic_spark.llm.shared import connected_components, global_rank

from .brute import near_components, without_repeats


def texts(seed: int = 3) -> list[tuple]:
    """Copies, near copies, shared passages, short and odd texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base, passage = prose(90), prose(60)
    rows = [(1, base), (2, base), (3, base.upper()), (9, None), (10, ""), (11, " \t\n"), (12, "One two"), (13, "one TWO"), (14, "a b c d"),
            (15, "a b c d e"), (16, "x" * 450), (17, "ab" * 300), (18, prose(15) + " " + passage), (19, passage + prose(20)), (20, prose(200))]
    for k in range(21, 60):
        w = base.split(" ")
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = word()
        rows.append((k, " ".join(w)))
    rows += [(k, prose(5) + "\n" + passage + "\n" + prose(5)) for k in range(60, 75)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 5, "y") for i, t in rows], "doc_id long, text string, key string, bands int, gid string")


def test_near_duplicates_equal_all_pairs(spark):
    rows = texts()
    for size in (4, 5):
        got = minhash.near_duplicates(frame(spark, rows), shingle_words=size).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_components(rows, size)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_edges(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "q r s t u"), (2, "a b c d e f")]
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == 5
    assert {(r.doc_id, r.component_id, r.kept) for r in got if r.doc_id != 2} == {(None, None, True), (1, 1, True)}
    assert {r.component_id for r in got if r.doc_id == 2} <= {1, 2}
    kept = minhash.drop_near_duplicates(frame(spark, [(3, "a b c d e f"), (4, "a b c d e f"), (5, None)]))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5]
    assert kept.columns == ["doc_id", "text", "key", "bands", "gid"]
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


def test_drop_keeps_one_row_per_component(spark):
    a, b, near = "a b c d e f", "q r s t u", " ".join(f"w{k}" for k in range(40))
    ids = lambda rows: sorted(((r.doc_id, r.text) for r in minhash.drop_near_duplicates(frame(spark, rows)).collect()), key=str)
    assert ids([(1, a), (1, a), (1, a), (7, b)]) == [(1, a), (7, b)]
    assert ids([(1, a), (2, a), (2, b)]) == [(1, a), (2, b)]
    assert len(ids([(1, a), (1, b), (1, near), (1, near + " x")])) == 3
    assert ids([(None, a), (None, a), (None, a.upper()), (None, b), (5, b)])[0] == (5, b)
    assert len(ids([(None, a), (None, a), (None, a.upper()), (None, b), (5, b)])) == 2
    assert ids([(None, near), (None, near + " x"), (3, near + " y")]) == [(3, near + " y")]
    assert ids([(None, None), (None, None), (4, " "), (4, " ")]) == [(4, " "), (4, " "), (None, None), (None, None)]


def test_drop_chooses_among_rows_of_one_text_by_their_columns(spark):
    rows = [(1, "a b c d e f", source) for source in ("web", "books", "code")] + [(2, "a b c d e f", "a"), (3, "z", "web")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3, "source")
    assert sorted(minhash.drop_near_duplicates(docs).collect()) == [(1, "a b c d e f", "books"), (3, "z", "web")]


def test_signature_agreement_is_similarity():
    import numpy as np
    rng = np.random.default_rng(1)
    for n in (6, 40, 900):
        shares = []
        for _ in range(60):
            pool = rng.integers(0, 2 ** 63, size=n + n // 2, dtype=np.uint64)
            a, b = np.unique(pool[:n]), np.unique(pool[n // 2:])
            shares.append((minhash.signature(a) == minhash.signature(b)).mean())
        assert abs(np.mean(shares) - (n - n // 2) / (n + n // 2)) < 0.06


@pytest.mark.parametrize("most", [64, 2])
def test_repeated_substrings_against_windows(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    rows = texts(5) + [(20, "again"), (None, "z" * 500)]
    got = suffix_dedup.dedup_substrings(frame(spark, rows)).withColumn("sha", F.sha2("kept", 256)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[4])
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in got), key=key) == sorted(without_repeats(rows), key=key)


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "q" * 199), (1, "q" * 199), (2, "w" * 100 + "v" * 150), (2, "w" * 100 + "v" * 150)]
    got = suffix_dedup.dedup_substrings(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, 250), (2, 250)]
    assert suffix_dedup.dedup_substrings(frame(spark, [])).count() == 0


def test_long_text_is_cut_in_segments(monkeypatch):
    import numpy as np
    rng = random.Random(2)
    text = np.frombuffer("".join(rng.choice("abc d") for _ in range(5000)).encode(), np.uint8)
    whole = suffix_dedup.anchors(text)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    assert all(np.array_equal(a, b) for a, b in zip(whole, suffix_dedup.anchors(text)))


def test_components_and_ranks(spark):
    rng = random.Random(4)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)]
    root = {x: x for p in links for x in p if p[0] != p[1]}
    for _ in root:
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = connected_components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r.node: r.component for r in got} == root and len(got) == len(root)
    values = spark.createDataFrame([(k * 7 % 100, k % 5) for k in range(100)], "v int, w int")
    weights = {r.v: r.w for r in values.collect()}
    ranked = global_rank(values.repartition(7), ["v"], weight=F.col("w")).collect()
    assert all(r["rank"] == sum(w for v, w in weights.items() if v < r.v) for r in ranked)
