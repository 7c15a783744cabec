import bisect
import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from civic_spark.llm import decontaminate, fingerprints, line_dedup, mixing, queries, warc

from .brute import generalised_jaccard, hit_words

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    norm = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    want = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    key = lambda r: [str(x) for x in r]
    assert sorted((tuple(norm(r[c]) for c in cols) for r in got.collect()), key=key) == sorted((tuple(map(norm, r)) for r in want), key=key)


def test_native_plans_hold_no_python(spark):
    for name in ("op6_source_mixing", "op10_line_dedup", "op7_benchmark_decontamination"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_mixing_edges(spark):
    schema = "doc_id long, text string, source string, copy int, rate string, size int"
    rows = [(1, "a b c", "s", 1, "r", 9), (2, None, None, 1, "r", 9), (3, "", "t", 1, "r", 9), (4, "x y", None, 1, "r", 9), (4, "x y", None, 1, "r", 9)]
    got = mixing.mixture(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 5 and all(0 <= r.taken <= 3 * r.size for r in got)
    by_source = {r.doc_id: (r.source_size, r.target) for r in got}
    assert by_source[1][0] == 3 and by_source[3] == (0, 0.0) and by_source[4][0] == 4
    out = mixing.mix(spark.createDataFrame(rows, schema))
    assert sorted(out.columns) == sorted(["doc_id", "text", "source", "rate", "size", "copy"])
    copies = {r.doc_id: r.copies for r in got}
    assert {i: out.where(F.col("doc_id") == i).count() for i in (1, 3)} == {i: copies[i] for i in (1, 3)}
    assert mixing.mixture(spark.createDataFrame([], schema)).count() == 0


def test_mixture_comes_near_its_targets(spark):
    rows = [(k, " ".join(["w"] * (1 + k % 7)), f"s{k % 4}") for k in range(8000)]
    got = mixing.mixture(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy(F.col("doc_id") % 4).agg(F.sum("taken").alias("t"), F.max("target").alias("target"))
    assert all(abs(r.t - r.target) < 0.06 * r.target for r in got.collect())


def brute_lines(rows, min_lines, min_chars):
    """Texts without lines of windows that stand earlier."""
    own = [(i, t, [(k, x) for k, x in enumerate(t.split("\n")) if x.strip()]) for i, t in sorted(rows)]
    seen, gone = set(), {i: set() for i, _ in rows}
    for i, _, lines in own:
        for s in range(len(lines)):
            for n in (1, min_lines):
                window = tuple(x for _, x in lines[s:s + n])
                if len(window) == n and (n == min_lines or len(window[0]) >= min_chars):
                    if window in seen:
                        gone[i] |= {k for k, _ in lines[s:s + n]}
                    seen.add(window)
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in rows}


@pytest.mark.parametrize("min_lines", [2, 3, 5])
def test_line_dedup_against_windows(spark, min_lines):
    rng = random.Random(min_lines)
    rows = [(k, "\n".join(rng.choice(["a", "b", "c", "", "a long line", " "]) for _ in range(rng.randint(1, 25)))) for k in range(40)]
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, lines int, rank string")
    got = line_dedup.dedup_lines(docs, min_lines=min_lines, min_chars=8)
    assert {r.doc_id: r["__text"] for r in got.collect()} == brute_lines(rows, min_lines, 8)


def test_line_dedup_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "p\nq"), (3, "p\nq"), (4, "p\nq\nr"), (None, "p\nq")], "doc_id long, text string")
    got = sorted(((r.doc_id, r["__text"], r["__n_removed"]) for r in line_dedup.dedup_lines(docs).collect()), key=str)
    assert got == sorted([(1, None, 0), (2, "", 0), (3, "", 2), (3, "", 2), (4, "r", 2), (None, "p\nq", 0)], key=str)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_decontamination_against_windows(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(["Ab", "cé", "x1", "the", "zz"]) + rng.choice(["", "", "q", ","]) for _ in range(n))
    items = [(1, prose(20)), (2, prose(14)), (3, "Short one"), (4, "..."), (5, None), (6, "the the the the"), (7, "Short ONE")]
    docs = [(k, prose(rng.randint(0, 60))) for k in range(20)]
    docs += [(30, prose(9) + " " + items[0][1] + " " + prose(200)), (31, "a " + items[1][1].upper()), (32, None), (33, "the " * 12), (34, "say: short-one!"),
             (35, " ".join(items[0][1].split()[3:17]))]
    want = hit_words(docs, items)
    d = spark.createDataFrame([(i, t, 0, "c") for i, t in docs], "doc_id long, text string, pos int, class string")
    b = spark.createDataFrame([(i, t, 0, "c") for i, t in items], "item_id long, text string, n int, term string")
    got = {r.doc_id: r for r in decontaminate.contamination(d, b).collect()}
    for i, (n, hit, ids) in want.items():
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()), i
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
    kept = decontaminate.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (n, hit, _) in want.items() if not (hit and 20 * hit >= n)}
    assert decontaminate.contamination(d.limit(0), b).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(d, b.limit(0)).collect())


def test_proximity(spark):
    d = spark.createDataFrame([(1, "x red y blue z"), (2, "blue a b c d red"), (3, "red red")], "doc_id long, text string")
    b = spark.createDataFrame([(7, "Red blue")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.start) for r in decontaminate.proximity_matches(d, b, 4).collect()}
    assert got == {(1, "7", 1)}


def test_fingerprints(spark):
    rng = random.Random(8)
    prose = lambda n: " ".join(rng.choice("abcdefgh") + rng.choice("abcdefghijkl") for _ in range(n))
    rows = [(k, prose(rng.randint(20, 90))) for k in range(0, 120, 2)] + [(200, None), (201, ""), (202, "ä ö"), (203, "ä ö")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, term string")
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs).collect()}
    assert len(got) == len(rows)
    near, true = [], []
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        near += [r.near_edited, r.near_next]
        true += [generalised_jaccard(t, edited), generalised_jaccard(t, after)]
    assert got[202].fingerprint == got[203].fingerprint and got[202].near_next == 1.0
    gap = [a - b for a, b in zip(near, true)]
    assert abs(sum(gap) / len(gap)) < 0.03 and sum(x * x for x in gap) / len(gap) < 0.09 ** 2
    again = spark.createDataFrame([(1, "p q r s"), (1, "p q r s"), (2, "t u"), (None, "v")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in fingerprints.edited_fingerprints(again).collect()) == ["1", "1", "2", "None"]
    assert fingerprints.edited_fingerprints(again.limit(0)).count() == 0


def test_fingerprints_keep_64_samples(spark):
    docs = spark.createDataFrame([(1, "p q r s"), (2, None)], "doc_id long, text string")
    rows = fingerprints.edited_fingerprints(docs).collect()
    assert len(rows) == 2 and all(len(r.fingerprint) >= 64 * 4 and len(r.edited_fingerprint) >= 64 * 4 for r in rows)


def test_merkle_audit(spark):
    rows = [(k, f"u{k}", "h" * (k % 9)) for k in range(300)] + [(5, "u5", "other"), (None, None, None), (7, "u7", "h" * 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    own = warc.archive(pages)
    out = sorted((r.offset, r.length) for r in own.collect())
    assert out[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(out, out[1:]))
    bad = own.withColumn("digest", F.when(F.col("seq").isin(0, 130, 302), F.lit("x")).otherwise(F.col("digest"))).where("seq <> 77")
    got = {(r.seq, r.status) for r in warc.audit(own, bad, fanout=4).collect()}
    assert got == {(0, "corrupt"), (130, "corrupt"), (302, "corrupt"), (77, "missing")}
    assert warc.audit(own, own, fanout=4).count() == 0
    assert warc.drill(pages.limit(0)).count() == 0


@pytest.mark.parametrize("min_lines", [2, 3, 4])
def test_repeated_runs_against_windows(spark, min_lines):
    rng = random.Random(20 + min_lines)
    texts = [[rng.choice("abcd") for _ in range(rng.randint(0, 30))] for _ in range(25)]
    texts += [texts[3] * 3, texts[5], texts[5], ["u1", "u2"], list("abcabcabc" * 6)]
    docs = spark.createDataFrame([(k, "\n".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    places = {}
    for k, t in enumerate(texts):
        for s in range(len(t) - min_lines + 1):
            places.setdefault(tuple(t[s:s + min_lines]), []).append((k, s))
    later = {p: (v[0], len(v)) for v in places.values() for p in v[1:]}
    want = set()
    for (k, s), (head, n) in later.items():
        if (k, s - 1) not in later:
            size = next(j for j in range(1, 1000) if (k, s + j) not in later)
            want.add((k, s, size + min_lines - 1, *head, n))
    got = line_dedup.repeated_runs(docs, min_lines).collect()
    assert {(r.doc, r.seq, r.n_lines, r.first_doc, r.first_seq, r.copies) for r in got} == want and len(got) == len(want)


def test_suffix_array_and_common_prefixes(spark):
    rng = random.Random(4)
    texts = [[rng.choice("ab") for _ in range(rng.randint(1, 14))] for _ in range(9)] + [list("ab" * 9)] * 2
    docs = spark.createDataFrame([(k, "\n".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    scratch = line_dedup.Scratch(spark)
    first, total = line_dedup._suffixes(line_dedup.line_sequences(docs), scratch)
    places, levels = line_dedup._array(first, total, scratch)
    rows = places.collect()
    # The order of lines is that of their hashes.
    by_line = {texts[r.doc][r.seq]: r.rank for r in first.collect()}
    suffix = {(k, s): tuple(by_line[x] for x in t[s:]) for k, t in enumerate(texts) for s in range(len(t))}
    order = sorted(suffix.values())
    assert total == len(rows) == len(order)
    assert all(r.rank == order.index(suffix[r.doc, r.seq]) and r.n == order.count(suffix[r.doc, r.seq]) for r in rows)
    groups = places.groupBy("rank").agg(F.min(F.struct(*line_dedup.PLACE)).alias("first"), F.count("*").alias("n"), F.max("rest").alias("rest"))
    got = {r.rank: r.lcp for r in line_dedup._common(groups, levels, 2, scratch).collect()}
    share = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    parts = sorted(set(order))
    want = {order.index(a): share(a, b) for a, b in zip(parts, parts[1:]) if share(a, b) >= 2}
    assert got == want


def test_frequent_lines_are_dealt(spark):
    """One line holds most places: its rows go to many tasks, and the result is that of plain windows."""
    rows = [(k, f"common\ncommon\nown {k}\ncommon\nx {k % 3}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = line_dedup.line_sequences(docs)
    names = lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
    out = line_dedup._joined(lines.select(*line_dedup.PLACE, "a", "b"), names, ["a", "b"], 1200)
    assert out.count() == 1200
    assert {r.doc_id: r["__text"] for r in line_dedup.dedup_lines(docs).collect()} == brute_lines(rows, 2, 200)


def test_long_runs_take_few_rounds_and_jobs(spark):
    """Exchanges cost the driver memory however few the rows: a repeated run of 150 lines takes three rounds, not eight."""
    rng = random.Random(11)
    run = [rng.choice("abcdefgh") for _ in range(150)]
    texts = [run, run[:70] + ["own 1"] + run[70:], ["b"] * 90, run[:65] + run[:66], ["b"] * 37 + ["own 2"] + ["b"] * 38, run[3:140]]
    rows = [(k, "\n".join(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scratch = line_dedup.Scratch(spark)
    first, total = line_dedup._suffixes(line_dedup.line_sequences(docs), scratch)
    places, levels = line_dedup._array(first, total, scratch)
    assert len(levels) <= 4
    by_line = {texts[r.doc][r.seq]: r.rank for r in first.collect()}
    suffix = {}
    for r in places.collect():
        suffix[r.doc, r.seq] = (tuple(by_line[x] for x in texts[r.doc][r.seq:r.seq + r.rest]), r.rank, r.n)
    order = sorted(s for s, _, _ in suffix.values())
    assert len(order) == total
    assert all(rank == bisect.bisect_left(order, s) and n == bisect.bisect_right(order, s) - rank for s, rank, n in suffix.values())
    groups = places.groupBy("rank").agg(F.min(F.struct(*line_dedup.PLACE)).alias("first"), F.count("*").alias("n"), F.max("rest").alias("rest"))
    share = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    parts = sorted(set(order))
    for min_lines in (2, 9):
        want = {bisect.bisect_left(order, a): share(a, b) for a, b in zip(parts, parts[1:]) if share(a, b) >= min_lines}
        assert {r.rank: r.lcp for r in line_dedup._common(groups, levels, min_lines, scratch).collect()} == want
    sc = spark.sparkContext
    sc.setJobGroup("long-runs", "line dedup of long runs")
    try:
        got = {r.doc_id: r["__text"] for r in line_dedup.dedup_lines(docs).collect()}
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description"):
            sc.setLocalProperty(key, None)
    assert got == brute_lines(rows, 2, 200)
    assert 0 < len(sc.statusTracker().getJobIdsForGroup("long-runs")) <= 130
