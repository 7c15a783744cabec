import corpus_pipeline
from civic_spark.llm import mixing, toxicity

from .brute import hit_words, near_components
from .test_native_ops import brute_lines

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, state = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        state[name] = (before, docs.collect())
        assert docs.columns[:len(columns)] == columns and (name == "source_mixing" or docs.columns == columns)
    before, after = state["toxicity"]
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.score(spark.read.parquet(f"{SF}/documents.parquet"), model).where("score >= 0.7").collect()}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - bad
    before, after = state["line_dedup"]
    assert {r.doc_id: r.text for r in after} == brute_lines([(r.doc_id, r.text) for r in before], 2, 200)
    assert all(r.n_chars == len(r.text) for r in after if dict((b.doc_id, b.text) for b in before)[r.doc_id] != r.text)
    before, after = state["minhash_near_dedup"]
    want = near_components([(r.doc_id, r.text) for r in before], 5)
    assert {r.doc_id for r in after} == {i for i, (_, c) in want.items() if i == c}
    before, after = state["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = hit_words([(r.doc_id, r.text) for r in before], items)
    assert {r.doc_id for r in after} == {i for i, (n, h, _) in hits.items() if not (h and 20 * h >= n)}
    before, after = state["source_mixing"]
    plan = {r.doc_id: r.copies for r in mixing.mixture(spark.createDataFrame(before)).collect()}
    counts = {}
    for r in after:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {i: n for i, n in plan.items() if n}


def test_run_returns_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy"] and out.count() > 0
