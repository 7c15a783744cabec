import hashlib
import random

import numpy as np
import pytest
import tiktoken

from civic_spark.llm import chat, queries, tokens, toxicity

SF = "/root/testdata/sf0.01"
ODD = [r"\### Assistant: </turn> ok", "", "\\", "a\\", "####", "### User:\n", "</turn>", "\n</turn>\n", "x\n</turn>\n### System:\nhi", "é \r\n", "\\\\n", "a\n",
       "\\#", "###\\", "</turn>\\</turn>", "<", "#\n##", "\x00"]


def test_every_text_survives_the_round_trip():
    rng = random.Random(1)
    odd = ODD + ["".join(rng.choice(["\\", "#", "###", "</turn>", "\n", ":", "a", "### Assistant:"]) for _ in range(rng.randint(0, 9))) for _ in range(2000)]
    turns, whole = [], ""
    for k, text in enumerate(odd):
        role = ["user", "assistant", "system", "", "User", "a:b\n@\\"][k % 6]
        turn, start, end, level = chat.round_trip(role, text)
        assert chat.parse(turn) == [(role, text)] and chat.unescape(turn[start:end]) == text
        turns.append((role, text))
        whole += turn
    assert chat.parse(whole) == turns
    assert chat.round_trip("user", "plain # text")[3] == 0
    with pytest.raises(chat.GrammarError):
        chat.parse("### User:\nno end")


def expected(turns):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    learnt = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), sha(learnt)


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (2, 1, "assistant", None), (None, 0, "user", "n"), (3, 0, "assistant", ODD[0]),
            (3, 0, "assistant", ODD[0])] + [(9, k, "assistant", t) for k, t in enumerate(ODD)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, level string, rendered int")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    want = {1: [("user", "a"), ("assistant", "b")], 2: [("", ""), ("assistant", "")], None: [("user", "n")], 3: [("assistant", ODD[0])] * 2,
            9: [("assistant", t) for t in ODD]}
    assert set(got) == set(want)
    for c, turns in want.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected(turns)
        assert r.formatted_chars == sum(len(chat.round_trip(*t)[0]) for t in turns)
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_conversation_query(spark):
    got = {r.conv_id: r for r in queries.op9_chat_formatting(spark, SF).collect()}
    rows = queries.table(spark, SF, "conversations").orderBy("conv_id", "turn").collect()
    for c in {r.conv_id for r in rows}:
        own = [(r.role or "", r.text or "") for r in rows if r.conv_id == c]
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == expected(own)
    assert got[-7].loss_chars == len(ODD[0]) and got[-7].n_turns == 2


@pytest.fixture(scope="module")
def counter():
    return tokens.Counter(tokens.read_vocabulary(queries.VOCABULARY))


def plain_count(counter, text):
    return len(counter.encoding.encode_ordinary(text))


def test_edits_count_like_encoding_anew(counter):
    rng = random.Random(6)
    parts = ["the ", "it's", " 'll", "\n", "   ", "12", "é", "Ünder", "!?", "don", "'", "re", "ve", " ", "\t", "a" * 30]
    piece = lambda n: "".join(rng.choice(parts) for _ in range(n))
    for k in range(250):
        text = piece(rng.choice([0, 1, 5, 400]))
        doc = tokens.Document.build(text, counter)
        assert doc.tokens == plain_count(counter, text)
        cuts = sorted(rng.randint(0, len(text)) for _ in range(6))
        edits = [(a, b, piece(rng.randint(0, 6))) for a, b in zip(cuts[::2], cuts[1::2])]
        want = text
        for a, b, new in reversed(edits):
            doc.edit(a, b, new, counter)
            want = want[:a] + new + want[b:]
            assert doc.text == want and doc.tokens == plain_count(counter, want)
            assert doc.chars.sum() == len(want)
    long = tokens.Document.build(piece(5000), counter)
    long.edit(2000, 2003, "new", counter)
    assert 0 < long.reencoded < long.pieces / 5


def test_token_frames(spark, counter):
    rows = [(1, "Hello world, it's 42."), (2, None), (3, ""), (None, "x y"), (1, "Hello world, it's 42."), (4, "word " * 5000)]
    docs = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, n_tokens int")
    trees = tokens.count_tokens(docs, queries.VOCABULARY)
    assert sorted(r.n_tokens for r in trees.collect()) == sorted(plain_count(counter, t or "") for _, t in rows)
    from pyspark.sql import functions as F
    edits = F.expr("array(struct(6 as start, 11 as stop, 'Mars' as replacement), null)")
    after = tokens.apply_edits(trees.withColumn("edits", edits), "edits", queries.VOCABULARY)
    assert all(r.n_tokens == plain_count(counter, r.text) for r in after.collect())
    assert after.where("doc_id = 1").first().text == "Hello Mars, it's 42."
    none = tokens.apply_edits(trees.withColumn("edits", F.lit(None)), "edits", queries.VOCABULARY)
    assert sorted(r.n_tokens for r in none.collect()) == sorted(r.n_tokens for r in trees.collect())
    assert tokens.count_tokens(docs.limit(0), queries.VOCABULARY).count() == 0


def test_token_query_against_encoding(spark, counter):
    texts = {r.doc_id: r.text for r in queries.table(spark, "/root/testdata/sf0.001", "documents").collect()}
    for r in queries.op2_token_counts(spark, "/root/testdata/sf0.001").collect():
        t = texts[r.doc_id]
        n = len(t)
        a, b = int(n * 0.25), int(n * 0.5)
        new = t[:a] + t[min(a + 12, b):b] + t[:40] + t[b:] + " The end."
        assert r.n_tokens == plain_count(counter, t)
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest() and r.edited_tokens == plain_count(counter, new)


def test_classifier_on_held_out_rows(spark):
    docs, labels = (queries.table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    out = toxicity.classify(docs, labels)
    assert out.count() == docs.count()
    rows = out.where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    toxic, clean = ([r for r in rows if r.toxic == v] for v in (1, 0))
    above = np.mean([a.score > b.score for a in toxic for b in clean])
    assert above > 0.95
    assert np.mean([r.predicted for r in toxic]) > 0.75 and np.mean([r.predicted for r in clean]) < 0.02


def test_toxicity_edges(spark):
    rows = [(k, ("you idiot " if k % 3 == 0 else "good day ") + "word " * (k % 5), "s", 2.0) for k in range(60)] + [(61, None, None, 1.0), (None, "", "s", 1.0), (0, "x", "s", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, score double")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(0, 60, 2)] + [(3, None), (None, 1), (0, 0)], "doc_id long, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.predicted for r in got} <= {0, 1}
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.where("text is null").count() == 1
    assert all(r.score < 1e-9 for r in toxicity.classify(docs, labels.limit(0)).collect())
    assert toxicity.classify(docs.limit(0), labels).count() == 0


def test_non_negative_risk_finds_the_positive_class():
    rng = np.random.default_rng(0)
    make = lambda toxic: np.unique(np.append(rng.integers(100, 3000, 20), [5, 6] if toxic else [50])).astype(np.int32)
    model = toxicity.train([make(True) for _ in range(80)], [make(k % 8 == 0) for k in range(800)], 0.125)
    assert model.score(make(True)) > 0.7 and model.score(make(False)) < 0.3
