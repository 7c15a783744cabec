"""Scalar helpers with R semantics (micro-fixtures with NULLs, accents, ties)."""

from pyspark.sql import functions as F

from civic_spark.functions import clean, logic, text


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_fold_accents_every_mapped_letter(spark):
    src = text.FOLD_FROM + "".join(s for s, _ in text.FOLD_MULTI)
    want = text.FOLD_TO + "".join(d for _, d in text.FOLD_MULTI)
    assert one(spark, text.fold_accents("s"), [(src,)], "s string") == [want]
    assert one(spark, text.fold_lower("s"), [("JOSÉ SÃO 2º TURNO",), (None,)], "s string") == \
        ["jose sao 2o turno", None]


def test_fold_reaches_beyond_latin_1(spark):
    cases = {"āčłńőşțžŭỳẽ": "acłnostzuye".replace("ł", "l"), "“Łódź” – it’s…": '"Lodz" - it\'s...', "e\u0301 n\u0303 1\u0302": "e n 1",
             "Đorđe ŉ Ĳssel": "Dorde 'n IJssel", "ελ й": "ελ й", "Việt Nam": "Viet Nam", "": "", "plain": "plain"}
    got = one(spark, text.fold_accents("s"), [(k,) for k in cases], "s string")
    assert got == list(cases.values())
    assert one(spark, text.fold_accents("s"), [(None,)], "s string") == [None]


def test_fold_sql_agrees(spark):
    import duckdb
    letters = [chr(c) for first, last in text.FOLD_BLOCKS for c in range(first, last + 1) if chr(c).isalpha()]
    got = one(spark, text.fold_accents("s"), [(c,) for c in letters], "s string")
    want = duckdb.execute(f"SELECT {text.fold_accents_sql('s')} FROM (SELECT unnest(?) AS s)", [letters]).fetchall()
    # letters whose base is no ASCII letter (hooks, digraphs) keep it here and lose only a further accent there
    assert [(c, g, w[0]) for c, g, w in zip(letters, got, want) if g.isascii() != w[0].isascii() or (g.isascii() and g != w[0])] == []


def test_pad_left_never_truncates(spark):
    got = one(spark, text.pad_left("s", 5), [("1234567",), ("12",), (None,), ("",)], "s string")
    assert got == ["1234567", "00012", None, "00000"]
    got = one(spark, text.pad_left_digits("s", 5), [("sp",), ("123",)], "s string")
    assert got == ["sp", "00123"]


def test_if_else_null_condition_gives_null(spark):
    got = one(spark, logic.if_else(F.col("b"), 1, 0), [(True,), (False,), (None,)], "b boolean")
    assert got == [1, 0, None]


def test_case_when_null_falls_through(spark):
    e = logic.case_when((F.col("x") > 1, "big"), default="other")
    assert one(spark, e, [(5,), (0,), (None,)], "x int") == ["big", "other", "other"]


def test_not_in_keeps_null(spark):
    got = one(spark, logic.not_in("s", ["a"]), [("a",), ("b",), (None,)], "s string")
    assert got == [False, True, True]


def test_parse_dmy_separators_and_bad(spark):
    got = one(spark, F.date_format(logic.parse_dmy("s"), "yyyy-MM-dd"),
              [("03/10/1998",), ("3-1-2004",), ("31/02/2001",), ("",), (None,)], "s string")
    assert got == ["1998-10-03", "2004-01-03", None, None, None]


def test_paste0_na_text(spark):
    e = text.paste0(F.lit("19"), text.tail("d", 2), na_text="NA")
    assert one(spark, e, [("01/02/1965",), (None,)], "d string") == ["1965", "19NA"]


def test_detect_word_and_token(spark):
    rows = [("pt do b / psdb", "pt"), ("pt / psdb", "pt"), (None, "pt")]
    assert one(spark, text.detect_word("c", "p", "word"), rows, "c string, p string") == [True, True, None]
    assert one(spark, text.detect_word("c", "p", "token"), rows, "c string, p string") == [False, True, None]


def test_list_length_null_is_one(spark):
    assert one(spark, text.list_length("c"), [("a/b/c",), (None,)], "c string") == [3, 1]


def test_replace_first_only(spark):
    assert one(spark, text.replace_first("s", "[0-9]+", "N"), [("a12b34",)], "s string") == ["aNb34"]


def test_na_sentinels_and_rotation(spark):
    df = spark.createDataFrame([("#NE#", "x", "2014"), ("", "#NULO#", "2010"), ("ok", "y", "2014")],
                               "a string, b string, y string")
    out = clean.na_sentinels(df).collect()
    assert [tuple(r) for r in out] == [(None, "x", "2014"), (None, None, "2010"), ("ok", "y", "2014")]
    rot = clean.rotate_when(df, F.col("y") == "2014", {"a": "b", "b": "a"}).collect()
    assert [tuple(r) for r in rot] == [("x", "#NE#", "2014"), ("", "#NULO#", "2010"), ("y", "ok", "2014")]


def test_normalise_header():
    assert text.normalise_name('"Número do  Recibo"') == "numero_do_recibo"
    assert text.normalise_name("DR.DS_TITULO") == "dr_ds_titulo"


def test_leading_then_sorted(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "d int, b int, a int, c int")
    assert clean.leading_then_sorted(df, "c").columns == ["c", "a", "b", "d"]


def test_size_shuffle_partitions(spark):
    from civic_spark.session import size_shuffle_partitions
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffle_partitions(spark, 100 * 1024 ** 4) == 409600
        assert size_shuffle_partitions(spark, 10, minimum=4) == 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
