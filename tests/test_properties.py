"""Property tests: operators against a plain-Python model of R's rules,
on random small tables with NULLs (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civic_spark.functions import logic
from civic_spark.operators import aggregates as A
from civic_spark.operators import groups, scan, windows

ROWS = st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(-3, 3)),
                          st.one_of(st.none(), st.sampled_from(["R", "N", "A"]))), min_size=1, max_size=40)
CFG = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _df(spark, rows):
    return spark.createDataFrame([(i, k, v, f) for i, (k, v, f) in enumerate(rows)],
                                 "id int, k int, v int, f string")


def _groups(rows):
    g = {}
    for i, (k, v, f) in enumerate(rows):
        g.setdefault(k, []).append((i, v, f))
    return g


@CFG
@given(rows=ROWS)
def test_group_sums_match_r(spark, rows):
    out = {r["k"]: r for r in A.group_agg(_df(spark, rows), ["k"], {
        "p": A.sum_poison("v"), "s": A.sum_skip("v"), "nd": A.n_distinct("v"),
        "ci": A.count_if(F.col("f") == "R", poison=True)}).collect()}
    for k, items in _groups(rows).items():
        vs = [v for _, v, _ in items]
        fs = [f for _, _, f in items]
        assert out[k]["p"] == (None if None in vs else sum(vs))
        assert out[k]["s"] == sum(v for v in vs if v is not None)
        assert out[k]["nd"] == len(set(vs))
        assert out[k]["ci"] == (None if None in fs else sum(f == "R" for f in fs))


@CFG
@given(rows=ROWS)
def test_group_filters_match_r(spark, rows):
    df = _df(spark, rows)
    g = _groups(rows)
    keep_any = {k for k, it in g.items() if any(f == "R" for _, _, f in it)}
    drop_any = {k for k, it in g.items() if not any(f == "R" or f is None for _, _, f in it)}
    one = {k for k, it in g.items() if sum(f == "R" for _, _, f in it) == 1}
    single = {k for k, it in g.items() if len({f for _, _, f in it}) == 1}
    p = F.col("f") == "R"
    assert {r.k for r in groups.keep_groups_any(df, ["k"], p).collect()} == keep_any
    assert {r.k for r in groups.drop_groups_any(df, ["k"], p).collect()} == drop_any
    assert {r.k for r in groups.keep_groups_exactly_one(df, ["k"], p).collect()} == one
    assert {r.k for r in groups.keep_groups_single_value(df, ["k"], "f").collect()} == single


@CFG
@given(rows=ROWS)
def test_keep_first_and_running_sum_match_r(spark, rows):
    df = _df(spark, rows)
    got = {r.k: r.id for r in A.keep_first(df, ["k"], ["v", "id"]).collect()}
    run = {r.id: r.c for r in windows.running_sum(df, ["k"], ["id"], F.col("v"), "c").collect()}
    for k, items in _groups(rows).items():
        # R arrange puts NA last
        first = sorted(items, key=lambda t: (t[1] is None, t[1] if t[1] is not None else 0, t[0]))[0][0]
        assert got[k] == first
        total, poisoned = 0, False
        for i, v, _ in sorted(items):
            poisoned = poisoned or v is None
            total += 0 if v is None else v
            assert run[i] == (None if poisoned else total)


@CFG
@given(vals=st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c"])), min_size=1, max_size=20))
def test_if_else_and_not_in_match_r(spark, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    out = {r.i: r for r in df.select("i", logic.if_else(F.col("v") == "a", 1, 0).alias("ie"),
                                     logic.not_in("v", ["a", "b"]).alias("ni")).collect()}
    for i, v in enumerate(vals):
        assert out[i]["ie"] == (None if v is None else int(v == "a"))
        assert out[i]["ni"] == (v not in ("a", "b"))


@CFG
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30), st.one_of(st.none(), st.integers(-5, 5))),
                     min_size=1, max_size=60, unique_by=lambda t: (t[0], t[1])))
def test_ordered_scan_equals_plain_windows(spark, rows):
    df = spark.createDataFrame([(k or None, t, v) for k, t, v in rows], "k int, t int, v int").repartition(3)
    order = ["-t"]
    b = scan.ordered_scan(df, ["k"], order, seq={"rn": -1}, sums={"s": (F.col("v"), False), "p": (F.col("v"), True)},
                          shifts={"lg": ("v", 1), "ld": ("v", -1)})
    a = windows.sequence_number(df, ["k"], order, "rn", -1).withColumn("rn", F.col("rn").cast("long"))
    a = windows.running_sum(a, ["k"], order, F.coalesce(F.col("v"), F.lit(0)), "s", poison=False)
    a = windows.running_sum(a, ["k"], order, F.col("v"), "p", poison=True)
    a = windows.lag_lead(a, ["k"], order, {"lg": ("v", 1), "ld": ("v", -1)})
    cols = ["k", "t", "rn", "s", "p", "lg", "ld"]
    got = sorted((tuple(r) for r in b.select(*cols).collect()), key=str)
    want = sorted((tuple(r) for r in a.select(*cols).collect()), key=str)
    assert got == want
