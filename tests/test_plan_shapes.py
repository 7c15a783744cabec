"""Physical-plan checks for the scale design."""

import re

from pyspark.sql import functions as F

from civic_spark.operators import aggregates as A
from civic_spark.operators import scan, windows

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_unpartitioned_window_or_cartesian_in_registered_queries(spark):
    from civic_spark.plans import driver_queries
    for name, fn in driver_queries.queries().items():
        if name.startswith(("m1", "m2", "s1", "stream")):
            continue
        p = _plan(fn(spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
        # Window [exprs], [partition keys], [order]: an empty key list means one task holds everything
        assert not re.search(r"\+- Window \[.*?\], \[\], \[", p), name


def test_per_group_limits_run_before_the_exchange(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    for df in (A.keep_first(li, ["l_orderkey"], ["l_linenumber"]),
               windows.top2_relative_gap(li, ["l_partkey"], "l_quantity", ["-l_quantity", "l_suppkey"], "g")):
        p = _plan(df)
        assert "WindowGroupLimit" in p and "Partial" in p


def test_hot_key_results_stay_whole(spark):
    # one key holds a third of the rows
    rows = [(0, i, float(i)) for i in range(3000)] + [(k, i, float(i)) for k in range(1, 2001) for i in range(3)]
    df = spark.createDataFrame(rows, "k int, i int, v double")
    first = {r.k: r.i for r in A.keep_first(df, ["k"], ["-v", "i"]).collect()}
    assert first[0] == 2999 and len(first) == 2001
    run = scan.ordered_scan(df, ["k"], ["i"], sums={"r": (F.col("v"), True)}).filter("k = 0")
    assert run.agg(F.max("r")).collect()[0][0] == sum(range(3000))


def test_chamber_and_marginal_seat_shuffle_the_election_table_once(spark):
    import tempfile

    from civic_spark.plans import candidate, chamber, coalition, election, marginal_seat, votes
    from tests import election_world as W
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = W.frames(spark)
        coal = coalition.build(f["coalition"])
        elec = election.build([votes.build(f["votes"], coal, f["dim"], level="local")],
                              candidate.build(f["candidate"], coal, f["dim"], supplementary_max_rows=1))
        path = tempfile.mkdtemp(prefix="civic-plan-") + "/election"
        elec.write.parquet(path)
        e = spark.read.parquet(path)
        for df, extra in ((chamber.build(e, strategy="window"), 1), (marginal_seat.build(e, strategy="window"), 0)):
            ex = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(df))
            big = [x for x in ex if x.startswith("cod_ibge_6")]
            assert len(big) == 1 and len(ex) == 1 + extra, ex
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def _shuffle_plan(spark, name):
    """Plan of a registered query as between large tables: no broadcast, before AQE."""
    from civic_spark.plans import driver_queries
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        return _plan(driver_queries.queries()[name](spark, SF))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_group_flags_and_values_take_two_exchanges(spark):
    for name in ("f7_keep_orders_any_returned", "f8_orders_single_linestatus", "f9_drop_orders_any_returned_null",
                 "f10_orders_exactly_one_returned", "w1_line_share_of_order", "a14_fill_first_priority"):
        assert _shuffle_plan(spark, name).count("Exchange hashpartitioning") == 2, name
    assert _shuffle_plan(spark, "a7_a8_a11_order_line_stats").count("Exchange hashpartitioning") == 1


def test_flagship_limits_groups_before_the_exchange(spark):
    assert "WindowGroupLimit" in _shuffle_plan(spark, "w7_a19_supplier_concentration")


def test_no_ordered_window_holds_an_unsplit_key(spark):
    """Numbers, running sums, neighbours, limits and positions window over (partition, key) only."""
    for name in ("w3_w4_w5_customer_order_sequence", "w4_event_running_sums", "w9_w10_a24_last_two_lines", "o1_o2_sorted_customers",
                 "o3_sort_within_orders", "w2_w8_f10_first_line_and_returned_part"):
        for functions, keys in re.findall(r"\+- Window \[(.*?)\], \[([^\]]*)\]", _shuffle_plan(spark, name)):
            # windows by key alone run over the carries, two rows per partition
            assert "__part" in keys or "__part" in functions, (name, keys)


def test_two_tier_lookup_shuffles_each_side_once(spark):
    plan = _shuffle_plan(spark, "j5_j6_two_tier_lookup")
    # the price table grouped once (reused for both tiers), lookup and rows once each
    assert len(set(re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan))) == 3
    assert not re.search(r"Exchange hashpartitioning\(p_type", plan)
    assert re.search(r"Exchange hashpartitioning\(__tier#\d+, __share", plan)
