"""The segmented scan against plain windows, with one key over all partitions."""

import pytest
from pyspark.sql import functions as F

from civic_spark.operators import scan, sorting, windows


@pytest.fixture(autouse=True)
def small_partitions(spark):
    """Small tables keep all their ranges, as large ones do."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def plain(df, order):
    a = windows.sequence_number(df, ["k"], order, "rn").withColumn("rn", F.col("rn").cast("long"))
    a = windows.running_sum(a, ["k"], order, F.coalesce(F.col("v"), F.lit(0)), "s", poison=False)
    a = windows.running_sum(a, ["k"], order, F.col("v"), "p", poison=True)
    a = windows.lag_lead(a, ["k"], order, {"lg": ("v", 1), "ld": ("v", -1), "name_before": ("name", 1)})
    return a.withColumn("end", F.count(F.lit(1)).over(windows._w(["k"])) - F.col("rn") + 1)


def scanned(df, order):
    return scan.ordered_scan(df, ["k"], order, seq={"rn": 0}, seq_from_end={"end": 0}, sums={"s": (F.col("v"), False), "p": (F.col("v"), True)},
                             shifts={"lg": ("v", 1), "ld": ("v", -1), "name_before": ("name", 1)})


def same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    assert sorted((tuple(r) for r in a.select(*cols).collect()), key=str) == sorted((tuple(r) for r in b.select(*cols).collect()), key=str)


@pytest.fixture(params=["one key", "hot key and null keys", "many keys", "empty"])
def table(request, spark):
    i = F.col("id")
    k = {"one key": F.lit(7), "hot key and null keys": F.when(i % 3 == 0, 5).when(i % 3 == 1, F.lit(None)).otherwise(i % 40),
         "many keys": i % 900, "empty": i}[request.param]
    n = 0 if request.param == "empty" else 4000
    # one NULL value late in the order, so that it poisons only what follows
    return (spark.range(n, numPartitions=5).select(k.cast("int").alias("k"), ((i * 7919) % 4001).alias("t"), F.when(i != 17, i % 11).alias("v"),
                                                  F.concat(F.lit("n"), i.cast("string")).alias("name"), i.alias("__other")))


@pytest.mark.parametrize("order", [["t"], ["-t"], ["v", "-t"]])
def test_scan_equals_windows(table, order):
    same(scanned(table, order), plain(table, order))


def test_one_key_lies_across_partitions(spark):
    df = spark.range(20_000, numPartitions=4).select(F.lit("a").alias("k"), F.col("id").alias("t"))
    rows = scan._ranged(df, ["k"], ["t"])
    sizes = [r["count"] for r in rows.groupBy(scan.PART).count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 2 * 20_000 / len(sizes)


def test_positions_and_places(spark):
    df = spark.range(3000, numPartitions=6).select((F.col("id") * 31 % 3000).alias("x"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("g"))
    got = sorting.arrange(df, "-g", "x", position="at").collect()
    assert [r["at"] for r in got] == list(range(1, 3001))
    assert [(r.g, r.x) for r in got] == sorted(((r.g, r.x) for r in df.collect()), key=lambda t: (t[0] is None, -(t[0] or 0), t[1]))
    inside = sorting.arrange_within(df, ["g"], "-x", position="at").collect()
    places = {}
    for r in inside:
        places.setdefault(r.g, []).append((r["at"], -r.x))
    assert all([p for p, _ in v] == list(range(1, len(v) + 1)) and v == sorted(v, key=lambda t: t[1]) for v in places.values())
    assert [r.g for r in inside] == sorted((r.g for r in inside), key=lambda g: (g is None, g))
    kept = windows.last_two_flags(windows.limit_per_group(df, ["g"], ["x"], F.least(F.col("group_size") - 1, F.lit(500))), place="place", size="group_size")
    per = {r.g: r for r in kept.groupBy("g").agg(F.count("*").alias("n"), F.sum("last_seat").alias("l"), F.sum("runner_up").alias("u"), F.max(
        F.when(F.col("runner_up") == 1, F.col("place"))).alias("at")).collect()}
    sizes = {r.g: r["count"] for r in df.groupBy("g").count().collect()}
    assert {g: r.n for g, r in per.items()} == {g: min(n - 1, 500) for g, n in sizes.items()}
    assert all((r.l, r.u, r["at"]) == (1, 1, r.n) for r in per.values())
    flags = windows.last_two_flags(df, ["g"], ["x"]).filter("last_seat + runner_up > 0")
    assert flags.count() == 2 * len(sizes) and flags.filter("runner_up = 1").select("g", "x").exceptAll(df.groupBy("g").agg(F.max("x"))).isEmpty()


def test_shifts_reach_one_row(spark):
    with pytest.raises(ValueError):
        scan.ordered_scan(spark.range(3).withColumn("k", F.lit(1)), ["k"], ["id"], shifts={"a": ("id", 2)})
