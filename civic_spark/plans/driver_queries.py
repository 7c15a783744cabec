"""Driver-table queries: every operator of the library run on the star-schema
test tables, each paired with an independent SQL statement (the oracle).

The election feeds are not available to the checker, so each operator is
exercised on an analogue with the same shape (SURVEY §7.4): order lines play
electoral zones, customers' segments play party lists, nations play
municipalities.  NULL behaviour is provoked with ``nullif`` in both the
Spark plan and its SQL, because the tables hold no NULL.

Numeric outputs are rounded to a precision finer than the exact value's grid
(2-decimal money sums → 2 or 4 places; averages → 8; ratios → 6) so both
engines agree despite floating-point summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, logic, text
from ..operators import aggregates as A
from ..operators import apportion, groups, joins, scan, sorting, stats, unions, windows
from ..session import read_table

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


def _date_text(c: str) -> F.Column:
    return F.date_format(F.col(c), "yyyy-MM-dd")


# --------------------------------------------------------------------------- flagship

def supplier_concentration(spark: SparkSession, d: str) -> DataFrame:
    """Flagship (W7 + A19 + J1): per customer nation and order year, the
    number of suppliers, revenue, the effective number of suppliers
    (1 / Σ share²) and the relative revenue gap between the top two."""
    li = _t(spark, d, "lineitem").select(
        "l_orderkey", "l_suppkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"))
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"))
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, d, "nation").select("n_nationkey", "n_name")
    # customer nation per order first (orders-sized join), so the lineitem
    # side is shuffled once, by order key
    order_nation = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
                     .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                     .select("o_orderkey", "order_year", "n_name"))
    base = li.join(order_nation, F.col("l_orderkey") == F.col("o_orderkey"))
    keys = ["n_name", "order_year"]
    per = base.groupBy(*keys, "l_suppkey").agg(F.sum("rev").alias("revenue"))
    # sums need no order; the two largest come from a per-task group limit, so no
    # task sorts all suppliers of a nation and year
    sums = per.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_suppliers"),
        F.round(F.sum("revenue"), 4).alias("revenue"),
        F.round(F.try_divide(F.sum("revenue") * F.sum("revenue"), F.sum(F.col("revenue") * F.col("revenue"))), 6)
        .alias("effective_suppliers"))
    gap = windows.top2_relative_gap(per, keys, "revenue", ["-revenue", "l_suppkey"], "top2_gap")
    return joins.left_join(sums, gap.withColumn("top2_gap", F.round("top2_gap", 6)), keys)


query("w7_a19_supplier_concentration", """
WITH per AS (
  SELECT n.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS order_year, l.l_suppkey,
         sum(l.l_extendedprice * (1 - l.l_discount)) AS revenue
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY n_name, order_year ORDER BY revenue DESC, l_suppkey) AS rn FROM per)
SELECT n_name, order_year, count(*) AS n_suppliers, round(sum(revenue), 4) AS revenue,
       round(sum(revenue) * sum(revenue) / sum(revenue * revenue), 6) AS effective_suppliers,
       round((max(CASE WHEN rn = 1 THEN revenue END) - max(CASE WHEN rn = 2 THEN revenue END))
             / max(CASE WHEN rn = 2 THEN revenue END), 6) AS top2_gap
FROM r GROUP BY 1, 2
""")(supplier_concentration)


# --------------------------------------------------------------------------- aggregates

@query("a1_a3_p13_collapse_lines", """
SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_linestatus,
       CASE WHEN count(*) = count(nullif(l_quantity, 7.0)) THEN sum(nullif(l_quantity, 7.0)) END AS qty_poison,
       coalesce(sum(nullif(l_quantity, 7.0)), 0) AS qty_skip,
       round(sum(l_extendedprice), 2) AS price
FROM lineitem GROUP BY 1, 2, 3, 4, 5
""")
def collapse_lines(spark, d):
    li = _t(spark, d, "lineitem")
    keys = clean.names_not_matching(li, r"^l_(linenumber|quantity|extendedprice|discount|tax|shipdate)$")
    x = li.select(*keys, F.nullif("l_quantity", F.lit(7.0)).alias("qty"), "l_extendedprice")
    return A.group_agg(x, keys, {"qty_poison": A.sum_poison("qty"), "qty_skip": A.sum_skip("qty"),
                                 "price": F.round(F.sum("l_extendedprice"), 2)})


@query("a4_sum_all_columns", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS l_quantity,
       round(sum(l_extendedprice), 2) AS l_extendedprice, round(sum(l_discount), 2) AS l_discount,
       round(sum(l_tax), 2) AS l_tax
FROM lineitem GROUP BY 1, 2
""")
def sum_all_columns(spark, d):
    li = _t(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice",
                                         "l_discount", "l_tax")
    out = A.sum_all(li, ["l_returnflag", "l_linestatus"])
    return clean.map_columns(out, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], lambda c: F.round(c, 2))


@query("a7_a8_a11_order_line_stats", """
SELECT l_orderkey, count(*) AS n_lines,
       CAST(count_if(l_returnflag = 'R') AS BIGINT) AS n_returned,
       round(CAST(count_if(l_returnflag = 'R') AS DOUBLE) / count(*), 6) AS share_returned,
       CASE WHEN count(*) = count(CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_linestatus = 'F' END)
            THEN CAST(count_if(CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_linestatus = 'F' END) AS BIGINT) END
            AS n_final_poison,
       round(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 0), 2) AS price_returned,
       round(avg(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 8) AS mean_price_returned,
       round(stddev_samp(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 6) AS sd_price_returned,
       bool_or(l_returnflag = 'R') AS any_returned,
       count(DISTINCT nullif(l_returnflag, 'A')) + max(CASE WHEN nullif(l_returnflag, 'A') IS NULL THEN 1 ELSE 0 END)
            AS n_flags
FROM lineitem GROUP BY 1
""")
def order_line_stats(spark, d):
    li = _t(spark, d, "lineitem")
    r = F.col("l_returnflag") == "R"
    fin = F.when(F.col("l_linestatus") == "O", F.lit(None).cast("boolean")).otherwise(F.col("l_linestatus") == "F")
    return A.group_agg(li, ["l_orderkey"], {
        "n_lines": F.count(F.lit(1)),
        "n_returned": A.count_if(r).cast("long"),
        "share_returned": F.round(A.share_if(r), 6),
        "n_final_poison": A.count_if(fin, poison=True).cast("long"),
        "price_returned": F.round(A.sum_if("l_extendedprice", r), 2),
        "mean_price_returned": F.round(A.mean_if("l_extendedprice", r), 8),
        "sd_price_returned": F.round(A.sd_if("l_extendedprice", r), 6),
        "any_returned": A.any_(r),
        "n_flags": A.n_distinct(F.nullif(F.col("l_returnflag"), F.lit("A")), few=True).cast("long"),
    })


@query("w1_line_share_of_order", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_orderkey), 6) AS share
FROM lineitem
""")
def line_share_of_order(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    x = groups.with_group_values(li, ["l_orderkey"], {"__tot": F.sum("l_extendedprice")})
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.round(F.try_divide(F.col("l_extendedprice"), F.col("__tot")), 6).alias("share"))


@query("a19_effective_suppliers_per_part", """
WITH per AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
SELECT l_partkey, round(sum(q) * sum(q) / sum(q * q), 6) AS effective_suppliers FROM per GROUP BY 1
""")
def effective_suppliers_per_part(spark, d):
    li = _t(spark, d, "lineitem")
    out = A.effective_number(li, ["l_partkey"], "l_suppkey", F.col("l_quantity"), "effective_suppliers")
    return out.withColumn("effective_suppliers", F.round("effective_suppliers", 6))


@query("a13_brands_per_supplier", """
SELECT l.l_suppkey, string_agg(DISTINCT p.p_brand, ' / ' ORDER BY p.p_brand) AS brands,
       count(DISTINCT p.p_brand) AS n_brands
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1
""")
def brands_per_supplier(spark, d):
    li = _t(spark, d, "lineitem").select("l_suppkey", "l_partkey")
    p = _t(spark, d, "part").select("p_partkey", "p_brand")
    x = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    return A.group_agg(x, ["l_suppkey"], {"brands": A.string_agg_sorted("p_brand", distinct=True),
                                          "n_brands": F.size(F.collect_set("p_brand")).cast("long")})


@query("a17_j10_f3_drop_rare_brands", """
WITH p AS (SELECT p_partkey, nullif(p_brand, 'Brand#1') AS brand FROM part),
counts AS (SELECT brand, count(*) AS n FROM p GROUP BY brand),
rare AS (SELECT brand FROM counts WHERE n < (SELECT floor(avg(n)) FROM counts))
SELECT p_partkey, brand FROM p
WHERE NOT EXISTS (SELECT 1 FROM rare r WHERE r.brand IS NOT DISTINCT FROM p.brand)
""")
def drop_rare_brands(spark, d):
    p = _t(spark, d, "part").select("p_partkey", F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("brand"))
    mean = A.count_by(p, ["brand"], "n").agg(F.floor(F.avg("n"))).scalar()
    rare = A.having_count(p, ["brand"], "<", mean).select("brand")
    return joins.exclude_values_in(p, rare, "brand")


@query("a14_fill_first_priority", """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate, nullif(o_orderpriority, '1-URGENT') AS prio FROM orders),
f AS (SELECT o_custkey, arg_min(prio, (prio IS NULL, o_orderdate, o_orderkey)) AS first_priority
      FROM o GROUP BY 1)
SELECT o.o_orderkey, o.o_custkey, f.first_priority FROM o JOIN f USING (o_custkey)
""")
def fill_first_priority(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                      F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("prio"))
    first = F.min_by(F.col("prio"), F.struct(F.col("prio").isNull(), F.col("o_orderdate"), F.col("o_orderkey")))
    x = groups.with_group_values(o, ["o_custkey"], {"first_priority": first})
    return x.select("o_orderkey", "o_custkey", "first_priority")


@query("a18_reaggregate_duplicate_lines", """
WITH li AS (SELECT l_orderkey, l_linenumber, l_quantity, nullif(l_returnflag, 'N') AS l_returnflag,
                   l_partkey, l_suppkey, l_extendedprice FROM lineitem),
f AS (SELECT l_orderkey, l_linenumber,
                  arg_min(l_returnflag, (l_partkey, l_suppkey, l_extendedprice, l_returnflag))
                    FILTER (WHERE l_returnflag IS NOT NULL) AS fill FROM li GROUP BY 1, 2),
x AS (SELECT li.* REPLACE (coalesce(li.l_returnflag, f.fill) AS l_returnflag)
      FROM li JOIN f ON li.l_orderkey = f.l_orderkey AND li.l_linenumber = f.l_linenumber)
SELECT l_orderkey, l_linenumber, l_returnflag,
       CASE WHEN count(*) = count(l_quantity) THEN sum(l_quantity) END AS l_quantity,
       arg_min(l_partkey, (l_partkey, l_suppkey, l_extendedprice)) AS l_partkey,
       arg_min(l_suppkey, (l_partkey, l_suppkey, l_extendedprice)) AS l_suppkey,
       arg_min(l_extendedprice, (l_partkey, l_suppkey, l_extendedprice)) AS l_extendedprice
FROM x GROUP BY 1, 2, 3
""")
def reaggregate_duplicate_lines(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                         F.nullif(F.col("l_returnflag"), F.lit("N")).alias("l_returnflag"),
                                         "l_partkey", "l_suppkey", "l_extendedprice")
    return A.reaggregate_duplicates(li, ["l_orderkey", "l_linenumber"], ["l_quantity"], ["l_returnflag"],
                                    ["l_partkey", "l_suppkey", "l_extendedprice"])


@query("a5_a6_count_sorted_types", """
SELECT p_type, count(*) AS n FROM part GROUP BY 1
""")
def count_sorted_types(spark, d):
    return A.count_by(_t(spark, d, "part"), ["p_type"], "n", sort=True)


@query("a16_distinct_part_supplier_pairs", """
SELECT DISTINCT l_partkey, l_suppkey FROM lineitem
""")
def distinct_pairs(spark, d):
    return A.distinct_rows(_t(spark, d, "lineitem"), ["l_partkey", "l_suppkey"])


@query("a12_a21_a22_a23_table_summary", """
SELECT count(*) AS n_lines,
       round(avg(CAST(l_returnflag = 'R' AS INTEGER)), 6) AS share_returned,
       round(CAST(count_if(l_returnflag = 'R' AND l_linestatus = 'F') AS DOUBLE) / count_if(l_linestatus = 'F')
             * 100.0, 6)
           AS pct_returned_of_final,
       bool_or(l_shipdate > TIMESTAMP '2001-06-01') AS any_late,
       round(sum(l_extendedprice), 2) AS revenue
FROM lineitem
""")
def table_summary(spark, d):
    li = _t(spark, d, "lineitem")
    r, f = F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"
    return li.agg(F.count(F.lit(1)).alias("n_lines"),
                  F.round(A.proportion(r), 6).alias("share_returned"),
                  F.round(A.pct_ratio(r, f), 6).alias("pct_returned_of_final"),
                  A.any_(F.col("l_shipdate") > F.lit("2001-06-01").cast("timestamp_ntz")).alias("any_late"),
                  F.round(F.sum("l_extendedprice"), 2).alias("revenue"))


@query("a25_split_summary_priority", """
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS order_year, c.c_mktsegment,
       CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS urgent,
       count(*) AS n_orders, round(avg(o.o_totalprice), 8) AS mean_total, round(sum(o.o_totalprice), 2) AS total
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3
""")
def split_summary_priority(spark, d):
    o = _t(spark, d, "orders")
    c = _t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    x = o.join(c, F.col("o_custkey") == F.col("c_custkey")).withColumn("order_year", F.year("o_orderdate"))
    side = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0)
    return A.split_summary(x, ["order_year", "c_mktsegment"], side, "urgent", {
        "n_orders": F.count(F.lit(1)), "mean_total": F.round(F.avg("o_totalprice"), 8),
        "total": F.round(F.sum("o_totalprice"), 2)})


# --------------------------------------------------------------------------- group filters

_LINE_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]


@query("f7_keep_orders_any_returned", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem
WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def keep_orders_any_returned(spark, d):
    li = _t(spark, d, "lineitem").select(*_LINE_COLS)
    return groups.keep_groups_any(li, ["l_orderkey"], F.col("l_returnflag") == "R")


@query("f9_drop_orders_any_returned_null", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem
WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE coalesce(nullif(l_returnflag, 'A') = 'R', true))
""")
def drop_orders_any_returned(spark, d):
    li = _t(spark, d, "lineitem").select(*_LINE_COLS)
    return groups.drop_groups_any(li, ["l_orderkey"], F.nullif(F.col("l_returnflag"), F.lit("A")) == "R")


@query("f10_orders_exactly_one_returned", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem
WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count_if(l_returnflag = 'R') = 1)
""")
def orders_exactly_one_returned(spark, d):
    li = _t(spark, d, "lineitem").select(*_LINE_COLS)
    return groups.keep_groups_exactly_one(li, ["l_orderkey"], F.col("l_returnflag") == "R")


@query("f8_orders_single_linestatus", """
WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
                   nullif(l_linestatus, 'O') AS l_linestatus FROM lineitem)
SELECT * FROM li WHERE l_orderkey IN (
  SELECT l_orderkey FROM li GROUP BY 1
  HAVING count(DISTINCT l_linestatus) + max(CASE WHEN l_linestatus IS NULL THEN 1 ELSE 0 END) = 1)
""")
def orders_single_linestatus(spark, d):
    li = _t(spark, d, "lineitem").select(*_LINE_COLS[:-1], F.nullif(F.col("l_linestatus"), F.lit("O"))
                                         .alias("l_linestatus"))
    return groups.keep_groups_single_value(li, ["l_orderkey"], "l_linestatus")


# --------------------------------------------------------------------------- joins

@query("j1_j4_nation_roles", """
SELECT cn.n_name AS cust_n_name, sn.n_name AS supp_n_name, count(*) AS n_lines,
       round(sum(l.l_extendedprice), 2) AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
GROUP BY 1, 2
""")
def nation_roles(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    s = _t(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    n = _t(spark, d, "nation").select("n_nationkey", "n_name")
    # role 1: the customer's nation per order (orders-sized join)
    oc = joins.left_join(o.join(c, F.col("o_custkey") == F.col("c_custkey")), n, "c_nationkey", "n_nationkey",
                         right_prefix="cust_").select("o_orderkey", "cust_n_name")
    # role 2: the supplier's nation per supplier (supplier-sized join)
    sn = joins.left_join(s, n, "s_nationkey", "n_nationkey", right_prefix="supp_").select("s_suppkey", "supp_n_name")
    x = li.join(sn, F.col("l_suppkey") == F.col("s_suppkey")).join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
    return A.group_agg(x, ["cust_n_name", "supp_n_name"], {"n_lines": F.count(F.lit(1)),
                                                           "revenue": F.round(F.sum("l_extendedprice"), 2)})


@query("j2_j3_null_safe_multi_key", """
WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS prio, nullif(o_orderstatus, 'P') AS status,
                  o_totalprice FROM orders),
s AS (SELECT prio AS g_prio, status AS g_status, count(*) AS grp_orders, round(avg(o_totalprice), 8) AS grp_avg
      FROM o GROUP BY 1, 2)
SELECT o.o_orderkey, o.prio, o.status, s.grp_orders, s.grp_avg FROM o LEFT JOIN s
  ON o.prio IS NOT DISTINCT FROM s.g_prio AND o.status IS NOT DISTINCT FROM s.g_status
""")
def null_safe_multi_key(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("prio"),
                                      F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"), "o_totalprice")
    s = A.group_agg(o, ["prio", "status"], {"grp_orders": F.count(F.lit(1)),
                                            "grp_avg": F.round(F.avg("o_totalprice"), 8)})
    s = s.withColumnsRenamed({"prio": "g_prio", "status": "g_status"})
    x = joins.left_join(o, s, ["prio", "status"], ["g_prio", "g_status"])
    return x.select("o_orderkey", "prio", "status", "grp_orders", "grp_avg")


@query("j5_j6_two_tier_lookup", """
WITH st AS (SELECT p_brand, p_type, avg(p_retailprice) AS avg_price FROM part GROUP BY 1, 2),
fed AS (SELECT p_type, avg_price FROM (
          SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_brand, avg_price) AS rn FROM st) WHERE rn = 1)
SELECT p.p_partkey,
       round(coalesce(CASE WHEN p.p_size > 45 THEN p.p_retailprice END,
                      CASE WHEN p.p_size <= 7 THEN fed.avg_price ELSE st.avg_price END), 8) AS ref_price
FROM part p
LEFT JOIN st ON p.p_brand IS NOT DISTINCT FROM st.p_brand AND p.p_type IS NOT DISTINCT FROM st.p_type
LEFT JOIN fed ON p.p_type IS NOT DISTINCT FROM fed.p_type
""")
def two_tier(spark, d):
    p = _t(spark, d, "part")
    st = A.group_agg(p, ["p_brand", "p_type"], {"avg_price": F.avg("p_retailprice")})
    x = p.select("p_partkey", "p_brand", "p_type", "p_size",
                 F.when(F.col("p_size") > 45, F.col("p_retailprice")).alias("ref_price"))
    x = joins.two_tier_lookup(x, st, ["p_brand", "p_type"], ["p_type"], {"ref_price": "avg_price"},
                              F.col("p_size") <= 7, dedupe_order=["p_brand", "avg_price"])
    return x.select("p_partkey", F.round("ref_price", 8).alias("ref_price"))


@query("j7_u1_split_join_union", """
WITH lc AS (SELECT l_orderkey AS o_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1)
SELECT o.o_orderkey, o.o_orderstatus, c.c_nationkey FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderstatus = 'F'
UNION ALL BY NAME
SELECT o.o_orderkey, o.o_orderstatus, lc.n_lines FROM orders o
  LEFT JOIN lc ON o.o_orderkey = lc.o_orderkey WHERE o.o_orderstatus = 'O'
UNION ALL BY NAME
SELECT o.o_orderkey, o.o_orderstatus, c.c_mktsegment FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderstatus = 'P'
""")
def split_join_union(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    cust = _t(spark, d, "customer")
    nat = cust.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    seg = cust.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    lc = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"))
    st = F.col("o_orderstatus")
    out = joins.split_join_union(o, [(st == "F", nat, ["o_custkey"]), (st == "O", lc, ["o_orderkey"]),
                                     (st == "P", seg, ["o_custkey"])])
    return out.drop("o_custkey")


@query("j8_j14_order_vs_lines", """
WITH lines AS (SELECT l_orderkey AS o_orderkey, round(sum(l_extendedprice), 2) AS lines_total, count(*) AS n_lines
               FROM lineitem GROUP BY 1),
ord AS (SELECT o_orderkey, round(sum(o_totalprice), 2) AS order_total FROM orders GROUP BY 1)
SELECT ord.o_orderkey, ord.order_total, lines.lines_total, lines.n_lines,
       round(ord.order_total - lines.lines_total, 2) AS difference
FROM lines RIGHT JOIN ord ON lines.o_orderkey = ord.o_orderkey
""")
def order_vs_lines(spark, d):
    li = _t(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    o = _t(spark, d, "orders")
    a = A.group_agg(li, ["o_orderkey"], {"lines_total": F.round(F.sum("l_extendedprice"), 2),
                                         "n_lines": F.count(F.lit(1))})
    b = A.group_agg(o, ["o_orderkey"], {"order_total": F.round(F.sum("o_totalprice"), 2)})
    x = joins.right_join(a, b, ["o_orderkey"])
    return x.withColumn("difference", F.round(F.col("order_total") - F.col("lines_total"), 2))


@query("j9_lagged_self_join", """
WITH y AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n_orders
           FROM orders GROUP BY 1, 2)
SELECT t1.o_custkey, t1.order_year, t1.n_orders, t2.n_orders AS n_orders_prev
FROM y t1 LEFT JOIN y t2 ON t1.order_year - 1 = t2.order_year AND t1.o_custkey = t2.o_custkey
""")
def lagged(spark, d):
    o = _t(spark, d, "orders").withColumn("order_year", F.year("o_orderdate"))
    y = A.count_by(o, ["o_custkey", "order_year"], "n_orders")
    return joins.lagged_self_join(y, y, ["o_custkey"], "order_year", 1, {"n_orders_prev": "n_orders"})


@query("j11_fan_out_national_rows", """
WITH reg AS (SELECT r.r_name, c.c_mktsegment, count(*) AS n, 'region' AS scope
             FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
             JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2),
nat AS (SELECT c_mktsegment, count(*) AS n, 'all' AS scope FROM customer GROUP BY 1)
SELECT r_name, c_mktsegment, n, scope FROM reg
UNION ALL
SELECT r.r_name, nat.c_mktsegment, nat.n, nat.scope FROM nat CROSS JOIN region r
""")
def fan_out_national(spark, d):
    c = _t(spark, d, "customer")
    n = _t(spark, d, "nation")
    r = _t(spark, d, "region")
    cr = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")) \
          .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    reg = A.count_by(cr, ["r_name", "c_mktsegment"]).withColumn("scope", F.lit("region"))
    nat = A.count_by(c, ["c_mktsegment"]).withColumn("scope", F.lit("all")).withColumn("r_name", F.lit("ALL"))
    both = unions.bind_rows(reg, nat.select(*reg.columns))
    return joins.fan_out(both, "r_name", "ALL", r.select("r_name"))


@query("s18_coverage_grid_missing", """
SELECT u.user_id, t.event_type
FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (SELECT DISTINCT event_type FROM events) t
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND e.event_type = t.event_type)
""")
def coverage_grid_missing(spark, d):
    """User × event type cells without an event."""
    from ..sources.readers import coverage_grid
    e = _t(spark, d, "events").select("user_id", "event_type")
    return coverage_grid(e.select("user_id"), e.select("event_type"), e, ["user_id", "event_type"])


@query("j13_shifted_year_join", """
WITH y AS (SELECT c.c_nationkey, CAST(year(o.o_orderdate) AS INTEGER) AS order_year,
                  round(sum(o.o_totalprice), 2) AS revenue
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2)
SELECT a.c_nationkey, a.order_year, a.revenue, b.revenue AS revenue_two_years_before
FROM y a LEFT JOIN y b ON a.c_nationkey = b.c_nationkey AND a.order_year = b.order_year + 2
""")
def shifted_year(spark, d):
    o = _t(spark, d, "orders")
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    x = o.join(c, F.col("o_custkey") == F.col("c_custkey")).withColumn("order_year", F.year("o_orderdate"))
    y = A.group_agg(x, ["c_nationkey", "order_year"], {"revenue": F.round(F.sum("o_totalprice"), 2)})
    prev = y.withColumnRenamed("revenue", "revenue_two_years_before")
    return joins.shifted_key_join(y, prev, ["c_nationkey"], "order_year", 2)


# --------------------------------------------------------------------------- windows

@query("w3_w4_w5_customer_order_sequence", """
SELECT o_orderkey, o_custkey,
       CAST(row_number() OVER w - 1 AS INTEGER) AS prior_orders,
       round(sum(o_totalprice) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_total,
       lag(o_totalprice) OVER w AS prev_total, lead(o_totalprice) OVER w AS next_total
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def customer_order_sequence(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    order = ["o_orderdate", "o_orderkey"]
    x = scan.ordered_scan(
        o, ["o_custkey"], order, seq={"prior_orders": -1},
        sums={"running_total": (F.col("o_totalprice"), True)},
        shifts={"prev_total": ("o_totalprice", 1), "next_total": ("o_totalprice", -1)})
    return x.select("o_orderkey", "o_custkey", F.col("prior_orders").cast("int").alias("prior_orders"), F.round("running_total", 2).alias("running_total"),
                    "prev_total", "next_total")


@query("w4_event_running_sums", """
SELECT event_id, user_id,
       round(coalesce(sum(value) OVER w, 0), 2) AS running_value,
       CASE WHEN max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER w = 0
            THEN round(sum(value) OVER w, 2) END AS running_value_poison,
       CAST(count_if(event_type = 'error') OVER w AS BIGINT) AS running_errors
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def event_running_sums(spark, d):
    e = _t(spark, d, "events").select("event_id", "user_id", "ts", "event_type", "value")
    x = scan.ordered_scan(e, ["user_id"], ["ts", "event_id"], sums={
        "running_value": (F.col("value"), False),
        "running_value_poison": (F.when(F.col("event_type") != "view", F.col("value")), True),
        "running_errors": ((F.col("event_type") == "error").cast("long"), False)})
    return x.select("event_id", "user_id", F.round("running_value", 2).alias("running_value"),
                    F.round("running_value_poison", 2).alias("running_value_poison"), "running_errors")


@query("w7_top2_supplier_gap", """
WITH per AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY qty DESC, l_suppkey) AS rn FROM per)
SELECT l_partkey, round((max(CASE WHEN rn = 1 THEN qty END) - max(CASE WHEN rn = 2 THEN qty END))
                        / max(CASE WHEN rn = 2 THEN qty END), 6) AS gap
FROM r GROUP BY 1
""")
def top2_supplier_gap(spark, d):
    per = A.group_agg(_t(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], {"qty": F.sum("l_quantity")})
    out = windows.top2_relative_gap(per, ["l_partkey"], "qty", ["-qty", "l_suppkey"], "gap")
    return out.withColumn("gap", F.round("gap", 6))


@query("w9_w10_a24_last_two_lines", """
WITH r AS (SELECT l_orderkey, l_extendedprice,
                  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey,
                                     l_linenumber, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus,
                                     l_shipdate) AS rn,
                  count(*) OVER (PARTITION BY l_orderkey) AS n_lines
           FROM lineitem),
k AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM r WHERE rn <= least(n_lines, 4))
SELECT l_orderkey,
       round(max(CASE WHEN rn = n - 1 THEN l_extendedprice END) - max(CASE WHEN rn = n THEN l_extendedprice END), 2)
           AS difference
FROM k GROUP BY 1
""")
def last_two_lines(spark, d):
    li = _t(spark, d, "lineitem")
    order = ["-l_extendedprice", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
    x = windows.limit_per_group(li, ["l_orderkey"], order, F.least(F.col("n_lines"), F.lit(4)), "place", "n_lines")
    x = windows.last_two_flags(x, place="place", size="n_lines")
    out = A.flagged_difference(x, ["l_orderkey"], "l_extendedprice", F.col("last_seat") == 1,
                               F.col("runner_up") == 1, "difference")
    return out.withColumn("difference", F.round("difference", 2))


@query("w11_group_min_boundary", """
SELECT o_orderkey, o_orderstatus, min(year(o_orderdate)) OVER (PARTITION BY o_orderstatus) AS min_year,
       CASE WHEN year(o_orderdate) = min(year(o_orderdate)) OVER (PARTITION BY o_orderstatus) THEN 1 ELSE 0 END
           AS first_cycle
FROM orders
""")
def group_min_boundary(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    x = windows.group_min_boundary(o, "o_orderstatus", "y", "min_year")
    return x.select("o_orderkey", "o_orderstatus", F.col("min_year").cast("long").alias("min_year"),
                    logic.flag(F.col("y") == F.col("min_year")).alias("first_cycle"))


@query("w12_segment_share_by_nation", """
SELECT c_nationkey, c_mktsegment, count(*) AS n,
       round(count(*) / sum(count(*)) OVER (PARTITION BY c_nationkey), 6) AS share
FROM customer GROUP BY 1, 2
""")
def segment_share_by_nation(spark, d):
    x = A.count_by(_t(spark, d, "customer"), ["c_nationkey", "c_mktsegment"])
    return windows.share_within(x, ["c_nationkey"], "n").withColumn("share", F.round("share", 6))


@query("w13_event_type_pct_of_total", """
SELECT event_type, count(*) AS n,
       round(CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100.0, 6) AS pct
FROM events GROUP BY 1
""")
def event_type_pct(spark, d):
    x = A.count_by(_t(spark, d, "events"), ["event_type"])
    return windows.share_of_total(x, "n", "pct").withColumn("pct", F.round("pct", 6))


@query("o4_top20_parts_by_quantity", """
SELECT l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1 ORDER BY qty DESC, l_partkey LIMIT 20
""")
def top20_parts(spark, d):
    per = A.group_agg(_t(spark, d, "lineitem"), ["l_partkey"], {"qty": F.sum("l_quantity")})
    return sorting.top_k(per, 20, "-qty", "l_partkey")


@query("o1_o2_sorted_customers", """
SELECT c_custkey, nullif(c_mktsegment, 'HOUSEHOLD') AS segment, c_acctbal,
       row_number() OVER (ORDER BY nullif(c_mktsegment, 'HOUSEHOLD') ASC NULLS LAST, c_acctbal DESC NULLS LAST,
                          c_custkey) AS position
FROM customer
""")
def sorted_customers(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD"))
                                        .alias("segment"), "c_acctbal")
    return sorting.arrange(c, "segment", "-c_acctbal", "c_custkey", position="position")


@query("o3_sort_within_orders", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC NULLS LAST, l_partkey, l_linenumber)
           AS position
FROM lineitem
""")
def sort_within_orders(spark, d):
    """O3: lines next to the others of their order and sorted within it (price
    descending), ``arrange(..., .by_group = TRUE)``, with their place in it."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return sorting.arrange_within(li, ["l_orderkey"], "-l_extendedprice", "l_partkey", "l_linenumber",
                                  position="position")


# --------------------------------------------------------------------------- decisive semantics: the D8 core

@query("a20_x14_d8_marginal_seat_segments", """
WITH lists AS (SELECT c.c_nationkey AS n_nationkey, c.c_mktsegment, count(*) AS votes
               FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2),
seats AS (SELECT n.n_nationkey, 9 + count(s.s_suppkey) AS seats
          FROM nation n LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey GROUP BY 1),
q AS (SELECT l.n_nationkey, l.c_mktsegment, l.votes, s.seats,
             sum(l.votes) OVER (PARTITION BY l.n_nationkey) / s.seats AS quota,
             CASE WHEN l.c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 1 ELSE 0 END AS side
      FROM lists l JOIN seats s ON l.n_nationkey = s.n_nationkey),
e AS (SELECT *, unnest(generate_series(1, seats)) AS divisor FROM q WHERE votes >= quota),
r AS (SELECT *, votes / divisor AS quotient,
             row_number() OVER (PARTITION BY n_nationkey ORDER BY divisor, votes / divisor DESC, c_mktsegment, side) AS rn
      FROM e),
k AS (SELECT *, count(*) OVER (PARTITION BY n_nationkey) AS n FROM r WHERE rn <= seats + 1)
SELECT n_nationkey,
       CASE WHEN max(CASE WHEN rn = n - 1 THEN side END) <> max(CASE WHEN rn = n THEN side END) THEN 1
            WHEN max(CASE WHEN rn = n - 1 THEN side END) = max(CASE WHEN rn = n THEN side END) THEN 0 END
           AS mayor_opposition_flip,
       round((max(CASE WHEN rn = n - 1 THEN quotient END) - max(CASE WHEN rn = n THEN quotient END))
             / sum(votes), 8) AS quotient_margin,
       CAST(sum(votes) AS BIGINT) AS total_vote, count(*) AS n_rows
FROM k GROUP BY 1 HAVING count(*) >= 2
""")
def marginal_seat_segments(spark, d):
    o = _t(spark, d, "orders").select("o_custkey")
    c = _t(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment")
    lists = A.count_by(o.join(c, F.col("o_custkey") == F.col("c_custkey")), ["n_nationkey", "c_mktsegment"], "votes")
    s = _t(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    n = _t(spark, d, "nation").select("n_nationkey")
    seats = A.group_agg(joins.left_join(n, s, "n_nationkey"), ["n_nationkey"],
                        {"seats": F.lit(9) + F.count("s_suppkey")})
    x = joins.left_join(lists, seats, "n_nationkey")
    q = A.group_agg(x, ["n_nationkey"], {"quota": A.quota("votes", "seats")})
    x = joins.left_join(x, q, "n_nationkey")
    x = x.withColumn("side", F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), 1).otherwise(0))
    out = apportion.marginal_seat(x, ["n_nationkey"], "c_mktsegment", "votes", "seats", "side", quota="quota")
    return out.withColumn("quotient_margin", F.round("quotient_margin", 8))


# --------------------------------------------------------------------------- scalar functions

@query("x1_x2_fold_lower_documents", f"""
SELECT doc_id, md5({text.fold_accents_sql('text')}) AS folded_md5,
       md5(lower({text.fold_accents_sql('text')})) AS folded_lower_md5,
       CAST(length({text.fold_accents_sql('text')}) AS INTEGER) AS folded_chars
FROM documents
""")
def fold_documents(spark, d):
    doc = _t(spark, d, "documents")
    folded = text.fold_accents("text")
    return doc.select("doc_id", F.md5(folded).alias("folded_md5"),
                      F.md5(text.fold_lower("text")).alias("folded_lower_md5"),
                      F.length(folded).alias("folded_chars"))


@query("x3_x13_pad_codes", """
SELECT c_custkey,
       CASE WHEN length(CAST(c_custkey AS VARCHAR)) >= 5 THEN CAST(c_custkey AS VARCHAR)
            ELSE lpad(CAST(c_custkey AS VARCHAR), 5, '0') END AS code5,
       CASE WHEN length(CAST(c_custkey AS VARCHAR)) >= 3 THEN CAST(c_custkey AS VARCHAR)
            ELSE lpad(CAST(c_custkey AS VARCHAR), 3, '0') END AS code3,
       CASE WHEN regexp_matches(c_mktsegment, '^[0-9]+$') THEN lpad(c_mktsegment, 12, '0') ELSE c_mktsegment END
           AS segment_code,
       CAST(c_custkey AS VARCHAR) IN ('0', repeat('0', 11), repeat('9', 11)) AS defective_id
FROM customer
""")
def pad_codes(spark, d):
    c = _t(spark, d, "customer")
    k = F.col("c_custkey").cast("string")
    return c.select("c_custkey", text.pad_left(k, 5).alias("code5"), text.pad_left(k, 3).alias("code3"),
                    text.pad_left_digits("c_mktsegment", 12).alias("segment_code"),
                    ((k == "0") | (k == text.repeat_text("0", 11)) | (k == text.repeat_text("9", 11))).alias("defective_id"))


@query("x4_x7_url_parts", """
SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
       substring(url, 1, 5) AS head5, right(url, 2) AS tail2,
       regexp_matches(url, '^https') AS is_https,
       regexp_replace(url, '[0-9]+', '#', 'g') AS url_masked,
       regexp_replace(url, '[0-9]+', 'N') AS url_first_masked,
       concat(regexp_extract(url, '^https?://([^/?#]+)', 1), '|', right(url, 2)) AS host_tail
FROM pages
""")
def url_parts(spark, d):
    p = _t(spark, d, "pages")
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    return p.select("page_id", host.alias("host"), text.head("url", 5).alias("head5"),
                    text.tail("url", 2).alias("tail2"), text.detect("url", "^https").alias("is_https"),
                    text.replace_all("url", "[0-9]+", "#").alias("url_masked"),
                    text.replace_first("url", "[0-9]+", "N").alias("url_first_masked"),
                    text.paste0(host, F.lit("|"), text.tail("url", 2)).alias("host_tail"))


@query("x9_x10_html_counts", """
SELECT page_id, CAST(length(html) AS INTEGER) AS html_chars,
       CAST(len(regexp_extract_all(html, '<p[ >]')) AS INTEGER) AS n_paragraphs,
       CAST(len(regexp_extract_all(html, '<a ')) AS INTEGER) AS n_links
FROM pages
""")
def html_counts(spark, d):
    p = _t(spark, d, "pages")
    return p.select("page_id", text.n_chars("html").alias("html_chars"),
                    text.count_matches("html", "<p[ >]").alias("n_paragraphs"),
                    text.count_matches("html", "<a ").alias("n_links"))


@query("x8_x11_x12_segment_coalitions", """
WITH coal AS (SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ' / ' ORDER BY c_mktsegment) AS coalition
              FROM customer GROUP BY 1)
SELECT c.c_custkey, coal.coalition,
       regexp_matches(coal.coalition, '\\b' || c.c_mktsegment || '\\b') AS member_word,
       list_contains(list_transform(string_split(coal.coalition, '/'), lambda x: trim(x)), c.c_mktsegment) AS member_token,
       1 + CAST(len(regexp_extract_all(coal.coalition, '/')) AS INTEGER) AS coalition_size,
       coalesce(CAST(len(string_split(coal.coalition, '/')) AS INTEGER), 1) AS n_members
FROM customer c LEFT JOIN coal ON c.c_nationkey = coal.c_nationkey
""")
def segment_coalitions(spark, d):
    c = _t(spark, d, "customer")
    coal = A.group_agg(c, ["c_nationkey"],
                       {"coalition": A.string_agg_sorted("c_mktsegment", distinct=True)})
    x = joins.left_join(c.select("c_custkey", "c_nationkey", "c_mktsegment"), coal, "c_nationkey")
    return x.select("c_custkey", "coalition",
                    text.detect_word("coalition", "c_mktsegment", "word").alias("member_word"),
                    text.detect_word("coalition", "c_mktsegment", "token").alias("member_token"),
                    (F.lit(1) + text.count_matches("coalition", "/")).alias("coalition_size"),
                    text.list_length("coalition").alias("n_members"))


@query("x15_x20_x24_x26_conditionals", """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high' WHEN o_orderpriority = '3-MEDIUM' THEN 'medium'
            ELSE 'low' END AS priority_class,
       CASE WHEN nullif(o_orderstatus, 'P') = 'F' THEN 1 WHEN NOT (nullif(o_orderstatus, 'P') = 'F') THEN 0 END
           AS final_flag,
       greatest(nullif(CAST(year(o_orderdate) AS INTEGER), 1995), 1997) AS year_floor,
       coalesce(nullif(o_orderpriority, '5-LOW'), 'unknown') AS priority_filled,
       nullif(o_orderpriority, '5-LOW') IS NULL AS priority_missing,
       nullif(CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 ELSE -1 END, -1) AS status_code,
       CASE WHEN CAST(year(o_orderdate) AS INTEGER) % 4 = 0 THEN 1 ELSE 0 END AS cycle_flag
FROM orders
""")
def conditionals(spark, d):
    o = _t(spark, d, "orders")
    prio = F.col("o_orderpriority")
    st = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    code = logic.case_when((F.col("o_orderstatus") == "F", 1), (F.col("o_orderstatus") == "O", 0), default=-1)
    return o.select(
        "o_orderkey",
        logic.case_when((prio.isin("1-URGENT", "2-HIGH"), "high"), (prio == "3-MEDIUM", "medium"),
                        default="low").alias("priority_class"),
        logic.flag(st == "F").alias("final_flag"),
        logic.pmax(F.nullif(F.year("o_orderdate"), F.lit(1995)), F.lit(1997)).alias("year_floor"),
        logic.replace_na(F.nullif(prio, F.lit("5-LOW")), "unknown").alias("priority_filled"),
        logic.is_na(F.nullif(prio, F.lit("5-LOW"))).alias("priority_missing"),
        logic.sentinel_to_null(code, -1).alias("status_code"),
        logic.cycle_flag(F.year("o_orderdate").cast("string")).alias("cycle_flag"))


@query("f11_x27_p9_sentinels_customer", """
WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE c_mktsegment END AS seg_raw
           FROM customer)
SELECT c_custkey,
       CASE WHEN c_name IN ('#NE#', '#NULO#', '#nulo', '', 'MACHINERY') THEN NULL ELSE lower(c_name) END AS c_name,
       CASE WHEN seg_raw IN ('#NE#', '#NULO#', '#nulo', '', 'MACHINERY') THEN NULL ELSE lower(seg_raw) END AS segment,
       CASE WHEN seg_raw = '' THEN c_name WHEN NOT (seg_raw = '') THEN seg_raw END AS seg_or_name
FROM c
""")
def sentinels_customer(spark, d):
    c = _t(spark, d, "customer").select(
        "c_custkey", "c_name",
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("")).otherwise(F.col("c_mktsegment")).alias("segment"))
    c = c.withColumn("seg_or_name", logic.empty_to("segment", "c_name"))
    x = clean.na_sentinels(c, (*clean.SENTINELS, "MACHINERY"), cols=["c_name", "segment"])
    return clean.map_columns(x, ["c_name", "segment"], F.lower)


@query("x21_x22_dmy_roundtrip", """
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS dmy_text,
       strftime(try_strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y'), '%Y-%m-%d') AS parsed,
       CAST(year(try_strptime(strftime(o_orderdate, '%d-%m-%Y'), '%d-%m-%Y')) AS INTEGER) AS parsed_year,
       try_strptime('3' || strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') IS NULL AS bad_is_null
FROM orders
""")
def dmy_roundtrip(spark, d):
    o = _t(spark, d, "orders")
    txt = F.date_format("o_orderdate", "dd/MM/yyyy")
    return o.select("o_orderkey", txt.alias("dmy_text"),
                    F.date_format(logic.parse_dmy(txt), "yyyy-MM-dd").alias("parsed"),
                    F.year(logic.parse_dmy(F.date_format("o_orderdate", "dd-MM-yyyy"))).alias("parsed_year"),
                    logic.parse_dmy(F.concat(F.lit("3"), txt)).isNull().alias("bad_is_null"))


@query("p8_rotate_columns_2000", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN year(l_shipdate) = 2000 THEN l_linestatus ELSE l_returnflag END AS l_returnflag,
       CASE WHEN year(l_shipdate) = 2000 THEN l_returnflag ELSE l_linestatus END AS l_linestatus
FROM lineitem
""")
def rotate_columns(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus",
                                         "l_shipdate")
    x = clean.rotate_when(li, F.year("l_shipdate") == 2000, {"l_returnflag": "l_linestatus",
                                                              "l_linestatus": "l_returnflag"})
    return clean.leading_then_sorted(x.drop("l_shipdate"), "l_orderkey")


@query("u2_s13_yearly_layouts", """
SELECT o_orderkey AS order_id, CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderstatus AS status,
       CASE WHEN year(o_orderdate) % 2 = 0 THEN o_orderpriority END AS priority,
       CAST(o_totalprice AS DECIMAL(18,2)) AS total
FROM orders
""")
def yearly_layouts(spark, d):
    """S13 + U2: each year arrives in its own layout (even years carry the
    priority under another name, odd years lack it); adapters map them to
    one canonical layout and the years are bound."""
    from ..sources import readers
    from ..sources.schemas import struct

    from ..operators.unions import bind_all

    o = _t(spark, d, "orders").withColumn("y", F.year("o_orderdate"))
    canonical = struct("order_id long, order_year int, status string, priority string, total decimal(18,2)")
    even = o.filter(F.col("y") % 2 == 0).select(
        F.col("o_orderkey").alias("id"), F.col("y").alias("ano"), F.col("o_orderstatus").alias("st"),
        F.col("o_orderpriority").alias("prio"),
        F.regexp_replace(F.col("o_totalprice").cast("string"), r"\.", ",").alias("valor"))
    # an order without a date has no priority either, as in the odd years
    odd = o.filter(F.coalesce(F.col("y") % 2, F.lit(1)) == 1).select("o_orderkey", "y", "o_orderstatus", "o_totalprice")
    layouts = [(even, {"order_id": "id", "order_year": "ano", "status": "st", "priority": "prio", "total": "valor"}),
               (odd, {"order_id": "o_orderkey", "order_year": "y", "status": "o_orderstatus", "total": "o_totalprice"})]
    return bind_all(readers.adapt_layout(f, m, canonical) for f, m in layouts)


# --------------------------------------------------------------------------- more operators

@query("a15_j12_first_order_per_customer", """
WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
                          FROM orders) WHERE rn = 1)
SELECT c.c_custkey, c.c_name, f.o_orderkey, strftime(f.o_orderdate, '%Y-%m-%d') AS first_order_date,
       f.o_totalprice AS first_order_total
FROM customer c LEFT JOIN f ON c.c_custkey = f.o_custkey
""")
def first_order_per_customer(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    o = _t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate",
                                      "o_totalprice")
    x = joins.dedupe_then_join(c, o, "c_custkey", ["o_orderdate", "o_orderkey"])
    return x.select("c_custkey", "c_name", "o_orderkey", _date_text("o_orderdate").alias("first_order_date"),
                    F.col("o_totalprice").alias("first_order_total"))


@query("w2_w8_f10_first_line_and_returned_part", """
WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag FROM lineitem),
one AS (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned_partkey
        FROM li GROUP BY 1 HAVING count_if(l_returnflag = 'R') = 1),
r AS (SELECT li.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey,
                                      l_linenumber, l_returnflag) AS rn FROM li)
SELECT r.l_orderkey, r.l_linenumber, r.l_partkey, CASE WHEN rn = 1 THEN 1 ELSE 0 END AS first_value,
       one.returned_partkey
FROM r JOIN one ON r.l_orderkey = one.l_orderkey
""")
def first_line_and_returned_part(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                         "l_extendedprice", "l_returnflag")
    r = F.col("l_returnflag") == "R"
    x = groups.keep_groups_exactly_one(li, ["l_orderkey"], r)
    x = groups.value_of_unique_row(x, ["l_orderkey"], r, {"returned_partkey": "l_partkey"})
    x = windows.first_row_flag(x, ["l_orderkey"], ["-l_extendedprice", "l_partkey", "l_suppkey", "l_linenumber",
                                                   "l_returnflag"])
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "first_value", "returned_partkey")


@query("u4_split_repair_union_low_priority", """
WITH low AS (SELECT o_custkey, count(*) AS n_low, round(avg(o_totalprice), 8) AS avg_low FROM orders
             WHERE o_orderpriority = '5-LOW' GROUP BY 1)
SELECT o_orderkey AS order_or_customer, o_orderpriority AS priority, round(o_totalprice, 8) AS amount,
       CAST(NULL AS BIGINT) AS n_low
FROM orders WHERE NOT coalesce(o_orderpriority = '5-LOW', false)
UNION ALL
SELECT o_custkey, '5-LOW', avg_low, n_low FROM low
""")
def split_repair_union(spark, d):
    """U4: rows of one kind are repaired by an aggregation (low-priority
    orders collapsed per customer) and rebound to the untouched rows."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")

    def repair(part):
        return part.groupBy(F.col("o_custkey").alias("order_or_customer")).agg(
            F.lit("5-LOW").alias("priority"), F.round(F.avg("o_totalprice"), 8).alias("amount"),
            F.count(F.lit(1)).alias("n_low"))

    keep = o.select(F.col("o_orderkey").alias("order_or_customer"), F.col("o_orderpriority").alias("priority"),
                    F.round("o_totalprice", 8).alias("amount"), "o_orderpriority", "o_custkey", "o_totalprice")
    out = unions.split_repair_union(keep, F.col("o_orderpriority") == "5-LOW",
                                    lambda p: repair(p))
    return out.select("order_or_customer", "priority", "amount", "n_low")


@query("f1_f4_f6_f12_f14_filters", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_acctbal > 0 AND c_nationkey <> 7
  AND regexp_matches(c_name, '[13579]$')
  AND NOT (c_mktsegment = 'BUILDING' AND c_acctbal < 5000)
  AND length(c_name) > 17
  AND c_mktsegment NOT IN ('HOUSEHOLD', 'FURNITURE')
""")
def filters(spark, d):
    c = _t(spark, d, "customer")
    seg = F.col("c_mktsegment")
    return c.filter((F.col("c_acctbal") > 0) & (F.col("c_nationkey") != 7)                      # F1
                    & text.detect("c_name", "[13579]$")                                        # F4
                    & ~((seg == "BUILDING") & (F.col("c_acctbal") < 5000))                     # F6
                    & (text.n_chars("c_name") > 17)                                            # F12
                    & ~seg.isin("HOUSEHOLD", "FURNITURE")) \
        .select("c_custkey", "c_name", "c_mktsegment")                                         # F14


@query("p5_p7_p10_p11_p12_s11_column_helpers", """
SELECT c_custkey AS customer_key, lower(c_name) AS c_name, lower(c_mktsegment) AS c_mktsegment,
       c_nationkey, 2016 AS year, 'customer' AS source
FROM customer
""")
def column_helpers(spark, d):
    from ..sources.readers import normalise_header

    c = _t(spark, d, "customer")
    c = clean.rename_with(c, lambda n: f'"{n.upper()}"')                  # P11: names as a raw export would have them
    c = normalise_header(c)                                               # S11: back to clean names
    c = clean.drop_matching(c, ends="acctbal")                            # P5
    c = clean.map_matching(c, F.lower, regex="name$|segment$")            # P10
    c = clean.rename(c, {"customer_key": "c_custkey"})                    # P7
    return clean.with_constant(c, year=2016, source="customer")           # P12


@query("stream_event_hourly_totals", """
SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS value
FROM events GROUP BY 1, 2
""")
def stream_event_hourly_totals(spark, d):
    """Structured Streaming: hourly event totals computed incrementally over the
    events file (availableNow trigger, foreachBatch into shared storage)."""
    from ..streaming.ingest import windowed_totals

    schema = _t(spark, d, "events").schema
    out = windowed_totals(spark, d, "events.parquet", schema, "ts", "1 hour", ["event_type"], "value")
    return out.withColumn("value", F.round("value", 2))


@query("stream_landing_orders", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS order_year
FROM orders
""")
def stream_landing_orders(spark, d):
    """Structured Streaming: the orders file landed incrementally (file source,
    ``availableNow``, exactly-once Parquet sink partitioned by year, source log
    in the shared checkpoint folder) and read back as a table."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..streaming.ingest import land

    schema = _t(spark, d, "orders").schema
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/landing-{uuid.uuid4().hex}"
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(d)
              .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                      F.year("o_orderdate").alias("order_year")))
    land(stream, base + "/orders", partition_by=("order_year",), checkpoint=base + "/checkpoint").awaitTermination()
    return spark.read.parquet(base + "/orders")


# --------------------------------------------------------------------------- statistics

@query("m3_price_histogram", """
SELECT l_returnflag, floor(l_extendedprice / 10000.0) * 10000.0 AS bin, count(*) AS n,
       round(CAST(count(*) AS DOUBLE) / (CAST(sum(count(*)) OVER (PARTITION BY l_returnflag) AS DOUBLE) * 10000.0),
             14) AS density
FROM lineitem GROUP BY 1, 2
""")
def price_histogram(spark, d):
    h = stats.histogram_density(_t(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", 10000.0)
    return h.withColumn("bin", F.col("bin").cast("double")).withColumn("density", F.round("density", 14))


@query("m4_event_type_frequency_by_user", """
SELECT user_id, event_type, count(*) AS n,
       round(count(*) / sum(count(*)) OVER (PARTITION BY user_id), 6) AS prop
FROM events GROUP BY 1, 2
""")
def event_type_frequency(spark, d):
    f = stats.relative_frequency(_t(spark, d, "events"), ["user_id"], "event_type")
    return f.withColumn("prop", F.round("prop", 6))


@query("m2_ols_price_on_quantity", """
WITH s AS (SELECT count(*) AS n, avg(l_quantity) AS mx, regr_slope(l_extendedprice, l_quantity) AS b,
                  regr_intercept(l_extendedprice, l_quantity) AS a, regr_sxx(l_extendedprice, l_quantity) AS sxx,
                  regr_syy(l_extendedprice, l_quantity) AS syy FROM lineitem),
c AS (SELECT a, b, sqrt((syy - b * b * sxx) / (n - 2) * (1.0 / n + mx * mx / sxx)) AS sa,
             sqrt((syy - b * b * sxx) / (n - 2) / sxx) AS sb FROM s)
SELECT '(Intercept)' AS term, round(a, 4) AS estimate, round(sa, 4) AS std_error, round(a / sa, 4) AS statistic
FROM c
UNION ALL
SELECT 'l_quantity', round(b, 4), round(sb, 4), round(b / sb, 4) FROM c
""")
def ols_price_on_quantity(spark, d):
    """M2 with a closed-form oracle: ``lm(price ~ quantity)`` coefficient table
    (estimate, std. error, t) from distributed normal equations."""
    li = _t(spark, d, "lineitem").select("l_extendedprice", "l_quantity")
    t = stats.linear_regression(li, "l_extendedprice", ["l_quantity"])
    return t.select("term", *[F.round(c, 4).alias(c) for c in ("estimate", "std_error", "statistic")])


def _newton_sql(steps: int) -> str:
    """The logit of a return on quantity and discount by Newton steps over the distinct (quantity, discount) rows,
    each solved by the adjugate of the 3 x 3 information matrix."""
    ctes = ["""g AS MATERIALIZED (SELECT l_quantity AS q, l_discount AS d, count(*)::DOUBLE AS n,
  sum(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)::DOUBLE AS y FROM lineitem GROUP BY 1, 2)""",
            "b0 AS (SELECT ln(sum(y) / (sum(n) - sum(y))) AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 FROM g)"]
    for k in range(1, steps + 1):
        ctes.append(f"""s{k} AS (SELECT any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2, sum(w) AS a, sum(w * q) AS b,
  sum(w * d) AS c, sum(w * q * q) AS e, sum(w * q * d) AS f, sum(w * d * d) AS h, sum(r) AS r0, sum(r * q) AS r1, sum(r * d) AS r2
  FROM (SELECT *, n * m * (1 - m) AS w, y - n * m AS r
        FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * q + b2 * d))) AS m FROM g CROSS JOIN b{k - 1})))""")
        ctes.append(f"""b{k} AS (SELECT b0 + ((e * h - f * f) * r0 + (c * f - b * h) * r1 + (b * f - c * e) * r2) / det AS b0,
  b1 + ((c * f - b * h) * r0 + (a * h - c * c) * r1 + (b * c - a * f) * r2) / det AS b1,
  b2 + ((b * f - c * e) * r0 + (b * c - a * f) * r1 + (a * e - b * b) * r2) / det AS b2,
  sqrt((e * h - f * f) / det) AS s0, sqrt((a * h - c * c) / det) AS s1, sqrt((a * e - b * b) / det) AS s2
  FROM (SELECT *, a * (e * h - f * f) + b * (c * f - b * h) + c * (b * f - c * e) AS det FROM s{k}))""")
    rows = [f"SELECT '{term}' AS term, round(b{i}, 4) AS estimate, round(s{i}, 4) AS std_error, round(b{i} / s{i}, 4) AS statistic FROM b{steps}"
            for i, term in enumerate(("(Intercept)", "l_quantity", "l_discount"))]
    return f"WITH {', '.join(ctes)} {' UNION ALL '.join(rows)}"


@query("m1_logit_returned", _newton_sql(8))
def logit_returned(spark, d):
    li = _t(spark, d, "lineitem").select((F.col("l_returnflag") == "R").cast("double").alias("returned"),
                                         "l_quantity", "l_discount")
    t = stats.logistic_regression(li, "returned", ["l_quantity", "l_discount"])
    return t.select("term", *[F.round(c, 4).alias(c) for c in ("estimate", "std_error", "statistic")])


@query("m2_linear_price_by_flag", """
WITH g AS (SELECT l_returnflag AS flag, count(*) AS n, avg(l_quantity) AS x, avg(l_extendedprice) AS y,
                  regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_sxy(l_extendedprice, l_quantity) AS sxy,
                  regr_syy(l_extendedprice, l_quantity) AS syy FROM lineitem GROUP BY 1),
w AS (SELECT sum(n) AS n, sum(sxx) AS sxx, sum(sxy) / sum(sxx) AS slope, count(*) AS k,
             (sum(syy) - sum(sxy) * sum(sxy) / sum(sxx)) / (sum(n) - count(*) - 1) AS s2 FROM g),
l AS (SELECT g.*, y - slope * x AS a, s2, w.sxx AS wxx, slope, row_number() OVER (ORDER BY flag) AS place FROM g CROSS JOIN w),
t AS (SELECT '(Intercept)' AS term, a AS estimate, sqrt(s2 * (1.0 / n + x * x / wxx)) AS se FROM l WHERE place = 1
      UNION ALL SELECT 'l_quantity', slope, sqrt(s2 / wxx) FROM l WHERE place = 1
      UNION ALL SELECT 'l_returnflag' || l.flag, l.a - o.a,
                       sqrt(l.s2 * (1.0 / l.n + 1.0 / o.n + (l.x - o.x) * (l.x - o.x) / l.wxx))
                FROM l JOIN l AS o ON o.place = 1 WHERE l.place > 1)
SELECT term, round(estimate, 4) AS estimate, round(se, 4) AS std_error, round(estimate / se, 4) AS statistic FROM t
""")
def linear_price(spark, d):
    li = _t(spark, d, "lineitem").select("l_extendedprice", "l_quantity", "l_returnflag")
    t = stats.linear_regression(li, "l_extendedprice", ["l_quantity"], ["l_returnflag"])
    return t.select("term", *[F.round(c, 4).alias(c) for c in ("estimate", "std_error", "statistic")])


@query("o5_hash_sample_orders", f"""
SELECT * FROM orders
WHERE ('0x' || substr(md5('1789|' || o_orderkey::VARCHAR), 1, 13))::BIGINT < {int(0.25 * (1 << 52))}
""")
def hash_sample(spark, d):
    return sorting.hash_sample(_t(spark, d, "orders"), 0.25, ["o_orderkey"], seed=1789)


@query("o5_seeded_sample_orders", """
SELECT * FROM orders
QUALIFY row_number() OVER (ORDER BY ('0x' || substr(md5('1789|' || o_orderkey::VARCHAR), 1, 13))::BIGINT, o_orderkey)
        <= (SELECT round_even(0.25 * count(*), 0) FROM orders)
""")
def seeded_sample(spark, d):
    return sorting.sample_exact(_t(spark, d, "orders"), 0.25, ["o_orderkey"], seed=1789)


@query("s21_split_orders", """
SELECT o_orderkey, o_orderstatus, year(o_orderdate) AS order_year,
       CASE WHEN year(o_orderdate) % 4 = 0 THEN 'local' ELSE 'fed_state' END AS output
FROM orders WHERE year(o_orderdate) % 2 = 0
UNION ALL
SELECT o_orderkey, o_orderstatus, year(o_orderdate), 'urgent' FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def split_orders(spark, d):
    """One pass writes three outputs (two sides and a slice across both); each is read back on its own."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..sources import sinks

    o = _t(spark, d, "orders").withColumn("order_year", F.year("o_orderdate").cast("long"))
    y = F.col("order_year")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/split-{uuid.uuid4().hex}"
    paths = sinks.write_split(o.select("o_orderkey", "o_orderstatus", "order_year", "o_orderpriority"), {
        "local": y % 4 == 0, "fed_state": y % 4 == 2, "urgent": F.col("o_orderpriority") == "1-URGENT"}, base)
    parts = [spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "order_year", F.lit(name).alias("output")) for name, path in paths.items()]
    return unions.bind_all(parts)


# --------------------------------------------------------------------------- sources / sinks

@query("s1_s20_csv_roundtrip_customer", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def csv_roundtrip(spark, d):
    """Write the table as Latin-1, ``;``-separated,
    gzip CSV with decimal commas into the shared checkpoint folder, then read
    it back with an explicit schema."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..sources import readers, sinks
    from ..sources.schemas import struct

    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/csv-roundtrip-{uuid.uuid4().hex}"
    c = _t(spark, d, "customer")
    sinks.write_delimited(c, base, sep=";", gzip=True, encoding=readers.LATIN1, decimal_comma=True)
    raw = readers.scan_delimited(spark, base, struct(
        "c_custkey string, c_name string, c_nationkey string, c_acctbal string, c_mktsegment string"),
        sep=";", encoding=readers.LATIN1)
    return raw.select(logic.try_long("c_custkey").alias("c_custkey"), "c_name",
                      logic.try_int("c_nationkey").alias("c_nationkey"),
                      logic.decimal_comma("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment")


@query("s2_s4_s6_s10_s14_s16_u3_tagged_files", """
SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, 'Ação; "' || o_orderpriority || '"' AS label,
       CASE WHEN year(o_orderdate) % 2 = 0 THEN 'even' ELSE 'odd' END AS tag,
       CAST(CASE WHEN year(o_orderdate) % 2 = 0 THEN 0 ELSE 1 END AS INTEGER) AS parity
FROM orders
""")
def tagged_files(spark, d):
    """Headerless ``;`` text in UTF-8 with empty fields (S2, S4, S10), written to two folders and read by one scan over
    both (S6, U3); the folder of a row's file tags it (S14), and an inline table gives the tag its number (S16)."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..sources import readers, sinks

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tagged-{uuid.uuid4().hex}"
    y = F.year("o_orderdate")
    o = _t(spark, d, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.concat(F.lit('Ação; "'), "o_orderpriority", F.lit('"')).alias("label"), y.alias("y"))
    paths = sinks.write_split(o, {"even": F.col("y") % 2 == 0, "odd": F.coalesce(F.col("y") % 2, F.lit(1)) == 1}, base,
                              fmt="csv", column="tag", sep=";", header=False, escape='"', emptyValue="")
    files = readers.scan_delimited(spark, list(paths.values()), readers.all_string_schema(["o_orderkey", "status", "label", "y"]),
                                   sep=";", header=False, encoding="UTF-8", path_column="_source_file")
    tags = readers.inline_table(spark, [("even", 0), ("odd", 1)], "tag string, parity int")
    x = files.withColumn("tag", F.regexp_extract("_source_file", r"/tag=(\w+)/", 1))
    return joins.left_join(x, tags, "tag").select(logic.try_long("o_orderkey").alias("o_orderkey"), "status", "label", "tag", "parity")


@query("x14_seat_quotients", """
SELECT c_nationkey, c_mktsegment, votes, seats, CAST(divisor AS INTEGER) AS divisor, round(votes / divisor, 8) AS quotient
FROM (SELECT *, unnest(range(1, seats + 1)) AS divisor
      FROM (SELECT c_nationkey, c_mktsegment, count(*) AS votes, CAST(c_nationkey % 7 AS BIGINT) AS seats FROM customer GROUP BY 1, 2))
""")
def seat_quotients(spark, d):
    """Every list's votes over 1, 2, ... up to its nation's seats; nations without a seat have no row."""
    votes = A.count_by(_t(spark, d, "customer"), ["c_nationkey", "c_mktsegment"]).withColumnRenamed("n", "votes")
    x = apportion.quotient_rows(votes.withColumn("seats", (F.col("c_nationkey") % 7).cast("long")), "seats", "votes")
    return x.withColumn("quotient", F.round("quotient", 8))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1].strip() for k, v in REGISTRY.items() if v[1]}
