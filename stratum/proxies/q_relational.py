"""Joins (C1-C3, C5, C8), aggregations (D1-D10), windows (E1-E4) and sorts (F1-F2)."""
from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import hierarchy as hier
from stratum.operators import running
from stratum.operators.joins import broadcast_bounded, lookup
from stratum.operators.pivot import LANGUAGES, pivot_by_key
from stratum.operators.scd2 import close_intervals
from stratum.plans import gold
from stratum.plans.star import Relationship, StarModel
from stratum.proxies import testdata as td
from stratum.proxies.registry import query
from stratum.proxies.sql import with_ctes

T = td.table


def customers_per_nation(spark, d):
    n = T(spark, d, "nation")
    per = T(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_customers"))
    return n.join(per, n["n_nationkey"] == per["c_nationkey"], "left").select("n_nationkey", "n_name", "n_customers")


@query("c1_left_join", """
SELECT n.n_nationkey, n.n_name, p.n_customers FROM nation n
LEFT JOIN (SELECT c_nationkey, CAST(count(*) AS BIGINT) AS n_customers FROM customer GROUP BY c_nationkey) p
ON n.n_nationkey = p.c_nationkey""")
def c1(spark, d):
    return customers_per_nation(spark, d)


@query("c2_left_join_conditioned", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name, s.s_name
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey AND p.p_brand = 'Brand#11'
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey AND s.s_nationkey < 5""")
def c2(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    p = T(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    s = T(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    j = lookup(li, p, li["l_partkey"] == p["p_partkey"], right_filter=F.col("p_brand") == "Brand#11")
    j = lookup(j, s, j["l_suppkey"] == s["s_suppkey"], right_filter=F.col("s_nationkey") < 5)
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "s_name")


@query("c3_left_lookup", """
SELECT e.event_id, c.c_nationkey AS UnitId FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey""")
def c3(spark, d):
    ev = T(spark, d, "events").select("event_id", "user_id")
    c = T(spark, d, "customer").select(F.col("c_custkey"), F.col("c_nationkey").alias("UnitId"))
    return lookup(ev, c, ev["user_id"] == c["c_custkey"], distinct_right=True).select("event_id", "UnitId")


CLOSE_SQL = """
WITH h AS (SELECT event_id, user_id, CAST(ts AS DATE) AS StartDate,
                  lead(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events)
SELECT event_id, user_id, StartDate,
       CASE WHEN nxt IS NOT NULL AND nxt >= StartDate THEN 0 ELSE 1 END AS Active,
       CASE WHEN nxt IS NOT NULL AND nxt >= StartDate THEN CAST(nxt - 1 AS DATE) END AS EndDate
FROM h"""


def events_history(spark, d):
    ev = T(spark, d, "events")
    return ev.select("event_id", "user_id", "ts", F.to_date("ts").alias("StartDate"),
                     F.lit(1).alias("Active"), F.lit(None).cast("date").alias("EndDate"))


@query("c5_merge_self_update", CLOSE_SQL)
def c5(spark, d):
    h = close_intervals(events_history(spark, d), "user_id", ["ts", "event_id"])
    return h.select("event_id", "user_id", "StartDate", "Active", "EndDate")


@query("e2_scd2_close", CLOSE_SQL)
def e2(spark, d):
    h = close_intervals(events_history(spark, d), "user_id", ["ts", "event_id"], skew_safe=True)
    return h.select("event_id", "user_id", "StartDate", "Active", "EndDate")


@query("c8_cumulative_range_join", """
WITH days AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS period FROM events)
SELECT d.event_type, d.period, CAST(count(*) AS BIGINT) AS running_count
FROM days d JOIN events e ON e.event_type = d.event_type AND CAST(e.ts AS DATE) <= d.period
GROUP BY d.event_type, d.period""")
def c8(spark, d):
    return running.running_count(T(spark, d, "events"), ["event_type"], "ts").withColumn(
        "running_count", F.col("running_count").cast("long"))


@query("d1_global_min", "SELECT min(o_orderdate) AS first_order FROM orders")
def d1(spark, d):
    return T(spark, d, "orders").agg(F.min("o_orderdate").alias("first_order"))


HIER_SQL = """paths AS (
  SELECT c.c_custkey AS Id, concat_ws(' > ', r.r_name, n.n_name, c.c_name) AS path
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def customer_paths(spark, d):
    c, n, r = T(spark, d, "customer"), T(spark, d, "nation"), T(spark, d, "region")
    j = lookup(lookup(c, n, c["c_nationkey"] == n["n_nationkey"]), r, F.col("n_regionkey") == r["r_regionkey"])
    return j.select(F.col("c_custkey").alias("Id"), hier.hierarchy_path("r_name", "n_name", "c_name").alias("path"))


@query("d2_pivot_levels", with_ctes(HIER_SQL) + "SELECT Id, " + ", ".join(
    f"trim(string_split(path, '>')[{i}]) AS Level{i}" for i in range(1, 9)) + ", array_to_string(list_transform(string_split(path, '>'), lambda x: trim(x)), ' > ') AS Levels FROM paths")
def d2(spark, d):
    p = customer_paths(spark, d)
    return p.select("Id", *hier.level_columns("path", with_all=True))


@query("e1_row_number_position", with_ctes(HIER_SQL) + """
SELECT Id, CAST(generate_subscripts(string_split(path, '>'), 1) AS INTEGER) AS position,
       trim(unnest(string_split(path, '>'))) AS level FROM paths""")
def e1(spark, d):
    return hier.explode_levels(customer_paths(spark, d), "Id", "path")


@query("d3_pivot_language", """
SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_returnflag END) AS ptBR,
       max(CASE WHEN l_linenumber = 2 THEN l_returnflag END) AS enUS,
       max(CASE WHEN l_linenumber = 3 THEN l_returnflag END) AS esES
FROM lineitem GROUP BY l_orderkey""")
def d3(spark, d):
    return pivot_by_key(T(spark, d, "lineitem"), "l_orderkey", "l_linenumber", "l_returnflag", LANGUAGES)


@query("d4_count_rows_zero", """
WITH per AS (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY c_nationkey)
SELECT n.n_name, CAST(coalesce(sum(p.n), 0) AS BIGINT) AS n_customers
FROM nation n LEFT JOIN per p ON n.n_nationkey = p.c_nationkey GROUP BY n.n_name""")
def d4(spark, d):
    m = StarModel({"customer": T(spark, d, "customer"), "nation": T(spark, d, "nation")},
                  [Relationship("customer", "c_nationkey", "nation", "n_nationkey")])
    return m.count_rows("customer", "nation", ["n_name"], "n_customers", fact_filter=F.col("c_acctbal") > 9000,
                        zero_fill=True)


@query("d5_distinct_count", """
SELECT event_type, CAST(count(DISTINCT user_id) + max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_users
FROM events GROUP BY event_type""")
def d5(spark, d):
    ev = T(spark, d, "events")
    return ev.groupBy("event_type").agg(
        (F.countDistinct("user_id") + F.max(F.col("user_id").isNull().cast("int"))).cast("long").alias("n_users"))


@query("d6_distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def d6(spark, d):
    return T(spark, d, "events").select("user_id", "event_type").distinct()


@query("d7_string_agg", """
SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_nationkey) AS nations FROM nation GROUP BY n_regionkey""")
def d7(spark, d):
    n = T(spark, d, "nation")
    return n.groupBy("n_regionkey").agg(F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda s: s["n_name"]), ", ")
        .alias("nations"))


@query("d8_default_summarize", """
SELECT o_orderstatus, round(sum(o_totalprice), 2) AS sum_o_totalprice, CAST(count(o_orderkey) AS BIGINT) AS count_o_orderkey
FROM orders GROUP BY o_orderstatus""")
def d8(spark, d):
    from stratum.plans.summarize import summarize
    out = summarize(T(spark, d, "orders"), ["o_orderstatus"], {"o_totalprice": "sum", "o_orderkey": "count"})
    # the two engines add doubles in different orders; only this comparison rounds
    return out.withColumn("sum_o_totalprice", F.round("sum_o_totalprice", 2))


TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@query("d9_row_count", " UNION ALL ".join(f"SELECT '{t}' AS source, CAST(count(*) AS BIGINT) AS n_rows FROM {t}"
                                          for t in TABLES))
def d9(spark, d):
    out = None
    for t in TABLES:
        part = T(spark, d, t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("source"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


CAL_SQL = f"""cal AS (
  SELECT CAST(d AS DATE) AS DateRef FROM (SELECT unnest(generate_series(CAST((SELECT min(o_orderdate) FROM orders) AS DATE),
         DATE '{td.CAL_RUN_DATE[:4]}-12-31', INTERVAL 1 DAY)) AS d))"""


def orders_calendar(spark, d):
    o = T(spark, d, "orders").select(F.col("o_orderdate").alias("DataCriacao"))
    return gold.dim_calendar(o, td.CAL_RUN_DATE)


@query("d10_max_in_context", with_ctes(CAL_SQL) + """
SELECT CAST(year(DateRef) AS INTEGER) AS Year, CAST(month(DateRef) AS INTEGER) AS MonthNumber, max(DateRef) AS max_date FROM cal GROUP BY 1, 2""")
def d10(spark, d):
    return orders_calendar(spark, d).groupBy("Year", "MonthNumber").agg(F.max("DateRef").alias("max_date"))


@query("f2_sort_multi_asc", with_ctes(CAL_SQL) + """
SELECT DISTINCT CAST(year(DateRef) AS INTEGER) AS Year, CAST(month(DateRef) AS INTEGER) AS MonthNumber FROM cal ORDER BY 1, 2""")
def f2(spark, d):
    return orders_calendar(spark, d).select("Year", "MonthNumber").distinct().orderBy("Year", "MonthNumber")


@query("f1_sort_by_measure_desc", """
SELECT n.n_name, CAST(count(*) AS BIGINT) AS n_customers FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name ORDER BY n_customers DESC, n.n_name""")
def f1(spark, d):
    c = T(spark, d, "customer")
    n = broadcast_bounded(T(spark, d, "nation"))
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_customers")).orderBy(F.desc("n_customers"), "n_name")


@query("e3_running_count", """
WITH per AS (SELECT o_orderstatus, last_day(CAST(o_orderdate AS DATE)) AS period, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_orderstatus, period, CAST(sum(n) OVER (PARTITION BY o_orderstatus ORDER BY period
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_count FROM per""")
def e3(spark, d):
    out = running.running_count(T(spark, d, "orders"), ["o_orderstatus"], "o_orderdate", period="month")
    return out.withColumn("running_count", F.col("running_count").cast("long"))


@query("e4_running_distinct", """
WITH days AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS period FROM events),
first AS (SELECT event_type, user_id, min(CAST(ts AS DATE)) AS first_day FROM events GROUP BY 1, 2)
SELECT d.event_type, d.period, CAST(count(f.user_id) AS BIGINT) AS running_distinct
FROM days d LEFT JOIN first f ON f.event_type = d.event_type AND f.first_day <= d.period
WHERE d.period IN (SELECT first_day FROM first f2 WHERE f2.event_type = d.event_type)
GROUP BY d.event_type, d.period""")
def e4(spark, d):
    out = running.running_distinct(T(spark, d, "events"), ["event_type"], "ts", "user_id")
    return out.withColumn("running_distinct", F.col("running_distinct").cast("long"))
