"""Projections, predicates (B1-B20) and scalar functions (H1-H18) on the test tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from stratum.functions import audit, casts, dates, json as fjson, names
from stratum.operators import hierarchy as hier
from stratum.operators.joins import broadcast_bounded, lookup
from stratum.operators.partitioning import spread
from stratum.plans import gold, measures as M, silver
from stratum.proxies import testdata as td
from stratum.proxies.q_reports import history, star
from stratum.proxies.registry import query
from stratum.proxies.sql import FACT, HIS, STAR, with_ctes

T = td.table


@query("b1_project_rename", """
SELECT o_orderkey AS Id, o_custkey AS UnitId, o_orderstatus AS Status, CAST(o_orderdate AS DATE) AS CreationDate FROM orders""")
def b1(spark, d):
    o = T(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("Id"), F.col("o_custkey").alias("UnitId"),
                    F.col("o_orderstatus").alias("Status"), F.to_date("o_orderdate").alias("CreationDate"))


@query("b2_clean_column_names", "SELECT * FROM part")
def b2(spark, d):
    p = T(spark, d, "part")
    messy = p.toDF(*[c.replace("_", " ", 1) if i % 2 == 0 else c.replace("_", "/", 1) for i, c in enumerate(p.columns)])
    return names.clean_column_names(messy)


@query("b3_constant_columns", """
SELECT o_orderkey, 1 AS Active, CAST(NULL AS DATE) AS EndDate, CAST(NULL AS INTEGER) AS OccupationalRiskHisId FROM orders""")
def b3(spark, d):
    o = T(spark, d, "orders")
    return o.select("o_orderkey", F.lit(1).alias("Active"), F.lit(None).cast("date").alias("EndDate"),
                    F.lit(None).cast("int").alias("OccupationalRiskHisId"))


CLASS_PROXY_SQL = """classe_risco AS (
  SELECT p_partkey AS Id, p_size AS Peso, p_size < 25 AS ClasseAceitavel, p_size AS Inicio, p_size + 10 AS Fim,
         p_brand AS CorFundo, p_type AS CorTexto, CASE WHEN p_size <= 25 THEN 'R' ELSE 'A' END AS PSR,
         CASE WHEN p_brand < 'Brand#3' THEN 1 ELSE 2 END AS Modulo FROM part)"""


def classe_risco(spark, d):
    p = T(spark, d, "part")
    return p.select(F.col("p_partkey").alias("Id"), F.col("p_size").alias("Peso"),
                    (F.col("p_size") < 25).alias("ClasseAceitavel"), F.col("p_size").alias("Inicio"),
                    (F.col("p_size") + 10).alias("Fim"), F.col("p_brand").alias("CorFundo"), F.col("p_type").alias("CorTexto"),
                    F.when(F.col("p_size") <= 25, "R").otherwise("A").alias("PSR"),
                    F.when(F.col("p_brand") < "Brand#3", 1).otherwise(2).alias("Modulo"))


@query("b4_filter_conjunction", with_ctes(CLASS_PROXY_SQL) + """
SELECT Id, Peso, ClasseAceitavel, Inicio, Fim, CorFundo, CorTexto FROM classe_risco WHERE PSR = 'R' AND Modulo = 1""")
def b4(spark, d):
    return gold.dim_risk_class(classe_risco(spark, d))


@query("b5_filter_language", "SELECT doc_id, text, lang, source FROM documents WHERE lang = 'en'")
def b5(spark, d):
    return T(spark, d, "documents").filter(F.col("lang") == "en").select("doc_id", "text", "lang", "source")


@query("b6_filter_in_list", """
SELECT CAST(l_quantity AS INTEGER) AS class_id, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
WHERE CAST(l_quantity AS INTEGER) IN (9, 12, 13, 14, 15) GROUP BY 1""")
def b6(spark, d):
    li = T(spark, d, "lineitem").select(F.col("l_quantity").cast("int").alias("class_id"))
    return li.filter(F.col("class_id").isin(9, 12, 13, 14, 15)).groupBy("class_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query("b7_filter_not_null_member", STAR + """
, per AS (SELECT LinearClassId AS k, count(*) AS n FROM fact f WHERE NOT coalesce(f.Eliminated, false) GROUP BY 1)
SELECT l.ptBR, CAST(sum(p.n) AS BIGINT) AS active_risks_rrn FROM per p JOIN lang l ON p.k = l.Id GROUP BY l.ptBR""")
def b7(spark, d):
    m = star(spark, d, False)
    out = M.active_risks_rrn(m, ("ptBR",), zero_fill=False)
    return out.filter(F.col("ptBR").isNotNull())


@query("b8_filter_relative_date", """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n_orders FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-15' AND DATE '1996-03-15' GROUP BY o_orderstatus""")
def b8(spark, d):
    today = dates.date_lit("1996-03-15")
    o = T(spark, d, "orders")
    return o.filter((F.col("o_orderdate") >= today) & (F.col("o_orderdate") < F.date_add(today, 1))).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders"))


@query("b9_filter_null_or_range", with_ctes(HIS.replace("audit AS", "audit AS", 1)) + """
SELECT OccupationalRiskHisId, EndDate FROM his WHERE EndDate IS NULL OR EndDate >= last_day(DATE '2024-01-15')""")
def b9(spark, d):
    h = history(spark, d)
    return h.filter(F.col("EndDate").isNull() | (F.col("EndDate") >= dates.eomonth(dates.date_lit("2024-01-15")))) \
            .select("OccupationalRiskHisId", "EndDate")


@query("b10_filter_not_equal_blank", """
SELECT d.doc_id, l.quality - 1 AS status FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE coalesce(l.quality - 1, 0) <> -1""")
def b10(spark, d):
    docs = T(spark, d, "documents").select("doc_id")
    lab = T(spark, d, "labels").select("doc_id", (F.col("quality") - 1).alias("status"))
    j = docs.join(lab, "doc_id", "left")
    return j.filter(M.status_not(-1, "status")).select("doc_id", "status")


@query("b11_filter_not_eliminated", """
SELECT l_linestatus, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
WHERE NOT coalesce(l_returnflag = 'R', false) GROUP BY l_linestatus""")
def b11(spark, d):
    li = T(spark, d, "lineitem").withColumn("Eliminated", F.col("l_returnflag") == "R")
    return li.filter(M.not_eliminated()).groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n_rows"))


@query("b12_case_when", """
SELECT o_orderkey, CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS Semester,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Unacceptable' ELSE 'Acceptable' END AS Tolerability
FROM orders""")
def b12(spark, d):
    o = T(spark, d, "orders")
    return o.select("o_orderkey", dates.semester("o_orderdate").alias("Semester"),
                    F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Unacceptable")
                     .otherwise("Acceptable").alias("Tolerability"))


@query("b13_drop_columns", "SELECT p_partkey, p_name, p_brand, p_size FROM part")
def b13(spark, d):
    return T(spark, d, "part").drop("p_type", "p_retailprice")


@query("b14_rename_column", with_ctes(FACT.split(",\nfact AS")[0]) + """
SELECT r.Id, a.n_name AS Descricao_Classe, b.n_name AS Descricao_Severidade, c.n_name AS Descricao_Probabilidade
FROM risk r LEFT JOIN nation a ON r.ClasseId = a.n_nationkey
LEFT JOIN nation b ON r.ClassePosControleId = b.n_nationkey
LEFT JOIN nation c ON r.ClasseLinearPosControleId = c.n_nationkey""")
def b14(spark, d):
    r = td.risco_ocupacional(spark, d)
    n = T(spark, d, "nation").select("n_nationkey", "n_name")
    roles = {"Descricao_Classe": "ClasseId", "Descricao_Severidade": "ClassePosControleId",
             "Descricao_Probabilidade": "ClasseLinearPosControleId"}
    out = r.select("Id", *roles.values())
    for new, key in roles.items():
        copy = n.withColumnRenamed("n_name", new).withColumnRenamed("n_nationkey", f"__k_{new}")
        out = lookup(out, copy, F.col(key) == F.col(f"__k_{new}")).drop(f"__k_{new}")
    return out.select("Id", *roles.keys())


def _json_family_sql() -> str:
    nulls = ", ".join([f"CAST(NULL AS INTEGER) AS v{i}" for i in range(1, 16)] +
                      [f"CAST(NULL AS INTEGER) AS c{i}" for i in range(1, 41)])
    return f"SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, {nulls} FROM events"


@query("b15_generate_columns", _json_family_sql())
def b15(spark, d):
    ev = spread(T(spark, d, "events"))
    fields = {"k": "int", **fjson.generated_fields("v", 15), **fjson.generated_fields("c", 40)}
    return fjson.json_select(ev, "props", fields, keep=["event_id"])


@query("b16_final_schema", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment,
       CAST(c_acctbal AS DECIMAL(15,2)) AS c_acctbal FROM customer""")
def b16(spark, d):
    c = T(spark, d, "customer")
    return casts.conform(c, "c_custkey bigint, c_name string, c_nationkey bigint, c_mktsegment string, c_acctbal decimal(15,2)")


@query("b17_dedup_rows", "SELECT DISTINCT text, lang FROM documents")
def b17(spark, d):
    return silver.bronze_to_silver(T(spark, d, "documents").select("text", "lang"), apply_distinct=True)


@query("b18_cte_composition", """
WITH per_customer AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey)
SELECT n_orders, CAST(count(*) AS BIGINT) AS n_customers FROM per_customer GROUP BY n_orders""")
def b18(spark, d):
    per = T(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    return per.groupBy("n_orders").agg(F.count(F.lit(1)).alias("n_customers"))


@query("b19_non_empty_guard", """
SELECT 'region' AS source, (SELECT count(*) FROM region) > 0 AS non_empty
UNION ALL SELECT 'nation', (SELECT count(*) FROM nation) > 0
UNION ALL SELECT 'orders_negative_price', (SELECT count(*) FROM orders WHERE o_totalprice < 0) > 0""")
def b19(spark, d):
    frames = {"region": T(spark, d, "region"), "nation": T(spark, d, "nation"),
              "orders_negative_price": T(spark, d, "orders").filter(F.col("o_totalprice") < 0)}
    rows = [(k, not v.isEmpty()) for k, v in frames.items()]
    return spark.createDataFrame(rows, "source string, non_empty boolean")


@query("b20_slicer_filter", """
SELECT CAST(month(o_orderdate) AS INTEGER) AS MonthNumber, CAST(count(*) AS BIGINT) AS n_orders FROM orders
WHERE year(o_orderdate) = 1997 GROUP BY 1""")
def b20(spark, d):
    o = T(spark, d, "orders")
    # a half-open range on the bare column reaches the scan
    o = o.filter((F.col("o_orderdate") >= dates.date_lit("1997-01-01")) & (F.col("o_orderdate") < dates.date_lit("1998-01-01")))
    return o.groupBy(F.month("o_orderdate").alias("MonthNumber")).agg(F.count(F.lit(1)).alias("n_orders"))


# -- scalar functions --------------------------------------------------------------------------
@query("h1_row_hash", """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
       md5(concat_ws('|', coalesce(CAST(c_custkey AS VARCHAR), ''), coalesce(c_name, ''),
                     coalesce(CAST(c_nationkey AS VARCHAR), ''), coalesce(c_mktsegment, ''))) AS hash_row
FROM customer""")
def h1(spark, d):
    c = T(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return audit.with_row_hash(c)


@query("h2_audit_columns", f"""
SELECT r_regionkey, r_name, TIMESTAMP '{td.RUN_TS_1}' AS insert_date, TIMESTAMP '{td.RUN_TS_1}' AS update_date,
       md5(concat_ws('|', coalesce(CAST(r_regionkey AS VARCHAR), ''), coalesce(r_name, ''))) AS hash_row
FROM region""")
def h2(spark, d):
    return audit.with_audit_columns(T(spark, d, "region"), td.RUN_TS_1 + ".123456")


@query("h3_concat_ws", """
SELECT n.n_nationkey, concat_ws(' > ', r.r_name, CASE WHEN n.n_nationkey > 20 THEN NULL ELSE n.n_name END) AS path
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def h3(spark, d):
    n, r = T(spark, d, "nation"), T(spark, d, "region")
    j = lookup(n, r, n["n_regionkey"] == r["r_regionkey"])
    return j.select("n_nationkey", hier.hierarchy_path("r_name", F.when(F.col("n_nationkey") <= 20, F.col("n_name")))
                    .alias("path"))


PATH_SQL = """paths AS (
  SELECT n.n_nationkey AS id, r.r_name || '>' || n.n_name || ' >  x' AS path
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""


@query("h4_split_trim_explode", with_ctes(PATH_SQL) + """
SELECT id, CAST(generate_subscripts(string_split(path, '>'), 1) AS INTEGER) AS position,
       trim(unnest(string_split(path, '>'))) AS level FROM paths""")
def h4(spark, d):
    n, r = T(spark, d, "nation"), T(spark, d, "region")
    j = lookup(n, r, n["n_regionkey"] == r["r_regionkey"])
    p = j.select(F.col("n_nationkey").alias("id"), F.concat("r_name", F.lit(">"), "n_name", F.lit(" >  x")).alias("path"))
    return hier.explode_levels(p, "id", "path")


@query("h5_coalesce", """
SELECT o_orderkey, CAST(coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 10 DAY END, o_orderdate) AS DATE) AS ref_date,
       coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, '') AS status_text
FROM orders""")
def h5(spark, d):
    o = T(spark, d, "orders")
    upd = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("interval 10 days"))
    return o.select("o_orderkey", F.to_date(F.coalesce(upd, F.col("o_orderdate"))).alias("ref_date"),
                    F.coalesce(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), F.lit("")).alias("status_text"))


@query("h6_casts", """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_text, CAST(o_totalprice AS DECIMAL(38,2)) AS price,
       o_orderstatus = 'F' AS finished, CAST(o_orderdate AS DATE) AS order_date,
       CAST(trunc(o_totalprice / 1000) AS INTEGER) AS price_k,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(trunc(o_totalprice / 1000) AS INTEGER) END AS lenient_k
FROM orders""")
def h6(spark, d):
    o = T(spark, d, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(
        F.format_string("%.5f", F.col("o_totalprice") / 1000))
    return o.select("o_orderkey", F.col("o_orderkey").cast("string").alias("key_text"),
                    casts.money_to_decimal("o_totalprice").alias("price"),
                    (F.col("o_orderstatus") == "F").alias("finished"), F.to_date("o_orderdate").alias("order_date"),
                    (F.col("o_totalprice") / 1000).try_cast("int").alias("price_k"),
                    casts.lenient_int(text).alias("lenient_k"))


@query("h7_to_date", "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem")
def h7(spark, d):
    return T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_date"))


@query("h8_date_add_sub", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) + 50 AS expires, CAST(o_orderdate AS DATE) - 1 AS day_before FROM orders""")
def h8(spark, d):
    o = T(spark, d, "orders")
    return o.select("o_orderkey", dates.expiry(F.lit(None).cast("timestamp_ntz"), F.col("o_orderdate"), 50).alias("expires"),
                    F.date_sub(F.to_date("o_orderdate"), 1).alias("day_before"))


@query("h9_date_parts", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, CAST(day(o_orderdate) AS INTEGER) AS DayNumber, CAST(month(o_orderdate) AS INTEGER) AS MonthNumber,
       CAST(year(o_orderdate) AS INTEGER) AS Year, CAST(quarter(o_orderdate) AS INTEGER) AS Quarter, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS DayOfWeekNumber,
       CAST(dayofyear(o_orderdate) AS INTEGER) AS DayOfYear FROM orders""")
def h9(spark, d):
    o = T(spark, d, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return o.select("d", F.dayofmonth("d").alias("DayNumber"), F.month("d").alias("MonthNumber"), F.year("d").alias("Year"),
                    F.quarter("d").alias("Quarter"), F.dayofweek("d").alias("DayOfWeekNumber"),
                    F.dayofyear("d").alias("DayOfYear"))


@query("h10_date_format", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS YearMonthDay, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp
FROM orders""")
def h10(spark, d):
    o = T(spark, d, "orders")
    return o.select("o_orderkey", dates.format_ntz("o_orderdate", "yyyyMMdd").alias("YearMonthDay"),
                    dates.format_ntz("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("stamp"))


@query("h11_last_day_make_date", """
SELECT o_orderkey, last_day(o_orderdate) AS month_end, last_day(make_date(year(o_orderdate), 12, 1)) AS year_end
FROM orders""")
def h11(spark, d):
    o = T(spark, d, "orders")
    return o.select("o_orderkey", dates.eomonth(F.to_date("o_orderdate")).alias("month_end"),
                    dates.year_end("o_orderdate").alias("year_end"))


@query("h12_date_sequence", """
SELECT o_orderkey, CAST(unnest(generate_series(CAST(o_orderdate AS DATE),
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) + 2 END, INTERVAL 1 DAY)) AS DATE) AS day
FROM orders""")
def h12(spark, d):
    o = T(spark, d, "orders")
    end = F.when(F.col("o_orderstatus") != "P", F.date_add(F.to_date("o_orderdate"), 2))
    return o.select("o_orderkey", F.explode(F.sequence(F.to_date("o_orderdate"), end, F.expr("interval 1 day"))).alias("day"))


@query("h13_interval_arith", """
SELECT o_orderkey, o_orderdate - INTERVAL 3 HOUR AS local_ts, o_orderdate + INTERVAL 7 DAY AS week_later FROM orders""")
def h13(spark, d):
    o = T(spark, d, "orders")
    return o.select("o_orderkey", dates.shift_hours("o_orderdate", -3).alias("local_ts"),
                    (F.col("o_orderdate") + F.make_interval(days=F.lit(7))).alias("week_later"))


@query("h14_json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def h14(spark, d):
    ev = T(spark, d, "events")
    return ev.select("event_id", *fjson.json_fields("props", {"k": "int"}))


def _audit_fields_sql() -> str:
    cols = ["CAST(floor(k / 4) AS INTEGER) AS ClasseId", "CAST(floor(k / 4) AS INTEGER) AS ClassePosControleId",
            "CAST(floor(k / 4) AS INTEGER) + 1 AS ClasseLinearId", "CAST(NULL AS INTEGER) AS ClasseLinearPosControleId",
            "CAST(trunc(value) AS INTEGER) AS RiscoLinear", "CAST(NULL AS INTEGER) AS RiscoLinearPosControle",
            "event_type = 'signup' AS Deletado", "CASE WHEN event_type = 'error' THEN -1 ELSE 1 END AS Status",
            "k AS v1"]
    cols += [f"CAST(NULL AS INTEGER) AS v{i}" for i in range(2, 16)]
    cols += ["CAST(trunc(value) AS INTEGER) AS c1"] + [f"CAST(NULL AS INTEGER) AS c{i}" for i in range(2, 41)]
    return ("SELECT event_id AS Id, " + ", ".join(cols) +
            " FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)")


@query("h15_json_fields_wide", _audit_fields_sql())
def h15(spark, d):
    raw = td.risco_auditoria(spark, d)
    wide = fjson.json_select(raw, "RegistroDepois", silver.audit_fields(), rename=silver.AUDIT_RENAMES, keep=["Id"])
    return wide


@query("h16_is_blank", """
SELECT d.doc_id, l.quality IS NULL AS unlabeled FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def h16(spark, d):
    docs = T(spark, d, "documents").select("doc_id")
    lab = T(spark, d, "labels").select("doc_id", "quality")
    return docs.join(lab, "doc_id", "left").select("doc_id", F.col("quality").isNull().alias("unlabeled"))


@query("h17_infinity_to_null", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS valid_from FROM orders""")
def h17(spark, d):
    o = T(spark, d, "orders")
    text = F.when(F.col("o_orderstatus") == "P",
                  F.when(F.col("o_orderpriority") < "3", F.lit("infinity")).otherwise(F.lit("-infinity"))) \
            .otherwise(dates.format_ntz("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return o.select("o_orderkey", casts.infinity_to_null(text).try_cast("timestamp_ntz").alias("valid_from"))


@query("h18_lower_names", "SELECT n_nationkey, lower(n_name) AS n_name_lower FROM nation")
def h18(spark, d):
    return T(spark, d, "nation").select("n_nationkey", F.lower("n_name").alias("n_name_lower"))
