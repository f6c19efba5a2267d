"""Table builders (K1-K27): build, guard non-empty, load through automated_load, read back."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.audit import with_audit_columns
from stratum.plans import contract, gold, silver
from stratum.operators.joins import lookup
from stratum.proxies import testdata as td
from stratum.proxies.q_predicates import CLASS_PROXY_SQL, classe_risco
from stratum.proxies.q_relational import CAL_SQL, orders_calendar
from stratum.proxies.q_sources import fresh
from stratum.proxies.registry import query
from stratum.proxies.sql import AUDIT, FACT, HIS, with_ctes
from stratum.session import scratch_path
from stratum.sources import files
from stratum.sources import tables as tb

T = td.table
TS1 = f"TIMESTAMP '{td.RUN_TS_1}'"
STAMP = f", {TS1} AS insert_date, {TS1} AS update_date"


class EmptySource(RuntimeError):
    pass


def build_and_load(spark, name: str, df: DataFrame, keys, drop_hash: bool = True) -> DataFrame:
    """The builder body: a non-empty guard (B19), then automated_load (A22) into a fresh table."""
    if df.isEmpty():
        raise EmptySource(f"{name}: source frame is empty, nothing to load")
    t = tb.Target(f"{fresh('gold')}.{name}", "external")
    out = tb.load(spark, df, t, "merge", keys=keys, run_ts=td.RUN_TS_1)
    return out.drop("hash_row") if drop_hash else out


@query("k1_dim_risk_class", with_ctes(CLASS_PROXY_SQL) + f"""
SELECT Id, Peso, ClasseAceitavel, Inicio, Fim, CorFundo, CorTexto{STAMP},
       md5(concat_ws('|', coalesce(CAST(Id AS VARCHAR), ''), coalesce(CAST(Peso AS VARCHAR), ''),
           coalesce(CAST(ClasseAceitavel AS VARCHAR), ''), coalesce(CAST(Inicio AS VARCHAR), ''),
           coalesce(CAST(Fim AS VARCHAR), ''), coalesce(CorFundo, ''), coalesce(CorTexto, ''))) AS hash_row
FROM classe_risco WHERE PSR = 'R' AND Modulo = 1""")
def k1(spark, d):
    return build_and_load(spark, "dim_risk_class", gold.dim_risk_class(classe_risco(spark, d)), "Id", drop_hash=False)


@query("k2_dim_unit", """
WITH paths AS (
  SELECT c.c_custkey AS Id, concat_ws(' > ', r.r_name, n.n_name, c.c_name) AS path
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE c.c_acctbal >= 0)
SELECT c.c_custkey AS UnitId, CAST(c.c_nationkey AS BIGINT) AS HigherUnitId, """ + ", ".join(
    f"trim(string_split(p.path, '>')[{i}]) AS Level{i}" for i in range(1, 9)) + f""",
       CASE WHEN p.path IS NOT NULL THEN array_to_string(list_transform(string_split(p.path, '>'), lambda x: trim(x)), ' > ') END AS Levels,
       c.c_acctbal AS Latitude, CAST(NULL AS DOUBLE) AS Longitude, c.c_nationkey AS LOTOMapExpired,
       0 AS SecurityMapExpired, CAST(length(c.c_mktsegment) AS INTEGER) AS RiskWithoutAction{STAMP}
FROM customer c LEFT JOIN paths p ON c.c_custkey = p.Id""")
def k2(spark, d):
    return build_and_load(spark, "dim_unit", gold.dim_unit(td.unidade(spark, d), td.unidade_idioma(spark, d)), "UnitId")


@query("k3_dim_calendar", with_ctes(CAL_SQL) + f"""
SELECT DateRef, CAST(day(DateRef) AS INTEGER) AS DayNumber, CAST(month(DateRef) AS INTEGER) AS MonthNumber, CAST(year(DateRef) AS INTEGER) AS Year,
       CAST(quarter(DateRef) AS INTEGER) AS Quarter, CASE WHEN month(DateRef) <= 6 THEN 1 ELSE 2 END AS Semester,
       strftime(DateRef, '%Y%m%d') AS YearMonthDay, CAST(dayofweek(DateRef) + 1 AS INTEGER) AS DayOfWeekNumber,
       CAST(dayofyear(DateRef) AS INTEGER) AS DayOfYear{STAMP} FROM cal""")
def k3(spark, d):
    return build_and_load(spark, "dim_calendar", orders_calendar(spark, d), "DateRef")


@query("k4_fact_occupational_risk", with_ctes(FACT) + f"SELECT *{STAMP} FROM fact")
def k4(spark, d):
    fact = gold.fact_occupational_risk(td.risco_ocupacional(spark, d))
    # Id is not unique in the stand-in data, so the fact is loaded with overwrite, not merge.
    t = tb.Target(f"{fresh('gold')}.fact_occupational_risk", "external")
    return tb.load(spark, fact, t, "overwrite", run_ts=td.RUN_TS_1).drop("hash_row")


@query("k5_fact_occupational_risk_his", with_ctes(HIS) + f"SELECT *{STAMP} FROM his")
def k5(spark, d):
    from stratum.proxies.q_reports import enriched_audit_table
    his = gold.fact_occupational_risk_his(enriched_audit_table(spark, d))
    return build_and_load(spark, "fact_occupational_risk_his", his, "OccupationalRiskHisId")


LANG_ROWS_SQL = """
SELECT n_nationkey AS Id, 1 AS IdiomaId, n_name AS Descricao, 'criterion' AS Criterio, n_nationkey AS ClasseRiscoIdiomaId FROM nation
UNION ALL SELECT n_nationkey, 2, lower(n_name), 'criterion', n_nationkey FROM nation
UNION ALL SELECT n_nationkey, 3, n_name || ' (es)', 'criterion', n_nationkey FROM nation"""

# Stand-in source of each pass-through builder: test table (or the language rows), its keys, and its columns by kind.
PASS_SOURCES = {
    "dim_language_risk_class": (f"({LANG_ROWS_SQL})", ["Id", "IdiomaId"], {}),
    "fact_action": ("orders", ["o_orderkey"], {"bigint": ["o_custkey"], "string": ["o_orderstatus", "o_orderpriority"], "timestamp_ntz": ["o_orderdate"], "double": ["o_totalprice"]}),
    "fact_risk_action": ("events", ["event_id"], {"bigint": ["user_id"], "string": ["event_type", "props"], "timestamp_ntz": ["ts"], "double": ["value"]}),
    "dim_characterization": ("documents", ["doc_id"], {"bigint": ["n_chars"], "string": ["lang", "source", "text"]}),
    "dim_option_characterization": ("part", ["p_partkey"], {"bigint": ["p_size"], "string": ["p_name", "p_brand", "p_type"], "double": ["p_retailprice"]}),
    "dim_language_option_characterization": ("labels", ["doc_id", "quality"], {"bigint": ["toxic"]}),
    "dim_control": ("supplier", ["s_suppkey"], {"bigint": ["s_nationkey"], "string": ["s_name"], "double": ["s_acctbal"]}),
    "dim_language_category_control": ("conversations", ["conv_id", "turn"], {"string": ["role", "text"]}),
    "fact_lottery": ("pages", ["page_id"], {"string": ["url"]}),
    "fact_block_lottery": ("benchmark", ["item_id"], {"string": ["text"]}),
    "fact_occupational_safety_map": ("customer", ["c_custkey"], {"bigint": ["c_nationkey"], "string": ["c_name", "c_mktsegment"], "double": ["c_acctbal"]}),
    "fact_occupational_risk_safety_map": ("nation", ["n_nationkey"], {"bigint": ["n_regionkey"], "string": ["n_name"]}),
    "fact_control_measure": ("region", ["r_regionkey"], {"string": ["r_name"]}),
    "dim_danger": ("part", ["p_partkey"], {"bigint": ["p_size"], "string": ["p_name", "p_brand", "p_type"]}),
    "dim_danger_class": ("customer", ["c_custkey"], {"bigint": ["c_nationkey"], "string": ["c_name", "c_mktsegment"]}),
    "dim_language_danger": (f"({LANG_ROWS_SQL})", ["Id", "IdiomaId"], {"string": ["Descricao", "Criterio"]}),
}
K_IDS = {spec.gold: f"k{i}" for i, spec in zip([6, 7, 8, 9, 10, 11, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22],
                                                 gold.PASS_THROUGH)}
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE"}


def stand_in(gold_name: str, changed: str = "false") -> list[tuple[str, str, str]]:
    """(column, expression, type) of a silver-shaped row for each column of a gold table, in SQL that both engines read:
    keys first, then the table's columns of that kind in turn, a language suffix as a mark in the text. Where ``changed``
    holds, the first text is another one."""
    spec = gold.PASS_THROUGH_BY_GOLD[gold_name]
    _, keys, kinds = PASS_SOURCES[gold_name]
    out, turn, fresh_text = [], {}, False
    for c in spec.columns:
        kind = contract.column_type(c)
        if c in spec.keys:
            out.append((c, keys[spec.keys.index(c)], kind))
            continue
        pool = kinds.get(kind) or {"int": kinds.get("bigint"), "boolean": kinds.get("bigint"), "double": kinds.get("bigint")}.get(kind) or [keys[0]]
        source = pool[turn.setdefault(kind, 0) % len(pool)]
        turn[kind] += 1
        if kind == "boolean":
            source = f"{source} % 2 = 1"
        elif kind == "timestamp_ntz" and "timestamp_ntz" not in kinds:
            source = "NULL"
        elif kind == "string":
            mark = f", ' {c[-4:]}'" if c[-5:-4] == "_" else ""
            source = f"concat(CAST({source} AS {{text}}){mark})"
            if not fresh_text:
                source, fresh_text = f"CASE WHEN {changed} THEN concat({source}, '!') ELSE {source} END", True
        out.append((c, source, kind))
    return out


def _pass_query(gold_name: str):
    """Two loads: two thirds of the rows, then all of them with every fifth text changed, which merges."""
    table, keys, _ = PASS_SOURCES[gold_name]
    spec = gold.PASS_THROUGH_BY_GOLD[gold_name]
    first, changed = f"{keys[0]} % 3 <> 1", f"{keys[0]} % 5 = 0"
    columns = ", ".join(f"CAST({e.format(text='VARCHAR')} AS {DUCK_TYPES[t]}) AS {c}" for c, e, t in stand_in(gold_name, changed))
    ts1, ts2 = (f"TIMESTAMP '{t}'" for t in (td.RUN_TS_1, td.RUN_TS_2))
    text = next(c for c, _, t in stand_in(gold_name) if t == "string")
    joined = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c, _, t in stand_in(gold_name) if t not in ("double", "timestamp_ntz"))
    sql = f"""SELECT *, CASE WHEN {spec.keys[0]} % 3 <> 1 THEN {ts1} ELSE {ts2} END AS insert_date,
       CASE WHEN {spec.keys[0]} % 3 <> 1 AND NOT ({spec.keys[0]} % 5 = 0 AND {text} IS NOT NULL) THEN {ts1} ELSE {ts2} END AS update_date,
       md5(concat_ws('|', {joined})) AS row_text
FROM (SELECT {columns} FROM {table})"""

    def run(spark, d):
        base = td.classe_risco_idioma(spark, d) if table.startswith("(") else T(spark, d, table)

        def silver_rows(where, changed):
            return base.filter(where).select(*[F.expr(f"CAST({e.format(text='STRING')} AS {t})").alias(c) for c, e, t in stand_in(gold_name, changed)])
        t = tb.Target(f"{fresh('gold')}.{gold_name}", "external")
        for rows, ts in ((silver_rows(first, "false"), td.RUN_TS_1), (silver_rows("true", changed), td.RUN_TS_2)):
            tb.load(spark, gold.pass_through(rows, spec), t, "merge", keys=list(spec.keys), run_ts=ts)
        out = spark.table(t.name)
        # digests of numbers and times are left to k1 and h1: the engines write them differently
        said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in spec.columns if contract.column_type(c) not in ("double", "timestamp_ntz")]
        return out.drop("hash_row").withColumn("row_text", F.md5(F.concat_ws("|", *said)))

    query(f"{K_IDS[gold_name]}_{gold_name}", sql)(run)


for _g in PASS_SOURCES:
    _pass_query(_g)


@query("k23_language_riskclass", """
WITH src AS (SELECT l_linenumber + 8 AS Id,
                    CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS IdiomaId,
                    l_linestatus || '-' || CAST(l_partkey AS VARCHAR) AS Descricao FROM lineitem)
SELECT Id, max(CASE WHEN IdiomaId = 1 THEN Descricao END) AS ptBR, max(CASE WHEN IdiomaId = 2 THEN Descricao END) AS enUS,
       max(CASE WHEN IdiomaId = 3 THEN Descricao END) AS esES,
       CASE WHEN Id IN (13, 14, 15) THEN 'Unacceptable' ELSE 'Acceptable' END AS Tolerability
FROM src WHERE Id IN (9, 12, 13, 14, 15) GROUP BY Id""")
def k23(spark, d):
    li = T(spark, d, "lineitem")
    src = li.select((F.col("l_linenumber") + 8).alias("Id"),
                    F.when(F.col("l_returnflag") == "N", 1).when(F.col("l_returnflag") == "R", 2).otherwise(3).alias("IdiomaId"),
                    F.concat(F.col("l_linestatus"), F.lit("-"), F.col("l_partkey").cast("string")).alias("Descricao"))
    return gold.language_riskclass(src)


@query("k24_silver_generic_load", f"SELECT DISTINCT *{STAMP} FROM part")
def k24(spark, d):
    p = T(spark, d, "part")
    bronze_path = scratch_path(spark, "bronze", "part_spaced")
    spaced = p.unionAll(p).toDF(*[c.replace("_", " ") for c in p.columns])
    files.write_bronze(spaced, bronze_path, spread_scan=True)
    silver_df = silver.bronze_to_silver(files.read_parquet(spark, bronze_path), apply_distinct=True)
    t = tb.Target(f"{fresh('silver')}.part", "external")
    return tb.load(spark, silver_df, t, "merge", keys="p_partkey", run_ts=td.RUN_TS_1).drop("hash_row")


def _k25_sql() -> str:
    cols = ["e.event_id AS Id", "e.user_id AS RiscoOcupacional", "c.c_nationkey AS UnitId",
            "CAST(NULL AS INTEGER) AS RiscoAmbiental", "e.ts AS Datahora", "e.ts AS DataCriacao", "'system' AS Usuario",
            "CAST(NULL AS VARCHAR) AS Justificativa", "e.event_type AS Diff",
            "CAST(floor(k / 4) AS INTEGER) + 1 AS ClasseLinearId", "CAST(NULL AS INTEGER) AS ClasseLinearPosControleId",
            "CAST(trunc(e.value) AS INTEGER) AS RiscoLinear", "CAST(NULL AS INTEGER) AS RiscoLinearPosControle",
            "CAST(floor(k / 4) AS INTEGER) AS ClasseId", "CAST(floor(k / 4) AS INTEGER) AS ClassePosControleId"]
    cols += [f"e.event_type AS {c}" for c in ("ProbabilidadeAntes", "SeveridadeAntes", "ClasseRiscoAntes",
                                              "ProbabilidadeDepois", "SeveridadeDepois", "ClasseRiscoDepois")]
    cols += ["CAST(NULL AS INTEGER) AS EvidenciaId", "1 AS Tipo", "e.event_type = 'signup' AS Deletado",
             "CASE WHEN e.event_type = 'error' THEN -1 ELSE 1 END AS Status", "e.ts AS SYNC_DATE",
             "CAST(NULL AS VARCHAR) AS MobileId", "CAST(NULL AS VARCHAR) AS Motivo", "k AS v1"]
    cols += [f"CAST(NULL AS INTEGER) AS v{i}" for i in range(2, 16)]
    cols += ["CAST(trunc(e.value) AS INTEGER) AS c1"] + [f"CAST(NULL AS INTEGER) AS c{i}" for i in range(2, 41)]
    return ("SELECT " + ", ".join(cols) + " FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k "
            "FROM events) e LEFT JOIN customer c ON e.user_id = c.c_custkey")


@query("k25_audit_enriched", _k25_sql())
def k25(spark, d):
    return silver.enrich_audit(td.risco_auditoria(spark, d), td.risk_lookup(spark, d))


@query("k26_unit_path", """
SELECT n.n_nationkey AS Id, 1 AS IdiomaId, n.n_name AS Descricao, concat_ws(' > ', r.r_name, n.n_name) AS Hierarquia
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def k26(spark, d):
    n, r = T(spark, d, "nation"), T(spark, d, "region")
    ui = lookup(n, r, n["n_regionkey"] == r["r_regionkey"], "left").select(
        F.col("n_nationkey").alias("Id"), F.lit(1).alias("IdiomaId"), F.col("n_name").alias("Descricao"), "r_name")
    derived = silver.unit_paths(ui, ["r_name", "Descricao"]).drop("r_name")
    return tb.replace_table(spark, derived, tb.Target(f"{fresh('silver')}.unidade_idioma_path", "external"))


@query("k27_status_json", "SELECT doc_id, lang, source FROM documents")
def k27(spark, d):
    docs = T(spark, d, "documents").select("doc_id", "lang", "source")
    path = scratch_path(spark, "json", "status")
    files.write_json_arrays(docs, path, rows_per_file=20_000)
    st = silver.status_table(spark, path)
    return st.select("doc_id", "lang", "source")
