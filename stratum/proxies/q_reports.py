"""Star model, measures and report queries (A21, C6-C9, L1-L15) on the test-table star."""
from __future__ import annotations


from pyspark.sql import functions as F

from stratum.operators.intervals import active_by_union
from stratum.plans import gold, measures as M, reports as R
from stratum.plans import silver
from stratum.plans.star import Measure
from stratum.proxies import testdata as td
from stratum.proxies.layers_cache import materialized
from stratum.proxies.registry import query
from stratum.proxies.sql import CAL, FACT, HIS, LANG, STAR, count_by_role, with_ctes

# Report parameters of the registered queries.
SLICER_YEAR = 1997
TIME_CHART_YEAR = 2024
EXPIRY_DATE = "1997-03-15"


def enriched_audit_table(spark, d):
    """Silver step: the enriched audit rows written as a table of their own (as the silver layer does, once
    per session and input), so gold history builds read Parquet instead of re-parsing every JSON document."""
    return materialized(spark, d, "risco_auditoria_enriched",
                        lambda: silver.enrich_audit(td.risco_auditoria(spark, d), td.risk_lookup(spark, d)))


def history(spark, d):
    return gold.fact_occupational_risk_his(enriched_audit_table(spark, d))


def star(spark, d, with_history: bool = True, whole: bool = False):
    """The test star over written gold tables (built once per session and input, see layers_cache);
    the history fact only when asked for, all six entities with ``whole``."""
    fact = materialized(spark, d, "fact_occupational_risk",
                        lambda: gold.fact_occupational_risk(td.risco_ocupacional(spark, d)))
    written = lambda name, build: materialized(spark, d, name, build)
    tables = {
        M.FACT: fact,
        M.CAL: written("dim_calendar", lambda: gold.dim_calendar(fact, td.MODEL_RUN_DATE, date_col="CreationDate")),
        M.CLASS: written("language_riskclass", lambda: gold.language_riskclass_all(td.classe_risco_idioma(spark, d))),
    }
    if with_history:
        tables[M.HIS] = materialized(spark, d, "fact_occupational_risk_his", lambda: history(spark, d))
    if whole:
        from stratum.proxies.q_predicates import classe_risco
        tables["dim_unit"] = written("dim_unit", lambda: gold.dim_unit(td.unidade(spark, d), td.unidade_idioma(spark, d)))
        tables["dim_risk_class"] = written("dim_risk_class", lambda: gold.dim_risk_class(classe_risco(spark, d)))
    return M.risk_model(tables)


@query("a21_bind_model_table", STAR + """
SELECT 'fact_occupational_risk' AS entity, CAST(count(*) AS BIGINT) AS n_rows FROM fact
UNION ALL SELECT 'fact_occupational_risk_his', CAST(count(*) AS BIGINT) FROM his
UNION ALL SELECT 'dim_calendar', CAST(count(*) AS BIGINT) FROM cal
UNION ALL SELECT 'language_riskclass', CAST(count(*) AS BIGINT) FROM lang
UNION ALL SELECT 'dim_unit', CAST(count(*) AS BIGINT) FROM customer
UNION ALL SELECT 'dim_riskclass', CAST(count(*) AS BIGINT) FROM part WHERE p_size <= 25 AND p_brand < 'Brand#3'""")
def a21(spark, d):
    m = star(spark, d, whole=True)
    parts = [m.table(n).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("entity"), "n_rows")
             for n in (M.FACT, M.HIS, M.CAL, M.CLASS, "dim_unit", "dim_riskclass")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("c6_star_join", STAR + """
SELECT l.ptBR, c.Year, CAST(count(*) AS BIGINT) AS n_rows
FROM fact f LEFT JOIN lang l ON f.ClassId = l.Id LEFT JOIN cal c ON f.CreationDate = c.DateRef
GROUP BY l.ptBR, c.Year""")
def c6(spark, d):
    return star(spark, d, False).summarize(M.FACT, [(M.CLASS, "ptBR"), (M.CAL, "Year")], [Measure("n_rows")])


UNITS = """, unit AS (
  SELECT c.c_custkey AS UnitId, CASE WHEN c.c_acctbal >= 0 THEN r.r_name END AS Level1, CASE WHEN c.c_acctbal >= 0 THEN n.n_name END AS Level2
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
riskclass AS (SELECT p_partkey AS Id, p_size AS Peso FROM part WHERE p_size <= 25 AND p_brand < 'Brand#3')
"""


@query("c6_star_join_four_dimensions", STAR + UNITS + """
SELECT u.Level1, r.Peso, c.Year, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT f.HazardId) AS BIGINT) AS hazards
FROM fact f JOIN lang l ON f.ClassId = l.Id AND l.Tolerability = 'Acceptable' LEFT JOIN unit u ON f.UnitId = u.UnitId
LEFT JOIN riskclass r ON f.ClassId = r.Id LEFT JOIN cal c ON f.CreationDate = c.DateRef
GROUP BY u.Level1, r.Peso, c.Year""")
def c6_four(spark, d):
    """The risk fact by unit level, class weight and year, under a filter on the class language table."""
    return star(spark, d, False, True).summarize(
        M.FACT, [("dim_unit", "Level1"), ("dim_riskclass", "Peso"), (M.CAL, "Year")],
        [Measure("n_rows"), Measure("hazards", distinct="HazardId")], {M.CLASS: F.col("Tolerability") == "Acceptable"})


@query("c6_star_join_history", STAR + UNITS + """
, rows AS (SELECT u.Level2, h.ClassId, h.MitigatedClassId, h.Active, h.OccupationalRiskId
           FROM his h JOIN unit u ON h.UnitId = u.UnitId AND u.Level1 = 'ASIA' JOIN cal c ON h.StartDate = c.DateRef AND c.MonthNumber <= 6),
a AS (SELECT Level2, l.ptBR, count(*) AS n, 0 AS m, 0 AS k FROM rows LEFT JOIN lang l ON ClassId = l.Id GROUP BY 1, 2),
b AS (SELECT Level2, l.ptBR, 0, count(*), 0 FROM rows LEFT JOIN lang l ON MitigatedClassId = l.Id WHERE Active = 1 GROUP BY 1, 2),
e AS (SELECT Level2, l.ptBR, 0, 0, count(DISTINCT OccupationalRiskId) + max(CASE WHEN OccupationalRiskId IS NULL THEN 1 ELSE 0 END)
      FROM rows LEFT JOIN lang l ON ClassId = l.Id GROUP BY 1, 2)
SELECT Level2, ptBR, CAST(sum(n) AS BIGINT) AS entries, CAST(sum(m) AS BIGINT) AS open_mitigated, CAST(sum(k) AS BIGINT) AS risks
FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM e) GROUP BY Level2, ptBR""")
def c6_history(spark, d):
    """The history fact by unit and class: two class roles and a distinct count side by side, under filters on the units
    and the calendar."""
    return star(spark, d, True, True).summarize(
        M.HIS, [("dim_unit", "Level2"), (M.CLASS, "ptBR")],
        [Measure("entries"), Measure("open_mitigated", {M.CLASS: "MitigatedClassId"}, F.col("Active") == 1), Measure("risks", distinct="OccupationalRiskId")],
        {"dim_unit": F.col("Level1") == "ASIA", M.CAL: F.col("MonthNumber") <= 6})


@query("c7_role_playing_join", STAR + """
, a AS (SELECT l.ptBR, count(*) AS n FROM fact f JOIN lang l ON f.ClassId = l.Id
        WHERE NOT coalesce(f.Eliminated, false) GROUP BY l.ptBR),
b AS (SELECT l.ptBR, count(*) AS n FROM fact f JOIN lang l ON f.MitigatedClassId = l.Id
      WHERE NOT coalesce(f.Eliminated, false) GROUP BY l.ptBR)
SELECT l.ptBR, CAST(coalesce(a.n, 0) AS BIGINT) AS active_risks, CAST(coalesce(b.n, 0) AS BIGINT) AS active_risks_mitigated
FROM lang l LEFT JOIN a ON l.ptBR = a.ptBR LEFT JOIN b ON l.ptBR = b.ptBR""")
def c7(spark, d):
    return M.side_by_side(star(spark, d, False), ("active_risks", "active_risks_mitigated"), dim_filter=F.col("ptBR").isNotNull())


@query("c9_interval_join", STAR + """
, months AS (SELECT DISTINCT last_day(DateRef) AS month_end FROM cal),
h AS (SELECT * FROM his WHERE coalesce(Status, 0) <> -1 AND NOT coalesce(Eliminated, false)),
cov AS (SELECT l.ptBR, m.month_end, h.OccupationalRiskId
        FROM h JOIN months m ON h.StartDate <= m.month_end AND (h.EndDate IS NULL OR h.EndDate >= m.month_end)
        LEFT JOIN lang l ON h.MitigatedClassId = l.Id)
SELECT ptBR, CAST(year(month_end) AS INTEGER) AS Year, CAST(month(month_end) AS INTEGER) AS MonthNumber,
       CAST(count(DISTINCT OccupationalRiskId) + max(CASE WHEN OccupationalRiskId IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS historicals
FROM cov GROUP BY ptBR, month_end""")
def c9(spark, d):
    return M.historicals_by_month(star(spark, d), ("ptBR",))


@query("c9_interval_join_overlapping", STAR + """
, months AS (SELECT DISTINCT last_day(DateRef) AS month_end FROM cal),
h AS (SELECT *, CASE WHEN Status > 0 AND OccupationalRiskHisId % 10 > 0 THEN CAST(StartDate + CAST(30 * (1 + OccupationalRiskHisId % 40) AS INTEGER) AS DATE) END AS Until
      FROM his WHERE NOT coalesce(Eliminated, false)),
cov AS (SELECT h.MitigatedClassId, m.month_end, h.UnitId
        FROM h JOIN months m ON h.StartDate <= m.month_end AND (h.Until IS NULL OR h.Until >= m.month_end))
SELECT MitigatedClassId, month_end, CAST(count(DISTINCT UnitId) + max(CASE WHEN UnitId IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS units
FROM cov GROUP BY MitigatedClassId, month_end""")
def c9_overlapping(spark, d):
    """Units with an open history row at each month end, by class: a unit's rows overlap widely."""
    m = star(spark, d)
    until = F.when((F.col("Status") > 0) & (F.col("OccupationalRiskHisId") % 10 > 0),
                   F.date_add("StartDate", (30 * (1 + F.col("OccupationalRiskHisId") % 40)).cast("int")))
    h = m.table(M.HIS).filter(M.not_eliminated()).withColumn("Until", until)
    horizon = m.table(M.CAL).agg(F.last_day(F.max("DateRef"))).scalar()
    return active_by_union(h, ["MitigatedClassId"], "StartDate", "Until", "UnitId", horizon, "units")


@query("l1_active_risks", count_by_role("f.ClassId", "active_risks"))
def l1(spark, d):
    return M.active_risks(star(spark, d, False))


@query("l2_active_risks_mitigated", count_by_role("f.MitigatedClassId", "active_risks_mitigated"))
def l2(spark, d):
    return M.active_risks_mitigated(star(spark, d, False))


@query("l3_active_risks_rrn", count_by_role("f.LinearClassId", "active_risks_rrn"))
def l3(spark, d):
    return M.active_risks_rrn(star(spark, d, False))


@query("l5_active_risks_rrn_mitigated", count_by_role("f.LinearMitigatedClassId", "active_risks_rrn_mitigated"))
def l5(spark, d):
    return M.active_risks_rrn_mitigated(star(spark, d, False))


@query("l4_active_risks_rrn_acumulative", STAR + """
, per AS (SELECT l.ptBR, last_day(f.CreationDate) AS month_end, count(*) AS n
          FROM fact f LEFT JOIN lang l ON f.LinearClassId = l.Id
          WHERE NOT coalesce(f.Eliminated, false) AND f.CreationDate IN (SELECT DateRef FROM cal)
          GROUP BY l.ptBR, last_day(f.CreationDate)),
members AS (SELECT DISTINCT ptBR FROM lang UNION SELECT DISTINCT ptBR FROM per),
months AS (SELECT DISTINCT last_day(DateRef) AS month_end FROM cal),
grid AS (SELECT m.ptBR, mo.month_end FROM members m CROSS JOIN months mo)
SELECT g.ptBR, CAST(year(g.month_end) AS INTEGER) AS Year, CAST(month(g.month_end) AS INTEGER) AS MonthNumber,
       CAST(sum(coalesce(p.n, 0)) OVER (PARTITION BY g.ptBR ORDER BY g.month_end
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS active_risks_rrn_acumulative
FROM grid g LEFT JOIN per p ON g.ptBR IS NOT DISTINCT FROM p.ptBR AND g.month_end = p.month_end""")
def l4(spark, d):
    return M.active_risks_rrn_acumulative(star(spark, d, False))


@query("l6_historicals", STAR + """
, cut AS (SELECT max(DateRef) AS d FROM cal),
h AS (SELECT his.* FROM his, cut WHERE Active = 1 AND coalesce(Status, 0) <> -1 AND StartDate <= cut.d
      AND (EndDate IS NULL OR EndDate >= last_day(cut.d))),
k AS (SELECT l.ptBR, h.OccupationalRiskId FROM h LEFT JOIN lang l ON h.MitigatedClassId = l.Id)
SELECT ptBR, CAST(count(DISTINCT OccupationalRiskId) + max(CASE WHEN OccupationalRiskId IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS historicals
FROM k GROUP BY ptBR""")
def l6(spark, d):
    return M.historicals(star(spark, d), ("ptBR",))


L7_SQL = STAR + """
, h AS (SELECT * FROM his WHERE NOT coalesce(Eliminated, false) AND Active = 1 AND coalesce(Status, 0) <> -1
        AND StartDate IN (SELECT DateRef FROM cal)),
first AS (SELECT l.ptBR, h.OccupationalRiskId, last_day(min(h.StartDate)) AS month_end
          FROM h LEFT JOIN lang l ON h.MitigatedClassId = l.Id GROUP BY l.ptBR, h.OccupationalRiskId),
counts AS (SELECT ptBR, month_end, count(*) AS n FROM first GROUP BY ptBR, month_end),
starts AS (SELECT ptBR, min(month_end) AS s FROM counts GROUP BY ptBR),
months AS (SELECT DISTINCT last_day(DateRef) AS month_end FROM cal),
grid AS (SELECT s.ptBR, m.month_end FROM starts s JOIN months m ON m.month_end >= s.s),
acc AS (SELECT g.ptBR, g.month_end,
           CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY g.ptBR ORDER BY g.month_end
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS historicals_acumulative
        FROM grid g LEFT JOIN counts c ON g.ptBR IS NOT DISTINCT FROM c.ptBR AND g.month_end = c.month_end)
"""


@query("l7_historicals_acumulative", L7_SQL + """
SELECT ptBR, CAST(year(month_end) AS INTEGER) AS Year, CAST(month(month_end) AS INTEGER) AS MonthNumber, historicals_acumulative FROM acc""")
def l7(spark, d):
    return M.historicals_acumulative(star(spark, d), ("ptBR",))


def _chart_sql(year_filter: str) -> str:
    yf = f" AND year(f.CreationDate) = {year_filter}" if year_filter else ""
    return STAR + f"""
, a AS (SELECT l.ptBR, count(*) AS n FROM fact f JOIN lang l ON f.LinearMitigatedClassId = l.Id
        WHERE NOT coalesce(f.Eliminated, false){yf} AND f.CreationDate IN (SELECT DateRef FROM cal) GROUP BY l.ptBR),
b AS (SELECT l.ptBR, count(*) AS n FROM fact f JOIN lang l ON f.LinearClassId = l.Id
      WHERE NOT coalesce(f.Eliminated, false){yf} AND f.CreationDate IN (SELECT DateRef FROM cal) GROUP BY l.ptBR)
SELECT l.ptBR AS class_name, CAST(coalesce(a.n, 0) AS BIGINT) AS active_risks_rrn_mitigated,
       CAST(coalesce(b.n, 0) AS BIGINT) AS active_risks_rrn
FROM (SELECT DISTINCT ptBR FROM lang WHERE ptBR IS NOT NULL) l LEFT JOIN a ON l.ptBR = a.ptBR LEFT JOIN b ON l.ptBR = b.ptBR"""


@query("l8_column_chart", _chart_sql(""))
def l8(spark, d):
    return R.column_chart(star(spark, d, False))


@query("l9_pie_unacceptable", STAR + """
, a AS (SELECT l.ptBR, count(*) AS n FROM fact f JOIN lang l ON f.LinearMitigatedClassId = l.Id
        WHERE NOT coalesce(f.Eliminated, false) AND l.Tolerability = 'Unacceptable' GROUP BY l.ptBR)
SELECT l.ptBR AS class_name, CAST(coalesce(a.n, 0) AS BIGINT) AS active_risks_rrn_mitigated
FROM (SELECT DISTINCT ptBR FROM lang WHERE Tolerability = 'Unacceptable') l LEFT JOIN a ON l.ptBR IS NOT DISTINCT FROM a.ptBR""")
def l9(spark, d):
    return R.pie_unacceptable(star(spark, d, False))


@query("l10_time_chart", L7_SQL + f"""
SELECT CAST(year(month_end) AS INTEGER) AS Year, CAST(month(month_end) AS INTEGER) AS MonthNumber, ptBR AS class_name, historicals_acumulative
FROM acc WHERE year(month_end) = {TIME_CHART_YEAR}""")
def l10(spark, d):
    return R.time_chart(star(spark, d), TIME_CHART_YEAR)


@query("l11_card_mitigated_total", STAR + """
SELECT CAST(count(*) AS BIGINT) AS active_risks_mitigated FROM fact f
WHERE NOT coalesce(f.Eliminated, false)""")
def l11(spark, d):
    return R.card_mitigated_total(star(spark, d, False))


@query("l12_cards_by_class", STAR + """
, cards AS (SELECT * FROM (VALUES ('Acceptable', 12), ('Low', 9), ('Medium', 13), ('High', 14), ('Critical', 15)) t(card, class_id)),
per AS (SELECT f.LinearMitigatedClassId AS k, count(*) AS n FROM fact f JOIN lang l ON f.LinearMitigatedClassId = l.Id
        WHERE NOT coalesce(f.Eliminated, false) GROUP BY 1)
SELECT c.card, CAST(c.class_id AS INTEGER) AS class_id, CAST(coalesce(p.n, 0) AS BIGINT) AS active_risks_rrn_mitigated
FROM cards c LEFT JOIN per p ON c.class_id = p.k""")
def l12(spark, d):
    return R.cards_by_class(star(spark, d, False))


@query("l13_card_unacceptable", STAR + """
SELECT CAST(count(*) AS BIGINT) AS active_risks_rrn_mitigated FROM fact f JOIN lang l ON f.LinearMitigatedClassId = l.Id
WHERE NOT coalesce(f.Eliminated, false) AND l.Tolerability = 'Unacceptable'""")
def l13(spark, d):
    return R.card_unacceptable(star(spark, d, False))


@query("l14_card_expiring_today", STAR + f"""
SELECT CAST(count(*) AS BIGINT) AS active_risks FROM fact f
WHERE NOT coalesce(f.Eliminated, false)
  AND f.EvaluationExpirationDate BETWEEN DATE '{EXPIRY_DATE}' AND DATE '{EXPIRY_DATE}'""")
def l14(spark, d):
    return R.card_expiring(star(spark, d, False), EXPIRY_DATE)


@query("l15_year_slicer", _chart_sql(str(SLICER_YEAR)))
def l15(spark, d):
    return R.column_chart(star(spark, d, False), year=SLICER_YEAR)


IN_YEAR = f"AND f.CreationDate IN (SELECT DateRef FROM cal WHERE Year = {SLICER_YEAR})"


@query("l15_year_slicer_pie", STAR + f"""
, a AS (SELECT l.ptBR, count(*) AS n FROM fact f JOIN lang l ON f.LinearMitigatedClassId = l.Id
        WHERE NOT coalesce(f.Eliminated, false) AND l.Tolerability = 'Unacceptable' {IN_YEAR} GROUP BY l.ptBR)
SELECT l.ptBR AS class_name, CAST(coalesce(a.n, 0) AS BIGINT) AS active_risks_rrn_mitigated
FROM (SELECT DISTINCT ptBR FROM lang WHERE Tolerability = 'Unacceptable') l LEFT JOIN a ON l.ptBR IS NOT DISTINCT FROM a.ptBR""")
def l15_pie(spark, d):
    return R.pie_unacceptable(star(spark, d, False), year=SLICER_YEAR)


@query("l15_year_slicer_mitigated_total", STAR + f"""
SELECT CAST(count(*) AS BIGINT) AS active_risks_mitigated FROM fact f WHERE NOT coalesce(f.Eliminated, false) {IN_YEAR}""")
def l15_total(spark, d):
    return R.card_mitigated_total(star(spark, d, False), year=SLICER_YEAR)


@query("l15_year_slicer_cards", STAR + f"""
, cards AS (SELECT * FROM (VALUES ('Acceptable', 12), ('Low', 9), ('Medium', 13), ('High', 14), ('Critical', 15)) t(card, class_id)),
per AS (SELECT f.LinearMitigatedClassId AS k, count(*) AS n FROM fact f JOIN lang l ON f.LinearMitigatedClassId = l.Id
        WHERE NOT coalesce(f.Eliminated, false) {IN_YEAR} GROUP BY 1)
SELECT c.card, CAST(c.class_id AS INTEGER) AS class_id, CAST(coalesce(p.n, 0) AS BIGINT) AS active_risks_rrn_mitigated
FROM cards c LEFT JOIN per p ON c.class_id = p.k""")
def l15_cards(spark, d):
    return R.cards_by_class(star(spark, d, False), year=SLICER_YEAR)


@query("l15_year_slicer_unacceptable", STAR + f"""
SELECT CAST(count(*) AS BIGINT) AS active_risks_rrn_mitigated FROM fact f JOIN lang l ON f.LinearMitigatedClassId = l.Id
WHERE NOT coalesce(f.Eliminated, false) AND l.Tolerability = 'Unacceptable' {IN_YEAR}""")
def l15_unacceptable(spark, d):
    return R.card_unacceptable(star(spark, d, False), year=SLICER_YEAR)


@query("l15_year_slicer_expiring", STAR + f"""
SELECT CAST(count(*) AS BIGINT) AS active_risks FROM fact f WHERE NOT coalesce(f.Eliminated, false)
  AND f.EvaluationExpirationDate BETWEEN DATE '{EXPIRY_DATE}' AND DATE '{EXPIRY_DATE}' {IN_YEAR}""")
def l15_expiring(spark, d):
    return R.card_expiring(star(spark, d, False), EXPIRY_DATE, year=SLICER_YEAR)
