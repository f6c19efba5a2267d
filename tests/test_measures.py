"""Measures on a hand-written star: blank handling, roles, history as written vs point in time."""
import datetime as dt

from pyspark.sql import functions as F

from stratum.operators.scd2 import close_intervals
from stratum.plans import measures as M
from stratum.plans import reports as R

D = dt.date


def star(spark):
    fact = spark.createDataFrame([
        # Id, ClassId, Mitigated, Linear, LinearMitigated, CreationDate, Eliminated, Expiry
        (1, 13, 13, 13, 13, D(2024, 1, 5), None, D(2024, 2, 24)),   # NULL Eliminated counts as not eliminated
        (2, 13, 9, 14, 15, D(2024, 1, 9), False, D(2024, 2, 28)),
        (3, 99, 9, 14, 15, D(2024, 2, 1), False, D(2024, 3, 22)),   # unknown class -> blank member
        (4, 9, 9, 9, 9, D(2024, 2, 3), True, D(2024, 3, 24)),       # eliminated
    ], "Id int, ClassId int, MitigatedClassId int, LinearClassId int, LinearMitigatedClassId int, "
       "CreationDate date, Eliminated boolean, EvaluationExpirationDate date")
    lang = spark.createDataFrame([(9, "Baixo", "Acceptable"), (12, "Aceitavel", "Acceptable"), (13, "Medio", "Unacceptable"),
                                  (14, "Alto", "Unacceptable"), (15, "Critico", "Unacceptable")],
                                 "Id int, ptBR string, Tolerability string")
    cal = spark.createDataFrame([(D(2024, 1, 1) + dt.timedelta(days=i),) for i in range(91)], "DateRef date") \
               .withColumn("Year", F.year("DateRef")).withColumn("MonthNumber", F.month("DateRef"))
    his = spark.createDataFrame([
        # risk, his id, created, status, mitigated class, eliminated
        (1, 10, dt.datetime(2024, 1, 5), 1, 13, False),
        (1, 11, dt.datetime(2024, 2, 10), 1, 14, False),     # closes row 10 on 2024-02-09
        (2, 20, dt.datetime(2024, 1, 20), None, 13, None),   # NULL status counts (blank <> -1)
        (3, 30, dt.datetime(2024, 2, 2), -1, 13, False),     # status -1 excluded
        (None, 40, dt.datetime(2024, 3, 1), 1, 14, False),   # NULL risk: one blank value, never chained
    ], "OccupationalRiskId int, OccupationalRiskHisId int, CreateDateTime timestamp_ntz, Status int, "
       "MitigatedClassId int, Eliminated boolean") \
        .withColumn("StartDate", F.to_date("CreateDateTime")).withColumn("Active", F.lit(1)) \
        .withColumn("EndDate", F.lit(None).cast("date"))
    his = close_intervals(his, "OccupationalRiskId", ["CreateDateTime", "OccupationalRiskHisId"])
    return M.risk_model({M.FACT: fact, M.HIS: his, M.CAL: cal, M.CLASS: lang})


def as_dict(df, key, val):
    return {r[key]: r[val] for r in df.collect()}


def test_counts_with_roles_and_blank(spark):
    m = star(spark)
    assert as_dict(M.active_risks(m), "ptBR", "active_risks") == \
        {"Baixo": 0, "Aceitavel": 0, "Medio": 2, "Alto": 0, "Critico": 0, None: 1}
    assert as_dict(M.active_risks_rrn_mitigated(m), "ptBR", "active_risks_rrn_mitigated") == \
        {"Baixo": 0, "Aceitavel": 0, "Medio": 1, "Alto": 0, "Critico": 2}
    chart = R.column_chart(m).collect()
    assert [r["class_name"] for r in chart][:2] == ["Critico", "Medio"]      # sorted by the measure, blank dropped
    cards = {r["card"]: r["active_risks_rrn_mitigated"] for r in R.cards_by_class(m).collect()}
    assert cards == {"Acceptable": 0, "Low": 0, "Medium": 1, "High": 0, "Critical": 2}
    assert R.card_unacceptable(m).first()[0] == 3
    assert R.card_expiring(m, "2024-02-28").first()[0] == 1


def test_cumulative_counts_carry_months(spark):
    m = star(spark)
    out = {(r["ptBR"], r["MonthNumber"]): r["active_risks_rrn_acumulative"] for r in M.active_risks_rrn_acumulative(m).collect()}
    assert out[("Alto", 1)] == 1 and out[("Alto", 2)] == 2 and out[("Alto", 3)] == 2
    assert out[("Baixo", 3)] == 0 and out[("Medio", 1)] == 1


def test_history_measures(spark):
    m = star(spark)
    written = as_dict(M.historicals(m), "ptBR", "historicals")
    # active rows only: risk 1's latest row (Alto), risk 2 (Medio, NULL status), the NULL risk (Alto)
    assert written == {"Alto": 2, "Medio": 1}
    pit = {(r["ptBR"], r["MonthNumber"]): r["historicals"] for r in M.historicals_by_month(m).collect()}
    assert pit[("Medio", 1)] == 2          # risks 1 and 2 at the end of January
    assert ("Medio", 2) in pit and pit[("Medio", 2)] == 1     # risk 1 moved to Alto on 10 Feb
    acc = {(r["ptBR"], r["MonthNumber"]): r["historicals_acumulative"] for r in M.historicals_acumulative(m).collect()}
    assert acc[("Medio", 1)] == 1 and acc[("Medio", 3)] == 1 and acc[("Alto", 2)] == 1 and acc[("Alto", 3)] == 2


def test_active_only_variant_leaves_inactive_rows(spark):
    rows = [(1, 1, dt.datetime(2024, 1, 1), 1), (1, 2, dt.datetime(2024, 1, 5), 0), (1, 3, dt.datetime(2024, 1, 9), 1)]
    h = spark.createDataFrame(rows, "k int, id int, ts timestamp_ntz, Active int") \
             .withColumn("StartDate", F.to_date("ts")).withColumn("EndDate", F.lit(None).cast("date"))
    full = {r["id"]: (r["Active"], r["EndDate"]) for r in close_intervals(h, "k", ["ts", "id"]).collect()}
    live = {r["id"]: (r["Active"], r["EndDate"]) for r in close_intervals(h, "k", ["ts", "id"], active_only=True).collect()}
    assert full[1] == (0, D(2024, 1, 4))          # closed by the next row of the whole history
    assert live[1] == (0, D(2024, 1, 8))          # as written: closed by the next *active* row
    assert live[2] == (0, None)                   # inactive rows are left as they are


def test_sweep_equals_exact_expansion(spark):
    m = star(spark)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert rows(M.historicals_by_month(m, disjoint=True)) == rows(M.historicals_by_month(m, disjoint=False))
    from stratum.proxies.q_reports import star as test_star
    big = test_star(spark, "/root/testdata/sf0.001")
    assert rows(M.historicals_by_month(big, disjoint=True)) == rows(M.historicals_by_month(big, disjoint=False))


def test_union_of_overlapping_intervals_equals_exact_expansion(spark):
    """Random overlapping, touching, nested, open, empty and NULL-member intervals; one member holds a third of the rows."""
    import random
    from stratum.operators.intervals import active_by_union, distinct_active
    rng = random.Random(1)
    rows = []
    for i in range(600):
        a = D(2022, 1, 1) + dt.timedelta(days=rng.randrange(900))
        e = None if rng.random() < .1 else a + dt.timedelta(days=rng.randrange(-20, 200))
        rows.append((rng.choice(["x", "y", None]), 7 if i % 3 == 0 else rng.choice([1, 2, 3, 4, 5, None]), a, e))
    df = spark.createDataFrame(rows, "g string, m int, s date, e date")
    horizon = F.lit("2024-12-31").cast("date")
    args = (df, ["g"], "s", "e", "m", horizon)
    got, plain = active_by_union(*args), distinct_active(*args)
    assert sorted(map(tuple, got.select(*plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_several_dimensions_and_roles_against_plain_joins(spark):
    m = star(spark)
    units = spark.createDataFrame([(1, "north"), (2, "south"), (3, "south")], "UnitId int, Level1 string")
    m.tables["dim_unit"] = units
    m.tables[M.FACT] = m.table(M.FACT).withColumn("UnitId", F.expr("CASE Id WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 9 END"))
    out = m.summarize(M.FACT, [(M.CLASS, "ptBR"), ("dim_unit", "Level1")],
                      [M.Measure("n"), M.Measure("mitigated", {M.CLASS: "MitigatedClassId"}, F.col("Id") > 1), M.Measure("units", distinct="UnitId")],
                      {M.CAL: F.col("MonthNumber") <= 2})
    got = {(r["ptBR"], r["Level1"]): (r["n"], r["mitigated"], r["units"]) for r in out.collect()}
    assert got == {("Medio", "north"): (1, 0, 1), ("Medio", "south"): (1, 0, 1), (None, None): (1, 0, 1),
                   ("Baixo", "south"): (0, 1, 0), ("Baixo", None): (1, 2, 1)}
    # a filter reaches each measure through its own role
    only = m.summarize(M.FACT, [("dim_unit", "Level1")], [M.Measure("n"), M.Measure("mitigated", {M.CLASS: "MitigatedClassId"})],
                       {M.CLASS: F.col("ptBR") == "Baixo"})
    assert {r["Level1"]: (r["n"], r["mitigated"]) for r in only.collect()} == {"south": (0, 1), None: (1, 2)}


def test_one_fact_scan_for_several_measures(spark):
    from stratum.proxies.registry import load_all
    queries, _ = load_all()
    for name, scans in (("l8_column_chart", 1), ("c7_role_playing_join", 1), ("l4_active_risks_rrn_acumulative", 1), ("l7_historicals_acumulative", 0), ("c9_interval_join", 0)):
        text = queries[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert sum("FileScan" in line and ".fact_occupational_risk[" in line for line in text.split("\n")) == scans, name


def test_year_slicer_and_time_chart(spark):
    m = star(spark)
    assert [r["Year"] for r in R.slicer_years(m).collect()] == [2024]
    chart = R.time_chart(m, year=2024).collect()
    assert [(r["MonthNumber"], r["class_name"]) for r in chart][:2] == [(1, "Medio"), (2, "Alto")]
    assert R.time_chart(m, year=2023).count() == 0
    sliced = {r["class_name"]: r["active_risks_rrn_mitigated"] for r in R.column_chart(m, year=2024).collect()}
    assert sliced["Critico"] == 2 and R.column_chart(m, year=2023).filter("active_risks_rrn_mitigated > 0").count() == 0
