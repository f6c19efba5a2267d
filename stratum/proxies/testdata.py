"""Silver-shaped frames derived from the test tables (every one grows with its inputs).

risco_ocupacional <- lineitem + supplier lookup      (risk fact source)
risco_auditoria   <- events + customer lookup         (audit history source, JSON document built here)
classe_risco_idioma <- nation, three languages        (class descriptions)
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.joins import lookup
from stratum.operators.partitioning import spread
from stratum.operators.pivot import LANGUAGES, tolerability

# Run parameters used by the registered queries.
RUN_TS_1 = "2024-01-01 10:00:00"
RUN_TS_2 = "2024-02-01 10:00:00"
MODEL_RUN_DATE = "2024-06-30"
CAL_RUN_DATE = "2001-08-01"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def risco_ocupacional(spark: SparkSession, d: str) -> DataFrame:
    li = spread(table(spark, d, "lineitem"))
    sup = table(spark, d, "supplier").select(F.col("s_suppkey"), F.col("s_nationkey"))
    j = lookup(li, sup, li["l_suppkey"] == sup["s_suppkey"], "left", distinct_right=True)
    upd = F.when(F.col("l_linestatus") == "F", F.col("l_shipdate") + F.expr("interval 30 days"))
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("Id"),
        F.col("l_suppkey").alias("UnidadeId"),
        F.col("s_nationkey").alias("ClasseId"),
        F.round(F.col("l_discount") * 100).cast("int").alias("ClassePosControleId"),
        F.col("l_quantity").cast("int").alias("ClasseLinearId"),
        (F.col("l_linenumber") + 8).alias("ClasseLinearPosControleId"),
        F.col("l_quantity").alias("RiscoLinear"),
        F.col("l_extendedprice").alias("RiscoLinearPosControle"),
        F.col("l_linenumber").alias("ProbabilidadeId"),
        F.col("l_linenumber").alias("ProbabilidadePosControleId"),
        F.col("l_linenumber").alias("SeveridadeId"),
        F.col("l_partkey").alias("PerigoId"),
        F.col("l_shipdate").alias("DataCriacao"),
        upd.alias("DataAtualizacao"),
        (F.col("l_returnflag") == "R").alias("Deletado"),
        F.when(F.col("l_linestatus") == "F", F.lit(-1)).otherwise(F.lit(1)).alias("Status"))


def props_k() -> F.Column:
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def risco_auditoria(spark: SparkSession, d: str) -> DataFrame:
    """Raw audit rows: one per event, with an after-image JSON document (numbers, text numbers,
    decimals and booleans mixed so the lenient conversion is exercised)."""
    ev = spread(table(spark, d, "events"))
    k = props_k()
    doc = F.to_json(F.struct(
        F.floor(k / 4).cast("int").alias("classeId"),
        F.floor(k / 4).cast("int").alias("classePosControleId"),
        (F.floor(k / 4).cast("int") + 1).alias("classeLinearId"),
        F.col("value").alias("riscoLinear"),
        F.when(F.col("event_type") == "error", F.lit(-1)).otherwise(F.lit(1)).alias("status"),
        (F.col("event_type") == "signup").alias("deletado"),
        k.cast("string").alias("v1"),
        F.col("value").alias("c1")))
    return ev.select(
        F.col("event_id").alias("Id"), F.col("user_id").alias("RiscoOcupacional"),
        F.lit(None).cast("int").alias("RiscoAmbiental"), F.col("ts").alias("Datahora"),
        F.col("ts").alias("DataCriacao"), F.lit("system").alias("Usuario"), F.lit(None).cast("string").alias("Justificativa"),
        F.col("event_type").alias("Diff"),
        F.col("event_type").alias("ProbabilidadeAntes"), F.col("event_type").alias("SeveridadeAntes"),
        F.col("event_type").alias("ClasseRiscoAntes"), F.col("event_type").alias("ProbabilidadeDepois"),
        F.col("event_type").alias("SeveridadeDepois"), F.col("event_type").alias("ClasseRiscoDepois"),
        F.lit(None).cast("int").alias("EvidenciaId"), F.lit(1).alias("Tipo"), F.col("ts").alias("SYNC_DATE"),
        F.lit(None).cast("string").alias("MobileId"), F.lit(None).cast("string").alias("Motivo"),
        F.col("props").alias("RegistroAntes"), doc.alias("RegistroDepois"), F.lit(None).cast("string").alias("Detalhes"))


def risk_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Risk -> unit lookup for the audit enrichment: customers stand in for risks, nations for units."""
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("Id"), F.col("c_nationkey").alias("UnidadeId"))


def classe_risco_idioma(spark: SparkSession, d: str) -> DataFrame:
    """Class descriptions in three languages (one row per nation and language)."""
    n = table(spark, d, "nation")
    texts = {1: F.col("n_name"), 2: F.lower("n_name"), 3: F.concat(F.col("n_name"), F.lit(" (es)"))}
    rows = F.array(*[F.struct(F.lit(k).alias("IdiomaId"), v.alias("Descricao")) for k, v in texts.items()])
    e = n.select(F.col("n_nationkey").alias("Id"), F.explode(rows).alias("r"))
    return e.select("Id", "r.IdiomaId", "r.Descricao", F.lit("criterion").alias("Criterio"),
                    F.col("Id").alias("ClasseRiscoIdiomaId"))


def unidade(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("Id"), F.col("c_nationkey").cast("bigint").alias("IdSuperior"),
                    F.col("c_acctbal").alias("Latitude"), F.lit(None).cast("double").alias("Longitude"),
                    F.col("c_nationkey").alias("QtdeMapaLOTOVencido"), F.lit(0).alias("QtdeMapaSegurancaVencido"),
                    F.length("c_mktsegment").alias("QtdeRiscoOcupacionalCriticoSemPlanoAcao"))


def unidade_idioma(spark: SparkSession, d: str) -> DataFrame:
    """Paths region > nation > customer of all customers: in language 1 where the balance is not negative, else in
    language 2, so that the language filter leaves units without a path."""
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = lookup(lookup(c, n, c["c_nationkey"] == n["n_nationkey"]), r, F.col("n_regionkey") == r["r_regionkey"])
    return j.select(F.col("c_custkey").alias("Id"), F.when(F.col("c_acctbal") >= 0, 1).otherwise(2).alias("IdiomaId"),
                    F.concat_ws(" > ", "r_name", "n_name", "c_name").alias("Hierarquia"),
                    F.col("c_name").alias("Descricao"))
