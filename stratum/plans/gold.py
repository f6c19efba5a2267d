"""Gold builders (K1-K23): DataFrame in, DataFrame out; the loader (A22) writes them.

K6-K22 are one spec-driven pass-through; K1-K5 and K23 carry real logic."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.dates import expiry
from stratum.operators import calendar as cal
from stratum.operators import hierarchy as hier
from stratum.operators.pivot import language_pivot
from stratum.operators.merge import SchemaMismatch
from stratum.operators.scd2 import close_intervals
from stratum.plans import contract

# The filter that selects risk classes, the language used for unit paths, and the
# number of days after which a risk evaluation expires.
RISK_CLASS_PSR = "R"
RISK_CLASS_MODULE = 1
PRIMARY_LANGUAGE = 1
EXPIRY_DAYS = 50


def dim_risk_class(classe_risco: DataFrame) -> DataFrame:
    """K1: project + conjunctive filter."""
    return (classe_risco.filter((F.col("PSR") == RISK_CLASS_PSR) & (F.col("Modulo") == RISK_CLASS_MODULE))
            .select("Id", "Peso", "ClasseAceitavel", "Inicio", "Fim", "CorFundo", "CorTexto"))


def unit_levels(unidade_idioma: DataFrame, language_id: int = PRIMARY_LANGUAGE, max_levels: int = hier.MAX_LEVELS,
                with_depth: bool = False) -> DataFrame:
    """One row per unit id with Level1..N from its path in one language.
    A unit with several rows in that language keeps the smallest path (deterministic)."""
    paths = (unidade_idioma.filter(F.col("IdiomaId") == language_id)
             .groupBy("Id").agg(F.min("Hierarquia").alias("Hierarquia")))
    return paths.select("Id", *hier.level_columns("Hierarquia", max_levels, with_depth=with_depth, with_all=True))


def dim_unit(unidade: DataFrame, unidade_idioma: DataFrame, language_id: int = PRIMARY_LANGUAGE,
             max_levels: int = hier.MAX_LEVELS, with_depth: bool = False) -> DataFrame:
    """K2: unit attributes left-joined to the level columns (a unit without a path keeps NULL levels)."""
    lv = unit_levels(unidade_idioma, language_id, max_levels, with_depth)
    u = unidade.alias("u")
    j = u.join(lv.alias("p"), F.col("u.Id") == F.col("p.Id"), "left")
    levels = [F.col(f"p.Level{i}") for i in range(1, max_levels + 1)] + [F.col("p.Levels")] + ([F.col("p.depth")] if with_depth else [])
    return j.select(F.col("u.Id").alias("UnitId"), F.col("u.IdSuperior").alias("HigherUnitId"), *levels,
                    F.col("u.Latitude"), F.col("u.Longitude"),
                    F.col("u.QtdeMapaLOTOVencido").alias("LOTOMapExpired"),
                    F.col("u.QtdeMapaSegurancaVencido").alias("SecurityMapExpired"),
                    F.col("u.QtdeRiscoOcupacionalCriticoSemPlanoAcao").alias("RiskWithoutAction"))


def dim_calendar(risco_ocupacional: DataFrame, run_date, date_col: str = "DataCriacao") -> DataFrame:
    """K3: first creation date to 31 Dec of the run year."""
    return cal.calendar_from(risco_ocupacional, date_col, run_date)


def fact_occupational_risk(risco_ocupacional: DataFrame) -> DataFrame:
    """K4: renames, dates, evaluation expiry (+50 days), typed NULL history id."""
    s = risco_ocupacional
    return s.select(
        F.col("Id"), F.col("UnidadeId").alias("UnitId"),
        F.col("ClasseId").alias("ClassId"), F.col("ClassePosControleId").alias("MitigatedClassId"),
        F.col("ClasseLinearId").alias("LinearClassId"),
        F.col("ClasseLinearPosControleId").alias("LinearMitigatedClassId"),
        F.col("RiscoLinear").alias("LinearRiskScore"), F.col("RiscoLinearPosControle").alias("MitigatedLinearRiskScore"),
        F.col("ProbabilidadeId").alias("ProbabilityId"), F.col("ProbabilidadePosControleId").alias("MitigatedProbabilityId"),
        F.col("SeveridadeId").alias("SeverityId"), F.col("PerigoId").alias("HazardId"),
        F.to_date("DataCriacao").alias("CreationDate"), F.to_date("DataAtualizacao").alias("UpdateDate"),
        expiry("DataAtualizacao", "DataCriacao", EXPIRY_DAYS).alias("EvaluationExpirationDate"),
        F.col("Deletado").alias("Eliminated"), F.col("Status"),
        F.lit(None).cast("int").alias("OccupationalRiskHisId"))


def history_rows(risco_auditoria: DataFrame) -> DataFrame:
    """K5 projection: every audit row opens an interval (Active = 1, EndDate NULL)."""
    s = risco_auditoria
    return s.select(
        F.col("UnitId"), F.col("Id").alias("OccupationalRiskHisId"), F.col("RiscoOcupacional").alias("OccupationalRiskId"),
        F.col("ClasseRiscoDepois").alias("Class"), F.col("ProbabilidadeDepois").alias("Probability"),
        F.col("SeveridadeDepois").alias("Severity"), F.col("Status"),
        F.col("ClasseId").alias("ClassId"), F.col("ClassePosControleId").alias("MitigatedClassId"),
        F.col("ClasseLinearId").alias("LinearClassId"), F.col("ClasseLinearPosControleId").alias("LinearMitigatedClassId"),
        F.col("RiscoLinear").alias("LinearRiskScore"), F.col("RiscoLinearPosControle").alias("MitigatedLinearRiskScore"),
        F.lit(1).alias("Active"), F.col("Deletado").alias("Eliminated"),
        F.to_date("DataCriacao").alias("StartDate"), F.lit(None).cast("date").alias("EndDate"),
        F.col("DataCriacao").alias("CreateDateTime"))


def fact_occupational_risk_his(risco_auditoria: DataFrame, active_only: bool = False, skew_safe: bool = True) -> DataFrame:
    """K5: history rows with closed validity intervals, in one build (no second MERGE)."""
    return close_intervals(history_rows(risco_auditoria), "OccupationalRiskId",
                           ["CreateDateTime", "OccupationalRiskHisId"], active_only=active_only, skew_safe=skew_safe)


def language_riskclass(classe_risco_idioma: DataFrame) -> DataFrame:
    """One row per reported class with ptBR/enUS/esES and Tolerability (the model's shape, Q10)."""
    return language_pivot(classe_risco_idioma, "Id", "IdiomaId", "Descricao")


@dataclass(frozen=True)
class PassThrough:
    """A gold table copied from one silver table."""
    gold: str
    silver: str
    keys: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return contract.COLUMNS[self.gold]


# Gold table, silver source and merge key of each pass-through builder.
PASS_THROUGH = (
    PassThrough("dim_language_risk_class", "classe_risco_idioma", ("Id", "IdiomaId")),
    PassThrough("fact_action", "acao", ("Id",)),
    PassThrough("fact_risk_action", "acao_risco", ("Id",)),
    PassThrough("dim_characterization", "caracterizacao", ("Id",)),
    PassThrough("dim_option_characterization", "caracterizacao_opcao", ("Id",)),
    PassThrough("dim_language_option_characterization", "caracterizacao_opcao_idioma", ("Id", "IdiomaId")),
    PassThrough("dim_control", "controle", ("Id",)),
    PassThrough("dim_language_category_control", "controle_categoria_idioma", ("Id", "IdiomaId")),
    PassThrough("fact_lottery", "loto", ("Id",)),
    PassThrough("fact_block_lottery", "loto_bloqueio", ("Id",)),
    PassThrough("fact_occupational_safety_map", "mapa_seguranca_ocupacional", ("Id",)),
    PassThrough("fact_occupational_risk_safety_map", "mapa_seguranca_risco_ocupacional", ("Id",)),
    PassThrough("fact_control_measure", "medida_controle", ("Id",)),
    PassThrough("dim_danger", "perigo", ("Id",)),
    PassThrough("dim_danger_class", "perigo_classe", ("Id",)),
    PassThrough("dim_language_danger", "perigo_idioma", ("Id", "IdiomaId")),
)
PASS_THROUGH_BY_GOLD = {p.gold: p for p in PASS_THROUGH}


def pass_through(source: DataFrame, spec: PassThrough) -> DataFrame:
    """The gold table's columns, by name and with their types; the loader stamps the control columns. A missing column
    raises, other columns of the silver table do not reach gold, and a value that its type cannot hold fails the load."""
    have = {c.lower(): c for c in source.columns}
    missing = [c for c in spec.columns if c.lower() not in have]
    if missing:
        raise SchemaMismatch(f"{spec.silver} lacks columns of {spec.gold}: {missing}")
    return source.select(*[F.col(f"`{have[c.lower()]}`").cast(contract.column_type(c)).alias(c) for c in spec.columns])


# Build levels of the gold layer (dimensions first, then facts).
LEVEL_1 = ("dim_risk_class", "dim_unit", "dim_calendar", "dim_language_risk_class", "language_riskclass",
           "dim_characterization", "dim_option_characterization", "dim_language_option_characterization",
           "dim_control", "dim_language_category_control", "dim_danger", "dim_danger_class", "dim_language_danger")
LEVEL_2 = ("fact_occupational_risk", "fact_occupational_risk_his", "fact_action", "fact_risk_action",
           "fact_lottery", "fact_block_lottery", "fact_occupational_safety_map",
           "fact_occupational_risk_safety_map", "fact_control_measure")


def language_riskclass_all(classe_risco_idioma: DataFrame) -> DataFrame:
    """K23 without the reported-class filter (every class id keeps its row)."""
    return language_pivot(classe_risco_idioma, "Id", "IdiomaId", "Descricao", keep_ids=None)
