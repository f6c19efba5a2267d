"""DuckDB SQL for the proxies in ``testdata`` (used by the oracle queries)."""
from __future__ import annotations

from stratum.proxies.testdata import MODEL_RUN_DATE

RISK = """risk AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS Id, l.l_suppkey AS UnidadeId, s.s_nationkey AS ClasseId,
         CAST(round(l.l_discount * 100) AS INTEGER) AS ClassePosControleId,
         CAST(l.l_quantity AS INTEGER) AS ClasseLinearId, l.l_linenumber + 8 AS ClasseLinearPosControleId,
         l.l_quantity AS RiscoLinear, l.l_extendedprice AS RiscoLinearPosControle,
         l.l_linenumber AS ProbabilidadeId, l.l_linenumber AS ProbabilidadePosControleId,
         l.l_linenumber AS SeveridadeId, l.l_partkey AS PerigoId, l.l_shipdate AS DataCriacao,
         CASE WHEN l.l_linestatus = 'F' THEN l.l_shipdate + INTERVAL 30 DAY END AS DataAtualizacao,
         l.l_returnflag = 'R' AS Deletado, CASE WHEN l.l_linestatus = 'F' THEN -1 ELSE 1 END AS Status
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

FACT = RISK + """,
fact AS (
  SELECT Id, UnidadeId AS UnitId, ClasseId AS ClassId, ClassePosControleId AS MitigatedClassId,
         ClasseLinearId AS LinearClassId, ClasseLinearPosControleId AS LinearMitigatedClassId,
         RiscoLinear AS LinearRiskScore, RiscoLinearPosControle AS MitigatedLinearRiskScore,
         ProbabilidadeId AS ProbabilityId, ProbabilidadePosControleId AS MitigatedProbabilityId,
         SeveridadeId AS SeverityId, PerigoId AS HazardId, CAST(DataCriacao AS DATE) AS CreationDate,
         CAST(DataAtualizacao AS DATE) AS UpdateDate,
         CAST(COALESCE(DataAtualizacao, DataCriacao) AS DATE) + 50 AS EvaluationExpirationDate,
         Deletado AS Eliminated, Status, CAST(NULL AS INTEGER) AS OccupationalRiskHisId
  FROM risk)"""

AUDIT = """audit AS (
  SELECT e.event_id AS Id, e.user_id AS RiscoOcupacional, c.c_nationkey AS UnitId, e.ts AS DataCriacao,
         e.event_type AS ClasseRiscoDepois, e.event_type AS ProbabilidadeDepois, e.event_type AS SeveridadeDepois,
         CAST(floor(CAST(json_extract_string(e.props, '$.k') AS INTEGER) / 4) AS INTEGER) AS ClasseId,
         CAST(floor(CAST(json_extract_string(e.props, '$.k') AS INTEGER) / 4) AS INTEGER) AS ClassePosControleId,
         CAST(floor(CAST(json_extract_string(e.props, '$.k') AS INTEGER) / 4) AS INTEGER) + 1 AS ClasseLinearId,
         CAST(NULL AS INTEGER) AS ClasseLinearPosControleId,
         CAST(trunc(e.value) AS INTEGER) AS RiscoLinear, CAST(NULL AS INTEGER) AS RiscoLinearPosControle,
         CASE WHEN e.event_type = 'error' THEN -1 ELSE 1 END AS Status,
         e.event_type = 'signup' AS Deletado
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey)"""

HIS_OPEN = AUDIT + """,
his_open AS (
  SELECT UnitId, Id AS OccupationalRiskHisId, RiscoOcupacional AS OccupationalRiskId, ClasseRiscoDepois AS Class,
         ProbabilidadeDepois AS Probability, SeveridadeDepois AS Severity, Status, ClasseId AS ClassId,
         ClassePosControleId AS MitigatedClassId, ClasseLinearId AS LinearClassId,
         ClasseLinearPosControleId AS LinearMitigatedClassId, RiscoLinear AS LinearRiskScore,
         RiscoLinearPosControle AS MitigatedLinearRiskScore, Deletado AS Eliminated,
         CAST(DataCriacao AS DATE) AS StartDate, DataCriacao AS CreateDateTime,
         CASE WHEN RiscoOcupacional IS NULL THEN NULL ELSE
           lead(CAST(DataCriacao AS DATE)) OVER (PARTITION BY RiscoOcupacional ORDER BY DataCriacao, Id) END AS next_start
  FROM audit)"""

HIS = HIS_OPEN + """,
his AS (
  SELECT UnitId, OccupationalRiskHisId, OccupationalRiskId, Class, Probability, Severity, Status, ClassId,
         MitigatedClassId, LinearClassId, LinearMitigatedClassId, LinearRiskScore, MitigatedLinearRiskScore,
         CASE WHEN next_start IS NOT NULL AND next_start >= StartDate THEN 0 ELSE 1 END AS Active, Eliminated,
         StartDate,
         CASE WHEN next_start IS NOT NULL AND next_start >= StartDate THEN CAST(next_start - 1 AS DATE) END AS EndDate,
         CreateDateTime
  FROM his_open)"""

LANG = """lang AS (
  SELECT n_nationkey AS Id, n_name AS ptBR, lower(n_name) AS enUS, n_name || ' (es)' AS esES,
         CASE WHEN n_nationkey IN (13, 14, 15) THEN 'Unacceptable' ELSE 'Acceptable' END AS Tolerability
  FROM nation)"""

CAL = f"""cal AS (
  SELECT CAST(d AS DATE) AS DateRef, CAST(year(d) AS INTEGER) AS Year, CAST(month(d) AS INTEGER) AS MonthNumber
  FROM (SELECT unnest(generate_series(CAST((SELECT min(l_shipdate) FROM lineitem) AS DATE),
                                      DATE '{MODEL_RUN_DATE[:4]}-12-31', INTERVAL 1 DAY)) AS d))"""

STAR = "WITH " + FACT + ",\n" + HIS + ",\n" + LANG + ",\n" + CAL + "\n"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def count_by_role(role: str, out: str, extra_where: str = "", dim_where: str | None = None) -> str:
    """COUNTROWS(fact) (not eliminated) by class name under a role, +0, blank member when unmatched."""
    where = "NOT coalesce(f.Eliminated, false)" + (f" AND {extra_where}" if extra_where else "")
    if dim_where is None:
        return STAR + f"""
, per AS (SELECT {role} AS k, count(*) AS n FROM fact f WHERE {where} GROUP BY {role}),
keyed AS (SELECT l.ptBR, p.n FROM per p LEFT JOIN lang l ON p.k = l.Id),
got AS (SELECT ptBR, sum(n) AS n FROM keyed GROUP BY ptBR),
members AS (SELECT DISTINCT ptBR FROM lang)
SELECT coalesce(m.ptBR, g.ptBR) AS ptBR, CAST(coalesce(g.n, 0) AS BIGINT) AS {out}
FROM members m FULL OUTER JOIN got g ON m.ptBR IS NOT DISTINCT FROM g.ptBR"""
    return STAR + f"""
, per AS (SELECT {role} AS k, count(*) AS n FROM fact f WHERE {where} GROUP BY {role}),
dim AS (SELECT * FROM lang WHERE {dim_where}),
got AS (SELECT d.ptBR, sum(p.n) AS n FROM per p JOIN dim d ON p.k = d.Id GROUP BY d.ptBR),
members AS (SELECT DISTINCT ptBR FROM dim)
SELECT coalesce(m.ptBR, g.ptBR) AS ptBR, CAST(coalesce(g.n, 0) AS BIGINT) AS {out}
FROM members m FULL OUTER JOIN got g ON m.ptBR IS NOT DISTINCT FROM g.ptBR"""
