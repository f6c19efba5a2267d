"""Silver builders."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.json import generated_fields, json_select
from stratum.functions.names import clean_column_names
from stratum.operators import hierarchy as hier
from stratum.operators.distinct import distinct_rows
from stratum.operators.joins import lookup
from stratum.sources import files

# Typed fields read from the audit document, and its generated field families.
AUDIT_FIELDS = {
    "classeLinearId": "int", "classeLinearPosControleId": "int", "riscoLinear": "int",
    "riscoLinearPosControle": "int", "classeId": "int", "classePosControleId": "int",
    "deletado": "boolean", "status": "int",
}
AUDIT_RENAMES = {
    "classeLinearId": "ClasseLinearId", "classeLinearPosControleId": "ClasseLinearPosControleId",
    "riscoLinear": "RiscoLinear", "riscoLinearPosControle": "RiscoLinearPosControle", "classeId": "ClasseId",
    "classePosControleId": "ClassePosControleId", "deletado": "Deletado", "status": "Status",
}
V_FIELDS, C_FIELDS = ("v", 15), ("c", 40)
AUDIT_BASE_COLUMNS = (
    "Id", "RiscoOcupacional", "UnitId", "RiscoAmbiental", "Datahora", "DataCriacao", "Usuario", "Justificativa",
    "Diff", "ClasseLinearId", "ClasseLinearPosControleId", "RiscoLinear", "RiscoLinearPosControle", "ClasseId",
    "ClassePosControleId", "ProbabilidadeAntes", "SeveridadeAntes", "ClasseRiscoAntes", "ProbabilidadeDepois",
    "SeveridadeDepois", "ClasseRiscoDepois", "EvidenciaId", "Tipo", "Deletado", "Status", "SYNC_DATE", "MobileId",
    "Motivo",
)


def audit_fields() -> dict[str, str]:
    f = dict(AUDIT_FIELDS)
    f.update(generated_fields(*V_FIELDS))
    f.update(generated_fields(*C_FIELDS))
    return f


def enrich_audit(risco_auditoria: DataFrame, risco_ocupacional: DataFrame, doc: str = "RegistroDepois",
                 final_columns=None) -> DataFrame:
    """Audit rows + their unit (left lookup through the risk) + 63 typed fields from the JSON
    document, in the final column order. Written to a table of its own (Q16).

    The three language-description joins of the source are dropped: their columns are removed
    before the write, so they only could multiply rows (Q17)."""
    units = risco_ocupacional.select(F.col("Id").alias("__rid"), F.col("UnidadeId").alias("UnitId"))
    with_unit = lookup(risco_auditoria, units, F.col("RiscoOcupacional") == F.col("__rid"), "left",
                       distinct_right=True).drop("__rid")
    fields = audit_fields()
    keep = [c for c in with_unit.columns if c not in ("RegistroAntes", "RegistroDepois", "Detalhes")]
    wide = json_select(with_unit, doc, fields, rename=AUDIT_RENAMES, keep=keep)
    cols = list(final_columns or AUDIT_BASE_COLUMNS) + list(generated_fields(*V_FIELDS)) + list(generated_fields(*C_FIELDS))
    return wide.select(*cols)


def unit_paths(unidade_idioma: DataFrame, parts: list[str], out: str = "Hierarquia") -> DataFrame:
    """A derived full path column (projection, never an in-place append to the input, Q15)."""
    return unidade_idioma.withColumn(out, hier.hierarchy_path(*parts))


def status_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A status list from a JSON array file."""
    return files.read_json_array(spark, path, schema)


def bronze_to_silver(bronze: DataFrame, apply_distinct: bool = False) -> DataFrame:
    """K24 transform of a bronze scan: optional whole-row de-duplication, then column-name clean-up."""
    return clean_column_names(distinct_rows(bronze) if apply_distinct else bronze)
