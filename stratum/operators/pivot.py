"""Language pivot (D3, K23): one row per id, one column per language, plus a tolerability label."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Language ids and their column names; risk class codes that are unacceptable,
# and the class codes a pivot keeps.
LANGUAGES = {1: "ptBR", 2: "enUS", 3: "esES"}
UNACCEPTABLE_CLASSES = (13, 14, 15)
REPORTED_CLASSES = (9, 12, 13, 14, 15)


def tolerability(id_col, unacceptable=UNACCEPTABLE_CLASSES) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.when(c.isin(*unacceptable), F.lit("Unacceptable")).otherwise(F.lit("Acceptable"))


def pivot_by_key(df: DataFrame, id_col: str, key_col: str, value_col: str, mapping: dict = None) -> DataFrame:
    """MAX(CASE WHEN key = k THEN value END) per id for each mapped key (aggregates combine map-side)."""
    mapping = mapping or LANGUAGES
    return df.groupBy(id_col).agg(*[F.max(F.when(F.col(key_col) == k, F.col(value_col))).alias(name)
                                    for k, name in mapping.items()])


def language_pivot(df: DataFrame, id_col: str = "Id", key_col: str = "IdiomaId", value_col: str = "Descricao",
                   keep_ids=REPORTED_CLASSES, unacceptable=UNACCEPTABLE_CLASSES, mapping: dict = None) -> DataFrame:
    src = df.filter(F.col(id_col).isin(*keep_ids)) if keep_ids is not None else df
    out = pivot_by_key(src, id_col, key_col, value_col, mapping)
    return out.withColumn("Tolerability", tolerability(id_col, unacceptable))
