"""Default summarization (D8): a column's declared summary (sum / count / none) turned into one aggregate."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Summary kinds the model declares per column.
SUMMARIES = ("sum", "count", "none")


def summarize(df: DataFrame, by: list[str], declared: dict[str, str]) -> DataFrame:
    """One aggregate per declared column, named by the summary and the whole column name; sums are not rounded."""
    aggs = []
    for col, kind in declared.items():
        if kind == "sum":
            aggs.append(F.sum(col).alias(f"sum_{col}"))
        elif kind == "count":
            aggs.append(F.count(col).alias(f"count_{col}"))
        elif kind != "none":
            raise ValueError(f"unknown summary {kind!r}")
    return df.groupBy(*by).agg(*aggs)
