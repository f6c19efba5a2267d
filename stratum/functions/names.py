"""Column name clean-up (B2, Q25) and name lower-casing."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Characters the silver layer replaces in column names.
_REPLACED = re.compile(r"[ /]")


class ColumnNameCollision(ValueError):
    pass


def clean_name(name: str) -> str:
    return _REPLACED.sub("_", name)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Space and '/' become '_'; two columns that would share a name raise."""
    new = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        k = n.lower()
        if k in seen:
            raise ColumnNameCollision(f"columns {seen[k]!r} and {old!r} both clean to {n!r}")
        seen[k] = old
    return df.toDF(*new)


def lower_name(name: str) -> str:
    return name.lower()
