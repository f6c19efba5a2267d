"""JSON field extraction (H14, H15, B15): one ``from_json`` per document, then typed casts.

Every field is parsed as text first (a scalar, an object or invalid JSON gives the same text a
``get_json_object`` lookup would), then converted leniently, so '"7"' and 12.5 both become ints."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.casts import lenient_bool, lenient_int, lenient_int_sql


def _convert(c: Column, kind: str) -> Column:
    if kind == "int":
        return lenient_int(c)
    if kind == "boolean":
        return lenient_bool(c)
    if kind == "string":
        return c
    return c.try_cast(kind)


def _convert_sql(ref: str, kind: str) -> str:
    if kind == "int":
        return lenient_int_sql(ref)
    if kind == "boolean":
        return f"try_cast(CAST({ref} AS STRING) AS BOOLEAN)"
    if kind == "string":
        return ref
    return f"try_cast({ref} AS {kind})"


def json_fields(doc, fields: dict[str, str], prefix_struct: str = "_j") -> list[Column]:
    """Column list extracting ``fields`` (json name -> type) from the JSON text column ``doc``.

    Names are matched exactly, like a ``$.name`` path. Output columns keep the json name;
    rename with ``json_select(..., rename=)``."""
    doc = F.col(doc) if isinstance(doc, str) else doc
    schema = T.StructType([T.StructField(n, T.StringType()) for n in fields])
    parsed = F.from_json(doc, schema, {"mode": "PERMISSIVE"})
    return [_convert(parsed.getField(n), kind).alias(n) for n, kind in fields.items()]


def json_select(df: DataFrame, doc: str, fields: dict[str, str], rename: dict[str, str] | None = None,
                keep: list[str] | None = None) -> DataFrame:
    """One projection: kept columns + every extracted field (no chain of withColumn)."""
    rename = rename or {}
    keep = df.columns if keep is None else keep
    schema = T.StructType([T.StructField(n, T.StringType()) for n in fields])
    tmp = df.select(*[F.col(c) for c in keep], F.from_json(F.col(doc), schema).alias("__json"))
    # one SQL expression per field: building many Column trees from Python costs seconds of driver time
    out = [f"`{c}`" for c in keep]
    for n, kind in fields.items():
        out.append(f"{_convert_sql(f'__json.`{n}`', kind)} AS `{rename.get(n, n)}`")
    return tmp.selectExpr(*out)


def generated_fields(stem: str, count: int, kind: str = "int") -> dict[str, str]:
    """v1..v15 / c1..c40 style field families, built from a rule."""
    return {f"{stem}{i}": kind for i in range(1, count + 1)}
