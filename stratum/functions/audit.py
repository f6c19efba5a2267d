"""Row hash (H1) and audit columns (H2)."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control columns every silver/gold table carries, and the offset of the wall clock the
# audit columns use (UTC minus three hours).
CONTROL_COLUMNS = ("insert_date", "update_date", "hash_row")
LOCAL_OFFSET_HOURS = -3


def hash_expr(columns, mode: str = "compat") -> Column:
    """'compat': md5 of the '|'-joined text of each column, NULL read as ''.
    'strict': sha-256 of the row as JSON with NULL fields kept (no NULL/'' or separator collisions)."""
    columns = list(columns)
    if mode == "compat":
        return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
    if mode == "strict":
        return F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"}), 256)
    raise ValueError(f"unknown hash mode {mode!r}")


def with_row_hash(df: DataFrame, mode: str = "compat", exclude=CONTROL_COLUMNS) -> DataFrame:
    excl = {c.lower() for c in exclude}
    cols = [c for c in df.columns if c.lower() not in excl]
    return df.withColumn("hash_row", hash_expr(cols, mode))


def load_clock(offset_hours: int = LOCAL_OFFSET_HOURS, now: _dt.datetime | None = None) -> str:
    """The one clock of a load: UTC now shifted to the local wall clock, to the second. Taken once on the
    driver and passed as ``run_ts`` to every write of the load (so inserts and updates agree, Q4)."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return (now + _dt.timedelta(hours=offset_hours)).strftime("%Y-%m-%d %H:%M:%S")


def run_timestamp(run_ts) -> Column:
    """One clock for the whole load: the given wall-clock time, truncated to the second."""
    if isinstance(run_ts, _dt.datetime):
        run_ts = run_ts.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp_ntz(F.substring(F.lit(str(run_ts)), 1, 19))


def with_audit_columns(df: DataFrame, run_ts, add_hash: bool = True, mode: str = "compat") -> DataFrame:
    """Replace insert_date / update_date with ``run_ts`` and (optionally) recompute hash_row."""
    ts = run_timestamp(run_ts)
    keep = [F.col(c) for c in df.columns if c.lower() not in CONTROL_COLUMNS]
    out = df.select(*keep, ts.alias("insert_date"), ts.alias("update_date"))
    return with_row_hash(out, mode) if add_hash else out
