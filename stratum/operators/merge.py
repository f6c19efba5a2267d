"""Hash-compared upsert (A15), its change feed (A20) and the multi-key match (C4).

Plain Parquet has no MERGE, so the merge is a pure function ``(target, source, keys) -> new snapshot``:
one full outer join on the keys. Matched rows whose hash differs are updated (hash_row included, Q1),
unmatched source rows are inserted, target-only rows are kept, nothing is deleted."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.audit import CONTROL_COLUMNS, run_timestamp, with_audit_columns


class SchemaMismatch(ValueError):
    pass


class KeyViolation(ValueError):
    pass


def parse_keys(keys) -> list[str]:
    if isinstance(keys, str):
        keys = keys.split(",")
    out = [k.strip() for k in keys if k and k.strip()]
    if not out:
        raise KeyViolation("merge needs at least one key column")
    return out


def check_keys(source: DataFrame, keys: list[str]) -> None:
    """NULL keys never match (Q7) and duplicate source keys are ambiguous (Q8): both raise.
    One grouped aggregate (combined map-side) finds either."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    bad = (source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
                 .filter((F.col("__n") > 1) | any_null).limit(1).collect())
    if bad:
        row = bad[0].asDict()
        kind = "NULL in merge key" if any(row[k] is None for k in keys) else "duplicate source key"
        raise KeyViolation(f"{kind} {keys}: {row}")


def latest_per_key(source: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """on_duplicate='latest': keep the row with the greatest ``order_by`` per key.
    An aggregate (max_by over a struct) combines map-side, so a hot key never lands whole in one task."""
    others = [c for c in source.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    order = F.struct(F.col(order_by), F.hash(*[F.col(c) for c in others]))
    agg = source.groupBy(*keys).agg(F.max_by(packed, order).alias("__row"))
    return agg.select(*keys, *[F.col("__row").getField(c).alias(c) for c in others]).select(*source.columns)


def same_columns(a: DataFrame, b: DataFrame) -> None:
    sa, sb = {c.lower() for c in a.columns}, {c.lower() for c in b.columns}
    if sa != sb:
        raise SchemaMismatch(f"column sets differ: only target {sorted(sa - sb)}, only source {sorted(sb - sa)}")


def merge_plan(target: DataFrame, source: DataFrame, keys, run_ts, add_hash: bool = True,
               hash_mode: str = "compat", on_duplicate: str = "error", order_by: str | None = None,
               validate: bool = True) -> DataFrame:
    """Joined frame with the merged row (target column order) and an ``_action`` column:
    insert | update | noop | keep."""
    keys = parse_keys(keys)
    if on_duplicate == "latest":
        if not order_by:
            raise ValueError("on_duplicate='latest' needs order_by")
        source = latest_per_key(source, keys, order_by)
    src = with_audit_columns(source, run_ts, add_hash=add_hash, mode=hash_mode)
    if not add_hash and "hash_row" in [c.lower() for c in target.columns]:
        src = src.withColumn("hash_row", F.lit(None).cast("string"))
    same_columns(target, src)
    if validate:
        check_keys(src, keys)
    tcols = target.columns
    lower_to_src = {c.lower(): c for c in src.columns}
    # a marker on each side tells which side a row came from; a key may be NULL in the target
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in tcols], F.lit(True).alias("_in_target"))
    s = src.select(*[F.col(lower_to_src[c.lower()]).alias(f"s__{c}") for c in tcols], F.lit(True).alias("_in_source"))
    cond = None
    for k in keys:
        tk = next(c for c in tcols if c.lower() == k.lower())
        e = F.col(f"t__{tk}") == F.col(f"s__{tk}")
        cond = e if cond is None else cond & e
    j = t.join(s, cond, "full_outer")
    in_t, in_s = F.col("_in_target").isNotNull(), F.col("_in_source").isNotNull()
    if add_hash:
        differs = ~F.col("t__hash_row").eqNullSafe(F.col("s__hash_row"))
    else:  # Q3: no hash -> compare every non-key, non-control column null-safely
        data = [c for c in tcols if c.lower() not in CONTROL_COLUMNS and c.lower() not in {k.lower() for k in keys}]
        same = F.lit(True)
        for c in data:
            same = same & F.col(f"t__{c}").eqNullSafe(F.col(f"s__{c}"))
        differs = ~same
    action = (F.when(~in_t, "insert").when(~in_s, "keep").when(differs, "update").otherwise("noop"))
    j = j.withColumn("_action", action)
    take_src = F.col("_action").isin("insert", "update")
    ts = run_timestamp(run_ts)
    out = []
    for c in tcols:
        lc = c.lower()
        if lc == "insert_date":
            e = F.when(in_t, F.col(f"t__{c}")).otherwise(F.col(f"s__{c}"))
        elif lc == "update_date":
            e = F.when(take_src, ts).otherwise(F.col(f"t__{c}"))
        else:
            e = F.when(take_src, F.col(f"s__{c}")).otherwise(F.col(f"t__{c}"))
        out.append(e.alias(c))
    return j.select(*out, "_action", *[F.col(f"t__{c}") for c in tcols])


def merge_frames(target: DataFrame, source: DataFrame, keys, run_ts, **kw) -> DataFrame:
    """The merged snapshot (target columns only)."""
    plan = merge_plan(target, source, keys, run_ts, **kw)
    return plan.select(*target.columns)


def change_feed(target: DataFrame, source: DataFrame, keys, run_ts, **kw) -> DataFrame:
    """Rows a change-data feed would report for this merge, from one pass over the join:
    insert, update_preimage, update_postimage (noop and kept rows report nothing)."""
    return changes_from_plan(merge_plan(target, source, keys, run_ts, **kw), target.columns)


def changes_from_plan(plan: DataFrame, cols: list[str]) -> DataFrame:
    """The change feed of an already computed ``merge_plan`` (so one join serves snapshot and feed)."""
    new = F.struct(*[F.col(c).alias(c) for c in cols], F.lit("insert").alias("_change_type"))
    post = F.struct(*[F.col(c).alias(c) for c in cols], F.lit("update_postimage").alias("_change_type"))
    pre = F.struct(*[F.col(f"t__{c}").alias(c) for c in cols], F.lit("update_preimage").alias("_change_type"))
    return (plan.filter(F.col("_action").isin("insert", "update"))
                .select(F.explode(F.when(F.col("_action") == "insert", F.array(new))
                                  .otherwise(F.array(pre, post))).alias("__c"))
                .select(*[F.col("__c").getField(c).alias(c) for c in cols], F.col("__c._change_type").alias("_change_type")))


def action_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("_action").count()
