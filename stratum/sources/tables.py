"""Catalog tables and load modes.

Tables are Parquet, registered in the session catalog. A write never replaces files a query is
reading: every full write goes to a fresh location under the table's root, then the catalog entry is
re-pointed (plain Parquet refuses to overwrite a table that the same plan reads). Appends add files
to the current location and widen the registered schema. Merge (A15) writes the merged snapshot the
same way."""
from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.audit import run_timestamp, with_audit_columns
from stratum.operators.merge import SchemaMismatch, check_keys, latest_per_key, parse_keys, same_columns
from stratum.operators.upsert import Upsert, match, observed, refuse_bad_keys, stage_checked, stage_matched
from stratum.session import shared_dir

# Load modes and table types the loader accepts; 'N/A' means no partition columns.
LOAD_MODES = ("merge", "overwrite", "append")
TABLE_TYPES = ("managed", "external")
NO_PARTITIONS = "N/A"
#: Codec of the files of tables and of staged frames. A merge keeps the old snapshot, staged rows and the new snapshot
#: side by side; snappy takes half as much again on wide texts.
CODEC = "zstd"
#: How these files are written. Readers hold up to 4,096 rows of a row group at once, whatever their width, so a row group of
#: wide rows is kept small enough for that.
WRITTEN = {"compression": CODEC, "parquet.block.size": str(32 << 20)}
#: The new rows of a merge that are not small are written in so many portions; a portion's staged files go when it is written.
PORTIONS = 8


class UnknownLoadMode(ValueError):
    pass


@dataclass
class Target:
    """Where a load goes: catalog name (``table``, ``schema.table`` or ``catalog.schema.table``),
    table type, optional root location and partition columns."""
    name: str
    table_type: str = "external"
    root: str | None = None
    partition_columns: list[str] = field(default_factory=list)
    buckets: int | None = None                 # bucket by the merge keys: merges then shuffle only the source
    bucket_keys: list[str] = field(default_factory=list)
    change_feed: bool = False                  # keep every load's changes in a table beside this one

    def __post_init__(self):
        if isinstance(self.partition_columns, str):
            pc = self.partition_columns.strip()
            self.partition_columns = [] if pc in ("", NO_PARTITIONS) else [c.strip() for c in pc.split(",")]
        if self.table_type not in TABLE_TYPES:
            raise ValueError(f"table_type must be one of {TABLE_TYPES}")

    @property
    def schema(self) -> str | None:
        parts = self.name.split(".")
        return ".".join(parts[:-1]) if len(parts) > 1 else None


def _root(spark: SparkSession, t: Target) -> str:
    if t.root:
        return t.root.rstrip("/")
    base = shared_dir(spark)
    kind = "managed" if t.table_type == "managed" else "external"
    return f"{base}/stratum/{kind}/{t.name.replace('.', '/')}"


def ensure_schema(spark: SparkSession, schema: str | None) -> None:
    """CREATE SCHEMA IF NOT EXISTS, located under the shared folder (not the driver's working dir)."""
    if schema and not spark.catalog.databaseExists(schema):
        loc = f"{shared_dir(spark)}/stratum/schemas/{schema.replace('.', '/')}.db"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{loc}'")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Probe a location by reading its schema; a missing or unreadable location is False."""
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def metadata(spark: SparkSession, name: str) -> dict:
    """The catalog's entry of a table; its keys never mix with the names of the table's columns."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])


def location(spark: SparkSession, name: str) -> str:
    return metadata(spark, name)["location"]


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _register(spark: SparkSession, t: Target, loc: str, schema: T.StructType) -> None:
    ensure_schema(spark, t.schema)
    new = _new_name(t)
    part = f"PARTITIONED BY ({', '.join(t.partition_columns)})" if t.partition_columns else ""
    data = [f for f in schema.fields if f.name not in t.partition_columns]
    parts = [schema[c] for c in t.partition_columns]
    spark.sql(f"CREATE TABLE {new} ({_ddl(T.StructType(data + parts))}) USING parquet {part} LOCATION '{loc}'")
    if t.partition_columns:
        spark.sql(f"ALTER TABLE {new} RECOVER PARTITIONS")
    _swap(spark, new, t)


def is_managed(spark: SparkSession, name: str) -> bool:
    return metadata(spark, name).get("type") == "MANAGED"


def _write_managed(spark: SparkSession, df: DataFrame, t: Target, more: Iterable[DataFrame] = ()) -> None:
    """A table whose files lie in the catalog's own folder, so that DROP removes them: written whole under a name of its
    own (``df``, then ``more``), then swapped in (the catalog moves the folder along with the name)."""
    ensure_schema(spark, t.schema)
    new = _new_name(t)
    w = _clustered(df, t.partition_columns).write.mode("errorifexists").format("parquet").options(**WRITTEN)
    if t.partition_columns:
        w = w.partitionBy(*t.partition_columns)
    w.saveAsTable(new)
    for rows in more:
        rows.write.mode("append").format("parquet").options(**WRITTEN).saveAsTable(new)
    _swap(spark, new, t)


def _new_name(t: Target) -> str:
    return f"{t.name}__new_{uuid.uuid4().hex[:8]}"


def _swap(spark: SparkSession, new: str, t: Target) -> None:
    """Give a complete table the target's name; only catalog entries change. The old entry is set aside first and gets its
    name back if the new one cannot take it, so a failure leaves the old table as it was."""
    old = f"{t.name}__old_{uuid.uuid4().hex[:8]}" if table_exists(spark, t.name) else None
    if old:
        _rename(spark, t.name, old)
    try:
        _rename(spark, new, t.name)
    except Exception:
        if old:
            _rename(spark, old, t.name)
        raise
    if old:
        spark.sql(f"DROP TABLE {old}")
    spark.catalog.refreshTable(t.name)


def _rename(spark: SparkSession, name: str, to: str) -> None:
    """A managed table's folder moves with its name, but the entries of its partitions may go on naming the old place, where
    another table's files may come to lie: dropping the table would delete those. So they are brought in line at once."""
    spark.sql(f"ALTER TABLE {name} RENAME TO {to}")
    if is_managed(spark, to) and any(c.isPartition for c in spark.catalog.listColumns(to)):
        spark.sql(f"MSCK REPAIR TABLE {to} SYNC PARTITIONS")
        spark.catalog.refreshTable(to)


def write_snapshot(spark: SparkSession, df: DataFrame, t: Target, more: Iterable[DataFrame] = ()) -> str:
    """``df``, then ``more``, in a folder that nothing reads yet."""
    loc = f"{_root(spark, t)}/snapshot-{uuid.uuid4().hex[:12]}"
    w = _clustered(df, t.partition_columns).write.mode("errorifexists").options(**WRITTEN)
    if t.partition_columns:
        w = w.partitionBy(*t.partition_columns)
    w.parquet(loc)
    for rows in more:
        rows.write.mode("append").options(**WRITTEN).parquet(loc)
    return loc


def _clustered(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a partition brought together before they are written, so that not every task writes a file into every
    partition. ``rebalance`` lets Spark split a hot partition over several tasks and join small ones in one."""
    return df.hint("rebalance", *[F.col(f"`{c}`") for c in columns]) if columns else df


def _write_bucketed(spark: SparkSession, df: DataFrame, t: Target) -> None:
    """A fresh snapshot written as a bucketed table (bucketing is recorded in the catalog entry), then swapped in. Rows
    of a bucket are brought together first; a hot bucket may be split over several tasks and then has several files."""
    ensure_schema(spark, t.schema)
    new = _new_name(t)
    df = _clustered(df.withColumn("__bucket", F.pmod(F.hash(*[F.col(c) for c in t.bucket_keys]), F.lit(t.buckets))), ["__bucket"]).drop("__bucket")
    w = df.write.mode("errorifexists").format("parquet").options(**WRITTEN)
    if t.table_type != "managed":
        w = w.option("path", f"{_root(spark, t)}/snapshot-{uuid.uuid4().hex[:12]}")
    if t.partition_columns:
        w = w.partitionBy(*t.partition_columns)
    w.bucketBy(t.buckets, *t.bucket_keys).sortBy(*t.bucket_keys).saveAsTable(new)
    _swap(spark, new, t)


def create_table(spark: SparkSession, df: DataFrame, t: Target, unique: list[str] = ()) -> DataFrame:
    """CREATE SCHEMA IF NOT EXISTS + a fresh table with ``df``'s columns (A11 managed, A12 external). The columns ``unique``
    must be keys: NULLs are counted while the rows are written, repeats are sought in the written keys, and the table gets
    its name only then, so the check runs the plan of ``df`` no second time."""
    if t.buckets or t.table_type == "managed":
        put = _staged(spark, t)
        rows = stage_checked(df, list(unique), put).frame if unique else df
        (_write_bucketed if t.buckets else _write_managed)(spark, rows, t)
        _discard(spark, put.made)
        return spark.table(t.name)
    watched, seen = observed(df, list(unique)) if unique else (df, None)
    loc = write_snapshot(spark, watched, t)
    if unique:
        refuse_bad_keys(spark.read.schema(df.schema).parquet(loc), seen, list(unique))
    _register(spark, t, loc, df.schema)
    return spark.table(t.name)


# For each number type the types that hold all its values.
WIDER = {"tinyint": ("smallint", "int", "bigint", "float", "double"), "smallint": ("int", "bigint", "float", "double"),
         "int": ("bigint", "double"), "bigint": (), "float": ("double",), "double": ()}
#: Digits of the integer types: a decimal with at least as many before its point holds them.
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def lossless(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of one type is a value of the other."""
    if have == want or isinstance(have, T.NullType):
        return True
    if isinstance(want, T.DecimalType):
        whole = want.precision - want.scale
        if isinstance(have, T.DecimalType):
            return have.scale <= want.scale and have.precision - have.scale <= whole
        return DIGITS.get(have.simpleString(), 99) <= whole
    return want.simpleString() in WIDER.get(have.simpleString(), ())


def _conformed(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """``df`` with the table's types, where none loses a digit by that; any other difference raises, since files of another
    type make a Parquet table unreadable."""
    have = {f.name.lower(): f.dataType for f in schema.fields}
    cols = []
    for f in df.schema.fields:
        want = have.get(f.name.lower(), f.dataType)
        a, b = f.dataType.simpleString(), want.simpleString()
        if a != b and not lossless(f.dataType, want):
            raise SchemaMismatch(f"column {f.name} of {name} is {b}, the new rows have {a}")
        cols.append(F.col(f"`{f.name}`").cast(want).alias(f.name) if a != b else F.col(f"`{f.name}`"))
    return df.select(*cols)


def overwrite(spark: SparkSession, df: DataFrame, t: Target) -> DataFrame:
    """Full replace; the schema is replaced too."""
    if table_exists(spark, t.name) and provider(spark, t.name) in NATIVE_MERGE_PROVIDERS:
        df.writeTo(t.name).overwrite(F.lit(True))
        return spark.table(t.name)
    return create_table(spark, df, t)


def append(spark: SparkSession, df: DataFrame, t: Target) -> DataFrame:
    """Append files to the current location; new columns widen the table schema."""
    if not table_exists(spark, t.name):
        return create_table(spark, df, t)
    cur = spark.table(t.name)
    df = _conformed(df, cur.schema, t.name)
    if provider(spark, t.name) in NATIVE_MERGE_PROVIDERS:
        df.writeTo(t.name).append()
        return spark.table(t.name)
    cur_names = {c.lower() for c in cur.columns}
    if t.buckets:
        if {c.lower() for c in df.columns} <= cur_names:
            w = df.select(*[c for c in cur.columns if c.lower() in {x.lower() for x in df.columns}]) \
                  .write.mode("append").format("parquet")
            if t.partition_columns:
                w = w.partitionBy(*t.partition_columns)
            w.bucketBy(t.buckets, *t.bucket_keys).sortBy(*t.bucket_keys).saveAsTable(t.name)
            return spark.table(t.name)
        # new columns: a widened bucketed snapshot (bucket files cannot take extra columns in place)
        stage = f"{_root(spark, t)}/staging-{uuid.uuid4().hex[:12]}"
        cur.unionByName(df, allowMissingColumns=True).write.mode("errorifexists").parquet(stage)
        _write_bucketed(spark, spark.read.parquet(stage), t)
        return spark.table(t.name)
    loc = location(spark, t.name)
    w = _clustered(df, t.partition_columns).write.mode("append").options(**WRITTEN)
    if t.partition_columns:
        w = w.partitionBy(*t.partition_columns)
    w.parquet(loc)
    added = [f for f in df.schema.fields if f.name.lower() not in cur_names]
    if is_managed(spark, t.name):   # its files belong to its name, so the entry is changed and never replaced
        if added:
            spark.sql(f"ALTER TABLE {t.name} ADD COLUMNS ({_ddl(T.StructType(added))})")
        if t.partition_columns:
            spark.sql(f"ALTER TABLE {t.name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(t.name)
    else:
        _register(spark, t, loc, T.StructType(list(cur.schema.fields) + added))
    return spark.table(t.name)


# Table formats whose catalog executes MERGE INTO natively.
NATIVE_MERGE_PROVIDERS = ("delta", "iceberg")


def provider(spark: SparkSession, name: str) -> str:
    return str(metadata(spark, name).get("provider", "")).lower()


def native_merge(spark: SparkSession, df: DataFrame, t: Target, keys, run_ts, add_hash: bool = True,
                 hash_mode: str = "compat", **kw) -> DataFrame:
    """MERGE INTO for table formats that support it: only files holding touched rows are rewritten.
    Same rules as the snapshot merge: update (hash included) when the hash differs, insert when
    absent, keep target-only rows."""
    from stratum.functions.audit import run_timestamp
    keys = parse_keys(keys)
    if kw.get("on_duplicate") == "latest":
        df = latest_per_key(df, keys, kw["order_by"])
    src = with_audit_columns(df, run_ts, add_hash, hash_mode)
    target_cols = spark.table(t.name).columns
    if {c.lower() for c in target_cols} != {c.lower() for c in src.columns}:
        raise SchemaMismatch(f"column sets differ between {t.name} and the source")
    check_keys(src, keys)
    view = register_view(src, "merge_src")
    on = " AND ".join(f"tgt.`{k}` = src.`{k}`" for k in keys)
    if add_hash:
        changed = "NOT (tgt.hash_row <=> src.hash_row)"
    else:
        data = [c for c in target_cols if c.lower() not in ("insert_date", "update_date", "hash_row")
                and c.lower() not in {k.lower() for k in keys}]
        changed = "NOT (" + " AND ".join(f"tgt.`{c}` <=> src.`{c}`" for c in data) + ")" if data else "false"
    sets = ", ".join(f"tgt.`{c}` = src.`{c}`" for c in target_cols if c.lower() != "insert_date")
    spark.sql(f"MERGE INTO {t.name} AS tgt USING {view} AS src ON {on} "
              f"WHEN MATCHED AND {changed} THEN UPDATE SET {sets} "
              f"WHEN NOT MATCHED THEN INSERT *")
    spark.catalog.dropTempView(view)
    return spark.table(t.name)


#: Touched partitions that a merge names in its scan filter; beyond, it joins with their table.
PRUNE_VALUES = 500


def _staged(spark: SparkSession, t: Target):
    """Writes frames below the table's root and reads them back: evaluated once, and safe from lost executors. ``put.made``
    are their folders."""
    def put(df: DataFrame, what: str) -> DataFrame:
        path = f"{_root(spark, t)}/staging-{what}-{uuid.uuid4().hex[:12]}"
        put.made.append(path)
        df.write.mode("errorifexists").options(**WRITTEN).parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    put.made = []
    return put


def _discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged files or folders that nothing reads any more."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def start_merge(spark: SparkSession, df: DataFrame, t: Target, keys, run_ts, add_hash: bool = True, hash_mode: str = "compat",
                on_duplicate: str = "error", order_by: str | None = None, validate: bool = True, put=None) -> Upsert:
    """The first phase of a merge: the stamped source, written and checked once, against the target's keys and hashes."""
    keys, target = parse_keys(keys), spark.table(t.name)
    if on_duplicate == "latest":
        if not order_by:
            raise ValueError("on_duplicate='latest' needs order_by")
        df = latest_per_key(df, keys, order_by)
    src = with_audit_columns(df, run_ts, add_hash, hash_mode)
    if not add_hash and "hash_row" in [c.lower() for c in target.columns]:
        src = src.withColumn("hash_row", F.lit(None).cast("string"))
    same_columns(target, src)
    by_name = {c.lower(): c for c in src.columns}
    src = _conformed(src.select(*[F.col(f"`{by_name[c.lower()]}`").alias(c) for c in target.columns]), target.schema, t.name)
    put = put or _staged(spark, t)
    up = stage_matched(target, src, keys, run_ts, put, add_hash, t.partition_columns) if validate else None
    return up or match(target, stage_checked(src, keys, put, validate), keys, run_ts, put, add_hash, t.partition_columns)


def merge_partitions(spark: SparkSession, up: Upsert, t: Target, new: DataFrame | None = None) -> DataFrame:
    """Rewrite only the partitions of a Parquet table that a merge touches: those that updated rows leave or enter and those
    that new rows enter (``new``, where they are written already). Where nothing differs, nothing is written. A partition that loses its last row cannot be emptied
    by a dynamic overwrite; then a complete new snapshot is written instead."""
    from stratum.operators.joins import broadcast_bounded
    pcols, put = list(t.partition_columns), _staged(spark, t)
    new = put(up.new_rows().select(*up.columns), "rows") if new is None else new.select(*up.columns)
    left = up.changed.select(*[F.col(f"`__old_{p}`").alias(p) for p in pcols])
    touched = put(left.unionByName(new.select(*pcols)).distinct(), "partitions")
    values = touched.limit(PRUNE_VALUES + 1).collect()
    if not values:
        return spark.table(t.name)
    if len(values) <= PRUNE_VALUES:
        rows = up.target.filter(_partition_filter(pcols, values))
    else:
        some = broadcast_bounded(touched)
        rows = up.target.join(some, [up.target[c].eqNullSafe(some[c]) for c in pcols], "left_semi")
    staged = put(up.kept(rows).unionByName(new), "merged")
    remaining = staged.select(*pcols).distinct()
    if not touched.join(remaining, [touched[c].eqNullSafe(remaining[c]) for c in pcols], "left_anti").isEmpty():
        whole = up.kept().unionByName(new)
        if is_managed(spark, t.name):
            _write_managed(spark, whole, t)
        else:
            _register(spark, t, write_snapshot(spark, whole, t), spark.table(t.name).schema)
        return spark.table(t.name)
    # the mode belongs to this one write: the session's setting may be in use by other loads
    _clustered(staged, pcols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .options(**WRITTEN).partitionBy(*pcols).parquet(location(spark, t.name))
    spark.sql(f"ALTER TABLE {t.name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(t.name)
    return spark.table(t.name)


def _partition_filter(cols: list[str], values: list):
    """Rows whose partition is one of ``values``, as plain comparisons with constants (a null-safe one does not prune)."""
    if len(cols) == 1:
        some = [r[0] for r in values if r[0] is not None]
        out = F.col(cols[0]).isin(some) if some else F.lit(False)
        return out | F.col(cols[0]).isNull() if len(some) < len(values) else out
    out = F.lit(False)
    for r in values:
        one = F.lit(True)
        for c in cols:
            one = one & (F.col(c).isNull() if r[c] is None else F.col(c) == F.lit(r[c]))
        out = out | one
    return out


def merge(spark: SparkSession, df: DataFrame, t: Target, keys, run_ts, add_hash: bool = True,
          hash_mode: str = "compat", with_changes: bool = False, **kw):
    """Hash-compared upsert into the table (A15); returns the new table (and the change feed).

    Delta/Iceberg tables get a native MERGE INTO. On plain Parquet the source meets the target's keys and hashes first
    (``operators.upsert``); unchanged rows then go from the old files to the new ones without a shuffle."""
    if provider(spark, t.name) in NATIVE_MERGE_PROVIDERS:
        if with_changes or t.change_feed:
            raise ValueError(f"{t.name} keeps a change feed of its own; read that one")
        return native_merge(spark, df, t, keys, run_ts, add_hash, hash_mode, **kw)
    put = _staged(spark, t)
    up = start_merge(spark, df, t, keys, run_ts, add_hash, hash_mode, put=put, **kw)
    # written before the table's own files change
    changes = _staged(spark, t)(up.changes(), "changes") if with_changes or t.change_feed else None
    new = changes.filter("_change_type <> 'update_preimage'") if changes is not None else None
    if t.buckets:
        _write_bucketed(spark, up.snapshot(new), t)
    elif t.partition_columns:
        merge_partitions(spark, up, t, new)
    else:
        if new is not None or up.source.small():
            rows, more = up.snapshot(new), []
        else:   # kept rows first, so that staged rows leave as the new ones come
            rows = up.kept()
            more = (r.select(*up.columns) for r in up.new_rows_in_portions(PORTIONS, lambda files: _discard(spark, files)))
        if is_managed(spark, t.name):
            _write_managed(spark, rows, t, more)
        else:
            # one catalog step: readers see the old files or the new ones, never neither
            spark.sql(f"ALTER TABLE {t.name} SET LOCATION '{write_snapshot(spark, rows, t, more)}'")
            spark.catalog.refreshTable(t.name)
    _discard(spark, put.made)
    if t.change_feed:
        record_changes(spark, changes, t, run_ts)
    out = spark.table(t.name)
    return (out, changes) if with_changes else out


def changes_table(t: Target) -> str:
    return f"{t.name}__changes"


def record_changes(spark: SparkSession, changes: DataFrame, t: Target, run_ts) -> None:
    """Add a load's changes, written already, to the table of changes: one partition per load, so a catalog entry only.
    Loads come after the snapshot they belong to; columns that a load adds are added to the table."""
    name = changes_table(t)
    if not table_exists(spark, name):
        spark.sql(f"CREATE TABLE {name} ({_ddl(changes.schema)}, _load STRING, _commit STRING) USING parquet PARTITIONED BY (_load, _commit) "
                  f"LOCATION '{_root(spark, t)}/changes'")
    known = {c.lower() for c in spark.table(name).columns}
    new = T.StructType([f for f in changes.schema.fields if f.name.lower() not in known])
    if new.fields:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(new)})")
    at = changes.inputFiles()
    place = at[0].rsplit("/", 1)[0] if at else None
    load = run_timestamp(run_ts)
    stamp = spark.range(1).select(F.date_format(load, "yyyy-MM-dd HH:mm:ss")).first()[0]
    if place:
        spark.sql(f"ALTER TABLE {name} ADD PARTITION (_load = '{stamp}', _commit = '{uuid.uuid4().hex[:12]}') LOCATION '{place}'")
    spark.catalog.refreshTable(name)


def read_changes(spark: SparkSession, t: Target | str, since: str | None = None, until: str | None = None) -> DataFrame:
    """The changes of all loads from ``since`` to ``until`` (wall-clock texts, both included), with ``_load``. Loads
    outside are not read: the range prunes partitions."""
    df = spark.table(t if isinstance(t, str) else changes_table(t))
    if since is not None:
        df = df.filter(F.col("_load") >= since)
    if until is not None:
        df = df.filter(F.col("_load") <= until)
    return df.drop("_commit")


def replace_table(spark: SparkSession, df: DataFrame, t: Target) -> DataFrame:
    """A transformed frame saved as a table of its own (A18); never over its own input (Q15, Q16)."""
    return create_table(spark, df, t)


def register_view(df: DataFrame, stem: str) -> str:
    """A unique temp view name per load."""
    name = f"{stem}_{uuid.uuid4().hex[:8]}"
    df.createOrReplaceTempView(name)
    return name


def load(spark: SparkSession, df: DataFrame, t: Target, mode: str, keys=None, run_ts=None,
         add_hash: bool = True, hash_mode: str = "compat", **kw) -> DataFrame:
    """automated_load (A22): create when absent, else merge / overwrite / append.

    Audit columns (and the row hash) are stamped with ``run_ts``; an unknown mode raises."""
    if mode not in LOAD_MODES:
        raise UnknownLoadMode(f"mode {mode!r} not in {LOAD_MODES}")
    present = table_exists(spark, t.name)
    if present and mode == "merge":
        return merge(spark, df, t, keys, run_ts, add_hash=add_hash, hash_mode=hash_mode, **kw)
    put, names = _staged(spark, t), []
    if not present and mode == "merge" and keys is not None:   # the first load keeps the rules of the later ones
        names = parse_keys(keys)
        if kw.get("on_duplicate") == "latest":
            df = latest_per_key(df, names, kw["order_by"])
    stamped = with_audit_columns(df, run_ts, add_hash, hash_mode)
    changes = None
    if t.change_feed:
        changes = stamped.withColumn("_change_type", F.lit("insert"))
        if present and mode == "overwrite":
            changes = changes.unionByName(spark.table(t.name).withColumn("_change_type", F.lit("delete")), allowMissingColumns=True)
        changes = put(changes, "changes")
    if not present:
        out = create_table(spark, stamped, t, names if kw.get("validate", True) else [])
    elif mode == "overwrite":
        out = overwrite(spark, stamped, t)
    else:
        out = append(spark, stamped, t)
    if changes is not None:
        record_changes(spark, changes, t, run_ts)
    return out
