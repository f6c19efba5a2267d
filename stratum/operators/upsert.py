"""The hash-compared upsert of a table in two phases (A15): keys and hashes first, rows afterwards.

Phase one joins the source with the target's keys, hashes and row places only. Phase two takes the target's rows as they
lie in their files, without those that change, and adds the changed and the new rows. So a wide target is never dealt
out anew: a small source is broadcast, and of a large one's target only narrow columns and touched files are. Where those
narrow columns can be broadcast, the source is staged with them, and only its rows that change something in full."""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratum.functions.audit import CONTROL_COLUMNS, run_timestamp
from stratum.operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, broadcast_bounded, row_bytes
from stratum.operators.merge import KeyViolation, SchemaMismatch

FILE, ROW = "__file", "__row"
Put = Callable[[DataFrame, str], DataFrame]


def located(table: DataFrame) -> DataFrame:
    """A file table's rows with their places: the file and the number of the row in it. Files go by a digest of their paths,
    so that no path travels with a row; where two files share a digest, by the paths."""
    meta = table.metadataColumn("_metadata")
    path = meta.getField("file_path")
    files = table.select(path.alias("path")).distinct().agg(F.count("path").alias("n"), F.count_distinct(F.xxhash64("path")).alias("digests")).first()
    name = F.xxhash64(path) if files["n"] == files["digests"] else path
    return table.select("*", name.alias(FILE), meta.getField("row_index").alias(ROW))


#: A located row's place is one of those in ``row_masks``.
IN_MASK = f"{FILE} = __f AND shiftright({ROW}, 6) = __w AND (shiftright(__mask, CAST({ROW} % 64 AS INT)) & 1) = 1"


def row_masks(places: DataFrame) -> DataFrame:
    """Places as bits, 64 rows of a file in one long: of many places much less has to be broadcast."""
    return places.groupBy(F.col(FILE).alias("__f"), F.expr(f"shiftright({ROW}, 6)").alias("__w")).agg(
        F.expr(f"bit_or(shiftleft(1L, CAST({ROW} % 64 AS INT)))").alias("__mask"))


def bounded_places(places: DataFrame) -> tuple[DataFrame, Column, bool]:
    """Places to join located rows with, the condition, and whether they are broadcast: as they are where they are few, as
    bits where those are, else neither."""
    plain, one_by_one = places.select(F.col(FILE).alias("__f"), F.col(ROW).alias("__r")), F.expr(f"{FILE} = __f AND {ROW} = __r")
    if (few := broadcast_bounded(plain)) is not plain:
        return few, one_by_one, True
    masks = row_masks(places)
    if (few := broadcast_bounded(masks)) is not masks:
        return few, F.expr(IN_MASK), True
    return plain, one_by_one, False


@dataclass
class Staged:
    """A frame written once, with what was counted while it was written."""
    frame: DataFrame
    rows: int
    bytes: int

    def small(self) -> bool:
        return self.rows <= DEFAULT_BROADCAST_ROWS and self.bytes <= DEFAULT_BROADCAST_BYTES


def stage_checked(source: DataFrame, keys: list[str], put: Put, validate: bool = True) -> Staged:
    """Write a source once; rows, bytes and NULL keys are counted on the way (an ``Observation``, no pass of its own).
    NULL keys never match (Q7) and duplicate keys are ambiguous (Q8): both raise before the target is touched."""
    watched, seen = observed(source, keys)
    out = put(watched, "source")
    if validate:
        refuse_bad_keys(out, seen, keys)
    return Staged(out, seen.get["rows"], seen.get["bytes"])


def observed(df: DataFrame, keys: list[str]) -> tuple[DataFrame, Observation]:
    """``df`` with rows, bytes and NULL keys counted while it is written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"),
                      F.count_if(_null_key(keys)).alias("null_keys")), seen


def _null_key(keys: list[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(f"`{k}`").isNull()
    return out


def refuse_bad_keys(written: DataFrame, seen: Observation, keys: list[str], row: str | None = None) -> None:
    """``row``: a column that tells the source's rows apart, where one may have been written more than once."""
    if seen.get["null_keys"]:
        row = written.filter(_null_key(keys)).select(*keys).first()
        raise KeyViolation(f"NULL in merge key {keys}: {seen.get['null_keys']} rows, such as {row.asDict()}")
    several = F.min(row) < F.max(row) if row else F.count(F.lit(1)) > 1
    twice = written.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), several.alias("__several")).filter("__several").drop("__several").limit(1).collect()
    if twice:
        raise KeyViolation(f"duplicate source key {keys}: {twice[0].asDict()}")


@dataclass
class Upsert:
    """A merge after its first phase. ``matched`` has a row for each target row that a source row meets: the source's keys,
    whether the rows differ, the target row's place, its insert date and partition."""
    target: DataFrame
    columns: list[str]
    source: Staged
    matched: DataFrame
    keys: list[str]
    run_ts: object

    @property
    def changed(self) -> DataFrame:
        return self.matched.filter("__differs")

    def new_rows(self) -> DataFrame:
        """Rows after their update (the source's values, the target's insert date, this load's update date) and rows that no
        target row meets, with ``_change_type``. One join: the source's rows are dealt out once, or not at all where the
        keys of ``matched`` are few enough to be sent to them."""
        s = self.source.frame.select(*[F.col(f"`{c}`").alias(f"s__{c}") for c in self.columns])
        m = broadcast_bounded(self.matched.select(*[f"__key{i}" for i in range(len(self.keys))], "__differs", "__insert_date"))
        return self._stamped(s.join(m, [s[f"s__{k}"] == m[f"__key{i}"] for i, k in enumerate(self.keys)], "left"), "s__")

    def _stamped(self, j: DataFrame, prefix: str = "") -> DataFrame:
        """New rows out of source rows with what they meet."""
        met, out = F.col("__differs").isNotNull(), []
        for c in self.columns:
            value = F.col(f"`{prefix}{c}`")
            if c.lower() in ("insert_date", "update_date"):
                value = F.when(met, F.col("__insert_date") if c.lower() == "insert_date" else run_timestamp(self.run_ts)).otherwise(value)
            out.append(value.alias(c))
        return j.filter("coalesce(__differs, true)").select(*out, F.when(met, "update_postimage").otherwise("insert").alias("_change_type"))

    def inserted(self) -> DataFrame:
        met = self.matched.select(*[F.col(f"__key{i}") for i in range(len(self.keys))]).distinct()
        s = self.source.frame
        met = F.broadcast(met) if self.source.small() else met   # at most one row for each source row
        return s.join(met, [s[k] == met[f"__key{i}"] for i, k in enumerate(self.keys)], "left_anti").select(*self.columns)

    def kept(self, target: DataFrame | None = None) -> DataFrame:
        """Target rows that do not change, straight from their files. Where too many rows change for a broadcast, only the
        rows of files with a changed row are dealt out."""
        t = self.target if target is None else target
        gone, same, few = bounded_places(self.changed)
        if few:
            return t.join(gone, same, "left_anti").select(*self.columns)
        files = broadcast_bounded(gone.select("__f").distinct())
        whole = t.join(files, t[FILE] == files["__f"], "left_anti")
        touched = t.join(files, t[FILE] == files["__f"], "left_semi")
        return whole.select(*self.columns).unionByName(touched.join(gone, same, "left_anti").select(*self.columns))

    def before(self) -> DataFrame:
        """Changed target rows as they were."""
        gone, same, _ = bounded_places(self.changed)
        return self.target.join(gone, same, "left_semi").select(*self.columns)

    def snapshot(self, new: DataFrame | None = None) -> DataFrame:
        """The table after the merge; ``new`` are its new rows where they are written already."""
        return self.kept().unionByName((self.new_rows() if new is None else new).select(*self.columns))

    def actions(self) -> DataFrame:
        """The keys of both sides with what the merge does to them: insert, update, noop, or keep for target rows alone."""
        names = self.keys
        met = self.matched.select(*[F.col(f"__key{i}").alias(k) for i, k in enumerate(names)],
                                  F.when(F.col("__differs"), "update").otherwise("noop").alias("_action"))
        met_at, same, _ = bounded_places(self.matched)
        kept = self.target.select(*names, FILE, ROW).join(met_at, same, "left_anti")
        return met.unionByName(self.inserted().select(*names, F.lit("insert").alias("_action"))).unionByName(kept.select(*names, F.lit("keep").alias("_action")))

    def changes(self) -> DataFrame:
        """What a change feed reports: insert, update_preimage, update_postimage."""
        return self.new_rows().unionByName(self.before().withColumn("_change_type", F.lit("update_preimage")))


    def new_rows_in_portions(self, portions: int, done: Callable[[list[str]], None]) -> Iterator[DataFrame]:
        """``new_rows`` of a few staged files at a time; ``done`` gets the files whose rows are written."""
        spark = self.source.frame.sparkSession
        jvm = spark._jvm
        # inputFiles() are URIs, with some characters escaped
        files = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString() for f in self.source.frame.inputFiles()]
        each = max(1, -(-len(files) // portions))
        for i in range(0, len(files), each):
            some = spark.read.schema(self.source.frame.schema).parquet(*files[i:i + each])
            yield replace(self, source=replace(self.source, frame=some)).new_rows()
            done(files[i:i + each])


@dataclass
class MetUpsert(Upsert):
    """An upsert whose source was staged together with the target rows that its rows meet: once for each, rows that change
    nothing without their data."""

    def new_rows(self) -> DataFrame:
        return self._stamped(self.source.frame)

    def inserted(self) -> DataFrame:
        return self.source.frame.filter("__differs IS NULL").select(*self.columns)


def differs(columns: list[str], keys: list[str], add_hash: bool, t: Callable[[str], Column], s: Callable[[str], Column]) -> Column:
    """Whether two rows of one key differ: by their hashes, or without them by every other data column, null-safely (Q3)."""
    if add_hash:
        return ~t("hash_row").eqNullSafe(s("hash_row"))
    out = F.lit(False)
    for c in compared(columns, keys, add_hash):
        out = out | ~t(c).eqNullSafe(s(c))
    return out


def compared(columns: list[str], keys: list[str], add_hash: bool) -> list[str]:
    own = {k.lower() for k in keys}
    return ["hash_row"] if add_hash else [c for c in columns if c.lower() not in CONTROL_COLUMNS and c.lower() not in own]


def _narrow(table: DataFrame, source: DataFrame, keys: list[str], add_hash: bool, partitions: list[str]) -> tuple[DataFrame, DataFrame, list[str], list[str]]:
    """The target's located rows; of these what a source is matched with; the keys by the target's names; what is compared."""
    columns = table.columns
    if {c.lower() for c in columns} != {c.lower() for c in source.columns}:
        raise SchemaMismatch(f"column sets differ: target {sorted(columns)}, source {sorted(source.columns)}")
    keys = [next(c for c in columns if c.lower() == k.lower()) for k in keys]
    target = located(table)
    some = compared(columns, keys, add_hash)
    dated = next((c for c in columns if c.lower() == "insert_date"), None)
    t = target.select(*[F.col(f"`{k}`").alias(f"t__{k}") for k in keys], *[F.col(f"`{c}`").alias(f"t__{c}") for c in some], FILE, ROW,
                      (F.col(dated) if dated else F.lit(None)).alias("__insert_date"), *[F.col(f"`{p}`").alias(f"__old_{p}") for p in partitions])
    return target, t, keys, some


def _matched(j: DataFrame, prefix: str, keys: list[str], partitions: list[str]) -> DataFrame:
    return j.select(*[F.col(f"`{prefix}{k}`").alias(f"__key{i}") for i, k in enumerate(keys)], "__differs", FILE, ROW,
                    "__insert_date", *[f"__old_{p}" for p in partitions])


def match(table: DataFrame, source: Staged, keys: list[str], run_ts, put: Put, add_hash: bool = True, partitions: list[str] = ()) -> Upsert:
    """Phase one: the source against keys, hashes and places of the target's rows. ``source`` has the target's columns."""
    target, t, keys, some = _narrow(table, source.frame, keys, add_hash, partitions)
    s = source.frame.select(*[F.col(f"`{c}`").alias(f"s__{c}") for c in (*keys, *some)])
    if source.small():
        s = F.broadcast(s)
    j = t.join(s, [t[f"t__{k}"] == s[f"s__{k}"] for k in keys])
    changed = differs(table.columns, keys, add_hash, lambda c: F.col(f"`t__{c}`"), lambda c: F.col(f"`s__{c}`"))
    matched = _matched(j.withColumn("__differs", changed), "s__", keys, partitions)
    return Upsert(target, table.columns, source, put(matched, "matched"), keys, run_ts)


def stage_matched(table: DataFrame, source: DataFrame, keys: list[str], run_ts, put: Put, add_hash: bool = True, partitions: list[str] = ()) -> Upsert | None:
    """Phase one while the source is staged, where the target's narrow columns are few enough to be sent to its rows: of rows
    that change nothing only the keys are written. None where they are not. Keys are refused as in ``stage_checked``."""
    target, t, keys, _ = _narrow(table, source, keys, add_hash, partitions)
    few = broadcast_bounded(t)
    if few is t:
        return None
    watched, seen = observed(source, keys)
    j = watched.withColumn("__source_row", F.monotonically_increasing_id()).join(few, [F.col(f"`{k}`") == F.col(f"`t__{k}`") for k in keys], "left")
    changed = differs(table.columns, keys, add_hash, lambda c: F.col(f"`t__{c}`"), lambda c: F.col(f"`{c}`"))
    j = j.withColumn("__differs", F.when(F.col(FILE).isNotNull(), changed))
    told = [F.col(f"`{c}`") if c in keys else F.when(F.coalesce("__differs", F.lit(True)), F.col(f"`{c}`")).alias(c) for c in table.columns]
    out = put(j.select(*told, "__differs", "__source_row", FILE, ROW, "__insert_date", *[f"__old_{p}" for p in partitions]), "source")
    refuse_bad_keys(out, seen, keys, "__source_row")
    return MetUpsert(target, table.columns, Staged(out, seen.get["rows"], seen.get["bytes"]),
                     _matched(out.filter("__differs IS NOT NULL"), "", keys, partitions), keys, run_ts)
