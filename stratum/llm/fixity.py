"""WARC records with offsets, and a Merkle audit of replicas that descends only mismatching branches."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratum.llm.common import stage

FANOUT = 16
#: Records of one WARC file on average; the number of files is the next power of 16.
FILE_RECORDS = 1000
END = "\r\n\r\n"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of one WARC/1.1 resource record without its closing two line ends, as text."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")),
                    F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit(END), body)


def file_digits(n: int) -> int:
    """Hexadecimal digits in a file's name for ``n`` records."""
    d = 0
    while n > FILE_RECORDS * 16 ** d:
        d += 1
    return d


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position and byte offset of each record within (partition, file); rows come sorted by file."""
    part, now, at, pos = TaskContext.get().partitionId(), None, 0, 0
    for b in batches:
        if not b.num_rows:
            continue
        files = b.column("file").to_pylist()
        sizes = b.column("length").to_numpy(zero_copy_only=False)
        offset, number = np.empty(len(files), np.int64), np.empty(len(files), np.int64)
        for i, (f, n) in enumerate(zip(files, sizes)):
            if f != now:
                now, at, pos = f, 0, 0
            offset[i], number[i] = at, pos
            at, pos = at + n, pos + 1
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("page_id", "url", "file", "length", "sha256")),
                                          pa.array([part] * len(files), pa.int32()), pa.array(number), pa.array(offset)],
                                         names=["page_id", "url", "file", "length", "sha256", "part", "idx", "pos"])


def manifest(pages: DataFrame, digits: int | None = None) -> DataFrame:
    """One row per page: page_id, url (null as empty), file, idx (record number in the file), pos (byte offset), length,
    sha256 of the record.

    Files are named by leading digits of the MD5 of page_id and url (as many as given, or as fit the number of pages);
    records are ordered by page_id, url and hash. A file that holds very many records (repeated pages) is laid out over
    several tasks: offsets are summed within sorted partitions and moved by the preceding partitions' totals."""
    digits = file_digits(pages.count()) if digits is None else digits
    pid, url = F.col("page_id").cast("long"), F.coalesce(F.col("url").cast("string"), F.lit(""))
    rec = F.concat(record(pid, url, F.col("html")), F.lit(END))
    key = F.md5(F.concat_ws("|", F.coalesce(pid.cast("string"), F.lit("null")), url))
    rows = pages.select(pid.alias("page_id"), url.alias("url"), F.substring(key, 1, digits).alias("file"), F.octet_length(rec).cast("long").alias("length"),
                        F.sha2(rec, 256).alias("sha256"), F.monotonically_increasing_id().alias("tie"))
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("file"), F.col("page_id").asc_nulls_first(), F.col("url"), F.col("sha256"), F.col("tie")]
    local = stage(rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
                  .mapInArrow(_place, "page_id long, url string, file string, length long, sha256 string, part int, idx long, pos long"), "manifest")
    totals = local.groupBy("file", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"))
    w = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # at most one row per partition
    base = totals.select("file", "part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n0"), F.coalesce(F.sum("bytes").over(w), F.lit(0)).alias("b0"))
    return local.join(base, ["file", "part"]).select("page_id", "url", "file", (F.col("idx") + F.col("n0")).alias("idx"),
                                                     (F.col("pos") + F.col("b0")).alias("pos"), "length", "sha256")


def tree(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of each file's tree, leaves first: (file, idx, pos, length, hash). A node hashes its children's offset
    ranges and hashes in order; the last level has one node per file. Levels are staged, each ``fanout`` times smaller."""
    levels = [leaves.select("file", "idx", "pos", "length", "hash")]
    top = levels[0].agg(F.max("idx")).first()[0]
    while top:
        child = F.sort_array(F.collect_list(F.struct("idx", "pos", "length", "hash")))   # at most fanout of them
        joined = F.array_join(F.transform(child, lambda c: F.concat_ws(":", c["pos"], c["length"], c["hash"])), ",")
        up = levels[-1].groupBy("file", F.floor(F.col("idx") / fanout).cast("long").alias("up")) \
            .agg(F.min("pos").alias("pos"), F.sum("length").alias("length"), F.sha2(joined, 256).alias("hash")).withColumnRenamed("up", "idx")
        levels.append(stage(up, "tree"))
        top //= fanout
    return levels


def audit(left: list[DataFrame], right: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(file, idx) of the leaves that differ or that only one replica has: roots are compared first, then, level by
    level, only the children of mismatching nodes. Trees must have the same number of levels for their files' sizes;
    a shorter one is compared from its own top."""
    bad = None
    for level in range(max(len(left), len(right)) - 1, -1, -1):
        a, b = (t[min(level, len(t) - 1)] if level < len(t) else None for t in (left, right))
        if a is None or b is None:   # only one tree is this high: everything below is suspect
            bad = None
            continue
        pick = ["file", "idx", F.concat_ws(":", "pos", "length", "hash").alias("v")]
        a, b = a.select(*pick), b.select(*pick)
        if bad is not None:
            up = bad.select("file", F.col("idx").alias("up"))
            a, b = (x.withColumn("up", F.floor(F.col("idx") / fanout).cast("long")).join(up, ["file", "up"], "left_semi").drop("up") for x in (a, b))
        bad = a.withColumnRenamed("v", "va").join(b.withColumnRenamed("v", "vb"), ["file", "idx"], "full_outer") \
            .where(~F.col("va").eqNullSafe(F.col("vb"))).select("file", "idx")
        bad = stage(bad, "mismatch")
    return bad


def replica_report(pages: DataFrame, replica: DataFrame) -> DataFrame:
    """Per record of either table: page_id, url, file, pos, length, sha256 (null if only the replica has it), replica_pos,
    replica_length, replica_sha256 (null if only ``pages`` has it) and status: intact, displaced (the same bytes at other
    offsets or numbers), changed, missing (from the replica) or extra.

    Each table is laid out in files and hashed into trees by itself. Records of the leaves that the audit finds are matched
    by page_id, url and bytes, copies in order; what is left of a page_id and url is matched in order as changed. Null url
    or html are empty; null page_ids sort first; repeated pages are records of their own; other columns are ignored."""
    digits = file_digits(pages.count())
    a, b = (stage(manifest(x, digits), "leaves") for x in (pages, replica))
    bad = audit(*(tree(x.withColumnRenamed("sha256", "hash")) for x in (a, b)))
    place = ["pos", "length", "sha256"]
    name = ["file", "page_id", "url"]

    def match(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        left, right = (x.select(*(F.col(c).alias(side + c) for c in x.columns)) for side, x in (("l_", left), ("r_", right)))
        on = F.lit(True)
        for k in keys:
            on = on & F.col("l_" + k).eqNullSafe(F.col("r_" + k))
        return stage(left.join(right, on, "full_outer").select(
            *(F.when(F.col("l_idx").isNotNull(), F.col("l_" + k)).otherwise(F.col("r_" + k)).alias(k) for k in name),
            *(F.col("l_" + c).alias(c) for c in ("idx", *place)), *(F.col("r_" + c).alias("replica_" + c) for c in ("idx", *place))), "matched")

    def copies(x: DataFrame) -> DataFrame:
        """Suspect records, the copies of each numbered: they follow each other in their file."""
        some = stage(x.join(bad, ["file", "idx"], "left_semi"), "suspects")
        first = some.groupBy(*name, "sha256").agg(F.min("idx").alias("first")).toDF("f", "p", "u", "s", "first")
        return some.join(first, (F.col("file") == F.col("f")) & F.col("page_id").eqNullSafe(F.col("p")) & (F.col("url") == F.col("u")) & (F.col("sha256") == F.col("s"))) \
            .select(*name, "idx", *place, (F.col("idx") - F.col("first")).alias("copy"))

    def rest(x: DataFrame, prefix: str) -> DataFrame:
        """Suspect records without an equal one on the other side, those of a page_id and url numbered."""
        w = Window.partitionBy(*name).orderBy("idx")
        return x.select(*name, *(F.col(prefix + c).alias(c) for c in ("idx", *place))).withColumn("number", F.row_number().over(w))

    equal = match(copies(a), copies(b), [*name, "sha256", "copy"])
    one, other = F.col("idx").isNotNull(), F.col("replica_idx").isNotNull()
    unequal = match(rest(equal.where(~other), ""), rest(equal.where(~one), "replica_"), [*name, "number"])
    found = equal.where(one & other).withColumn("status", F.lit("displaced")).unionByName(unequal.withColumn(
        "status", F.when(~other, "missing").when(~one, "extra").otherwise("changed")))
    out = [*name, *place, *("replica_" + c for c in place), "status"]
    sound = a.join(bad, ["file", "idx"], "left_anti").withColumns({"replica_" + c: F.col(c) for c in place}).withColumn("status", F.lit("intact"))
    return sound.select(out).unionByName(found.select(out))


def fixity_report(pages: DataFrame, replica: DataFrame | Column) -> DataFrame:
    """Per page: page_id, file, pos, length, sha256, intact (the replica has the same bytes), replica_sha256 (only where the
    audit located other bytes). A Column stands for a replica of the same pages with this html. See ``replica_report``,
    which also has the records that only the replica has; an empty table gives an empty result."""
    if isinstance(replica, Column):
        replica = pages.withColumn("html", replica)
    return replica_report(pages, replica).where("status != 'extra'").select(
        "page_id", "file", "pos", "length", "sha256", F.col("status").isin("intact", "displaced").alias("intact"),
        F.when(F.col("status") == "changed", F.col("replica_sha256")).alias("replica_sha256"))


def write_warc(pages: DataFrame, path: str) -> None:
    """WARC files under ``path``, one folder per file name; Spark's text writer closes each record with two line ends."""
    digits = file_digits(pages.count())
    pid, url = F.col("page_id").cast("long"), F.col("url").cast("string")
    key = F.md5(F.concat_ws("|", F.coalesce(pid.cast("string"), F.lit("null")), F.coalesce(url, F.lit(""))))
    rows = pages.select(F.concat(F.lit("f"), F.substring(key, 1, digits)).alias("file"), pid.alias("p"), F.coalesce(url, F.lit("")).alias("u"), record(pid, url, F.col("html")).alias("value"))
    rows.repartitionByRange(F.col("file"), F.col("p"), F.col("u"), F.col("value")).sortWithinPartitions("file", "p", "u") \
        .select("file", "value").write.partitionBy("file").option("lineSep", END).text(path)
