"""Connected components of an edge table, and groups of nodes that share buckets."""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratum.llm.common import stage


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``edges``: (a, b) long, any order, self-loops and repeats allowed. Returns (node, component) for every
    linked node but the smallest of each component, which is ``component`` itself.

    Each round is two aggregated joins over the edge table; edges stay distributed and each round is staged. The edge
    count never grows. An empty edge table gives an empty result. Raises if ``rounds`` rounds do not suffice
    (they do for components of up to about 2^rounds nodes)."""
    e = stage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _signature(e)
    if not before[0]:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(rounds):
        # large star: every larger neighbour of u is linked to the smallest node of u's neighbourhood
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: every smaller neighbour of u, and u itself, is linked to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(low, "a")
        small = near.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        e = stage(small, "edges")
        after = _signature(e)
        if after == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = after
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, component) after further links between the components ``ca`` and ``cb``: only components that
    these touch are gone through again, each pair of them once."""
    over = connected(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    moved = comp.join(over.toDF("component", "onto"), "component", "left").select("node", F.coalesce("onto", "component").alias("component"))
    return stage(moved.unionByName(over), "components")


PAIR = "a long, b long, ca long, cb long"
#: Rounds of pivots; whatever buckets are mixed after them is compared in full.
PIVOT_ROUNDS = 2
#: Nodes outside a bucket's largest component that are compared in one portion; larger buckets are cut into portions.
PORTION = 2000
#: Rounds in which a node outside its bucket's largest component proposes one link, before all pairs that are left are compared.
LINK_ROUNDS = 3


def _not_alone(batches):
    """From rows sorted by (bucket, node): the rows of buckets with several rows, and those at the partition's ends, whose
    bucket may go on in a neighbouring partition. One row is held back to see whether its successor shares its bucket."""
    first, last = True, None
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, node = (batch.column(i).to_numpy() for i in (0, 1))
        if last is not None:
            bucket, node = np.concatenate([last[0], bucket]), np.concatenate([last[1], node])
        same = bucket[1:] == bucket[:-1]
        keep = np.zeros(len(bucket), bool)
        keep[1:] |= same
        keep[:-1] |= same
        if last is not None:
            keep[0] |= last[2]
        if first:
            keep |= bucket == bucket[0]
            first = False
        yield pa.RecordBatch.from_arrays([pa.array(bucket[:-1][keep[:-1]]), pa.array(node[:-1][keep[:-1]])], names=["bucket", "node"])
        last = bucket[-1:].copy(), node[-1:].copy(), bool(keep[-1])
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array(last[0]), pa.array(last[1])], names=["bucket", "node"])


def shared_buckets(member: DataFrame) -> DataFrame:
    """From (bucket long, node long) the rows of buckets with at least two nodes, with ``hub``, the bucket's smallest node.

    One range shuffle on (bucket, node), so that even a bucket with very many nodes is cut over several tasks; only
    rows that share a bucket go on to the join."""
    n = int(member.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = member.select("bucket", "node").repartitionByRange(n, "bucket", "node").sortWithinPartitions("bucket", "node")
    some = stage(rows.mapInArrow(_not_alone, "bucket long, node long"), "buckets").distinct()
    hubs = some.groupBy("bucket").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "hub")
    return stage(some.join(hubs, "bucket"), "shared")


def _cell_pairs(rows: pa.Table, alike: Callable[[np.ndarray, np.ndarray], np.ndarray], one: bool) -> tuple[list, list, list, list]:
    """Pairs (with their components) of one cell's sides 0 and 1 in different components whose sketches are alike: ``one`` for
    each node of side 0, the one most alike, or all, each in its first common bucket."""
    side, bucket, node, comp = (rows.column(c).to_numpy() for c in ("side", "bucket", "node", "component"))
    nx = int(np.searchsorted(side, 1))
    if not nx or nx == len(side):
        return [], [], [], []
    sketch = rows.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(side), -1)
    main = rows.column("main").to_numpy(zero_copy_only=False)
    lists = rows.column("buckets")
    sets: dict[int, set] = {}

    def of(i: int) -> set:
        if i not in sets:
            sets[i] = set(lists[i].as_py())
        return sets[i]
    a, b, ca, cb = [], [], [], []
    for i in range(0, nx, 16):
        j = min(nx, i + 16)
        ok = comp[i:j, None] != comp[None, nx:]
        if not one:
            ok &= main[None, nx:] | (node[i:j, None] < node[None, nx:])
        ok = ok * alike(sketch[i:j], sketch[nx:])
        some = np.stack([np.flatnonzero(ok.any(1)), ok.argmax(1)[ok.any(1)]], 1) if one else np.argwhere(ok)
        for p, q in some.tolist():
            if one or min(of(i + p) & of(nx + q)) == bucket[i + p]:
                a.append(node[i + p])
                b.append(node[nx + q])
                ca.append(comp[i + p])
                cb.append(comp[nx + q])
    return a, b, ca, cb


def _cells(batches, alike, one):
    """Pairs of rows sorted by (cell, side). A cell is held whole: at most some portions of PORTION rows."""
    held: list[pa.Table] = []

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in _cell_pairs(pa.concat_tables(held), alike, one)], names=["a", "b", "ca", "cb"])
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), len(cell)]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and held[0].column(0)[0].as_py() != cell[lo]:
                yield done()
                held.clear()
            held.append(pa.Table.from_batches([batch.slice(lo, hi - lo)]))
    if held:
        yield done()


def group_by_buckets(shared: DataFrame, sketch: DataFrame, passes: Callable[[Column, Column], Column],
                     confirm: Callable[[DataFrame], DataFrame], refine: Callable[[DataFrame], DataFrame],
                     alike: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(node, component) of the links among nodes that share a bucket. ``sketch``: (node, sketch); two nodes are compared
    if ``passes`` holds for their sketches; ``confirm`` returns the linked ones of the pairs (a, b, and their components ca, cb) it gets. ``refine``
    makes finer sketches (node, sketch array<long>) of some nodes (node), and ``alike`` compares two blocks of them: 0 for
    pairs that cannot be linked, and more the more alike they are.

    Every node is compared with the smallest of its buckets' hubs first, then, in rounds, with one pivot of a bucket in which
    its component is not the pivot's. Buckets whose nodes are then in one component are done. In the others every node outside the
    bucket's largest component is compared with all nodes of other components, once a pair, by the finer sketches. So no
    candidate is left out however large a bucket is, and a large group of near copies takes a few comparisons a node."""
    def near(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sketch.toDF("a", "sa"), "a").join(sketch.toDF("b", "sb"), "b")
        return stage(confirm(both.where(passes(F.col("sa"), F.col("sb"))).select("a", "b", "ca", "cb")), "links")

    def placed(comp: DataFrame) -> DataFrame:
        return shared.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))

    spokes = shared.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    first = spokes.groupBy("b").agg(F.min("a").alias("a")).select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb"))
    comp = connected(near(first).select("a", "b"))
    for _ in range(PIVOT_ROUNDS):
        # one pivot a bucket, and of a node's buckets with a pivot in another component one: at most a pair a node and round
        rows = placed(comp)
        pivots = rows.groupBy("bucket").agg(F.min_by(F.struct(F.col("node").alias("p"), F.col("component").alias("c")), F.xxhash64("node", "component")).alias("v"),
                                            F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("bucket", "v.*")
        pairs = rows.join(pivots, "bucket").where("component != c").groupBy("node").agg(F.min(F.struct("p", "c", "component")).alias("v"))
        more = near(pairs.select(F.col("v.p").alias("a"), F.col("node").alias("b"), F.col("v.c").alias("ca"), F.col("v.component").alias("cb")))
        if more.isEmpty():
            break
        comp = joined(comp, more)
    # buckets of several components: the largest one's nodes are compared with the others only, in cells of bounded size. In
    # the first rounds a node proposes one link in one of its buckets, to the node most like it, which joins most components; then all pairs left meet
    portions = lambda n: F.ceil(n / PORTION).cast("int")
    n, fine = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions")), None
    for k in range(LINK_ROUNDS + 1):
        one, rows = k < LINK_ROUNDS, placed(comp)
        several = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket") \
            .agg(F.max_by("component", F.struct("n", "component")).alias("top"), F.count(F.lit(1)).alias("parts"),
                 portions(F.sum("n") - F.max("n")).alias("px"), portions(F.sum("n")).alias("py")).where("parts > 1")
        open_ = stage(rows.join(several, "bucket").select("bucket", "node", "component", (F.col("component") == F.col("top")).alias("main"), "px", "py"), "unresolved")
        if open_.isEmpty():
            break
        if fine is None:   # nodes that are open later are open now
            fine = stage(refine(open_.select("node").distinct()), "fine")
        own = open_.groupBy("node").agg(F.collect_list("bucket").alias("buckets")).join(fine.toDF("node", "sketch"), "node")
        asking = open_.where("NOT main")
        if one:
            asking = asking.groupBy("node").agg(F.min_by(F.struct("bucket", "component", "main", "px", "py"), F.xxhash64("bucket", "node", F.lit(k))).alias("v")).select("node", "v.*")
        cells = _dealt(0, asking, "px", "py").unionByName(_dealt(1, open_, "py", "px")).join(own, "node") \
            .select("cell", "side", "bucket", "node", "component", "main", "sketch", "buckets").repartition(n, "cell").sortWithinPartitions("cell", "side")
        more = stage(confirm(cells.mapInArrow(lambda it, one=one: _cells(it, alike, one), PAIR).distinct()), "links")
        if not more.isEmpty():
            comp = joined(comp, more)
    return comp


def _dealt(k: int, rows: DataFrame, mine: str, other: str) -> DataFrame:
    """Rows of side ``k`` in their own portion, against every portion of the other side."""
    part = F.pmod(F.xxhash64("node"), F.col(mine)).cast("int")
    dealt = rows.withColumn("own", part).withColumn("met", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
    px, py = ("own", "met") if k == 0 else ("met", "own")
    return dealt.select(F.xxhash64("bucket", px, py).alias("cell"), F.lit(k).alias("side"), "bucket", "node", "component", "main")
