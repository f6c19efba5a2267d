"""A small star model (A21, C6, C7, D4, D5): tables, many-to-one relationships (active or inactive),
role selection per measure, the blank member, and "+0" zero rows.

Evaluation follows the report semantics: a dimension filter reaches the fact, never the reverse;
picking an inactive role switches off the active relationship between the same two tables; fact rows
whose key has no dimension row fall into a blank member (all dimension attributes NULL); with
``zero_fill`` every (filtered) dimension member gets a row.

Facts are aggregated by their foreign keys before any join, so joins see one row per tuple of keys."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.operators.joins import broadcast_bounded


@dataclass(frozen=True)
class Relationship:
    from_table: str
    from_col: str
    to_table: str
    to_col: str
    active: bool = True


@dataclass(frozen=True)
class Measure:
    """COUNTROWS of a fact, or DISTINCTCOUNT of the column ``distinct`` (NULL counts as one value). ``roles`` names, by
    dimension, the fact column of an inactive relationship to use in place of the active one (USERELATIONSHIP)."""
    name: str
    roles: dict[str, str] = field(default_factory=dict)
    where: Column | None = None
    distinct: str | None = None


@dataclass
class StarModel:
    tables: dict[str, DataFrame]
    relationships: list[Relationship] = field(default_factory=list)
    dim_max_rows: int = 2_000_000

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    def relationship(self, fact: str, dim: str, from_col: str | None = None) -> Relationship:
        """The active fact->dim relationship, or the (inactive) one on ``from_col`` (USERELATIONSHIP)."""
        cands = [r for r in self.relationships if r.from_table == fact and r.to_table == dim]
        if from_col is not None:
            cands = [r for r in cands if r.from_col == from_col]
        else:
            cands = [r for r in cands if r.active]
        if len(cands) != 1:
            raise KeyError(f"no unique relationship {fact}->{dim} on {from_col or 'active role'}")
        return cands[0]

    # -- measure evaluation -------------------------------------------------
    def summarize(self, fact: str, by: list[tuple[str, str]], measures: list[Measure], where: dict[str, Column] | None = None,
                  fact_filter: Column | None = None, zero_fill: bool = False, extra: list[str] = ()) -> DataFrame:
        """Measures of one fact by attributes of any of its dimensions, under filters on any of them.

        ``by`` lists (dimension, attribute); ``where`` has a condition per dimension; ``extra`` are columns of the fact. The
        filters reach the fact along the relationship that each measure uses, so one filter may act through different keys
        for different measures. All measures come out of one scan: a fact row becomes one row per measure that counts it,
        with that measure's keys, and rows are counted per measure and tuple of keys before any dimension is joined."""
        where = where or {}
        dims = list(dict.fromkeys([d for d, _ in by] + list(where)))
        attributes = [a for _, a in by]
        if len(set(attributes)) < len(attributes):
            raise ValueError(f"attributes of one name in several dimensions: {attributes}")
        if zero_fill and (len({d for d, _ in by}) != 1 or extra):
            raise ValueError("zero rows are those of one dimension's members")
        f = self.tables[fact]
        if fact_filter is not None:
            f = f.filter(fact_filter)
        parts = []
        for distinct in dict.fromkeys(m.distinct for m in measures):   # counts, then each member column that is counted
            some = [(i, m) for i, m in enumerate(measures) if m.distinct == distinct]
            per = self._per_keys(f, fact, dims, some, distinct, list(extra))
            for j, d in enumerate(dims):
                per = self._reach(per, j, d, [a for dim, a in by if dim == d], where.get(d))
            group = [*attributes, *extra]
            if distinct is None:
                parts.append(per.groupBy(*group).agg(*[self._count(i, some).alias(m.name) for i, m in some]))
            else:
                one = per.groupBy(*group, "__m").agg((F.countDistinct("__member") + F.max(F.col("__member").isNull().cast("int"))).alias("__v"))
                parts.append(one.groupBy(*group).agg(*[F.max(F.when(F.col("__m") == i, F.col("__v"))).alias(m.name) for i, m in some]))
        group, names = [*attributes, *extra], [m.name for m in measures]
        if zero_fill:
            # +0: every member of the filtered dimension, zero where it has no rows. A union with zero rows and one
            # aggregate (NULL attributes group with the blank member) instead of a full outer join.
            dim = self.tables[by[0][0]]
            dim = dim.filter(where[by[0][0]]) if by[0][0] in where else dim
            parts.append(dim.select(*attributes).distinct().select(*attributes, *[F.lit(0).cast("long").alias(n) for n in names]))
        if len(parts) == 1:
            out = parts[0].select(*group, *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in names])
        else:
            filled = [p.select(*group, *[(F.coalesce(F.col(n), F.lit(0)) if n in p.columns else F.lit(0)).cast("long").alias(n) for n in names]) for p in parts]
            out = filled[0]
            for p in filled[1:]:
                out = out.unionByName(p)
            out = out.groupBy(*group).agg(*[F.sum(n).cast("long").alias(n) for n in names])
        if zero_fill:
            return out
        some_rows = F.lit(False)
        for n in names:
            some_rows = some_rows | (F.col(n) > 0)
        return out.filter(some_rows)

    @staticmethod
    def _count(i: int, some: list) -> Column:
        return F.sum("__n") if len(some) == 1 else F.sum(F.when(F.col("__m") == i, F.col("__n")))

    def _per_keys(self, f: DataFrame, fact: str, dims: list[str], some: list, distinct: str | None, extra: list[str]) -> DataFrame:
        """Rows per measure, dimension keys (and member): __m, __k0.., __n or __member."""
        def keys(m):
            out = []
            for j, d in enumerate(dims):
                rel = self.relationship(fact, d, m.roles.get(d))
                # a key that the dimension's type cannot hold belongs to no member
                out.append(F.col(rel.from_col).try_cast(self.tables[d].schema[rel.to_col].dataType).alias(f"__k{j}"))
            return out
        names = [f"__k{j}" for j in range(len(dims))]
        member = [F.col(distinct).alias("__member")] if distinct else []
        if len(some) == 1:
            i, m = some[0]
            rows = (f if m.where is None else f.filter(m.where)).select(F.lit(i).alias("__m"), *keys(m), *member, *extra)
        else:
            each = [F.struct(F.lit(i).alias("__m"), *keys(m)) for i, m in some]
            each = [e if m.where is None else F.when(m.where, e) for e, (_, m) in zip(each, some)]
            rows = f.select(F.explode(F.array(*each)).alias("__e"), *member, *extra).filter("__e IS NOT NULL") \
                    .select("__e.*", *(["__member"] if distinct else []), *extra)
        if distinct:
            return rows.distinct()
        return rows.groupBy("__m", *names, *extra).agg(F.count(F.lit(1)).alias("__n"))

    def _reach(self, per: DataFrame, j: int, dim: str, attributes: list[str], condition: Column | None) -> DataFrame:
        """Attributes of one dimension for its keys; under a filter only keys of remaining members stay, otherwise unknown
        keys have the blank member."""
        to_col = next(r.to_col for r in self.relationships if r.to_table == dim)
        d = self.tables[dim]
        if condition is not None:
            d = d.filter(condition)
        d = broadcast_bounded(d.select(F.col(to_col).alias("__dkey"), *attributes).distinct(), self.dim_max_rows)
        return per.join(d, per[f"__k{j}"] == d["__dkey"], "inner" if condition is not None else "left").drop(f"__k{j}", "__dkey")

    def count_rows(self, fact: str, dim: str, by: list[str], out: str, role: str | None = None,
                   fact_filter: Column | None = None, dim_filter: Column | None = None,
                   zero_fill: bool = True, extra_keys: list[str] | None = None, where: dict[str, Column] | None = None) -> DataFrame:
        """COUNTROWS(fact) grouped by dimension attributes ``by`` (+ optional fact columns)."""
        extra = extra_keys or []
        return self.summarize(fact, [(dim, a) for a in by], [Measure(out, {dim: role} if role else {})],
                              {**(where or {}), **({dim: dim_filter} if dim_filter is not None else {})}, fact_filter, zero_fill and not extra, extra)

    def distinct_count(self, fact: str, dim: str, by: list[str], member: str, out: str, role: str | None = None,
                       fact_filter: Column | None = None, dim_filter: Column | None = None,
                       zero_fill: bool = False) -> DataFrame:
        """DISTINCTCOUNT(member): a NULL member counts as one value."""
        return self.summarize(fact, [(dim, a) for a in by], [Measure(out, {dim: role} if role else {}, distinct=member)],
                              {dim: dim_filter} if dim_filter is not None else {}, fact_filter, zero_fill)
