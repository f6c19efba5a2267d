"""Secret scans: Boolean trigram queries derived from each rule's regex, an inverted index over those trigrams, and
verification of the candidates. Everything on the data runs as DataFrame expressions."""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_parse = re._parser.parse   # the regex syntax tree of the standard library
#: More alternatives than this of one stretch are not followed; the stretch then demands nothing.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` with one group for the value (group 0 if ``group`` is 0), which must have ``least`` characters."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base rules, then the rules that the index adds.
BASE = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
]
MORE = [
    Rule("pem", r"-----BEGIN(?:\x20[A-Z]+)*\x20PRIVATE\x20KEY-----"),
    Rule("github", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"(?:sk|rk)_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
]
RULES = BASE + MORE


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """A conjunction of disjunctions of trigram sets that every match of ``pattern`` satisfies, over lower-cased trigrams.
    Empty if the pattern has no mandatory trigram."""
    needs: list[list[frozenset[str]]] = []

    def close(strings: set[str]):
        grams = [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings]
        if grams and all(grams):   # an alternative that asks for more than another one is implied by it
            needs.append(sorted({g for g in grams if not any(o < g for o in grams)}, key=sorted))

    def strings_of(node) -> set[str] | None:
        """The finite set of strings of a node, or None."""
        op, arg = node
        name = str(op)
        if name == "LITERAL":
            return {chr(arg).lower()}
        if name == "IN":
            out = set()
            for o, a in arg:
                if str(o) == "LITERAL":
                    out.add(chr(a).lower())
                elif str(o) == "RANGE" and a[1] - a[0] < 8:
                    out |= {chr(c).lower() for c in range(a[0], a[1] + 1)}
                else:
                    return None
            return out if len(out) <= 8 else None
        if name == "SUBPATTERN":
            return all_of(arg[-1])
        if name == "BRANCH":
            parts = [all_of(b) for b in arg[1]]
            return None if any(p is None for p in parts) else set().union(*parts)
        if name == "MAX_REPEAT" and arg[1] != re._constants.MAXREPEAT and arg[1] <= 2:
            one = all_of(arg[2])
            return None if one is None else set().union(*[product([one] * k) for k in range(arg[0], arg[1] + 1)])
        return None

    def product(parts: list[set[str]]) -> set[str]:
        out = {""}
        for p in parts:
            out = {a + b for a in out for b in p}
        return out

    def all_of(seq) -> set[str] | None:
        out = {""}
        for node in seq:
            s = strings_of(node)
            if s is None or len(out) * len(s) > MAX_STRINGS:
                return None
            out = {a + b for a in out for b in s}
        return out

    run = {""}
    for node in _parse(pattern):
        s = strings_of(node)
        if s is None or len(run) * len(s) > MAX_STRINGS:
            close(run)
            run = {""} if s is None else s
        else:
            run = {a + b for a in run for b in s}
    close(run)
    return needs


def _sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans(text: str, rule: Rule) -> str:
    """SQL for the rule's spans in column ``text``: array of (start, kind rank, kind, end), by code points, end exclusive.

    The texts between the matches and the matches themselves give the positions; a match whose value is too short is
    dropped after it has been consumed."""
    p, rank = _sql(rule.pattern), RULES.index(rule)
    item = "struct<start:int,rank:int,kind:string,stop:int>"
    return f"""aggregate(
      filter(arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), regexp_extract_all({text}, {p}, {rule.group})), z -> z.`1` IS NOT NULL),
      named_struct('pos', 0, 'found', CAST(array() AS array<{item}>)),
      (a, z) -> named_struct('pos', a.pos + length(z.`0`) + length(z.`1`),
        'found', IF(length(z.`2`) >= {rule.least}, concat(a.found, array(named_struct('start', a.pos + length(z.`0`), 'rank', {rank},
            'kind', '{rule.kind}', 'stop', a.pos + length(z.`0`) + length(z.`1`)))), a.found)),
      a -> a.found)"""


def _queries(rules: list[Rule]) -> tuple[dict[str, list[list[frozenset[str]]]], list[str]]:
    q = {r.kind: trigram_query(r.pattern) for r in rules}
    return q, sorted({g for needs in q.values() for alts in needs for grams in alts for g in grams})


def postings(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    """The inverted index over the trigrams that the rules ask for: (gram, row keys). ``rows`` has the key columns and text."""
    grams = F.array(*[F.lit(g) for g in vocabulary])
    lower = F.lower("text")
    keys = [c for c in rows.columns if c != "text"]
    return rows.select(*keys, lower.alias("low")).select(*keys, F.explode(F.filter(grams, lambda g: F.contains(F.col("low"), g))).alias("gram"))


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """(row keys, kinds): the rules whose trigram query a row's postings satisfy. Postings are intersected by counting,
    for each conjunct's alternatives, how many of the alternative's trigrams the row has."""
    queries, _ = _queries(rules)
    keys = [c for c in index.columns if c != "gram"]
    terms = [(kind, i, j, len(alt), g) for kind, needs in queries.items() for i, alts in enumerate(needs)
             for j, alt in enumerate(alts) for g in alt]
    sizes = {kind: len(needs) for kind, needs in queries.items()}
    by_gram: dict[str, list[Column]] = {}
    for kind, i, j, size, g in terms:
        by_gram.setdefault(g, []).append(F.struct(F.lit(kind).alias("kind"), F.lit(i).alias("part"), F.lit(j).alias("alt"), F.lit(size).alias("size")))
    if not by_gram:
        return index.select(*keys, F.array().cast("array<string>").alias("kinds")).limit(0)
    which = F.create_map(*[x for g, uses in sorted(by_gram.items()) for x in (F.lit(g), F.array(*uses))])
    uses = index.select(*keys, F.explode(F.element_at(which, F.col("gram"))).alias("u")).select(*keys, "u.*")
    full = uses.groupBy(*keys, "kind", "part", "alt", "size").agg(F.count(F.lit(1)).alias("n")).where("n = size")
    need = F.create_map(*[x for k, n in sorted(sizes.items()) for x in (F.lit(k), F.lit(n))])
    met = full.groupBy(*keys, "kind").agg(F.count_distinct("part").alias("parts")).where(F.col("parts") == F.element_at(need, F.col("kind")))
    return met.groupBy(*keys).agg(F.collect_set("kind").alias("kinds"))


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Per row of ``docs``: doc_id, found (array of start, rank, kind, stop; by start, then kind as listed).

    Rules with mandatory trigrams are verified only in rows whose postings satisfy their query; the others scan every
    row. A null text is empty and has no spans; repeated rows and null ids give one row each; other columns are
    ignored. Key words match in either case of ASCII letters."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    keyed = rows.select(F.xxhash64("text").alias("text_hash"), F.length("text").alias("text_size"), "text")
    queries, vocabulary = _queries(rules)
    # candidates by content, so that copies share their postings; a clash of two texts only adds a candidate
    index = postings(keyed, vocabulary).distinct()
    kinds = candidates(index, rules).withColumnsRenamed({"text_hash": "ch", "text_size": "cn"})
    joined = rows.join(kinds, (F.xxhash64("text") == F.col("ch")) & (F.length("text") == F.col("cn")), "left")
    empty = "CAST(array() AS array<struct<start:int,rank:int,kind:string,stop:int>>)"
    parts = []
    for r in rules:
        # a rule without mandatory trigrams scans fully; a cheap test first avoids building empty lists
        test = f"array_contains(kinds, '{r.kind}')" if queries[r.kind] else f"rlike(text, {_sql(f'(?:{r.pattern}){{1}}' if r.least <= 1 else _at_least(r))})"
        parts.append(f"CASE WHEN {test} THEN {spans('text', r)} ELSE {empty} END")
    return joined.select("doc_id", F.expr(f"array_sort(concat({', '.join(parts)}))").alias("found"))


def _at_least(rule: Rule) -> str:
    """A pattern that every kept match of a plain ``[...]+`` rule contains: ``least`` characters of its class."""
    m = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return f"{m[1]}{{{rule.least}}}" if m and rule.group == 0 else rule.pattern


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_more from ``find_secrets``' rows."""
    def joined(col: str, where: str) -> str:
        return f"array_join(transform(filter({col}, s -> {where}), s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')"
    counts = [F.expr(f"CAST(size(filter(found, s -> s.kind = '{r.kind}')) AS BIGINT)").alias(f"n_{r.kind}") for r in BASE]
    return found.select("doc_id", *counts, F.sha2(F.expr(joined("found", f"s.rank < {len(BASE)}")), 256).alias("base_sha256"),
                        F.expr(joined("found", "true")).alias("spans"),
                        F.expr(f"CAST(size(filter(found, s -> s.rank >= {len(BASE)})) AS BIGINT)").alias("n_more"))
