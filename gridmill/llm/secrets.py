"""Secret scans through a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression. From its parse tree follow the substrings that
any match must hold, and from those a Boolean query: branches (OR) of trigram
sets (AND), letters lowered. The index lists, for every trigram that some rule
asks for, the documents that hold it; intersecting the postings of a branch gives
candidates, and only candidates are verified by the expression. A rule without
mandatory trigrams (a bare run of hexadecimal digits) is verified everywhere.

Postings are grouped by document and branch, never by trigram, so that a trigram
that stands in every document makes no large group. A bitmap of fixed size says
which documents may be candidates; only their texts are shuffled to meet their
rules. Where a corpus has far more candidates than the bitmap has places, more
texts are shuffled, with the same result.

Defined cases: a null text is empty; a null id is an id like any other; repeated
rows (same id and text) are handled alike, each row gets its result; an empty
table gives an empty result; only the id and the text are read.
"""

from __future__ import annotations

import re
import re._parser as rx
from functools import reduce
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.llm.common import keep, scratch, table, text_hash

MAX_BRANCHES = 64
#: Places of the bitmap of candidates: 2 MB, in rows of 4 KB.
LOG_BITS = 24
#: Matches of a text are placed in chunks of so many.
CHUNK = 256


class Rule(NamedTuple):
    """``group`` of a match must have ``least`` characters; base rules are counted each."""

    kind: str
    pattern: str
    group: int
    least: int
    base: bool


# The rules. The first three are the base, in the order that ties follow.
RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27, False),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]+", 0, 40, False),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15, False),
    Rule("payment", r"[rs]k_(live|test)_[A-Za-z0-9]+", 0, 32, False),
    Rule("signed", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30, False),
    Rule("bearer", r"[Bb]earer\x20+[A-Za-z0-9._~+/=-]+", 0, 24, False),
)


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The branches of a pattern; an empty list if it has no mandatory trigrams."""
    clauses: list[list[frozenset[str]]] = []

    def close(exact: set[str]) -> None:
        branches = [_trigrams(x) for x in exact]
        if all(branches):
            clauses.append(branches)

    def letters(node) -> set[str] | None:
        """The few strings that a node can be, or None if they are many."""
        op, value = node
        if op is rx.LITERAL:
            return {chr(value).lower()}
        if op is rx.IN and all(kind is rx.LITERAL for kind, _ in value):
            return {chr(c).lower() for _, c in value}
        if op is rx.SUBPATTERN:
            return whole(value[-1])
        if op is rx.BRANCH:
            each = [whole(x) for x in value[1]]
            return None if None in each else set().union(*each)
        if op is rx.MAX_REPEAT and value[:2] == (0, 1):
            inner = whole(value[2])
            return None if inner is None else inner | {""}
        return None

    def whole(nodes) -> set[str] | None:
        out = {""}
        for node in nodes:
            more = letters(node)
            if more is None or len(out) * len(more) > MAX_BRANCHES:
                return None
            out = {a + b for a in out for b in more}
        return out

    def walk(nodes) -> None:
        exact = {""}
        for node in nodes:
            more = letters(node)
            if more is not None and len(exact) * len(more) <= MAX_BRANCHES:
                exact = {a + b for a in exact for b in more}
                continue
            close(exact)
            exact = {""}
            op, value = node
            if op is rx.SUBPATTERN:
                walk(value[-1])
            elif op is rx.MAX_REPEAT and value[0] >= 1:
                walk(value[2])
        close(exact)

    walk(rx.parse(pattern))
    if not clauses:
        return []
    joined = {frozenset()}
    for branches in sorted(clauses, key=len):
        if len(joined) * len(branches) > MAX_BRANCHES:
            break
        joined = {a | b for a, b in product(joined, branches)}
    return sorted((b for b in joined if not any(a < b for a in joined)), key=sorted)  # what holds b holds a


def trigram_index(docs: DataFrame, trigrams: list[str], keys: list[str], text: str = "text") -> DataFrame:
    """(keys..., trigram): the postings of the given trigrams."""
    low = docs.select(*keys, F.lower(text).alias("_low"))
    held = F.filter(F.array(*[F.when(F.contains(F.col("_low"), F.lit(t)), F.lit(t)) for t in trigrams]), lambda x: x.isNotNull())
    return low.select(*keys, F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...], keys: list[str]) -> DataFrame:
    """(keys..., kinds): for each document, the indexed rules that may match in it."""
    asked = [(r.kind, b, t, len(branch)) for r in rules for b, branch in enumerate(trigram_query(r.pattern)) for t in sorted(branch)]
    queries = index.sparkSession.createDataFrame(asked, "kind string, branch int, trigram string, needed int")
    # As many rows as the rules have trigrams, whatever the corpus: bounded by MAX_BRANCHES a rule.
    met = index.distinct().join(F.broadcast(queries), "trigram").groupBy(*keys, "kind", "branch").agg(F.count("*").alias("found"), F.first("needed").alias("needed"))
    return met.where("found = needed").groupBy(*keys).agg(F.collect_set("kind").alias("kinds"))


def may_be_candidates(rows: DataFrame, hits: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``_maybe``: true for all rows whose keys are in ``hits``, and for some
    others. What is broadcast has 2**LOG_BITS bits, whatever the number of candidates."""
    place = (F.xxhash64(*keys).bitwiseAND(F.lit((1 << LOG_BITS) - 1)) + 1).alias("_place")
    bits = hits.select(place).groupBy(F.expr("bitmap_bucket_number(_place)").alias("_bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_place))").alias("_bits"))
    byte = F.expr("CAST(conv(hex(substring(_bits, CAST(bitmap_bit_position(_place) DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)")
    bit = F.expr("CAST(bitmap_bit_position(_place) % 8 AS INT)")
    joined = rows.select("*", place).join(F.broadcast(bits), F.expr("bitmap_bucket_number(_place)") == F.col("_bucket"), "left")
    return joined.select(*rows.columns, F.coalesce(F.call_function("getbit", byte, bit) == 1, F.lit(False)).alias("_maybe"))


def _strict(rule: Rule) -> str:
    """The pattern, or for a bare run of one class the runs that are long enough: all its
    matches that count, without the many short ones."""
    return f"{rule.pattern[:-1]}{{{rule.least},}}" if re.fullmatch(r"\[[^\]]+\]\+", rule.pattern) else rule.pattern


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Spans of the rule's matches, in code points: what lies between matches gives their
    places. They are added up in chunks, since an array is copied when it grows."""
    pattern = _strict(rule)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group))
    between = F.split(text, pattern, -1)
    steps = F.zip_with(F.slice(between, F.lit(1), F.size(matches)), F.arrays_zip(matches.alias("all"), measured.alias("part")), lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["all"]).alias("size"), F.length(m["part"]).alias("part")))
    none = F.array().cast("array<struct<start:int,rule:int,end:int,part:int>>")

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        one = F.struct(begin.alias("start"), F.lit(number).alias("rule"), (begin + x["size"]).alias("end"), x["part"].alias("part"))
        return F.struct((begin + x["size"]).alias("at"), F.array_append(acc["out"], one).alias("out"))

    def add_chunk(acc: Column, x: Column) -> Column:
        done = F.aggregate(x, F.struct(acc["at"].alias("at"), none.alias("out")), add)
        return F.struct(done["at"].alias("at"), F.array_append(acc["out"], done["out"]).alias("out"))

    chunks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(steps) - 1) / CHUNK).cast("int"))), lambda i: F.slice(steps, i * CHUNK + 1, F.lit(CHUNK)))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,rule:int,end:int,part:int>>>").alias("out"))
    return F.filter(F.flatten(F.aggregate(chunks, start, add_chunk)["out"]), lambda s: s["part"] >= rule.least)


def _written(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rule"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """doc_id, text, ``found`` (array of start, rule number, end, measured length; by
    start, then rule) and ``checked``, the rules that were verified on the document."""
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), text_hash(text).alias("_hash"))
    keys = ["doc_id", "_hash"]
    asked = sorted({t for r in rules for branch in trigram_query(r.pattern) for t in branch})
    hits = keep(candidates(trigram_index(rows, asked, keys), rules, keys), scratch(docs.sparkSession, "secrets"))
    flagged = may_be_candidates(rows, hits, keys)
    met = hits.withColumnsRenamed({"doc_id": "_of", "_hash": "_of_hash"})
    possible = flagged.where("_maybe")
    possible = possible.join(met, possible["doc_id"].eqNullSafe(met["_of"]) & (possible["_hash"] == met["_of_hash"]), "left").select("doc_id", "text", "kinds")
    joined = possible.unionByName(flagged.where(~F.col("_maybe")).select("doc_id", "text", F.lit(None).cast("array<string>").alias("kinds")))
    kinds = F.coalesce(F.col("kinds"), F.array().cast("array<string>"))
    checks = [(i, r, F.array_contains(kinds, r.kind) if trigram_query(r.pattern) else F.lit(True)) for i, r in enumerate(rules)]
    none = F.array().cast("array<struct<start:int,rule:int,end:int,part:int>>")
    found = [F.when(check & F.col("text").rlike(_strict(r)), _spans(F.col("text"), r, i)).otherwise(none) for i, r, check in checks]
    checked = F.array_compact(F.array(*[F.when(check, F.lit(r.kind)) for _, r, check in checks]))
    return joined.select("doc_id", "text", F.array_sort(reduce(lambda a, b: F.concat(a, b), found)).alias("found"), checked.alias("checked"))


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents")).select("doc_id", "found")
    base = [i for i, r in enumerate(RULES) if r.base]

    def of_rule(i: int) -> Column:
        return F.size(F.filter("found", lambda s: s["rule"] == i)).cast("long")

    counts = [of_rule(i).alias(f"n_{RULES[i].kind}") for i in base]
    base_spans = F.filter("found", lambda s: s["rule"].isin(base))
    return found.select("doc_id", *counts, F.sha2(_written(base_spans, RULES), 256).alias("base_sha256"), _written(F.col("found"), RULES).alias("spans"))


def _oracle() -> str:
    parts = []
    for i, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(f"""SELECT k, {i} AS r, '{r.kind}' AS kind, unnest(m) AS m, unnest(p) AS part, unnest(range(1, len(m) + 1)) AS i, g, m AS ms
 FROM (SELECT k, regexp_extract_all(text, '{p}') AS m, regexp_extract_all(text, '{p}', {r.group}) AS p, regexp_split_to_array(text, '{p}') AS g FROM d) WHERE len(m) > 0""")
    base = [i for i, r in enumerate(RULES) if r.base]
    least = " ".join(f"WHEN {i} THEN {r.least}" for i, r in enumerate(RULES))
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
h AS ({' UNION ALL '.join(parts)}),
s AS (SELECT k, r, kind, length(m) AS size, length(part) AS part, (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start FROM h),
f AS (SELECT k, r, start, kind || ':' || start::VARCHAR || ':' || (start + size)::VARCHAR AS span FROM s WHERE part >= CASE r {least} END),
a AS (SELECT k, {', '.join(f'count(*) FILTER (WHERE r = {i}) AS n_{RULES[i].kind}' for i in base)},
 string_agg(span, ',' ORDER BY start, r) FILTER (WHERE r IN ({', '.join(map(str, base))})) AS base, string_agg(span, ',' ORDER BY start, r) AS spans FROM f GROUP BY k)
SELECT d.doc_id, {', '.join(f'coalesce(a.n_{RULES[i].kind}, 0)::BIGINT AS n_{RULES[i].kind}' for i in base)}, sha256(coalesce(a.base, '')) AS base_sha256, coalesce(a.spans, '') AS spans FROM d LEFT JOIN a USING (k)
"""


OP8_SQL = _oracle()
