"""Secret scans over a trigram inverted index, in DataFrame functions only.

``trigram_query`` derives from a rule's regular expression which trigrams
(of the lower-cased text) every match must contain: an AND of ORs of ANDs.
``postings`` is the index: documents fall into blocks by id, and each block
has, for each trigram that any rule asks for, the sorted ids of its
documents that contain it. ``candidates`` evaluates the queries block by
block with array intersections and unions, so no posting list is longer
than a block. Candidates are verified with the rule's expression on the
whole text; a rule without a mandatory trigram scans every text.

Spans are code points, end exclusive, leftmost and not overlapping within a
kind. Null texts have none. A null id is verified against all rules; rows
that share an id share candidates and are verified each on its own text.
Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _parser

from pyspark.sql import Column, DataFrame, functions as F

BLOCK_DOCUMENTS = 4096
# Strings a part of an expression may stand for before it counts as unknown.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``min_length`` characters."""
    kind: str
    regex: str
    group: int = 0
    min_length: int = 0


# The contract's kinds, in its order.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Further well-known token formats.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES


def _strings(node) -> set[str] | None:
    """All strings that a parsed item can match, or None if unknown or too many."""
    op, arg = node[0], node[1]
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "IN":
        out = set()
        for o, a in arg:
            if str(o) == "LITERAL":
                out.add(chr(a).lower())
            elif str(o) == "RANGE" and a[1] - a[0] < MAX_STRINGS:
                out |= {chr(c).lower() for c in range(a[0], a[1] + 1)}
            else:
                return None
        return out if len(out) <= MAX_STRINGS else None
    if name == "SUBPATTERN":
        return _sequence_strings(arg[3])
    if name == "BRANCH":
        parts = [_sequence_strings(p) for p in arg[1]]
        return None if None in parts else set().union(*parts)
    if name == "MAX_REPEAT" and arg[1] <= 1:
        inner = _sequence_strings(arg[2])
        return None if inner is None else inner | ({""} if arg[0] == 0 else set())
    return None


def _sequence_strings(items) -> set[str] | None:
    out = {""}
    for item in items:
        own = _strings(item)
        if own is None or len(out) * len(own) > MAX_STRINGS:
            return None
        out = {a + b for a, b in product(out, own)}
    return out


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def trigram_query(regex: str) -> list[set[frozenset[str]]]:
    """AND over the list, OR over each set, AND over each frozenset. Empty:
    no trigram is mandatory."""
    clauses, run = [], {""}

    def flush():
        if min(map(len, run)) >= 3:
            options = {_trigrams(s) for s in run}
            clauses.append({o for o in options if not any(p < o for p in options)})

    for item in _parser.parse(regex):
        own = _strings(item)
        if own is not None and len(run) * len(own) <= MAX_STRINGS:
            run = {a + b for a, b in product(run, own)}
            continue
        flush()
        run = own if own is not None else {""}
    flush()
    return clauses


def _vocabulary(queries: list[list[set[frozenset[str]]]]) -> list[str]:
    return sorted({t for q in queries for clause in q for option in clause for t in option})


def postings(docs: DataFrame, id_col: str, text_col: str, vocabulary: list[str]) -> DataFrame:
    """``(block, lists)``: a map from trigram to the sorted ids of the
    block's documents that contain it."""
    blocks = max(1, -(-docs.count() // BLOCK_DOCUMENTS))
    low = F.lower(F.col(text_col))
    has = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in vocabulary]))
    return (docs.where(F.col(id_col).isNotNull()).select(F.pmod(F.xxhash64(id_col), F.lit(blocks)).alias("block"), F.col(id_col).alias("id"), F.explode(has).alias("trigram"))
            .groupBy("block", "trigram").agg(F.sort_array(F.collect_set("id")).alias("ids"))
            .groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("lists")))


def candidates(index: DataFrame, id_type: str, queries: list[list[set[frozenset[str]]]]) -> DataFrame:
    """``(id, rules)``: bit k of rules is set if rule k may match."""

    def ids(trigram: str) -> Column:
        return F.coalesce(F.try_element_at("lists", F.lit(trigram)), F.array().cast(f"array<{id_type}>"))

    def evaluate(query) -> Column:
        options = [reduce(F.array_union, [reduce(F.array_intersect, [ids(t) for t in sorted(o)]) for o in sorted(clause, key=sorted)]) for clause in query]
        return reduce(F.array_intersect, options)

    found = [F.struct(F.lit(1 << k).alias("rule"), evaluate(q).alias("ids")) for k, q in enumerate(queries) if q]
    return (index.select(F.explode(F.array(*found)).alias("f")).select("f.rule", F.explode("f.ids").alias("id"))
            .groupBy("id").agg(F.bit_or("rule").alias("rules")))


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """Array of (start, place, end) of the rule's matches in ``text``.

    The text between matches and the matches themselves alternate, so their
    lengths add up to the positions."""
    pattern = F.lit(rule.regex)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    steps = F.arrays_zip(F.transform(F.split(text, rule.regex, -1), F.char_length).alias("gap"), F.transform(whole, F.char_length).alias("size"), F.transform(checked, F.char_length).alias("own"))
    # the text after the last match has no match beside it
    empty = F.array().cast("array<struct<start:int,place:int,end:int>>")

    def step(state, x):
        start = state["at"] + x["gap"]
        end = start + x["size"]
        one = F.array(F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end")))
        return F.when(x["size"].isNull(), state).otherwise(
            F.struct(end.alias("at"), F.when(x["own"] >= rule.min_length, F.concat(state["spans"], one)).otherwise(state["spans"]).alias("spans")))

    walked = F.aggregate(steps, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda s: s["spans"])
    return F.when(F.regexp_like(text, pattern), walked).otherwise(empty)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``secrets``: an array of (start, place, end), ordered;
    place is the rule's number."""
    queries = [trigram_query(r.regex) for r in rules]
    found = candidates(postings(docs, id_col, text_col, _vocabulary(queries)), docs.schema[id_col].dataType.simpleString(), queries)
    found = found.select(F.col("id").alias("_candidate"), F.col("rules").alias("_rules"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    may = [F.col(id_col).isNull() | (F.coalesce(F.col("_rules"), F.lit(0)).bitwiseAND(1 << k) != 0) if q else F.lit(True) for k, q in enumerate(queries)]
    narrow = [F.lit(rules[k].regex.replace("]+", f"]{{{rules[k].min_length},}}")) if not q and not rules[k].group and rules[k].min_length else None for k, q in enumerate(queries)]
    none = F.array().cast("array<struct<start:int,place:int,end:int>>")
    spans = [F.when(m if n is None else m & F.regexp_like(text, n), _spans(text, r, k)).otherwise(none) for k, (r, m, n) in enumerate(zip(rules, may, narrow))]
    joined = docs.join(found, F.col(id_col) == F.col("_candidate"), "left")
    return joined.withColumn("secrets", F.array_sort(F.concat(*spans))).drop("_candidate", "_rules")


def without_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` in which no rule finds a secret, with all their columns."""
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return scan(packed, "id", "text", rules).where(F.size("secrets") == 0).select("row.*")


def digest(scanned: DataFrame, id_col: str = "doc_id", rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """The contract's columns from the output of ``scan``."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["place"]), x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(place: int) -> Column:
        return F.size(F.filter("secrets", lambda x: x["place"] == place)).cast("long")

    n = [count(k).alias(f"n_{r.kind}") for k, r in enumerate(base)]
    return scanned.select(F.col(id_col), *n, F.sha2(joined(F.filter("secrets", lambda x: x["place"] < len(base))), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


def _kind_sql(place: int, r: Rule) -> str:
    regex = r.regex.replace("'", "''")
    own = f"regexp_extract_all(t, '{regex}', {r.group})" if r.group else "m"
    return f"""select doc_id, '{r.kind}' kind, {place} place, s as "start", s + length(m[i]) as "end" from (
  select doc_id, i, m, own, list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) s from (
    select doc_id, m, p, own, unnest(range(1, len(m) + 1)) i from (select *, {own} own from (select doc_id, t, regexp_extract_all(t, '{regex}') m, string_split_regex(t, '{regex}') p from docs where regexp_matches(t, '{regex}')))))
  where length(own[i]) >= {r.min_length}"""


def oracle_sql(rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES) -> str:
    all_spans = "\n union all ".join(_kind_sql(k, r) for k, r in enumerate(rules))
    counts = ", ".join(f"coalesce(n_{r.kind}, 0)::bigint n_{r.kind}" for r in base)
    sums = ", ".join(f"count(*) filter (place = {k}) n_{r.kind}" for k, r in enumerate(base))
    one = "kind || ':' || \"start\"::bigint || ':' || \"end\"::bigint"
    return f"""with docs as (select doc_id, coalesce(text, '') t from documents), spans as ({all_spans}),
agg as (select doc_id, {sums}, string_agg({one}, ',' order by "start", place) filter (place < {len(base)}) base, string_agg({one}, ',' order by "start", place) spans from spans group by doc_id)
select d.doc_id, {counts}, sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans from docs d left join agg using (doc_id)"""
