"""Divergence of sources by hash-consed segment trees over term ids.

Terms are runs of ASCII letters and non-ASCII characters, ASCII lower-cased;
a language keeps those in at least ``MIN_DOCS`` of its documents. Kept terms
are numbered by falling count, so rare ones, which most sources lack, lie
together. The counts of a group (language, source) over these ids are the
leaves of a segment tree.

* Ids are cut into segments of ``SEGMENT``; a task has one segment of the
  groups of a language. Nodes are consed: equal pairs of children are one
  node, wherever they stand and whichever group they belong to, so equal
  counts share their subtrees.
* Two groups are compared by walking both trees at once from the segment's
  roots, a level at a time. Equal pairs of nodes met at one level are one
  pair with the number of its places, so each is opened once and a pair of
  leaf counts is priced once; the price is multiplied by the places.
* Segments are summed by Spark. Sources are dealt to tiles of ``TILE``; a
  task has two tiles, so neither many sources nor many terms make it grow.

With ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``, N the group's kept
occurrences and V the language's kept terms, the price of a term is
``floor((p - q)^2 / (p + q))``. All arithmetic is in whole numbers.

Null text, language and source are empty strings; a text without terms
gives its group no counts, and the group is reported all the same. Repeated
rows are documents of their own. An empty table has no rows. Further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from tabkit.llm import textops as X
from tabkit.llm.ranks import rank_within
from tabkit.scratch import Scratch

MIN_DOCS = 10
SCALE = 10 ** 9
TOP_TERMS = 10
SEGMENT = 1 << 13
TILE = 32
# Bytes of text counted at a time.
CHUNK_BYTES = 8 << 20

NOT_TERM = X.byte_table([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def _batch_counts(text, group) -> tuple:
    """(group, term, n, docs) of one chunk; group is a code for each row."""
    import pyarrow as pa

    data, off = X.utf8(text)
    starts, ends, per_row = X.spans(data, off, NOT_TERM)
    low = X.ASCII_LOWER[data]
    ends_at = np.concatenate(([0], np.cumsum(ends - starts)))
    words = low[~NOT_TERM[data]]  # spans hold all term bytes, in order
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends_at.astype(np.int64)), pa.py_buffer(words.tobytes())).dictionary_encode()
    code, kinds = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(1, len(terms.dictionary))
    row = np.repeat(np.arange(len(per_row)), per_row)
    in_row, n = np.unique(row * kinds + code, return_counts=True)
    in_group, at = np.unique(group[in_row // kinds] * kinds + in_row % kinds, return_inverse=True)
    total = np.zeros(len(in_group), np.int64)
    np.add.at(total, at, n)
    return in_group // kinds, terms.dictionary.take(pa.array(in_group % kinds)), total, np.bincount(at, minlength=len(in_group))


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents, added up
    in the tasks before they are shuffled."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            names = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], names=["lang", "source"])
            kinds = {k: i for i, k in enumerate(dict.fromkeys((r["lang"], r["source"]) for r in names.to_pylist()))}
            code = np.array([kinds[r["lang"], r["source"]] for r in names.to_pylist()], np.int64)
            langs, sources = (pa.array([k[i] for k in kinds], pa.string()) for i in (0, 1))
            for lo, hi in X.row_chunks(X.utf8(batch.column(2))[1], CHUNK_BYTES):
                group, term, n, in_docs = _batch_counts(batch.column(2).slice(lo, hi - lo), code[lo:hi])
                at = pa.array(group)
                yield pa.RecordBatch.from_arrays([langs.take(at), sources.take(at), term.cast(pa.string()), pa.array(n), pa.array(in_docs.astype(np.int64))], names=["lang", "source", "term", "n", "docs"])
        X.release()

    counted = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def consed_trees(counts: np.ndarray):
    """Segment trees over the rows of ``counts`` (their length a power of
    two): (values of the leaves, [(left, right) of the nodes of each level
    upwards], roots)."""
    values, ids = np.unique(counts, return_inverse=True)
    ids, levels, kinds = ids.reshape(counts.shape), [], len(values)
    while ids.shape[1] > 1:
        pairs, at = np.unique(ids[:, ::2] * kinds + ids[:, 1::2], return_inverse=True)
        levels.append((pairs // kinds, pairs % kinds))
        ids, kinds = at.reshape(ids.shape[0], -1), len(pairs)
    return values, levels, ids[:, 0]


def leaf_pairs(levels, a: int, b: int):
    """(leaf of a, leaf of b, places): the trees of roots a and b walked at
    once, each pair of nodes opened once however often it is met."""
    x, y, places = np.array([a]), np.array([b]), np.array([1])
    for left, right in reversed(levels):
        x, y, places = np.concatenate((left[x], right[x])), np.concatenate((left[y], right[y])), np.concatenate((places, places))
        width = int(y.max()) + 1
        pairs, at = np.unique(x * width + y, return_inverse=True)
        x, y = pairs // width, pairs % width
        merged = np.zeros(len(pairs), np.int64)
        np.add.at(merged, at, places)
        places = merged
    return x, y, places


def shares(counts: list[int], total: int, terms: int) -> list[int]:
    """p of each count, in Python's unbounded whole numbers."""
    return [1 + SCALE * (c + 2) // (total + 2 * terms) for c in counts]


def _prices(table, size: int):
    """One task's part of the sums: an Arrow table of one segment and two
    tiles, its rows counts (place >= 0) and one header for each group."""
    import pyarrow as pa
    import pyarrow.compute as pc

    head = table.filter(pc.less(table["place"], 0)).to_pylist()
    rows = table.filter(pc.greater_equal(table["place"], 0))
    lang, segment, tile_a, tile_b, terms = (head[0][k] for k in ("lang", "segment", "tile_a", "tile_b", "terms"))
    name = sorted({(h["tile"], h["source"]): h["n"] for h in head}.items())
    at = {key[1]: i for i, (key, _) in enumerate(name)}
    used = min(size, terms - segment * size)
    width = 1 << max(0, used - 1).bit_length()
    counts = np.zeros((len(name), width), np.int64)
    counts[:, used:] = -1  # no term: priced at nothing
    row = np.array([at[s] for s in rows["source"].to_pylist()], np.int64)
    counts[row, rows["place"].to_numpy()] = rows["n"].to_numpy()
    values, levels, roots = consed_trees(counts)
    share = [np.array([0 if c < 0 else p for c, p in zip(values.tolist(), shares(values.tolist(), n, terms))], np.int64) for _, n in name]
    out = []
    for i, ((tile, one), _) in enumerate(name):
        for j in range(i + 1 if tile_a == tile_b else 0, len(name)):
            (other_tile, other), _ = name[j]
            if tile_a != tile_b and not (tile == tile_a and other_tile == tile_b):
                continue
            x, y, places = leaf_pairs(levels, roots[i], roots[j])
            p, q = share[i][x], share[j][y]
            some = p > 0
            p, q = p[some], q[some]
            out.append((lang, one, other, int(((p - q) ** 2 // (p + q) * places[some]).sum())))
    cols = list(zip(*out)) if out else [[]] * 4
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("lang", "a", "b", "value"), cols, (pa.string(), pa.string(), pa.string(), pa.int64()))})


def _with_tiles(df: DataFrame, tiles: DataFrame) -> DataFrame:
    """Each row in every pair of tiles that holds its source's."""
    both = df.join(tiles, "lang").withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1), lambda t: F.struct(F.least("tile", t).alias("tile_a"), F.greatest("tile", t).alias("tile_b")))
    return both.select(*df.columns, "tile", F.inline(pairs))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, segment: int = SEGMENT, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """``(pairs, terms)``: ``(lang, a, b, value)`` for every two sources of a
    language, once; ``(lang, source, term, n, p, q, value)`` for every term
    that a group has more of than its language."""
    s = Scratch(docs.sparkSession, "divergence")
    texts = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = s.table(term_counts(texts), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    vocabulary = s.table(rank_within(kept.select("lang", "term", "lang_n"), "lang", [F.col("lang_n").desc(), F.col("term").asc()], s, "kept"), "vocabulary")
    langs = vocabulary.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("terms"))
    found = s.table(counts.select("lang", "source", "term", "n").join(vocabulary.select("lang", "term", "rank", "lang_n"), ["lang", "term"]), "found")
    sums = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = s.table(texts.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
                     .select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms", "lang_total"))), "groups")

    tiles = groups.groupBy("lang").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    segments = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("terms") - 1) / segment)))
    head = _with_tiles(groups.where("terms > 0").select("lang", "source", "terms", F.col("total").alias("n"), segments.alias("segment"), F.lit(-1).alias("place")), tiles)
    body = _with_tiles(found.select("lang", "source", F.lit(0).cast("long").alias("terms"), "n", F.floor(F.col("rank") / segment).alias("segment"), (F.col("rank") % segment).cast("int").alias("place")), tiles)
    priced = head.unionByName(body).groupBy("lang", "segment", "tile_a", "tile_b").applyInArrow(lambda table: _prices(table, segment), "lang string, a string, b string, value long")
    # languages without kept terms: every pair is at zero
    bare = _with_tiles(groups.where("terms = 0").select("lang", "source"), tiles).groupBy("lang", "tile_a", "tile_b").applyInArrow(_zeros, "lang string, a string, b string, value long")
    pairs = priced.unionByName(bare).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))

    share = "cast(1 + (cast({n} as decimal(38,0)) + 2) * 1000000000 div ({total} + 2 * terms) as bigint)"
    terms = (found.join(groups, ["lang", "source"])
             .withColumn("p", F.expr(share.format(n="n", total="total"))).withColumn("q", F.expr(share.format(n="lang_n", total="lang_total")))
             .where("p > q").select("lang", "source", "term", "n", "p", "q", F.expr("(p - q) * (p - q) div (p + q)").alias("value")))
    return pairs, terms


def _zeros(table):
    import pyarrow as pa

    rows = table.to_pylist()
    lang, a, b = (rows[0][k] for k in ("lang", "tile_a", "tile_b"))
    names = sorted({(r["tile"], r["source"]) for r in rows})
    out = [(x, y) for i, (t, x) in enumerate(names) for u, y in names[i + 1:] if (a == b or t != u)]
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "a": pa.array([x for x, _ in out], pa.string()), "b": pa.array([y for _, y in out], pa.string()), "value": pa.array([0] * len(out), pa.int64())})


def report(pairs: DataFrame, terms: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: for each group its
    distances to the other sources of the language, and its ``top`` terms."""
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc()))
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    best = terms.select("lang", "source", F.col("term").alias("item"), "value").withColumn("rank", rank).where(F.col("rank") <= top)
    out = both.withColumn("rank", rank).withColumn("part", F.lit("pair")).unionByName(best.withColumn("part", F.lit("term")))
    return out.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")


def oracle_sql() -> str:
    p = "(1 + ({n}::hugeint + 2) * 1000000000 // ({total} + 2 * {v}))"
    f = "((p - q) * (p - q) // (p + q))"
    return rf"""with docs as (
  select row_number() over () d, coalesce(lang, '') lang, coalesce(source, '') source, coalesce(text, '') text from documents),
words as (
  select d, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) term from docs),
kept as (select lang, term, count(*) n from words group by all having count(distinct d) >= {MIN_DOCS}),
langs as (select lang, count(*) v, sum(n) total from kept group by all),
found as (select lang, source, term, count(*) n from words semi join kept using (lang, term) group by all),
names as (select distinct lang, source from docs),
groups as (select lang, source, coalesce(v, 0) v, coalesce(sum(f.n), 0) total from names left join langs using (lang) left join found f using (lang, source) group by all),
priced as (
  select g.lang, g.source, kept.term, coalesce(f.n, 0) n, {p.format(n="coalesce(f.n, 0)", total="g.total", v="v")} p
  from groups g join kept using (lang) left join found f on (f.lang, f.source, f.term) = (g.lang, g.source, kept.term)),
sums as (select lang, source, item, sum({f}) as value from (select a.lang, a.source, b.source item, a.p, b.p q from priced a join priced b using (lang, term) where a.source <> b.source) group by all),
pairs as (
  select g.lang, g.source, o.source item, coalesce(s.value, 0) as value
  from groups g join groups o on g.lang = o.lang and g.source <> o.source left join sums s on (s.lang, s.source, s.item) = (g.lang, g.source, o.source)),
terms as (
  select lang, source, term item, {f} as value from (
    select a.lang, a.source, term, p, {p.format(n="k.n", total="l.total", v="l.v")} q from priced a join kept k using (lang, term) join langs l using (lang) where a.n > 0) where p > q)
select lang, source, 'pair' part, item, value::bigint as value, row_number() over (partition by lang, source order by value desc, item)::int as rank from pairs
union all
select * from (select lang, source, 'term' part, item, value::bigint as value, row_number() over (partition by lang, source order by value desc, item)::int as rank from terms) where rank <= {TOP_TERMS}"""


def audit(docs: DataFrame) -> DataFrame:
    return report(*divergence(docs))
