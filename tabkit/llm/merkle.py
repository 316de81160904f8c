"""Merkle manifest of a table: a proof for every row, by a nested-struct rollup.

Rows are leaves, ranked inside their group. A rank has ``LEVELS`` digits to
the base ``FANOUT`` inside a block of ``BLOCK`` neighbours. The digit columns
are grouped away one after the other, the last digit first; each grouping
nests the children's structs in their parent's, so that a block ends as one
row that holds its whole subtree. Blocks are the leaves of the next tier,
until a group is one node; the groups' nodes, ordered by group, are rolled up
in the same way to the root.

Proofs come down the same tiers. What lies above a block is put beside its
subtree by a union and a grouping on the block (two rows each), and one
``transform`` a level with a final ``explode`` gives every child the hashes
of its siblings. No row is bigger than a block, whatever a group's size, and
there is no join.

Definitions: a field's bytes are ``-`` if null, else its UTF-8 byte count,
``:`` and the value; a hash is the lowercase hex SHA-256 of its concatenated
inputs. Every ``FANOUT`` consecutive nodes (the last run: fewer, even one)
become one while several remain. Groups and ids that are null come first;
rows of one id are ordered by leaf; repeated rows are leaves of their own.
An empty table has no rows. Columns that are not named are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabkit.llm.ranks import rank_within
from tabkit.scratch import Scratch

FANOUT = 3
LEVELS = 5
BLOCK = FANOUT ** LEVELS
_NO_PATH = "cast(array() as array<struct<left:string,right:string>>)"

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


# Levels that a block of a group of ``total`` nodes goes up.
_HEIGHT = "CASE " + " ".join(f"WHEN total <= {FANOUT ** k} THEN {k}" for k in range(LEVELS)) + f" ELSE {LEVELS} END"


def roll_up(nodes: DataFrame) -> DataFrame:
    """``(group, total, block, node)``, one row a block, from ``(group, total,
    rank, h, item)``: node is a struct of a hash and its children."""
    digits = [f"d{k}" for k in range(LEVELS)]
    rows = nodes.selectExpr("group", "total", f"rank div {BLOCK} AS block", *(f"rank div {FANOUT ** k} % {FANOUT} AS d{k}" for k in range(LEVELS)), "struct(h, item) AS node")
    rows = rows.repartition("group", "block")
    for k in range(LEVELS):
        keys = ["group", "total", "block", *digits[k + 1:]]
        rows = rows.groupBy(*keys).agg(F.expr(f"sort_array(collect_list(struct(d{k}, node))).node AS kids"))
        rows = rows.selectExpr(*keys, f"struct(if({_HEIGHT} > {k}, sha2(array_join(kids.h, ''), 256), kids[0].h) AS h, kids) AS node")
    return rows


def _leaves(node: str, level: int, path: str) -> str:
    """SQL for the list of the leaves under ``node`` with their paths."""
    if level == 0:
        return f"array(struct({node}.item AS item, {node}.h AS h, {path} AS path))"
    kid, at = f"kid{level}", f"at{level}"
    step = f"struct(array_join(slice({node}.kids.h, 1, {at}), '') AS left, array_join(slice({node}.kids.h, {at} + 2, {FANOUT}), '') AS right)"
    return f"flatten(transform({node}.kids, ({kid}, {at}) -> {_leaves(kid, level - 1, f'concat(if(height >= {level}, array({step}), {_NO_PATH}), {path})')}))"


def hand_down(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """``(group, item, h, path, top)`` of each block's leaves; ``above`` has
    ``(group, block, path, top)``, one row a block."""
    both = (blocks.select("group", "block", "total", "node", F.lit(None).cast(above.schema["path"].dataType).alias("path"), F.lit(None).cast(above.schema["top"].dataType).alias("top"))
            .unionByName(above.select("group", "block", F.lit(None).cast("long").alias("total"), F.lit(None).cast(blocks.schema["node"].dataType).alias("node"), "path", "top")))
    one = both.groupBy("group", "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("total", "node", "path", "top")))
    leaves = one.withColumn("height", F.expr(_HEIGHT)).select("group", "top", F.explode(F.expr(_leaves("node", LEVELS, "path"))).alias("leaf"))
    return leaves.select("group", "leaf.*", "top")


def _tiers(nodes: DataFrame, s: Scratch, name: str) -> list[DataFrame]:
    tiers = []
    while True:
        blocks = s.table(roll_up(nodes), f"{name}{len(tiers)}")
        tiers.append(blocks)
        most = blocks.agg(F.max("total")).first()[0]
        if most is None or most <= BLOCK:
            return tiers
        nodes = blocks.select("group", F.ceil(F.col("total") / BLOCK).alias("total"), F.col("block").alias("rank"), F.col("node.h").alias("h"), F.col("block").alias("item"))


def _proofs(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    for blocks in reversed(tiers[1:]):
        above = hand_down(blocks, above).select("group", F.col("item").alias("block"), "path", "top")
    return hand_down(tiers[0], above)


def manifest(rows: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source", claim: Column | None = None) -> DataFrame:
    """``(id, group, leaf, claim, subroot, root, path)``, one row for each
    row: path is the list of (left, right) sibling hashes, concatenated, from
    the leaf's run to the root. ``claim`` is carried along for ``folded``:
    the leaf that somebody else computed (null: none)."""
    s = Scratch(rows.sparkSession, "merkle")
    claim = F.lit(None).cast("string") if claim is None else claim
    leaves = s.table(rows.select(F.col(group_col).alias("group"), F.col(id_col).alias("id"), leaf_hash(*map(F.col, fields)).alias("h"), claim.alias("claim")), "leaves")
    ranked = rank_within(leaves, "group", [F.col("id").asc_nulls_first(), F.col("h").asc()], s, "ranked")
    tiers = _tiers(ranked.select("group", "total", "rank", "h", F.struct("id", "claim").alias("item")), s, "tier")

    tops = tiers[-1].select(F.lit(0).alias("group"), F.struct(F.col("group").alias("name")).alias("item"), F.col("node.h").alias("h"))
    ordered = rank_within(tops, "group", [F.col("item.name").asc_nulls_first()], s, "groups")
    upper = _tiers(ordered, s, "upper")
    start = upper[-1].select("group", "block", F.expr(_NO_PATH).alias("path"), F.struct(F.col("node.h").alias("root")).alias("top"))
    groups = _proofs(upper, start).select(F.col("item.name").alias("group"), F.lit(0).cast("long").alias("block"), "path", F.struct("top.root", F.col("h").alias("subroot")).alias("top"))
    return _proofs(tiers, groups).select("item.id", "group", F.col("h").alias("leaf"), "item.claim", "top.subroot", "top.root", "path")


def proof_hash(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def digest(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, checked against texts that lost their
    line ends where 2 divides the id's CRC-32 (a null id's text is left)."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proofs = manifest(docs, claim=leaf_hash(*(F.col(c) for c in FIELDS[:-1]), tampered))
    out = proofs.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), folded(F.col("claim"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle_sql() -> str:
    """DuckDB: the tree level by level, and CRC-32 bit by bit."""
    def enc(v: str) -> str:
        return f"coalesce(strlen(cast({v} as varchar)) || ':' || cast({v} as varchar), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(enc(v) for v in (*FIELDS[:-1], text)) + ")"

    bit = "list_reduce([{crc}] || list_value(0,0,0,0,0,0,0,0)::ubigint[], lambda a, b: xor(a >> 1, (a & 1) * 3988292384))"
    crc = f"xor(list_reduce([4294967295::ubigint] || list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::ubigint), lambda crc, byte: {bit.format(crc='xor(crc, byte)')}), 4294967295)"

    def levels(name: str, start: str, part: str) -> str:
        keys = f"{part}, " if part else ""
        over = f"partition by {part}" if part else ""
        return f"""{name} as (
  select {keys}0::bigint lev, row_number() over ({over} order by {'doc_id nulls first, leaf' if part else 'source nulls first'}) - 1 idx, h, count(*) over ({over}) n from {start}
  union all
  select {keys}lev + 1, idx // {FANOUT}, sha256(string_agg(h, '' order by idx)), max((n + {FANOUT - 1}) // {FANOUT})
  from {name} where n > 1 group by {keys}lev, idx // {FANOUT})"""

    return f"""with recursive leaves as (
  select doc_id, source, {leaf('text')} leaf, {leaf(f"case when {crc} % 2 = 0 then replace(text, chr(10), '') else text end")} claim from documents),
base as (select *, leaf h from leaves),
{levels('tree', 'base', 'source')},
subroots as (select source, lev, h from tree where n = 1),
{levels('upper', 'subroots', '')},
ranked as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 idx from leaves),
groups as (select source, row_number() over (order by source nulls first) - 1 idx, lev height, h subroot from subroots),
fold as (
  select doc_id, r.source, leaf, subroot, r.idx, g.idx gidx, height, 0::bigint lev, claim cur, '' proof from ranked r join groups g on r.source is not distinct from g.source
  union all
  select doc_id, f.source, leaf, subroot, f.idx // {FANOUT}, f.gidx // case when f.lev < f.height then 1 else {FANOUT} end, height, f.lev + 1,
    sha256(coalesce(s.lft, '') || cur || coalesce(s.rgt, '')), proof || coalesce(s.lft, '') || coalesce(s.rgt, '')
  from (select *, case when lev < height then idx else gidx end spot from fold) f
  join (
    select a.source, a.lev, a.idx, false up, string_agg(b.h, '' order by b.idx) filter (b.idx < a.idx) lft, string_agg(b.h, '' order by b.idx) filter (b.idx > a.idx) rgt
    from tree a join tree b on a.source is not distinct from b.source and a.lev = b.lev and a.idx // {FANOUT} = b.idx // {FANOUT} where a.n > 1 group by all
    union all
    select null, a.lev, a.idx, true, string_agg(b.h, '' order by b.idx) filter (b.idx < a.idx), string_agg(b.h, '' order by b.idx) filter (b.idx > a.idx)
    from upper a join upper b on a.lev = b.lev and a.idx // {FANOUT} = b.idx // {FANOUT} where a.n > 1 group by all) s
  on s.idx = f.spot and s.up = (f.lev >= f.height) and s.lev = f.lev - case when s.up then f.height else 0 end and (s.up or s.source is not distinct from f.source))
select doc_id, leaf, subroot, root, sha256(proof) proof_sha256, cur folded_root, cur = root verified
from fold, (select h root from upper where n = 1) where lev = height + (select max(lev) from upper)"""
