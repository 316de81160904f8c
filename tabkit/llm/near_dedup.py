"""MinHash near-dedup: fast similarity sketching, banding, exact checks.

A document's set is the set of its distinct five-word shingles (ASCII
lower-cased, words split at ASCII white space). Equal sets are one *node*,
so exact copies never enter the search. Two nodes are linked if their
Jaccard similarity is at least the threshold.

* **Sketch.** ``COORDINATES`` bins. In round ``i`` every element is hashed
  to one bin with a fresh value and a bin keeps the smallest (round, value)
  it has seen; from round ``COORDINATES`` on the bin of round ``i`` is fixed
  to ``i - COORDINATES``, so after twice as many rounds every coordinate is
  filled, even for a set of one element. A set that has filled its bins
  stops: large sets need one pass over their elements.
* **Bands.** Four coordinates to a band, 32 bands: a pair at the threshold
  of 0.75 shares none with a chance of (1 - 0.75^4)^32 = 5e-6.
* **Stars, not pairs.** In each bucket the members are paired with one hub,
  another one in each band. The pair with the most shared bands is checked
  first for every node; then the other pairs, where they would still join
  two components. Buckets of three members or more that still hold more
  than one component are then dealt into blocks of bounded size; each pair
  of blocks counts the common shingles of its members at once, as a product
  of incidence matrices, and gives one link for two components that meet.
  So no link is lost to a failed hub, and no group's pairs are emitted.
* **Exact check**, always, on the full sets, recomputed from whole texts.

Nulls and texts without words: empty set, linked with nothing. A null id
takes part; a component's id is the smallest id that is not null. Repeated
rows are copies. Two texts under one id are two nodes. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from tabkit.llm import textops as X
from tabkit.llm.components import components
from tabkit.scratch import Scratch

COORDINATES = 128
ROWS_PER_BAND = 4
SHINGLE_WORDS = 5
PERCENT = 75
# A block of an open bucket holds at most about so many nodes, and so many shingles.
BLOCK_NODES = 1024
BLOCK_SHINGLES = 1 << 19
MATRIX_COLUMNS = 4096
# So many pairs of a block are compared one by one.
FEW_PAIRS = 24
# Bytes of text whose shingles are hashed at a time.
CHUNK_BYTES = 1 << 19

_U = np.uint64
_ROUND_KEYS = X._stream(21, 2 * COORDINATES)
_BAND_KEYS = X._stream(22, COORDINATES // ROWS_PER_BAND)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE_WORDS):
    """(elements, per_row): sorted distinct shingle hashes of each row."""
    data = X.ASCII_LOWER[data]
    starts, ends, words = X.spans(data, offsets, X.WHITE_SPACE)
    h, _, per_row = X.window_hashes(X.span_hashes(data, starts, ends), words, width)
    first = np.concatenate(([0], np.cumsum(per_row)))
    out = [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:])]
    return (np.concatenate(out) if out else h), np.array([len(x) for x in out], np.int64)


def set_keys(elements: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    """One 64-bit key per set (order-free sum of mixed elements and size)."""
    total = np.concatenate((np.zeros(1, _U), np.cumsum(X.mix(elements ^ _U(0x5851F42D4C957F2D)), dtype=_U)))
    first = np.concatenate(([0], np.cumsum(per_row)))
    return X.mix((total[first[1:]] - total[first[:-1]]) ^ X.mix(per_row.astype(_U)))


def sketches(elements: np.ndarray, per_row: np.ndarray, coordinates: int = COORDINATES, used: int | None = None) -> np.ndarray:
    """(rows, coordinates) sketch values; a row without elements stays at the
    maximum. Of the coordinates only the first ``used`` (all, by default) are
    sure to be filled."""
    rows = len(per_row)
    used = coordinates if used is None else used
    empty = np.iinfo(_U).max
    table = np.full(rows * coordinates, empty, _U)
    owner = np.repeat(np.arange(rows) * coordinates, per_row)
    left = np.flatnonzero(per_row)
    for i in range(coordinates + used):
        if not len(owner):
            break
        h = X.mix(elements ^ _ROUND_KEYS[i])
        at = owner + ((h & _U(coordinates - 1)).astype(np.int64) if i < coordinates else i - coordinates)
        if i:       # what an earlier round has left is less
            free = np.flatnonzero(table[at] == empty)
            at, h = at[free], h[free]
        np.minimum.at(table, at, (_U(i) << _U(56)) | (h >> _U(8)))
        more = (table.reshape(rows, coordinates)[left, :used] == empty).any(axis=1)
        if not more.all():
            rest = np.zeros(rows, bool)
            left = left[more]
            rest[left] = True
            rest = rest[owner // coordinates]
            elements, owner = elements[rest], owner[rest]
    return table.reshape(rows, coordinates)


def bands(table: np.ndarray) -> np.ndarray:
    parts = table.reshape(len(table), -1, ROWS_PER_BAND)
    h = np.broadcast_to(_BAND_KEYS, parts.shape[:2]).copy()
    for k in range(ROWS_PER_BAND):
        h = X.mix(h ^ parts[:, :, k]) + _BAND_KEYS
    return h


def sketch_documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text_hash, n_shingles, node, bands)``, one row per row of
    ``docs``; node is null and bands empty for an empty set."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("text_hash", T.LongType()), T.StructField("n_shingles", T.LongType()),
                           T.StructField("node", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        X.release()
        for batch in batches:
            for lo, hi, data, off in X.chunked(batch.column(1), CHUNK_BYTES):
                elements, n = shingle_sets(data, off)
                keys = X.as_long(set_keys(elements, n))
                b = X.as_long(bands(sketches(elements, n)))
                b = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum((n > 0) * b.shape[1]))), pa.int32()), pa.array(b[n > 0].ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(n), pa.array(keys, mask=n == 0), b], names=schema.names)
        X.release()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")).mapInArrow(run, schema)


def _nodes_of(rows: DataFrame) -> DataFrame:
    """``(node, text)`` of rows that have no id to be found by."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo, hi, data, off in X.chunked(batch.column(0), CHUNK_BYTES):
                elements, n = shingle_sets(data, off)
                yield pa.RecordBatch.from_arrays([pa.array(X.as_long(set_keys(elements, n)), mask=n == 0), batch.column(0).slice(lo, hi - lo)], names=["node", "text"])
        X.release()

    return rows.select("text").mapInArrow(run, "node long, text string")


def _full_sets(texts: DataFrame) -> DataFrame:
    """``(node, n, items)`` from ``(node, text)``; a text whose set
    is another than its node's (a repeated id) is dropped."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            wanted = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, off in X.chunked(batch.column(1), CHUNK_BYTES):
                elements, n = shingle_sets(data, off)
                keys = X.as_long(set_keys(elements, n))
                first = np.concatenate(([0], np.cumsum(n)))
                good = np.flatnonzero(keys == wanted[lo:hi])
                yield pa.RecordBatch.from_arrays([pa.array(keys[good]), pa.array(n[good]), pa.array([elements[first[i]:first[i + 1]].tobytes() for i in good], pa.binary())], names=["node", "n", "items"])
        X.release()

    return texts.select("node", "text").mapInArrow(run, "node long, n long, items binary")


def stored_sets(items):
    """(elements, per_row) of an Arrow array of sets as bytes."""
    import pyarrow as pa

    if not len(items):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    items = items.cast(pa.large_binary())
    off = np.frombuffer(items.buffers()[1], np.int64, len(items) + 1, items.offset * 8) // 8
    return np.frombuffer(items.buffers()[2] or b"", _U)[off[0]:off[-1]], np.diff(off)


def _split(elements: np.ndarray, per_row: np.ndarray) -> list[np.ndarray]:
    ends = np.cumsum(per_row)
    return [elements[a:b] for a, b in zip(ends - per_row, ends)]


def _checked(pairs: DataFrame, sets: DataFrame, percent: int, elements) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the threshold."""
    sa = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("items").alias("ia"))
    sb = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("items").alias("ib"))
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
            .join(sb, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).drop("na")
            .join(sa, "a").select("a", "b", "ia", "ib"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(*(_split(*elements(batch.column(c))) for c in (2, 3))):
                keep.append(_reaches(x, y, percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _blocks_of_open_buckets(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of the buckets with three nodes or more and more than one
    component, dealt into blocks and sent to every pair of blocks of their
    bucket."""
    labelled = members.join(labels, "node", "left").join(sets.select("node", "n"), "node").select("bucket", "node", "n", F.coalesce("root", "node").alias("root"))
    parts = F.ceil(F.greatest(F.count("*") / BLOCK_NODES, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = (labelled.groupBy("bucket").agg(F.count("*").alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi"), parts.alias("parts"))
             .where("size > 2 and lo <> hi").select("bucket", "parts"))
    dealt = labelled.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    return (dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("bucket", "node", "root", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
            .join(sets.select("node", "items"), "node"))


def common_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """(len(a), len(b)) sizes of the intersections of sets of elements."""
    element, column = np.unique(np.concatenate((*a, *b)), return_inverse=True)
    row = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in (*a, *b)])
    left = row < len(a)
    both = np.zeros(len(element), np.int8)
    both[column[left]] = 1
    both[column[~left]] |= 2
    number = np.cumsum(both == 3) - 1
    keep = both[column] == 3
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(a), len(b)), np.float32)
    edges = np.arange(0, (column[-1] if len(column) else -1) + 1 + MATRIX_COLUMNS, MATRIX_COLUMNS)
    cuts = np.searchsorted(column, edges)
    for lo, hi, base in zip(cuts[:-1], cuts[1:], edges):
        matrix = np.zeros((len(a) + len(b), MATRIX_COLUMNS), np.float32)
        matrix[row[lo:hi], column[lo:hi] - base] = 1
        out += matrix[:len(a)] @ matrix[len(a):].T
    return out


def _whole_groups(batches: Iterator, n_keys: int) -> Iterator:
    """Batches of sorted rows, cut where one of the first ``n_keys`` columns changes."""
    import pyarrow as pa

    def joined(parts):
        return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in range(n_keys)]
        if held and any(x[0] != y for x, y in zip(keys, last)):
            yield joined(held)
            held = []
        last = [x[-1] for x in keys]
        other = np.flatnonzero(np.any([x != x[-1] for x in keys], axis=0))
        if len(other):
            cut = int(other[-1]) + 1
            yield joined([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield joined(held)


def _reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    at = np.searchsorted(y, x)
    shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def block_links(low: np.ndarray, high: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Rows ``(i, j)`` of a pair of blocks that reach the threshold, one for
    each two roots at most. ``low`` and ``high`` are the rows of the blocks."""
    na, nb = np.array([len(sets[i]) for i in low]), np.array([len(sets[j]) for j in high])
    may = (roots[low][:, None] != roots[high][None, :]) & (100 * np.minimum(na[:, None], nb[None, :]) >= percent * np.maximum(na[:, None], nb[None, :]))
    if low[0] == high[0]:       # a block with itself
        may = np.triu(may)
    i, j = np.nonzero(may)
    if len(i) > FEW_PAIRS:
        common = common_counts([sets[x] for x in low], [sets[x] for x in high])[i, j]
        good = 100 * common >= percent * (na[i] + nb[j] - common)
        i, j = i[good], j[good]
        linked = lambda a, b: True
    else:
        linked = lambda a, b: _reaches(sets[a], sets[b], percent)
    out = {}
    for a, b, x, y in zip(low[i].tolist(), high[j].tolist(), roots[low[i]].tolist(), roots[high[j]].tolist()):
        pair = (x, y) if x < y else (y, x)
        if pair not in out and linked(a, b):
            out[pair] = (a, b)
    return list(out.values())


def _cross_links(rows: DataFrame, percent: int, elements) -> DataFrame:
    """Links ``(a, b)`` between nodes of different components of a pair of
    blocks, one for each two components at most."""
    keys = ["bucket", "left", "right"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in _whole_groups(batches, len(keys)):
            bucket, left, right, node, root, block = (batch.column(c).to_numpy() for c in range(6))
            sets = _split(*elements(batch.column(6)))
            new = (bucket[1:] != bucket[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
            edges = np.flatnonzero(np.concatenate(([True], new, [True])))
            links = []
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                at = np.arange(lo, hi)
                low, high = at[block[lo:hi] == left[lo]], at[block[lo:hi] == right[lo]]
                if len(low) and len(high):
                    links += block_links(low, high, root, sets, percent)
            a, b = np.array(links, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])
        X.release()

    return rows.select(*keys, "node", "root", "block", "items").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def buckets(banded: DataFrame) -> DataFrame:
    """``(bucket, node, hub)`` of the buckets ``(bucket, node)`` with two
    nodes or more."""
    order = F.col("node").bitwiseXOR(F.col("bucket"))
    hubs = (banded.groupBy("bucket").agg(F.min(order).alias("lo"), F.max(order).alias("hi"))
            .where("lo <> hi").select("bucket", F.col("lo").bitwiseXOR(F.col("bucket")).alias("hub")))
    return banded.join(hubs, "bucket")


def linked_nodes(members: DataFrame, sets: DataFrame, percent: int, s: Scratch, elements=stored_sets) -> DataFrame:
    """``(node, root)`` of all nodes with a link: the components of the
    pairs that share a bucket and whose full sets reach the threshold.
    ``elements`` turns the items of ``sets`` into (elements, per_row)."""
    stars = s.table(members.where("node <> hub").groupBy(F.col("hub").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("bands")), "stars")
    first = stars.groupBy("b").agg(F.max_by("a", F.struct("bands", "a")).alias("a")).select("a", "b")
    links = s.table(_checked(first, sets, percent, elements), "links0")
    labels = components(links, s, "c0")

    def joining(pairs: DataFrame) -> DataFrame:
        la = labels.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        lb = labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        return pairs.join(la, "a", "left").join(lb, "b", "left").where("coalesce(ra, a) <> coalesce(rb, b)").select("a", "b")

    more = s.table(_checked(joining(stars), sets, percent, elements), "links1")
    if not more.isEmpty():
        links = links.union(more)
        labels = components(links, s, "c1")
    more = s.table(_cross_links(_blocks_of_open_buckets(members, labels, sets), percent, elements).distinct(), "links2")
    if not more.isEmpty():
        links = links.union(more)
        labels = components(links, s, "c2")
    return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_shingles, component_id, kept,
    text_hash`` (xxhash64 of the text).

    ``component_id`` is the smallest id that links reach, ``kept`` marks the
    rows whose id it is. An empty table gives no rows.
    """
    spark = docs.sparkSession
    s = Scratch(spark, "near-dedup")
    sketched = s.table(sketch_documents(docs, id_col, text_col), "sketched")

    banded = sketched.where("node is not null").select("node", F.explode("bands").alias("bucket"))
    members = s.table(buckets(banded).distinct(), "members")

    nodes = sketched.where("node is not null").groupBy("node").agg(F.min("id").alias("id"))
    wanted = members.select("node").distinct().join(nodes, "node")
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = plain.join(wanted, "id").select("node", "text").union(
        _nodes_of(plain.where("id is null")).join(wanted.where("id is null").select("node"), "node", "left_semi"))
    sets = s.table(_full_sets(texts).dropDuplicates(["node"]), "sets")

    labels = linked_nodes(members, sets, percent, s)

    linked = labels.join(nodes, "node")
    smallest = linked.groupBy("root").agg(F.min("id").alias("first_id"))
    owner = s.table(linked.join(smallest, "root").select("node", "first_id"), "owner")
    s.drop("members", "sets", "stars")
    alone = sketched.where("node is null").select("id", "n_shingles", F.col("id").alias("component_id"), "text_hash")
    own = nodes.select("node", F.col("id").alias("own_id"))
    placed = (sketched.where("node is not null").select("id", "n_shingles", "node", "text_hash")
              .join(owner.unionByName(own.join(owner, "node", "left_anti").withColumnRenamed("own_id", "first_id")), "node")
              .select("id", "n_shingles", F.col("first_id").alias("component_id"), "text_hash"))
    return alone.union(placed).select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates (the one with
    the smallest id; one of repeated rows)."""
    found = near_duplicates(docs, id_col, text_col, percent).where("kept").select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_h")).distinct()
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_h"))
    named = keyed.where("_id is not null").join(found, ["_id", "_h"], "left_semi").dropDuplicates(["_id", "_h"])
    nameless = keyed.where("_id is null").join(found.where("_id is null").select("_h"), "_h", "left_semi").dropDuplicates(["_h"])
    return named.select("row.*").union(nameless.select("row.*"))
