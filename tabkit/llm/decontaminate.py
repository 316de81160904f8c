"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores, for each block of documents, the postings of their
tokens: the sorted distinct terms, and for each term the sorted positions
at which it stands. A shard is one row, written with the other shards as a
table in the shared folder; it can serve any number of searches.

``search`` takes the windows of the test items (ten consecutive words; an
item of fewer words is one window). In each shard a window's terms are put
in order from the rarest; the postings of the rarest, less its place in the
window, are the candidate starts, and each further list keeps those starts
at which its own term stands at the right offset. Matches are exact phrases;
``near`` matches have every term within ``slop`` words of its place.

Words are those of the contract (ASCII letters lower-cased; digits, letters
and every non-ASCII character belong to words), compared by 64-bit hashes.
Null texts have no words and no matches; a null item id finds phrases but is
not listed. Repeated rows are kept apart (a row is known by shard and place
in the shard). Empty tables give no rows, or no matches. Other columns are
ignored.

Test items are handed to the tasks in blocks of at most ``ITEM_BLOCK_BYTES``
of text. With one block the index holds the terms that the items use; with
more it holds all terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tabkit.llm import textops as X
from tabkit.scratch import Scratch

WINDOW_WORDS = 10
SLOP = 3
SHARD_BYTES = 4 << 20
ITEM_BLOCK_BYTES = 4 << 20
# Bytes of a shard's text whose words are hashed at a time.
CHUNK_BYTES = 1 << 19
# Starts in a shard that are checked at a time.
CANDIDATES = 1 << 18
# Positions left free between two documents, so that no window reaches over.
GAP = 64

_U = np.uint64


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    data = X.ASCII_LOWER[data]
    starts, ends, per_row = X.spans(data, offsets, X.NOT_WORD)
    return X.span_hashes(data, starts, ends), per_row


def postings(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray | None = None):
    """(keys, positions, words per row) of a shard's words in their order;
    keys are hashes or, with a vocabulary, places in it, of its words only."""
    keys, places, per_row, base = [], [], [], 0
    for lo, hi in X.row_chunks(offsets, CHUNK_BYTES):
        words, n = word_hashes(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        at = (base + np.arange(len(words)) + np.repeat(GAP * np.arange(len(n)), n)).astype(np.int32)
        if vocabulary is not None:
            code = np.searchsorted(vocabulary, words)
            known = np.flatnonzero(vocabulary[np.minimum(code, len(vocabulary) - 1)] == words) if len(vocabulary) else np.zeros(0, np.int64)
            words, at = code[known], at[known]
        keys.append(words)
        places.append(at)
        per_row.append(n)
        base += int(n.sum()) + GAP * len(n)
    return np.concatenate(keys), np.concatenate(places), np.concatenate(per_row)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: np.ndarray | None = None) -> DataFrame:
    """``(shard, ids, n_words, firsts, terms, list_ends, positions)``, one
    row per block of documents. ``vocabulary``: sorted term hashes to index
    (None: all)."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    wanted = None if vocabulary is None else spark.sparkContext.broadcast(vocabulary)
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("ids", T.ArrayType(id_type)), T.StructField("n_words", T.ArrayType(T.LongType())),
                           T.StructField("firsts", T.BinaryType()), T.StructField("terms", T.BinaryType()), T.StructField("list_ends", T.BinaryType()), T.StructField("positions", T.BinaryType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        X.release()
        shard = TaskContext.get().partitionId() << 32
        v = None if wanted is None else wanted.value
        for batch in batches:
            for lo, hi, data, off in X.chunked(batch.column(1), SHARD_BYTES):
                key, at, n = postings(data, off, v)
                firsts = np.concatenate(([0], np.cumsum(n + GAP)[:-1])).astype(np.int64)
                order = np.argsort(key, kind="stable")
                key, at = key[order], at[order]
                change = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
                terms = key[change] if v is None else v[key[change]]
                ends = np.concatenate((change[1:], [len(at)])) if len(change) else np.zeros(0, np.int64)
                ids = batch.column(0).slice(lo, hi - lo)
                one = pa.array([0, hi - lo], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard], pa.int64()), pa.ListArray.from_arrays(one, ids), pa.ListArray.from_arrays(one, pa.array(n, pa.int64())),
                    *(pa.array([x.tobytes()], pa.binary()) for x in (firsts, terms.astype(_U), ends.astype(np.int64), at))], names=schema.names)
                shard += 1
        X.release()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


class Windows:
    """The windows of a bounded block of test items, as arrays."""

    def __init__(self, texts: list[str], width: int):
        import pyarrow as pa

        words, n = word_hashes(*X.utf8(pa.array(texts, pa.string())))
        first = np.concatenate(([0], np.cumsum(n)))
        count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
        self.item = np.repeat(np.arange(len(n)), count)
        start = np.arange(count.sum()) + np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(count)[:-1])), count)
        self.length = np.minimum(n, width)[self.item]
        padded = np.concatenate((words, np.zeros(width, _U)))
        self.terms = padded[start[:, None] + np.arange(width)] if len(start) else np.zeros((0, width), _U)
        self.vocabulary = np.unique(words)


def _search_shard(w: Windows, terms, list_ends, positions, slop: int):
    """(window, start, exact) of the matches in one shard; start is the
    position of the window's first word."""
    width = w.terms.shape[1]
    used = np.arange(width)[None, :] < w.length[:, None]
    code = np.searchsorted(terms, w.terms)
    present = terms[np.minimum(code, len(terms) - 1)] == w.terms
    live = np.flatnonzero((present | ~used).all(axis=1) & (w.length > 0))
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
    if not len(live):
        return none
    code, used = code[live], used[live]
    begins = np.concatenate(([0], list_ends[:-1]))
    size = np.where(used, (list_ends - begins)[np.minimum(code, len(terms) - 1)], np.iinfo(np.int64).max)
    order = np.argsort(size, axis=1, kind="stable")
    sorted_postings = (np.repeat(np.arange(len(terms), dtype=np.int64), list_ends - begins) << 32) | positions
    rare = order[:, 0]
    rows = np.arange(len(live))
    n_candidates = size[rows, rare]
    out = []
    edges = np.concatenate(([0], np.cumsum(n_candidates)))
    lo = 0
    while lo < len(live):
        hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + CANDIDATES, "right")) - 1)
        part = slice(lo, hi)
        row = np.repeat(rows[part], n_candidates[part])
        at = np.arange(len(row)) - np.repeat(edges[part] - edges[lo], n_candidates[part]) + begins[code[row, rare[row]]]
        held = positions[at].astype(np.int64)       # where the rarest term stands, always inside a document
        start = held - rare[row]
        exact = np.ones(len(row), bool)
        for k in range(1, width):
            place = order[row, k]
            needed = used[row, place]
            base = code[row, place].astype(np.int64) << 32
            expected = start + place
            i = np.searchsorted(sorted_postings, base + np.maximum(expected - slop, 0))
            found = (sorted_postings[np.minimum(i, len(sorted_postings) - 1)] <= base + expected + slop) & (i < len(sorted_postings))
            if slop:
                j = np.searchsorted(sorted_postings, base + np.maximum(expected, 0))
                exact &= ~needed | ((expected >= 0) & (sorted_postings[np.minimum(j, len(sorted_postings) - 1)] == base + expected))
            keep = found | ~needed
            row, start, exact, held = row[keep], start[keep], exact[keep], held[keep]
        out.append((live[row], start, exact & (start >= 0), held))
        lo = hi
    return tuple(np.concatenate(x) for x in zip(*out))


def _merged(key: np.ndarray, start: np.ndarray, length: np.ndarray):
    """Spans of one key that touch or overlap become one."""
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order], (start + length)[order]
    if not len(key):
        return key, start, end
    new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (start[1:] > end[:-1]))))
    return key[new], start[new], np.maximum.reduceat(end, new)


def search(index: DataFrame, items: list, texts: list[str], item_type: T.DataType, width: int = WINDOW_WORDS, slop: int = SLOP) -> tuple[DataFrame, Broadcast]:
    """``(shard, place, item_id, start, n_words, kind)``: the word spans of
    each document (by shard and place in it) that windows of an item cover;
    kind is ``phrase``, or ``near`` for an item that has only near matches
    there. A near match lies in the document that holds its rarest term; its
    span ends where the document does. With it, the items as broadcast, to
    be destroyed when the rows are written."""
    shared = index.sparkSession.sparkContext.broadcast((items, Windows(texts, width)))
    arrow_item = to_arrow_type(item_type)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        ids, w = shared.value
        for batch in batches:
            for r in range(batch.num_rows):
                firsts, terms, ends, positions = (np.frombuffer(batch.column(c)[r].as_buffer(), t) for c, t in ((1, np.int64), (2, _U), (3, np.int64), (4, np.int32)))
                sizes = np.array(batch.column(5)[r].as_py(), dtype=np.int64)
                if not len(terms) or not len(w.item):
                    continue
                win, start, exact, held = _search_shard(w, terms, ends, positions, slop)
                place = np.searchsorted(firsts, held, "right") - 1
                begin = np.maximum(start, firsts[place])
                n = np.minimum(start + w.length[win], firsts[place] + sizes[place]) - begin
                item = w.item[win]
                pair = place.astype(np.int64) << 32 | item
                key, s, e = _merged(pair[exact], begin[exact], n[exact])
                only = ~exact & ~np.isin(pair, key)
                key2, s2, e2 = _merged(pair[only], begin[only], n[only])
                key, s, e = (np.concatenate(x) for x in ((key, key2), (s, s2), (e, e2)))
                p = key >> 32
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(key), batch.column(0)[r].as_py()), pa.int64()), pa.array(p.astype(np.int32)), pa.array([ids[i] for i in key & 0xFFFFFFFF], arrow_item),
                    pa.array((s - firsts[p]).astype(np.int32)), pa.array((e - s).astype(np.int32)), pa.array(np.where(np.arange(len(key)) < len(key) - len(key2), "phrase", "near").astype(object), pa.string())],
                    names=["shard", "place", "item_id", "start", "n_words", "kind"])
        X.release()

    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("place", T.IntegerType()), T.StructField("item_id", item_type),
                           T.StructField("start", T.IntegerType()), T.StructField("n_words", T.IntegerType()), T.StructField("kind", T.StringType())])
    return index.select("shard", "firsts", "terms", "list_ends", "positions", "n_words").mapInArrow(run, schema), shared


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  width: int = WINDOW_WORDS, slop: int = SLOP) -> tuple[DataFrame, DataFrame]:
    """``(documents, matches)``. documents: ``(shard, place, id, n_words)``,
    one row per row of ``docs``; matches as ``search`` gives them."""
    spark = docs.sparkSession
    s = Scratch(spark, "decontaminate")
    tests = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where("text is not null").distinct()
    item_type = benchmark.schema[item_col].dataType
    total = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // ITEM_BLOCK_BYTES))
    blocks = [tests] if n_blocks == 1 else [tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == k) for k in range(n_blocks)]
    index = matches = None
    for k, block in enumerate(blocks):
        rows = block.collect()  # at most ITEM_BLOCK_BYTES, or its share of a hash split
        items, texts = [r[0] for r in rows], [r[1] for r in rows]
        if index is None:
            vocabulary = Windows(texts, width).vocabulary if n_blocks == 1 else None
            index = s.table(build_index(docs, id_col, text_col, vocabulary), "index")
        found, shared = search(index, items, texts, item_type, width, slop)
        found = s.table(found, f"matches-{k}")
        shared.destroy()
        matches = found if matches is None else matches.union(found)
    documents = index.select("shard", F.posexplode(F.arrays_zip("ids", "n_words")).alias("place", "d")).select("shard", "place", F.col("d.ids").alias("id"), F.col("d.n_words").alias("n_words"))
    return documents, matches


def digest(documents: DataFrame, matches: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns, one row per document, and ``n_near`` (items
    with near matches only)."""
    phrase = F.col("kind") == "phrase"
    spans = F.array_sort(F.collect_set(F.when(phrase, F.struct("start", (F.col("start") + F.col("n_words")).alias("end")))))
    # words up to ``reach`` are counted
    words = F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")), lambda a, x: F.struct(
        (a["n"] + F.greatest(x["end"] - F.greatest(x["start"], a["reach"]), F.lit(0))).alias("n"), F.greatest(x["end"], a["reach"]).alias("reach")))
    item = F.col("item_id").cast("string")
    hit = (matches.groupBy("shard", "place").agg(
        words["n"].cast("long").alias("n_hit"),
        F.sort_array(F.collect_set(F.when(phrase, item))).alias("items"), F.size(F.collect_set(F.when(~phrase, item))).cast("long").alias("n_near")))
    none = F.array().cast("array<string>")
    return (documents.join(hit, ["shard", "place"], "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near")))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that share no window with a test item, with all their columns."""
    keyed = docs.select(F.struct("*").alias("row"), F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h")).alias("key"), F.col(text_col).alias("text"))
    documents, matches = contamination(keyed, benchmark, "key", "text", item_col, item_text_col, slop=0)
    hit = documents.join(matches.select("shard", "place").distinct(), ["shard", "place"]).select("id.*").distinct()
    return keyed.join(hit, keyed["key.id"].eqNullSafe(hit["id"]) & (keyed["key.h"] == hit["h"]), "left_anti").select("row.*")
