"""Repeated byte strings by distributed prefix doubling.

A byte goes if a string of ``LENGTH`` bytes that covers it starts at another
place too, in the same text or in another. Texts are taken as UTF-8 bytes.

* Equal texts are one text with a number of copies. Copies of ``LENGTH``
  bytes or more go whole; they stand in what follows as one text, since
  others may hold their parts.
* Positions: of the ``GRAM``-byte strings that start in a window (the
  possible ``LENGTH``-byte string from one place) the one of least hash is
  its anchor, the same one in every copy of the window. Some n / 60 places
  of a text are anchors; each has a stretch, the bytes of its windows.
* Anchors are sorted and ranked by their gram. Those of a rank of their own
  leave: their windows are unique. Equal stretches of one rank are repeated
  as a whole; one of them, home, goes on for all.
* Prefix doubling on the others: Spark sorts them by (rank of the prefix,
  name of the bytes at the offset where it ends), for the growing lengths
  ``AFTER``, and ranks them anew. Those of a rank of their own leave, the
  others go on until they are past the threshold. The same is done backwards
  from the gram (``BEFORE``). A window that holds a string of a rank of its
  own at its anchor is unique.
* What is left, windows at the ends of repeated stretches, is sorted by
  (rank of the anchor's gram, name of the window) together with the homes'
  windows, so that no copy of a window is missed.

Names are 64-bit hashes; two strings are taken as equal if the gram and all
further parts agree: two names for a window. Sorted tables are range
partitioned with ties spread over parts, so a passage in a third of all
texts lies in no single task.

Null texts are empty. Texts shorter than ``LENGTH`` keep all their bytes.
Repeated rows are copies, whatever their id. Null ids are ids. An empty
table has no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tabkit.llm import textops as X
from tabkit.plans.skew import salted_join
from tabkit.scratch import Scratch

LENGTH = 200
GRAM = 50
# Lengths from an anchor, and before it together with its gram, that are ranked; no window reaches farther.
AFTER = (75, 100, 150, LENGTH)
BEFORE = (25, 50, 100, LENGTH - GRAM)
# Bytes of text worked on at a time.
CHUNK_BYTES = 1 << 20

# Rows of one key from which on they are joined in several tasks.
HOT_ROWS = 200_000

_U = np.uint64
_LOW = _U(0xFFFFFFFF)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def anchors(data: np.ndarray, offsets: np.ndarray):
    """(window starts, anchor of each): places in ``data``; the anchor is the
    first of the least grams that start in the window (32 bits are compared)."""
    grams = len(data) - GRAM + 1
    wide = LENGTH - GRAM + 1
    if grams < wide:
        e = np.zeros(0, np.int64)
        return e, e
    at = np.arange(grams)
    key = X.span_hashes(data, at, at + GRAM) & ~_LOW | at.astype(_U)
    least = _least(key, wide) & _LOW
    inside = np.zeros(len(least) + 1, np.int64)
    long = np.diff(offsets) >= LENGTH
    inside[offsets[:-1][long]] += 1
    inside[offsets[1:][long] - LENGTH + 1] -= 1
    starts = np.flatnonzero(np.cumsum(inside[:-1]))
    return starts, least[starts].astype(np.int64)


def _row_of(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, at, "right") - 1


def stretches(texts: DataFrame) -> DataFrame:
    """``(tid, at, lo, hi, name, stretch)`` of each anchor: the first and last
    start of its windows, the names of its gram and of its stretch."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo, hi, data, off in X.chunked(batch.column(1), CHUNK_BYTES):
                starts, own = anchors(data, off)
                first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])[:len(own)]))
                at, begin, end = own[first], starts[first], starts[np.append(first[1:], len(starts))[:len(first)] - 1]
                row = _row_of(off, at)
                name = X.span_hashes(data, begin, end + LENGTH) ^ X.mix((at - begin).astype(_U))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).take(pa.array(row)), *(pa.array((x - off[row]).astype(np.int32)) for x in (at, begin, end)),
                                                  pa.array(X.as_long(X.span_hashes(data, at, at + GRAM))), pa.array(X.as_long(name))], names=["tid", "at", "lo", "hi", "name", "stretch"])
        X.release()

    return texts.select("tid", "text").mapInArrow(run, "tid long, at int, lo int, hi int, name long, stretch long")


def neighbourhoods(candidates: DataFrame) -> DataFrame:
    """``(tid, at, gram, home, after0 .., before0 ..)``: the names of the
    bytes between the steps, null where the text ends before."""
    names = [f"after{k}" for k in range(len(AFTER))] + [f"before{k}" for k in range(len(BEFORE))]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def named(data, a, b, inside):
            return pa.array(X.as_long(X.span_hashes(data, np.where(inside, a, 0), np.where(inside, b, 0))), mask=~inside)

        for batch in batches:
            for lo, hi, data, off in X.chunked(batch.column(1), CHUNK_BYTES):
                at, (_, _, gram, home) = _places(batch.column(2).slice(lo, hi - lo), off)
                row = _row_of(off, at)
                start, end = off[row], off[row + 1]
                parts = [named(data, at + a, at + b, at + b <= end) for a, b in zip((GRAM, *AFTER), AFTER)]
                parts += [named(data, at - b, at - a, at - b >= start) for a, b in zip((0, *BEFORE), BEFORE)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array((at - start).astype(np.int32)), pa.array(gram), pa.array(home > 0), *parts], names=["tid", "at", "gram", "home", *names])
        X.release()

    return candidates.select("tid", "text", "places").mapInArrow(run, "tid long, at int, gram long, home boolean, " + ", ".join(f"{n} long" for n in names))


def _known(rows: DataFrame, classes: DataFrame, keys: list[str], how: str, times: DataFrame) -> DataFrame:
    return salted_join(rows, classes, keys, how, hot_rows=HOT_ROWS, hot=times.where(F.col("times") >= HOT_ROWS).select(*keys))


def rerank(rows: DataFrame, keys: list[str], how: str, s: Scratch, name: str, *measures) -> DataFrame:
    """``rows`` with the ``rank`` of their keys among those that stand in two
    rows or more (null, or left out, for keys of one row) and the measures."""
    classes = s.table(rows.groupBy(*keys).agg(F.count("*").alias("times"), *measures).where("times > 1"), f"{name}-classes")
    # sorted over all tasks, so these numbers rise with the keys
    ranked = s.table(classes.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()), f"{name}-sorted")
    return _known(rows, ranked.drop("times"), keys, how, classes)


def unique_lengths(around: DataFrame, side: str, steps: tuple, s: Scratch) -> DataFrame:
    """``(tid, at, alone)``: the shortest of ``steps`` up to which the bytes to
    one side of the gram are like no other's. Anchors that reach the text's
    end or the last step before that have no row, nor have homes."""
    done = []
    left = around.select("tid", "at", "home", F.col("gram").alias("known"), *(f"{side}{k}" for k in range(len(steps))))
    for k, step in enumerate(steps):
        seen = rerank(left.where(F.col(f"{side}{k}").isNotNull()), ["known", f"{side}{k}"], "left", s, f"{side}{k}")
        seen = s.table(seen.select("tid", "at", "home", *(f"{side}{j}" for j in range(k + 1, len(steps))), F.col("rank").alias("known")), f"{side}{k}")
        done.append(s.table(seen.where("known is null and not home").select("tid", "at", F.lit(step).alias("alone")), f"{side}{k}-alone"))
        s.drop(f"{side}{k}-classes", f"{side}{k}-sorted", *([f"{side}{k - 1}"] if k else []))
        left = seen.where("known is not null")
    return reduce(DataFrame.unionByName, done)


def _places(lists, off: np.ndarray):
    """(absolute place, columns) of a list column of structs, of one chunk."""
    flat = lists.flatten()
    counts = np.diff(lists.offsets.to_numpy())
    cols = [flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(flat.type.num_fields)]
    return cols[0] + np.repeat(off[:-1], counts), cols[1:]


def open_windows(candidates: DataFrame) -> DataFrame:
    """``(tid, at, home, gram, name)``: the windows of the listed anchors that
    hold no string which is known to be unique."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo, hi, data, off in X.chunked(batch.column(1), CHUNK_BYTES):
                place, (first, last, gram, home, after, before) = _places(batch.column(2).slice(lo, hi - lo), off)
                row = _row_of(off, place)
                first, last = first + off[row], last + off[row]
                first = np.where(before > 0, np.maximum(first, place - before + 1), first)
                last = np.where(after > 0, np.minimum(last, place + after - LENGTH - 1), last)
                n = np.maximum(last - first + 1, 0)
                at = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
                row, gram, home = (np.repeat(x, n) for x in (row, gram, home))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array((at - off[row]).astype(np.int32)), pa.array(home > 0), pa.array(gram),
                                                  pa.array(X.as_long(X.span_hashes(data, at, at + LENGTH)))], names=["tid", "at", "home", "gram", "name"])
        X.release()

    return candidates.select("tid", "text", "places").mapInArrow(run, "tid long, at int, home boolean, gram long, name long")


def _cut(rows: DataFrame) -> DataFrame:
    """``(tid, spans)`` of ``(tid, n_bytes, settled, windows)``: the maximal
    runs of removed bytes."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                step = np.zeros(batch.column(1)[i].as_py() + 1, np.int64)
                settled = batch.column(2).slice(i, 1).flatten()
                lo, hi = (settled.field(j).to_numpy(zero_copy_only=False).astype(np.int64) for j in (0, 1))
                at = batch.column(3).slice(i, 1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                np.add.at(step, np.concatenate((lo, at)), 1)
                np.add.at(step, np.concatenate((hi, at)) + LENGTH, -1)
                edge = np.flatnonzero(np.diff(np.concatenate(([False], np.cumsum(step) > 0))))
                spans = pa.StructArray.from_arrays([pa.array(edge[::2].astype(np.int32)), pa.array(edge[1::2].astype(np.int32))], names=["start", "end"])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.ListArray.from_arrays(pa.array([0, len(spans)], pa.int32()), spans)], names=["tid", "spans"])
        X.release()

    return rows.select("tid", "n_bytes", "settled", "windows").mapInArrow(run, "tid long, spans array<struct<start:int,end:int>>")


def _of_text(rows: DataFrame, name: str, *cols) -> DataFrame:
    """One row a text with the list of its rows, at most as many as its bytes."""
    return rows.groupBy("tid").agg(F.collect_list(F.struct(*cols) if len(cols) > 1 else F.col(cols[0])).alias(name))


def repeated_bytes(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(rows, spans)``: ``docs`` with ``digest`` and ``n_bytes`` of the text,
    and ``(digest, copies, text, spans)`` of the texts that lose bytes."""
    s = Scratch(docs.sparkSession, "suffix-dedup")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumn("digest", F.sha2(text, 256)).withColumn("n_bytes", F.octet_length(text).cast("long"))
    texts = s.table(rows.select("digest", text.alias("text")).where(F.octet_length(text) >= LENGTH).groupBy("digest").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
                    .withColumn("tid", F.monotonically_increasing_id()), "texts")

    repeated = s.table(rerank(s.table(stretches(texts), "stretches"), ["name"], "inner", s, "gram").drop("name").withColumnRenamed("rank", "gram"), "repeated")
    s.drop("stretches", "gram-classes", "gram-sorted")
    ranked = s.table(rerank(repeated, ["gram", "stretch"], "left", s, "stretch", F.min(F.struct("tid", "at")).alias("first")), "ranked")
    s.drop("repeated", "stretch-classes", "stretch-sorted")
    settled = s.table(_of_text(ranked.where("rank is not null"), "settled", "lo", "hi"), "settled")
    single = ranked.where("rank is null").select("tid", "at", "lo", "hi", "gram", F.lit(0).alias("home"))
    homes = ranked.where((F.col("first.tid") == F.col("tid")) & (F.col("first.at") == F.col("at"))).select("tid", "at", "lo", "hi", "gram", F.lit(1).alias("home"))
    counts = single.groupBy("gram").agg(F.count("*").alias("times"))
    going = s.table(single.unionByName(_known(homes, counts.select("gram"), ["gram"], "inner", homes.groupBy("gram").agg(F.count("*").alias("times")))), "going")
    s.drop("ranked")
    place = ("at", "lo", "hi", "gram", "home")
    candidates = s.table(texts.select("tid", "text").join(_of_text(going, "places", *place), "tid"), "candidates")

    around = s.table(neighbourhoods(candidates), "around")
    after, before = (unique_lengths(around, side, steps, s).withColumnRenamed("alone", side) for side, steps in (("after", AFTER), ("before", BEFORE)))
    s.drop("around")
    limits = going.join(after, ["tid", "at"], "left").join(before, ["tid", "at"], "left").select("tid", *place, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("after", "before")))
    windows = s.table(open_windows(candidates.select("tid", "text").join(_of_text(limits, "places", *place, "after", "before"), "tid")), "windows")
    s.drop("going", "candidates")
    keys = ["gram", "name"]
    twice = s.table(windows.groupBy(*keys).agg(F.sum(F.when(F.col("home"), 2).otherwise(1)).alias("times")).where("times > 1"), "twice")
    hits = s.table(_of_text(_known(windows.where("not home"), twice, keys, "inner", twice), "windows", "at"), "hits")
    s.drop("windows", "twice")

    sizes = texts.where("copies = 1").select("tid", F.octet_length("text").alias("n_bytes"))
    spans = sizes.join(settled, "tid", "left").join(hits, "tid", "left").where("settled is not null or windows is not null")
    lost = s.table(_cut(spans.select("tid", "n_bytes", F.coalesce("settled", F.expr("cast(array() as array<struct<lo:int,hi:int>>)")).alias("settled"), F.coalesce("windows", F.expr("cast(array() as array<int>)")).alias("windows"))), "lost")
    whole = texts.where("copies > 1").withColumn("spans", F.array(F.struct(F.lit(0).alias("start"), F.octet_length("text").alias("end"))))
    return rows, whole.select("digest", "copies", "text", "spans").unionByName(texts.where("copies = 1").join(lost, "tid").select("digest", "copies", "text", "spans"))


def digest(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    rows, spans = repeated_bytes(docs.select(id_col, "text"))
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    body = F.encode("text", "UTF-8")
    # the bytes between the spans: from each span's end to the next one's start
    starts = F.concat(F.array(F.lit(0)), F.col("spans.end"))
    ends = F.concat(F.col("spans.start"), F.array(F.octet_length("text")))
    kept = F.array_join(F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda p: F.hex(F.substring(body, p["s"] + 1, p["e"] - p["s"]))), "")
    lost = spans.select("digest", "copies", length.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2(F.unhex(kept), 256).alias("kept_sha256"))
    known = salted_join(rows.drop("text"), lost, ["digest"], "left", hot_rows=HOT_ROWS, hot=lost.where(F.col("copies") >= HOT_ROWS).select("digest"))
    return known.select(id_col, "n_bytes", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_removed", "n_spans")), F.coalesce("kept_sha256", "digest").alias("kept_sha256"))
