"""Sequence packing as a cutting-stock problem, by column generation.

1. Documents become token ids (the tokenizer's, then one end id). A document
   is cut into full sequences and one remainder; each such piece falls into
   a size class of ``UNIT`` tokens.
2. The histogram of the classes (at most ``capacity / UNIT`` counts, whatever
   the input) is the demand of a linear program whose columns are patterns:
   how many pieces of each class share a sequence. New columns are priced
   by a knapsack dynamic program over the dual values until the bound says
   that no plan needs notably fewer sequences.
3. Pattern counts are rounded down; patterns that fill less than
   ``MIN_FILL`` are left out. Pieces are ranked inside their class (per
   input partition, then offsets by the partitions' counts) and a pattern
   takes the next ranks of its classes.
4. Pieces beyond the planned ranks are laid end to end and cut at sequence
   ends (at multiples of ``CUT`` tokens of the piece, whose prefix checksums
   are kept, so that no text is tokenized twice).

A null text is an empty one: its only id is the end id. Repeated rows and
ids are packed like others; a null id stays null. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tabkit.llm import textops as X
from tabkit.scratch import Scratch

CAPACITY = 2048
UNIT = 8
CUT = 16
END_ID = 1
MIN_FILL = 0.98
GAP = 2e-3
CACHE_WORDS = 1 << 19

# Separators at which every text may be split before tokenizing (the
# tokenizer drops white space, and no rule of it looks across).
_BLANK = X.byte_table([0x20, 0x09, 0x0A, 0x0D])
# Its rules also part ASCII letters and digits from ASCII signs. The
# apostrophe is left out: it may open a suffix.
_ALNUM = X.byte_table([*range(48, 58), *range(65, 91), *range(97, 123)])
_SIGN = X.byte_table([c for c in range(33, 127) if not _ALNUM[c] and c != 39])
# Strings that the tokenizer takes as one id.
_SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")


def _words(data: np.ndarray, offsets: np.ndarray, raw: bytes):
    """(bytes, starts, ends, per_row): the parts that can be tokenized by
    themselves. Words of ASCII only are lower-cased, as the tokenizer does."""
    starts, ends, per_row = X.spans(data, offsets, _BLANK)
    if any(x in raw for x in _SPECIAL) or not len(starts):
        return data, starts, ends, per_row
    alnum, sign = _ALNUM[data], _SIGN[data]
    cut = np.flatnonzero((alnum[:-1] & sign[1:]) | (sign[:-1] & alnum[1:])) + 1
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    cut = cut[~first[cut]]
    per_row = per_row + np.diff(np.searchsorted(cut, offsets))
    starts, ends = np.sort(np.concatenate((starts, cut))), np.sort(np.concatenate((ends, cut)))
    wide = np.concatenate(([0], np.cumsum(data >= 128)))
    wide = wide[ends] > wide[starts]
    edge = np.zeros(len(data) + 1, np.int8)
    np.add.at(edge, starts[wide], 1)
    np.add.at(edge, ends[wide], -1)
    return np.where(np.cumsum(edge[:-1], dtype=np.int8) > 0, data, X.ASCII_LOWER[data]), starts, ends, per_row


class WordEncoder:
    """Token ids of blank-separated words, each distinct word encoded once."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self):
        self.keys = np.zeros(0, np.uint64)
        self.first, self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """(ids, per_row) of the texts."""
        data, starts, ends, words = _words(data, offsets, data.tobytes())
        h = X.span_hashes(data, starts, ends)
        distinct, where, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_WORDS:
            self.clear()
        at = np.searchsorted(self.keys, distinct)
        new = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] != distinct) if len(self.keys) else np.arange(len(distinct))
        if len(new):
            raw = data.tobytes()
            encoded = [e.ids for e in self.tokenizer.encode_batch([raw[starts[i]:ends[i]].decode("utf-8", "replace") for i in where[new]], add_special_tokens=False)]
            n = np.array([len(e) for e in encoded], np.int64)
            first = len(self.ids) + np.cumsum(n) - n
            self.ids = np.concatenate((self.ids, np.array([i for e in encoded for i in e], np.uint32)))
            keys = np.concatenate((self.keys, distinct[new]))
            order = np.argsort(keys, kind="stable")
            self.keys, self.first, self.count = keys[order], np.concatenate((self.first, first))[order], np.concatenate((self.count, n))[order]
            at = np.searchsorted(self.keys, distinct)
        first, n = self.first[at][back], self.count[at][back]
        total = np.concatenate(([0], np.cumsum(n)))
        ids = self.ids[np.arange(total[-1]) + np.repeat(first - total[:-1], n)]
        row = np.concatenate(([0], np.cumsum(words)))
        return ids, total[row[1:]] - total[row[:-1]]


def prefix_checksums(ids: np.ndarray) -> np.ndarray:
    """CRC-32 after each ``CUT`` ids (little-endian 32-bit), and at the end."""
    raw, out, crc = ids.astype("<u4").tobytes(), [], 0
    for i in range(0, len(raw), 4 * CUT):
        crc = zlib.crc32(raw[i:i + 4 * CUT], crc)
        out.append(crc)
    return np.array(out, np.uint32)


def _shifts(n: int) -> np.ndarray:
    """Row k: what k zero bytes do to each single bit of a checksum."""
    out = np.zeros((n + 1, 32), np.uint32)
    out[0] = np.uint32(1) << np.arange(32, dtype=np.uint32)
    table = np.array([zlib.crc32(bytes([i])) ^ zlib.crc32(b"\0") for i in range(256)], np.uint32)
    for k in range(n):
        out[k + 1] = (out[k] >> np.uint32(8)) ^ table[out[k] & np.uint32(255)]
    return out


def inner_checksum(before: np.ndarray, whole: np.ndarray, n_bytes: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """CRC-32 of the last ``n_bytes`` of data whose checksum is ``whole``
    and whose checksum without them is ``before``."""
    out = whole.astype(np.uint32).copy()
    for bit in range(32):
        out ^= np.where((before >> np.uint32(bit)) & np.uint32(1), shifts[n_bytes, bit], np.uint32(0)).astype(np.uint32)
    return out


def cut_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``part, turn, id, doc_tokens, start, length,
    size, rank, crc, prefix``. rank counts inside (part, size); turn inside
    part. prefix holds the remainder's prefix checksums."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType)] + [T.StructField(n, T.LongType()) for n in ("part", "turn", "doc_tokens", "start", "length", "size", "rank", "crc")] + [T.StructField("prefix", T.BinaryType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, turn = TaskContext.get().partitionId(), 0
        seen = np.zeros(capacity // UNIT + 1, np.int64)
        enc = X.kept(("packing", tokenizer), lambda: WordEncoder(tokenizer))
        for batch in batches:
            for lo, hi, data, off in X.chunked(batch.column(1)):
                ids, n = enc.encode(data, off)
                first = np.concatenate(([0], np.cumsum(n)))
                whole = n + 1
                pieces = -(-whole // capacity)
                row = np.repeat(np.arange(hi - lo), pieces)
                k = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = k * capacity
                length = np.minimum(capacity, whole[row] - start)
                size = -(-length // UNIT)
                crc, prefix = np.zeros(len(row), np.int64), [None] * len(row)
                for i, (r, s, m) in enumerate(zip(row.tolist(), start.tolist(), length.tolist())):
                    own = ids[first[r] + s:min(first[r] + s + m, first[r + 1])]
                    if s + m == whole[r]:
                        own = np.append(own, np.uint32(END_ID))
                    if m == capacity:
                        crc[i] = zlib.crc32(own.astype("<u4").tobytes())
                    else:
                        sums = prefix_checksums(own)
                        crc[i], prefix[i] = sums[-1], sums.tobytes()
                order = np.argsort(size, kind="stable")
                sorted_size = size[order]
                new = np.flatnonzero(np.diff(sorted_size, prepend=-1))
                rank = np.empty(len(row), np.int64)
                rank[order] = np.arange(len(row)) - np.repeat(new, np.diff(np.append(new, len(row)))) + seen[sorted_size]
                seen += np.bincount(size, minlength=len(seen))
                ids_col = batch.column(0).slice(lo, hi - lo).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([ids_col, pa.array(np.full(len(row), part)), pa.array(turn + np.arange(len(row))), pa.array(whole[row]), pa.array(start), pa.array(length),
                                                  pa.array(size), pa.array(rank), pa.array(crc), pa.array(prefix, pa.binary())], names=schema.names)
                turn += len(row)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int):
    """The most valuable multiset of sizes within ``capacity``."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    values, ordered = values[order], sizes[order]
    for room in range(1, capacity + 1):
        fit = int(np.searchsorted(ordered, room, "right"))
        best[room], pick[room] = best[room - 1], -2
        if fit:
            total = best[room - ordered[:fit]] + values[:fit]
            i = int(np.argmax(total))
            if total[i] > best[room] + 1e-12:
                best[room], pick[room] = total[i], i
    count = np.zeros(len(sizes))
    room = capacity
    while room > 0:
        if pick[room] >= 0:
            count[order[pick[room]]] += 1
            room -= ordered[pick[room]]
        else:
            room -= 1
    return best[capacity], count


def patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP):
    """(columns, times): a basic solution of the cutting-stock relaxation,
    one column per row of ``columns`` (pieces of each size), used ``times``
    times. Stops when a bound (z / price, or the sum of all sizes) shows at
    most ``gap`` to gain."""
    least = (sizes * demand).sum() / capacity
    m = len(sizes)
    per = np.maximum(1, capacity // sizes).astype(float)
    columns = np.diag(per)
    inverse = np.diag(1 / per)
    x = demand / per
    turn = 0
    while True:
        dual = np.maximum(inverse.sum(axis=0), 0)
        price, column = _knapsack(dual, sizes, capacity)
        if price <= 1 + gap or x.sum() <= (1 + gap) * least:
            return columns.T, x
        d = np.einsum("ij,j->i", inverse, column)
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        r = int(np.argmin(ratio))
        columns[:, r] = column
        step = ratio[r]
        x = np.maximum(x - step * d, 0)
        x[r] = step
        inverse[r] /= d[r]
        others = np.arange(m) != r
        inverse[others] -= np.outer(d[others], inverse[r])
        turn += 1
        if turn % 100 == 0:
            # one Newton step takes rounding errors out (einsum: small, and without threads)
            inverse += np.einsum("ij,jk->ik", inverse, np.eye(m) - np.einsum("ij,jk->ik", columns, inverse))
            x = np.maximum(np.einsum("ij,j->i", inverse, demand), 0)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, min_fill: float = MIN_FILL):
    """(intervals, sequences) from ``{size class: pieces}``. An interval
    (size, first rank, last rank + 1, first sequence, pieces a sequence)
    says where the ranks of a class go; ranks beyond all are not planned."""
    units = capacity // UNIT
    out, sequences = [], 0
    if not histogram:
        return out, 0
    sizes = np.array(sorted(histogram))
    demand = np.array([histogram[s] for s in sizes], float)
    columns, times = patterns(sizes, demand, units)
    used = np.zeros(len(sizes), np.int64)
    demand = demand.astype(np.int64)
    for column, n in zip(columns.astype(np.int64), times):
        n = int(n + 1e-6)
        has = np.flatnonzero(column)
        if not n or (column * sizes).sum() < min_fill * units:
            continue
        n = min(n, *((demand[has] - used[has]) // column[has]).tolist())
        if n <= 0:
            continue
        for i in has:
            out.append((int(sizes[i]), int(used[i]), int(used[i] + n * column[i]), sequences, int(column[i])))
            used[i] += n * column[i]
        sequences += n
    return out, sequences


def _assign(ranked: DataFrame, intervals: list[tuple]) -> DataFrame:
    """Adds ``sequence`` (null where no pattern takes the rank)."""
    spark = ranked.sparkSession
    plan_df = spark.createDataFrame(intervals, "size long, lo long, hi long, seq long, each long")
    # at most (capacity / UNIT)^2 rows: a basis has one column per size class
    return (ranked.join(F.broadcast(plan_df), [ranked["size"] == plan_df["size"], ranked["rank"] >= plan_df["lo"], ranked["rank"] < plan_df["hi"]], "left")
            .drop(plan_df["size"]).withColumn("sequence", F.expr("seq + (rank - lo) div each")).drop("lo", "hi", "seq", "each"))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``."""
    s = Scratch(docs.sparkSession, "packing")
    pieces = s.table(cut_documents(docs, tokenizer, id_col, text_col, capacity), "pieces")
    counts = s.table(pieces.groupBy("part", "size").agg(F.count("*").alias("n")), "counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("size").agg(F.sum("n")).collect()}  # at most capacity / UNIT rows
    intervals, sequences = plan(histogram, capacity)

    before = F.sum("n").over(Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shift = counts.select("part", "size", F.coalesce(before, F.lit(0)).alias("shift"))
    ranked = (pieces.join(shift, ["part", "size"]).withColumn("rank", F.col("rank") + F.col("shift")).drop("shift"))
    placed = s.table(_assign(ranked, intervals), "placed")
    whole = placed.where("sequence is not null").select("id", "start", "length", "crc", "doc_tokens", "sequence", F.col("size").alias("at"), F.col("rank").alias("at2"))

    rest = placed.where("sequence is null").withColumn("units", F.ceil(F.col("length") / CUT))
    per_part = rest.groupBy("part").agg(F.sum("units").alias("units"))
    base = per_part.select("part", F.coalesce(F.sum("units").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("units").over(Window.partitionBy("part").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    room = capacity // CUT
    laid = (rest.withColumn("inside", inside).join(base, "part").withColumn("q", F.col("base") + F.col("inside"))
            .withColumn("k", F.explode(F.expr(f"sequence(q div {room}, (q + units - 1) div {room})")))
            .withColumn("from_unit", F.expr(f"greatest(q, k * {room}) - q")).withColumn("to_unit", F.expr(f"least(q + units, (k + 1) * {room}) - q")))
    shifts = _shifts(4 * capacity)

    def sums(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            a, b, n = (col[c].to_numpy() for c in ("from_unit", "to_unit", "length"))
            first, last = a * CUT, np.minimum(b * CUT, n)
            whole = [np.frombuffer(p, np.uint32) if p is not None else None for p in col["prefix"].to_pylist()]
            crc = np.array([c if p is None else p[j - 1] for p, j, c in zip(whole, b, col["crc"].to_pylist())], np.uint32)
            lead = np.array([0 if p is None or not i else p[i - 1] for p, i in zip(whole, a)], np.uint32)
            cut = a > 0
            crc[cut] = inner_checksum(lead[cut], crc[cut], 4 * (last - first)[cut], shifts)
            yield pa.RecordBatch.from_arrays([col["id"], pa.array(col["start"].to_numpy() + first), pa.array(last - first), pa.array(crc.astype(np.int64)), col["doc_tokens"],
                                              pa.array(col["k"].to_numpy() + sequences), pa.array(col["q"].to_numpy()), pa.array(a)], names=whole_names)

    whole_names = whole.columns
    cut = (laid.withColumn("prefix", F.when(F.col("length") < capacity, F.col("prefix")))
           .select("id", "start", "length", "crc", "prefix", "doc_tokens", "k", "q", "from_unit", "to_unit").mapInArrow(sums, whole.schema))
    ends = Window.partitionBy("sequence").orderBy("at", "at2").rowsBetween(Window.unboundedPreceding, -1)
    return whole.union(cut).select(
        F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", F.col("sequence").alias("sequence_id"),
        F.coalesce(F.sum("length").over(ends), F.lit(0).cast("long")).alias("offset"))
