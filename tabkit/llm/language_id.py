"""Language ID by interpolated Kneser-Ney character models.

Texts become lower-case letters with one space for every run of anything
else. One model of ``ORDER`` characters per language is learned from all
training texts: Spark counts the n-grams, the lower orders are Kneser-Ney
continuation counts. All models share arrays sorted by the hash of the
n-gram (with an index on the leading hash bits) that hold one log
probability per language. No n-gram is left out, however rare: the driver
and every worker hold all distinct ones. The prediction is the language with the lowest
cross-entropy per character.

Rejection is calibrated on all training texts: per language, the mean
cross-entropy and its spread as a function of length; a text is rejected if
even its best language lies ``REJECT_DEVIATIONS`` spreads above the mean, or
if it has no letter.

Null and letterless texts (and every text, if no language could be
learned): ``und``, score 0, rejected. A null id is never learned from and
not held out. Rows with a null language are not learned from. Repeated rows
count as often as they occur. Empty tables give no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from tabkit.llm import textops as X

ORDER = 4
# The score's scale is the one of these with the least loss over all training texts.
SCALES = (0.02, 0.05, 0.1, 0.2, 0.5, 1.0)
# Medians of the rejection limits are within a rank of one in this many of the true ones.
MEDIAN_ACCURACY = 100_000
REJECT_DEVIATIONS = 10.0
UNKNOWN = "und"
# So many n-grams are scored at a time.
SCORED_GRAMS = 1 << 16

_U = np.uint64
_SPACE = 32
_tables: list[np.ndarray] = []


def _letters() -> list[np.ndarray]:
    if not _tables:
        low, alpha = np.arange(1 << 16, dtype=np.uint16), np.zeros(1 << 16, bool)
        for c in range(1 << 16):
            ch = chr(c)
            if ch.isalpha():
                alpha[c] = True
                l = ch.lower()
                if len(l) == 1:
                    low[c] = ord(l)
        _tables.extend((low, alpha))
    return _tables


def symbols(data: np.ndarray, offsets: np.ndarray):
    """(symbols, per_row): 16-bit symbols of each text after ``ORDER - 1``
    leading spaces; per_row without those, 0 for a text without letters.
    Letters beyond the basic plane share one symbol."""
    low, alpha = _letters()
    lead = ORDER - 1
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    first = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
    high = points > 0xFFFF
    if high.any():
        kinds, back = np.unique(points[high], return_inverse=True)
        known = np.array([chr(c).isalpha() for c in kinds])[back]
        points = points.copy()
        points[high] = np.where(known, 0xFFFF, _SPACE)
    letter = alpha[points]
    letter |= points == 0xFFFF
    after = np.concatenate(([False], letter[:-1]))
    after[first[:-1][first[:-1] < len(points)]] = False
    keep = letter | after
    kept = np.concatenate(([0], np.cumsum(keep)))[first]
    per_row = np.diff(kept)
    out = np.full(len(per_row) * lead + kept[-1], _SPACE, np.uint16)
    at = np.arange(kept[-1]) + np.repeat((np.arange(len(per_row)) + 1) * lead, per_row)
    out[at] = np.where(letter, low[np.minimum(points, 0xFFFF)], _SPACE)[keep]
    return out, per_row


def grams(sym: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    """The packed ``ORDER``-gram that ends at each symbol of each text."""
    lead = ORDER - 1
    s = sym.astype(_U)
    packed = np.zeros(max(0, len(s) - lead), _U)
    for k in range(ORDER):
        packed |= s[k:k + len(packed)] << _U(16 * (lead - k))
    at = np.arange(per_row.sum()) + np.repeat(np.arange(len(per_row)) * lead, per_row)
    return packed[at]


def count_grams(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """``(lang, gram, n)`` over all rows."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        X.release()
        held: dict[str, list] = {}

        def merged(parts):
            keys, n = (np.concatenate(x) for x in zip(*parts))
            k, back = np.unique(keys, return_inverse=True)
            return k, np.bincount(back, n, len(k)).astype(np.int64)

        def emit():
            for lang, parts in held.items():
                k, n = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(X.as_long(k)), pa.array(n)], names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lo, hi, data, off in X.chunked(batch.column(1)):
                sym, n = symbols(data, off)
                g = grams(sym, n)
                owner = np.repeat(np.arange(hi - lo), n)
                for lang in set(langs[lo:hi]):
                    own = g[(langs[lo:hi] == lang)[owner]]
                    if len(own):
                        held.setdefault(lang, []).append(np.unique(own, return_counts=True))
                for lang, parts in held.items():
                    if len(parts) > 8:
                        held[lang] = [merged(parts)]
            if sum(len(p[0]) for parts in held.values() for p in parts) > 1_000_000:
                yield from emit()
        yield from emit()

    return (docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
            .mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))


class HashArray:
    """Packed n-grams sorted by hash; finds the place of many at once."""

    BITS = 18

    def __init__(self, keys: np.ndarray):
        h = X.mix(keys)  # a bijection: no two keys share a hash
        self.hashes = np.sort(h)
        self.index = np.searchsorted(self.hashes >> _U(64 - self.BITS), np.arange((1 << self.BITS) + 1, dtype=_U))
        self.depth = int(np.diff(self.index).max()) if len(keys) else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places in the sorted arrays, -1 where absent."""
        out = np.full(len(keys), -1, np.int64)
        if not self.depth:
            return out
        h = X.mix(keys)
        bucket = (h >> _U(64 - self.BITS)).astype(np.int64)
        at, end = self.index[bucket], self.index[bucket + 1]
        rest = np.flatnonzero(at < end)
        at, end, h = at[rest], end[rest], h[rest]
        while len(rest):
            hit = self.hashes[at] == h
            out[rest[hit]] = at[hit]
            go = ~hit & (at + 1 < end)
            rest, at, end, h = rest[go], at[go] + 1, end[go], h[go]
        return out


def _suffix(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & _U((1 << (16 * order)) - 1)


class Model:
    """Per order: a table of n-grams with a log probability per language,
    and a table of contexts with a log back-off weight per language."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        per_order: dict[int, list] = {o: [] for o in range(1, ORDER + 1)}
        for lang in self.langs:
            keys, n = counts[lang]
            for order in range(ORDER, 0, -1):
                per_order[order].append((keys, n))
                if order > 1:
                    keys, n = np.unique(_suffix(keys, order - 1), return_counts=True)
        symbols_seen = len(np.unique(np.concatenate([k for k, _ in per_order[1]])))
        self.floor = np.full(len(self.langs), -np.log(symbols_seen + 1), np.float64)
        self.grams: dict[int, tuple[HashArray, np.ndarray]] = {}
        self.contexts: dict[int, tuple[HashArray, np.ndarray]] = {}
        for order in range(1, ORDER + 1):
            union = np.unique(np.concatenate([k for k, _ in per_order[order]]))
            heads = np.unique(union >> _U(16))
            lower = self._lower(order, union)
            prob, weight = np.empty((len(union), len(self.langs)), np.float32), np.zeros((len(heads), len(self.langs)), np.float32)
            for j, (keys, n) in enumerate(per_order[order]):
                ones, twos = (n == 1).sum(), (n == 2).sum()
                discount = ones / (ones + 2 * twos) if ones and twos else 0.75
                at = np.searchsorted(heads, keys >> _U(16))
                total, kinds = np.bincount(at, n, len(heads)), np.bincount(at, minlength=len(heads))
                seen = total > 0
                gamma = np.where(seen, discount * kinds / np.where(seen, total, 1), 1.0)
                weight[:, j] = np.log(gamma)
                head = np.searchsorted(heads, union >> _U(16))
                p = gamma[head] * np.exp(lower[:, j])
                own = np.searchsorted(union, keys)
                p[own] += np.maximum(n - discount, 0) / total[at]
                prob[:, j] = np.log(p)
            table, ctx = HashArray(union), HashArray(heads)
            self.grams[order] = (table, prob[np.argsort(X.mix(union))])
            self.contexts[order] = (ctx, weight[np.argsort(X.mix(heads))])

    def _lower(self, order: int, keys: np.ndarray) -> np.ndarray:
        if order == 1:
            return np.broadcast_to(self.floor, (len(keys), len(self.langs)))
        return self.log_prob(_suffix(keys, order - 1), order - 1)

    def log_prob(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """(len(keys), languages) log probabilities of the last symbols."""
        table, prob = self.grams[order]
        at = table.find(keys)
        out = prob[at] if len(prob) else np.zeros((len(keys), len(self.langs)), np.float32)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            ctx, weight = self.contexts[order]
            head = ctx.find(keys[missing] >> _U(16))
            out[missing] = self._lower(order, keys[missing]) + np.where(head[:, None] >= 0, weight[head], 0)
        return out

    def cross_entropy(self, data: np.ndarray, offsets: np.ndarray):
        """(rows, languages) nats per symbol, and the symbols of each row."""
        sym, n = symbols(data, offsets)
        keys, owner = grams(sym, n), np.repeat(np.arange(len(n), dtype=np.int32), n)
        total = np.zeros((len(n), len(self.langs)))
        for lo in range(0, len(keys), SCORED_GRAMS):
            rows = owner[lo:lo + SCORED_GRAMS]
            starts = np.flatnonzero(np.diff(rows, prepend=-1))
            total[rows[starts]] += np.add.reduceat(self.log_prob(keys[lo:lo + SCORED_GRAMS]), starts, axis=0, dtype=np.float64)
        return -total / np.maximum(n, 1)[:, None], n


def _calibration(docs: DataFrame, shared, lang_col: str, text_col: str) -> DataFrame:
    """For each text with a letter: the place of its language, whether that
    is the predicted one, its symbols, the cross-entropy under its language
    and the loss of each of ``SCALES``."""
    names = ["own", "right", "k", "e", *(f"loss_{i}" for i in range(len(SCALES)))]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        X.release()
        model = shared.value[0]
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lo, hi, data, off in X.chunked(batch.column(1)):
                ce, n = model.cross_entropy(data, off)
                some = n > 0
                ce, k, own = ce[some], n[some].astype(float), np.searchsorted(model.langs, langs[lo:hi][some].astype(str))
                rows = np.arange(len(k))
                z = [(ce.min(axis=1, keepdims=True) - ce) * t * k[:, None] for t in SCALES]
                losses = [np.log(np.exp(x).sum(axis=1)) - x[rows, own] for x in z]
                yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int64)), pa.array(ce.argmin(axis=1) == own), pa.array(k), pa.array(ce[rows, own]), *map(pa.array, losses)], names=names)

    schema = "own long, right boolean, " + ", ".join(f"{c} double" for c in names[2:])
    return docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang"):
    """``(model, limits, scale)`` learned from ``docs``, or None without a
    labelled text. limits: per language mean, spread of long texts and
    spread per symbol of the cross-entropy."""
    spark = docs.sparkSession
    counts = count_grams(docs, lang_col, text_col).cache()
    split = {}
    for lang in sorted(r.lang for r in counts.select("lang").distinct().collect()):
        rows = counts.where(F.col("lang") == lang).select("gram", "n").toArrow()
        keys, n = rows.column("gram").to_numpy().view(_U), rows.column("n").to_numpy()
        order = np.argsort(keys)
        split[lang] = (keys[order], n[order])
    counts.unpersist()
    if not split:
        return None
    model = Model(split)

    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    shared = spark.sparkContext.broadcast((model,))
    texts = _calibration(labelled, shared, lang_col, text_col).cache()
    median = lambda c: F.percentile_approx(c, 0.5, MEDIAN_ACCURACY)
    root, right = F.sqrt("k"), F.col("right")
    per_lang = texts.groupBy("own").agg(F.avg("e").alias("any"), (F.sum(F.when(right, F.col("e") * root)) / F.sum(F.when(right, root))).alias("mean"),
                                        median(F.when(right, F.col("k"))).alias("half"), *[F.sum(f"loss_{i}").alias(f"loss_{i}") for i in range(len(SCALES))]).collect()
    limits = np.tile([0.0, 1.0, 1.0], (len(model.langs), 1))
    scale = 1.0
    if per_lang:
        scale = SCALES[int(np.argmin([sum(r[f"loss_{i}"] for r in per_lang) for i in range(len(SCALES))]))]
        for r in per_lang:
            limits[r.own] = r.any, 1.0, 1.0
        found = spark.createDataFrame([(r.own, r.mean, r.half) for r in per_lang], "own long, mean double, half double")
        off = F.abs(F.col("e") - F.col("mean"))
        for r in (texts.where(right).join(F.broadcast(found), "own").groupBy("own")
                  .agg(F.first("mean").alias("mean"), median(F.when(F.col("k") >= F.col("half"), off)).alias("long"), median(off * root).alias("per")).collect()):
            limits[r.own] = r.mean, max(0.15, 1.4826 * r.long), max(0.5, 1.4826 * r.per)
    texts.unpersist()
    shared.destroy()
    return model, limits, scale


def _predicted(docs: DataFrame, learned, text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` as ``_kept_0, ...`` and the four results."""
    own = [f"_kept_{i}" for i in range(len(keep))]
    source = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, own)])
    added = [T.StructField("_lang", T.StringType()), T.StructField("_score", T.DoubleType()), T.StructField("_rejected", T.BooleanType()), T.StructField("_entropy", T.DoubleType())]
    if learned is None:
        return source.select("*", F.lit(UNKNOWN).alias("_lang"), F.lit(0.0).alias("_score"), F.lit(True).alias("_rejected"), F.lit(None).cast("double").alias("_entropy"))
    shared, at = docs.sparkSession.sparkContext.broadcast(learned), keep.index(text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        X.release()
        model, limits, scale = shared.value
        langs = np.array([*model.langs, UNKNOWN], object)
        for batch in batches:
            for lo, hi, data, off in X.chunked(batch.column(at)):
                ce, n = model.cross_entropy(data, off)
                best = ce.argmin(axis=1)
                low = ce[np.arange(len(n)), best]
                score = 1 / np.exp(-(ce - low[:, None]) * scale * n[:, None]).sum(axis=1)
                mean, spread, per = limits[best].T
                rejected = (n == 0) | (low > mean + REJECT_DEVIATIONS * np.sqrt(spread ** 2 + per ** 2 / np.maximum(n, 1)))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(len(keep))), pa.array(langs[np.where(n > 0, best, len(langs) - 1)], pa.string()),
                                                  pa.array(np.where(n > 0, score, 0.0)), pa.array(rejected), pa.array(low, mask=n == 0)], names=[*own, *(f.name for f in added)])

    return source.mapInArrow(run, T.StructType(source.schema.fields + added))


def predict(docs: DataFrame, learned, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score, rejected, entropy`` (the best
    cross-entropy) of every row."""
    return _predicted(docs, learned, text_col, [id_col, text_col]).select(
        F.col("_kept_0").alias(id_col), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"), F.col("_rejected").alias("rejected"), F.col("_entropy").alias("entropy"))


def accepted(docs: DataFrame, learned, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    return _predicted(docs, learned, text_col, docs.columns).where("not _rejected").select(*[F.col(f"_kept_{i}").alias(c) for i, c in enumerate(docs.columns)])


def held_out(id_col: str, folds: int, fold: int):
    """True for ids whose CRC-32 (as text) falls into the fold; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def learnable(docs: DataFrame, id_col: str, folds: int, fold: int) -> DataFrame:
    return docs.where(F.col(id_col).isNotNull() & ~held_out(id_col, folds, fold))
