"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes
log-count ratios.

Texts become lower-case letters with single spaces; features are whether an
n-gram of ``ORDERS`` characters occurs, hashed into ``BUCKETS``. Over all
distinct labelled texts Spark counts, per bucket, the texts of either label.
Every bucket whose likelihood ratio statistic passes ``SIGNIFICANCE`` becomes
a feature whose value is its log-count ratio. A logistic regression over
these values is fitted in Spark on at most about ``FIT_ROWS`` of the distinct
texts and scores every text.

Null and empty texts have no feature and get the score of the intercept. A
null label, a null id and an id without a text or label are not learned
from. Without labels of both kinds every score is the share of label 1
(0.5 without labels). Copies of a text are learned from once per label and
scored as often as they occur. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from tabkit.llm import textops as X
from tabkit.llm.language_id import symbols
from tabkit.scratch import Scratch

ORDERS = (3, 4, 5)
BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
SIGNIFICANCE = 11.0
FIT_ROWS = 10_000
PENALTY = 1.0
# Bytes of text whose n-grams are sorted at a time.
CHUNK_BYTES = 1 << 18
STEPS = 200
# The sample is fitted by so few tasks that their gradients are summed without a shuffle.
FIT_TASKS = 4
# Bits of the filter that keeps texts without a label out of the exchange.
FILTER_BITS = 26

_U = np.uint64
_PLACE = X._stream(31, 16) | _U(1)


def _grams(data: np.ndarray, offsets: np.ndarray):
    """Per order: (bucket, row) of each n-gram of each text."""
    sym, n = symbols(data, offsets)
    lead = len(sym) and (len(sym) - int(n.sum())) // max(1, len(n))
    first = np.concatenate(([0], np.cumsum(n + lead)))[:-1] + max(0, lead - 1)
    s = sym.astype(_U)
    for order in ORDERS:
        count = np.where(n > 0, np.maximum(n + 1 - order + 1, 0), 0)
        at = np.arange(count.sum()) + np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count)
        h = np.full(max(0, len(s) - order + 1), order, _U)
        for k in range(order):
            h += s[k:k + len(h)] * _PLACE[k]
        yield (X.mix(h[at]) >> _U(64 - BUCKET_BITS)).astype(np.int64), np.repeat(np.arange(len(n)), count)


def _distinct(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None):
    """(row, bucket) of the distinct buckets of each text, of the wanted ones only if given."""
    parts = []
    narrow = len(offsets) - 1 <= 1 << (32 - BUCKET_BITS)  # rows and buckets fit 32 bits, which sort faster
    for bucket, row in _grams(data, offsets):
        if wanted is not None:
            keep = wanted[bucket]
            bucket, row = bucket[keep], row[keep]
        pairs = row << BUCKET_BITS | bucket
        parts.append(pairs.astype(np.uint32) if narrow else pairs)
    pairs = np.concatenate(parts)
    pairs.sort()
    pairs = pairs[np.concatenate(([True], pairs[1:] != pairs[:-1]))[:len(pairs)]].astype(np.int64)
    return pairs >> BUCKET_BITS, pairs & (BUCKETS - 1)


def count_buckets(labelled: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """``(bucket, neg, pos)``: texts of either label with an n-gram of the bucket."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, data, off in X.chunked(batch.column(0), CHUNK_BYTES):
                row, bucket = _distinct(data, off)
                for y in (0, 1):
                    seen[y] += np.bincount(bucket[label[lo:hi][row] == y], minlength=BUCKETS)
        has = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(seen[0, has]), pa.array(seen[1, has])], names=["bucket", "neg", "pos"])

    return (labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")).mapInArrow(run, "bucket long, neg long, pos long")
            .groupBy("bucket").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")))


def _bitmap(keys: DataFrame) -> np.ndarray:
    """A bitmap in which the leading ``FILTER_BITS`` bits of every ``key`` are set."""
    bit = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    words = (keys.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
             .toArrow())  # at most 2^20 rows
    bitmap = np.zeros(1 << (FILTER_BITS - 6), _U)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(_U)
    return bitmap


def labelled_texts(docs: DataFrame, labels: DataFrame, s: Scratch, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``(text, label)``, once for each distinct text and label.

    Ids, two hashes of the text and labels are joined as narrow rows, and one
    id is chosen for each text and label. Only texts of chosen rows are
    shuffled: a bitmap of their keys drops the others before the exchange
    (its false hits go in the join)."""
    known = docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    keyed = known.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"), F.xxhash64(F.lit(1), text_col).alias("h2"))
    marks = (labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).cast(docs.schema[id_col].dataType).alias("id"), F.col(label_col).cast("int").alias("label"))
             .distinct().hint("merge"))  # one plan at every size
    chosen = (keyed.select("id", "h", "h2").join(marks, "id").groupBy("h", "h2", "label").agg(F.min("id").alias("id"))
              .select("id", "h", "h2", "label", F.xxhash64("id", "h", "h2").alias("key")))
    chosen = s.table(chosen, "chosen")
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(chosen))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("text", docs.schema[text_col].dataType)]
                          + [T.StructField(n, T.LongType()) for n in ("h", "h2", "key")])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            bit = batch.column("key").to_numpy().view(_U) >> _U(64 - FILTER_BITS)
            has = shared.value[(bit >> _U(6)).astype(np.int64)] >> (bit & _U(63)) & _U(1)
            yield batch.filter(pa.array(has.astype(bool)))

    same = ["id", "h", "h2"]
    texts = keyed.withColumn("key", F.xxhash64(*same)).mapInArrow(run, schema).drop("key").dropDuplicates(same)
    return texts.join(chosen.drop("key").hint("merge"), same).select("text", "label")


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """``(weight per bucket, intercept)`` learned from rows with a text and a label."""
    known = labelled.where(F.col(text_col).isNotNull() & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    return fit(known.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")).distinct(), Scratch(labelled.sparkSession, "toxicity"))


def train_joined(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """What ``train`` learns from the join of ``docs`` and ``labels`` by ``id_col``."""
    s = Scratch(docs.sparkSession, "toxicity")
    return fit(labelled_texts(docs, labels, s, id_col, text_col, label_col), s)


def fit(distinct: DataFrame, s: Scratch):
    """``(weight per bucket, intercept)`` learned from distinct ``(text, label)``."""
    rows = s.table(distinct, "texts")
    by_label = dict(rows.groupBy("label").count().collect())
    neg, pos = by_label.get(0, 0), by_label.get(1, 0)
    weights = np.zeros(BUCKETS, np.float32)
    if not neg or not pos:
        share = pos / (pos + neg) if pos + neg else 0.5
        return weights, float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    share = pos / (pos + neg)
    seen = F.col("pos") + F.col("neg")
    rate = F.col("pos") / seen
    part = lambda n, p, q: F.when(n > 0, n * F.log(p / F.lit(q))).otherwise(0.0)
    strength = 2 * (part(F.col("pos"), rate, share) + part(F.col("neg"), 1 - rate, 1 - share))
    ratio = F.log(((F.col("pos") + 1) / F.lit(pos + 2)) / ((F.col("neg") + 1) / F.lit(neg + 2)))
    chosen = (count_buckets(rows, "text", "label").select("bucket", strength.alias("strength"), ratio.alias("ratio"))
              .where(F.col("strength") >= SIGNIFICANCE).select("bucket", "ratio").toArrow().sort_by("bucket"))  # at most BUCKETS
    buckets, ratios = chosen.column("bucket").to_numpy(), chosen.column("ratio").to_numpy()
    number = np.full(BUCKETS, -1, np.int32)
    number[buckets] = np.arange(len(buckets))
    spark, size = rows.sparkSession, len(buckets)
    shared = spark.sparkContext.broadcast((number, ratios))

    def features(batches: Iterator) -> Iterator:
        import pyarrow as pa

        number, ratios = shared.value
        for batch in batches:
            for lo, hi, data, off in X.chunked(batch.column(0), CHUNK_BYTES):
                row, bucket = _distinct(data, off, number >= 0)
                ends = pa.array(np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32))
                at = number[bucket]  # ascending in each row, as the buckets are
                vector = pa.StructArray.from_arrays([pa.array(np.zeros(hi - lo, np.int8)), pa.array(np.full(hi - lo, size, np.int32)), pa.ListArray.from_arrays(ends, pa.array(at)),
                                                     pa.ListArray.from_arrays(ends, pa.array(ratios[at]))], names=["type", "size", "indices", "values"])
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), vector], names=["label", "features"])

    every = max(1, -(-(pos + neg) // FIT_ROWS))
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).select("text", "label")
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("features", VectorUDT.sqlType())])
    s.table(sample.mapInArrow(features, schema), "features")
    fitted = spark.read.schema(T.StructType([schema["label"], T.StructField("features", VectorUDT())])).parquet(s.path("features")).coalesce(FIT_TASKS)
    n, toxic = fitted.agg(F.count("*"), F.sum("label")).first()
    if not size or not n or not 0 < toxic < n:
        return weights, float(np.log(share / (1 - share)))
    # the sum of the losses + PENALTY / 2 * the squared weights, without the intercept
    fitted_model = LogisticRegression(family="binomial", regParam=PENALTY / n, standardization=False, maxIter=STEPS).fit(fitted)
    weights[buckets] = fitted_model.coefficients.toArray() * ratios
    s.drop("texts", "features")
    return weights, float(fitted_model.intercept)


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, predicted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        weights, intercept = shared.value
        wanted = weights != 0
        for batch in batches:
            for lo, hi, data, off in X.chunked(batch.column(1), CHUNK_BYTES):
                row, bucket = _distinct(data, off, wanted)
                z = np.bincount(row, weights[bucket], hi - lo) + intercept
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, schema)
