"""Quality rules: compression bands and the contract's base counts.

A text's zstandard ratio (compressed / raw bytes) is taken over the whole
text and over each fixed chunk of ``CHUNK`` bytes. Each ratio is held
against the limits of its length band: below the lower one the text is
repetitive, above the upper one it is incompressible. A text is rejected if
its whole ratio leaves its band, or more than ``BAD_CHUNK_SHARE`` of its
chunks leave theirs. Short texts compress badly whatever they say, so the
shortest band has no limits.

Words are runs without ASCII white space; counts are code points. Null and
empty texts have no words and fail the base rule (fewer than 10 words).
Each row is judged by itself; a null id stays null, repeated rows give
repeated results, an empty table no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from tabkit.llm import textops as X

CHUNK = 4096
LEVEL = 3
BAD_CHUNK_SHARE = 0.5
# (shortest length in bytes, lowest ratio, highest ratio)
BANDS = ((0, 0.0, 99.0), (256, 0.40, 0.95), (512, 0.38, 0.90), (1024, 0.33, 0.80), (2048, 0.30, 0.75), (4096, 0.26, 0.70), (16384, 0.20, 0.65))
# Characters that count as symbols, and the base limits.
SYMBOLS = X.byte_table(b"#*$%&|<>")
REPEAT_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_EDGES = np.array([b[0] for b in BANDS])
_LOW = np.array([b[1] for b in BANDS])
_HIGH = np.array([b[2] for b in BANDS])


def repeated_words(words: np.ndarray, per_row: np.ndarray, width: int = REPEAT_WORDS) -> np.ndarray:
    """Per row, the words inside windows that occur twice or more in it."""
    long = np.where(per_row >= width, per_row, 0)
    h, at, count = X.window_hashes(words, per_row, width)
    whole = np.repeat(long > 0, count)
    row = np.repeat(np.arange(len(per_row)), count)
    key = X.mix(h ^ X.mix(row.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.concatenate(([False], k[1:] == k[:-1])) if len(k) else np.zeros(0, bool)
    again = np.zeros(len(k), bool)
    again[order] = same | np.concatenate((same[1:], [False])) if len(k) else again
    again &= whole
    cover = np.zeros(len(words) + width + 1, np.int32)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + width, -1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(cover)[:len(words)] > 0)))
    first = np.concatenate(([0], np.cumsum(per_row)))
    return inside[first[1:]] - inside[first[:-1]]


def duplicate_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per row, the lines with a word that equal an earlier line."""
    starts, ends, per_row = X.spans(data, offsets, X.byte_table([0x0A]))
    solid = np.concatenate(([0], np.cumsum(~X.WHITE_SPACE[data])))
    has = solid[ends] > solid[starts]
    row = np.repeat(np.arange(len(per_row)), per_row)[has]
    key = X.mix(X.span_hashes(data, starts[has], ends[has]) ^ X.mix(row.astype(np.uint64)))
    _, first = np.unique(key, return_index=True)
    return np.bincount(row, minlength=len(per_row)) - np.bincount(row[first], minlength=len(per_row))


def _outside(ratio: np.ndarray, length: np.ndarray) -> np.ndarray:
    band = np.searchsorted(_EDGES, length, "right") - 1
    return (ratio < _LOW[band]) | (ratio > _HIGH[band])


def compression(raw: bytes, compressor) -> tuple[float, int, int]:
    """(whole ratio, chunks, chunks outside their band)."""
    if not raw:
        return 0.0, 0, 0
    whole = len(compressor.compress(raw)) / len(raw)
    parts = [raw[i:i + CHUNK] for i in range(0, len(raw), CHUNK)] if len(raw) > CHUNK else []
    if not parts:
        return whole, 0, 0
    size = np.array([len(p) for p in parts])
    return whole, len(parts), int(_outside(np.array([len(compressor.compress(p)) for p in parts]) / size, size).sum())


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``id_col, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, ratio, n_chunks,
    n_bad_chunks``."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)] + [T.StructField(n, T.LongType()) for n in names]
                          + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("ratio", T.DoubleType()), T.StructField("n_chunks", T.LongType()), T.StructField("n_bad_chunks", T.LongType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        for batch in batches:
            for lo, hi, data, off in X.chunked(batch.column(1)):
                starts, ends, words = X.spans(data, off, X.WHITE_SPACE)
                repeat = repeated_words(X.span_hashes(data, starts, ends), words)
                per_row = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[off])
                chars = per_row(((data & 0xC0) != 0x80) & ~X.WHITE_SPACE[data])
                raw, edges = data.tobytes(), off.tolist()
                packed = [compression(raw[a:b], compressor) for a, b in zip(edges[:-1], edges[1:])]
                ratio, chunks, bad = (np.array(x) for x in zip(*packed))
                failed = (words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * words)
                kept = ~failed & ~_outside(ratio, np.diff(off)) & (bad <= BAD_CHUNK_SHARE * chunks)
                columns = (words, chars, per_row(SYMBOLS[data]), duplicate_lines(data, off), repeat, failed, kept, ratio, chunks, bad)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *map(pa.array, columns)], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, schema)
