"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

The transducer reads a word character by character. Its state holds, for
every suffix read that some piece may still extend, the last piece of the
encoding before that suffix and how many pieces fewer that was. A new
character ends exactly one piece that may follow the last piece before it
(two pieces may stand side by side if merging their text gives these two
again), which fixes the next state and the number of pieces to add: the
transition's annotation. States are made when first reached and kept for
later words.

No piece goes on past a word's end, so reading a space mark sets every state
to the same one: the state map of a word is constant, and the maps of the
words of a text compose to a prefix sum of their counts. Words are counted
once per distinct word of a batch. Runs of spaces are pieces of their own,
which the vocabulary merges last.

Null and empty texts have no tokens. Repeated rows are counted each; a null
id stays null; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from tabkit.llm import textops as X

MARK = "▁"
LIMIT = 4096
CACHE_WORDS = 1 << 20
CACHE_STATES = 1 << 18

_BLANK = X.byte_table([0x20])


class Transducer:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        normal = [i for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        self.score = {m.id_to_piece(i): m.get_score(i) for i in normal}
        blank = [p for p in self.score if set(p) == {MARK} and len(p) > 1]
        if any(MARK in p[1:] for p in self.score if p not in blank) or len({self.score[p] for p in blank}) > 1 or any(self.score[p] <= self.score[b] for b in blank[:1] for p in self.score if p not in blank and len(p) > 1):
            raise ValueError("the vocabulary joins words; it can't be compiled word by word")
        for b in blank:
            del self.score[b]
        self.heads = {p[:k] for p in self.score for k in range(1, len(p))}
        self.runs = {0: 0, 1: 1}
        self.fits, self.alone, self.words = {}, {}, {}
        self.clear()

    def clear(self):
        self.states, self.number, self.moves = [], {}, []
        self.start = self.state((("", None, 0, False),))

    def merge(self, text: str) -> list[str]:
        """The pieces of ``text`` by repeated merging of the best pair."""
        parts = list(text)
        while len(parts) > 1:
            best = max(range(len(parts) - 1), key=lambda i: (self.score.get(parts[i] + parts[i + 1], -np.inf), -i))
            if parts[best] + parts[best + 1] not in self.score:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def follows(self, last: str | None, piece: str) -> bool:
        if last is None:
            if piece not in self.alone:
                self.alone[piece] = self.merge(piece) == [piece]
            return self.alone[piece]
        key = (last, piece)
        if key not in self.fits:
            self.fits[key] = self.merge(last + piece) == [last, piece]
        return self.fits[key]

    def state(self, entries: tuple) -> int:
        if entries not in self.number:
            self.number[entries] = len(self.states)
            self.states.append(entries)
            self.moves.append({})
        return self.number[entries]

    def move(self, state: int, char: str) -> tuple[int, int, bool]:
        """(next state, pieces added, whether a space mark stands alone in front)."""
        entries, ends = self.states[state], None
        for head, last, fewer, bare in entries:
            piece = head + char
            if (piece in self.score or not head) and self.follows(last, piece):
                ends = piece, (1 if piece in self.score else len(char.encode())) - fewer, (piece == MARK if last is None else bare)
                break
        piece, added, bare = ends
        on = [(head + char, last, fewer + added, b) for head, last, fewer, b in entries if head + char in self.heads]
        to = self.state((*on, ("", piece, 0, bare)))
        self.moves[state][char] = (to, added, bare)
        return to, added, bare

    def count(self, word: str) -> int:
        """Twice the pieces of a space mark and ``word``, plus one if the mark stands alone."""
        at, total, bare = self.start, 0, False
        for char in MARK + word:
            to = self.moves[at].get(char)
            at, added, bare = to if to is not None else self.move(at, char)
            total += added
        return 2 * total + bare

    def run(self, length: int) -> int:
        """The pieces of a run of space marks."""
        if length not in self.runs:
            self.runs[length] = len(self.model.encode(" " * (length - 1)))
        return self.runs[length]

    def count_rows(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        starts, ends, words = X.spans(data, offsets, _BLANK)
        distinct, where, back = np.unique(X.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.states) > CACHE_STATES:
            self.clear()
        for cache in (self.words, self.fits):
            if len(cache) > CACHE_WORDS:
                cache.clear()
        raw, known, counts = data.tobytes(), self.words, np.empty(len(distinct), np.int64)
        for k, (h, i) in enumerate(zip(distinct.tolist(), where.tolist())):
            n = known.get(h)
            if n is None:
                n = known[h] = self.count(raw[starts[i]:ends[i]].decode("utf-8", "replace"))
            counts[k] = n
        own = counts[back]
        first = np.concatenate(([0], np.cumsum(words)))
        filled = words > 0
        before = np.concatenate((starts[:1] * 0, ends[:-1]))
        before[first[:-1][filled]] = offsets[:-1][filled] - 1  # every text begins with a mark of its own
        gap = starts - before if len(starts) else starts
        total = own >> 1
        wide = np.flatnonzero(gap > 1)
        total[wide] += np.array([self.run(g) - 1 if b else self.run(g - 1) for g, b in zip(gap[wide].tolist(), (own[wide] & 1).tolist())], np.int64)
        scan = np.concatenate(([0], np.cumsum(total)))
        out = scan[first[1:]] - scan[first[:-1]]
        size = np.diff(offsets)
        tail = np.where(filled, offsets[1:] - (ends[np.maximum(first[1:] - 1, 0)] if len(ends) else 0), np.where(size > 0, size + 1, 0))
        for i in np.flatnonzero(tail):
            out[i] += self.run(int(tail[i]))
        return out


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        machine = X.kept(("token counts", model), lambda: Transducer(model))
        for batch in batches:
            for lo, hi, data, off in X.chunked(batch.column(1)):
                size = np.diff(off)
                if MARK.encode() in data.tobytes():  # to the model a space and its mark are the same
                    data, off = X.utf8(pc.replace_substring(batch.column(1).slice(lo, hi - lo), MARK, " "))
                n = machine.count_rows(data, off)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(size), pa.array(n), pa.array(n > limit)], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, schema)
