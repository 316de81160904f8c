"""Repeated byte strings against every window of every text."""

import hashlib
import random
from collections import Counter

import pytest

from tabkit.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string, tid long, at int, rank int, digest string, n_bytes int"


def brute(rows):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(b[k:k + 200] for _, b in texts for k in range(len(b) - 199))
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                gone[k:k + 200] = [True] * 200
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def rows(seed):
    rng = random.Random(seed)
    fresh = lambda n: "".join(rng.choice("abcdefgh é日") for _ in range(n))
    shared = [fresh(rng.choice([120, 199, 200, 201, 230, 300, 360, 500, 900, 2000])) for _ in range(14)]
    out = []
    for _ in range(90):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts.append(fresh(rng.randrange(0, 260)))
            p = rng.choice(shared)
            a = rng.randrange(0, len(p) // 2)
            parts.append(p[a:rng.randrange(a, len(p))] if rng.random() < 0.5 else p)
        out.append("".join(parts))
    out += [out[0]] * 4 + ["x" * 199, "x" * 199, "y" * 200, "z" * 201, "ab" * 600, "long text " * 3000, "", None, " ", shared[4], shared[4] + "!", "é" * 100, "é" * 99 + "e"]
    out += [shared[9][:700] + c + shared[9][701:] for c in "abcd"]  # near copies
    return [(None if i % 17 == 0 else i % 60, t, 1, 2, 3, "clash", 4) for i, t in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_bytes(spark, seed):
    data = rows(seed)
    got = sorted(map(tuple, S.digest(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()), key=str)
    assert got == brute(data)


def test_hot_keys_are_salted(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT_ROWS", 3)
    data = rows(3)
    assert sorted(map(tuple, S.digest(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()), key=str) == brute(data)


def test_no_rows(spark):
    assert S.digest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert S.digest(spark.createDataFrame([(1, "short")], "doc_id long, text string")).collect()[0].n_removed == 0
