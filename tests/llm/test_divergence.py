"""Source divergence against plain counting, over small segments and tiles."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabkit.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string, value int, term string, n int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    docs = defaultdict(Counter)
    n = defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        lang, source, text = lang or "", source or "", text or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
        n[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, source in n:
        kept = [t for t, k in docs[lang].items() if k >= 10]
        own = {s: n[l, s] for l, s in n if l == lang}
        total = {s: sum(c[t] for t in kept) for s, c in own.items()}
        all_n = sum(total.values())
        p = lambda c, big: 1 + 10 ** 9 * (c + 2) // (big + 2 * len(kept))
        f = lambda x, y: (x - y) ** 2 // (x + y)
        parts = {"pair": [(o, sum(f(p(own[source][t], total[source]), p(own[o][t], total[o])) for t in kept)) for o in own if o != source], "term": []}
        for t in kept:
            x, y = p(own[source][t], total[source]), p(sum(c[t] for c in own.values()), all_n)
            if own[source][t] and x > y:
                parts["term"].append((t, f(x, y)))
        for part, items in parts.items():
            items.sort(key=lambda i: (-i[1], i[0].encode()))
            out += [(lang, source, part, *i, k) for k, i in enumerate(items, 1) if part == "pair" or k <= 10]
    return sorted(out)


def rows():
    rng = random.Random(3)
    vocabulary = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(90)] + ["Éa", "日本", "\U0001F600x"]
    out = []
    for i in range(260):
        weight = [1 + (j * (i % 13) % 7) ** 3 for j in range(len(vocabulary))]
        text = " ".join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(vocabulary, weight, k=rng.randrange(60))) + " 12 a1b\x00c"
        out.append((i, text, "en" if i % 4 else "de", f"s{i % 13}"))
    out += [(1, "long " * 20000, "en", "s1")] + [(2, "same text waa", "en", "hot")] * 40 + [(3, None, None, None), (None, "", "", "x"), (4, "!", "xx", "a"), (5, "rare", "xx", "b"), (6, None, "en", "silent")]
    return [(*r, 7, "clash", 1) for r in out]


@pytest.mark.parametrize("segment, tile", [(D.SEGMENT, D.TILE), (16, 3)])
def test_divergence(spark, segment, tile):
    data = rows()
    got = D.report(*D.divergence(spark.createDataFrame(data, SCHEMA).repartition(4), segment=segment, tile=tile)).collect()
    assert sorted(map(tuple, got)) == brute(data)


def test_no_rows(spark):
    assert D.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equal_counts_share_nodes():
    counts = np.array([[1, 2, 1, 2, 0, 0, 0, 0], [0, 0, 0, 0, 1, 2, 1, 2]])
    values, levels, roots = D.consed_trees(counts)
    assert values.tolist() == [0, 1, 2] and [len(x) for x, _ in levels] == [2, 2, 2]
    x, y, places = D.leaf_pairs(levels, *roots)
    assert sorted(zip(values[x], values[y], places)) == [(0, 1, 2), (0, 2, 2), (1, 0, 2), (2, 0, 2)]


def test_shares_beyond_64_bits():
    assert D.shares([10 ** 12], 10 ** 13, 5) == [1 + 10 ** 9 * (10 ** 12 + 2) // (10 ** 13 + 10)]
