"""Near matches of the decontamination against brute force."""

import numpy as np
import pytest

from tabkit.llm import decontaminate as D


def _near(docs, items, slop, width):
    """(document, item) with a near match: the window's rarest term (over all documents; the first of equals)
    stands in the document and every other term within slop words of its place there."""
    words = [d.split() for d in docs]
    counts = {}
    for w in words:
        for x in w:
            counts[x] = counts.get(x, 0) + 1
    near, exact, hit = set(), set(), [set() for _ in docs]
    for item, text in enumerate(items):
        t = text.split()
        for win in ([t[i:i + width] for i in range(len(t) - width + 1)] if len(t) >= width else [t]):
            rare = min(range(len(win)), key=lambda k: (counts.get(win[k], 0), k))
            for d, w in enumerate(words):
                for at in [i for i, x in enumerate(w) if x == win[rare]]:
                    s = at - rare
                    if all(x in w[max(s + k - slop, 0):max(s + k + slop + 1, 0)] for k, x in enumerate(win) if k != rare):
                        near.add((d, item))
                    if s >= 0 and w[s:s + len(win)] == win:
                        exact.add((d, item))
                        hit[d] |= set(range(s, s + len(win)))
    return near - exact, exact, [len(h) for h in hit]


def _search(spark, docs, items, **kw):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").coalesce(1)
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    documents, matches = D.contamination(d, b, **kw)
    return documents, matches


def test_near_match_before_a_text(spark):
    """A window that would start before its text's first word is not given to the text before."""
    docs = ["zz yy xx", "w2 w1 " + " ".join(f"w{i}" for i in range(3, 11)) + " q w1"]
    documents, matches = _search(spark, docs, [" ".join(f"w{i}" for i in range(1, 11))])
    got = {r.doc_id: r for r in D.digest(documents, matches).collect()}
    assert (got[0].n_near, got[1].n_near) == (0, 1)
    spans = matches.join(documents.withColumnRenamed("n_words", "total"), ["shard", "place"]).collect()
    assert all(r["start"] >= 0 and r["start"] + r["n_words"] <= r["total"] for r in spans)


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_near_matches_equal_brute_force(spark, slop):
    rng = np.random.default_rng(slop)
    docs = [" ".join(f"w{i}" for i in rng.integers(0, 7, rng.integers(0, 25))) for _ in range(60)]
    items = [" ".join(f"w{i}" for i in rng.integers(0, 7, n)) for n in (3, 4, 5, 7, 2, 1)] + ["w1 w1 w1", "nowhere w1", "w1 w1 w1"]
    near, exact, hit = _near(docs, items, slop, 4)
    documents, matches = _search(spark, docs, items, width=4, slop=slop)
    rows = documents.join(matches.drop("n_words"), ["shard", "place"]).select("id", "item_id", "kind").distinct().collect()
    assert {(r.id, r.item_id) for r in rows if r.kind == "phrase"} == exact
    assert {(r.id, r.item_id) for r in rows if r.kind == "near"} == near
    got = {r.doc_id: r for r in D.digest(documents, matches).collect()}
    assert [got[i].n_hit for i in range(60)] == hit
    assert [got[i].n_near for i in range(60)] == [sum(d == i for d, _ in near) for i in range(60)]


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "ITEM_BLOCK_BYTES", 64)
    rng = np.random.default_rng(9)
    docs = [" ".join(f"w{i}" for i in rng.integers(0, 40, 200)) for _ in range(8)]
    items = [" ".join(docs[i % 8].split()[7 * i:7 * i + 9]) for i in range(16)] + ["other words only"]
    _, exact, hit = _near(docs, items, 0, 4)
    documents, matches = _search(spark, docs, items, width=4, slop=0)
    rows = documents.join(matches.drop("n_words"), ["shard", "place"]).select("id", "item_id").distinct().collect()
    assert {(r.id, r.item_id) for r in rows} == exact
    got = {r.doc_id: r.n_hit for r in D.digest(documents, matches).collect()}
    assert [got[i] for i in range(8)] == hit
