"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from tabkit.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, h string, item int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """(top, per leaf the (left, right) siblings)."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            k = at[i] - at[i] % 3
            path.append(("".join(nodes[k:at[i]]), "".join(nodes[at[i] + 1:k + 3])))
        at = [a // 3 for a in at]
        nodes = [H(*nodes[k:k + 3]) for k in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, H(*map(field, r[:5])), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    inner = {}
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        inner[g] = tree([x[2] for x in groups[g]])
    root, outer = tree([inner[g][0] for g in names]) if names else (None, [])
    out = []
    for g, up in zip(names, outer):
        for (_, _, leaf, r), path in zip(groups[g], inner[g][1]):
            text = r[4]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            cur = H(*map(field, (*r[:4], text)))
            for left, right in path + up:
                cur = H(left, cur, right)
            out.append((r[0], leaf, inner[g][0], root, H(*(a + b for a, b in path + up)), cur, cur == root))
    return out


def rows():
    out = [(i, "hot", "en", i, f"line {i}\nnext") for i in range(800)]
    out += [(i * 7 % 1000, f"s{i % 9}", None, None, "no line end" if i % 3 else None) for i in range(120)]
    out += [(1, None, "", 0, ""), (None, None, "é", 2, "\n"), (5, "", "x", 1, "ü\n" * 2000), (None, "null ids", None, None, None), (None, "null ids", None, None, "a\nb")]
    out += [(2, "lone", None, None, "a\n"), (3, "twice", "l", 3, "t"), (3, "twice", "l", 3, "t"), (3, "twice", "l", 3, "other"), (9, "\U0001F600", "", 1, "x"), (8, "�", "", 1, "x")]
    return [(*r, "clash", 7) for r in out]


@pytest.mark.parametrize("take", [slice(None), slice(0, 244), slice(0, 1), slice(0, 0)])
def test_manifest(spark, take):
    data = rows()[take]
    got = merkle.digest(spark.createDataFrame(data, SCHEMA).repartition(5)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(data)))


def test_proofs_lead_to_the_root(spark):
    """General interface: other fields and columns, no claims."""
    data = [(f"k{i % 50}", i % 3, float(i)) for i in range(500)]
    got = merkle.manifest(spark.createDataFrame(data, "name string, part int, value double"), ["name", "value"], "name", "part")
    assert got.where(merkle.folded(got["leaf"], got["path"]) != got["root"]).isEmpty() and got.count() == 500
    assert got.where("claim is not null").isEmpty() and got.select("root").distinct().count() == 1
