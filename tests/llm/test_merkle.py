"""The manifest against a hash tree built by plain loops."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from varspark.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*(said(text if c == "text" else r[c]) for c in FIELDS))


def tree(level):
    """All levels, the lone node last."""
    out = [level]
    while len(level) > 1:
        level = [h(*level[i : i + 16]) for i in range(0, len(level), 16)]
        out.append(level)
    return out


def climb(levels, at, node):
    proof = []
    for level in levels[:-1]:
        a = at // 16 * 16
        left, right = level[a:at], level[at + 1 : a + 16]
        proof += left + right
        node, at = h(*left, node, *right), at // 16
    return node, proof


def plain(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = tree([leaf(r, r["text"]) for r in by[s]])
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(by[s]):
            t = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and t is not None:
                t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
            node, proof = climb(trees[s], i, leaf(r, t))
            node, more = climb(top, k, node)
            out.append((str(r["doc_id"]), trees[s][0][i], trees[s][-1][0], top[-1][0], h(*proof, *more), node, node == top[-1][0]))
    return sorted(out)


def run(df):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.manifest(df, FIELDS, "source", "doc_id", tampered, "text", merkle.lower_cased("text"))
    return sorted((str(r.id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in found.collect())


@pytest.mark.parametrize("copies", [4096, 3])
def test_trees_of_many_sizes(spark, monkeypatch, copies):
    monkeypatch.setattr(merkle, "RUNS_A_COPY", copies)  # hot nodes are stored in copies
    rows, i = [], 0
    for k, n in enumerate([1, 2, 15, 16, 17, 31, 256, 257, 700, 1, 3, 1, 1, 1, 1, 16, 1, 2]):
        for _ in range(n):
            rows.append((i * 7 % 5003, None if k == 4 else f"s{k}é", "en" if i % 3 else None, i if i % 4 else None, None if i % 11 == 0 else f"Text {i} É"))
            i += 1
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    got = run(df)
    assert got == plain([dict(zip(FIELDS, r)) for r in rows])
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_one_leaf_one_group_and_none(spark, docs, local):
    assert run(docs) == plain(local)
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert run(spark.createDataFrame([], schema)) == []
    for n in (1, 2, 40):
        rows = [(j, "a", None, None, "X") for j in range(n)]
        assert run(spark.createDataFrame(rows, schema)) == plain([dict(zip(FIELDS, r)) for r in rows])
    alone = [(j, f"a{j}", None, None, "X") for j in range(20)]
    assert run(spark.createDataFrame(alone, schema)) == plain([dict(zip(FIELDS, r)) for r in alone])
