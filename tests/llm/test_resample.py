"""Resampling against plain loops: features, gains, scores and ranks."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from varspark.llm import resample
from varspark.llm.textvec import texts

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
HARD = ["", None, "a", "A-b c", "x y", "y", "naïve 漢字, 12x3", "w" * 300 + " " + "é" * 90, " ", "end", "End\x00Z", "a b a b a B"]


def words(t):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))


def runs(t, order):
    w = words(t)
    return [b" ".join(w[i : i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_features_are_the_runs(order):
    for most in (2, 1 << 20):
        got = [[] for _ in HARD]
        for t in texts(pa.array(HARD), most):
            doc, bucket, n = resample.features(t, order, 10_000)
            for d, b in zip(doc.tolist(), bucket.tolist()):
                got[t.first + d].append(b)
            assert n.tolist() == [len(words(HARD[t.first + i])) for i in range(len(t))]
        assert [sorted(g) for g in got] == [sorted(zlib.crc32(x) % 10_000 for x in runs(t, order)) for t in HARD]


def plain(rows, target, order=1, buckets=10_000, least=20, percent=10):
    count = lambda ts: Counter(zlib.crc32(x) % buckets for t in ts for x in runs(t, order))
    s, t = count(r["text"] for r in rows), count(target)
    big_s, big_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in s}
    out = []
    for r in rows:
        f = [gain[zlib.crc32(x) % buckets] for x in runs(r["text"], order)]
        w = sum(f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()[:8], 16)
        out.append([r["doc_id"], len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(r["text"])) >= least])
    drawn = sorted((-x[3], x[0] is None, x[0] or 0) for x in out if x[4])
    most = percent * len(drawn) // 100
    ranks = [(-a, None if n else i, k + 1) for k, (a, n, i) in enumerate(drawn[:most])]
    return out, ranks


@pytest.mark.parametrize("order", [1, 2])
def test_hard_tables(spark, docs, local, order):
    target = ["w1 w2 w3 w4", None, "", "W5 zz"]
    t = spark.createDataFrame([(x, 1) for x in target], "text string, doc_id int")
    got = resample.resample(docs, t, order=order, percent=40).collect()
    want, ranks = plain(local, target, order, percent=40)
    assert Counter((r.kept.doc_id, r.n_features, r.weight, r.score) for r in got) == Counter(tuple(x[:4]) for x in want)
    assert sorted((r.score, r.kept.doc_id, r["rank"]) for r in got if r["rank"] is not None) == sorted(ranks)
    assert set(got[0].kept.asDict()) == set(docs.columns) - {"text"}
    assert resample.resample(docs.limit(0), t).count() == 0
    assert resample.resample(docs, t.limit(0)).count() == len(local)


@pytest.mark.parametrize("kind", ["spread", "ties", "copies"])
@pytest.mark.parametrize("share", [0, 10, 100])
def test_ranks_are_exact(spark, monkeypatch, kind, share):
    monkeypatch.setattr(resample, "SAMPLES", 50)
    score = {"spread": "cast(hash(id) % 1000 as long)", "ties": "id % 2", "copies": "5L"}[kind]
    rows = spark.range(0, 3000, 1, 7).select(F.expr(score).alias("score"), F.expr("1" if kind == "copies" else "if(id % 50 = 0, null, id * 7919 % 3001)").cast("long").alias("id"), (F.col("id") % 3 > 0).alias("can"))
    got = resample.ranked(rows, "score", "id", "can", share).collect()
    assert len(got) == 3000
    want = sorted((-r.score, r.id is None, r.id or 0) for r in rows.collect() if r.can)
    most = share * len(want) // 100
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, most + 1)) and all(r.can for r in drawn)
    assert [(-r.score, r.id is None, r.id or 0) for r in drawn] == want[:most]


def test_segments_are_even(spark):
    """Equal scores and ids do not gather: a segment holds its share and a sample's distance for each run."""
    n = 8000
    rows = spark.range(0, n, 1, 6).select(F.lit(1).cast("long").alias("score"), F.lit(2).cast("long").alias("id"), F.lit(True).alias("can"))
    seen = resample.ranked(rows, "score", "id", "can", 100)
    assert sorted(r["rank"] for r in seen.select("rank").collect()) == list(range(1, n + 1))
    per = [r["count"] for r in seen.groupBy(F.spark_partition_id()).count().collect()]
    assert max(per) <= n / 4 + 6 + 1
