"""Registered queries over the smallest tables, column by column, against plain loops over the same rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from varspark.llm.queries import queries

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "source").collect()
    return {r.doc_id: (r.text or "", r.source) for r in rows}


def run(spark, name):
    return queries()[name](spark, DATA)


def test_op1_targets_and_takes(spark, texts):
    got = {r.doc_id: r for r in run(spark, "op1_pareto_mixing").collect()}
    assert got.keys() == texts.keys()
    size = {i: len(WORD.findall(t)) for i, (t, _) in texts.items()}
    by = Counter()
    for i, (_, s) in texts.items():
        by[s] += size[i]
    names = sorted((s for s in by if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in by)
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    target, left = {}, set(names)
    total = sum(by.values())
    while True:
        share = total - sum(target.values())
        now = {s: share * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if now[s] > 3 * by[s]]
        if not over:
            target |= now
            break
        for s in over:
            target[s] = 3.0 * by[s]
            left.remove(s)
        if not left:
            break
    taken = Counter()
    for i, r in got.items():
        s = texts[i][1]
        assert (r.size, r.source_size) == (size[i], by[s]) and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
    for s in names:  # documents are taken whole, and the smallest source has about a dozen
        assert taken[s] == pytest.approx(target[s], rel=0.04)
    again = run(spark, "op1_pareto_mixing").select("doc_id", "taken").collect()
    assert {r.doc_id: r.taken for r in again} == {i: r.taken for i, r in got.items()}


def test_op1_draw(spark):
    """Whole expected copies are certain; beyond, documents are drawn by the Pareto order of their odds until one does not fit."""
    u = (F.xxhash64(F.lit(1), "doc_id", F.xxhash64("text")).bitwiseAND((1 << 52) - 1) + 0.5) / float(1 << 52)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", u.alias("u"))
    by = defaultdict(list)
    for r in run(spark, "op1_pareto_mixing").filter("size > 0").join(docs, "doc_id").collect():
        whole = int(r.expected)
        assert whole <= r.copies <= whole + 1 and r.expected <= 3
        by[r.source].append(r)
    for own in by.values():
        assert sum(r.expected * r["size"] for r in own) == pytest.approx(own[0].target, rel=1e-6)  # in expectation the target
        gap = own[0].target - sum(int(r.expected) * r["size"] for r in own)
        odds = lambda r: (r.u / (1 - r.u)) / ((r.expected % 1) / (1 - r.expected % 1))
        for r in sorted((r for r in own if r.expected % 1 > 0), key=odds):
            if r.copies == int(r.expected):
                assert r["size"] > gap  # the first one that is passed over is too long for what is left
                break
            gap -= r["size"]


def test_op2_each_id_in_one_place(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    enc = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    ids = {i: enc.encode(t, add_special_tokens=False).ids + [0] for i, (t, _) in texts.items()}
    pieces, places = defaultdict(list), defaultdict(list)
    for r in run(spark, "op2_harmonic_packing").collect():
        own = ids[r.doc_id]
        part = own[r.start : r.start + r.length]
        assert r.doc_tokens == len(own) and len(part) == r.length > 0
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        places[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for i, p in pieces.items():
        assert sum(n for _, n in p) == len(ids[i])
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(p), sorted(p)[1:])) and min(p)[0] == 0
    for p in places.values():
        p.sort()
        assert p[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(p, p[1:])) and sum(n for _, n in p) <= 1024
    assert sum(map(len, ids.values())) >= 0.9 * 1024 * (len(places) - 1)


def test_op3_payloads(spark, texts):
    got = run(spark, "op3_gif_media").collect()
    assert len(got) == len(texts)
    by_text = {}
    for r in got:
        raw = texts[r.doc_id][0].encode()
        payload = raw + b" " * (-len(raw) % 192 or (192 if not raw else 0))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert r.media_bytes > 0 and len(r.media_sha256) == 64 and r.feature
        assert by_text.setdefault(raw, (r.media_bytes, r.media_sha256, r.feature)) == (r.media_bytes, r.media_sha256, r.feature)


class Independent(__import__("html.parser").parser.HTMLParser):
    """All text of a page outside scripts and styles, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        if tag not in ("a", "b", "i", "em", "strong", "span", "small", "code", "u", "sub", "sup", "mark"):
            self.parts.append(" ")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style") and self.skip > 0
        if tag not in ("a", "b", "i", "em", "strong", "span", "small", "code", "u", "sub", "sup", "mark"):
            self.parts.append(" ")

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)


def test_op4_every_page(spark):
    """What is kept stands in the page in this order, as an independent parser reads it, and is a good part of it."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = run(spark, "op4_block_labeller").collect()
    assert len(got) == len(pages)
    kept = all_ = 0
    for r in got:
        p = pages[r.page_id]
        assert r.url == p.url and r.n_chars == len(r.text) and r.text == " ".join(r.text.split())
        reader = Independent()
        reader.feed(p.html or "")
        reader.close()
        words = iter(" ".join("".join(reader.parts).split()).split(" "))
        lost = [w for w in r.text.split() if not any(w == x for x in words)]
        assert not lost, (r.page_id, lost[:5])
        kept, all_ = kept + len(r.text), all_ + len("".join(reader.parts))
    assert sum(r.n_chars > 0 for r in got) >= 0.95 * len(got) and 0.2 * all_ < kept < 0.95 * all_


def test_op5_held_out(spark, texts):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    got = run(spark, "op5_quality_classifier").collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and labels.get(r.doc_id) is not None]
    assert not held or sum(p == y for p, y in held) >= 0.8 * len(held)


def test_op7_counts(spark, texts):
    """Counts before and after the three edits, against whole encodings."""
    import public_tokenizers
    from tokenizers import Tokenizer

    enc = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    enc.encode_special_tokens = True
    count = lambda t: len(enc.encode(t, add_special_tokens=False).ids)
    got = run(spark, "op7_edit_aware_counts").collect()
    assert {r.doc_id for r in got} == texts.keys()
    for r in got:
        t = texts[r.doc_id][0]
        n, after = len(t), t
        for at, delete, insert in ((int(n / 2), 7, ""), (int(n * 3 / 4), 3, " it's 42"), (0, 0, "Note: ")):
            at = min(at, len(after))
            after = after[:at] + insert + after[at + delete :]
        assert (r.n_tokens_before, r.n_tokens_after, r.n_edits, r.n_chars_after) == (count(t), count(after), 3, len(after))
        assert r.reencoded_chars < len(after) + 200


def test_op8_ranks_and_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    rows = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) and all(x is not None for x in v)]
    rows = [(i, v) for i, v in rows if np.isfinite(v).all() and v.any()]
    found = defaultdict(list)
    for r in run(spark, "op8_projected_neighbours").orderBy("query_id", "rank").collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    asked = {i: v for i, v in rows if i % 20 == 0}
    assert found.keys() == asked.keys()
    vector, hits, wanted = dict(rows), 0, 0
    for i, q in asked.items():
        best = sorted(((-float(np.sum(q * v)), j) for j, v in rows if j != i))[:20]
        assert [k for k, _, _ in found[i]] == list(range(1, len(best) + 1))
        keys = [(-s, j) for _, j, s in found[i]]
        assert keys == sorted(keys) and i not in {j for _, j in keys}
        assert all(s == pytest.approx(float(np.sum(q * vector[j])), rel=1e-12, abs=1e-12) for _, j, s in found[i])
        hits += len({j for _, j in best} & {j for _, j in keys})
        wanted += len(best)
    assert hits >= 0.9 * wanted


def test_columns(spark):
    want = {
        "op1_pareto_mixing": "doc_id size source_size target taken", "op2_harmonic_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op3_gif_media": "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature", "op4_block_labeller": "page_id url text n_chars",
        "op5_quality_classifier": "doc_id held_out score predicted", "op6_partition_jaccard": "doc_id n_shingles component_id", "op8_projected_neighbours": "query_id rank vec_id score",
        "op9_line_dedup": "doc_id n_lines n_dropped kept_sha256", "op10_stupid_backoff": "doc_id n_words n_backoff log_score",
    }
    kinds = {"held_out": "boolean", "score": "double", "predicted": "int", "rank": "int", "target": "double", "taken": "bigint", "n_shingles": "bigint", "component_id": "bigint", "tail_crc32": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"}
    for name, columns in want.items():
        types = dict(run(spark, name).dtypes)
        assert set(columns.split()) <= set(types), name
        assert all(types[c] == k for c, k in kinds.items() if c in columns.split()), name


def test_word_vectors_by_plain_loops(spark):
    from varspark.llm import quality
    from varspark.llm.textvec import texts as runs_of

    sample = ["Some words, some MORE words! words words 12 12", "", None, "naïve 漢字 x9-y", "12 more\nsome", "a"]
    df = spark.createDataFrame([(t,) for t in sample], "text string").repartition(3)
    token = re.compile(r"[A-Za-z\x80-\U0010ffff]+|[0-9]+|[^\sA-Za-z0-9\x80-\U0010ffff]+")
    sums, each = np.zeros((quality.BUCKETS, quality.DIM)), []
    import pyarrow as pa

    for t in sample:
        (run,) = list(runs_of(pa.array([t or ""])))
        buckets = quality.tokens(run)[1].tolist()
        plain = token.findall(t or "")
        marks = [sum(len(x) > 1 and x.isascii() and x.isalpha() and x.isupper() for x in plain), sum(a == b for a, b in zip(plain, plain[1:]))]
        assert [buckets.count(quality._UPPER), buckets.count(quality._REPEAT)] == marks and len(buckets) == len(plain) + sum(marks)
        own = [b for b in buckets if b not in (quality._UPPER, quality._REPEAT)]
        assert len({(x, b) for x, b in zip(plain, own)}) == len(set(plain))
        each.append(buckets)
        for i, b in enumerate(buckets):
            for j in (i - 1, i + 1):
                if 0 <= j < len(buckets):
                    for at, sign in zip(quality._AT[buckets[j]], quality._SIGN[buckets[j]]):
                        sums[b, at] += sign
    want = sums / np.maximum(np.sqrt((sums**2).sum(1, keepdims=True)), 1e-9)
    for b in range(quality.BUCKETS):
        for at, sign in zip(quality._AT[b], quality._SIGN[b]):
            want[b, at] += sign * 0.5
    got = quality.word_vectors(df)
    assert np.allclose(got, want, atol=1e-5)
    (run,) = list(runs_of(pa.array([t or "" for t in sample])))
    x, n = quality.pooled(run, got)
    for i, buckets in enumerate(each):
        assert n[i] == len(buckets) and np.allclose(x[i], sum((got[b] for b in buckets), np.zeros(quality.DIM)), atol=1e-4)
