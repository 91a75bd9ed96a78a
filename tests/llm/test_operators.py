"""The operators against brute force, over small documents with every hard case."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from varspark.llm import ann, edits, gif, html, jaccard, linededup, lm, mixing, packing, pretokens, quality
from varspark.llm.textvec import shingles, texts, words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lowered(t):
    return re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())


def test_words_are_the_runs():
    sample = ["a b\tc", "", None, "  x", "y", "é漢 z\n", "A a"]
    for run in texts(pa.array(sample), 5), texts(pa.array(sample)):
        got = defaultdict(int)
        for t in run:
            for d in words(t).doc.tolist():
                got[t.first + d] += 1
        assert [got[i] for i in range(len(sample))] == [len(WORD.findall((s or "").encode())) for s in sample]
    (t,) = texts(pa.array(["abc x", "x abc"]))
    w = words(t)
    assert w.hash[0] == w.hash[3] and w.hash[1] == w.hash[2] and w.hash[0] != w.hash[1]


def brute_lines(rows, least=10):
    strip = lambda x: x.strip(" \t\n\x0b\x0c\r")
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), strip(x))
    holder = {}
    for r in rows:
        if r["doc_id"] is not None:
            for x in (r["text"] or "").split("\n"):
                if len(key(x)) >= least:
                    holder[key(x)] = min(holder.get(key(x), r["doc_id"]), r["doc_id"])
    out = []
    for r in rows:
        lines = (r["text"] or "").split("\n")
        kept = [x for x in lines if r["doc_id"] is None or len(key(x)) < least or holder[key(x)] == r["doc_id"]]
        out.append((r["doc_id"], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup(docs, local):
    maps = linededup.keep_bitmaps(docs)
    got = linededup.apply_bitmaps(docs, maps)
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=str) == brute_lines(local)
    r = next(r for r in maps.collect() if r.doc_id == 11)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(r.keep_bitmap), np.uint8), count=r.n_lines)
    assert bits.sum() == r.n_lines - r.n_dropped
    assert linededup.apply_bitmaps(docs.limit(0), linededup.keep_bitmaps(docs.limit(0))).count() == 0


def test_line_dedup_across_range_borders(spark):
    same = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("the same line again\nthe same line again").alias("text")).repartition(8)
    got = {r.doc_id: r.n_dropped for r in linededup.keep_bitmaps(same).collect()}
    assert got == {i: 2 * (i > 0) for i in range(400)}


def test_mixing(docs, local):
    plan = mixing.mix(docs).collect()
    size = Counter()
    for r in local:
        size[r["source"]] += len(WORD.findall((r["text"] or "").encode()))
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(size.values()))
    while True:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * share > 3 * size[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * size[s]
            left -= target[s]
        open_ -= over
    target |= {s: weight[s] * share for s in open_}
    taken, most = Counter(), Counter()
    for r in plan:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == size[r.source]
        assert r.taken == r.copies * r["size"] and r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r["size"])
    assert len(plan) == len(local)
    assert all(abs(taken[s] - target[s]) <= most[s] for s in size)
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda rows: sorted((str(r.doc_id), r["size"], r.copies) for r in rows)
    assert key(plan) == key(again)
    many = mixing.mixed(docs, mixing.mix(docs))
    assert many.columns == docs.columns and many.count() == sum(r.copies for r in plan)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_meets_targets_closely(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"), F.repeat(F.lit("a "), (1 + F.col("id") * 7919 % 300).cast("int")).alias("text"))
    for r in mixing.mix(d).groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"), F.countDistinct("copies").alias("c")).collect():
        assert abs(r.n - r.t) < 0.002 * r.t and r.c > 1


def test_pretokens_equal_the_tokenizer():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rng = __import__("random").Random(2)
    parts = [*"ab'stmdrvel 1 \n\t\r.,!?#", "'s", "'ll", " 're", "  ", "é", "漢", "́", "²", "\x85", "　", "<|endoftext|>", "don't"]
    sample = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    ids, at = pretokens.encoder().encode(sample)
    want = [e.ids for e in t.encode_batch(sample, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def test_packing(docs, local):
    pieces = packing.pack(docs).collect()
    assert {len(p.ids) for p in pieces} and all(p.length == len(p.ids) <= 1024 for p in pieces)
    by = defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append((p.offset, p.length))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    enc = pretokens.encoder()
    total = 0
    for r in local:
        total += len(enc.encode([r["text"] or ""])[0]) + 1
    assert sum(p.length for p in pieces) == total
    assert all(zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 for p in pieces)
    long = sorted((p.start, p.ids) for p in pieces if p.doc_id == 506)
    ids = [i for _, part in long for i in part]
    text = next(r["text"] for r in local if r["doc_id"] == 506)
    assert ids == enc.encode([text])[0].tolist() + [0]
    padding = sum(1024 - sum(n for _, n in s) for s in by.values())
    assert padding < 2048
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_hands_pieces_over(spark, monkeypatch):
    monkeypatch.setattr(packing, "_OVER", 50)
    d = spark.range(600).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 37).cast("int")).alias("text")).repartition(6)
    pieces = packing.pack(d, with_ids=False)
    assert pieces.filter("sequence_id is null").count() == 0
    assert pieces.select("doc_id").distinct().count() == 600
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m")).filter("n <> m or n > 1024").count() == 0


@pytest.mark.parametrize("compress", [False, True])
def test_gif_round_trip(compress):
    rng = __import__("random").Random(4)
    for k in range(12):
        n = 192 * rng.randrange(1, 60)
        data = bytes(rng.randrange([2, 30, 256][k % 3]) for _ in range(n))
        frames = list(gif.read_gif(gif.write_gif(data, rows=20, compress=compress)))
        assert b"".join(f.samples.tobytes() for f in frames) == data
        assert [f.delay_ms for f in frames] == [100] * len(frames)


def test_gif_disposal_transparency_interlace():
    import struct

    def frame(flags, clear, left, top, w, h, data, packed=0):
        return struct.pack("<BBBBHBB", 0x21, 0xF9, 4, flags, 3, clear, 0) + struct.pack("<BHHHHBB", 0x2C, left, top, w, h, packed, 8) + gif._blocks(gif.lzw_compress(bytes(data)))

    head = b"GIF89a" + struct.pack("<HHBBB", 2, 2, 0xF7, 0, 0) + bytes(v for i in range(256) for v in (i, 255 - i, 7))
    data = head + frame(1 << 2, 0, 0, 0, 2, 2, [1, 2, 3, 4]) + frame((2 << 2) | 1, 9, 0, 0, 2, 1, [9, 8]) + frame(3 << 2, 0, 1, 1, 1, 1, [5]) + frame(0, 0, 0, 0, 1, 1, [6]) + b"\x3b"
    f = [x.colours[:, :, 0].tolist() for x in gif.read_gif(data)]
    assert f == [[[1, 2], [3, 4]], [[1, 8], [3, 4]], [[0, 0], [3, 5]], [[6, 0], [3, 4]]]
    rows = list(range(10))
    stored = [rows[i] for i in gif._rows(10)]
    (x,) = gif.read_gif(b"GIF89a" + struct.pack("<HHBBB", 1, 10, 0xF7, 0, 0) + head[13:] + frame(0, 0, 0, 0, 1, 10, stored, 0x40) + b"\x3b")
    assert x.samples.ravel().tolist() == rows


def test_gif_columns(docs, local):
    out = gif.gif_frames(gif.text_to_gif(docs)).collect()
    assert len(out) == len(local)
    want = Counter()
    for r in local:
        raw = (r["text"] or "").encode()
        want[raw.ljust(max(1, -(-len(raw) // 192)) * 192, b" ")] += 1
    assert Counter(b"".join(bytes(f.samples) for f in r.frames) for r in out) == want
    assert all(sum(f.histogram) == f.width * f.height for r in out for f in r.frames)
    assert gif.gif_frames(gif.text_to_gif(docs.limit(0))).count() == 0


@pytest.fixture(scope="module")
def labeller(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    return html.train(pages)


def test_main_text_of_pages(spark, labeller):
    from html import unescape

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = html.main_text(pages, labeller).collect()
    right = 0
    for r in got:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        right += r.text == " ".join(unescape(re.sub(r"<[^>]+>", " ", article)).split())
    assert right >= 0.98 * len(got)


def test_main_text_of_other_layouts(labeller):
    p = "The committee met on Tuesday, and after a long debate it agreed that the plan should go ahead next year. "
    page = (
        '<html><body><div id="top-menu"><ul><li><a href="/">Home</a><li><a href="/a">About us</a></ul></div><div class="cookie-notice"><p>We use cookies.</p></div>'
        f'<div class="entry-content"><h2>A long debate</h2><p>{p * 3}</p><p>Fish &amp; chips, it said. {p}</p></div>'
        '<div class="comments"><p>Reply</p><div>Great post, thanks!</div></div><aside><h3>Popular posts</h3><p>Most read</p></aside><footer>&copy; 2024 All rights reserved.</footer><script>var x = "<p>no</p>";</script></body>'
    )
    found = html.blocks(page)
    labels = labeller.label([html.features(found)])[0]
    text = " ".join(b.text for b, v in zip(found, labels) if v >= 0.5)
    assert "A long debate The committee" in text and "Fish & chips, it said." in text
    for word in ("cookies", "Home", "Great post", "Popular", "rights", "var x"):
        assert word not in text


def test_main_text_edge_cases(spark, labeller):
    rows = [(1, None, "x"), (2, "", "x"), (3, "<p>unclosed <b>bold", "x"), (4, "<!-- never closed", "x"), (5, "<p>" * 3000 + "deep", "x"), (5, "<p>" * 3000 + "deep", "x"), (None, "plain", None)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = html.main_text(df, labeller).collect()
    assert len(out) == 7 and all(r.text is not None for r in out)
    assert {r.text for r in out if r.page_id in (1, 2, 4)} == {""}
    assert html.main_text(df.limit(0), labeller).count() == 0


def test_lstm_gradients():
    rng = np.random.Generator(np.random.PCG64(1))
    net = html.Labeller()
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, mask = html.batch([rng.random((4, html._INPUT)), rng.random((2, html._INPUT))])
    y = (rng.random(mask.shape) < 0.5) * 1.0

    def loss():
        p = net.forward(x, mask)[0]
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()

    grads, _ = net.gradients(x, mask, y)
    for k in ("xf", "hb", "bf", "o"):
        flat = net.w[k].reshape(-1)
        i = int(np.argmax(abs(grads[k].reshape(-1))))
        old, d = flat[i], 1e-4
        flat[i] = old + d
        up = loss()
        flat[i] = old - d
        down = loss()
        flat[i] = old
        assert grads[k].reshape(-1)[i] == pytest.approx((up - down) / (2 * d), rel=2e-2, abs=1e-5)


def test_quality_on_held_out_rows(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = quality.classify(d, labels).join(labels, "doc_id").filter(quality.fold() == 2).select("score", "quality").toPandas()
    good, bad = scored.score[scored.quality == 1].values, scored.score[scored.quality == 0].values
    assert (good[:, None] > bad[None, :]).mean() > 0.98
    assert (good >= 0.7).mean() > 0.98 and (bad < 0.7).mean() > 0.9


def test_quality_edge_cases(spark, docs, local):
    labels = spark.createDataFrame([(0, 1), (10, 0), (500, None), (None, 1), (0, 1), (999999, 0)], "doc_id long, quality int")
    out = quality.classify(docs, labels).collect()
    assert len(out) == len(local) and all(0 <= r.score <= 1 for r in out)
    by = defaultdict(set)
    for r in out:
        by[r.text].add(r.score)
    assert all(len(s) == 1 for s in by.values())
    assert len({s for t in (None, "", " \n\t") for s in by[t]}) == 1
    flat = quality.classify(docs, labels.limit(0)).collect()
    assert all(r.score == pytest.approx(0.5) for r in flat)
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_word_vectors_do_not_depend_on_partitions(docs):
    assert np.array_equal(quality.word_vectors(docs), quality.word_vectors(docs.repartition(7)))


def shingle_set(text, k=5):
    w = WORD.findall(lowered(text))
    return frozenset(map(tuple, (w[i : i + k] for i in range(len(w) - k + 1)))) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = [(r["doc_id"], shingle_set(r["text"])) for r in rows if r["doc_id"] is not None]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            both = len(x & y)
            if x and y and 100 * both >= 80 * (len(x) + len(y) - both):
                i, j = find(i), find(j)
                parent[max(i, j)] = min(i, j)
    return sorted((i, len(x), find(i)) for i, x in sets)


def test_jaccard(docs, local):
    got = jaccard.similar_documents(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == brute_components(local)
    assert [(r.n_shingles, r.component_id) for r in got if r.doc_id is None] == [(None, None)]
    assert jaccard.similar_documents(docs.limit(0)).count() == 0


def test_jaccard_in_large_groups(spark):
    """Near copies of one text, some too far from it, and a passage that unlike texts share."""
    rng = __import__("random").Random(7)
    vocabulary = [f"v{i}" for i in range(500)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    base, passage = text(150), text(45)
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(7)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append({"doc_id": 2 * i, "text": " ".join(w)})
    for i in range(120):
        rows.append({"doc_id": 2 * i + 1, "text": " ".join(text(rng.randrange(6, 20)) + passage)})
    rows.append({"doc_id": 1000, "text": " ".join(base)})
    df = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_documents(df).collect())
    assert got == brute_components(rows)


def test_errors_bound():
    for a in range(1, 60):
        for b in range(a, 60):
            least = math.ceil(4 * (a + b) / 9)
            assert jaccard.most_errors(np.array([a]), np.array([b]), 80)[0] == a + b - 2 * least


def test_nearest(spark):
    rng = np.random.Generator(np.random.PCG64(3))
    x = rng.normal(size=(700, 16)) * rng.random((700, 1))
    x[50:120] = x[50]
    rows = [(i, [float(np.float32(v)) for v in x[i]]) for i in range(700)]
    rows += [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] * 16), (1004, [1.0]), (None, rows[0][1]), (1005, [float("inf")] * 16), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = ann.nearest(df, lambda i: i % 20 == 0).toPandas()
    x = np.array([r[1] for r in rows[:700]])
    hit = 0
    for q, g in got.groupby("query_id"):
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        order = np.lexsort((np.arange(700), -s))[:20]
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 21)) and q not in set(g.vec_id)
        assert np.array_equal(g.score.values, (x[g.vec_id.values] * x[q]).sum(1))
        hit += len(set(order) & set(g.vec_id))
    assert got.query_id.nunique() == 35 and hit >= 0.9 * 20 * 35
    assert ann.nearest(df.limit(0), lambda i: i % 20 == 0).count() == 0
    few = ann.nearest(df.filter("vec_id in (0, 1, 2)"), lambda i: i % 20 == 0).collect()
    assert [r["rank"] for r in few] == [1, 2]


def test_chi_square_quantile():
    assert ann.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-2)
    assert ann.chi_square_quantile(0.5, 2) == pytest.approx(2 * math.log(2), abs=1e-6)


@pytest.mark.parametrize("order, chunk", [(1, 1 << 23), (2, 100), (3, 1 << 23), (3, 2000), (4, 500)])
def test_backoff_scores(docs, local, order, chunk):
    texts_ = [(r["doc_id"], WORD.findall(lowered(r["text"]))) for r in local]
    seen = Counter()
    for _, w in texts_:
        seen.update(tuple(w[i : i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1))
    total = sum(n for g, n in seen.items() if len(g) == 1)
    want = defaultdict(lambda: [0, 0, 0])
    for i, w in texts_:
        want[i]
        for at, x in enumerate(w):
            longest = min(order, at + 1)
            for k in range(longest, 0, -1):
                gram = tuple(w[at - k + 1 : at + 1])
                if k == 1 or seen[gram] >= 2:
                    break
            s = 0.4 ** (longest - k) * (seen[gram] / (seen[gram[:-1]] if k > 1 else total))
            want[i][0] += 1
            want[i][1] += k < longest
            want[i][2] += round(math.log(s) * 1e6)
    got = lm.backoff_scores(docs, order=order, chunk=chunk).collect()
    assert {r.doc_id: [r.n_words, r.n_backoff, round(r.log_score * 1e6)] for r in got} == dict(want)
    assert lm.backoff_scores(docs.limit(0), order=order).count() == 0
    if order == 3:
        counts = lm.ngram_counts(docs)
        assert Counter((r.k, r.n) for r in counts.collect()) == Counter((len(g), n) for g, n in seen.items())
        assert counts.count() == counts.select("k", "gram").distinct().count() and lm.ngram_counts(docs.limit(0)).count() == 0


def test_edits(spark, docs, local):
    rng = __import__("random").Random(8)
    enc, counter = pretokens.encoder(), edits.Counter(pretokens.encoder())
    parts = [*"ab's 1\n\t.,", "don't", "  ", "漢", "word "]
    for k in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(300)))
        tree = edits.trees(enc, [text])[0]
        for _ in range(4):
            insert = "".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 3, 40, 2000] if k % 20 == 0 else [0, 3, 9])))
            text, tree, _ = edits.edit(text, tree, rng.randrange(-2, len(text) + 5), rng.randrange(30), insert, counter)
            assert tree.total == len(enc.encode([text])[0]) and tree.chars[1] == len(text)
    e = F.array(F.struct(F.lit(2).cast("long").alias("at"), F.lit(1).cast("long").alias("delete"), F.lit("xy z").alias("insert")), F.lit(None).cast("struct<at:long,delete:long,insert:string>"))
    out = edits.apply_edits(edits.token_trees(docs.withColumn("edits", e))).collect()
    assert len(out) == len(local)
    for r in out:
        assert r.n_tokens == len(enc.encode([r.text])[0]) and r.n_edits == 1
    long = next(r for r in out if r.doc_id == 506)
    assert long.reencoded_chars < 300
    none = edits.apply_edits(edits.token_trees(docs.withColumn("edits", F.lit(None).cast("array<struct<at:long,delete:long,insert:string>>")))).collect()
    assert sum(r.n_edits for r in none) == 0
    assert edits.apply_edits(edits.token_trees(docs.limit(0).withColumn("edits", e))).count() == 0


def test_hash_of_kept_text_is_of_utf8(docs):
    r = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs)).filter("doc_id = 508").select("text", F.sha2("text", 256).alias("h")).first()
    assert r.h == hashlib.sha256(r.text.encode()).hexdigest()
