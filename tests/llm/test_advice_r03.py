"""What the third round's findings ask for."""

import numpy as np
import pytest

from varspark.llm import ann, gif, jaccard


def test_nearest_moves_vectors_in_proportion(spark, monkeypatch):
    """Twice the vectors with twice the queries move about twice the bytes, however few queries meet in a cell."""
    monkeypatch.setattr(ann, "BLOCK", 64)
    monkeypatch.setattr(ann, "CHUNK", 8)
    x = np.random.default_rng(5).normal(size=(4000, 16))
    moved = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()
    sizes = []
    for n in (2000, 4000):
        df = spark.createDataFrame([(i, x[i].tolist()) for i in range(n)], "vec_id long, embedding array<float>")
        before = moved()
        assert ann.nearest(df, lambda i: i % 20 == 0, k=5).count() == n // 20 * 5
        sizes.append(moved() - before)
    assert sizes[1] < 2.6 * sizes[0] and sizes[1] < 20 * x.astype(np.float32).nbytes


@pytest.mark.parametrize("data", [b" " * 192, b"abracadabra " * 4000, bytes(range(256)) * 300, np.random.default_rng(2).bytes(192 * 200)])
def test_gif_is_stored_by_lzw(data):
    """What is stored by default is compressed by a growing table of words, and read by it."""
    samples = data[: len(data) // 192 * 192]
    media = gif.write_gif(samples)
    stream = gif.lzw_compress(samples)
    assert gif._blocks(stream) in media
    groups = list(gif._groups(stream, 8))
    assert max(c for g in groups for c in g) > 257  # words, not samples alone
    assert b"".join(w for g in groups for w in gif._words(g, 8)) == samples
    assert b"".join(f.samples.tobytes() for f in gif.read_gif(media)) == samples


def test_gif_query_stores_words(spark):
    from varspark.llm.queries import queries

    rows = queries()["op3_gif_media"](spark, "/root/testdata/sf0.001").select("payload_bytes", "media_bytes").collect()
    assert sum(r.media_bytes - 800 for r in rows) < 0.8 * sum(r.payload_bytes for r in rows)


@pytest.mark.parametrize("followed", [64, 0])
def test_shared_passages_need_few_neighbourhoods(spark, monkeypatch, followed):
    """Texts that share a common passage are open after the short lists: following lists settles most, and links equal brute force."""
    rng = __import__("random").Random(7)
    word = lambda: f"w{rng.randrange(10**6)}"
    passages = [[word() for _ in range(66)] for _ in range(12)]
    texts = []
    for i in range(240):
        if i % 8 == 7:  # a near copy of an earlier text
            words = list(rng.choice(texts[-40:]))
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = word()
        else:
            words = rng.choice(passages) + [word() for _ in range(rng.randrange(8, 15))]
        texts.append(words)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    reach = list(range(len(sets)))

    def top(i):
        while reach[i] != i:
            i = reach[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if 100 * len(x & sets[j]) >= 80 * len(x | sets[j]):
                low, high = sorted((top(i), top(j)))
                reach[high] = low
    made = {"neighbourhoods": 0, "jaccard-open": 0}
    stage = jaccard.stage

    def counted(df, name, *a):
        out = stage(df, name, *a)
        if name in made:
            made[name] += out.count()
        return out

    monkeypatch.setattr(jaccard, "stage", counted)
    monkeypatch.setattr(jaccard, "_FOLLOWED", followed, raising=False)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.similar_documents(df).collect()}
    assert got == {i: top(i) for i in range(len(sets))}
    assert made["jaccard-open"] > 20
    assert (made["neighbourhoods"] < 20 * made["jaccard-open"]) if followed == 64 else made["neighbourhoods"] > 0
