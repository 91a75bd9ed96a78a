"""What the review of the first round found missing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from varspark.llm import html, jaccard, mixing


def test_needed_covers_every_partner():
    percent = 80
    first, last = jaccard.bands(percent)
    for size in range(1, 3001):
        band = int(np.searchsorted(first, size, "right") - 1)
        for role in (0, 1):
            low = -(-size * percent // 100) if role else int(first[band])
            high = int(last[band - 1]) if role and band else 0 if role else size * 100 // percent
            p = np.arange(low, high + 1)
            p = p[(100 * p >= percent * size) & (100 * size >= percent * p)]
            if len(p):
                most = int(jaccard.most_errors(np.full(len(p), size), p, percent).max())
                assert jaccard.needed(np.array([size]), np.array([band]), role, percent)[0] > most, (size, role)


def test_jaccard_of_short_texts_in_neighbouring_bands(spark):
    rows = []
    for small, large in (9, 11), (12, 15), (16, 20), (27, 33):
        for i in range(40):
            words = [f"x{small}y{i}z{j}" for j in range(large + 4)]
            a = 2 * (100 * small + i)
            rows += [(a, " ".join(words[: small + 4])), (a + 1, " ".join(words))]
    got = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and all(r.component_id == r.doc_id // 2 * 2 for r in got)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_mixing_passes_over_what_does_not_fit(spark, seed):
    """Source a: one document of 20,000 words and 200 of 100; its target is 36,000 of 40,000 words."""
    sized = [(i, "a", 20_000 if i == 0 else 100) for i in range(201)] + [(1000 + i, "b", 100) for i in range(680)]
    d = spark.createDataFrame(sized, "doc_id long, source string, n int").withColumn("text", F.expr("repeat('w ', n)")).drop("n")
    plan = mixing.mix(d, seed=seed).filter("source = 'a'").groupBy().agg(F.first("target").alias("t"), F.sum("taken").alias("n"), F.first("source_size").alias("s")).first()
    assert plan.t == pytest.approx(36_000) and plan.s == 40_000
    assert abs(plan.n - plan.t) <= 50


def test_blocks_lose_no_article_to_open_elements():
    for before in '<svg class="i"/>', '<object data="a"/>', "<select-menu>x</select-menu>", "<button-bar>", "<button>", "<select>", '<iframe src="x">', "<svg>", "<object>":
        page = f"<div>{before}<p>Article</p></div><div><button>Send</button><select><option>1</select><iframe></iframe><svg><title>t</title></svg><object></object></div>"
        found = [b.text for b in html.blocks(page)]
        assert "Article" in found and not {"Send", "1", "t"} & set(found), before
    assert [b.text for b in html.blocks("<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds<svg><g>no</g></svg>.</p>")] == ["So x=1 holds ."]
    assert [b.text for b in html.blocks("<svg><svg>a</svg>b</svg><p>c</p><script>d</p>")] == ["c"]


def test_features_read_the_whole_block():
    same = "some words of one opening " * 20
    a, b, c = (html.features([html.Block(html.path_of(("t:p",)), same + rest, 0)])[0] for rest in ("alpha beta gamma " * 50, "delta omega kappa " * 50, "alp, bet. gamma; " * 50))
    assert (a[html._PATH : html._PATH + html._WORDS] != b[html._PATH : html._PATH + html._WORDS]).any() and c[-6] > a[-6]
    assert a[html._PATH : html._PATH + html._WORDS].sum() == pytest.approx(1)


def test_mixed_keeps_every_column_and_row(spark):
    """Rows of one id and text but other columns stay apart, and clashing names come through."""
    rows = [(1, "a b c", f"x{i % 3}", i % 2, "s") for i in range(9)] + [(2, "a b c", "y", 5, "s"), (None, "q r", "n1", 1, "t"), (None, "q r", "n2", 2, "t"), (3, None, "z", 1, "t"), (4, "q r", "k", 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __r string, __n int, source string").repartition(3)
    from collections import Counter

    plan = docs.select("doc_id", F.xxhash64("text").alias("rid"), F.when(F.col("text").isNull(), 0).when(F.col("doc_id") == 1, F.col("__n") + 1).otherwise(3).cast("long").alias("copies"))
    got = mixing.mixed(docs, plan)
    assert got.columns == docs.columns
    found = Counter(tuple(r) for r in got.collect())
    group = [r for r in rows if r[0] == 1]
    total = sum(r[3] + 1 for r in group)
    assert sum(n for r, n in found.items() if r[0] == 1) == total
    for r, k in Counter(group).items():  # each different row has its share
        assert abs(found[r] - total * k / len(group)) < 1
    assert {r: n for r, n in found.items() if r[0] != 1} == {r: 3 for r in rows if r[0] != 1 and r[1] is not None}


@pytest.mark.parametrize("page,want", [
    ('<p class="a"">First..</p><p class="b">Second.</p><p class="c"">Third.</p><p>Fourth</p>', ["First..", "Second.", "Third.", "Fourth"]),
    ("<p title=it's>First.</p><p>Second it's here.</p><p>Third</p>", ["First.", "Second it's here.", "Third"]),
    ('<p "a" class = "x > y" b=\'>\'>One</p><p c=">Two</p><p>Three</p>', ["One", "Two", "Three"]),
    ("<p a=b\"c>One</p><p =\"q\">Two</p><p/>Three", ["One", "Two", "Three"]),
])
def test_quotes_open_values_only(page, want):
    assert [b.text for b in html.blocks(page)] == want


def test_depth_costs_nothing():
    import time

    start = time.perf_counter()
    found = html.blocks('<div class="a b">x' * 20_000 + "</span></b></section>" * 20_000)
    assert len(found) == 20_000 and time.perf_counter() - start < 2
    assert found[-1].path == html.path_of(("t:div", "c:a", "c:b")) and found[-1].depth == 60_000
    closed = html.blocks("<div id=a><p>one</p></div><p>two")
    assert closed[0].path == html.path_of(("t:div", "c:a", "t:p")) and closed[1].path == html.path_of(("t:p",))


@pytest.mark.parametrize("extra", [[1e200], [1e-200], [1e200, -1e200, 1e-200, 1e-310, 3e5, 1e160], [1e308] * 30])
def test_neighbours_of_vectors_of_any_size(spark, extra):
    """Huge and tiny vectors beside ordinary ones, as candidates and as queries, against brute force."""
    from varspark.llm import ann

    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(400)]
    rows += [(1000 + 20 * j, (v * np.sign(rng.normal(size=16)) if j % 2 else np.full(16, v)).tolist()) for j, v in enumerate(extra)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, lambda i: i % 20 == 0, k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    x = dict((i, np.array(v)) for i, v in rows)
    hits = wanted = 0
    for q in (i for i in x if i % 20 == 0):
        with np.errstate(over="ignore", invalid="ignore"):
            s = {i: float((x[q] * v).sum()) for i, v in x.items() if i != q}
        s = {i: -np.inf if np.isnan(v) else v for i, v in s.items()}
        best = sorted(s, key=lambda i: (-s[i], i))[:20]
        assert len(got[q]) == 20 and all(v == s[i] or v == pytest.approx(s[i], rel=1e-12) for i, v in got[q])
        keys = [(-v, i) for i, v in got[q]]
        assert keys == sorted(keys)
        hits += len({i for i, _ in got[q]} & set(best))
        wanted += 20
    assert hits >= 0.99 * wanted


def test_all_vectors_huge_or_tiny(spark):
    from varspark.llm import ann

    rng = np.random.default_rng(6)
    for size in (1e250, 1e-250):
        df = spark.createDataFrame([(i, (rng.normal(size=8) * size).tolist()) for i in range(60)], "vec_id long, embedding array<double>")
        assert ann.nearest(df, lambda i: i % 20 == 0, k=5).count() == 15
