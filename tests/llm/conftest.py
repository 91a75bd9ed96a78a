import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, blanks, copies, repeated rows and ids, a long text, and columns with clashing names."""
    rng = __import__("random").Random(1)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = [text(60) for _ in range(12)]
    line = "This very line is in many documents."
    rows = []
    for i, b in enumerate(base):
        words = b.split()
        rows.append((10 * i, b + "\n" + line))
        rows.append((10 * i + 1, b + "\n  " + line.upper() + "\t"))
        words[30] = "changed"
        rows.append((10 * i + 2, " ".join(words)))
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "one"), (504, "ONE"), (505, "a b c d"), (506, text(20000)), (None, base[0]), (507, base[1]), (507, base[1]), (507, text(30)), (508, "naïve ünï 漢字 " + text(9))]
    full = [(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t), "a", 1.5, "b", k) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, size string, score double, keep_bitmap string, n_dropped int").repartition(3).cache()


@pytest.fixture(scope="session")
def local(docs):
    return [r.asDict() for r in docs.collect()]
