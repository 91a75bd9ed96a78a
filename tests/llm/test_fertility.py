"""Fertility rules against plain loops over the same texts, and the tokenizers' own ids."""

import base64
import math
import re
from collections import Counter, defaultdict

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from varspark.llm import fertility
from varspark.llm.queries import queries
from varspark.llm.textvec import texts

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if n[x] > 1 for j in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def reference(name):
    with open(P.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


HARD = ["", None, " ", "\n", "a\n\na\n a\na", "\x0b\x0c\r\n", "a b c d e " * 3, "a b c d e\n" * 2, "one", "naïve 漢字かな\n漢字かな", "x" * 70_000, "###$$$ |<>| & %", "𝔘𝔫𝔦 \U0001f600", "don't we'll\nx", "a b c d a b c d a b", "  lead\ntrail  \n  lead"]


def test_counts_of_hard_texts():
    for most in (3, 1 << 20):
        for t in texts(pa.array(HARD), most):
            got = fertility.base_counts(t)
            for i in range(len(t)):
                assert tuple(int(got[c][i]) for c in fertility._BASE) == plain(HARD[t.first + i]), HARD[t.first + i]


def test_token_measures_equal_the_tokenizers():
    own = [fertility.Vocabulary(P.path(v), P.PATTERN) for v in fertility.VOCABULARIES]
    sample = [t or "" for t in HARD]
    got = fertility.token_measures(sample, own)
    for k, name in enumerate(fertility.VOCABULARIES):
        enc = reference(name)
        for i, t in enumerate(sample):
            ids = enc.encode_ordinary(t)
            n = Counter(ids)
            assert got[f"tokens_{k}"][i] == len(ids)
            assert got[f"single_{k}"][i] == sum(len(b := enc.decode_single_token_bytes(x)) == 1 and b[0] > 127 for x in ids)
            assert got[f"entropy_{k}"][i] == pytest.approx(-sum(c / len(ids) * math.log2(c / len(ids)) for c in n.values()) if ids else 0, abs=1e-9)
    names = dict(zip(sample, (fertility.SCRIPTS[s] for s in got["script"])))
    assert names["one"] == "latin" and names["naïve 漢字かな\n漢字かな"] == "latin" and names["###$$$ |<>| & %"] == "other"
    assert fertility.SCRIPTS[fertility.token_measures(["Привет, мир x"], own)["script"][0]] == "cyrillic"


def median(values):
    return sorted(values)[(len(values) - 1) // 2]


def test_query_against_plain_loops(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries()["op11_tokeniser_fertility"](spark, DATA).collect()}
    assert len(got) == len(docs)
    encs = [reference(v) for v in fertility.VOCABULARIES]
    groups, rows = defaultdict(list), {}
    for d in docs:
        n, chars, symbols, dup, repeat = plain(d.text)
        r = got[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)
        rates, first = {}, 1
        for k, enc in enumerate(encs):
            ids = enc.encode_ordinary(d.text or "")
            m = max(1, len(ids))
            first = m if k == 0 else first
            rates[f"fertility_{k}"] = math.floor(1000 * len(d.text or "") / m + 0.5)
            rates[f"fallback_{k}"] = math.floor(1000 * sum(len(b := enc.decode_single_token_bytes(x)) == 1 and b[0] > 127 for x in ids) / m + 0.5)
            rates[f"entropy_{k}"] = r[f"entropy_{k}"]
            assert r[f"entropy_{k}"] == pytest.approx(-1000 * sum(c / m * math.log2(c / m) for c in Counter(ids).values()), abs=0.51)
        assert all(r[c] == v for c, v in rates.items())
        length = math.floor(2 * math.log2(first))
        rows[d.doc_id] = (d.lang, length, rates, r)
        if not r.base_failed:
            for band in {("language", d.lang), ("script", "latin")}:  # all test documents are in Latin script
                for rate, v in rates.items():
                    groups[band, length, rate].append(v)
                    if not rate.startswith("entropy"):
                        groups[band, -1, rate].append(v)

    def band(key):
        v = groups.get(key, [])
        if len(v) < fertility.LEAST_DOCUMENTS:
            return None
        mid = median(v)
        mad = median([abs(x - mid) for x in v])
        more = fertility.FALLBACK_SLACK if key[2].startswith("fallback") else fertility.SLACK / 1000 * mid
        reach = (1.5 if key[1] == -1 else 1) * 1.4826 * fertility.DEVIATIONS * mad + more
        return mid - reach, mid + reach

    rejected = 0
    for lang, length, rates, r in rows.values():
        broken = []
        for name, v in rates.items():
            probe = "fertility_0"
            for b, at in ((("language", lang), length), (("language", lang), -1), (("script", "latin"), length), (("script", "latin"), -1)):
                if band((b, at, probe)) is not None:
                    found = band((b, at, name)) if not (at == -1 and name.startswith("entropy")) else None
                    if found and not found[0] <= v <= found[1]:
                        broken.append(name)
                    break
        assert r.broken == ",".join(n for n in ("fertility_0", "fallback_0", "entropy_0", "fertility_1", "fallback_1", "entropy_1") if n in broken)
        assert r.kept == (not r.base_failed and not broken)
        rejected += not r.kept
    assert 0 < rejected < len(rows) / 2


def test_hard_tables(spark, docs, local):
    found = fertility.fertility_rules(docs)
    got = found.collect()
    assert len(got) == len(local) and set(got[0].kept.asDict()) == set(docs.columns) - {"text"}
    want = Counter((r["doc_id"], *plain(r["text"])) for r in local)
    assert Counter((r.kept.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert all(r.base_failed and not r.kept_by_rules for r in got if r.n_words < 10)
    assert fertility.fertility_rules(docs.limit(0)).count() == 0
    few = fertility.fertility_rules(docs.filter("doc_id < 100"), lang_col=None, least=1000)  # nothing known, nothing rejected
    assert few.filter(~F.col("base_failed") & ~F.col("kept_by_rules")).count() == 0
    named = docs.withColumnsRenamed({"n_chars": "n_words", "score": "band", "size": "broken"})
    assert fertility.fertility_rules(named).count() == len(local)
