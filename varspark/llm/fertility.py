"""Quality rules from public vocabularies: how well a tokenizer's pieces fit a text.

Each text is encoded with several public byte-level vocabularies.  Characters for a token tell how familiar its words
are, single bytes beyond ASCII (the vocabulary's fallback where it has no piece for a character) how foreign its
characters are, and the entropy of its ids how varied it is.  What is normal differs by language and length, so bands
are laid around the median of each language (script, where no language is given) and class of length, as wide as
the median deviation there says.  The histograms behind medians cover all documents that pass the base rules.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import pretokens
from .common import join_small, release, stage
from .textvec import Texts, span_hashes, texts, words

#: Vocabularies of a byte-level BPE (files of ranks) by which texts are measured, as public_tokenizers names them.
VOCABULARIES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")
#: Fewest words, and most percent of words in repeated windows of ``WINDOW`` words.
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5
#: A band reaches so many median deviations (scaled to a normal distribution's) to either side, and so many thousandths of the median
#: more; of fallback shares, which are mostly 0 and jump by whole tokens, so many tokens in a thousand more.
DEVIATIONS, SLACK, FALLBACK_SLACK = 4.0, 10, 50
#: Documents that a language and class of length need for bands of their own.
LEAST_DOCUMENTS = 50
#: Classes of length for each doubling of a text's tokens, and the class that stands for all lengths.
CLASSES, ALL_LENGTHS = 2, -1

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True
#: Names of scripts and the first code points of the ranges that belong to them (fixed values of Unicode, main blocks only).
SCRIPTS = ("other", "latin", "greek", "cyrillic", "hebrew", "arabic", "devanagari", "thai", "kana", "han", "hangul")
_RANGES = [(0x41, 1), (0x5B, 0), (0x61, 1), (0x7B, 0), (0xC0, 1), (0x250, 0), (0x370, 2), (0x400, 3), (0x530, 0), (0x590, 4), (0x600, 5), (0x700, 0), (0x900, 6), (0x980, 0), (0xE00, 7), (0xE80, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 8), (0x3100, 0), (0x3400, 9), (0xA000, 0), (0xAC00, 10), (0xD7B0, 0), (0x20000, 9), (0x32000, 0)]
_FROM, _SCRIPT = (np.array(x) for x in zip(*_RANGES))


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the flags hold in each text."""
    upto = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=upto[1:])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def _distinct(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return np.bincount(doc[new], minlength=n)


def base_counts(t: Texts, window: int = WINDOW) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of some whole texts."""
    data, off, n = t.data, t.offsets, len(t)
    w = words(t)
    out = {"n_words": np.bincount(w.doc, minlength=n), "word_chars": _sums(~_SPACES[data] & ((data & 0xC0) != 0x80), off), "n_symbols": _sums(_SYMBOL[data], off)}
    # lines: from a text's start or behind a line feed to the next one or the text's end
    feed = np.flatnonzero(data == 10)
    doc = np.concatenate([np.arange(n), np.searchsorted(off, feed, "right") - 1])
    start, end = np.concatenate([off[:-1], feed + 1]), np.concatenate([feed, off[1:]])
    start, end = np.sort(start, kind="stable"), np.sort(end, kind="stable")
    doc = np.sort(doc, kind="stable")
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~_SPACES[data], out=filled[1:])
    some = filled[end] > filled[start]
    doc, h = doc[some], span_hashes(t, start[some], end[some])
    out["n_dup_lines"] = np.bincount(doc, minlength=n) - _distinct(doc, h, n)
    # words of windows that their text holds twice or more
    k = len(w.hash) - window + 1
    out["n_repeat_words"] = np.zeros(n, np.int64)
    if k > 0:
        at = np.flatnonzero(w.doc[window - 1 :] == w.doc[:k])
        h = np.zeros(len(at), np.uint64)
        for i in range(window):
            h = h * np.uint64(0x9E3779B97F4A7C15) + w.hash[at + i]
        own = w.doc[at]
        order = np.lexsort((h, own))
        same = (own[order][1:] == own[order][:-1]) & (h[order][1:] == h[order][:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.zeros(len(w.hash) + 1, np.int64)
        np.add.at(edge, at[twice], 1)
        np.add.at(edge, at[twice] + window, -1)
        out["n_repeat_words"] = np.bincount(w.doc[np.cumsum(edge[:-1]) > 0], minlength=n)
    return out


def script_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The number in ``SCRIPTS`` of the script that most letters of each text (of code points) have; other without letters."""
    kind = np.where(data < 0x41, 0, _SCRIPT[np.maximum(np.searchsorted(_FROM, data, "right") - 1, 0)])
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(doc * len(SCRIPTS) + kind, minlength=n * len(SCRIPTS)).reshape(n, len(SCRIPTS))
    counts[:, 0] = 0
    return counts.argmax(1)


class Vocabulary:
    """A byte-level vocabulary with what its ids say: ``single`` marks ids of one byte beyond ASCII."""

    def __init__(self, path: str, pattern: str):
        self.encoder = pretokens.encoder(path, pattern)
        bpe = self.encoder.bpe
        self.size = bpe.n_vocab
        self.single = np.zeros(self.size, bool)
        for b in range(128, 256):
            self.single[bpe.encode_single_token(bytes([b]))] = True


def token_measures(pieces: list[str], vocabularies: list[Vocabulary]) -> dict[str, np.ndarray]:
    """Of some whole texts: n_chars, script, and for vocabulary k tokens_k, single_k (ids of one byte beyond ASCII) and
    entropy_k (bits, of the ids' shares)."""
    data, offsets = pretokens.code_points(pieces)
    start = pretokens.boundaries(data, offsets)
    end = np.append(start[1:], len(data)) if len(start) else start
    edge = np.searchsorted(start, offsets)
    out = {"n_chars": np.diff(offsets), "script": script_of(data, offsets)}
    m = len(pieces)
    for k, v in enumerate(vocabularies):
        n, ids = v.encoder.found(data, start, end) if len(start) else (np.zeros(0, np.int64), np.zeros(0, np.int32))
        upto = np.concatenate([[0], np.cumsum(n)])[edge]
        total = np.diff(upto)
        doc = np.repeat(np.arange(m), total)
        key = np.sort(doc * v.size + ids)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        c = np.diff(np.append(first, len(key))).astype(float)
        own = key[first] // v.size
        spread = np.bincount(own, c * np.log2(c), minlength=m)
        out |= {f"tokens_{k}": total, f"single_{k}": _sums(v.single[ids], upto), f"entropy_{k}": np.log2(np.maximum(total, 1)) - spread / np.maximum(total, 1)}
    return out


_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measured(batches: Iterator[pa.RecordBatch], paths: tuple[str, ...], pattern: str, fields: pa.Schema) -> Iterator[pa.RecordBatch]:
    vocabularies = [Vocabulary(p, pattern) for p in paths]
    try:
        for b in batches:
            column = b.column("__text")
            for t in texts(column, 1 << 19):
                part = column.slice(t.first, len(t)).cast(pa.large_string()).fill_null("").to_pylist()
                found = base_counts(t) | token_measures(part, vocabularies)
                rest = b.slice(t.first, len(t))
                yield pa.RecordBatch.from_arrays([rest.column(f.name) if f.name in b.schema.names else pa.array(found[f.name]).cast(f.type) for f in fields], schema=fields)
    finally:
        vocabularies.clear()
        pretokens.release()
        release()


def measures(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, vocabularies=VOCABULARIES, folder=None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all without ``text_col`` by default) as a struct ``kept``, with the counts of every whole text:
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_chars, script, and tokens_k, single_k, entropy_k of vocabulary k.

    A null text counts as an empty one.  ``folder``: a function from a vocabulary's name to its file."""
    import public_tokenizers
    from pyspark.sql.pandas.types import to_arrow_schema

    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    source = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("kept"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    names = ", ".join([*(f"{c} long" for c in (*_BASE, "n_chars", "script")), *(f"tokens_{k} long, single_{k} long, entropy_{k} double" for k in range(len(vocabularies)))])
    schema = source.select("kept").schema
    for f in docs.sparkSession.createDataFrame([], names).schema:
        schema = schema.add(f)
    paths = tuple(str((folder or public_tokenizers.path)(v)) for v in vocabularies)
    # the struct's own fields come as Arrow gives them
    run = partial(_measured, paths=paths, pattern=public_tokenizers.PATTERN, fields=to_arrow_schema(schema))
    return source.mapInArrow(run, schema)


def _rates(n_vocabularies: int) -> dict[str, Column]:
    """What bands are laid around, in thousandths: characters for a token, single bytes for 1000 tokens, bits of entropy."""
    out = {}
    for k in range(n_vocabularies):
        n = F.greatest(F.col(f"tokens_{k}"), F.lit(1))
        out[f"fertility_{k}"] = F.round(1000 * F.col("n_chars") / n).cast("long")
        out[f"fallback_{k}"] = F.round(1000 * F.col(f"single_{k}") / n).cast("long")
        out[f"entropy_{k}"] = F.round(1000 * F.col(f"entropy_{k}")).cast("long")
    return out


def _median(hist: DataFrame, by: list[str], bin_: str, name: str) -> DataFrame:
    """The lower median of ``bin_`` weighted by ``n`` in each group: groups hold a row for each bin, whatever the number of documents."""
    hist = hist.groupBy(*by, bin_).agg(F.sum("n").alias("n"))
    up = Window.partitionBy(*by).orderBy(bin_)
    whole = Window.partitionBy(*by)
    return hist.withColumn("__upto", F.sum("n").over(up)).withColumn("__all", F.sum("n").over(whole)).filter(2 * F.col("__upto") >= F.col("__all")).groupBy(*by).agg(F.min(bin_).alias(name), F.max("__all").alias("n_documents"))


def bands(measured: DataFrame, n_vocabularies: int, deviations: float = DEVIATIONS, slack: int = SLACK, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(band, length, bounds): for each language or script and class of length the lowest and highest value of each rate that
    stays; length is ``ALL_LENGTHS`` where they are taken together, which leaves out entropy, as that grows with a text.  ``measured`` has the columns
    band, length and the rates.  Values are counted by thousandths, so what windows see is bounded."""
    rates = list(_rates(n_vocabularies))
    long = measured.select("band", "length", F.explode(F.array(*(F.struct(F.lit(r).alias("rate"), F.col(r).alias("value")) for r in rates))).alias("x")).select("band", "length", "x.*")
    by = ["band", "length", "rate"]
    hist = stage(long.groupBy(*by, "value").agg(F.count("*").alias("n")), "fertility-histogram")
    whole = hist.filter(~F.col("rate").startswith("entropy")).groupBy("band", F.lit(ALL_LENGTHS).alias("length"), "rate", "value").agg(F.sum("n").alias("n"))
    hist = hist.unionByName(whole)
    mid = _median(hist, by, "value", "mid")
    off = hist.join(mid.drop("n_documents"), by).withColumn("off", F.abs(F.col("value") - F.col("mid")))
    wide = _median(off, by, "off", "mad").drop("n_documents")
    more = F.when(F.col("rate").startswith("fallback"), F.lit(float(FALLBACK_SLACK))).otherwise(F.lit(slack / 1000) * F.col("mid"))
    # all lengths: short texts vary more than the median deviation says
    reach = F.when(F.col("length") == ALL_LENGTHS, F.lit(1.5)).otherwise(F.lit(1.0)) * F.lit(1.4826 * deviations) * F.col("mad") + more
    found = mid.filter(F.col("n_documents") >= least).join(wide, by).select(*by, (F.col("mid") - reach).alias("low"), (F.col("mid") + reach).alias("high"))
    return found.groupBy("band", "length").agg(F.map_from_entries(F.collect_list(F.struct("rate", F.struct("low", "high")))).alias("bounds"))


def fertility_rules(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", keep: list[str] | None = None, vocabularies=VOCABULARIES, least: int = LEAST_DOCUMENTS, folder=None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all but the text by default) as the struct ``kept``, with counts, rates and verdicts of every row:

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (words in windows of 5 words that the text holds twice or more),
    base_failed, and for vocabulary k the rates fertility_k (characters for 1000 tokens), fallback_k, entropy_k (thousandths of
    bits); kept_by_rules: base passed and no rate outside its band; broken: the rates outside.

    Bands are those of the row's language and class of length; where fewer than ``least`` documents that pass the base rules are there,
    those of the language over all lengths (without entropy), then those of its script, likewise; rows without a language have their script's.
    Where even a script has too few documents nothing is known to be normal, and nothing is rejected.
    Null and empty texts have no words and fail the base rules.  Repeated rows count as often as they are there and get the same
    verdict.  Columns of any names may be in ``keep``: they stay inside the struct.  An empty table gives an empty result."""
    k = len(vocabularies)
    lang = F.lit(None).cast("string") if lang_col is None else F.col(f"`{lang_col}`").cast("string")
    given = docs.select(F.struct(*(F.col(f"`{c}`") for c in (keep if keep is not None else [c for c in docs.columns if c != text_col]))).alias("own"), lang.alias("lang"), F.col(f"`{text_col}`").alias("text"))
    m = stage(measures(given, vocabularies=vocabularies, folder=folder), "fertility")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    script = F.concat(F.lit("script "), F.element_at(F.array(*map(F.lit, SCRIPTS)), F.col("script").cast("int") + 1))
    length = F.floor(CLASSES * F.log2(F.greatest(F.col("tokens_0"), F.lit(1)))).cast("int")
    m = m.select(F.col("kept.own").alias("kept"), *_BASE, failed.alias("base_failed"), F.coalesce(F.concat(F.lit("language "), F.col("kept.lang")), script).alias("band"), script.alias("script_band"), length.alias("length"), *(v.alias(r) for r, v in _rates(k).items()))
    good = m.filter(~F.col("base_failed"))
    both = good.unionByName(good.withColumn("band", F.col("script_band")).filter(m["band"] != m["script_band"]))
    found = stage(bands(both, k, least=least), "fertility-bands")
    for i, (band, at) in enumerate((("band", "length"), ("band", ""), ("script_band", "length"), ("script_band", ""))):
        bound = found if at else found.filter(F.col("length") == ALL_LENGTHS).drop("length")
        bound = bound.withColumnsRenamed({"band": band, "bounds": f"__{i}"})
        m = join_small(m, bound, [band, at] if at else [band])
    bounds = F.coalesce(*(f"__{i}" for i in range(4)))
    outside = F.array_compact(F.array(*(F.when(~F.col(r).between(bounds[r]["low"], bounds[r]["high"]), F.lit(r)) for r in _rates(k))))
    return m.select("kept", *_BASE, "base_failed", (~F.col("base_failed") & (F.size(outside) == 0)).alias("kept_by_rules"), outside.alias("broken"), *_rates(k))
