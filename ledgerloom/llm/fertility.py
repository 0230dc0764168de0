"""Quality rules from tokeniser fertility: how well public vocabularies take a text.

Three figures of a text are held against bands that the corpus itself gives for each language and length: characters per token and
the entropy of the tokens under a byte-level vocabulary, and the share of tokens that a vocabulary with byte fallback has
to spell in bytes.  Figures that do not depend on a language, on repeats, symbols and length, are checked first.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import sent, slices
from ledgerloom.session import stage

RANKS, PIECES = "/opt/tokenizers/byte_bpe_50k.tiktoken", "/opt/tokenizers/piece_bpe_32k.model"
#: Cuts a text into words with a leading blank, numbers, marks and blanks before merges.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE, SYMBOLS = " \t\n\r\x0b\x0c", "#*$%&|<>"
LEAST_WORDS, MOST_REPEATS = 10, 20  # words, and per cent of words in repeated windows
WINDOW = 5
FENCE = 2.0  # interquartile ranges beyond the quartiles of its size class at which a text is rejected
STEPS = (2, 1)  # size classes for each doubling of the tokens; the finest that has LEAST_IN_CLASS documents holds
LEAST_IN_CLASS = 50
LOOSE_FENCE = 2.5  # the same for texts whose size class has too few documents, against texts of all sizes
LEAST_DOCS = 100  # documents of a language below which the band of all languages holds
KEPT_WORDS = 150_000
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, chars_per_token double, fallback_share double, entropy double"


class Vocabularies:
    """Both vocabularies as plain values, for tasks that cannot see their files."""

    def __init__(self, ranks: str = RANKS, pieces: str = PIECES):
        with open(ranks, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(pieces, "rb") as model:
            self.pieces = model.read()


class Gauge:
    """Figures of whole texts; remembers the tokens of words seen, up to a bound."""

    def __init__(self, v: Vocabularies):
        self.bpe = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=v.ranks, special_tokens={})
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=v.pieces)
        self.is_byte = np.array([self.sp.is_byte(i) for i in range(self.sp.get_piece_size())])
        self._forget()

    def _forget(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.tokens, self.starts = np.empty(0, np.int32), np.zeros(1, np.int64)
        self.n_pieces, self.n_bytes = np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        ids = [self.bpe.encode_ordinary(" " + t) for t in texts]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.tokens = np.concatenate([self.tokens, np.fromiter(chain.from_iterable(ids), np.int32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        pieces = self.sp.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        seen = np.concatenate([[0], np.cumsum(self.is_byte[np.fromiter(chain.from_iterable(pieces), np.int64)])])
        ends = np.cumsum(sizes)
        self.n_pieces = np.concatenate([self.n_pieces, sizes])
        self.n_bytes = np.concatenate([self.n_bytes, seen[ends] - seen[ends - sizes]])

    def figures(self, texts: list[str | None]) -> list[tuple]:
        if len(self.codes) > KEPT_WORDS:
            self._forget()
        known, find, out = len(self.codes), self.codes, []
        data = [(t or "").encode() for t in texts]
        words = [np.fromiter((find.setdefault(w, len(find)) for w in d.split()), np.int64) for d in data]
        if len(find) > known:
            self._learn(list(find)[known:])
        for text, raw, codes in zip(texts, data, words):
            text = text or ""
            lines = [line for line in raw.split(b"\n") if line.strip()]
            chars = len(text) - sum(map(text.count, SPACE))
            base = (len(codes), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated(codes))
            out.append((*base, *self._fertility(codes, chars)))
        return out

    def _fertility(self, codes: np.ndarray, chars: int) -> tuple:
        if not len(codes):
            return 0, None, None, None
        first, sizes = self.starts[codes], self.starts[codes + 1] - self.starts[codes]
        n = int(sizes.sum())
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(n)
        counts = np.unique(self.tokens[at], return_counts=True)[1]
        # As a share of the most that so many tokens can have.
        entropy = float(np.log(n) - (counts * np.log(counts)).sum() / n) / float(np.log(n)) if n > 1 else 0.0
        return n, chars / n, float(self.n_bytes[codes].sum() / self.n_pieces[codes].sum()), entropy


def repeated(codes: np.ndarray) -> int:
    """Words in windows of WINDOW words that occur twice or more, given the words as numbers."""
    n = len(codes) - WINDOW + 1
    if n < 2:
        return 0
    mixed = codes.astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        key = (key ^ (mixed[j : j + n] + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[place] > 1
    if not twice.any():
        return 0
    marks = np.zeros(len(codes) + 1, np.int64)
    marks[:n] += twice
    marks[WINDOW : WINDOW + n] -= twice
    return int((np.cumsum(marks)[:-1] > 0).sum())


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", vocabularies: Vocabularies | None = None) -> DataFrame:
    """``doc_id, lang`` and the figures of STATS of every whole text."""
    told = sent(docs.sparkSession, vocabularies or Vocabularies())

    @F.pandas_udf(STATS)
    def figures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        gauge = Gauge(told())
        names = [c.split()[0] for c in STATS.split(", ")]
        for batch in batches:
            texts = batch.tolist()
            yield pd.DataFrame([f for s, e in slices(texts) for f in gauge.figures(texts[s:e])], columns=names)

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{lang}`").alias("lang"), figures(F.col(f"`{text}`")).alias("s")).select("doc_id", "lang", "s.*")


def _band(column: str) -> list[Column]:
    low, high = (F.percentile_approx(column, p, 1000) for p in (0.25, 0.75))
    return [low.alias(f"{column}_low"), high.alias(f"{column}_high")]


FIGURES = ("chars_per_token", "fallback_share", "entropy")
#: Narrowest interquartile range that a band is taken to have.
LEAST_RANGE = {"chars_per_token": 0.04, "fallback_share": 0.005, "entropy": 0.03}
#: The same for a size class, in which texts scatter less.
LEAST_RANGE_IN_CLASS = {"chars_per_token": 0.02, "fallback_share": 0.005, "entropy": 0.01}


def _size(step: int) -> Column:
    return F.floor(step * F.log2(F.greatest("n_tokens", F.lit(1)))).cast("int")


def bands(figures: DataFrame) -> DataFrame:
    """Quartiles of each figure over all documents that pass the base rules: by language and size class for each of STEPS,
    by language (step 0), and one row for all (step null)."""
    passed = figures.where(~base_failed())
    made = [F.count(F.lit(1)).alias("docs"), *(c for f in FIGURES for c in _band(f))]
    of_size = [passed.groupBy("lang", _size(k).alias("size")).agg(*made).where(F.col("docs") >= LEAST_IN_CLASS).withColumn("step", F.lit(k)) for k in STEPS]
    by_lang = passed.groupBy("lang").agg(*made).where(F.col("docs") >= LEAST_DOCS).withColumns({"size": F.lit(0), "step": F.lit(0)})
    nothing = {"lang": F.lit(None).cast("string"), "size": F.lit(None).cast("int"), "step": F.lit(None).cast("int")}
    return reduce(DataFrame.unionByName, [*of_size, by_lang, passed.agg(*made).withColumns(nothing)])


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATS * F.col("n_words"))


def _inside() -> Column:
    """Whether every figure lies within its band.

    The band of a size class has the scatter of texts of that length in it.  One of all sizes is taken wider for shorter
    texts, whose figures scatter more, and has no upper side for entropy, which falls with the length.
    """
    slack = 1 + 16 / F.sqrt(F.greatest("n_tokens", F.lit(1)))
    fence = F.when(F.col("sized"), F.lit(FENCE)).otherwise(LOOSE_FENCE * slack)
    sides = []
    for f in FIGURES:
        least = F.when(F.col("sized"), F.lit(LEAST_RANGE_IN_CLASS[f])).otherwise(F.lit(LEAST_RANGE[f]))
        reach = fence * F.greatest(F.col(f"{f}_high") - F.col(f"{f}_low"), least)
        above = F.col(f) <= F.col(f"{f}_high") + reach
        sides.append(above | ~F.col("sized") if f == "entropy" else above)
        if f != "fallback_share":
            sides.append(F.col(f) >= F.col(f"{f}_low") - reach)
    inside = sides[0]
    for side in sides[1:]:
        inside = inside & side
    return F.coalesce(inside, F.lit(True))


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", label: str = "fertility") -> DataFrame:
    """One row per document: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept`` and the
    fertility figures.

    Null and empty texts have zeros, null fertility and fail the base rules.  A size class with fewer than LEAST_IN_CLASS
    passing documents is held against the band of its language, a null language, and one with fewer than LEAST_DOCS passing
    documents, against the band of all.  Repeated rows count one by one.  An empty table gives
    no rows.
    """
    figures = stage(measured(docs, doc_id, text, lang), label)
    limits = stage(bands(figures), f"{label}-bands")
    whole = limits.where("step IS NULL").first()
    edges = [c for c in limits.columns if c.endswith(("_low", "_high"))]
    joined, found = figures, []
    for step in (*STEPS, 0):
        size, name = (_size(step) if step else F.lit(0)), f"_band{step}"
        own = limits.where((F.col("step") == step) & F.col("lang").isNotNull()).select("lang", F.col("size").alias("_size"), F.struct(*edges).alias(name))
        joined = joined.withColumn("_size", size).join(own, ["lang", "_size"], "left").drop("_size")
        found.append(name)
    # One row of numbers for all languages together.
    edge = {c: F.coalesce(*(F.col(f"{name}.{c}") for name in found), F.lit(whole[c]).cast("double")) for c in edges}
    sized = F.coalesce(*(F.col(name) for name in found[:-1])).isNotNull()
    joined = joined.withColumns(edge | {"sized": sized})
    verdict = ~base_failed() & _inside()
    names = [c.split()[0] for c in STATS.split(", ")]
    return joined.select("doc_id", *names[:5], base_failed().alias("base_failed"), verdict.alias("kept"), *names[5:])
