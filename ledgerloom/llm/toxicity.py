"""Toxicity of whole texts by a bidirectional gated recurrent network over overlapping word windows.

Every word enters as a hashed word vector next to the mean of its hashed character n-gram vectors.  Two gated recurrent
layers read a window in either direction, attention pools their states, and a document's score is the highest of all its
windows.  The network is trained in numpy on a bounded sample of labelled documents: as a label says nothing about where
a text is toxic, each step learns from the window that scores highest at that time.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import sent, slices

WINDOW, STRIDE = 48, 36
WORD_ROWS, GRAM_ROWS, GRAM_SIZES = 1 << 13, 1 << 14, (3, 4, 5)
WIDE, HIDDEN, HEADS = 12, 8, 4
#: The fit sees at most this many documents of either class, none longer than this.
SAMPLE_PER_CLASS, SAMPLE_CHARS = 1500, 1 << 16
STEPS, BATCH_DOCS, RATE, SEED = 360, 24, 0.01, 7
#: Words and n-grams of fewer training documents keep the zero vector that unseen ones have.
LEAST_DOCS = 3
KEPT_WORDS = 60_000  # words whose vectors a task keeps for the texts to come
BATCH_WINDOWS = 1024

Params = dict[str, np.ndarray]
_LETTERS = re.compile(r"\w+").findall


def split(text: str | None) -> list[str]:
    """Runs of letters and digits; a text that has none but isn't blank counts as its blank-separated strings."""
    low = text.lower() if text else ""
    return _LETTERS(low) or low.split()


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of each word's own vector, and (gram rows, the word each belongs to) of all their character n-grams."""
    rows = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in words), np.int64, len(words)) % WORD_ROWS
    flat = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    of = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)) + 2)
    grams, owners = [], []
    for size in GRAM_SIZES:
        k = len(flat) - size + 1
        if k <= 0:
            continue
        h = np.full(k, size, np.uint64)
        for j in range(size):
            h = (h ^ flat[j : j + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        inside = of[:k] == of[size - 1 :]
        grams.append((h[inside] % np.uint64(GRAM_ROWS)).astype(np.int64))
        owners.append(of[:k][inside])
    none = np.empty(0, np.int64)
    return rows, np.concatenate([none, *grams]), np.concatenate([none, *owners])


def _windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and length of every window; each text with a word has one at least, the last ends with it."""
    count = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // STRIDE)), 0)
    doc = np.repeat(np.arange(len(sizes)), count)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(place * STRIDE, np.maximum(sizes[doc] - WINDOW, 0))
    base = np.cumsum(sizes) - sizes
    return doc, base[doc] + start, np.minimum(sizes[doc], WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


def _tanh(x: np.ndarray) -> np.ndarray:
    """By way of exp, which numpy has in vector form on more machines than tanh."""
    with np.errstate(over="ignore"):
        return 1 - 2 / (1 + np.exp(2 * x))


class Network:
    """Parameters with forward and backward pass; ``p`` maps names to float32 arrays."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p: Params = {
            "word": np.zeros((WORD_ROWS, WIDE), np.float32), "gram": np.zeros((GRAM_ROWS, WIDE), np.float32),
            "in": draw(2 * WIDE, 6 * HIDDEN, scale=0.3), "in0": np.zeros(6 * HIDDEN, np.float32),
            "up": draw(2, HIDDEN, 3 * HIDDEN, scale=0.25),
            "att": draw(2 * HIDDEN, HEADS, scale=0.3), "att0": np.zeros(HEADS, np.float32), "pick": draw(HEADS, scale=0.3),
            "out": draw(2 * HIDDEN, scale=0.3), "out0": np.zeros(1, np.float32),
        }

    def inputs(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """Input vectors of distinct words, and what the way back needs."""
        rows, grams, owners = word_features(words)
        count = np.maximum(np.bincount(owners, minlength=len(words)), 1).astype(np.float32)
        mean = np.zeros((len(words), WIDE), np.float32)
        known = np.flatnonzero(self.p["gram"].any(axis=1)[grams])
        for k in range(WIDE):
            mean[:, k] = np.bincount(owners[known], self.p["gram"][grams[known], k], len(words))
        mean /= count[:, None]
        return np.hstack([self.p["word"][rows], mean]), (rows, grams, owners, count)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """Input part of all gates of both directions."""
        return x @ self.p["in"] + self.p["in0"]

    def run(self, gates: np.ndarray, index: np.ndarray, size: np.ndarray, keep: bool = False):
        """Logit of every window; ``index`` has a row of places in ``gates`` for each window, ``size`` its words."""
        n, steps, H = len(index), index.shape[1], HIDDEN
        states = np.zeros((steps, n, 2 * H), np.float32)
        short = bool((size < steps).any())
        columns = np.ascontiguousarray(index.T)
        kept = []
        for d, order in enumerate((range(steps), range(steps - 1, -1, -1))):
            h = np.zeros((n, H), np.float32)
            up, at = self.p["up"][d], slice(3 * H * d, 3 * H * (d + 1))
            own = np.ascontiguousarray(gates[:, at])
            for t in order:
                g = np.take(own, columns[t], axis=0)
                u = h @ up
                zr = _sigmoid(g[:, : 2 * H] + u[:, : 2 * H])
                z, r = zr[:, :H], zr[:, H:]
                c = _tanh(g[:, 2 * H :] + r * u[:, 2 * H :])
                new = c + z * (h - c)
                if short:
                    new = np.where((t < size)[:, None], new, h)
                if keep:
                    kept.append((d, t, h, u[:, 2 * H :], z, r, c))
                h = new
                states[t, :, d * H : (d + 1) * H] = h
        tanh = _tanh(states @ self.p["att"] + self.p["att0"])
        score = tanh @ self.p["pick"]
        if short:
            score = np.where(np.arange(steps)[:, None] < size, score, np.float32(-1e9))
        share = np.exp(score - score.max(axis=0))
        share /= share.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", share, states)
        logit = pooled @ self.p["out"] + self.p["out0"]
        return (logit, (index, size, states, tanh, share, pooled, kept)) if keep else logit

    def back(self, d_logit: np.ndarray, memory: tuple, n_words: int) -> tuple[Params, np.ndarray]:
        """Gradients of the network's own parameters, and of the gates' input part of each word."""
        index, size, states, tanh, share, pooled, kept = memory
        n, steps, H = len(index), index.shape[1], HIDDEN
        g: Params = {"out": pooled.T @ d_logit, "out0": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.p["out"]
        d_states = share[:, :, None] * d_pooled
        d_share = np.einsum("tnh,nh->tn", states, d_pooled)
        d_score = share * (d_share - (share * d_share).sum(axis=0))
        g["pick"] = np.einsum("tnk,tn->k", tanh, d_score)
        d_tanh = d_score[:, :, None] * self.p["pick"] * (1 - tanh * tanh)
        g["att"] = np.einsum("tnh,tnk->hk", states, d_tanh)
        g["att0"] = d_tanh.sum(axis=(0, 1))
        d_states += d_tanh @ self.p["att"].T
        g["up"] = np.zeros_like(self.p["up"])
        flat = np.zeros((2, steps, n, 3 * H), np.float32)
        d_h = np.zeros((n, H), np.float32)
        for i in range(len(kept) - 1, -1, -1):
            d, t, h, u, z, r, c = kept[i]
            if i == len(kept) - 1 or kept[i + 1][0] != d:
                d_h = np.zeros((n, H), np.float32)
            d_h = d_h + d_states[t, :, d * H : (d + 1) * H]
            live = (t < size)[:, None]
            d_new = np.where(live, d_h, 0)
            d_c = d_new * (1 - z) * (1 - c * c)
            d_z = d_new * (h - c) * z * (1 - z)
            d_r = d_c * u * r * (1 - r)
            d_u = np.hstack([d_z, d_r, d_c * r])
            g["up"][d] += h.T @ d_u
            flat[d, t] = np.hstack([d_z, d_r, d_c])
            d_h = np.where(live, d_new * z, d_h) + d_u @ self.p["up"][d].T
        at = np.ascontiguousarray(index.T).ravel()
        return g, np.hstack([_added(at, x.reshape(-1, 3 * H), n_words) for x in flat])


class Adam:
    """Adaptive steps; rows of a vector table move only when they have a gradient."""

    def __init__(self, p: Params, rate: float = RATE):
        self.p, self.rate, self.n = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, gradients: dict) -> None:
        self.n += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.n) / (1 - 0.9**self.n)
        for name, g in gradients.items():
            rows = slice(None)
            if isinstance(g, tuple):
                rows, g = g
            m = self.m[name][rows] * 0.9 + 0.1 * g
            v = self.v[name][rows] * 0.999 + 0.001 * g * g
            self.m[name][rows], self.v[name][rows] = m, v
            self.p[name][rows] -= scale * m / (np.sqrt(v) + 1e-6)


def _added(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of the values of each row from 0 to ``n`` - 1."""
    return np.stack([np.bincount(rows, column, n) for column in values.T], axis=1).astype(np.float32)


def _summed(rows: np.ndarray, values: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that may move, each with the sum of its gradients."""
    move = free[rows]
    used, place = np.unique(rows[move], return_inverse=True)
    return used, _added(place, values[move], len(used))


def _free(docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Which word and n-gram rows occur in LEAST_DOCS documents or more."""
    word, gram = np.zeros(WORD_ROWS, np.int64), np.zeros(GRAM_ROWS, np.int64)
    for doc in docs:
        rows, grams, _ = word_features(list(set(doc)))
        word[np.unique(rows)] += 1
        gram[np.unique(grams)] += 1
    return word >= LEAST_DOCS, gram >= LEAST_DOCS


def _coded(texts: list[list[str]]) -> tuple[list[str], np.ndarray]:
    words: dict[str, int] = {}
    codes = np.fromiter((words.setdefault(w, len(words)) for t in texts for w in t), np.int64)
    return list(words), codes


def _index(start: np.ndarray, size: np.ndarray, codes: np.ndarray) -> np.ndarray:
    steps = np.arange(int(size.max()) if len(size) else 0)
    return codes[np.minimum(start[:, None] + steps, len(codes) - 1)]


def train(texts: list[str], toxic: list[int], steps: int = STEPS) -> Network:
    """Fit on whole labelled texts in ``steps`` steps; the same texts in the same order give the same network."""
    net, rng = Network(), np.random.default_rng(SEED)
    docs = [split(t) for t in texts]
    labels = np.array(toxic, np.float32)
    # Every step learns from as many toxic as other texts, in turn, however few there are of either.
    classes = [np.array([i for i, d in enumerate(docs) if d and labels[i] == c], np.int64) for c in (0, 1)]
    classes = [c for c in classes if len(c)]
    adam = Adam(net.p)
    free_words, free_grams = _free(docs)
    turns = [np.concatenate([rng.permutation(c) for _ in range(-(-steps * BATCH_DOCS // len(c)))]) for c in classes]
    share = BATCH_DOCS // max(1, len(classes))
    while classes and adam.n < steps:
        picked = np.concatenate([t[adam.n * share : (adam.n + 1) * share] for t in turns])
        words, codes = _coded([docs[i] for i in picked])
        doc, start, size = _windows(np.array([len(docs[i]) for i in picked]))
        x, features = net.inputs(words)
        gates = net.gates(x)
        index = _index(start, size, codes)
        logit = net.run(gates, index, size)
        best = np.full(len(picked), -np.inf, np.float32)
        np.maximum.at(best, doc, logit)
        top = np.flatnonzero(logit == best[doc])
        top = top[np.unique(doc[top], return_index=True)[1]]
        found, memory = net.run(gates, index[top], size[top], keep=True)
        d_logit = ((_sigmoid(found) - labels[picked][doc[top]]) / len(top)).astype(np.float32)
        g, d_gates = net.back(d_logit, memory, len(words))
        g["in"], g["in0"] = x.T @ d_gates, d_gates.sum(axis=0)
        d_x = d_gates @ net.p["in"].T
        rows, grams, owners, count = features
        moved = np.abs(d_x).sum(axis=1) > 0  # only words of the windows learnt from
        g["word"] = _summed(rows[moved], d_x[moved, :WIDE], free_words)
        inside = moved[owners]
        g["gram"] = _summed(grams[inside], (d_x[:, WIDE:] / count[:, None])[owners[inside]], free_grams)
        adam.step(g)
    return net


class Scorer:
    """Scores runs of texts, keeping the gate inputs of the words seen so far."""

    def __init__(self, net: Network):
        self.net = net
        self._forget()

    def _forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.gates = np.empty((0, 6 * HIDDEN), np.float32)

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Score from 0 to 1 and number of windows of each text; a text without a word scores 0."""
        if len(self.codes) > KEPT_WORDS:
            self._forget()
        docs = [split(t) for t in texts]
        known, find = len(self.codes), self.codes
        codes = np.fromiter((find.setdefault(w, len(find)) for d in docs for w in d), np.int64)
        if len(find) > known:
            new = list(find)[known:]
            self.gates = np.concatenate([self.gates, self.net.gates(self.net.inputs(new)[0])])
        doc, start, size = _windows(np.fromiter(map(len, docs), np.int64, len(docs)))
        logit = np.empty(len(doc), np.float32)
        # Short windows go together, so that full ones need no mask.
        order = np.argsort(size, kind="stable")
        full = int(np.searchsorted(size[order], WINDOW))
        for part in (order[:full], order[full:]):
            for at in range(0, len(part), BATCH_WINDOWS):
                own = part[at : at + BATCH_WINDOWS]
                logit[own] = self.net.run(self.gates, _index(start[own], size[own], codes), size[own])
        best = np.full(len(docs), -np.inf)
        np.maximum.at(best, doc, logit)
        return np.where(np.isinf(best), 0.0, 1 / (1 + np.exp(-np.clip(best, -30, 30)))), np.bincount(doc, minlength=len(docs))


def held_out(doc_id: str) -> Column:
    """Rows that labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Network:
    """A network for the labelled documents that are not held out.

    At most SAMPLE_PER_CLASS documents of either label, those with the lowest hash of their id, none above SAMPLE_CHARS
    characters, are brought to the driver.  Without any, the network stays as drawn.
    """
    told = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out("doc_id"))
    told = told.groupBy("doc_id").agg(F.max("toxic").alias("_toxic")).withColumn("_order", F.xxhash64("doc_id"))
    per_class = [told.where(F.col("_toxic") == c).orderBy("_order", "doc_id").limit(SAMPLE_PER_CLASS) for c in (0, 1)]
    some = per_class[0].unionByName(per_class[1])
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text")).where(F.length("_text") <= SAMPLE_CHARS)
    # The sample has a fixed bound of 2 * SAMPLE_PER_CLASS ids, so it may go to all tasks.
    sample = rows.join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.max("_toxic").alias("_toxic"), F.min("_text").alias("_text"), F.min("_order").alias("_order"))
    found = sample.toPandas().sort_values(["_order", "doc_id"])
    return train(found["_text"].tolist(), found["_toxic"].tolist())


def scorer(spark: SparkSession, net: Network) -> Callable[[str], Column]:
    """A function from a text column to a struct of ``score`` (0 to 1) and ``n_windows``; null and empty texts score 0."""
    told = sent(spark, net)

    @F.pandas_udf("score double, n_windows int")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Scorer(told())
        for batch in batches:
            texts = batch.tolist()
            parts = [own.scores(texts[s:e]) for s, e in slices(texts)]
            yield pd.DataFrame({
                "score": np.concatenate([np.empty(0), *(p[0] for p in parts)]),
                "n_windows": np.concatenate([np.empty(0, np.int64), *(p[1] for p in parts)]).astype(np.int32),
            })

    return lambda text: score(F.col(f"`{text}`"))


def clean(docs: DataFrame, labels: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents that score below ``least``, with all their columns."""
    return docs.where(scorer(docs.sparkSession, fit(docs, labels))(text)["score"] < least)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, n_windows``.

    Labels of held-out rows, language, source and id never enter a score.  Equal texts get equal scores.  A null id counts
    as not held out, a document with two labels as toxic.  Empty tables give no rows; without labels the network is untrained.
    """
    rows = docs.select("doc_id", scorer(docs.sparkSession, fit(docs, labels))("text").alias("_tox"))
    score = F.col("_tox.score")
    return rows.select(
        "doc_id", held_out("doc_id").alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"),
        F.col("_tox.n_windows").alias("n_windows"),
    )
