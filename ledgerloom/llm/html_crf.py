"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

Each block has features of the tags and names above it, its own tag, its length, links and place; neighbours are tied by
one weight for each pair of labels, of one kind within a parent element and of another across.  The field is trained on
labelled pages by gradient ascent on the exact likelihood and decoded by Viterbi.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import sent, slices
from ledgerloom.llm.html_blocks import Block, blocks
from ledgerloom.llm.html_pages import MAIN, OTHER, labelled_pages

TRAIN_PAGES, SEED, ROUNDS, RATE, DECAY = 700, 11, 160, 0.08, 1e-3
KEPT_PATHS = 20_000  # tag paths whose scores a task remembers


def path_features(path: tuple) -> list[str]:
    """What the elements above say: tags, names with and without their ending, and the names of the nearest two."""
    found = {f"in:{tag}" for tag, _ in path}
    for depth, (tag, own) in enumerate(reversed(path)):
        for name in own:
            found.update((f"n:{name}", f"n:{name[:4]}~"))
            if depth < 2:
                found.add(f"own:{name[:4]}~")
    found.add(f"tag:{path[-1][0]}" if path else "tag:")
    if len(path) > 1:
        found.add(f"up:{path[-2][0]}>{path[-1][0]}")
    return sorted(found)


def text_features(block: Block, place: int, count: int) -> list[str]:
    words = block.text.count(" ") + 1
    size = int(np.searchsorted((2, 4, 8, 16, 40, 100), words))
    share = block.linked / len(block.text)
    end = block.text[-1]
    found = [f"size:{size}", f"links:{int(share * 4)}", f"end:{'stop' if end in '.!?…' else 'letter' if end.isalpha() else 'mark'}"]
    found.append("first" if place == 0 else "last" if place == count - 1 else f"at:{4 * place // count}")
    if "©" in block.text[:200]:
        found.append("copyright")
    return found


def ties(page: list[Block]) -> np.ndarray:
    """For each block after the first, whether it has the parent of the one before it."""
    return np.array([int(a.path[:-1] == b.path[:-1]) for a, b in zip(page, page[1:])], np.int64)


class Field:
    """Weights of features by label, of label pairs by kind of tie, and of first labels; labels are 1 for main text, 0 else."""

    def __init__(self, names: dict[str, int]):
        self.names = names
        self.w = np.zeros((len(names), 2))
        self.pair = np.zeros((2, 2, 2))
        self.first = np.zeros(2)
        self.paths: dict[tuple, np.ndarray] = {}

    def scores(self, page: list[Block]) -> np.ndarray:
        out = np.empty((len(page), 2))
        for i, block in enumerate(page):
            if block.path not in self.paths:
                if len(self.paths) >= KEPT_PATHS:
                    self.paths.clear()
                self.paths[block.path] = self._sum(path_features(block.path))
            out[i] = self.paths[block.path] + self._sum(text_features(block, i, len(page)))
        return out

    def _sum(self, features: list[str]) -> np.ndarray:
        return self.w[[self.names[f] for f in features if f in self.names]].sum(axis=0)

    def decode(self, page: list[Block]) -> list[int]:
        """Most likely labels of a page's blocks."""
        if not page:
            return []
        score = self.scores(page).tolist()
        pair, kinds = self.pair.tolist(), ties(page).tolist()
        best0, best1 = score[0][0] + self.first[0], score[0][1] + self.first[1]
        back = []
        for own, kind in zip(score[1:], kinds):
            p = pair[kind]
            a, b, c, d = best0 + p[0][0], best1 + p[1][0], best0 + p[0][1], best1 + p[1][1]
            back.append((int(b > a), int(d > c)))
            best0, best1 = max(a, b) + own[0], max(c, d) + own[1]
        labels = [int(best1 > best0)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def train(n: int = TRAIN_PAGES, seed: int = SEED, rounds: int = ROUNDS) -> Field:
    """The field for ``n`` drawn pages; equal arguments give an equal field."""
    pages, truth = [], []
    for html in labelled_pages(n, seed):
        page, labels = [], []
        for b in blocks(html):
            labels.append(int(MAIN in b.text))
            b.text = b.text.replace(MAIN, "").replace(OTHER, "").strip()
            if b.text:
                page.append(b)
            else:
                labels.pop()
        if page:
            pages.append(page)
            truth.append(labels)
    names: dict[str, int] = {}
    flat, owner = [], []
    starts = np.cumsum([0, *map(len, pages)])
    for start, page in zip(starts, pages):
        for i, block in enumerate(page):
            own = [names.setdefault(f, len(names)) for f in path_features(block.path) + text_features(block, i, len(page))]
            flat += own
            owner += [start + i] * len(own)
    field = Field(names)
    flat, owner, y = np.array(flat), np.array(owner), np.concatenate(truth)
    longest = max(map(len, pages))
    size = np.array([len(p) for p in pages])
    at = np.minimum(starts[:-1, None] + np.arange(longest), starts[-1] - 1)
    live = np.arange(longest) < size[:, None]
    kinds = np.zeros((len(pages), longest), np.int64)
    for i, page in enumerate(pages):
        kinds[i, 1 : len(page)] = ties(page)
    rows = np.arange(len(pages))
    params = [field.w, field.pair, field.first]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        node = np.zeros((starts[-1], 2))
        for c in (0, 1):
            node[:, c] = np.bincount(owner, field.w[flat, c], starts[-1])
        g = [-DECAY * len(pages) * field.w, np.zeros((2, 2, 2)), np.zeros(2)]
        alpha, beta = np.zeros((len(pages), longest, 2)), np.zeros((len(pages), longest, 2))
        alpha[:, 0] = node[at[:, 0]] + field.first
        for t in range(1, longest):
            way = np.logaddexp.reduce(alpha[:, t - 1, :, None] + field.pair[kinds[:, t]], axis=1) + node[at[:, t]]
            alpha[:, t] = np.where(live[:, t, None], way, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            way = np.logaddexp.reduce(field.pair[kinds[:, t + 1]] + (node[at[:, t + 1]] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(live[:, t + 1, None], way, 0)
        total = np.logaddexp.reduce(alpha[rows, size - 1], axis=1)
        share = np.exp(alpha + beta - total[:, None, None])
        wrong = np.zeros((starts[-1], 2))
        wrong[at[live]] = -share[live]
        wrong[np.arange(len(y)), y] += 1
        for c in (0, 1):
            g[0][:, c] += np.bincount(flat, wrong[owner, c], len(names))
        g[2] += np.bincount(y[starts[:-1]], minlength=2) - share[:, 0].sum(axis=0)
        for t in range(1, longest):
            both = np.exp(alpha[:, t - 1, :, None] + field.pair[kinds[:, t]] + (node[at[:, t]] + beta[:, t])[:, None, :] - total[:, None, None])
            on = live[:, t]
            np.add.at(g[1], kinds[on, t], -both[on])
            np.add.at(g[1], (kinds[on, t], y[at[on, t - 1]], y[at[on, t]]), 1)
        for p, d, a, b in zip(params, g, m, v):
            a += 0.1 * (d - a)
            b += 0.01 * (d * d - b)
            p += RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)
    return field


def main_text(field: Field, html: str | None) -> str:
    """The page's main blocks in order, joined by one space; empty for null, empty and textless pages."""
    page = blocks(html)
    return " ".join(b.text for b, label in zip(page, field.decode(page)) if label)


def extracted(pages: DataFrame, html: str = "html", field: Field | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page, from its whole html.

    Null and empty pages, and pages without main text, have the empty text.  Repeated rows stay; other columns are not read.
    """
    told = sent(pages.sparkSession, field or train())

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = batch.tolist()
            yield pd.Series([main_text(told(), h) for s, e in slices(found) for h in found[s:e]], dtype=object)

    return pages.select("page_id", "url", text(F.col(f"`{html}`")).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
