"""SentencePiece encoding and decoding by a streaming Viterbi search over a public vocabulary.

A text is its characters after one leading blank, blanks written as U+2581.  The search holds, for each place from which a
piece could still begin, the best way to get there; whenever the ways to all these places pass through one boundary, the
ids up to it are final and everything before it is forgotten.  A character that no piece covers is spelt in bytes.

Ways through a long run of one character may never meet, as each keeps its own phase.  The search then keeps the last step
to every place since they parted, 16 bytes a character, and looks for a common boundary again only when that window has
doubled, so the work stays in proportion to the text, whatever it is.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.llm.common import give_back, sent, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN = 10.0  # how much worse than the worst piece a character spelt in bytes scores
CACHE_UNITS, CACHE_CHARS = 150_000, 48  # stretches between forced boundaries whose ids a task remembers, and their length
STEP = 64  # places after which the search looks for a common boundary
CHUNK = 1024  # characters of a long stretch that are read at once


class Vocabulary:
    """Pieces with scores and bytes of a model file; small, so that it may be sent to every task."""

    def __init__(self, path: str = MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces: dict[str, int] = {}
        self.bytes: list[bytes] = [b""] * n
        self.byte_ids = [-1] * 256
        scores = np.zeros(n)
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[piece] = i
                self.bytes[i] = piece.replace(MARK, " ").encode()
                scores[i] = model.get_score(i)
        if -1 in self.byte_ids:
            raise ValueError(f"{path} has no byte pieces, so not every text could be encoded")
        self.scores = scores.tolist()
        self.unknown = float(scores.min()) - UNKNOWN
        self.longest = max(map(len, self.pieces))

    def automaton(self) -> ahocorasick.Automaton:
        """Finds all pieces that end at a place; blanks stand for marks."""
        found = ahocorasick.Automaton()
        for piece, i in self.pieces.items():
            found.add_word(piece.replace(MARK, " "), (len(piece), self.scores[i], i))
        found.make_automaton()
        return found


class Known(dict):
    """Ids of stretches seen, worked out when first asked for; forgets all when it is full."""

    def __init__(self, search):
        self.search = search

    def __missing__(self, unit: str) -> tuple[int, ...]:
        ids = self.search(unit)
        if len(unit) <= CACHE_CHARS:
            if len(self) >= CACHE_UNITS:
                self.clear()
            self[unit] = ids
        return ids


class Encoder:
    """Encodes and decodes whole texts; holds a search window and a bounded memory of stretches seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.find = vocabulary.automaton()
        self.single = {p.replace(MARK, " ") for p in vocabulary.pieces if len(p) == 1}
        self.known = Known(self.stretch)

    def spelt(self, char: str) -> list[int]:
        return [self.v.byte_ids[b] for b in char.encode()]

    def stream(self, chunks: Iterable[str]) -> Iterator[list[int]]:
        """Ids of one text given in chunks (with its leading blank), each list as soon as it is final."""
        longest = self.v.longest
        done = place = 0  # all before ``done`` is final; ``place`` characters were read
        best = [0.0]  # score of the best way to each of the last places, up to ``place``
        length, piece = [0], [0]  # of the last step to each place from ``done`` on; -1 for a character spelt in bytes
        held: dict[int, str] = {}  # those characters
        tail, look = "", STEP  # what a piece that ends in the next chunk may begin in; the window at which to look
        for chunk in chunks:
            best = best[-longest:]
            at, n = len(best) - 1, len(chunk)  # where ``place`` is in ``best``
            best += [-np.inf] * n
            length += [0] * n
            piece += [0] * n
            spelt = self._advance(tail, chunk, best, length, piece, at, place - done)
            held.update((place + i, chunk[i - 1]) for i in spelt)
            place += n
            tail = (tail + chunk)[-(longest - 1) :]
            if place - done >= look:
                cut = done + self._common(length, max(0, place - done - longest + 1), place - done)
                if cut > done:
                    yield self._path(length, piece, held, cut, done)
                    held = {p: c for p, c in held.items() if p > cut}
                    del length[: cut - done], piece[: cut - done]
                    done = cut
                look = max(STEP, 2 * (place - done))
        if place > done:
            yield self._path(length, piece, held, place, done)

    def _advance(self, tail: str, chunk: str, best: list, length: list, piece: list, at: int, to: int) -> list[int]:
        """Best last step to each place of a chunk; the place before it is ``best[at]``, ``length[to]`` and ``piece[to]``.

        Returns the characters of the chunk, counted from 1, that may have to be spelt.
        """
        shift, first, over = at + 1 - len(tail), len(tail), to - at
        if self.single.issuperset(chunk):
            for end, (size, score, i) in self.find.iter(tail + chunk):
                if end >= first:
                    end += shift
                    score += best[end - size]
                    if score > best[end]:
                        best[end] = score
                        length[end + over] = size
                        piece[end + over] = i
            return []
        spelt = [i + 1 for i, c in enumerate(chunk) if c not in self.single]
        waiting, unknown = iter([*(at + i for i in spelt), len(best)]), self.v.unknown

        def spell(end: int) -> int:  # no piece is the character alone
            if best[end - 1] + unknown > best[end]:
                best[end] = best[end - 1] + unknown
                length[end + over], piece[end + over] = 1, -1
            return next(waiting)

        odd = next(waiting)
        for end, (size, score, i) in self.find.iter(tail + chunk):
            if end >= first:
                end += shift
                while odd < end:
                    odd = spell(odd)
                score += best[end - size]
                if score > best[end]:
                    best[end] = score
                    length[end + over] = size
                    piece[end + over] = i
        while odd < len(best):
            odd = spell(odd)
        return spelt

    def stretch(self, unit: str) -> tuple[int, ...]:
        """Ids between two forced boundaries; of a stretch read at once all ids are final when it ends."""
        n = len(unit)
        if n > CHUNK:
            return tuple(chain.from_iterable(self.stream(unit[i : i + CHUNK] for i in range(0, n, CHUNK))))
        best, length, piece = [0.0] + [-np.inf] * n, [0] * (n + 1), [0] * (n + 1)
        spelt = self._advance("", unit, best, length, piece, 0, 0)
        return tuple(self._path(length, piece, {i: unit[i - 1] for i in spelt}, n, 0))

    @staticmethod
    def _common(length: list, first: int, last: int) -> int:
        """Boundary that the best ways to all places from ``first`` to ``last`` share, as a distance from the last one found."""
        ways, known = [-p for p in range(last, first - 1, -1)], set(range(first, last + 1))  # a heap with the last place on top
        while len(ways) > 1:
            before = -ways[0] - length[-ways[0]]
            if not before:
                return 0
            if before in known:
                heapq.heappop(ways)
            else:
                known.add(before)
                heapq.heapreplace(ways, -before)
        return -ways[0]

    def _path(self, length: list, piece: list, held: dict, end: int, done: int) -> list[int]:
        ids: list[int] = []
        at = end - done
        while at:
            if piece[at] >= 0:
                ids.append(piece[at])
            else:
                ids += reversed(self.spelt(held[done + at]))
            at -= length[at]
        return ids[::-1]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; none for null and for the empty text.

        No piece holds a blank after another character, nor a line end, so every way passes the places before a run of
        blanks and around a line end: the stretches between them can be searched, and remembered, one by one.
        """
        if not text:
            return np.empty(0, np.int32)
        text = " " + text
        if MARK not in text:
            return np.fromiter(chain.from_iterable(map(self.known.__getitem__, _UNITS(text))), np.int32)
        ids: list[int] = []
        for part in text.split(MARK):  # the mark itself is spelt in bytes, as its piece stands for a blank
            ids += [*chain.from_iterable(map(self.known.__getitem__, _UNITS(part))), *self.spelt(MARK)]
        return np.array(ids[: -len(MARK.encode())], np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        """The text that was encoded: bytes of all pieces without the leading blank."""
        return b"".join(map(self.v.bytes.__getitem__, ids))[1:].decode("utf-8", "replace")


_UNITS = re.compile(r" +[^ \n]*|[^ \n]+|\n").findall


def encoded(docs: DataFrame, vocabulary: Vocabulary | None = None, text: str = "text", check: bool = True) -> DataFrame:
    """All columns but the text, with ``n_chars`` (code points), ``n_ids, ids`` and ``same`` (the ids decode to the text).

    Null and empty texts have no ids and count as the same.  Columns that bear one of these names give way to the new
    ones.  Texts of any length go through whole.
    """
    told = sent(docs.sparkSession, vocabulary or Vocabulary())
    made = ("n_chars", "n_ids", "ids", "same")
    others = [c for c in docs.columns if c != text and c not in made]
    given = docs.select(*(F.col(f"`{c}`") for c in others), F.col(f"`{text}`").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(told())
        for batch in batches:
            give_back()
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for start, end in slices(texts):
                own = texts[start:end]
                ids = [encoder.encode(t) for t in own]
                same = [encoder.decode(i.tolist()) == (t or "") for i, t in zip(ids, own)] if check else [None] * len(own)
                sizes = [len(i) for i in ids]
                flat = pa.array(np.concatenate([np.empty(0, np.int32), *ids]))
                columns = [
                    *(batch.column(k).slice(start, end - start) for k in range(batch.num_columns - 1)),
                    pa.array([len(t or "") for t in own], pa.int64()), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), flat), pa.array(same, pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*others, *made])

    return given.mapInArrow(run, T.StructType([*given.schema.fields[:-1], *T.StructType.fromDDL("n_chars long, n_ids long, ids array<int>, same boolean")]))
