"""Removal of long repeated byte strings by equal digests of suffix heads, thinned by a difference cover.

Suffixes are not put in text order: only equality of a window's bytes is asked for, so digests are sorted in their place, and
a cover sample's rank is "unique" or "tied".

A byte goes if a string of so many bytes as the window has that covers it also starts anywhere else in the corpus.  Strings never cross
documents.  The work is bounded by blocks (runs of documents) and suffix buckets (ranges of leading hash bits):

1. Of all suffixes only those at cover positions are ranked first: offsets whose remainder modulo the period lies in a
   perfect difference set.  For any two offsets there is a shift below the period that takes both to cover positions, so two
   equal strings of a window hold two equal cover samples of ``sample`` bytes at the same shift.  The digests of each bucket of samples are
   sorted alone; a sample's rank is settled as unique or as tied with a sample elsewhere.
2. A suffix none of whose cover samples is tied is unique, and is never sorted.  The others, the long ties, are dealt to
   suffix buckets by a hash of the window's bytes, and the digests of each bucket are sorted alone.
3. The answers, one bit for a suffix, go back to the block, which works out the spans to cut.

Blocks send every distinct key once, however often it occurs in them, so a passage that a third of all documents share
gives its bucket one key for each block; copies of a text are dealt to the same block where they are few enough.  A key has 64 bits of one digest and its bucket holds as many bits of a second
one as the corpus needs buckets, so keys get longer as the corpus grows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.llm.common import carried, give_back, packed, unpacked
from ledgerloom.session import stage

BLOCK_BYTES = 4 << 20  # text of one block; a longer document is a block of its own and is read in slices
BUCKET_BYTES = 8 << 20  # keys of one suffix bucket
SAMPLE_KEY = 6  # bytes of a sample's key beyond its bucket's bits; equal keys of different samples only cost a sort
HEAVY_BYTES = BLOCK_BYTES // 4  # copies of one text that hold more than this are spread over all blocks
SLICE = 1 << 18
NULL_TEXT = "_suffixes_null_text"
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Window:
    """Bytes of the strings that count as repeats, and the cover that fits them: order + 1 remainders modulo the period."""

    size: int = 400
    order: int = 17  # a prime

    @property
    def period(self) -> int:
        return self.order * self.order + self.order + 1

    @property
    def sample(self) -> int:
        return self.size - self.period + 1


LONG = Window()
#: Fifty words of an alphabetic script take more than this; samples of 68 bytes.
PASSAGE = Window(200, 11)


def difference_cover(order: int) -> np.ndarray:
    """Singer's perfect difference set: every non-zero remainder is a difference of two members, in just one way.

    Powers of a generator x of the field with order ** 3 elements that have no x ** 2 term lie on a line of the
    projective plane; their exponents are the set.  The cubic is the first one whose x generates such a plane.
    """
    period = order * order + order + 1
    for a, b, c in np.ndindex(order, order, order):
        x, found = (1, 0, 0), []
        for i in range(period):
            if x[2] == 0:
                found.append(i)
            x = (x[2] * c % order, (x[0] + x[2] * b) % order, (x[1] + x[2] * a) % order)  # x ** 3 = a x ** 2 + b x + c
        if len(found) == order + 1 and len({(i - j) % period for i in found for j in found}) == period:
            return np.array(found)
    raise ValueError(f"{order} is not a prime")


class Digests:
    """Digests of all substrings of one length, from running sums of byte values times powers of an odd number."""

    def __init__(self, which: int, window: int):
        base = np.uint64(ODD[which])
        powers = np.full(SLICE + window + 1, base, np.uint64)
        powers[0] = 1
        self.powers = np.cumprod(powers)
        inverse = np.full(SLICE + window + 1, pow(int(base), -1, 1 << 64), np.uint64)
        inverse[0] = 1
        self.inverse = np.cumprod(inverse)
        self.values = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(ODD[1 - which]))

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=out[1:])
        return out

    def at(self, sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        return _mixed((sums[starts + length] - sums[starts]) * self.inverse[starts])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_MADE: dict = {}  # tables that a worker builds once; functools.cache would tie them to this module's place on disk


def _digests(which: int, w: Window) -> Digests:
    if (which, w) not in _MADE:
        _MADE[which, w] = Digests(which, w.size)
    return _MADE[which, w]


def _in_cover(w: Window) -> np.ndarray:
    if ("cover", w) not in _MADE:
        marks = np.zeros(w.period, bool)
        marks[difference_cover(w.order)] = True
        _MADE["cover", w] = np.tile(marks, SLICE // w.period + w.size // w.period + 3)
    return _MADE["cover", w]


def _slices(data: np.ndarray, w: Window) -> Iterator[tuple[int, np.ndarray]]:
    """Offset and bytes of overlapping slices; every string of a window lies in one."""
    for at in range(0, max(1, len(data) - w.size + 1), SLICE):
        yield at, data[at : at + SLICE + w.size - 1]


def _samples(w: Window, at: int, part: np.ndarray, last: bool, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in a slice that start a cover sample, and the samples' keys: leading ``bits`` and SAMPLE_KEY bytes of a digest.

    All but the last slice leave the samples of the overlap to the next one.
    """
    most = len(part) - w.sample + 1 if last else SLICE
    starts = np.flatnonzero(_in_cover(w)[at % w.period : at % w.period + most])
    first = _digests(0, w)
    spare = np.uint64(max(0, 64 - 8 * SAMPLE_KEY - bits))
    return starts, (first.at(first.sums(part), starts, w.sample) >> spare) << spare


def _documents(block: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(text, np.uint8) for text in unpacked(block)]


def _packed(keys: np.ndarray) -> bytes:
    """Bytes of sorted keys, highest bytes of all of them first, as those compress well."""
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, ::-1].T).tobytes()


def _unpacked(told: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(told, np.uint8).reshape(8, -1)[::-1].T).view(np.uint64).ravel()


def _dealt(keys: np.ndarray, bucket: np.ndarray, again: np.ndarray, block: int, bits: int) -> pa.Table:
    """Sorted keys as one row for each bucket; bucket numbers must rise."""
    cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1))
    used = np.flatnonzero(np.diff(cuts))
    return pa.table({
        "bucket": pa.array(used, pa.int64()), "block": pa.array(np.full(len(used), block), pa.int64()),
        "keys": pa.array([_packed(keys[cuts[b] : cuts[b + 1]]) for b in used], pa.binary()),
        "again": pa.array([np.packbits(again[cuts[b] : cuts[b + 1]]).tobytes() for b in used], pa.binary()),
    })


KEYS = "bucket long, block long, keys binary, again binary"


def _once(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and whether each occurs more than once."""
    distinct, n = np.unique(keys, return_counts=True)
    return distinct, n > 1


def _top(x: np.ndarray, bits: int) -> np.ndarray:
    return (x >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(x), np.int64)


def _sample_keys(w: Window, block: pa.Table, bits: int) -> pa.Table:
    number = block.column("block")[0].as_py()
    held = []
    for data in _documents(block):
        if len(data) >= w.size:
            for at, part in _slices(data, w):
                held.append(_samples(w, at, part, at + len(part) == len(data), bits)[1])
    keys, again = _once(np.concatenate(held)) if held else (np.empty(0, np.uint64), np.empty(0, bool))
    return _dealt(keys, _top(keys, bits), again, number, bits)


def _ties(bucket: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All keys of a bucket in the order they came, where each row starts, and which keys are tied."""
    told, marks = bucket.column("keys"), bucket.column("again")
    starts = np.cumsum([0, *(len(x.as_buffer()) // 8 for x in told)])
    keys, tied = np.empty(starts[-1], np.uint64), np.empty(starts[-1], bool)
    for start, end, own, mark in zip(starts, starts[1:], told, marks):
        keys[start:end] = _unpacked(own.as_buffer())
        tied[start:end] = np.unpackbits(np.frombuffer(mark.as_buffer(), np.uint8), count=end - start)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    del ranked
    tied[order[1:][same]] = True
    tied[order[:-1][same]] = True
    return keys, starts, tied


def _tied_samples(bucket: pa.Table) -> pa.Table:
    keys, starts, tied = _ties(bucket)
    told = [_packed(keys[s:e][tied[s:e]]) for s, e in zip(starts, starts[1:])]
    return pa.table({"block": bucket.column("block"), "bucket": pa.array(np.full(len(told), -1), pa.int64()), "told": pa.array(told, pa.binary())})


def _tied_windows(bucket: pa.Table) -> pa.Table:
    _, starts, tied = _ties(bucket)
    told = [np.packbits(tied[s:e]).tobytes() for s, e in zip(starts, starts[1:])]
    return pa.table({"block": bucket.column("block"), "bucket": bucket.column("bucket"), "told": pa.array(told, pa.binary())})


ANSWER = "block long, bucket long, told binary"


def _long_ties(w: Window, data: np.ndarray, tied: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Offsets of the suffixes of one document that hold a tied sample, with both digests of their window."""
    if len(data) < w.size or not len(tied):
        return
    for at, part in _slices(data, w):
        # The next slice's samples count as well for windows that reach into it.
        starts, keys = _samples(w, at, part, True, bits)
        found = tied[np.minimum(np.searchsorted(tied, keys), len(tied) - 1)] == keys
        if not found.any():
            continue
        marks = np.zeros(len(part) + w.period + 1, np.int32)
        marks[starts[found] + 1] = 1
        seen = np.cumsum(marks)
        last = len(part) - w.size + 1
        where = np.flatnonzero(seen[w.period : w.period + last] > seen[:last])
        one, two = _digests(0, w), _digests(1, w)
        yield at + where, one.at(one.sums(part), where, w.size), two.at(two.sums(part), where, w.size)


def _window_keys(w: Window, block: pa.Table, answers: pa.Table, sample_bits: int, bits: int) -> tuple[list, np.ndarray, np.ndarray]:
    """For a block: (document, offsets) of its long ties in turn, and digest and bucket of their windows.

    A block can be all ties, so what is held for each of them is kept small: the second digest only as its bucket.
    """
    told = [x for x, b in zip(answers.column("told").to_pylist(), answers.column("bucket").to_pylist()) if b < 0]
    tied = np.unique(np.concatenate([np.empty(0, np.uint64), *map(_unpacked, told)]))
    places, ones, buckets = [], [np.empty(0, np.uint64)], [np.empty(0, np.int32)]
    for i, data in enumerate(_documents(block)):
        for where, one, two in _long_ties(w, data, tied, sample_bits):
            places.append((i, where))
            ones.append(one)
            buckets.append(_top(two, bits).astype(np.int32))
    return places, np.concatenate(ones), np.concatenate(buckets)


def _sorted(one: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by bucket, then by key, and for each place in it the number of its distinct pair."""
    order = np.lexsort((one, bucket))
    new = np.ones(len(order), bool)
    for values in (one, bucket):
        ranked = values[order]
        differ = ranked[1:] != ranked[:-1]
        new[1:] = differ if values is one else new[1:] | differ
    group = np.cumsum(new, dtype=np.int32)
    group -= 1
    return order, group


def _suffix_keys(w: Window, block: pa.Table, answers: pa.Table, sample_bits: int, bits: int) -> pa.Table:
    if not block.num_rows:
        return _dealt(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool), 0, bits)
    one, bucket = _window_keys(w, block, answers, sample_bits, bits)[1:]
    order, group = _sorted(one, bucket)
    sizes = np.bincount(group)
    first = order[np.cumsum(sizes) - sizes] if len(sizes) else order
    return _dealt(one[first], bucket[first], sizes > 1, block.column("block")[0].as_py(), bits)


def _spans(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by strings of ``size`` bytes at rising ``starts``."""
    new = np.flatnonzero(np.append(True, starts[1:] > starts[:-1] + size))
    return starts[new], starts[np.append(new[1:] - 1, len(starts) - 1)] + size


def _cut(w: Window, block: pa.Table, answers: pa.Table, sample_bits: int, bits: int) -> pa.Table:
    places, one, bucket = _window_keys(w, block, answers, sample_bits, bits)
    order, group = _sorted(one, bucket)
    told = {b: t for b, t in zip(answers.column("bucket").to_pylist(), answers.column("told").to_pylist()) if b >= 0}
    repeated = np.zeros(len(one), bool)
    if len(one):
        sizes = np.bincount(group)
        per_bucket = np.bincount(bucket[order[np.cumsum(sizes) - sizes]], minlength=1 << bits)
        flags = [np.unpackbits(np.frombuffer(told[b], np.uint8), count=per_bucket[b]) for b in np.flatnonzero(per_bucket)]
        repeated[order] = np.concatenate(flags).astype(bool)[group]
    starts: dict[int, list] = {}
    at = 0
    for i, where in places:
        starts.setdefault(i, []).append(where[repeated[at : at + len(where)]])
        at += len(where)
    out = []
    for i, data in enumerate(_documents(block)):
        own = np.concatenate(starts.get(i, [np.empty(0, np.int64)]))
        if not len(own):
            out.append((len(data), 0, 0, hashlib.sha256(data).hexdigest(), data.tobytes()))
            continue
        begin, end = _spans(own, w.size)
        kept = b"".join(data[a:b].tobytes() for a, b in zip([0, *end], [*begin, len(data)]))
        out.append((len(data), int((end - begin).sum()), len(begin), hashlib.sha256(kept).hexdigest(), kept))
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    made = {n: pa.array(c, k) for n, c, k in zip(names, zip(*out) if out else [[]] * len(names), kinds)}
    return pa.table({"doc": carried(block), **made})


CUT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _power(n: float) -> int:
    """Bits that number ``n`` buckets."""
    return max(0, int(np.ceil(np.log2(max(n, 1)))))


def cut_repeats(docs: DataFrame, text: str = "text", window: Window = LONG) -> DataFrame:
    """One row per document: ``doc`` (a struct of its other columns), ``n_bytes, n_removed, n_spans, kept_sha256, kept``.

    ``kept`` is the binary remainder.  Null and empty texts have no bytes, texts shorter than the window stay whole.  Repeated
    rows are documents of their own and so repeats of one another.  Columns of any name may come along.  ``docs`` should be
    a stored table: it is scanned once for its size, and once for the blocks that all later steps share.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    doc = F.struct(*others) if others else F.struct(F.lit(0).alias("none"))
    data = F.col(f"`{text}`").cast("binary")
    copies = stage(docs.select(F.xxhash64(data).alias("digest"), F.octet_length(data).alias("n")).groupBy("digest").agg(F.sum("n").alias("n")), "suffix-texts")
    total = copies.agg(F.sum("n")).first()[0] or 0
    heavy = stage(copies.where(F.col("n") > HEAVY_BYTES).select("digest", F.lit(True).alias("heavy")), "suffix-heavy")
    blocks = -(-total // BLOCK_BYTES) or 1
    # Copies of a text share a block, which sends their keys once; a text with a great many copies is spread by row.
    own = F.when(F.col("heavy"), F.xxhash64("digest", F.monotonically_increasing_id())).otherwise(F.col("digest"))
    dealt = (
        docs.select(doc.alias("doc"), data.alias("data"), F.xxhash64(data).alias("digest"))
        .join(heavy, "digest", "left")
        .select("doc", "data", F.pmod(F.xxhash64(own), F.lit(blocks)).alias("block"))
    )
    sample_bits = _power(8 * total * (window.order + 1) / window.period / BUCKET_BYTES)
    # Windows fill a bucket to a tenth if a tenth of all text is repeated, and four times over if all of it is.
    window_bits = _power(8 * total / (4 * BUCKET_BYTES))

    def samples(block: pa.Table) -> pa.Table:
        give_back()
        return _sample_keys(window, block, sample_bits)

    def suffixes(block: pa.Table, answers: pa.Table) -> pa.Table:
        give_back()
        return _suffix_keys(window, block, answers, sample_bits, window_bits)

    def cut(block: pa.Table, answers: pa.Table) -> pa.Table:
        give_back()
        return _cut(window, block, answers, sample_bits, window_bits)

    by_block = packed(dealt).groupBy("block")
    ranks = by_block.applyInArrow(samples, KEYS).groupBy("bucket").applyInArrow(_tied_samples, ANSWER)
    ties = by_block.cogroup(ranks.groupBy("block")).applyInArrow(suffixes, KEYS)
    answers = ranks.unionByName(ties.groupBy("bucket").applyInArrow(_tied_windows, ANSWER))
    schema = T.StructType([dealt.schema["doc"], *T.StructType.fromDDL(CUT)])
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(cut, schema)


def shortened(docs: DataFrame, text: str = "text", length: str = "n_chars", window: Window = PASSAGE) -> DataFrame:
    """The documents, columns in order, with the remaining text and, if there is such a column, its length in characters.

    A null text stays null, with the length it had.  A cut that falls inside a character drops what is left of that character.
    """
    @F.pandas_udf("string")
    def decoded(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: b.decode("utf-8", "ignore"))

    marked = docs.withColumn(NULL_TEXT, F.col(f"`{text}`").isNull())
    rows = cut_repeats(marked, text, window).withColumn("kept", F.when(~F.col("doc").getField(NULL_TEXT), decoded("kept")))
    kinds = dict(docs.dtypes)
    columns = []
    for c in docs.columns:
        value = F.col("kept") if c == text else F.col("doc").getField(c)
        if c == length and kinds[c] in ("int", "bigint"):
            value = F.coalesce(F.length("kept").cast(kinds[c]), value)
        columns.append(value.alias(c))
    return rows.select(*columns)
