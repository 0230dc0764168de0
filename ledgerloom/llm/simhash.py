"""Near-duplicate groups by SimHash and the generalised pigeonhole principle.

Two fingerprints that differ in at most ``radius`` bits, cut into partitions with thresholds ``t_p`` that sum up to
``radius - partitions + 1``, differ by at most ``t_p`` in some partition.  So a fingerprint that looks up, in each
partition, every value within its threshold finds all its partners.  Bits that rise and fall together share a
partition, and each fingerprint gets its own thresholds by dynamic programming over the candidates that a histogram
of partition values lets it expect: a partition in which its value is common gets -1 (no look-up), a rare one more.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.llm.common import numbered, partitions, sent
from ledgerloom.llm.components import connected
from ledgerloom.session import stage

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
SLOT_BITS = 16  # a histogram has 2 ** SLOT_BITS counts for each partition, whatever the input
BLOCK = 2048  # fingerprints of one partition value that are compared with as many others in one step
LOOK_UP, VERIFY = 1.0, 0.003  # relative cost of a shuffled look-up row and of a comparison
MOST_FLIPS = 2


def fingerprint(text: str | None) -> int:
    """64-bit SimHash over word shingles, repeats included; 0 for null and for texts without a word."""
    words = text.encode().lower().split() if text else []  # bytes: only A-Z change case, only ASCII space parts words
    if not words:
        return 0
    joined = [b" ".join(words)] if len(words) < SHINGLE else map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    n = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in joined), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 15):
        part = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def hex_digits(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how many have both bits set, for each pair of bits."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            bits = _bits(batch["fp"].to_numpy().view(np.uint64)).astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        yield pd.DataFrame({"cell": np.arange(BITS * BITS + 1), "n": np.append(total.ravel(), n)})

    rows = fps.select("fp").mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1, np.int64)
    for row in rows:
        cells[row["cell"]] = row["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[np.ndarray]:
    """Bits in ``parts`` groups of nearly equal size, each grown from the bit with the strongest ties to the rest."""
    share = both / max(n, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    ties = np.abs((share - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(ties, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda i: ties[i, left].sum())]
        left.remove(group[0])
        while len(group) < size:
            group.append(max(left, key=lambda i: ties[i, group].sum()))
            left.remove(group[-1])
        groups.append(np.array(sorted(group)))
    return groups


def parts_for(n: int) -> int:
    """Partitions with the least expected cost of look-ups and comparisons among ``n`` evenly spread fingerprints."""
    def cost(parts: int) -> float:
        wide = BITS // parts
        flips = max(RADIUS - parts + 1, 0)
        looks = parts + flips * wide
        return looks * (LOOK_UP + VERIFY * n / 2.0**wide)

    return min((4, 3, 2), key=cost)


class Plan:
    """Bit groups, expected candidates by slot and look-up masks; at most 4 * 2 ** 16 counts, so it may be sent to all tasks."""

    def __init__(self, groups: list[np.ndarray], counts: np.ndarray):
        self.groups, self.exact = groups, counts
        self.masks, self.expected = [], []
        for p, group in enumerate(groups):
            wide = len(group)
            self.masks.append([
                np.array([sum(1 << b for b in bits) for bits in combinations(range(wide), r)], np.uint64) for r in range(MOST_FLIPS + 1)
            ])
            thin = 2.0 ** max(0, wide - SLOT_BITS)  # values that share a slot
            near, total = counts[p] / thin, [counts[p] / thin]
            if wide <= SLOT_BITS:
                slots = np.arange(1 << SLOT_BITS, dtype=np.uint64)
                once = sum(counts[p][(slots ^ np.uint64(1 << b)).astype(np.int64)] for b in range(wide))
                total.append(near + once)
                total.append(near + once * (1 + wide / 2))
            else:
                mean = counts[p].sum() / 2.0**wide
                total += [near + wide * mean, near + (wide + wide * (wide - 1) / 2) * mean]
            self.expected.append(total)

    def values(self, fps: np.ndarray) -> np.ndarray:
        """Value of every partition, one row each."""
        bits = _bits(fps).astype(np.uint64)
        return np.stack([(bits[:, g] << np.arange(len(g), dtype=np.uint64)).sum(axis=1, dtype=np.uint64) for g in self.groups])

    def slots(self, p: int, values: np.ndarray) -> np.ndarray:
        return _slots(len(self.groups[p]), values)

    def thresholds(self, values: np.ndarray) -> np.ndarray:
        """For each fingerprint the cheapest thresholds from -1 to MOST_FLIPS with the sum that the principle asks for."""
        parts, n = values.shape
        goal = RADIUS - parts + 1
        room = parts + goal  # thresholds counted from -1: each 0 or more, this much together
        best = np.full((room + 1, n), np.inf)
        best[0] = 0
        picks = np.zeros((parts, room + 1, n), np.int8)
        for p in range(parts):
            slot = self.slots(p, values[p])
            cost = [np.zeros(n)]
            looks = 0
            for r in range(MOST_FLIPS + 1):
                looks += len(self.masks[p][r])
                cost.append(LOOK_UP * looks + VERIFY * self.expected[p][r][slot])
            after = np.full_like(best, np.inf)
            for used in range(room + 1):
                for step in range(min(MOST_FLIPS + 1, used) + 1):
                    total = best[used - step] + cost[step]
                    better = total < after[used]
                    after[used][better] = total[better]
                    picks[p, used][better] = step
            best = after
        chosen, used, every = np.empty((parts, n), np.int8), np.full(n, room), np.arange(n)
        for p in range(parts - 1, -1, -1):
            step = picks[p, used, every]
            chosen[p] = step - 1
            used = used - step
        return chosen


def _slots(wide: int, values: np.ndarray) -> np.ndarray:
    if wide <= SLOT_BITS:
        return values.astype(np.int64)
    mixed = values * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def plan(fps: DataFrame) -> Plan:
    """Partitions and thresholds for distinct fingerprints ``fp``; only counts of fixed number reach the driver."""
    n, both = _bit_counts(fps)
    groups = group_bits(n, both, parts_for(n))
    empty = Plan(groups, np.zeros((len(groups), 1 << SLOT_BITS)))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((len(groups), 1 << SLOT_BITS), np.int64)
        for batch in batches:
            values = empty.values(batch["fp"].to_numpy().view(np.uint64))
            for p in range(len(groups)):
                held[p] += np.bincount(empty.slots(p, values[p]), minlength=1 << SLOT_BITS)
        flat = held.ravel()
        used = np.nonzero(flat)[0]
        yield pd.DataFrame({"cell": used, "n": flat[used]})

    found = fps.select("fp").mapInPandas(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(groups) << SLOT_BITS)
    counts[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy()
    return Plan(groups, counts.reshape(len(groups), -1))


def _blocks(fps: np.ndarray, count: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """How many blocks a value's fingerprints fill, and the block of each fingerprint."""
    many = np.maximum(1, np.ceil(count / BLOCK)).astype(np.int64)
    mixed = (fps ^ np.uint64(salt)) * np.uint64(0xD6E8FEB86659FD93)
    return many, ((mixed >> np.uint64(32)) % many.astype(np.uint64)).astype(np.int64)


def links(fps: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` that connect all fingerprints with at most RADIUS differing bits.

    Each look-up group hands on a spanning forest of its links, at most one pair for each of its members, so a dense
    group of n near copies makes n pairs and not n * n.  A value that many fingerprints share is dealt out as pairs of
    blocks: its stored rows go to every block of look-ups and its look-ups to every block of stored rows.
    """
    spark = fps.sparkSession
    told = sent(spark, plan(fps))

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        this = told()
        for batch in batches:
            for at in range(0, len(batch), 20_000):
                own = batch["fp"].to_numpy()[at : at + 20_000].view(np.uint64)
                values = this.values(own)
                chosen = this.thresholds(values)
                for p in range(len(this.groups)):
                    for flips in range(-1, MOST_FLIPS + 1):
                        masks = np.zeros(1, np.uint64) if flips <= 0 else this.masks[p][flips]
                        who = np.arange(len(own)) if flips < 0 else np.nonzero(chosen[p] >= flips)[0]
                        if not len(who):
                            continue
                        value = (values[p][who][:, None] ^ masks[None, :]).ravel()
                        fp = np.repeat(own[who], len(masks))
                        many, block = _blocks(fp, this.exact[p][this.slots(p, value)], 1 if flips < 0 else 2)
                        copy = np.repeat(np.arange(len(fp)), many)
                        other = np.arange(len(copy)) - np.repeat(np.cumsum(many) - many, many)
                        stored, asked = (block[copy], other) if flips < 0 else (other, block[copy])
                        yield pd.DataFrame({
                            "part": np.full(len(copy), p, np.int32), "value": value[copy].view(np.int64), "stored": stored, "asked": asked,
                            "asks": np.full(len(copy), flips >= 0), "fp": fp[copy].view(np.int64),
                        })

    rows = fps.select("fp").mapInPandas(look_up, "part int, value long, stored long, asked long, asks boolean, fp long")
    buckets = max(partitions(spark), 16) * 2
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("part", "value", "stored", "asked"), F.lit(buckets)))

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["part", "value", "stored", "asked", "asks"], kind="stable")
        key = rows[["part", "value", "stored", "asked"]].to_numpy()
        fps, asks = rows["fp"].to_numpy().view(np.uint64), rows["asks"].to_numpy()
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1))) if len(key) else np.array([], int)
        ends = np.append(starts[1:], len(key))
        out = []
        for s, e in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            cut = s + int(np.searchsorted(asks[s:e], True))
            if s < cut < e:
                out += _forest(fps[s:cut], fps[cut:e])
        a, b = (np.concatenate(x) for x in zip(*out)) if out else (np.array([], np.uint64),) * 2
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)}).drop_duplicates()

    return dealt.groupBy("bucket").applyInPandas(verify, "a long, b long")


def _forest(stored: np.ndarray, asking: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    nodes = np.unique(np.concatenate([stored, asking]))
    label = np.arange(len(nodes))
    to, of = np.searchsorted(nodes, stored), np.searchsorted(nodes, asking)
    for at in range(0, len(asking), 512):
        near = np.bitwise_count(asking[at : at + 512, None] ^ stored[None, :]) <= RADIUS
        i, j = np.nonzero(near)
        label = merged(label, of[at + i], to[j])
    moved = label != np.arange(len(nodes))
    return [(nodes[moved], nodes[label[moved]])] if moved.any() else []


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining ``a[k]`` with ``b[k]`` for all k; a label is the smallest member's place."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return label
        la, lb = la[differ], lb[differ]
        low = np.minimum(la, lb)
        label = label.copy()
        np.minimum.at(label, np.maximum(la, lb), low)
        while (label[label] != label).any():
            label = label[label]


def components(rows: DataFrame, doc_id: str = "doc_id", label: str = "simhash") -> DataFrame:
    """``(fp, component)`` for every distinct fingerprint of ``rows``; the component is the smallest fingerprint reachable.

    ``rows`` has a column ``fp`` and is read several times, so hand in a stored table.
    """
    fps = stage(rows.select("fp").distinct(), f"{label}-fps")
    found = connected(links(fps), "a", "b", f"{label}-links")
    return fps.join(found, fps["fp"] == found["node"], "left").select("fp", F.coalesce("root", "fp").alias("component"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "simhash") -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Null and empty texts have fingerprint zero and are linked with one another and with whatever is within RADIUS bits.
    Repeated rows are kept, each with its own row.  ``component_id`` is the smallest non-null id reachable, null if a
    group has none.  Other columns, whatever their names, are not read.  No documents: no rows.
    """
    rows = stage(docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text)).alias("fp")), f"{label}-rows")
    named = rows.groupBy("fp").agg(F.min("doc_id").alias("least")).join(components(rows, label=label), "fp")
    groups = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = named.select("fp", "component").join(groups, "component").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", hex_digits("fp").alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "simhash") -> DataFrame:
    """The document with the smallest id (nulls last, then the first stored row) of each group of ``near_duplicates``, all columns.

    Shingle length and bit distance are those of the operator; nothing is checked beside the distance.  Documents without a
    word are one group.  Columns of any name are carried along; no documents: no rows.
    """
    made = numbered(docs, f"{label}-docs", _fp=fingerprints(F.col(text)))
    rows = made.select("_row", F.col("doc").getField(doc_id).alias("doc_id"), F.col("_fp").alias("fp"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    by_fp = stage(rows.groupBy("fp").agg(first.alias("first")), f"{label}-firsts")
    kept = by_fp.join(components(by_fp, label=label), "fp").groupBy("component").agg(F.min("first").alias("first"))
    return made.join(kept.select(F.col("first._row").alias("_row")), "_row", "left_semi").select("doc.*")
