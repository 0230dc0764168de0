"""Hard negatives for anchors and their positives by slot-decomposed selection.

Every positive of an anchor wants the first k negatives between a share of its score from below and one from above.  The
windows of an anchor's positives overlap, so they are not searched one by one: their upper limits, in falling order, cut
the scores into disjoint slots.  One scan of all rows keeps the k best negatives of each slot, in each task and then
overall, and from the lowest slot up the lists are merged: the k best below an upper limit are the slot's own list followed
by what was merged below it.  A window's answer is that merged list as far as its lower limit.

Both scans (for the positives, for the slots) meet every row with the anchors, the stated query set, in blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.session import stage

SCALE = 256
LOW, HIGH, WHOLE = 30, 90, 100  # negatives score from LOW to HIGH hundredths of the positive
ROWS, ANCHORS, STEP = 4096, 8192, 128  # rows and anchors of one block, and anchors that meet a block of rows at once
RUN = 64  # blocks of rows that one task of a block of anchors reads
EXACT, MOST = 1 << 53, (1 << 63) - 1


def usable(vectors: DataFrame, relabel: Column | None = None, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, label, v``: floor(SCALE * x) of each component as a double, of rows that take part.

    Rows without an id, a label or a vector and vectors with null or non-finite components take no part.  Of rows that repeat
    an id, the one with the least label, then the least vector, counts.  A component so large that its product with SCALE is
    not finite takes its row out as well.
    """
    x = F.col(f"`{embedding}`").cast("array<double>")
    scaled = F.transform(x, lambda c: c * SCALE)
    finite = F.forall(scaled, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    named = F.col(f"`{label}`").cast("long") if relabel is None else relabel.cast("long")
    rows = vectors.where(F.col(f"`{vec_id}`").isNotNull() & F.col(f"`{label}`").isNotNull() & x.isNotNull()).where(finite)
    whole = F.transform(scaled, lambda c: F.when(F.abs(c) < EXACT, F.floor(c).cast("double")).otherwise(c))  # large doubles are whole
    row = F.struct(named.alias("label"), whole.alias("v"))
    return rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), row.alias("row")).groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")


def _matrix(column: pa.Array, wide: int) -> np.ndarray:
    """Vectors as rows; those that are shorter end in zeros."""
    out = np.zeros((len(column), wide))
    out[np.arange(wide) < np.diff(column.offsets.to_numpy())[:, None]] = column.flatten().to_numpy()
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of ``a`` with all rows of ``b``, held at the limits of a long.

    Products that doubles may not hold exactly are worked out with integers of any size, only for the rows that need it.
    """
    wide = max(1, a.shape[1])
    most_a, most_b = np.abs(a).max(1, initial=0), np.abs(b).max(1, initial=0)
    with np.errstate(all="ignore"):
        out = np.clip(np.nan_to_num(a @ b.T, nan=0.0), -(2.0**62), 2.0**62).astype(np.int64)
        odd = [(i, most_b * most_a[i] * wide >= EXACT) for i in np.flatnonzero(most_a * most_b.max(initial=0) * wide >= EXACT)]
    for i, which in odd:
        own = [int(x) for x in a[i]]
        for j in np.flatnonzero(which):
            out[i, j] = max(-MOST, min(MOST, sum(x * int(y) for x, y in zip(own, b[j]))))
    return out


def first(which: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first of each group of ``which`` (any integers), by falling score and rising id."""
    order = np.lexsort((vec_id, -score, which))
    of = which[order]
    starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    place = np.arange(len(of)) - np.repeat(starts, np.diff(np.append(starts, len(of))))
    return order[place < k]


LEAST = np.iinfo(np.int64).min


def _best(table: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the entries no lower than the row's k-th best; LEAST marks what does not count."""
    if table.shape[1] > k:
        floor = np.partition(table, -k, axis=1)[:, -k]
        return np.nonzero((table >= floor[:, None]) & (table > LEAST))
    return np.nonzero(table > LEAST)


class Held:
    """The k first of each group of one block of anchors, over the blocks of rows that a task has read so far."""

    def __init__(self, k: int):
        self.k, self.parts, self.n = k, [], 0

    def add(self, which: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        self.parts.append((which, score, vec_id))
        self.n += len(which)
        if self.n > 1 << 20:
            self.combined()

    def combined(self) -> tuple[np.ndarray, ...]:
        none = np.empty(0, np.int64)
        which, score, vec_id = (np.concatenate([none, *(p[i] for p in self.parts)]) for i in range(3))
        own = first(which, score, vec_id, self.k)
        self.parts, self.n = [(which[own], score[own], vec_id[own])], 0
        return self.parts[0]


def _asked(anchors: DataFrame, blocks: int, salts: int, label: str) -> DataFrame:
    """Anchors in blocks, each row ``block, anchors``: an Arrow stream of the block's rows; one copy for each salt."""
    def gather(block: pa.Table) -> pa.Table:
        sink = pa.BufferOutputStream()
        own = block.drop_columns("block").sort_by("vec_id")
        with pa.ipc.new_stream(sink, own.schema) as to:
            to.write_table(own)
        return pa.table({"block": [block.column("block")[0].as_py()], "anchors": [sink.getvalue().to_pybytes()]})

    numbered = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    asked = stage(numbered.groupBy("block").applyInArrow(gather, "block long, anchors binary"), label)
    return asked.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))


def _packed(rows: DataFrame, wide: int) -> DataFrame:
    """Rows in blocks ``ids, labels, data, number`` of at most ROWS, by rising id inside a block."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = part.column(0).to_numpy()
                made = [x.tobytes() for x in (ids, part.column(1).to_numpy(), _matrix(part.column(2), wide))]
                yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.binary()) for x in made), pa.array([int(ids[0])])], names=["ids", "labels", "data", "number"])

    return rows.select("vec_id", "label", "v").mapInArrow(pack, "ids binary, labels binary, data binary, number long")


def _scan(rows: DataFrame, anchors: DataFrame, n: tuple[int, int, int], k: int, pick: Callable, label: str) -> DataFrame:
    """``anchor_id, slot, vec_id, score``: what ``pick`` takes of every row for every anchor, the k first of each slot of a task.

    ``pick(scores, same, anchors)`` gets a table of scores of some anchors, whether the labels are the same, and those
    anchors' rows, and yields a slot number with the table of the scores that count in it.  The rows of a block of anchors
    are dealt to salts, so a task reads about RUN blocks of rows however many rows there are.
    """
    n_rows, n_anchors, wide = n
    blocks = -(-n_anchors // ANCHORS) or 1
    salts = -(-n_rows // (ROWS * RUN)) or 1
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    pairs = _packed(rows, wide).withColumn("salt", F.pmod(F.xxhash64("number"), F.lit(salts))).withColumn("block", every)
    pairs = pairs.join(_asked(anchors, blocks, salts, label), ["block", "salt"]).select("block", "ids", "labels", "data", "anchors")

    def told(own: pa.Table, held: Held) -> pa.RecordBatch:
        which, score, vec_id = held.combined()
        names = own.column("vec_id").to_numpy()
        return pa.RecordBatch.from_arrays([pa.array(names[which >> 8]), pa.array((which & 255).astype(np.int32)), pa.array(vec_id), pa.array(score)], names=["anchor_id", "slot", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, held = None, None, None
        for batch in batches:
            for block, ids, labels, data, asked in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if block != at:
                    if held:
                        yield told(own, held)
                    at, held = block, Held(k)
                    own = pa.ipc.open_stream(asked).read_all().combine_chunks()
                    heads = own.column("vec_id").to_numpy()
                    marks = own.column("label").to_numpy()
                    vectors = _matrix(own.column("v").combine_chunks(), wide)
                ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
                data = np.frombuffer(data).reshape(len(ids), wide)
                for start in range(0, len(heads), STEP):
                    end = start + STEP
                    table = scores(vectors[start:end], data)
                    table[heads[start:end, None] == ids[None, :]] = LEAST
                    same = marks[start:end, None] == labels[None, :]
                    for slot, counted in pick(table, same, own.slice(start, STEP)):
                        i, j = _best(counted, k)
                        held.add((start + i) << 8 | slot, counted[i, j], ids[j])
        if held:
            yield told(own, held)

    return pairs.mapInArrow(run, "anchor_id long, slot int, vec_id long, score long")


def _share(score: Column, of: int, up: bool) -> Column:
    """``of`` hundredths of a score, rounded up or down, worked out in parts as a long may not hold the product."""
    rest = F.pmod(score, F.lit(WHOLE))
    over = rest * of + (WHOLE - 1 if up else 0)
    return F.call_function("div", score - rest, F.lit(WHOLE)) * of + F.call_function("div", over, F.lit(WHOLE))


def positives(rows: DataFrame, anchors: DataFrame, n: tuple[int, int, int], most: int) -> DataFrame:
    """``anchor_id, positive_id, positive_score, low, high``: the first ``most`` other rows of each anchor's label."""
    def pick(table, same, _):
        yield 0, np.where(same, table, LEAST)

    found = _scan(rows, anchors, n, most, pick, "negatives-anchors")
    ranked = found.withColumn("place", F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), F.col("vec_id"))))
    score = F.col("score")
    return ranked.where(F.col("place") <= most).select(
        "anchor_id", F.col("vec_id").alias("positive_id"), score.alias("positive_score"), _share(score, LOW, True).alias("low"), _share(score, HIGH, False).alias("high")
    )


def slots(wanted: DataFrame) -> DataFrame:
    """``anchor_id, highs, lows``: the distinct upper limits of an anchor's windows in falling order, slot by slot.

    ``lows`` is the lowest score that any window of the slot or one above it reaches, so that a slot holds nothing in vain.
    Windows that no score lies in have no part in it.
    """
    open_ones = wanted.where("low <= high")
    grouped = open_ones.groupBy("anchor_id", "high").agg(F.min("low").alias("low")).groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("high", "low")), asc=False).alias("limits"))
    lowest = F.transform("limits", lambda _, i: F.array_min(F.transform(F.slice("limits", 1, i + 1), lambda x: x["low"])))
    return grouped.select("anchor_id", F.col("limits.high").alias("highs"), lowest.alias("lows"))


def held_by_slot(rows: DataFrame, anchors: DataFrame, limits: DataFrame, n: tuple[int, int, int], k: int) -> DataFrame:
    """``anchor_id, lists``: for each slot of the anchor, from the highest down, its k first rows of other labels."""
    def pick(table, same, own):
        highs, lows = (own.column(c).to_pylist() for c in ("highs", "lows"))
        table = np.where(same, LEAST, table)
        for slot in range(max(map(len, highs), default=0)):
            top = np.array([h[slot] if slot < len(h) else LEAST for h in highs], np.int64)
            bottom = np.array([max(lo[slot], h[slot + 1] + 1 if slot + 1 < len(h) else lo[slot]) if slot < len(h) else 0 for h, lo in zip(highs, lows)], np.int64)
            yield slot, np.where((table <= top[:, None]) & (table >= bottom[:, None]), table, LEAST)

    asked = anchors.join(limits.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    found = _scan(rows, asked, n, k, pick, "negatives-limits")
    by_score = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), F.col("vec_id"))
    best = found.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= k)
    entry = F.struct((-F.col("score")).alias("order"), F.col("vec_id"))
    lists = best.groupBy("anchor_id", "slot").agg(F.sort_array(F.collect_list(entry)).alias("list"))
    return lists.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "list"))).alias("lists"))


def merged(highs: Column, lists: Column, k: int) -> Column:
    """For each slot the k first rows at or below its upper limit: from the lowest up, its own and then those merged below."""
    none = F.array().cast("array<struct<order:bigint,vec_id:bigint>>")
    below = F.reverse(F.sequence(F.lit(0), F.size(highs) - 1))
    start = F.array(none)

    def add(done: Column, slot: Column) -> Column:
        own = F.coalesce(F.element_at(lists, slot), none)
        return F.concat(F.array(F.slice(F.concat(own, F.element_at(done, 1)), 1, k)), done)

    return F.aggregate(below, start, add)


def mined(rows: DataFrame, anchors: DataFrame, n_positives: int = 5, k: int = 10) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``vec_id, label, v`` rows.

    Anchors are rows as well.  Both frames should be stored tables.  Higher scores come first, ties by smaller id.  Scores that a
    long cannot hold stand at its limits.  Vectors of unequal length count as ending in zeros.
    """
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("wide")).first()
    n = (size["n"], anchors.count(), size["wide"] or 0)
    wanted = stage(positives(rows, anchors, n, n_positives), "negatives-positives")
    limits = stage(slots(wanted), "negatives-slots")
    lists = held_by_slot(rows, anchors, limits, n, k)
    answers = limits.join(lists, "anchor_id").select("anchor_id", "highs", merged(F.col("highs"), F.col("lists"), k).alias("merged"))
    at = F.array_position("highs", F.col("high")).cast("int")
    fits = F.filter(F.element_at("merged", at), lambda x: -x["order"] >= F.col("low"))
    each = wanted.where("low <= high").join(answers, "anchor_id").select("anchor_id", "positive_id", "positive_score", F.posexplode(fits).alias("place", "one"))
    return each.select(
        "anchor_id", "positive_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("one.vec_id").alias("negative_id"), "positive_score", (-F.col("one.order")).alias("negative_score")
    )


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """The first 10 hard negatives of the first 5 positives of each anchor, a row whose id is divisible by 100.

    Labels of rows whose id is divisible by 7 are moved on by one of ten, as wrong labels are in real data.
    """
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = stage(usable(vectors, moved), "negatives-rows")
    return mined(rows, stage(rows.where(F.col("vec_id") % 100 == 0), "negatives-asked"))
