"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

The documents of a source, shuffled by a hash of their id, form a stream of words that is cut into blocks of BLOCK words.
Slot i of the schedule has the point frac(i * golden ratio); the interval of the sources' cumulative targets that holds the
point names the slot's source, and the slot's rank among those of its source names the block it takes, the stream
starting again after its end.  All shares stay within a few blocks of their targets in every prefix of the schedule, and a
source's last slot is cut so that it ends at its target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.common import numbered, word_count
from ledgerloom.session import stage

BLOCK = 4096
SHARE = (3, 2)  # words of the mix to words of all sources, as a fraction
MOST = 2  # times that a document may be taken
WEIGHTS = (5, 2, 1)  # of the sources in order of name, repeating
KEY_BITS, BUCKET_BITS = 60, 12  # a source's stream is put in order in so many parts, by the leading bits of a hash
POINT_BITS = 31
GOLDEN = 1327217885  # 2 ** 31 over the golden ratio, odd
CHUNK_BITS = 16  # slots are ranked within chunks of so many, and chunks by their counts
GRID_BITS = 10  # cells of the unit interval by which points find their source


def targets(totals: DataFrame) -> DataFrame:
    """From ``source, size`` (words of each source): ``sid, source, size, weight, target``.

    Sources are numbered by code point, null last.  The mix has SHARE of all words, shared by weight; no target exceeds MOST
    times its source's size, and what is over goes to the others by weight until none exceeds it.  With the sources in order
    of size over weight, those that are cut off come first; the first one that is not settles the price of a weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1).cast("int")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("sid") % len(WEIGHTS) + 1).cast("int"))
    named = totals.withColumn("sid", place).withColumn("weight", weight.cast("long"))
    order = Window.orderBy(F.col("size") / F.col("weight"), "sid")
    cut = F.lit(MOST) * F.col("size")
    everywhere = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = named.withColumns({
        "place": F.row_number().over(order),
        "before": F.coalesce(F.sum(cut).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "heavy": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
        "all": F.sum("size").over(everywhere),
    })
    left = F.col("all").cast("double") * SHARE[0] / SHARE[1] - F.col("before")
    settled = F.when(left * F.col("weight") / F.col("heavy") <= cut, F.struct("place", left.alias("left"), "heavy"))
    first = held.withColumn("first", F.min(settled).over(everywhere))
    free = F.col("first.left") * F.col("weight") / F.col("first.heavy")
    target = F.when(F.col("place") < F.col("first.place"), cut.cast("double")).otherwise(free)
    return first.select("sid", "source", "size", "weight", target.alias("target"))


def schedule(sources: DataFrame, slots: int, block: int = BLOCK) -> DataFrame:
    """Rows ``slot, sid, epoch, block, words`` for the sources of ``targets``, staged by the caller.

    ``slots`` is the number of points; a source that the points leave a few blocks short gets its last ones after them.
    """
    spark = sources.sparkSession
    grid = 1 << GRID_BITS
    scale = float(1 << POINT_BITS)
    upto = F.sum("target").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("target").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    words = F.floor("target").cast("long")
    edges = sources.where("target >= 1").withColumns({"high": F.floor(upto / whole * scale).cast("long"), "words": words})
    edges = edges.withColumn("low", F.lag("high", 1, 0).over(Window.orderBy("sid")))
    cell = 1 << (POINT_BITS - GRID_BITS)
    cells = edges.where("high > low").withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / cell), F.floor((F.col("high") - 1) / cell))))
    i = F.col("slot")
    points = spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", (i % (1 << POINT_BITS)) * GOLDEN % (1 << POINT_BITS))
    named = (
        points.withColumn("cell", F.floor(F.col("point") / cell))
        .join(cells.select("cell", "low", "high", "sid"), "cell")
        .where("point >= low AND point < high")
        .select("slot", "sid", F.shiftright("slot", CHUNK_BITS).alias("chunk"))
    )
    in_chunk = named.withColumn("place", F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1)
    chunks = named.groupBy("sid", "chunk").count()
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.withColumn("start", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    ranked = in_chunk.join(starts, ["sid", "chunk"]).select("slot", "sid", (F.col("start") + F.col("place")).alias("rank"))
    # Blocks of one round through a source's stream, and of all rounds until its target.
    per_round = F.ceil(F.col("size") / block)
    wanted = F.floor(F.col("words") / F.col("size")) * per_round + F.ceil(F.col("words") % F.col("size") / block)
    need = edges.select("sid", "size", "words", per_round.alias("per_round"), wanted.alias("wanted"))
    given = chunks.groupBy("sid").agg(F.sum("count").alias("given"))
    short = need.join(given, "sid", "left").withColumn("given", F.coalesce("given", F.lit(0))).where("given < wanted")
    late = short.select("sid", F.explode(F.sequence("given", F.col("wanted") - 1)).alias("rank"))
    late = late.select((F.lit(slots) + F.col("rank")).alias("slot"), "sid", "rank")
    taken = ranked.unionByName(late).join(need, "sid").where("rank < wanted")
    epoch, place = F.floor(F.col("rank") / F.col("per_round")), F.col("rank") % F.col("per_round")
    start = place * block
    length = F.least(F.lit(block), F.col("size") - start, F.col("words") - epoch * F.col("size") - start)
    return taken.select("slot", "sid", epoch.alias("epoch"), place.alias("block"), length.cast("long").alias("words"))


def _streams(rows: DataFrame, label: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """Stored ``rows`` of ``doc_id, source, size, ...`` with their source's figures and their place in its stream; and the sources."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    key = F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")
    keyed = rows.withColumn("key", key).withColumn("bucket", F.shiftright("key", KEY_BITS - BUCKET_BITS))
    sums = stage(keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words")), f"{label}-sums")
    totals = sums.groupBy("source").agg(F.sum("words").alias("size"))
    sources = stage(targets(totals).withColumnRenamed("size", "source_size"), f"{label}-sources")
    named = sums.join(sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = named.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    starts = starts.withColumnsRenamed({"source": "_s", "bucket": "_b"})
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b"))
    within = Window.partitionBy("sid", "bucket").orderBy("key", doc_id, "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = keyed.join(starts, same).withColumn("offset", F.col("start") + F.sum("size").over(within) - F.col("size"))
    return placed.drop("_s", "_b", "start", "bucket", "key"), sources


def pieces(rows: DataFrame, label: str = "mix", doc_id: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """The stored ``rows`` once for every block they reach into and every slot that takes the block.

    Adds ``sid, source_size, weight, target, offset`` (place in the source's stream), ``slot, epoch`` and the words
    ``from`` (first, counted from 0) and ``taken`` of the document.  A piece that no slot takes has null and 0 there, and so
    has a document without words.
    """
    placed, sources = _streams(rows, label, doc_id)
    total = sources.agg(F.sum("target")).first()[0] or 0
    slots = schedule(sources.withColumnRenamed("source_size", "size"), int(total // block) + 1, block)
    first, last = F.floor(F.col("offset") / block), F.floor((F.col("offset") + F.greatest("size", F.lit(1)) - 1) / block)
    cut = placed.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest("offset", F.col("block") * block)
    end = F.least(F.col("offset") + F.col("size"), F.col("block") * block + F.coalesce("words", F.lit(0)))
    found = cut.join(slots, ["sid", "block"], "left")
    return found.withColumns({"from": begin - F.col("offset"), "taken": F.greatest(end - begin, F.lit(0)).cast("long")}).drop("words", "block")


def mix(docs: DataFrame, label: str = "mix") -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``.

    Sizes are words, 0 for null and empty texts.  A null source is a source of its own, a null id is ordered like an empty
    one.  Rows that repeat an id count one by one, ordered by size.  An empty table gives no rows.  Equal input gives
    equal output: the order depends on ids and sizes only.
    """
    rows = stage(docs.select("doc_id", "source", word_count("text").alias("size"), F.monotonically_increasing_id().alias("_row")), f"{label}-rows")
    of_row = ("_row", "doc_id", "size", "source_size", "target")
    return pieces(rows, label).groupBy(*of_row).agg(F.sum("taken").alias("taken")).drop("_row")


def mixed(docs: DataFrame, label: str = "mix") -> DataFrame:
    """The documents as often as the mix takes their first word (0 to MOST times), with all columns.

    Whole documents are handed on, so a source's words stay within a document of its target.  Documents without words
    are never taken.
    """
    made = numbered(docs, f"{label}-docs", _size=word_count("text"))
    rows = made.select("_row", "doc.doc_id", "doc.source", F.col("_size").alias("size"))
    starts = pieces(rows, label).where("taken > 0 AND `from` = 0").groupBy("_row").agg(F.count(F.lit(1)).cast("int").alias("_times"))
    return made.join(starts, "_row").withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times"))).select("doc.*")
