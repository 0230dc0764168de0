"""Exact top-k search by a vector-approximation file.

Each component of each vector is kept as the number of its cell, one byte.  A scan of the cells alone bounds every score
from both sides; vectors whose upper bound is below the k-th best lower bound are out.  Exact vectors of the others are read
in order of their upper bounds: a first wave settles a k-th score, and a second one reads all that may still reach it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerloom.session import stage

CELLS = 256  # of each component; a cell's number is a byte
SCALE = 1024
BLOCK, QUERIES, STEP = 4096, 4096, 256  # vectors and queries of one block, and queries that meet a block at once
WAVE = 2  # times k vectors are read before the rest is weighed again


def integers(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, v``: floor(SCALE * x) of each component, of all rows with an id and finite components."""
    x = F.col(f"`{embedding}`").cast("array<double>")
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = vectors.where(F.col(vec_id).isNotNull() & x.isNotNull()).where(finite)
    ints = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * SCALE).cast("long")).alias("v"))
    return ints.groupBy("vec_id").agg(F.min("v").alias("v"))


def _grid(ints: DataFrame) -> np.ndarray | None:
    """Lowest value, highest value of every component; shorter vectors count as ending in zeros."""
    sizes = ints.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if sizes[1] is None:
        return None
    rows = ints.select(F.posexplode("v")).groupBy("pos").agg(F.min("col").alias("low"), F.max("col").alias("high")).collect()
    grid = np.zeros((2, sizes[1]), np.int64)
    for r in rows:
        grid[:, r["pos"]] = r["low"], r["high"]
    if sizes[0] < sizes[1]:
        grid[0, sizes[0] :] = np.minimum(grid[0, sizes[0] :], 0)
        grid[1, sizes[0] :] = np.maximum(grid[1, sizes[0] :], 0)
    return grid


def _matrix(column: pa.Array, wide: int) -> np.ndarray:
    out = np.zeros((len(column), wide), np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    out[np.arange(wide) < sizes[:, None]] = flat
    return out


def _packed(rows: DataFrame, grid: np.ndarray) -> DataFrame:
    """Rows of ``vec_id, v`` in blocks ``ids, data`` of at most BLOCK; data has a byte for each component, its cell."""
    step = -(-(grid[1] - grid[0] + 1) // CELLS)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                data = ((_matrix(part.column(1), grid.shape[1]) - grid[0]) // step).astype(np.uint8)
                ids = part.column(0).to_numpy().tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([ids], pa.binary()), pa.array([data.tobytes()], pa.binary())], names=["ids", "data"])

    return rows.select("vec_id", "v").mapInArrow(pack, "ids binary, data binary")


def _best(column: str, k: int, by: list[Column]) -> Column:
    """Whether a row is among the first k of its query."""
    return F.row_number().over(Window.partitionBy("query_id").orderBy(*by)).alias(column)


def candidates(ints: DataFrame, queries: DataFrame, k: int, grid: np.ndarray) -> DataFrame:
    """``query_id, vec_id, low, high`` of all pairs that the bounds within a block leave in."""
    wide = grid.shape[1]
    step = -(-(grid[1] - grid[0] + 1) // CELLS)
    cells = _packed(ints, grid)
    blocks = -(-queries.count() // QUERIES) or 1

    def gather(block: pa.Table) -> pa.Table:
        data = _matrix(block.column("v").combine_chunks(), wide)
        ids = block.column("vec_id").combine_chunks().to_numpy(zero_copy_only=False)
        return pa.table({"block": [block.column("block")[0].as_py()], "query_ids": [ids.tobytes()], "query_data": [data.tobytes()]})

    numbered = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    asked = stage(numbered.groupBy("block").applyInArrow(gather, "block long, query_ids binary, query_data binary"), "va-queries")
    # Every block of cells meets every block of queries: the stated query set against all rows, in blocks.
    pairs = cells.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).join(asked, "block")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data, query_ids, query_data in zip(*(batch.column(c).to_pylist() for c in ("ids", "data", "query_ids", "query_data"))):
                ids, query_ids = np.frombuffer(ids, np.int64), np.frombuffer(query_ids, np.int64)
                low = (np.frombuffer(data, np.uint8).reshape(len(ids), wide) * step + grid[0]).astype(float)
                high = np.minimum(low + (step - 1), grid[1])
                asked = np.frombuffer(query_data, np.int64).reshape(len(query_ids), wide).astype(float)
                for at in range(0, len(query_ids), STEP):
                    own = query_ids[at : at + STEP]
                    up, down = np.maximum(asked[at : at + STEP], 0), np.minimum(asked[at : at + STEP], 0)
                    most, least = up @ high.T + down @ low.T, up @ low.T + down @ high.T
                    itself = own[:, None] == ids[None, :]
                    most[itself] = least[itself] = -np.inf
                    floor = np.partition(least, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(own), -np.inf)
                    i, j = np.nonzero((most >= floor[:, None]) & ~itself)
                    yield pa.RecordBatch.from_arrays([pa.array(own[i]), pa.array(ids[j]), pa.array(least[i, j]), pa.array(most[i, j])], names=["query_id", "vec_id", "low", "high"])

    return pairs.select("ids", "data", "query_ids", "query_data").mapInArrow(bound, "query_id long, vec_id long, low double, high double")


RESULT = "query_id long, rank int, vec_id long, score long"


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best integer inner products of each query, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's own; a query with fewer gets
    all.  Vectors that are null or hold null or non-finite components, and rows without an id, take no part.  Vectors of
    unequal length count as ending in zeros.  Of rows that repeat an id the one with the least vector counts.  Equal vectors
    tie, so of each only the k + 1 smallest ids are searched.  Components up to 2 ** 20 in size give exact bounds.
    """
    spark = vectors.sparkSession
    ints = stage(integers(vectors, vec_id, embedding), "va-exact")
    grid = _grid(ints)
    if grid is None:
        return spark.createDataFrame([], T.StructType.fromDDL(RESULT))
    queries = stage(ints.where(F.col("vec_id") % every == 0), "va-asked")
    same = Window.partitionBy("v").orderBy("vec_id")
    few = ints.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + 1).drop("place")
    found = stage(candidates(few, queries, k, grid), "va-bounds")
    floors = found.withColumn("place", _best("place", k, [F.col("low").desc(), F.col("vec_id")])).where(F.col("place") == k)
    left = found.join(floors.select("query_id", F.col("low").alias("floor")), "query_id", "left").where("floor IS NULL OR high >= floor")
    order = stage(left.select("query_id", "vec_id", "high", _best("place", k, [F.col("high").desc(), F.col("vec_id")])), "va-order")

    def read(pairs: DataFrame) -> DataFrame:
        product = F.aggregate(F.zip_with("q", "v", lambda a, b: F.coalesce(a * b, F.lit(0))), F.lit(0).cast("long"), lambda s, x: s + x)
        asked = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
        return pairs.join(ints, "vec_id").join(asked, "query_id").select("query_id", "vec_id", product.alias("score"))

    by_score = [F.col("score").desc(), F.col("vec_id")]
    first = stage(read(order.where(F.col("place") <= WAVE * k)), "va-first")
    certain = first.withColumn("place", _best("place", k, by_score)).where(F.col("place") == k)
    rest = order.where(F.col("place") > WAVE * k).join(certain.select("query_id", "score"), "query_id").where("high >= score")
    scores = first.unionByName(read(rest.select("query_id", "vec_id")))
    ranked = scores.withColumn("rank", _best("rank", k, by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
