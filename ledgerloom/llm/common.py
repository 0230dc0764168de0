"""Small helpers that several operators of this package share."""

from __future__ import annotations

import ctypes
import pickle
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom.session import stage

#: Words are runs of anything but ASCII white space; Java, RE2 and Python read this pattern alike.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts are handed on inside a task in slices of about this many characters.
SLICE_CHARS = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: str | Column) -> Column:
    """Number of words of a text, 0 for null, without building an array of them."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def sent(spark: SparkSession, thing) -> Callable:
    """A function that gives ``thing``, of bounded size, inside a task.

    It travels as bytes that hold its class by value, so a worker needs no copy of this package.
    """
    told, here = spark.sparkContext.broadcast(cloudpickle.dumps(thing)), []

    def get():
        if not here:
            here.append(pickle.loads(told.value))
        return here[0]

    return get


def give_back() -> None:
    """Hand to the system what this worker has freed.

    Workers are used again from stage to stage, and would otherwise keep the most that any earlier task took.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole(df: DataFrame) -> Column:
    """All columns as one struct, so that columns of any name can be carried along."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def numbered(docs: DataFrame, label: str, **made: Column) -> DataFrame:
    """``doc`` (a struct of the row), a number of its own in ``_row``, and the columns ``made``, written once.

    Repeated rows and null ids can then be told apart in every later step, also when an executor is lost.
    """
    number = F.monotonically_increasing_id().alias("_row")
    return stage(docs.select(whole(docs).alias("doc"), number, *(c.alias(n) for n, c in made.items())), label)


def slices(texts, most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts that hold about ``most`` characters together, one text at least."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text) if text is not None else 0
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def packed(docs: DataFrame) -> DataFrame:
    """Rows of ``doc`` (a struct), ``data`` (binary) and ``block`` as ``block, docs, texts``, several rows for each block.

    The texts of a row are compressed together, so that dealing them to blocks moves a third of their bytes.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column(2).to_numpy()
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.append(True, block[order][1:] != block[order][:-1])).tolist()
            rows = batch.take(pa.array(order))
            ends = [*cuts[1:], len(order)]
            texts = []
            for start, end in zip(cuts, ends):
                own = rows.column(1).slice(start, end - start).to_pylist()
                texts.append(press.compress(b"".join(struct.pack("<q", len(t or b"")) + (t or b"") for t in own)))
            whole = pa.ListArray.from_arrays(pa.array([*cuts, len(order)], pa.int32()), rows.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(block[order][cuts]), whole, pa.array(texts, pa.binary())], names=["block", "docs", "texts"])

    given = docs.select("doc", "data", F.col("block").cast("long"))
    schema = [T.StructField("block", T.LongType()), T.StructField("docs", T.ArrayType(given.schema["doc"].dataType)), T.StructField("texts", T.BinaryType())]
    return given.mapInArrow(pack, T.StructType(schema))


def unpacked(block: pa.Table) -> Iterator[memoryview]:
    """The texts of a block's rows in turn, as its ``docs`` are."""
    for texts in block.column("texts").to_pylist():
        data, at = memoryview(zstandard.ZstdDecompressor().decompress(texts)), 0
        while at < len(data):
            (size,) = struct.unpack_from("<q", data, at)
            yield data[at + 8 : at + 8 + size]
            at += 8 + size


def carried(block: pa.Table) -> pa.Array:
    """The ``docs`` of all rows of a block as one array of structs."""
    docs = block.column("docs").combine_chunks()
    return (pa.concat_arrays(docs.chunks) if isinstance(docs, pa.ChunkedArray) else docs).flatten()
