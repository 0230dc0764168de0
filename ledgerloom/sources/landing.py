"""Landing scans: statement files as all-text rows."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.schemas import LANDING


READERS = 32  # files whose first lines are read at once
FIRST_BYTES = 1 << 16


def read_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """Statement files with a header.  Columns are matched by name; those a bank does not give are NULL.

    Files with unlike headers are read apart, each kind under its own header, and put together by name.  Where all files
    have one header, as they mostly do, the folder is read as a whole and no file is named.
    """
    settings = {"header": "true", "multiLine": "false", "quote": '"', "escape": '"', **options}
    kinds = headers(spark, path)
    if not kinds:
        return spark.createDataFrame([], LANDING.schema)
    if len(kinds) == 1:
        return _named(spark.read.options(**settings).csv(path))
    return reduce(DataFrame.unionByName, [_named(spark.read.options(**settings).csv(sorted(kinds[k]))) for k in sorted(kinds)])


def headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files under each first line; empty files have none.

    A scan would read every byte a second time, as a task cannot leave a file after its first line.  So the first bytes of
    the files that Spark lists are read here, many files at once: one short read a file, whatever its length.
    """
    with ThreadPoolExecutor(READERS) as readers:
        found = list(readers.map(lambda file: _first_line(spark, file), spark.read.text(path).inputFiles()))
    kinds: dict[str, list[str]] = {}
    for name, line in found:
        if line is not None:
            kinds.setdefault(line, []).append(name)
    return kinds


def _first_line(spark: SparkSession, file: str) -> tuple[str, str | None]:
    """Name and first line of a file in whatever store it is, unpacked if it is packed."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = place.getFileSystem(conf).open(place, FIRST_BYTES)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        reader = jvm.java.io.InputStreamReader(stream if codec is None else codec.createInputStream(stream), "UTF-8")
        return place.toString(), jvm.java.io.BufferedReader(reader, FIRST_BYTES).readLine()
    finally:
        stream.close()


def _named(files: DataFrame) -> DataFrame:
    given = {name.strip().upper(): name for name in files.columns}
    return files.select(
        *[
            (F.col(f"`{given[c]}`") if c in given else F.lit(None)).cast("string").alias(c)
            for c in LANDING.columns
        ]
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDING.schema).parquet(path)
