"""Session settings and the shared staging area."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

# Settings that matter for these jobs on any cluster; sizes are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
SHUFFLE_BYTES = 256 * 1024**2  # wanted size of one shuffle partition


def shuffle_partitions(data_bytes: int) -> int:
    """Shuffle partitions for the largest input; adaptive execution merges those that turn out small."""
    return max(200, -(-data_bytes // SHUFFLE_BYTES))


def build_session(
    master: str | None = None, app: str = "ledgerloom", data_bytes: int | None = None, **extra: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {"spark.sql.shuffle.partitions": str(shuffle_partitions(data_bytes))} if data_bytes else {}
    for key, value in {**SETTINGS, **sized, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """Shared folder for cut-off points, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster a
    machine-local folder would be lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running staged jobs")
    root = tempfile.mkdtemp(prefix="ledgerloom-stage-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


_OPEN_SCOPES: list[list[str]] = []


def stage(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    This cuts lineage (a lost executor re-reads files instead of re-running the
    statement parse), pins results that must not change between two jobs, and
    gives the planner true sizes, so small tables broadcast without a hint.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    for scope in _OPEN_SCOPES[-1:]:
        scope.append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_parts(parts: list[tuple[int, DataFrame]], label: str, column: str) -> DataFrame:
    """``stage`` of frames that each hold one value of ``column``, as one table partitioned by it.

    Every frame goes straight to its own partition folder, so no task sorts its rows by the partition, as one write
    of all of them would.
    """
    first = parts[0][1]
    spark, path = first.sparkSession, f"{staging_root(first.sparkSession)}/{label}-{uuid.uuid4().hex}"
    for scope in _OPEN_SCOPES[-1:]:
        scope.append(path)
    for value, df in parts:
        df.drop(column).write.mode("append").parquet(f"{path}/{column}={value}")
    return spark.read.schema(first.schema).parquet(path)


def counted(df: DataFrame, label: str, **figures: Column) -> tuple[DataFrame, dict]:
    """``stage`` with aggregates of the rows, their number as ``rows`` if none is named, gathered as they are written.

    No second job reads the rows.  The figures belong to the tasks that write, and a write task that is run again counts
    once, so they hold when an executor is lost.
    """
    seen = Observation()
    wanted = figures or {"rows": F.count(F.lit(1))}
    staged = stage(df.observe(seen, *(c.alias(n) for n, c in wanted.items())), label)
    return staged, seen.get


def weighed(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A stored table as a side of a join: not to be broadcast if its rows are more than the planner's limit holds in memory.

    The planner takes the bytes of compressed files, shared out by the declared width of the columns, for the bytes in
    memory.  Ids among columns of few values come to many times that, and what is broadcast passes through the driver.  Here
    the rows are counted, or given as ``rows``, and each is as wide as the planner takes it to be.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    width = 8 + df._jdf.schema().defaultSize()  # of a row: its header and its values
    return df.hint("merge") if (df.count() if rows is None else rows) * width > limit else df


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the tables staged inside the block when it ends well.

    A job's staged tables can be as large as its input, so a job that has
    written its results does not leave them behind.  What a failed job had
    staged stays, as it may be the only copy of what it worked out.
    """
    _OPEN_SCOPES.append([])
    try:
        yield
    except BaseException:
        _OPEN_SCOPES.pop()
        raise
    for path in _OPEN_SCOPES.pop():
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder and all it holds from whatever store it is in."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders and files right below a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [f.getPath().getName() for f in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]


_CLAIMING = threading.Lock()


def claimed(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it is there already, and tell whether this call made it.

    Of several drivers one alone succeeds where the store creates files conditionally, as HDFS does; on a local disk this
    holds for the threads of one driver.
    """
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = file.getFileSystem(spark._jsc.hadoopConfiguration())
    with _CLAIMING:
        try:
            store.create(file, False).close()
        except Py4JJavaError as error:
            # Its owner may have removed the file since, so it need not be there any more.
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException" or store.exists(file):
                return False
            raise
    return True
