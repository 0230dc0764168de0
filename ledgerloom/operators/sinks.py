"""Load patterns as frame-to-frame functions, plus thin writers over catalog tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from ledgerloom.functions.text import fold
from ledgerloom.schemas import MONTH, TABLES, Table, table_of
from ledgerloom.session import claimed, counted, delete, folders, stage, weighed

LARGE_BATCH = 100_000  # rows of a batch that no join should move for a few keys


def first_per_key(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """First row of every key in the given order; the other columns break ties.

    The rank limit is applied on the map side as well, so a key that holds a
    third of all rows still reaches the reduce side as one row per map task.
    """
    lead = [c for c in order if c not in key]
    rest = [c for c in rows.columns if c not in key and c not in lead]
    first = Window.partitionBy(*key).orderBy(*lead, *rest)
    return rows.withColumn("_ROW", F.row_number().over(first)).where("_ROW = 1").drop("_ROW")


def insert_ignore(rows: DataFrame, target: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Rows whose key is new: first wins inside the batch, the target always wins.

    Only the key of the target is read.  The batch is staged where it lies, and
    its repeated keys are found from the keys alone: only rows of those are
    gathered and sorted.  These are staged too, and of a large batch the keys
    found in the target, so that true sizes decide the joins: a statement whose
    ids fit the planner's broadcast limit in memory is sent to the target's scan
    tasks and no stored id moves, of a larger one the ids alone are shuffled.
    The batch stays where it is while either kind of key is few.
    """
    given, seen = counted(rows, "insert-batch")
    large = seen["rows"] > LARGE_BATCH
    repeated = stage(given.groupBy(*key).agg(F.count("*").alias("_N")).where("_N > 1").select(*key), "insert-repeated")
    again = (weighed(repeated) if large else repeated).select(*[F.col(c).alias(f"_K_{c}") for c in key])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_K_{c}")) for c in key])
    first = first_per_key(given.join(again, same, "left_semi"), key, order)
    batch = given.join(again, same, "left_anti").unionByName(first)
    held = target.select(*key).join(weighed(given.select(*key), seen["rows"]), key, "left_semi")
    if large:
        held = weighed(stage(held, "insert-held"))
    return batch.join(held, key, "left_anti").select(*rows.columns)


def untouched(rows: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Target rows that a replace leaves as they are."""
    return target.join(rows.select(*key), key, "left_anti").select(*target.columns)


def untouched_counted(rows: DataFrame, target: DataFrame, key: list[str]) -> tuple[DataFrame, Observation]:
    """``untouched``, and how many target rows are ``replaced``, known once the rows have been written.

    Keys are unique on both sides.  The count is taken behind the join, in the tasks that write, so it costs no job and no
    further shuffle.
    """
    seen = Observation()
    hits = target.join(rows.select(*key, F.lit(True).alias("_HIT")), key, "left").observe(seen, F.count("_HIT").alias("replaced"))
    return hits.where("_HIT IS NULL").select(*target.columns), seen


def replace_into(rows: DataFrame, target: DataFrame, key: list[str], table: Table | None = None) -> DataFrame:
    """Whole-row upsert by key.  Columns the source does not give fall back to NULL, other rows stay."""
    kept = untouched(rows, target, key)
    given = rows
    if table is not None:
        for field in table.schema:
            if field.name not in rows.columns:
                given = given.withColumn(field.name, F.lit(None).cast(field.dataType))
    return kept.unionByName(given.select(*target.columns))


def insert_missing(candidates: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Candidate rows that the target does not hold yet, one per key; texts are compared as names are."""
    names = [f"_K_{c}" for c in key]
    lowest = F.min(F.struct(*candidates.columns)).alias("_row")
    once = candidates.groupBy(*folded_keys(candidates, key)).agg(lowest)
    missing = once.join(target.select(*folded_keys(target, key)), names, "left_anti")
    return missing.select("_row.*")


def folded_keys(df: DataFrame, key: list[str]) -> list[Column]:
    kinds = dict(df.dtypes)
    return [(fold(F.col(c)) if kinds[c] == "string" else F.col(c)).alias(f"_K_{c}") for c in key]


def insert_row(target: DataFrame, table: Table, **values) -> DataFrame:
    """Append one literal row."""
    row = tuple(values.get(f.name) for f in table.schema)
    one = target.sparkSession.createDataFrame([row], table.schema)
    return target.unionByName(one.select(*target.columns))


def update_where(target: DataFrame, condition: Column, **values) -> DataFrame:
    """Keyed update: the columns given take a new value where the condition holds."""
    kinds = {f.name: f.dataType for f in target.schema}
    changes = {
        c: F.when(condition, (v if isinstance(v, Column) else F.lit(v)).cast(kinds[c])).otherwise(F.col(c))
        for c, v in values.items()
    }
    return target.withColumns(changes)


def truncated(target: DataFrame) -> DataFrame:
    """Same schema, no rows."""
    return target.where(F.lit(False))


def cascade_delete(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows whose parent is still there."""
    return children.join(parents.select(key), key, "left_semi").select(*children.columns)


def modify_columns(target: DataFrame, **changes) -> DataFrame:
    """Add columns or change their type."""
    return target.withColumns(
        {c: (F.col(c) if c in target.columns else F.lit(None)).cast(kind) for c, kind in changes.items()}
    )


def month_number(date: str) -> Column:
    """Year * 100 + month; 0 for a row without a date."""
    return F.coalesce(F.year(date) * 100 + F.month(date), F.lit(0))


class Warehouse:
    """The tables of ``schemas`` as parquet tables of one catalog database."""

    def __init__(self, spark: SparkSession, database: str = "ledgerloom"):
        self.spark, self.database = spark, database

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def create(self, *names: str, location: str | None = None) -> None:
        place = f" LOCATION '{location}'" if location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}{place}")
        for name in names or TABLES:
            table = table_of(name)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
            columns += f", {MONTH} int" if table.month_of else ""
            parts = f" PARTITIONED BY ({', '.join(table.stored_by)})" if table.stored_by else ""
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(name)} ({columns}) USING parquet{parts}")

    def read(self, name: str, months: list[int] | None = None) -> DataFrame:
        """The declared columns; of the months given, if any, only their partitions are read."""
        rows = self.spark.table(self.name(name))
        return (rows if months is None else rows.where(F.col(MONTH).isin(months))).select(*table_of(name).columns)

    def months(self, name: str, condition: Column) -> list[int]:
        """Months, in order, of the rows that meet a condition."""
        found = self.spark.table(self.name(name)).where(condition).select(MONTH).distinct().collect()
        return sorted(r[0] for r in found)

    @contextmanager
    def only_writer(self, wait: float) -> Iterator[None]:
        """Hold the database's writer file; another writer is waited for, ``wait`` seconds at most.

        A driver that dies leaves the file ``_writer`` in the database's folder; remove it once no job of it runs any more.
        """
        file, until = f"{self._place()}/_writer", time.monotonic() + wait
        while not claimed(self.spark, file):
            if time.monotonic() >= until:
                raise TimeoutError(f"another job writes to {self.database}: {file}")
            time.sleep(0.2)
        try:
            for name in TABLES:
                if self.spark.catalog.tableExists(self.name(name)):
                    self.spark.catalog.refreshTable(self.name(name))  # files of the writer before
            yield
        finally:
            delete(self.spark, file)

    def append(self, name: str, rows: DataFrame, gather: bool = True) -> None:
        """Add rows to a table.

        They are gathered by partition first, so that few files are written.  Rows that lie by partition already, as those
        of a table stored by bank and date do, need no ``gather``: each task writes what it reads and no row is shuffled.
        """
        self._ready(name, rows, gather).write.insertInto(self.name(name))

    def overwrite_partition(self, name: str, rows: DataFrame, months: list[int] | None = None, **partition: int) -> None:
        """Replace one partition (or the table, if none is named) by ``rows``, or only some of its months, those of the rows.

        They are written to a new folder first, and each month's partition then points there in one step: a failure on the
        way leaves months as they were or as they shall be, and the same call can be made again.  A month without rows goes.
        """
        of, new = {k: int(v) for k, v in partition.items()}, self._version(name)
        held = self._months_held(name, of)
        self._dated(name, self._monthly(name, rows).drop(*of).hint("rebalance", MONTH), MONTH).write.partitionBy(MONTH).parquet(new)
        written = {int(x.split("=")[1]) for x in folders(self.spark, new) if x.startswith(f"{MONTH}=")}
        if months is not None and not written <= set(months):
            raise ValueError(f"rows of {name} lie outside the months {sorted(months)}")
        old = []
        for month in sorted(written | (held if months is None else held & set(months))):
            where = ", ".join(f"{k} = {v}" for k, v in {**of, MONTH: month}.items())
            old += [self._location(name, where)] if month in held else []
            if month not in written:
                self.spark.sql(f"ALTER TABLE {self.name(name)} DROP PARTITION ({where})")
            elif month in held:
                self.spark.sql(f"ALTER TABLE {self.name(name)} PARTITION ({where}) SET LOCATION '{new}/{MONTH}={month}'")
            else:
                self.spark.sql(f"ALTER TABLE {self.name(name)} ADD PARTITION ({where}) LOCATION '{new}/{MONTH}={month}'")
        self._moved(name, *old)

    def _months_held(self, name: str, of: dict[str, int]) -> set[int]:
        where = f" PARTITION ({', '.join(f'{k} = {v}' for k, v in of.items())})" if of else ""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(name)}{where}").collect()
        return {int(r[0].rsplit("=", 1)[1]) for r in listed}

    def overwrite(self, name: str, rows: DataFrame) -> None:
        """Replace an unpartitioned table, which ``rows`` may be read from; in one step, like a partition."""
        old, new = self._location(name), self._version(name)
        rows.select(*self.spark.table(self.name(name)).columns).write.parquet(new)
        self.spark.sql(f"ALTER TABLE {self.name(name)} SET LOCATION '{new}'")
        self._moved(name, old)

    def _location(self, name: str, partition: str | None = None) -> str:
        """Where the table, or its partition, is stored now."""
        of = f" PARTITION ({partition})" if partition else ""
        lines = self.spark.sql(f"DESCRIBE FORMATTED {self.name(name)}{of}").where("col_name = 'Location'")
        return lines.first()["data_type"]

    def _place(self) -> str:
        place = self.spark.sql(f"DESCRIBE DATABASE {self.database}").where("info_name = 'Location'").first()["info_value"]
        return place.rstrip("/")

    def _version(self, name: str) -> str:
        return f"{self._place()}/_versions/{name.lower()}-{uuid.uuid4().hex}"

    def _moved(self, name: str, *old: str) -> None:
        """Forget cached file lists, and only then remove what was there before."""
        self.spark.sql(f"REFRESH TABLE {self.name(name)}")
        for place in old:
            delete(self.spark, place)

    def truncate(self, name: str) -> None:
        self.spark.sql(f"TRUNCATE TABLE {self.name(name)}")

    def _monthly(self, name: str, rows: DataFrame) -> DataFrame:
        """Columns in stored order, the month worked out from the date."""
        date = table_of(name).month_of
        made = rows.withColumn(MONTH, month_number(date)) if date else rows
        return made.select(*self.spark.table(self.name(name)).columns)

    def _ready(self, name: str, rows: DataFrame, gather: bool = True) -> DataFrame:
        """Columns in stored order, spread so that one hot partition is written by many tasks."""
        stored, parts = self._monthly(name, rows), table_of(name).stored_by
        return self._dated(name, stored.hint("rebalance", *parts) if gather else stored, *parts) if parts else stored

    def _dated(self, name: str, rows: DataFrame, *parts: str) -> DataFrame:
        """Rows of each file by date, so that a filter on the date skips row groups."""
        return rows.sortWithinPartitions(*parts, "TRANSACTION_DATE") if "TRANSACTION_DATE" in table_of(name).columns else rows
