"""Audit log as an append-only table; the state of a run is its latest row."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.ids import next_value
from ledgerloom.schemas import ETL_LOG


def log_row(log: DataFrame, proc: str, bank_id: int | None, start: datetime) -> dict:
    """A STARTED entry with the next log id."""
    return {
        "LOG_ID": next_value(log, "LOG_ID") + 1, "PROC_NAME": proc, "BANK_ID": bank_id, "START_TIME": start,
        "END_TIME": None, "ROWS_PROCESSED": 0, "STATUS": "STARTED", "ERROR_MSG": None,
    }


def finished(entry: dict, end: datetime, rows: int | None = None, error: str | None = None) -> dict:
    """The same entry as SUCCESS with its row count, or FAILED with its message."""
    status = "FAILED" if error else "SUCCESS"
    return {**entry, "END_TIME": end, "STATUS": status, "ROWS_PROCESSED": rows or 0, "ERROR_MSG": error}


def log_frame(spark, entries: list[dict]) -> DataFrame:
    rows = [tuple(e[c] for c in ETL_LOG.columns) for e in entries]
    return spark.createDataFrame(rows, ETL_LOG.schema)


def latest(log: DataFrame) -> DataFrame:
    """One row per run: the finished entry if there is one, else the STARTED one."""
    order = F.struct(F.col("END_TIME").isNotNull().alias("done"), F.col("END_TIME").alias("at"))
    rest = F.struct(*[c for c in ETL_LOG.columns if c != "LOG_ID"])
    picked = log.groupBy("LOG_ID").agg(F.max_by(rest, order).alias("row"))
    return picked.select("LOG_ID", "row.*").select(*ETL_LOG.columns)


def unseen_since(log: DataFrame, proc: str, bank_id: int | None) -> datetime | None:
    """From when on the last good run of a job may have missed what others added; None if it never ended well.

    That is its own start, or the start of a load (of the same bank, if one is given) that was still under way then: its
    rows bear an earlier time than the one at which they came to be seen.
    """
    runs = latest(log) if bank_id is None else latest(log).where(F.col("BANK_ID") == bank_id)
    good = runs.where((F.col("PROC_NAME") == proc) & (F.col("STATUS") == "SUCCESS"))
    seen = good.agg(F.max("START_TIME")).first()[0]
    if seen is None:
        return None
    end = F.coalesce("END_TIME", F.lit(seen).cast("timestamp_ntz"))
    open_then = runs.where(F.col("PROC_NAME").startswith("load_") & (end >= F.lit(seen).cast("timestamp_ntz")))
    return min(seen, open_then.agg(F.min("START_TIME")).first()[0] or seen)
