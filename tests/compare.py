"""Run registered queries against their checking SQL and report differences."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

SOURCES = ("orders", "customer", "nation", "region")


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in SOURCES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(spark, con, name: str, sf_dir: str):
    """(spark rows, oracle rows, first differing pairs); columns are compared by name."""
    df = entry.queries()[name](spark, sf_dir)
    order = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*order).collect()]
    cursor = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    if sorted(names) != order:
        return len(ours), -1, [(order, sorted(names))]
    place = [names.index(c) for c in order]
    theirs = [tuple(r[i] for i in place) for r in cursor.fetchall()]
    key = lambda row: tuple((v is not None, str(v)) for v in row)
    ours.sort(key=key)
    theirs.sort(key=key)
    pairs = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return len(ours), len(theirs), pairs


if __name__ == "__main__":
    from ledgerloom.session import build_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
                       "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name in wanted or entry.queries():
        start = time.time()
        try:
            a, b, pairs = differences(spark, con, name, sf)
            state = "ok " if a == b and not pairs else "BAD"
            print(state, name, a, b, round(time.time() - start, 1), pairs[:1] if pairs else "", flush=True)
        except Exception as error:  # report and go on with the next query
            print("ERR", name, str(error)[:600].replace("\n", " "), flush=True)
