"""Checks of the declared rules: keys, required columns, references and text lengths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.schemas import Table


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("CNT")).where("CNT > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values without a parent and their row count.

    The child is counted per value first, so a hot value is one row in the join.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("CNT"))
    return used.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def too_long(df: DataFrame, column: str, limit: int) -> DataFrame:
    return df.where(F.length(column) > limit)


def cut_to_length(df: DataFrame, table: Table) -> DataFrame:
    return df.withColumns(
        {c: F.left(F.col(c), F.lit(n)) for c, n in table.lengths.items() if c in df.columns}
    )


def longest_breach(df: DataFrame, table: Table) -> dict[str, int]:
    """Columns that hold texts over their length, with the row count; one pass."""
    limits = {c: n for c, n in table.lengths.items() if c in df.columns}
    found = df.agg(*[_count(F.length(c) > n).alias(c) for c, n in limits.items()]).first()
    return {c: found[c] for c in limits if found[c]}


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def _line(table: Table, check: str, detail: str, bad: Column | str) -> list[Column]:
    return [
        F.lit(table.name).alias("TABLE_NAME"), F.lit(check).alias("CHECK_NAME"), F.lit(detail).alias("DETAIL"),
        (F.col(bad) if isinstance(bad, str) else bad).alias("BAD_ROWS"),
    ]


def column_checks(df: DataFrame, table: Table) -> DataFrame:
    """NOT NULL and length breaches of all columns in one pass over the table."""
    tests = {("not null", c): F.col(c).isNull() for c in table.required}
    tests |= {("length", c): F.length(c) > n for c, n in table.lengths.items()}
    lines = [
        F.struct(F.lit(check).alias("CHECK_NAME"), F.lit(c).alias("DETAIL"), _count(test).alias("BAD_ROWS"))
        for (check, c), test in tests.items()
    ]
    return df.agg(F.array(*lines).alias("lines")).select(
        F.lit(table.name).alias("TABLE_NAME"), F.inline("lines")
    )


def key_check(df: DataFrame, table: Table) -> DataFrame:
    extra = duplicate_keys(df, list(table.key)).agg(F.coalesce(F.sum(F.col("CNT") - 1), F.lit(0)).alias("n"))
    return extra.select(*_line(table, "key", ",".join(table.key), "n"))


def reference_checks(tables: dict[str, DataFrame], table: Table) -> DataFrame:
    """Rows without a parent for every reference of a table whose parent is given, in one pass and one join.

    The child is counted per column and value before the join, so a hot value is
    one row there; the parents' keys are tagged with the column they belong to.
    A reference that is the table's own key has a value of its own in every row,
    which counting would only carry further: it goes to its parent as it is.
    """
    columns = {c: parent for c, (parent, _) in table.foreign.items() if parent in tables}
    keys = [c for c in columns if table.key == (c,)]
    parts = [_key_reference(tables, table, c) for c in keys]
    if shared := {c: parent for c, parent in columns.items() if c not in keys}:
        parts.append(_shared_references(tables, table, shared))
    return reduce(DataFrame.unionByName, parts)


def _key_reference(tables: dict[str, DataFrame], table: Table, column: str) -> DataFrame:
    parent, parent_column = table.foreign[column]
    child = tables[table.name].select(F.col(column).cast("long").alias("VALUE")).where("VALUE IS NOT NULL")
    lost = child.join(tables[parent].select(F.col(parent_column).cast("long").alias("VALUE")), "VALUE", "left_anti")
    return lost.agg(F.count("*").alias("n")).select(*_line(table, "reference", f"{column} -> {parent}", "n"))


def _shared_references(tables: dict[str, DataFrame], table: Table, columns: dict[str, str]) -> DataFrame:
    child = tables[table.name].select(*[F.col(c).cast("long").alias(c) for c in columns])
    # Counted by the tuple first: the rows that are spread out are tuples, not facts.
    tuples = child.groupBy(*columns).agg(F.count("*").alias("N"))
    used = tuples.unpivot(["N"], list(columns), "FIELD", "VALUE").where("VALUE IS NOT NULL").groupBy("FIELD", "VALUE").agg(
        F.sum("N").alias("CNT")
    )
    known = reduce(DataFrame.unionByName, [
        tables[parent].select(F.lit(c).alias("FIELD"), F.col(table.foreign[c][1]).cast("long").alias("VALUE"))
        for c, parent in columns.items()
    ])
    lost = used.join(known, ["FIELD", "VALUE"], "left_anti")
    lines = [
        F.struct(
            F.lit("reference").alias("CHECK_NAME"), F.lit(f"{c} -> {parent}").alias("DETAIL"),
            F.coalesce(F.sum(F.when(F.col("FIELD") == c, F.col("CNT"))), F.lit(0)).alias("BAD_ROWS"),
        )
        for c, parent in columns.items()
    ]
    return lost.agg(F.array(*lines).alias("lines")).select(F.lit(table.name).alias("TABLE_NAME"), F.inline("lines"))


def unchecked(spark: SparkSession, table: Table, missing: list[str]) -> DataFrame:
    """A line without a count for each reference to a parent that was not given."""
    lines = [(table.name, "reference", f"{c} -> {parent}", None) for c, (parent, _) in table.foreign.items() if parent in missing]
    return spark.createDataFrame(lines, "TABLE_NAME string, CHECK_NAME string, DETAIL string, BAD_ROWS long")


def quality_report(tables: dict[str, DataFrame], declared: dict[str, Table]) -> DataFrame:
    """One line per check over the tables given; a reference whose parent is not given has a NULL count: not checked."""
    parts = []
    for name, df in tables.items():
        table = declared[name]
        parts.append(column_checks(df, table))
        if table.key:
            parts.append(key_check(df, table))
        parents = [parent for parent, _ in table.foreign.values()]
        if any(parent in tables for parent in parents):
            parts.append(reference_checks(tables, table))
        if missing := [parent for parent in parents if parent not in tables]:
            parts.append(unchecked(df.sparkSession, table, missing))
    return reduce(DataFrame.unionByName, parts)
