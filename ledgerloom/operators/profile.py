"""Schema profile and the read-only query call."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ledgerloom.schemas import Table

# Sample size, name parts that ask for samples, and functions that a reading query may not call.
SAMPLE_SIZE = 15
SAMPLED_NAMES = ["NAME", "TYPE", "CATEGORY", "CATG", "STATUS"]
CALLING_FUNCTIONS = ["reflect", "java_method", "try_reflect"]
SCRIPT_NODES = ["Call", "CompoundBody"]
GROUPS = 128  # groups of values of a column of which only the lowest is sent on, well above the sample size
PREFIX_BYTES = 15  # bytes of a text whose number fits a decimal of 38 digits


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables of a database."""
    names = [(t.name.upper(),) for t in spark.catalog.listTables(database) if not t.isTemporary]
    return spark.createDataFrame(names, "TABLE_NAME string").orderBy("TABLE_NAME")


LINE = "POSITION int, FIELD string, TYPE string, NULLABLE string, COLUMN_KEY string"


def described(schema: T.StructType, table: Table) -> list[tuple]:
    required = set(table.required)
    return [
        (
            i, f.name, f.dataType.simpleString(), "NO" if f.name in required else "YES",
            "PRI" if f.name in table.key else "",
        )
        for i, f in enumerate(schema, start=1)
    ]


def describe(spark: SparkSession, schema: T.StructType, table: Table) -> DataFrame:
    """Name, type, nullability and key mark of every column."""
    return spark.createDataFrame(described(schema, table), LINE)


def prefix_bytes(text: Column) -> Column:
    return F.substring(text.cast("binary"), 1, PREFIX_BYTES)


def prefix_number(text: Column) -> Column:
    """The first PREFIX_BYTES bytes of a text as a number that keeps their order."""
    digits = F.rpad(F.hex(prefix_bytes(text)), 2 * PREFIX_BYTES, "0")
    high, low = (F.conv(F.substring(digits, at, n), 16, 10) for at, n in ((1, 14), (15, 16)))
    return (high.cast("decimal(17,0)") * F.lit(str(2**64)).cast("decimal(20,0)") + low.cast("decimal(20,0)")).cast("decimal(38,0)")


def number_bytes(number: Column) -> Column:
    """The bytes of a prefix number, zero bytes where the text was shorter."""
    unit = F.lit(str(2**64)).cast("decimal(20,0)")
    low = (number % unit).cast("decimal(20,0)")
    high = ((number - low) / unit).cast("decimal(17,0)")
    digits = [F.lpad(F.conv(part.cast("string"), 10, 16), n, "0") for part, n in ((high, 14), (low, 16))]
    return F.unhex(F.concat(*digits))


def first_values(long: DataFrame, limit: int = SAMPLE_SIZE) -> DataFrame:
    """``NO, SAMPLES``: the first distinct values of every column numbered ``NO``, compared without case, lowest spelling shown.

    ``long`` has ``NO, VALUE`` and is read twice.  Values are first dealt to GROUPS by hash and only the lowest prefix of each
    group is sent on, as a number, so that the tasks hash the rows and sort none: as equal values share a group, at least
    ``limit`` distinct values do not exceed the ``limit``-th of these.  What exceeds it is dropped where it is read, and the
    spellings that are left, each sent once by a task, are told apart as a whole.  These are few unless a great many values
    agree in their first PREFIX_BYTES bytes; then those are sent and compared too.
    """
    keyed = long.where("VALUE IS NOT NULL").select("NO", F.upper("VALUE").alias("_K"), "VALUE")
    group = F.pmod(F.xxhash64("_K"), F.lit(GROUPS)).cast("int").alias("_G")
    lowest = keyed.groupBy("NO", group).agg(F.min(prefix_number(F.col("_K"))).alias("_P"))
    # One row for each column of the tables, so it may go to all tasks.
    ends = lowest.groupBy("NO").agg(F.get(F.sort_array(F.collect_list("_P")), F.lit(limit - 1)).alias("_END"))
    ends = ends.select("NO", number_bytes(F.col("_END")).alias("_END"))
    near = keyed.join(F.broadcast(ends), "NO").where(F.col("_END").isNull() | (prefix_bytes(F.col("_K")) <= F.col("_END")))
    distinct = near.select("NO", "_K", "VALUE").distinct().groupBy("NO", "_K").agg(F.min("VALUE").alias("VALUE"))
    place = F.row_number().over(Window.partitionBy("NO").orderBy("_K"))
    kept = distinct.withColumn("POS", place).where(F.col("POS") <= limit)
    pairs = F.array_sort(F.collect_list(F.struct("POS", "VALUE")))
    return kept.groupBy("NO").agg(F.transform(pairs, lambda p: p["VALUE"]).alias("SAMPLES"))


def column_samples(df: DataFrame, column: str, limit: int = SAMPLE_SIZE) -> DataFrame:
    """The first distinct values of a column in order, without regard to case; the lowest spelling is shown."""
    long = df.select(F.lit(0).alias("NO"), F.col(column).cast("string").alias("VALUE"))
    return first_values(long, limit).select(F.explode("SAMPLES").alias("VALUE"))


def sampled_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if any(part in c.upper() for part in SAMPLED_NAMES)]


def samples(tables: dict[str, DataFrame], limit: int = SAMPLE_SIZE) -> DataFrame:
    """``TABLE_NAME, FIELD, SAMPLES`` of the descriptive columns of all tables, worked out together in one job."""
    spark, names, parts = next(iter(tables.values())).sparkSession, [], []
    for name, df in tables.items():
        columns = sampled_columns(df)
        if columns:
            numbered = [F.struct(F.lit(len(names) + i).alias("NO"), F.col(c).cast("string").alias("VALUE")) for i, c in enumerate(columns)]
            parts.append(df.select(F.inline(F.array(*numbered))))
            names += [(len(names) + i, name, c) for i, c in enumerate(columns)]
    named = spark.createDataFrame(names, "NO int, TABLE_NAME string, FIELD string")
    if not parts:
        return named.select("TABLE_NAME", "FIELD", F.array().cast("array<string>").alias("SAMPLES"))
    return first_values(reduce(DataFrame.unionByName, parts), limit).join(F.broadcast(named), "NO").drop("NO")


def profile(tables: dict[str, DataFrame], declared: dict[str, Table], limit: int = SAMPLE_SIZE) -> DataFrame:
    """One line per table and column, with samples for the descriptive ones."""
    lines = []
    for name, df in tables.items():
        lines += [(name, *line) for line in described(df.schema, declared[name])]
    spark = next(iter(tables.values())).sparkSession
    told = spark.createDataFrame(lines, f"TABLE_NAME string, {LINE}")
    # Lines and samples have one row for each column of the tables.
    return told.join(F.broadcast(samples(tables, limit)), ["TABLE_NAME", "FIELD"], "left").select(
        "TABLE_NAME", "POSITION", "FIELD", "TYPE", "NULLABLE", "COLUMN_KEY", F.array_join("SAMPLES", ", ").alias("SAMPLES")
    )


def profile_database(spark: SparkSession, database: str, declared: dict[str, Table], limit: int = SAMPLE_SIZE) -> DataFrame:
    """The profile of every stored table of a database that is declared."""
    names = [r["TABLE_NAME"] for r in list_tables(spark, database).collect()]
    tables = {n: spark.table(f"{database}.{n}").select(*declared[n].columns) for n in names if n in declared}
    return profile(tables, declared, limit)


def is_read_only(spark: SparkSession, sql: str) -> bool:
    """Whether the parsed statement only reads: a query, or a command that shows, describes or explains.

    Functions that call into the running program are no reading either.  Text that does not parse is not run.
    """
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception:
        return False
    kind = plan.getClass().getSimpleName()
    command = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.logical.Command")
    statement = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.logical.ParsedStatement")
    if command.isInstance(plan) or statement.isInstance(plan):
        return kind.startswith(("Show", "Describe")) or kind == "ExplainCommand" and is_read_only(spark, explained(sql))
    if any(f"'{name}(" in plan.toString().lower() for name in CALLING_FUNCTIONS):
        return False
    nodes = [plan]
    while nodes:
        node = nodes.pop()
        if command.isInstance(node) or statement.isInstance(node) or node.getClass().getSimpleName() in SCRIPT_NODES:
            return False
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return True


def explained(sql: str) -> str:
    """The statement that an EXPLAIN is about."""
    return re.sub(r"^\s*EXPLAIN\s+(EXTENDED\s+|CODEGEN\s+|COST\s+|FORMATTED\s+|LOGICAL\s+)?", "", sql, flags=re.I)


def read_only_query(spark: SparkSession, sql: str, params: dict | list | None = None) -> DataFrame:
    """Run a query that cannot change data; anything else raises PermissionError."""
    text = sql.rstrip().rstrip(";")
    if not is_read_only(spark, text):
        raise PermissionError("only reading queries are allowed")
    return spark.sql(text, args=params) if params else spark.sql(text)


def rows(df: DataFrame) -> Iterator[dict]:
    """Rows as dictionaries, fetched one partition at a time; all of them pass through the driver, so ask for few."""
    return (r.asDict() for r in df.toLocalIterator())
