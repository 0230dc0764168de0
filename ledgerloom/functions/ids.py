"""Row ranks, hashed ids and identity columns that do not need a one-task sort."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerloom.session import stage

_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, position below


def content_key(columns: list[str]) -> Column:
    """Digest of whole rows, used to order rows that tie on the wanted keys; its 16 bytes sort as its hex digits do."""
    return F.unhex(F.md5(F.concat_ws("\x01", *[F.coalesce(F.col(c), F.lit("\x02")) for c in columns])))


def global_rank(df: DataFrame, order: list[Column], name: str, label: str, tie: Column | None = None) -> DataFrame:
    """Number all rows 1..n in the given order, without one task seeing them all.

    ``tie`` orders the rows that are equal by ``order``; it is made once per row.

    The rows are range-partitioned and sorted, then written once with the
    position each row has inside its partition.  The partitions are counted from
    that one column, and a running sum over the counts (one row per partition)
    gives each its offset.  These rows are sent to the scan tasks whatever size
    the planner expects, as they are no more than the shuffle has partitions; it
    takes them for a share of the rows and would shuffle a large table by its
    partition number to meet them.  A trailing salt in the range key lets a run
    of equal rows spread over several partitions; as equal rows are
    interchangeable the numbering stays well defined.  The input must give its
    rows in the same order when a task runs again, as a file scan does; stage
    anything else first.
    """
    made = {"_salt": F.monotonically_increasing_id(), **({} if tie is None else {"_tie": tie})}
    keys = [*order, *([] if tie is None else [F.col("_tie")]), F.col("_salt")]
    placed = (
        df.withColumns(made)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop(*made)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    staged = stage(placed, label).withColumn("_part", F.shiftright("_place", _POSITION_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = staged.groupBy("_part").count()
    starts = counts.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)) + 1
    return staged.join(F.broadcast(starts), "_part").withColumn(name, position + F.col("_start")).drop("_part", "_start", "_place")


def hash_id(text: Column) -> Column:
    """Positive 63-bit id from the first 16 hex digits of an MD5; NULL for a NULL text."""
    # try_cast, as the one value without a positive counterpart must give NULL, not an error.
    digits = F.conv(F.substring(F.md5(text), 1, 16), 16, -10)
    return F.ltrim(digits, F.lit("-")).try_cast("long")


def lookups(**questions: DataFrame) -> dict:
    """Answer several one-value questions (frames of one row and one column) in one job."""
    parts = [df.select(F.lit(name).alias("name"), F.col(df.columns[0]).cast("long").alias("value"))
             for name, df in questions.items()]
    return {r["name"]: r["value"] for r in reduce(DataFrame.unionByName, parts).collect()}


def highest(df: DataFrame, column: str, base: int = 0) -> DataFrame:
    """Highest value so far, or ``base`` for an empty table, as a one-value frame."""
    return df.agg(F.coalesce(F.max(column), F.lit(base)))


def next_value(df: DataFrame, column: str, base: int = 0) -> int:
    return highest(df, column, base).first()[0]


def occurrence(
    staged: DataFrame, group: Column, order: list[Column], name: str, label: str, keep: list[str] | None = None
) -> DataFrame:
    """Number the rows of each group from 1, in order, without a task per group.

    The rows are ranked as a whole with the group first; a row's number is its
    rank less the lowest of its group, found by an aggregate that combines on
    the map side, so one group with most of the rows stays split.  Only groups
    of several rows are looked up; they are staged, so that their true size
    decides the join and the rows stay where they are while such groups are few.
    ``keep`` names the columns handed on, those of ``order`` among them, where ``group`` needs more.
    """
    grouped = staged.select(*(keep or staged.columns), group.alias("_group"))
    ranked = global_rank(grouped, [F.col("_group"), *order], "_whole", label)
    sizes = ranked.groupBy(F.col("_group").alias("_g")).agg(F.min("_whole").alias("_first"), F.count("*").alias("_rows"))
    first = stage(sizes.where("_rows > 1").drop("_rows"), f"{label}-repeated")
    joined = ranked.join(first, F.col("_group").eqNullSafe(F.col("_g")), "left")
    number = F.coalesce(F.col("_whole") - F.col("_first") + 1, F.lit(1))
    return joined.withColumn(name, number).drop("_group", "_g", "_whole", "_first")


def assign_identity(new_rows: DataFrame, order: list[Column], starts: dict[str, int], label: str) -> DataFrame:
    """Give each new row the next values of one or more counters, in the given order.

    ``starts`` maps a counter column to the last value in use.  The rows are
    staged and ranked, so ids stay as given however often they are read.  Two
    jobs that number the same table at the same time would give the same ids:
    let one writer run at a time.
    """
    ranked = global_rank(stage(new_rows, f"new-{label}"), order, "_rank", label)
    return ranked.withColumns({c: (F.col("_rank") + F.lit(start)).cast("int") for c, start in starts.items()}).drop("_rank")


def running_total(ranked: DataFrame, rank: str, flag: Column, name: str, bucket_rows: int = 1_000_000) -> DataFrame:
    """Running sum of ``flag`` along a 1..n rank, by buckets of equal size.

    Every bucket holds at most ``bucket_rows`` rows whatever the keys look like;
    the bucket sums (one row per bucket) carry the total from one to the next.
    """
    flagged = ranked.withColumn("_flag", flag.cast("long")).withColumn(
        "_bucket", F.floor((F.col(rank) - 1) / bucket_rows)
    )
    sums = flagged.groupBy("_bucket").agg(F.sum("_flag").alias("_sum"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carried"))
    inside = Window.partitionBy("_bucket").orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    return (
        flagged.withColumn("_inside", F.sum("_flag").over(inside))
        .join(carried, "_bucket")
        .withColumn(name, F.col("_inside") + F.col("_carried"))
        .drop("_flag", "_bucket", "_inside", "_carried")
    )
