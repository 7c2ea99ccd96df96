"""Running sums and ranks in a global order, made from ranges and one total each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracat.functions.cells import col
from veracat.session import materialise


def in_ranges(df: DataFrame, order: Sequence[str | Column], name: str = "_range") -> DataFrame:
    """The rows dealt by ranges of an order and written, with the number of their range. Every row of a range comes
    before every row of the next one; rows that tie share a range, so the order should be as fine as the rows."""
    return materialise(df.repartitionByRange(*order).withColumn(name, F.spark_partition_id()), "ranges")


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: Column, name: str) -> DataFrame:
    """The sum of ``value`` over the rows of a key up to and with each row, in order; NULL keys are one key.

    A prefix sum in two steps: every range is summed inside itself, and lifted by the totals of the key in the ranges
    before. Keys are the first part of the order, so a key has a total for each range that it reaches into: one, or,
    for a key that holds much of the table, as many as there are ranges. No window holds more than a range of rows or
    one row for each range.
    """
    dealt = in_ranges(df.withColumns({"_key": F.struct(F.lit(0), *keys), "_value": value}), ["_key", *order])
    part = F.struct("_key", "_range")
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("_part._key").orderBy("_part._range").rowsBetween(Window.unboundedPreceding, -1)
    marked = dealt.withColumn("_part", part)
    lifts = marked.groupBy("_part").agg(F.sum("_value").alias("_total")).withColumn("_lift", F.sum("_total").over(before))
    summed = marked.withColumn("_inside", F.sum("_value").over(inside)).join(lifts.filter("_lift IS NOT NULL").select("_part", "_lift"), "_part", "left")
    return summed.select(*df.columns, (F.coalesce("_inside", F.lit(0)) + F.coalesce("_lift", F.lit(0))).alias(name))


#: A key of more rows than this is ranked by ranges; the rows of any other key are one group of a window.
MANY = 100_000
#: Groups of keys that are counted before keys are: few enough to be added up in every task, whatever the keys.
GROUPS = 1 << 16


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "rank", many: int = MANY) -> DataFrame:
    """The place of each row among the rows of its key, from 1; NULL keys are one key. Rows that tie get different places.

    The rows of a key are counted first, and before that the rows of ``GROUPS`` groups of keys: where no group has more than
    ``many``, no key has, and keys are not counted. Keys of up to ``many`` rows are ranked by a window, in one shuffle. The others,
    few by their size, are dealt by ranges, see ``_ranked_by_ranges``. ``df`` is read for each count and for each of the
    two kinds that it holds.
    """
    order = [col(o) if isinstance(o, str) else o for o in order]
    if not keys:
        return _ranked_by_ranges(df, keys, order, name)
    by_key = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")
    groups = df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(GROUPS)).alias("_group")).agg(F.count("*").alias("_n"))
    if groups.filter(F.col("_n") > many).isEmpty():
        return df.select("*", by_key.alias(name))
    counted = df.groupBy(F.struct(F.lit(0), *keys).alias("_key")).agg(F.count("*").alias("_n"))
    # A row for each large key, and one without a key for all others.
    sizes = materialise(counted.groupBy(F.when(F.col("_n") > many, F.col("_key")).alias("_key")).agg(F.sum("_n").alias("_n")), "sizes")
    large, small = sizes.agg(F.bool_or(F.col("_key").isNotNull()), F.bool_or(F.col("_key").isNull())).first()
    if not large:
        return df.select("*", by_key.alias(name))
    keyed, theirs = df.withColumn("_key", F.struct(F.lit(0), *keys)), F.broadcast(sizes.filter("_key IS NOT NULL").select("_key"))
    out = _ranked_by_ranges(keyed.join(theirs, "_key", "left_semi").select(*df.columns) if small else df, keys, order, name)
    if not small:
        return out
    return out.unionByName(keyed.join(theirs, "_key", "left_anti").select(*df.columns, by_key.alias(name)))


def _ranked_by_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Rows are dealt by ranges of the key and the order and written in order, with their number in the task. A row's
    place is how far it lies behind its key's first row in its range, and the rows of the key in the ranges before. Keys
    and ranges have one small row each where they meet, which every task is sent; no window holds the rows themselves."""
    dealt = df.withColumn("_key", F.struct(F.lit(0), *keys)).repartitionByRange("_key", *order).sortWithinPartitions("_key", *order)
    placed = materialise(dealt.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranges")
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy("_key", "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    lifted = firsts.select("_key", "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_lift"))
    return placed.join(F.broadcast(lifted), ["_key", "_range"]).select(*df.columns, (F.col("_at") + F.col("_lift")).alias(name))


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int, name: str = "_nth") -> DataFrame:
    """The first n rows of each key, with their place. Spark cuts at n in every task before the shuffle as well, so no
    task gathers a key."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, nth).filter(F.col(name) <= n)
