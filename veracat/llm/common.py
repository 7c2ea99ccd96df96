"""What several operators share: words, running sums, connected components, row identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veracat.session import configure, materialise

# Fixed: the white space of the word definition, and the characters between lower-case ASCII words.
SPACE = r"[\x20\x09-\x0D]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def settings(spark: SparkSession) -> SparkSession:
    """The library's settings, with Arrow batches small enough for rows that hold whole texts."""
    configure(spark, {}).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark


def whole(text: str | Column) -> Column:
    """A text, with NULL as the empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def pieces(text: Column, separator: str) -> Column:
    """What stands between runs of a separator; a split leaves an empty piece only at the ends."""
    return F.filter(F.split(text, separator), lambda w: w != "")


def words(text: str | Column) -> Column:
    return pieces(whole(text), SPACE)


def folded_words(text: str | Column) -> Column:
    """Words of ASCII letters, digits and anything beyond ASCII, with A-Z lower-cased."""
    upper = "".join(map(chr, range(65, 91)))
    return pieces(F.translate(whole(text), upper, upper.lower()), NOT_WORD)


def grams(items: Column, n: int) -> Column:
    """A hash of every n consecutive items, in order; none where there are fewer than n."""
    starts = F.sequence(F.lit(1), F.size(items) - (n - 1))
    return F.when(F.size(items) >= n, F.transform(starts, lambda i: F.xxhash64(F.slice(items, i, F.lit(n))))).otherwise(F.array().cast("array<bigint>"))


def let(value: Column, body) -> Column:
    """Bind an expression once, as the variable of a lambda over a list of one: an expression that stands
    inside another lambda is computed anew for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that the frame does not use yet, compared as Spark does, without case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame less the columns that an operator is about to add under its own names."""
    drop = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in drop])


def spread(df: DataFrame) -> DataFrame:
    """A small table of work items, dealt out over all cores, four tasks to a core at most. A shuffle that names its
    number of partitions is not coalesced at run time, as one of a few short rows would be."""
    return df.repartition(max(1, min(df.count(), 4 * df.sparkSession.sparkContext.defaultParallelism)))


def light(df: DataFrame) -> DataFrame:
    """A table of short rows, written as a quarter of the files that a shuffle would leave."""
    return df.coalesce(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4))


def running_sum(df: DataFrame, order: list[str | Column], value: str, name: str) -> DataFrame:
    """The sum of ``value`` over all rows before each row in a global order, without gathering the rows.

    The rows are dealt by ranges of the order and written; each range is summed inside itself and lifted by
    the totals of the ranges before it, one row per range. Rows that tie over ``order`` share a range, so the
    order should be as fine as the rows.
    """
    (block,) = free(df, "block")
    dealt = df.repartitionByRange(*order).withColumn(block, F.spark_partition_id())
    kept = materialise(dealt, "ranges")
    totals = kept.groupBy(block).agg(F.sum(value).alias("total"))
    lifts = totals.select(
        F.col(block).alias("of_block"),
        F.coalesce(F.sum("total").over(Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("lift"),
    )
    inside = F.sum(value).over(Window.partitionBy(block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    out = kept.withColumn(name, F.coalesce(inside, F.lit(0)))
    # One row per range: its size is that of the shuffle setting, not of the data.
    out = out.join(F.broadcast(lifts), F.col(block) == F.col("of_block"))
    return out.withColumn(name, F.col(name) + F.col("lift")).drop(block, "of_block", "lift")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of a graph: (node, root), root the smallest node that can be reached.

    Alternates large and small stars: every node hangs its larger, then its smaller neighbours from the
    smallest node it knows, which takes a number of rounds logarithmic in the longest path. A node's neighbours are only
    ever reduced to their minimum, so a hub is never gathered; each round is written to the shared folder.
    """
    now = materialise(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct().transform(light), "edges")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lowest.select("u", F.col("m").alias("v")))
        new = materialise(light(small.where("u <> v").distinct()), "edges")
        if new.exceptAll(now).isEmpty() and now.exceptAll(new).isEmpty():
            return new.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(new.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        now = new
