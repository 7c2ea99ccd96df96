"""The register of queries, and the tables they read."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracat.session import configure


class Tables:
    """The benchmark tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def lines(self) -> DataFrame:
        """Line items as evidence: the supplier's nation is the dataset, the part the entity, the
        order the group, the discount the q-value and the return flag the label."""
        s = self.supplier.select("s_suppkey", "s_nationkey")
        flag = F.col("l_returnflag")
        label = F.when(flag == "N", "target").when(flag == "R", "decoy").otherwise("contaminant")
        quantity = F.col("l_quantity").cast("bigint")
        ambiguous = F.when((F.col("l_linestatus") == "F") & (quantity > 25), True).when(F.col("l_linestatus") != "F", False)
        return self.lineitem.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(
            text("D", "s_nationkey").alias("dataset_id"), text("P", "l_partkey").alias("entity"), text("G", "l_orderkey").alias("group_id"),
            F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("form_id"),
            label.alias("label"), F.col("l_discount").alias("q"), F.nullif("l_tax", F.lit(0.0)).alias("q2"), ambiguous.alias("ambiguous"),
            quantity.alias("n"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus",
        )

    @cached_property
    def members(self) -> DataFrame:
        """Lines with a list of two member entities."""
        return self.lines.withColumn("members", F.array("entity", text("P", F.col("l_partkey") % 97)))


def text(prefix: str, c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(prefix), c.cast("string"))


def joined(c: str | Column, sep: str = ",") -> Column:
    """A list as text, so both engines print it alike."""
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.transform(c, lambda x: x.cast("string")), sep)


# The same bindings in SQL.
LINES_SQL = """lines AS (
  SELECT 'D' || s.s_nationkey AS dataset_id, 'P' || l.l_partkey AS entity, 'G' || l.l_orderkey AS group_id,
         l.l_orderkey || ':' || l.l_linenumber AS form_id,
         CASE l.l_returnflag WHEN 'N' THEN 'target' WHEN 'R' THEN 'decoy' ELSE 'contaminant' END AS label,
         l.l_discount AS q, nullif(l.l_tax, 0.0) AS q2,
         CASE WHEN l.l_linestatus = 'F' AND CAST(l.l_quantity AS BIGINT) > 25 THEN true WHEN l.l_linestatus <> 'F' THEN false END AS ambiguous,
         CAST(l.l_quantity AS BIGINT) AS n, l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_extendedprice,
         l.l_returnflag, l.l_linestatus
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
), members AS (
  SELECT *, ['P' || l_partkey, 'P' || (l_partkey % 97)] AS members FROM lines
)"""

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None = None, lines: bool = False):
    """Register a query. ``sql`` restates it; ``lines`` puts the evidence bindings in front of it."""
    full = f"WITH {LINES_SQL}{', ' if sql and sql.lstrip().startswith('+') else ' '}{sql.lstrip().lstrip('+')}" if sql and lines else sql

    def add(fn: Callable[[Tables], DataFrame]):
        REGISTRY[fn.__name__] = (lambda spark, folder: fn(Tables(spark, folder)), full)
        return fn

    return add
