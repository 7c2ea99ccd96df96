"""A stored index for keyword search: which rows hold which three letters in a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3


def grams_of(text: Column) -> Column:
    """The distinct three letters in a row of a text, in lower case."""
    letters = F.split(F.lower(text), "")
    starts = F.sequence(F.lit(0), F.size(letters) - GRAM)
    held = F.transform(starts, lambda i: F.concat(*[F.get(letters, i + k) for k in range(GRAM)]))
    return F.when(F.length(text) >= GRAM, F.array_distinct(held)).otherwise(F.array().cast("array<string>"))


def write_search_index(spark: SparkSession, sources: Mapping[str, tuple[DataFrame, Sequence[str]]], folder: str) -> None:
    """Write, for each source, its rows with a number (``cards``), and one table of (gram, card) for all, sorted by gram
    and split by ranges of it, so that a question reads the row groups of its own grams alone. A list column
    counts as its entries, set apart by spaces.
    """
    said = []
    for name, (df, columns) in sources.items():
        df.withColumn("_card", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{folder}/cards/{name}")
        cards = spark.read.parquet(f"{folder}/cards/{name}")
        kinds = dict(cards.dtypes)
        texts = [F.array_join(c, " ") if kinds[c].startswith("array") else F.col(c).cast("string") for c in columns]
        held = F.array_distinct(F.flatten(F.array(*[F.coalesce(grams_of(x), F.array().cast("array<string>")) for x in texts])))
        said.append(cards.select(F.lit(name).alias("source"), F.col("_card").alias("card"), F.explode(held).alias("gram")))
    postings = said[0]
    for more in said[1:]:
        postings = postings.unionByName(more)
    postings.repartitionByRange("source", "gram", "card").sortWithinPartitions("source", "gram", "card").write.mode("overwrite").partitionBy("source").parquet(f"{folder}/grams")


@dataclass
class SearchIndex:
    spark: SparkSession
    folder: str

    def cards(self, source: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/cards/{source}").drop("_card")

    def candidates(self, source: str, query: str) -> DataFrame:
        """The rows of a source that hold every three letters in a row of the query, in any of its columns: all rows
        that contain it, and few others, for the search itself to verify. A query of fewer letters is in all rows."""
        text = query.lower()
        wanted = sorted({text[i:i + GRAM] for i in range(len(text) - GRAM + 1)})
        cards = self.spark.read.parquet(f"{self.folder}/cards/{source}")
        if not wanted:
            return cards.drop("_card")
        postings = self.spark.read.schema("gram string, card bigint, source string").parquet(f"{self.folder}/grams")
        held = postings.where((F.col("source") == source) & F.col("gram").isin(wanted)).groupBy("card").agg(F.count("*").alias("n"))
        return cards.join(held.where(F.col("n") == len(wanted)), F.col("_card") == F.col("card"), "left_semi").drop("_card")
