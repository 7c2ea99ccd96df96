"""Wide quantity tables to long rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracat.functions.cells import first_alternative, lenient_float, measured, number, verbatim
from veracat.functions.rules import detection_type


def wide_columns(df: DataFrame, prefix: str) -> dict[str, str]:
    """{run: column} for every ``<prefix>_<run>`` column."""
    lead = prefix + "_"
    return {c[len(lead):]: c for c in df.columns if c.startswith(lead)}


def melt_measures(df: DataFrame, ids: Sequence[str], families: Mapping[str, bool], run: str = "run",
                  measure: str = "measure", value: str = "value") -> DataFrame:
    """One row per (ids, run, measure). ``families`` maps a column prefix to whether zero is a value:
    where it is not, a zero is no row. The table is scanned once for all families."""
    cells = []
    for prefix, zero_is_value in families.items():
        for name, column in wide_columns(df, prefix).items():
            c = F.col(f"`{column}`").cast("string")
            cells.append(F.struct(F.lit(name).alias("r"), F.lit(prefix).alias("m"),
                                  (number(c) if zero_is_value else measured(c)).alias("v")))
    # Without a column of any family there are no cells, and so no rows.
    listed = F.array(*cells) if cells else F.array().cast("array<struct<r:string,m:string,v:double>>")
    long = df.select(*ids, F.explode(listed).alias("_c"))
    return long.filter("_c.v IS NOT NULL").select(
        *ids, F.col("_c.r").alias(run), F.col("_c.m").alias(measure), F.col("_c.v").alias(value)
    )


def melt_with_detection(df: DataFrame, ids: Sequence[str], value_prefix: str = "Intensity", detection_prefix: str = "Detection Type") -> DataFrame:
    """One row per (ids, run): a measured value beside the detection label of the same run."""
    labels = wide_columns(df, detection_prefix)
    cells = [
        F.struct(F.lit(name).alias("r"), measured(F.col(f"`{column}`")).alias("v"),
                 (detection_type(F.col(f"`{labels[name]}`")) if name in labels else F.lit(None).cast("string")).alias("d"))
        for name, column in wide_columns(df, value_prefix).items()
    ]
    listed = F.array(*cells) if cells else F.array().cast("array<struct<r:string,v:double,d:string>>")
    long = df.select(*ids, F.explode(listed).alias("_c")).filter("_c.v IS NOT NULL")
    return long.select(*ids, F.col("_c.r").alias("run"), F.col("_c.v").alias("value"), F.col("_c.d").alias("detection_type"))


def best_quality(df: DataFrame, keys: Sequence[str], q: str, threshold: float) -> DataFrame:
    """Lowest q per key with whether it passes. A key none of whose rows has a q stays, with NULL."""
    best = df.groupBy(*keys).agg(F.min(lenient_float(F.col(q).cast("string"))).alias("pip_q_value"))
    return best.withColumn("mbr_kept", F.col("pip_q_value") <= threshold)


def attach_quality(rows: DataFrame, quality: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(quality, list(keys), "left")


def quant_rows(rows: DataFrame, dataset_id: Column, run: Column, feature_type: str, feature_id: Column, definition: Column) -> DataFrame:
    """The quantity table's shape; columns a family does not have are NULL."""
    def own(name: str, kind: str) -> Column:
        return (F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(name)

    return rows.select(
        F.concat(dataset_id, F.lit(":"), run, F.lit(":label_free")).alias("assay_id"), F.lit(feature_type).alias("feature_type"),
        feature_id.alias("feature_id"), "value", own("detection_type", "string"), own("pip_q_value", "double"),
        own("mbr_kept", "boolean"), definition.alias("definition_id"),
    )


def peptide_notation(df: DataFrame) -> Column:
    """The notation of a peptide quantity row: its sequence, else its base sequence."""
    return first_alternative(F.coalesce(verbatim("Sequence"), verbatim("`Base Sequence`"), F.lit("")))
