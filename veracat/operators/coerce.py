"""Bend rows into a table's declared types, and count what does not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracat.functions.cells import null_if_empty, strip
from veracat.schema import required

_TRUE_WORDS = ["true", "yes", "1", "y", "t"]


def _scalar(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(have, (T.DoubleType, T.FloatType)):
        c = F.when(~F.isnan(c), c)
    if not isinstance(have, T.StringType):
        if isinstance(want, T.StringType):
            return c.cast("string")
        return c if have == want else c.try_cast(want)
    text = F.when(strip(c) != "", c)
    if isinstance(want, T.BooleanType):
        return F.lower(strip(text)).isin(_TRUE_WORDS)
    if isinstance(want, T.LongType):
        return strip(text).try_cast("double").try_cast("bigint")
    if isinstance(want, T.DoubleType):
        value = strip(text).try_cast("double")
        return F.when(~F.isnan(value), value)
    if isinstance(want, T.DateType):
        return F.substr(strip(text), F.lit(1), F.lit(10)).try_cast("date")
    if isinstance(want, T.TimestampType):
        return strip(text).try_cast("timestamp")
    return text


def coerce_column(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """One column in its declared type: blank, NaN and the empty list are NULL, a number goes through
    a double and truncates, text without a zone is UTC (the session zone)."""
    if isinstance(want, T.ArrayType):
        if isinstance(have, T.StringType):
            c, have = F.when(c != "", F.array(c)), T.ArrayType(T.StringType())
        return null_if_empty(F.transform(c, lambda x: _scalar(x, have.elementType, want.elementType)))
    return _scalar(c, have, want)


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows in the schema's column order. A column the schema does not have is refused."""
    unknown = sorted(set(df.columns) - set(schema.fieldNames()))
    if unknown:
        raise ValueError(f"unknown columns {unknown}")
    have = {f.name: f.dataType for f in df.schema}
    return df.select(*[
        coerce_column(F.col(f"`{f.name}`"), have[f.name], f.dataType).alias(f.name)
        if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema
    ])


def coercion_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column, rule, n) over one pass: required columns that came out NULL, and non-blank text that
    is no number, date or timestamp."""
    have = {f.name: f.dataType for f in df.schema}
    must = set(required(schema))
    counts = []
    for f in schema:
        if f.name not in have:
            if f.name in must:
                counts.append((f.name, "required", F.count(F.lit(1))))
            continue
        c = F.col(f"`{f.name}`")
        out = coerce_column(c, have[f.name], f.dataType)
        malformed = F.lit(False)
        if isinstance(have[f.name], T.StringType) and not isinstance(
            f.dataType, (T.StringType, T.BooleanType, T.ArrayType)
        ):
            # "nan" is a number that is absent, not text that failed to parse.
            malformed = (strip(c) != "") & out.isNull() & (F.lower(strip(c)) != "nan")
            counts.append((f.name, "malformed", F.count_if(malformed)))
        if f.name in must:
            counts.append((f.name, "required", F.count_if(out.isNull() & ~F.coalesce(malformed, F.lit(False)))))
    if not counts:
        return df.sparkSession.createDataFrame([], "column string, rule string, n bigint")
    one = df.agg(*[n.alias(f"v{i}") for i, (_, _, n) in enumerate(counts)])
    rows = F.array(*[
        F.struct(F.lit(name).alias("column"), F.lit(rule).alias("rule"), F.col(f"v{i}").alias("n"))
        for i, (name, rule, _) in enumerate(counts)
    ])
    return one.select(F.explode(rows).alias("r")).select("r.*").filter("n > 0")
