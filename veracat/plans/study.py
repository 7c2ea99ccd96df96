"""Take in one delivery of a study layer: read, check, refuse or write."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracat import schema as S
from veracat.functions.cells import reserved_word, strip
from veracat.operators.coerce import coerce, coercion_violations
from veracat.operators.quality import CHECK_COLUMNS, checked, reserved_flag_conflicts, undeclared_definitions, union_all, unique_rule
from veracat.operators.snapshots import declaration_digest, path_exists, snapshot_id, write_snapshot
from veracat.session import materialise
from veracat.sources.files import read_delivery, role_digests

# Fixed: which flag tells that which value is a reserved word.
RESERVED_FLAGS = {"curated_sample_characteristics": {"value_reserved": "value"}}


def _found(bad: DataFrame, name: str, kind: str, example: str) -> DataFrame:
    seen = bad.agg(F.count("*").alias("observed"), F.min(F.col(example).cast("string")).alias("e"))
    return seen.filter("observed > 0").select(F.lit(name).alias("name"), F.lit(kind).alias("kind"), F.lit(False).alias("ok"), "observed", F.lit(0).cast("bigint").alias("expected"), F.concat(F.lit("e.g. "), "e").alias("detail"))


def delivery_checks(spark: SparkSession, delivered: Mapping[str, DataFrame], definitions: Sequence[str] = ()) -> DataFrame:
    """What refuses a delivery: required cells without a value, text that is no number, repeated keys, reserved-word flags
    that disagree with their value, and definitions that it does not declare (where it declares any)."""
    declared = spark.createDataFrame([(d,) for d in definitions], "definition_id string")
    out = [spark.createDataFrame([], CHECK_COLUMNS)]
    for name, raw in delivered.items():
        kind = S.struct_type(name)
        out.append(coercion_violations(with_flags(name, raw), kind).select(
            F.concat(F.lit(f"{name}."), "column").alias("name"), F.col("rule").alias("kind"), F.lit(False).alias("ok"), F.col("n").alias("observed"), F.lit(0).cast("bigint").alias("expected"), F.lit(None).cast("string").alias("detail")))
        for flag, value in RESERVED_FLAGS.get(name, {}).items():
            if flag in raw.columns:
                out.append(_found(reserved_flag_conflicts(raw, flag, value), f"{name}.{flag}", "reserved-flag", value))
        if "definition_id" in raw.columns:
            out.append(_found(undeclared_definitions(raw, "definition_id", declared, "definition_id"), f"{name}.definition_id", "undeclared-definition", "definition_id"))
    rules = [unique_rule(name, S.STUDY_KEYS[name], [], "study-unique") for name in delivered if name in S.STUDY_KEYS]
    if rules:
        out.append(checked({name: coerce(df, S.struct_type(name)) for name, df in delivered.items()}, rules))
    return union_all(out)


def with_flags(name: str, df: DataFrame) -> DataFrame:
    """Reserved-word flags as their values say; a blank value leaves its flag alone."""
    for flag, value in RESERVED_FLAGS.get(name, {}).items():
        given = F.col(flag).try_cast("boolean") if flag in df.columns else F.lit(None).cast("boolean")
        df = df.withColumn(flag, F.when(strip(value) != "", reserved_word(value)).otherwise(given))
    return df


def write_study(spark: SparkSession, layer: str, tables: Mapping[str, str], store: str, definitions: Sequence[str] = (), notes: Sequence[str] = ()) -> str:
    """Write the delivered files of ``tables`` as a snapshot of the layer and return its folder. The same files and
    declaration give the same folder, which is not written again; a delivery that fails a check is not written."""
    if layer not in S.STUDY_VERSIONS:
        raise ValueError(f"study layer {layer} is not carried; layers are {', '.join(S.STUDY_VERSIONS)}")
    if unknown := sorted(set(tables) - set(S.STUDY_COLUMNS)):
        raise ValueError(f"{layer} has no table {', '.join(unknown)}")
    stated = spark.createDataFrame([(layer, json.dumps(sorted(definitions)), json.dumps(list(notes)))], "layer string, definitions string, notes string")
    content = declaration_digest(stated, ["layer"], ["definitions", "notes"]).select(F.lit("declaration").alias("role"), F.lit("").alias("path"), "sha256")
    sources = role_digests(spark, [(f"table:{n}", p) for n, p in sorted(tables.items())]).unionByName(content)
    version = S.STUDY_VERSIONS[layer]
    identity = snapshot_id(sources.withColumn("layer", F.lit(layer)), ["layer"], ["study/1", f"schema/{S.SCHEMA_VERSION}", f"study/{layer}/{version}"], order=["role"]).first()["snapshot_id"]
    folder = f"{store}/study/{layer}"
    if path_exists(spark, f"{folder}/{identity}/bundle.json"):
        return f"{folder}/{identity}"
    delivered = {n: read_delivery(spark, p, S.struct_type(n)) for n, p in tables.items()}
    checks = delivery_checks(spark, delivered, definitions)
    typed = {n: materialise(with_flags(n, coerce(df, S.struct_type(n))), n) for n, df in delivered.items()}
    now = spark.sql("SELECT date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss\") AS t").first()["t"]
    told = spark.createDataFrame([(n,) for n in notes], "note string")
    write_snapshot(spark, typed, folder, identity, {"layer": layer, "layer_version": version, "written_utc": now}, checks, lists={"sources": sources.select("role", "path", "sha256"), "notes": told})
    return f"{folder}/{identity}"
