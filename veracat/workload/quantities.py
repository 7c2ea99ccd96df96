"""Quantities on the benchmark tables."""

from pyspark.sql import functions as F

from veracat.operators import quant
from veracat.workload.registry import query, text

_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
_K = ", ".join(_KEYS)


def _wide(lineitem):
    s = lambda c: F.col(c).cast("string")
    return lineitem.select(*_KEYS, "l_returnflag", s("l_discount").alias("Intensity_r1"), s("l_tax").alias("Intensity_r2"), s("l_quantity").alias("SpectralCount_r1"),
                             F.when(F.col("l_returnflag") == "A", F.lit("")).otherwise(s("l_tax")).alias("SpectralCount_r2"))


@query(f"""SELECT {_K}, run, measure, value FROM (
SELECT {_K}, 'r1' AS run, 'Intensity' AS measure, nullif(l_discount, 0.0) AS value FROM lineitem UNION ALL SELECT {_K}, 'r2', 'Intensity', nullif(l_tax, 0.0) FROM lineitem
UNION ALL SELECT {_K}, 'r1', 'SpectralCount', l_quantity FROM lineitem UNION ALL SELECT {_K}, 'r2', 'SpectralCount', CASE WHEN l_returnflag <> 'A' THEN l_tax END FROM lineitem) WHERE value IS NOT NULL""")
def melt_measures(t):
    return quant.melt_measures(_wide(t.lineitem), _KEYS, {"Intensity": False, "SpectralCount": True})


@query(f"""SELECT {_K}, run, value, detection_type FROM (SELECT {_K}, 'r1' AS run, nullif(l_discount, 0.0) AS value, CASE l_returnflag WHEN 'A' THEN 'MSMS' WHEN 'N' THEN 'MBR' ELSE 'not_detected' END AS detection_type FROM lineitem
UNION ALL SELECT {_K}, 'r2', nullif(l_tax, 0.0), NULL FROM lineitem) WHERE value IS NOT NULL""")
def melt_with_detection(t):
    flag = F.col("l_returnflag")
    label = F.when(flag == "A", F.lit("MSMS")).when(flag == "N", F.lit("MBR")).otherwise(F.lit("NotDetected"))
    wide = _wide(t.lineitem).withColumn("Detection Type_r1", label).drop("l_returnflag")
    return quant.melt_with_detection(wide, _KEYS)


@query("""SELECT l_suppkey, l_partkey, min(q) AS pip_q_value, min(q) <= 0.01 AS mbr_kept FROM (SELECT *, CASE WHEN l_returnflag <> 'A' THEN l_discount END AS q FROM lineitem) GROUP BY ALL""")
def best_quality(t):
    rows = t.lineitem.select("l_suppkey", "l_partkey", F.when(F.col("l_returnflag") == "A", F.lit("x")).otherwise(F.col("l_discount").cast("string")).alias("q"))
    return quant.best_quality(rows, ["l_suppkey", "l_partkey"], "q", 0.01)


@query(f"""SELECT {_K}, x.q AS pip_q_value, x.q <= 0.01 AS mbr_kept FROM lineitem LEFT JOIN (SELECT l_suppkey AS s, l_partkey AS p, min(l_discount) AS q FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL) x ON x.s = l_suppkey AND x.p = l_partkey""")
def attach_quality(t):
    best = quant.best_quality(t.lineitem.filter("l_returnflag = 'N'"), ["l_suppkey", "l_partkey"], "l_discount", 0.01)
    return quant.attach_quality(t.lineitem.select(*_KEYS), best, ["l_suppkey", "l_partkey"])


@query("""SELECT 'X:s' || l_suppkey || ':label_free' AS assay_id, 'peptidoform' AS feature_type, 'X:P' || l_partkey AS feature_id, l_discount AS value, CAST(NULL AS VARCHAR) AS detection_type,
l_tax AS pip_q_value, l_tax <= 0.01 AS mbr_kept, 'def' AS definition_id FROM lineitem WHERE l_discount <> 0""")
def quant_rows(t):
    rows = t.lineitem.filter("l_discount <> 0").select("l_suppkey", "l_partkey", F.col("l_discount").alias("value"), F.col("l_tax").alias("pip_q_value"), (F.col("l_tax") <= 0.01).alias("mbr_kept"))
    return quant.quant_rows(rows, F.lit("X"), text("s", "l_suppkey"), "peptidoform", text("X:P", "l_partkey"), F.lit("def"))
