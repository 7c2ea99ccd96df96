"""Snapshots, unions and exports on the benchmark tables."""

from pyspark.sql import functions as F

from veracat.operators import export
from veracat.operators import snapshots as snap
from veracat.operators.quality import unique_key
from veracat.schema import empty_like as empty
from veracat.session import scratch_dir
from veracat.workload.registry import query


@query("""SELECT o_custkey, substr(sha256('build/1' || chr(10) || 'schema/2' || chr(10) || o_custkey || chr(10) || string_agg(o_orderpriority || chr(9) || sha256(o_orderstatus) || chr(10), '' ORDER BY o_orderpriority, o_orderkey)), 1, 16) AS snapshot_id FROM orders GROUP BY 1""")
def snapshot_id(t):
    """A customer's orders are the sources of its snapshot."""
    sources = t.orders.select("o_custkey", F.col("o_orderpriority").alias("role"), F.col("o_orderkey").alias("path"), F.sha2("o_orderstatus", 256).alias("sha256"))
    return snap.snapshot_id(sources, ["o_custkey"], ["build/1", "schema/2", F.col("o_custkey").cast("string")])


@query("""SELECT o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderstatus":' || CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '"' || o_orderstatus || '"' END || '}') AS sha256 FROM orders""")
def declaration_digest(t):
    rows = t.orders.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    return snap.declaration_digest(rows, ["o_orderkey"], ["o_orderstatus", "o_custkey"])


@query("""SELECT 'A' AS dataset_id, o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT 'B', o_orderkey, NULL FROM orders WHERE o_orderpriority = '2-HIGH'
UNION ALL SELECT 'C', o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority > '3'""")
def union_snapshots(t):
    part = lambda cond: t.orders.filter(cond).select(F.col("o_custkey").cast("string").alias("dataset_id"), "o_orderkey", "o_orderstatus")
    return snap.union_snapshots([
        (part("o_orderpriority = '1-URGENT'"), {"dataset_id": "A"}), (part("o_orderpriority = '2-HIGH'").drop("o_orderstatus"), {"dataset_id": "B"}),
        (part("o_orderpriority > '3'"), {"dataset_id": "C"})])


@query("SELECT dataset_id, form_id, n, unnest(members) AS member FROM members", lines=True)
def explode_members(t):
    return t.members.select("dataset_id", "form_id", "n", F.explode("members").alias("member"))


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def empty_like(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return empty(t.spark, rows.schema).unionByName(rows)


def _write(t, folder):
    tables = {"orders": t.orders.drop("o_orderdate"), "customer": t.customer, "nothing": t.orders.filter("o_orderkey IS NULL").drop("o_orderdate")}
    snap.write_snapshot(t.spark, tables, folder, "abc", {"dataset_id": "X", "written_utc": "2024"}, unique_key(t.orders, "orders", ["o_orderkey"], []), {"orders": ["o_custkey"]})


@query("SELECT 'orders' AS \"table\", count(*) AS written, count(*) AS held, false AS written_again FROM orders UNION ALL SELECT 'customer', count(*), count(*), false FROM customer")
def write_snapshot(t):
    folder = scratch_dir(t.spark, "store")
    _write(t, folder)
    again = snap.write_snapshot(t.spark, {}, folder, "abc", {})
    manifest = t.spark.read.schema("tables map<string,bigint>").json(f"{folder}/abc/bundle.json").select(F.explode("tables").alias("table", "written"))
    held = [t.spark.read.parquet(f"{folder}/abc/{n}.parquet").agg(F.count("*").alias("held")).withColumn("table", F.lit(n)) for n in ("orders", "customer")]
    return manifest.join(held[0].unionByName(held[1]), "table").withColumn("written_again", F.lit(again))


@query("SELECT 'X' AS dataset_id, 'abc' AS bundle_id, c_custkey, c_name FROM customer")
def read_snapshots(t):
    folder = scratch_dir(t.spark, "store")
    _write(t, folder)
    return snap.read_snapshots(t.spark, "customer", [("X", "abc", f"{folder}/abc")], t.customer.schema).select("dataset_id", "bundle_id", "c_custkey", "c_name")


_ENTRIES = """e AS (SELECT md5(c_name) AS k, '{"name":"' || c_name || '","segment":"' || c_mktsegment || '"}' AS d FROM customer), s AS (SELECT k, 36 + strlen(d) AS b FROM e),
sized AS (SELECT k, l, sum(b) OVER (PARTITION BY l, substr(k, 1, l)) AS total FROM s, (SELECT unnest(range(2, 9)) AS l)),
chosen AS (SELECT k, min(l) AS l FROM sized WHERE total + 2 <= 600 GROUP BY 1)"""


def _entries(t):
    return t.customer.select(F.md5("c_name").alias("k"), F.to_json(F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))).alias("d"))


@query(f"WITH {_ENTRIES} SELECT k, substr(k, 1, l) AS shard FROM chosen")
def assign_shards(t):
    return export.assign_shards(_entries(t), "k", "d", 600).select("k", "shard")


@query(f"WITH {_ENTRIES} SELECT substr(c.k, 1, c.l) AS shard, count(*) AS entries, CAST(sum(s.b) + 2 AS BIGINT) AS bytes FROM chosen c JOIN s ON s.k = c.k GROUP BY 1")
def write_sharded_json(t):
    folder = scratch_dir(t.spark, "shards")
    export.write_sharded_json(_entries(t), "k", "d", folder, 600)
    return t.spark.read.schema("shard string, entries bigint, bytes bigint").json(f"{folder}/index")


@query("SELECT DISTINCT upper(substr(s, 1, 1)) AS letter, upper(s) AS symbol, p_partkey FROM (SELECT CASE WHEN p_size % 7 = 0 THEN '(' || p_name WHEN p_size % 7 = 1 THEN '' ELSE p_name END AS s, p_partkey FROM part) WHERE s <> '' AND s NOT LIKE '(%' UNION ALL SELECT '_', upper('(' || p_name), p_partkey FROM part WHERE p_size % 7 = 0")
def symbol_index(t):
    r = F.col("p_size") % 7
    rows = t.part.select("p_partkey", F.when(r == 0, F.concat(F.lit("("), F.col("p_name"))).when(r == 1, F.lit("")).otherwise(F.col("p_name")).alias("s"))
    folder = scratch_dir(t.spark, "symbols")
    export.write_symbol_index(rows, "s", "p_partkey", folder)
    return t.spark.read.schema("letter string, symbol string, p_partkey bigint").json(folder)


# A folder for each status; every file describes itself, with its own rows and digest.
@query("""SELECT p.o_orderstatus AS part, c.column_name AS "column", CASE WHEN c.data_type IN ('BIGINT', 'INTEGER') THEN 'sc:Integer' WHEN c.data_type = 'DOUBLE' THEN 'sc:Float' ELSE 'sc:Text' END AS type, false AS repeated, p.n AS rows_of_part
FROM information_schema.columns c, (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1) p WHERE c.table_name = 'orders' AND c.column_name NOT IN ('o_orderdate', 'o_orderstatus')
UNION ALL SELECT o_orderstatus, 'tags', 'sc:Text', true, count(*) FROM orders GROUP BY 1""")
def column_catalog(t):
    folder = scratch_dir(t.spark, "files")
    rows = t.orders.drop("o_orderdate").withColumn("tags", F.array("o_orderpriority"))
    rows.repartition("o_orderstatus").write.partitionBy("o_orderstatus").parquet(folder)
    # One path a status, of which there are three.
    names = [r[0] for r in t.orders.select("o_orderstatus").distinct().orderBy("o_orderstatus").collect()]
    found = export.column_catalog(t.spark, [f"{folder}/o_orderstatus={n}" for n in names])
    part = F.regexp_extract("path", "o_orderstatus=([^/]*)", 1)
    counted = t.spark.read.parquet(folder).groupBy(F.col("o_orderstatus").alias("part")).agg(F.count("*").alias("rows_of_part"))
    told = found.filter("length(sha256) = 64 AND size_bytes > 0").select(part.alias("part"), "column", "type", "repeated").distinct()
    return told.join(counted, "part").select("part", "column", "type", "repeated", "rows_of_part")
