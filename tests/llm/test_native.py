"""Mixing, quality ledger, decontamination and line dedup against their SQL, and on awkward input."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import clashing, prose
from veracat.llm import decontaminate, lines, mixing, quality
from veracat.llm.queries import QUERIES

NATIVE = [name for name, (_, sql) in QUERIES.items() if sql]


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


def by_sql(sql, docs, benchmark=()):
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.sql("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    for table, rows in (("documents", [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]), ("benchmark", benchmark)):
        if rows:
            con.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    out = con.sql(sql)
    return bag(out.columns, out.fetchall())


def by_spark(df):
    return bag(df.columns, [tuple(r) for r in df.collect()])


@pytest.mark.parametrize("name", NATIVE)
def test_query_matches_its_sql(spark, sf, name):
    run, sql = QUERIES[name]
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    want = con.sql(sql)
    assert by_spark(run(spark, sf)) == bag(want.columns, want.fetchall())


def mixed(docs):
    return mixing.mix_plan(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def test_mixing_of_odd_rows_and_none(odd, none):
    assert by_spark(mixed(clashing(odd))) == by_sql(mixing.SQL, odd)
    assert mixed(none).count() == 0 and mixing.mix(none).count() == 0


def test_mixing_stops_at_three_times_and_reshares(documents):
    docs = documents([(i, prose(i, 50), None, "a") for i in range(4)] + [(100 + i, prose(i, 50), None, "b") for i in range(200)] + [(900, prose(9, 400), None, None)])
    rows = mixed(docs).collect()
    targets = {r["source_size"]: r["target"] for r in rows}
    assert targets[200] == 600.0 and abs(sum(targets.values()) - 10600) < 1e-6
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert sorted(mixed(docs).collect()) == sorted(rows)
    out = mixing.mix(clashing(docs))
    assert out.columns == clashing(docs).columns and out.where("source = 'a'").count() == 12


def test_ledger_of_odd_rows_policies_and_ablations(odd, none):
    entries = quality.apply_policy(quality.stored_ledger(clashing(odd)), "v1")
    base = F.col("failures").bitwiseAND(F.lit(quality.mask("base")).cast("bigint")) != 0
    got = entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "n_lines", "policy", "failures")
    assert by_spark(got) == by_sql(quality.SQL, odd)
    assert quality.ledger(none).count() == 0
    failed = {r["rule"]: (r["failed"], r["only_this"]) for r in quality.ablations(entries, "v1").collect()}
    bits = [r["failures"] for r in entries.collect()]
    for rule, _ in quality.RULES:
        b = quality.bit(rule)
        assert failed[rule] == (sum(x & b > 0 for x in bits), sum(x & quality.mask("v1") == b for x in bits))


def test_decontamination_of_odd_rows_and_short_items(spark, odd, none, documents):
    long_, short = prose(50, 30), prose(51, 4)
    docs = odd.unionByName(documents([(20, f"{prose(60, 50)} {long_.upper()} {prose(61, 5)}"), (21, f"x {short}, y"), (22, " ".join(long_.split()[3:12])), (23, long_), (23, long_), (24, " ".join(long_.split()[5:15]))]))
    items = [(1, long_), (2, short), (3, None), (4, "..."), (None, long_), (5, prose(50, 30)), (6, short)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert by_spark(decontaminate.annotate(clashing(docs), bench)) == by_sql(decontaminate.SQL, docs, items)
    assert decontaminate.annotate(none, bench).count() == 0
    clean = decontaminate.decontaminate(clashing(docs), bench)
    assert clean.columns == clashing(docs).columns
    assert {r[0] for r in clean.select("doc_id").collect()} == {1, 2, 3, 4, 5, 6, 7, 8, -9, 22, None} and clean.count() == docs.count() - 5
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.annotate(odd, nothing).where("contaminated").count() == 0


def test_every_shared_window_has_a_shared_fingerprint(spark):
    rows = spark.createDataFrame([(prose(7, 40),)], "t string").select(F.split("t", " ").alias("w"))
    whole = set(rows.select(F.explode(decontaminate.winnow(F.col("w")))).toPandas()["col"])
    for start in range(31):
        part = rows.select(F.explode(decontaminate.winnow(F.slice("w", start + 1, 10)))).collect()
        assert part and all(r[0] in whole for r in part)


def test_line_dedup_of_odd_rows_and_runs(documents, odd, none):
    a, b, c, d = (prose(i, 8) for i in range(4))
    docs = odd.unionByName(documents([(30, "\n".join([a, b, c])), (31, "\n".join([d, a, "", b, c, d])), (32, "\n".join([b, c, a])), (33, "\n".join([a] * 7)), (34, f"{a}\n{d}"), (34, f"{a}\n{d}"), (35, "\n".join([a, b, c]))]))
    got = lines.dedup_lines(clashing(docs)).select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))
    assert by_spark(got) == by_sql(lines.SQL, docs)
    assert lines.dedup_lines(none).count() == 0


def test_line_dedup_leaves_texts_where_they_lie(documents, monkeypatch):
    """Rows of several tasks and blocks; only what is told about a block goes to its texts."""
    monkeypatch.setattr(lines, "BLOCK", 2)
    docs = documents([(i, "\n".join(prose(k % 11, 6) for k in range(i, i + i % 4))) for i in range(50)]).repartition(3)
    conf, name = docs.sparkSession.conf, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    first = conf.get(name, None)
    conf.unset(name)
    try:
        got = lines.dedup_lines(docs)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and plan.count("Exchange") == 1
    finally:
        if first is not None:
            conf.set(name, first)
    assert by_spark(got.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))) == by_sql(lines.SQL, docs)


def test_suffix_order_and_shared_prefixes(documents):
    import random

    draw = random.Random(3)
    texts = {i: [draw.choice("aaabbbcdefgh") * 3 for _ in range(draw.randint(1, 30))] for i in range(12)}
    texts[20] = texts[3]
    rows = documents([(i, "\n".join(t)) for i, t in texts.items()]).select("doc_id", F.col("doc_id").alias("doc"), "text")
    table = lines.line_table(rows)
    got = lines.neighbours(lines.suffix_array(table)).orderBy("rank").collect()
    suffix = [texts[r["doc"]][r["place"]:] for r in got]
    often = Counter(x for t in texts.values() for x in t)
    assert len(got) == sum(often[x] > 1 for t in texts.values() for x in t)

    def shared(x, y):
        return next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))

    assert [r["lcp"] for r in got] == [0, *(shared(x, y) for x, y in zip(suffix, suffix[1:]))]
