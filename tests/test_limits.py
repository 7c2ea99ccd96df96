"""Inputs that the benchmark tables do not hold: depth, size, several files, absent columns."""

import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from veracat import session
from veracat.operators import export, figures, quant, search
from veracat.operators.notation import translate_notation
from veracat.sources import files


def test_brackets_of_any_depth(spark):
    registry = spark.createDataFrame([("Hydroxylation", ["K", "N"], 35, None, 1)], "name string, targets array<string>, unimod bigint, mass double, entry_order int")
    deep = "AC[K:" + "[" * 20 + "x" + "]" * 20 + " on C]D"
    got = {r["notation"]: (r["base_sequence"], r["unresolved"]) for r in translate_notation(spark.createDataFrame([(deep,), ("A[open[x]C",)], "n string"), "n", registry).collect()}
    assert got[deep] == ("ACD", [deep[3:-2]]) and got["A[open[x]C"][0] == "A"


def test_shards_are_json_objects_within_the_cap(spark, tmp_path):
    rows = spark.createDataFrame([(f"K{i:03d}", json.dumps({"v": "é" * (i % 40)}, ensure_ascii=False)) for i in range(300)], "k string, d string")
    index = {r["shard"]: r["bytes"] for r in export.write_sharded_json(rows, "k", "d", f"{tmp_path}/s", 600).collect()}
    found = {}
    for name in glob.glob(f"{tmp_path}/s/entries/*/*.txt"):
        shard = name.split("shard=")[1].split("/")[0]
        assert os.path.getsize(name) == index[shard] <= 600
        found |= json.load(open(name))
    assert found == {r["k"]: json.loads(r["d"]) for r in rows.collect()}
    with pytest.raises(Exception, match="has no shard"):
        export.assign_shards(rows.unionByName(spark.createDataFrame([(None, "{}")], "k string, d string")), "k", "d", 600).collect()


def test_a_shard_costs_no_process(spark, tmp_path):
    """Thousands of files of a few bytes, with names that Spark's readers understand."""
    rows = spark.createDataFrame([(f"{i:05d}", "x") for i in range(4_000)] + [("a/b=c %:[]^", "y"), ("é", "z")], "shard string, value string").repartition(4)
    begin = time.perf_counter()
    export.write_texts(rows, "shard", f"{tmp_path}/many")
    assert time.perf_counter() - begin < 20
    got = spark.read.option("basePath", f"{tmp_path}/many").schema("value string, shard string").text([f"{tmp_path}/many/{n}" for n in sorted(os.listdir(tmp_path / "many"))[-40:]])
    assert {tuple(r) for r in got.filter("value <> 'x'").select("shard", "value").collect()} == {("a/b=c %:[]^", "y"), ("é", "z")}
    assert len(glob.glob(f"{tmp_path}/many/*/part-*.txt")) == 4_002 and not glob.glob(f"{tmp_path}/many/*/.*")


def test_many_annotation_files_are_read_once_by_few_tasks(spark, tmp_path):
    """A file of a few lines costs no task, and none is opened again by what looks at its lines."""
    def text(i):
        head = "#!fmt 2" if i == 3 else "#!other x\n#!fmt 1" if i == 4 else "#!fmt 1\n#!fmt 1" if i == 5 else "#!fmt 1"
        return f"{head}\n{'a b' if i == 6 else 'a\tb'}\nx{i}\ty" + ("\tz\n\nonly" if i == 7 else "")

    rows = spark.createDataFrame([(f"{i:03d}", text(i)) for i in range(300)], "part string, value string").repartition(4)
    export.write_texts(rows, "part", f"{tmp_path}/files")
    before = {k: spark.conf.get(k, None) for k in session.MANY_FILES}
    header, cells, problems = files.read_headered_annotation(spark, f"{tmp_path}/files/*", ["a", "b"], "fmt", "1")
    assert before == {k: spark.conf.get(k, None) for k in session.MANY_FILES}
    for df in (header, cells, problems):
        assert df.inputFiles() and len(df.inputFiles()) < 100 and not any(f"{tmp_path}/files" in f for f in df.inputFiles())
    told = sorted((r["file"].split("part=")[1][:3], r["problem"]) for r in problems.collect())
    assert told == [("003", "unknown format version"), ("004", "wrong first key"), ("005", "header key twice: fmt"), ("006", "wrong columns"), ("007", "wrong cell count"), ("007", "wrong cell count")]
    assert sorted((r["a"], r["b"]) for r in cells.select("a", "b").collect() if r["a"] != "only") == sorted((f"x{i}", "y") for i in range(300))


def test_modification_lists_of_a_folder_keep_every_entry(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"{i}.txt").write_text(f"ID   A{i}\nTG   K\nMM   1.5\n//\nID   B{i}\nTG   N\n//\n")
    assert {r["name"] for r in files.read_modification_list(spark, [str(tmp_path)]).collect()} == {"A0", "A1", "B0", "B1"}


def test_protein_xml_is_read_by_many_tasks(spark, tmp_path):
    head = '<?xml version="1.0"?>\n<!-- <entry><accession>no</accession> -->\n<uniprot xmlns="http://uniprot.org/uniprot"><entry/><entry a="b"/>\n'
    entry = '<entry dataset="x"\n a=">"><accession> P{0} </accession><accession>Q</accession><comment><sequence>NO</sequence></comment><!-- c --><sequence length="3">ac\n d&amp;{1}</sequence></entry>\n'
    rows = [(f"P{i}", "ACD&" + "K" * (i % 90)) for i in range(3_000)]
    body = "".join(entry.format(k[1:], v[4:].lower()) for k, v in rows)
    tail = '<entry><accession>none</accession></entry><entry><accession>é</accession><sequence><![CDATA[é<e]]></sequence></entry><entryset/></uniprot>'
    (tmp_path / "a.xml").write_text(head + body + tail, encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = files.read_protein_xml(spark, f"{tmp_path}/a.xml")
        assert got.rdd.getNumPartitions() > 20
        assert sorted(map(tuple, got.collect())) == sorted([*rows, ("é", "É<E")])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32m")
    # An end of an entry that is none.
    (tmp_path / "b.xml").write_text("<u><entry><accession>A</accession><!-- </entry> --><sequence>K</sequence></entry></u>")
    want = spark.read.format("xml").option("rowTag", "entry").schema("accession array<string>, sequence string").load(f"{tmp_path}/b.xml").selectExpr("accession[0]", "sequence").filter("accession[0] IS NOT NULL AND sequence IS NOT NULL").collect()
    assert list(map(tuple, files.read_protein_xml(spark, f"{tmp_path}/b.xml").collect())) == list(map(tuple, want))


def test_counts_are_added_as_whole_numbers(spark):
    big = spark.createDataFrame([("a", 2**53), ("b", 1)], "dataset_id string, n bigint")
    row = figures.headline_sums(big, {"total": "n"}, big, "n").first()
    assert row["total"] == row["reported"] == 2**53 + 1


def test_melts_without_a_column_are_empty(spark):
    df = spark.createDataFrame([("x",)], "id string")
    assert quant.melt_measures(df, ["id"], {"Intensity": False}).count() == 0
    assert quant.melt_with_detection(df, ["id"]).columns == ["id", "run", "value", "detection_type"]


def test_digests_name_every_input(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "a").write_text("1")
    (tmp_path / "one").write_text("2")
    inputs = [("matches", str(folder)), ("groups", str(tmp_path / "one")), ("peaks", "/too/large")]
    digests = lambda: {r["role"]: r["sha256"] for r in files.role_digests(spark, inputs, {"/too/large": "x"}).collect()}
    before = digests()
    (folder / "b").write_text("3")
    after = digests()
    assert set(before) == {"matches", "groups", "peaks"} and after["matches"] != before["matches"] and after["groups"] == before["groups"] and after["peaks"] == "x"
    assert spark.range(1).select(F.sha2(F.lit("2"), 256)).first()[0] == before["groups"]


def test_documents_hold_every_finding(spark):
    one = spark.createDataFrame([("D1",)], "dataset_id string")
    findings = spark.createDataFrame([("D1", f"c{i % 3}", ["error", "info"][i % 2], f"m{i:04d}", "open") for i in range(1_500)] * 2, "dataset_id string, code string, severity string, message string, status string")
    mods = spark.createDataFrame([("D1", f"n{i}", "U", 5) for i in range(1_200)], "dataset_id string, modification_name string, modification string, n_sites int")
    values = spark.createDataFrame([("D1", f"v{i}", 1.0, "d") for i in range(1_100)], "dataset_id string, name string, value double, definition_id string")
    got = figures.dataset_documents(one, one, one, findings, mods, values).collect()[0]
    assert (len(got["findings"]), len(got["modifications"]), len(got["metrics"])) == (1_500, 1_200, 1_100)
    assert [f["severity"] for f in got["findings"]] == ["error"] * 750 + ["info"] * 750 and {f["n"] for f in got["findings"]} == {2}


def test_a_sample_search_lists_every_value(spark):
    samples = spark.createDataFrame([("D1", f"tissue {i % 90:02d}") for i in range(200)] + [("D1", None), ("D2", "tissue")], "dataset_id string, tissue string")
    got = {r["dataset_id"]: r for r in search.search_sample(samples, samples.selectExpr("tissue AS name", "tissue AS value"), "Tissue", ["tissue"])[0].collect()}
    assert got["D1"]["tissues"] == [f"tissue {i:02d}" for i in range(90)] and got["D1"]["n_samples"] == 200 and got["D2"]["tissues"] == ["tissue"]


def test_shuffles_start_from_many_small_partitions(spark):
    """What a task holds is bounded by a size that is named, not by the input over Spark's default of partitions."""
    from veracat.session import configure

    configure(spark)
    conf = {k: spark.conf.get(f"spark.sql.adaptive.{k}", None) for k in ("coalescePartitions.initialPartitionNum", "advisoryPartitionSizeInBytes")}
    assert conf == {"coalescePartitions.initialPartitionNum": "2000", "advisoryPartitionSizeInBytes": "16m"}
