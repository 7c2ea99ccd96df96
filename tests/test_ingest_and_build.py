"""One search of our own making, from files to a catalog that answers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tests import searchfiles
from veracat.operators import search
from veracat.plans.answer import search_catalog
from veracat.plans.catalog import build_catalog, open_catalog
from veracat.plans.publish import publish
from veracat.plans.ingest import Search, ingest


@pytest.fixture(scope="module")
def snapshot(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("instance")
    paths = searchfiles.write(str(root / "files"))
    s = Search("PX1", **paths, title="Small", organism="NCBITaxon:9606", expected_files=2, engine="Engine", engine_version="1", notes=["first of its kind"],
               declared_lists=[("fixed", "Common Fixed\tCarbamidomethyl on C"), ("variable", "A\tAcetylation on X\t\tB\tNever seen on S")])
    return ingest(spark, s, str(root / "store")), s, str(root)


def rows(spark, folder, name):
    return [r.asDict() for r in spark.read.parquet(f"{folder}/{name}.parquet").collect()]


def test_matches(spark, snapshot):
    got = {r["psm_id"]: r for r in rows(spark, snapshot[0], "psms")}
    assert set(got) == {"PX1:runA:10:1", "PX1:runA:10:2", "PX1:runB:11:1", "PX1:runB:12:1", "PX1:runB:13:1", "PX1:runB:14:1"}
    first = got["PX1:runA:10:1"]
    assert first["usi"] == "mzspec:PX1:runA:scan:10:SAYC[UNIMOD:4]LER/2"
    assert first["q_value"] == 0.001 and got["PX1:runA:10:2"]["q_value"] == 0.005
    assert got["PX1:runB:11:1"]["notch_ambiguous"] is True
    assert got["PX1:runB:12:1"]["peptidoform"] == "MDEFGHK[Info:Unheard on K]LR"


def test_sites_are_placed_by_sequence(spark, snapshot):
    got = {r["ptm_site_id"]: r for r in rows(spark, snapshot[0], "ptm_sites")}
    assert got["PX1:AAA1:C5:Carbamidomethyl on C"]["n_psms"] == 2
    assert {"PX1:BBB2:C6:Carbamidomethyl on C", "PX1:BBB2:C13:Carbamidomethyl on C"} <= set(got)
    # Residue 2 behind the excised M is the protein's N-terminus.
    assert "PX1:AAA1:S2:Acetylation on X@protein_n_term" in got
    assert got["PX1:CON1:K7:Unheard on K"]["target_decoy"] == "contaminant"
    assert got["PX1:AAA1:C5:Carbamidomethyl on C"]["best_ambiguity_level"] == "1"


def test_proteins(spark, snapshot):
    got = {r["protein_accession"]: r for r in rows(spark, snapshot[0], "proteins")}
    assert got["AAA1"]["gene"] == "ONE" and got["AAA1"]["organism"] == "NCBITaxon:9606"
    assert got["CON1"]["is_contaminant"] and got["CON1"]["organism"] is None and got["CON1"]["organism_name"] == "Bos taurus"
    assert got["DECOY_AAA1"]["source_db"] == "decoy" and got["DECOY_AAA1"]["organism_name"] is None
    # A collapsed species cell holds for both members of its row.
    assert got["BBB2"]["organism_name"] == "Homo sapiens"


def test_zero_is_absence_only_for_intensities(spark, snapshot):
    q = rows(spark, snapshot[0], "quant_values")
    key = {(r["assay_id"], r["feature_id"], r["definition_id"]): r for r in q}
    assert key[("PX1:runB:label_free", "PX1:AAA1;BBB2", "QuantProject:DEF-PROT-SPC")]["value"] == 0.0
    assert ("PX1:runB:label_free", "PX1:AAA1;BBB2", "QuantProject:DEF-PROT-INT") not in key
    pep = key[("PX1:runB:label_free", "PX1:MDEFGHK[Info:Unheard on K]LR", "QuantProject:DEF-PEP-INT")]
    assert (pep["value"], pep["detection_type"], pep["pip_q_value"], pep["mbr_kept"]) == (7.0, "MBR", 0.004, True)


def test_occupancy(spark, snapshot):
    got = {r["ptm_site_id"]: r for r in rows(spark, snapshot[0], "ptm_stoichiometry")}
    a, b = got["PX1:AAA1:C5:Carbamidomethyl on C"], got["PX1:BBB2:C6:Carbamidomethyl on C"]
    # The one intensity segment fits AAA1 alone, so it is stored there, as a measured zero.
    assert a["occupancy_state"] == "floor" and a["n_modified_psms"] == 2 and a["n_covering_psms"] == 3
    assert b["occupancy_state"] == "count_only" and b["count_is_ceiling"]


def test_findings_and_reconciliation(spark, snapshot):
    got = {r["code"]: r for r in rows(spark, snapshot[0], "findings")}
    assert {"low_id_rate", "odd thing", "excluded_from_search", "unresolved_modifications", "sdrf_partial", "collapsed_duplicate_rows",
            "occupancy_decoy_groups", "occupancy_cells_truncated", "upstream_provenance_changed"} <= set(got)
    assert got["occupancy_cells_truncated"]["severity"] == "error" and got["occupancy_cells_truncated"]["message"].startswith("1 ")
    assert got["upstream_provenance_changed"]["finding_id"].endswith("convert") and "converted.json" in got["upstream_provenance_changed"]["message"]
    # Four accepted peptides are claimed; the match file holds fewer.
    assert "count_mismatch" in got
    assert not any(r["finding_id"].endswith("count_mismatch:psms") for r in rows(spark, snapshot[0], "findings"))


def test_runs_and_samples(spark, snapshot):
    runs = {r["run_id"]: r for r in rows(spark, snapshot[0], "runs")}
    assert set(runs) == {"PX1:runA", "PX1:runB"} and runs["PX1:runA"]["fragmentation"] == ["HCD"]
    samples = {r["sample_id"]: r for r in rows(spark, snapshot[0], "samples")}
    assert set(samples) == {"PX1:S1", "PX1:runB"}
    assert runs["PX1:runA"]["instrument_model"] == "Q Exactive Plus"
    assert rows(spark, snapshot[0], "datasets")[0]["instrument_vendor"] == "Thermo"


def test_declared_modifications(spark, snapshot):
    got = {r["name"]: r for r in rows(spark, snapshot[0], "search_modifications_declared")}
    assert got["Carbamidomethyl on C"]["modification"] == "UNIMOD:4"
    assert got["Acetylation on X"]["modification"] == "UNIMOD:1"
    assert got["Never seen on S"]["modification"] is None and got["Never seen on S"]["residues"] == "S"


def test_provenance_and_metrics(spark, snapshot):
    records = {r["stage"]: r for r in rows(spark, snapshot[0], "provenance_records")}
    assert set(records) == {"search", "fetch"}  # the changed file is no record of its stage
    record = records["search"]
    assert (record["stage"], record["pipeline_commit"], record["wall_seconds"]) == ("search", "c", 7.5)
    assert record["params_json"] == '{"tasks": ["a", "b"]}' and len(record["original_sha256"]) == 64
    metrics = {(r["scope"], r["name"], r["source"]): (r["value"], r["definition_id"]) for r in rows(spark, snapshot[0], "metrics")}
    assert metrics[("dataset", "psms_1pct", "id_rate.psms_1pct")] == (2.0, "aging:DEF-PSM-1PCT")
    assert metrics[("dataset", "mbr_rows", "mbr")] == (12.0, "QuantProject:DEF-QC-MBR")
    assert metrics[("run", "ms2_scans", "report")] == (20.0, "aging:DEF-MS2")
    versions = {r["definition_id"]: r["version"] for r in rows(spark, snapshot[0], "definitions")}
    assert versions["pep:DEF-PEP"] == "Engine 9.9; regime not recorded" and "aging:DEF-PRECURSORS" not in versions
    assert rows(spark, snapshot[0], "datasets")[0]["search_engine_version"] == "9.9"
    assert rows(spark, snapshot[0], "datasets")[0]["search_database"] == "proteins.fasta"


def test_the_manifest_says_what_it_was_made_of(snapshot):
    manifest = json.loads(open(f"{snapshot[0]}/bundle.json").read())
    assert manifest["notes"] == [{"note": "first of its kind"}]
    assert {d["path"].rsplit("/", 1)[1]: d["entries"] for d in manifest["databases"]}["proteins.fasta"] > 0
    assert {"matches", "database", "upstream", "declaration"} <= {x["role"] for x in manifest["sources"]}


def test_second_ingest_is_a_no_op(spark, snapshot):
    folder, s, root = snapshot
    before = os.path.getmtime(f"{folder}/bundle.json")
    assert ingest(spark, s, f"{root}/store") == folder
    assert os.path.getmtime(f"{folder}/bundle.json") == before


def test_build_and_answer(spark, snapshot):
    folder, _, root = snapshot
    catalog = open_catalog(spark, build_catalog(spark, [f"{folder}/bundle.json"], f"{root}/catalogs"))
    overview = catalog["dataset_overview"].first()
    assert (overview["n_psms_all"], overview["n_psms_1pct"], overview["n_runs"], overview["n_protein_groups_1pct"]) == (6, 2, 2, 2)
    index = {r["protein_accession"]: r for r in catalog["protein_index"].collect()}
    assert index["AAA1"]["n_datasets_1pct"] == 1 and index["DECOY_AAA1"]["dataset_ids_1pct"] is None
    assert catalog["age_effects"].count() == 0  # present and empty
    tables = {r["table_name"]: r for r in catalog["catalog_tables"].collect()}
    assert tables["psms"]["rows"] == 6 and tables["protein_index"]["kind"] == "derived" and tables["age_effects"]["kind"] == "study"
    assert catalog["catalog_checks"].filter("NOT ok").count() == 0
    hits = search.search_entity(catalog["protein_index"], "one", "protein_accession", "gene", "n_datasets_1pct")
    assert [r["protein_accession"] for r in hits.collect()] == ["AAA1"]
    answer = search.disclose_sources(search.bounded_answer(catalog["psms"].select("psm_id", "pep"), rows=3), {"psms": (catalog["psms"], ["pep"]), "age_effects": (catalog["age_effects"], ["beta"])})
    assert answer.truncated_by == "rows" and len(answer.rows) == 3
    assert answer.empty_sources == ["age_effects"] and answer.run_relative_columns == ["pep"]
    # The stored index gives the rows that the table gives, and no base table is read for them.
    for text in ("one", "AAA1", "a", "nothing like it"):
        kept = lambda df: sorted(map(tuple, search.search_entity(df, text, "protein_accession", "gene", "n_datasets_1pct").select("protein_accession", "gene", "n_datasets").collect()))  # noqa: B023, E731
        assert kept(catalog.rows("protein_index", text)) == kept(catalog["protein_index"])
    files = catalog.rows("protein_index", "AAA1").inputFiles()
    assert files and all("/search/" in f for f in files)
    found = search_catalog(catalog, "aaa1")
    assert [h["protein_accession"] for h in found.hits["protein"]][:1] == ["AAA1"] and found.datasets == ["PX1"] and "protein_annotations" in found.empty_sources
    peptide = catalog["peptide_index"].first()["base_sequence"]
    assert search_catalog(catalog, peptide).hits["peptide"][0]["base_sequence"] == peptide and search_catalog(catalog, "carbamido").hits["modification"]
    many = search_catalog(catalog, "PX1", ["run"], limit=1)
    assert many.cut == ["run"] and len(many.hits["run"]) == 1 and [x["source"] for x in many.searched] == ["runs"]
    with pytest.raises(ValueError, match="kind"):
        search_catalog(catalog, "x", ["gene"])
    shards = publish(catalog, f"{root}/site", cap=2_000)
    assert shards["datasets"] == 1 and shards["proteins"] >= 1
    told = [json.loads(line) for line in open(f"{root}/site/figures.json")]
    assert {t["figure"] for t in told} >= {"spread", "findings", "totals"} and json.loads(next(t["rows"][0] for t in told if t["figure"] == "totals"))["datasets"] == 1
    text = [r["value"] for r in spark.read.text(f"{root}/site/datasets/entries").select("value").collect()]
    assert json.loads(text[0])["PX1"]["title"] == "Small" and json.loads(text[0])["PX1"]["findings"]
    assert "AAA1" in json.loads(spark.read.text(f"{root}/site/proteins/entries").filter("value LIKE '%AAA1%'").first()["value"])
    assert {r["column"] for r in spark.read.json(f"{root}/site/files").filter("path LIKE '%/psms/%'").collect()} >= {"psm_id", "run_id"}
    # The same snapshots give the same folder, and it is not built again.
    assert build_catalog(spark, [f"{folder}/bundle.json"], f"{root}/catalogs") == catalog.path
    assert catalog["samples"].filter(F.col("organism_part_name").isNotNull()).count() == 0
