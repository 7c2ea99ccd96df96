"""What a catalog is built of: snapshots, study deliveries, artefacts, and the digests that tie them together."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from tests import searchfiles
from veracat import schema as S
from veracat.operators.quality import GateRefused
from veracat.operators.snapshots import write_snapshot
from veracat.plans.catalog import build_catalog, open_catalog
from veracat.plans.choose import choose_artefacts, choose_snapshots, choose_studies
from veracat.plans.ingest import Search, ingest
from veracat.plans.study import write_study
from veracat.sources.digests import PART, file_digests


@pytest.fixture
def store(tmp_path):
    """Manifests of three datasets, one of them with two snapshots."""
    for dataset, bundle, when in (("A", "a1f0", "2024-01-01T00:00:00"), ("B", "b100", "2024-01-01T00:00:00"), ("B", "b200", "2024-02-01T00:00:00"), ("C", "c1", "2024-01-01T00:00:00")):
        folder = tmp_path / dataset / bundle
        folder.mkdir(parents=True)
        (folder / "bundle.json").write_text(json.dumps({"bundle_id": bundle, "dataset_id": dataset, "schema_version": S.SCHEMA_VERSION, "written_utc": when, "tables": {}}))
    return str(tmp_path)


def pairs(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_one_snapshot_a_dataset_is_chosen_or_refused(spark, store):
    open_ = choose_snapshots(spark, store)
    assert pairs(open_.chosen, "dataset_id", "bundle_id") == [("A", "a1f0"), ("C", "c1")]
    assert pairs(open_.refused, "dataset_id", "reason") == [("B", "2 snapshots and no pin")]
    with pytest.raises(GateRefused, match="B: 2 snapshots"):
        open_.manifests()
    newest = choose_snapshots(spark, store, latest=True)
    assert [m.split("/")[-2] for m in newest.manifests()] == ["a1f0", "b200", "c1"]
    assert pairs(choose_snapshots(spark, store, pins={"B": "b1"}).chosen, "bundle_id") == [("a1f0",), ("b100",), ("c1",)]
    assert pairs(choose_snapshots(spark, store, ["B"], pins={"B": "b"}).refused, "dataset_id", "reason") == [("B", "the pin matches 2 of 2 snapshots")]
    assert pairs(choose_snapshots(spark, store, ["A", "Z"]).refused, "dataset_id", "reason") == [("Z", "no snapshot")]
    held = choose_snapshots(spark, store, ["A", "C"], held={"C": "on hold: reprocessing"})
    assert pairs(held.chosen, "dataset_id") == [("A",)] and pairs(held.refused, "dataset_id", "reason") == [("C", "on hold: reprocessing")]
    assert pairs(choose_snapshots(spark, store, latest=True, held={"C": "hold"}).chosen, "dataset_id") == [("A",), ("B",)]


def test_a_release_names_every_snapshot(spark, store):
    with pytest.raises(ValueError, match="exact snapshots"):
        choose_snapshots(spark, store, release="2024.1", latest=True)
    assert pairs(choose_snapshots(spark, store, ["A", "B"], pins={"B": "b200"}, release="2024.1").refused, "dataset_id", "reason") == [("A", "a release needs a pin")]
    assert len(choose_snapshots(spark, store, ["A", "B"], pins={"A": "a", "B": "b200"}, release="2024.1").manifests()) == 2


AGES = "sample_id\tage_raw\tage_years\tage_source\nS1\t34Y\t34\tsheet\nS2\t>=60Y\t60\tsheet\n"
CURATED = "sample_id\tname\tvalue\tsource_reference\tcuration_version\nS1\ttissue\tnot available\tpaper\t1\nS2\ttissue\tliver\tpaper\t1\n"


def delivery(folder, **tables):
    out = {}
    for name, text in tables.items():
        (folder / f"{name}.tsv").write_text(text)
        out[name] = str(folder / f"{name}.tsv")
    return out


def test_a_study_delivery_is_written_once(spark, tmp_path):
    files = delivery(tmp_path, sample_ages=AGES, curated_sample_characteristics=CURATED)
    folder = write_study(spark, "aging", files, str(tmp_path / "store"), notes=["first cut"])
    ages = {r["sample_id"]: r["age_years"] for r in spark.read.parquet(f"{folder}/sample_ages.parquet").collect()}
    assert ages == {"S1": 34.0, "S2": 60.0}
    flags = {r["sample_id"]: r["value_reserved"] for r in spark.read.parquet(f"{folder}/curated_sample_characteristics.parquet").collect()}
    assert flags == {"S1": True, "S2": False}
    manifest = json.loads(open(f"{folder}/bundle.json").read())
    assert manifest["layer_version"] == S.STUDY_VERSIONS["aging"] and manifest["notes"] == [{"note": "first cut"}] and manifest["tables"] == {"sample_ages": 2, "curated_sample_characteristics": 2}
    assert write_study(spark, "aging", files, str(tmp_path / "store"), notes=["first cut"]) == folder
    assert write_study(spark, "aging", files, str(tmp_path / "store"), notes=["second cut"]) != folder


@pytest.mark.parametrize("text, message", [
    (AGES + "S1\t35Y\t35\tsheet\n", "sample_ages.sample_id"), (AGES.replace("34Y\t34", "34Y\told"), "age_years"), (AGES.replace("S1", ""), "required|sample_id"),
])
def test_a_wrong_delivery_is_refused(spark, tmp_path, text, message):
    with pytest.raises(GateRefused, match=message):
        write_study(spark, "aging", delivery(tmp_path, sample_ages=text), str(tmp_path / "store"))
    assert not (tmp_path / "store").exists() or not list((tmp_path / "store").rglob("bundle.json"))


def test_flags_and_columns_of_a_delivery(spark, tmp_path):
    wrong = CURATED.replace("value\tsource", "value\tvalue_reserved\tsource").replace("available\t", "available\tfalse\t").replace("liver\t", "liver\tfalse\t")
    with pytest.raises(GateRefused, match="value_reserved"):
        write_study(spark, "aging", delivery(tmp_path, curated_sample_characteristics=wrong), str(tmp_path / "store"))
    with pytest.raises(ValueError, match="unknown columns"):
        write_study(spark, "aging", delivery(tmp_path, sample_ages=AGES.replace("age_raw", "age_row")), str(tmp_path / "store"))
    with pytest.raises(ValueError, match="no table"):
        write_study(spark, "aging", {"psms": "x.tsv"}, str(tmp_path))
    with pytest.raises(ValueError, match="not carried"):
        write_study(spark, "sleep", {}, str(tmp_path))


def test_layers_are_loaded_only_when_asked_for(spark, tmp_path):
    store = str(tmp_path / "store")
    first = write_study(spark, "aging", delivery(tmp_path, sample_ages=AGES), store)
    assert choose_studies(spark, store) == []
    layer, bundle, path, counts = choose_studies(spark, store, latest=["aging"])[0]
    assert (layer, bundle) == ("aging", first.rsplit("/", 1)[1]) and counts == {"sample_ages": 2} and path.endswith(bundle)
    assert choose_studies(spark, store, pins={"aging": bundle[:6]})[0][1] == bundle
    with pytest.raises(ValueError, match="both"):
        choose_studies(spark, store, {"aging": bundle}, ["aging"])
    with pytest.raises(ValueError, match="exact"):
        choose_studies(spark, store, latest=["aging"], release="1")
    with pytest.raises(GateRefused, match="matches 0"):
        choose_studies(spark, store, {"aging": "zz"})
    manifest = json.loads(open(f"{first}/bundle.json").read()) | {"layer_version": "0.0.1"}
    open(f"{first}/bundle.json", "w").write(json.dumps(manifest))
    os.remove(f"{first}/.bundle.json.crc")  # of the manifest as it was
    with pytest.raises(GateRefused, match="version 0.0.1"):
        choose_studies(spark, store, latest=["aging"])


def test_from_search_to_genes(spark, tmp_path):
    """A real build: the chosen snapshot, the artefact of its database, a delivery, and genes through both."""
    paths = searchfiles.write(str(tmp_path / "files"))
    store = str(tmp_path / "store")
    fasta = next(p for p in paths["databases"] if p.endswith(".fasta"))
    sha = hashlib.sha256(open(fasta, "rb").read()).hexdigest()
    record = json.loads(open(paths["provenance"]).read())
    declared = [("fixed", "Common Fixed\tCarbamidomethyl on C")]
    s = Search("PX1", **paths, title="Small", organism="NCBITaxon:9606", expected_files=2, engine="Engine", engine_version="1", declared_lists=declared)

    # A database that is not the recorded one stops the ingest.
    for digest, fits in (("0" * 64, False), (sha, True)):
        open(paths["provenance"], "w").write(json.dumps(record | {"inputs": [{"path": "elsewhere/proteins.fasta", "sha256": digest}, {"path": "runA.raw", "sha256": "1"}]}))
        if fits:
            ingest(spark, s, store)
        else:
            with pytest.raises(GateRefused, match="not the database that was searched"):
                ingest(spark, s, store)

    genes = spark.createDataFrame([("AAA1", "resolved", 1, "ENSG1", "ONE", 0)], "accession string, outcome string, n_genes bigint, gene_id string, gene_symbol string, off_primary_genes bigint")
    full = genes.withColumns({"definition_id": F.lit("d"), "namespace": F.lit("uniprot"), "source": F.lit("s"), "search_database_sha256": F.lit(sha)})
    full = full.select(*[(F.col(f.name) if f.name in full.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in S.struct_type("gene_resolutions")])
    engine = S.ENGINE_TABLES["gene_resolutions"]
    write_snapshot(spark, {"gene_resolutions": full}, f"{store}/engine/{engine}", "g1", {"engine": engine, "search_database": sha})
    write_snapshot(spark, {"gene_resolutions": full}, f"{store}/engine/{engine}", "g0", {"engine": engine, "search_database": "ff"})
    delivered = write_study(spark, "aging", delivery(tmp_path, sample_ages=AGES.replace("S1", "PX1:S1").replace("S2", "PX1:runB")), store)

    manifests = choose_snapshots(spark, store).manifests()
    artefacts, coverage = choose_artefacts(spark, store, manifests)
    assert [(e, i) for e, i, *_ in artefacts] == [(engine, "g1")] and pairs(coverage, "ok", "observed", "expected") == [(True, 1, 1)]
    catalog = open_catalog(spark, build_catalog(spark, manifests, str(tmp_path / "catalogs"), studies=choose_studies(spark, store, latest=["aging"]), artefacts=artefacts, coverage=coverage))
    assert catalog["sample_ages"].count() == 2 and pairs(catalog["sample_ages"], "study_bundle_id")[0] == (delivered.rsplit("/", 1)[1],)
    assert {r["gene_id"] for r in catalog["protein_genes"].collect() if r["gene_id"]} == {"ENSG1"}
    assert pairs(catalog["catalog_checks"].filter("kind = 'engine-coverage'"), "observed", "expected") == [(1, 1)]

    other = {"gene_resolutions": full.withColumn("outcome", F.lit("guessed"))}
    write_snapshot(spark, other, f"{tmp_path}/odd/engine/{engine}", "g3", {"engine": engine, "search_database": sha})
    with pytest.raises(GateRefused, match="unknown outcome: 1"):
        choose_artefacts(spark, f"{tmp_path}/odd", manifests)
    write_snapshot(spark, {"gene_resolutions": full}, f"{store}/engine/{engine}", "g2", {"engine": engine, "search_database": sha})
    with pytest.raises(GateRefused, match="2 artefacts"):
        choose_artefacts(spark, store, manifests)


def test_digests_by_ranges(spark, tmp_path):
    data = bytes(range(256)) * 40
    (tmp_path / "a.bin").write_bytes(data)
    get = lambda **how: {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in file_digests(spark, f"{tmp_path}/*.bin", **how).collect()}
    plain = {"a.bin": hashlib.sha256(data).hexdigest()}
    assert get() == plain and get(part=1000, whole=True) == plain
    lines = "\n".join(hashlib.sha256(data[i:i + 1000]).hexdigest() for i in range(0, len(data), 1000))
    tree = "tree/1/1000:" + hashlib.sha256(f"tree/1/1000\n{lines}".encode()).hexdigest()
    assert get(part=1000) == plain | {"a.bin": tree}
    (tmp_path / "a.bin").write_bytes(data[:-1] + b"x")
    assert get(part=1000)["a.bin"] != tree


def test_a_file_larger_than_a_row_has_a_digest(spark, tmp_path):
    with open(tmp_path / "sparse.bin", "wb") as f:
        f.truncate(3 << 30)
    got = file_digests(spark, f"{tmp_path}/sparse.bin").first()
    assert got["size_bytes"] == 3 << 30 and got["sha256"].startswith(f"tree/1/{PART}:")
