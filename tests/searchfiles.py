"""A small search of our own making, as producer files."""

import hashlib
import json
import os

MATCH_HEADER = [
    "File Name", "Scan Number", "Precursor Charge", "Precursor MZ", "Score", "Notch", "Base Sequence", "Full Sequence", "Ambiguity Level", "Missed Cleavages",
    "Mass Diff (ppm)", "Accession", "Gene Name", "Organism Name", "Start and End Residues In Full Sequence", "Previous Residue", "Decoy/Contaminant/Target",
    "QValue", "QValue Notch", "PEP", "PEP_QValue",
]

# Proteins: AAA1 MKTAYCLER..., BBB2 holds the shared peptide later, CON1 is a contaminant panel entry.
FASTA = ">sp|AAA1|ONE_X first\nMSAYCLER\nGGKTAYC\n>sp|BBB2|TWO_X second\nMMSAYCLERSAYCLERK\n"
CONTAMINANTS = "<?xml version=\"1.0\"?>\n<uniprot xmlns=\"http://uniprot.org/uniprot\"><entry><accession>CON1</accession><accession>ZZZ</accession><sequence length=\"9\">MDEFGHKLR\n AAA</sequence></entry></uniprot>\n"

MODS = "Some preamble\nID   Carbamidomethyl on C\nTG   C\nPP   Anywhere.\nDR   Unimod; 4.\n//\nID   Acetylation\nTG   X\nDR   Unimod; 1.\n//\nID   Heavy\nTG   K or R\nMM   10.5\n"


def match(file, scan, full, base, acc, span, label="T", q="0.001", notch="0", prev="-", gene="G1", organism="Homo sapiens", level="1", qn="0.002"):
    return [file, scan, "2.0", "500.5", "10", notch, base, full, level, "0", "1.5", acc, gene, organism, span, prev, label, q, qn, "0.1", "0.2"]


MATCHES = [
    match("runA-calib", "10", "SAYC[Common Fixed:Carbamidomethyl on C]LER", "SAYCLER", "AAA1|BBB2", "[2 to 8]|[3 to 9]", gene="primary:ONE, synonym:UNO|TWO"),
    match("runA-calib", "10", "SAYC[Common Fixed:Carbamidomethyl on C]LER", "SAYCLER", "AAA1|BBB2", "[2 to 8]|[3 to 9]", q="0.005", level="2A", gene="ONE|TWO"),
    match("runB", "11", "[Protein:Acetylation on X]SAYCLER", "SAYCLER", "AAA1", "[2 to 8]", prev="M", notch="0|1"),
    match("runB", "12", "MDEFGHK[Odd:Unheard on K]LR", "MDEFGHKLR", "CON1", "[1 to 9]", label="C", organism="Bos taurus", gene=""),
    match("runB", "13", "RELCYAS", "RELCYAS", "DECOY_AAA1", "[1 to 7]", label="D", q="0.009"),
    match("runB-averaged-calib", "14", "GGKTAYC", "GGKTAYC", "AAA1", "[9 to 15]", q="0.5"),
]

GROUP_HEADER = [
    "Protein Accession", "Gene", "Number of Peptides", "Number of Unique Peptides", "Sequence Coverage Fraction", "SpectralCount_runA-calib", "Intensity_runA-calib",
    "CountOccupancy_runA-calib", "IntensityOccupancy_runA-calib", "SpectralCount_runB", "Intensity_runB", "CountOccupancy_runB", "IntensityOccupancy_runB",
    "Protein Decoy/Contaminant/Target", "Protein QValue",
]
COUNT = "pos5[Carbamidomethyl on C,info:fraction=0.67(2/3)]|pos6[Carbamidomethyl on C,info:fraction=1.00(2/2)]"
INTENSITY = "pos5[Carbamidomethyl on C,info:fraction=0.0000(0/4000)]"
GROUPS = [
    ["AAA1|BBB2", "ONE|TWO", "3", "1", "0.5|0.4", "2", "1000", COUNT, INTENSITY, "0", "0", "", "", "T", "0"],
    ["AAA1|BBB2", "ONE|TWO", "3", "1", "0.5|0.4", "2", "1000", COUNT, INTENSITY, "0", "0", "", "", "T", "0"],
    ["CON1", "", "1", "1", "0.9", "1", "500", "Output too long for Excel", "", "1", "0", "", "", "C", "0.002"],
    ["DECOY_AAA1", "", "1", "1", "0.1", "1", "", "pos1[Carbamidomethyl on C,info:fraction=1(1/1)]", "", "0", "", "", "", "D", "0.02"],
]
PEPTIDE_HEADER = ["Sequence", "Base Sequence", "Intensity_runA-calib", "Intensity_runB", "Detection Type_runA-calib", "Detection Type_runB"]
PEPTIDES = [["SAYC[Common Fixed:Carbamidomethyl on C]LER", "SAYCLER", "100", "0", "MSMS", "NotDetected"], ["MDEFGHK[Odd:Unheard on K]LR", "MDEFGHKLR", "", "7", "", "MBR"]]
PEAK_HEADER = ["File Name", "Full Sequence", "PIP Q-Value"]
PEAKS = [["runB", "MDEFGHK[Odd:Unheard on K]LR", "0.02"], ["runB", "MDEFGHK[Odd:Unheard on K]LR", "0.004"], ["runA-calib", "SAYC[Common Fixed:Carbamidomethyl on C]LER", ""]]
REPORT = "Engine 1\n\nAll target PSMs with q-value <= 0.01: 2\nAll target peptides with q-value <= 0.01: 4\nAll target protein groups with q-value <= 0.01 (1% FDR): 2\nAll MS2 Scans: 30\nrunA-calib - MS2 Scans: 20\n"
SHEET = "source name\tcharacteristics[organism]\tcharacteristics[organism part]\tcomment[label]\tcomment[instrument]\tcomment[data file]\n" \
        "S1\tNT=Homo sapiens;AC=NCBITaxon:9606\tnot available\tNT=label free sample\tNT=Q Exactive Plus;AC=MS:1\trunA.raw\n" \
        "S2\tHomo sapiens\tBlood serum\tlabel free\tQ Exactive Plus\trunZ.raw\n"


def tsv(path, header, rows):
    with open(path, "w") as f:
        for row in [header, *rows]:
            f.write("\t".join(row) + "\n")


def write(folder):
    """Write the files and return their paths by role."""
    os.makedirs(folder, exist_ok=True)
    p = lambda name: os.path.join(folder, name)
    tsv(p("matches.tsv"), MATCH_HEADER, MATCHES)
    tsv(p("groups.tsv"), GROUP_HEADER, GROUPS)
    tsv(p("peptides_quant.tsv"), PEPTIDE_HEADER, PEPTIDES)
    tsv(p("peaks.tsv"), PEAK_HEADER, PEAKS)
    for name, text in (("report.txt", REPORT), ("sheet.tsv", SHEET), ("proteins.fasta", FASTA), ("contaminants.xml", CONTAMINANTS), ("mods.txt", MODS)):
        with open(p(name), "w") as f:
            f.write(text)
    # What earlier stages recorded; of the second the search recorded another file.
    stages = {name: json.dumps({"schema": "aging-provenance/3", "stage": stage, "started_utc": "2023-12-31T00:00:00+00:00"}) for name, stage in (("fetched.json", "fetch"), ("converted.json", "convert"))}
    for name, text in stages.items():
        with open(p(name), "w") as f:
            f.write(text)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    docs = {
        "fetch.json": {"files": [{"name": "runA.raw", "sha256": "a", "pride_checksum": "x", "category": "RAW"}, {"name": "runB.raw", "sha256": "b", "category": "RAW"}, {"name": "notes.txt", "category": "OTHER"}]},
        "qc.json": {"runA.raw": {"pass": True, "ms2": 20, "run_minutes": 90.0, "ms2_analyzer_dissociation": {"Trap/HCD": 20}}, "runB.raw": {"pass": True, "ms2": 10, "run_minutes": 60.0},
                    "blank.raw": {"pass": False, "ms2": 1}},
        "provenance.json": {"schema": "aging-provenance/3", "stage": "search", "started_utc": "2024-01-01T00:00:00+00:00", "pipeline": {"repo": "r", "commit": "c"}, "id_rate": {"psms_1pct": 2, "ms2": 30, "rate": 0.1}, "tools": {"Engine": {"release": "9.9"}}, "params": {"tasks": ["a", "b"]},
                            "mbr": {"mbr_rows": 12, "mbr_fdr_threshold": 0.01}, "resources": {"wall_s": 7.5},
                            "inputs": [{"path": "t/Search.toml", "sha256": "0"}, {"path": "db/proteins.fasta", "sha256": sha(FASTA)},
                                       {"path": p("fetched.json"), "sha256": sha(stages["fetched.json"])}, {"path": p("converted.json"), "sha256": "2"}], "flags": ["low_id_rate: few", "odd thing: detail"],
                            "excluded_files": {"files": ["blank.raw"], "reason": "too_few_ms2"}},
    }
    for name, doc in docs.items():
        with open(p(name), "w") as f:
            json.dump(doc, f)
    return {
        "matches": p("matches.tsv"), "groups": p("groups.tsv"), "peptide_quant": p("peptides_quant.tsv"), "peaks": p("peaks.tsv"), "report": p("report.txt"), "sheet": p("sheet.tsv"),
        "fetch": p("fetch.json"), "qc": p("qc.json"), "provenance": p("provenance.json"), "databases": [p("proteins.fasta"), p("contaminants.xml")], "modification_lists": [p("mods.txt")],
        "upstream": [p(name) for name in stages],
    }
