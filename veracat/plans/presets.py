"""Column bindings and fixed values of one family of search outputs."""

from __future__ import annotations

# Fixed format: the match file's columns by the role they play.
MATCH_COLUMNS = {
    "file": ["File Name"],
    "scan": ["Scan Number"],
    "full_sequence": ["Full Sequence"],
    "charge": ["Precursor Charge"],
    "mz": ["Precursor MZ"],
    "retention_time": ["Scan Retention Time"],
    "score": ["Score"],
    "delta_score": ["Delta Score"],
    "q_value": ["QValue"],
    "q_value_notch": ["QValue Notch"],
    "notch": ["Notch"],
    "pep": ["PEP"],
    "pep_q_value": ["PEP_QValue"],
    "mass_diff_ppm": ["Mass Diff (ppm)"],
    "label": ["Decoy/Contaminant/Target"],
    "accession": ["Accession", "Protein Accession"],
    "ambiguity_level": ["Ambiguity Level"],
    "missed_cleavages": ["Missed Cleavages"],
    "ranges": ["Start and End Residues In Full Sequence"],
    "previous": ["Previous Residue", "Previous Amino Acid"],
    "gene": ["Gene Name"],
    "organism_name": ["Organism Name"],
}

GROUP_COLUMNS = {
    "accession": "Protein Accession",
    "gene": "Gene",
    "label": "Protein Decoy/Contaminant/Target",
    "q_value": "Protein QValue",
    "coverage": "Sequence Coverage Fraction",
    "n_peptides": "Number of Peptides",
    "n_unique": "Number of Unique Peptides",
}

# Definition, version and owner of every stored number, with what it counts.
DEFINITIONS = [
    ("aging:DEF-PSM-1PCT", "v1", "aging", "Target matches accepted on both q-values with one notch."),
    ("aging:DEF-PSM-NOTCH-AMBIGUOUS", "v1", "aging", "A match whose notch cell holds more than one hypothesis."),
    ("aging:DEF-PSM-FDRENGINE", "v1", "aging", "Matches within the threshold as the error-rate engine logs them."),
    ("aging:DEF-ID-RATE", "v1", "aging", "Identified share of the fragment spectra."),
    ("QuantProject:DEF-QC-MBR", "v1", "QuantProject", "Transfers between runs and how many pass the threshold."),
    ("QuantProject:DEF-PEP-INT", "v1", "QuantProject", "Peptide intensity in one run."),
    ("QuantProject:DEF-PROT-INT", "v1 as corrected by v3.3", "QuantProject", "Protein group intensity in one run."),
    ("QuantProject:DEF-PROT-SPC", "v3.5", "QuantProject", "Spectral count of a protein group in one run; zero is a value."),
    ("QuantProject:DEF-OCC-CELL", "v3.2", "QuantProject", "Modified share at a site in one run."),
    ("aging:DEF-PEPTIDE-1PCT", "v1", "aging", "Accepted target peptides."),
    ("aging:DEF-PROTEINGROUP-1PCT", "v1", "aging", "Accepted protein groups, contaminants included."),
    ("aging:DEF-MS2", "v1", "aging", "Fragment spectra."),
    ("aging:DEF-RUN-MINUTES", "v1", "aging", "Length of a run in minutes."),
    ("aging:DEF-PRECURSORS", "v1", "aging", "Precursors of the fragment spectra."),
    ("aging:DEF-CONTAM-PSM", "v1", "aging", "Contaminant share of the accepted matches."),
    ("QuantProject:DEF-QC-9", "v2", "QuantProject", "Contaminant share of the intensity of one file."),
    ("pep:DEF-PEP", "v1", "pep", "Error probability from a model trained on this search alone."),
]

# Fixed values: (metric, provenance layout or None for any, definition, where it is read).
PROVENANCE_METRICS = [
    ("psms_1pct", 3, "aging:DEF-PSM-1PCT", "id_rate.psms_1pct"),
    ("psms_fdr_engine_1pct", 3, "aging:DEF-PSM-FDRENGINE", "id_rate.psms_fdr_engine_1pct"),
    ("psms_fdr_engine_1pct", 2, "aging:DEF-PSM-FDRENGINE", "id_rate.psms_1pct"),
    ("ms2", None, "aging:DEF-MS2", "id_rate.ms2"),
    ("id_rate", None, "aging:DEF-ID-RATE", "id_rate.rate"),
    ("mbr_rows", None, "QuantProject:DEF-QC-MBR", "mbr"),
    ("mbr_kept", None, "QuantProject:DEF-QC-MBR", "mbr"),
    ("msms_peaks", None, "QuantProject:DEF-QC-MBR", "mbr"),
    ("kept_over_msms", None, "QuantProject:DEF-QC-MBR", "mbr"),
    ("mbr_fdr_threshold", None, "QuantProject:DEF-QC-MBR", "mbr"),
]
LAYOUTS = {"aging-provenance/2": 2, "aging-provenance/3": 3}

REPORT_METRICS = {
    "psms": ("psms_1pct", "aging:DEF-PSM-1PCT"),
    "peptides": ("peptides", "aging:DEF-PEPTIDE-1PCT"),
    "protein_groups": ("protein_groups", "aging:DEF-PROTEINGROUP-1PCT"),
    "ms2_scans": ("ms2_scans", "aging:DEF-MS2"),
    "precursors": ("precursors", "aging:DEF-PRECURSORS"),
}

PROVENANCE_SCHEMA = (
    "schema string, stage string, started_utc string, finished_utc string, pipeline struct<repo:string,commit:string>, "
    "params_file struct<sha256:string>, params string, tools string, resources string, "
    "inputs array<struct<path:string,sha256:string>>, flags array<string>, "
    "id_rate struct<psms_1pct:double,psms_fdr_engine_1pct:double,ms2:double,rate:double>, "
    "mbr struct<mbr_rows:double,mbr_kept:double,msms_peaks:double,kept_over_msms:double,mbr_fdr_threshold:double>, "
    "excluded_files struct<files:array<string>,reason:string>, "
    "contamination struct<psm_share:double,contaminant_psms:double,target_plus_contaminant_psms:double,"
    "intensity_share_per_file:map<string,double>,intensity_share_median:double,intensity_share_min:double,intensity_share_max:double>"
)
FETCH_SCHEMA = "files array<struct<name:string,pride_checksum:string,sha256:string,category:string>>"
QC_VALUE = "struct<pass:boolean,ms2:bigint,run_minutes:double,ms2_analyzer_dissociation:map<string,bigint>>"

ANNOTATION_CHARACTERISTICS = [
    "characteristics[organism part]", "characteristics[cell type]", "characteristics[disease]", "characteristics[individual]",
]
