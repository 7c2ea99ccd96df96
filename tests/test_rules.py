"""Single rules on hand-made inputs."""

import itertools
import random
import re
import time
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracat.functions import cells, rules
from veracat.operators import filters, ordering, pieces, quality, quant, samples, sites
from veracat.operators import identification as ident
from veracat.operators import search
from veracat.operators.coerce import coerce, coercion_violations
from veracat.operators.notation import lookup_with_preference, translate_notation
from veracat.operators.snapshots import declaration_digest, latest_snapshot, snapshot_id
from veracat.schema import parse_columns
from veracat.sources import files


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def values(df, *cols):
    return [tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()]


def one(spark, expr, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()] or [F.lit(1).alias("_")])
    return df.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("cell,nt,ac", [
    ("NT=heart;AC=U:1", "heart", "U:1"), ("plain", "plain", None), ("NT=a;NT=b", "b", None), ("bare;AC=X", "bare", "X"),
    ("ac = y ; z", "z", "y"), ("", "", None), ("NT=a;tail", "a", None), ("a;b;AC=1", "a", "1"),
])
def test_cell_values(spark, cell, nt, ac):
    m = one(spark, cells.parse_key_value_cell("c"), c=cell)
    assert (m.get("NT"), m.get("AC")) == (nt, ac)
    assert one(spark, cells.cell_value("c", "NT"), c=cell) == nt
    assert one(spark, cells.cell_value("c", "AC"), c=cell) == ac


def test_alignment_is_never_guessed(spark):
    aligned = lambda text, n: one(spark, cells.align_list("c", F.lit(n)), c=text)
    assert aligned("a|b", 2) == ["a", "b"]
    assert aligned("a", 3) == ["a", "a", "a"]
    assert aligned("a|b", 3) == [None, None, None]
    assert aligned("a|", 2) == ["a", None]


def test_stems_and_suffixes(spark):
    assert one(spark, cells.file_stem("c"), c="/x/run.a.raw") == "run.a"
    assert one(spark, cells.file_stem("c"), c=".hidden") == ".hidden"
    assert one(spark, cells.strip_run_suffixes("c"), c="r-calib-averaged-calibrated") == "r"
    assert one(spark, cells.strip_run_suffixes("c"), c="r-calib.x") == "r-calib.x"
    assert one(spark, cells.delete_extensions("c"), c="X.raw.thermo.RAW") == "X.thermo"


def test_occurrences_match_brute_force(spark):
    rng = random.Random(5)
    pairs = [("".join(rng.choice("AB") for _ in range(rng.randint(1, 3))), "".join(rng.choice("ABé") for _ in range(rng.randint(0, 14)))) for _ in range(300)]
    pairs += [(".", "a.b."), ("\\E", "x\\Ey"), ("", "abc"), ("aa", "aaaa")]
    pairs += [(None, "abc"), ("abc", None), ("a" * 50, "a" * 70)]
    named = [(p, s, f"A{i}") for i, (p, s) in enumerate(pairs)] + [("aa", None, None)]
    # A sequence of its own for each, and for one of them a second that shares some of its places.
    known = [(a, s) for p, s, a in named if s is not None] + [("A0", "B"), ("A0", named[0][1] + "AB")]
    placed = sites.place_peptides(frame(spark, named, "p string, s string, a string"), "p", "a", frame(spark, known, "accession string, sequence string"))
    got = Counter(values(placed, "accession", "piece", "start", "previous", "length", "reason"))
    want = Counter()
    for p, _, a in named:
        own = [s for x, s in known if x == a]
        places = {(i + 1, s[i - 1] if i else "", len(s)) for s in own for i in range(len(s)) if p and s.startswith(p, i)}
        want.update([(a, p, *x, None) for x in places] or [(a, p, None, None, None, "peptide_not_in_sequence" if own else "no_sequence")])
    assert got == want
    told = {(r["accession"], r["piece"]): (r["n_places"], r["reason"]) for r in sites.count_places(frame(spark, named, "p string, s string, a string"), "p", "a", frame(spark, known, "accession string, sequence string")).collect()}
    rows = Counter()
    for a, p, start, *_, reason in got.elements():
        rows[a, p, reason] += start is not None
    assert told == {(a, p): (n, reason) for (a, p, reason), n in rows.items()}


def test_pieces_of_one_text_are_looked_up_together(spark):
    """Lengths around a seed, long pieces, astral letters, repeated pairs and groups that cross Arrow batches."""
    rng = random.Random(8)
    texts = {f"T{i}": "".join(rng.choice("abé𝄞 ") for _ in range(rng.choice([0, 2, 3, 60, 400]))) for i in range(30)} | {"long": "ab" * 150 + "c" + "ab" * 80, "x": "none"}
    asked = [(t[i:i + n], a) for a, t in texts.items() for n in (1, 2, 3, 4, 7, 95, 96, 97, 98, 99, 100, 130, 161) for i in range(0, max(0, len(t) - n + 1), 9)]
    asked += [("ab" * 60 + "b", "long"), ("b" + "ab" * 79, "long"), ("zz", "x"), ("", "x"), (None, "x"), ("a", None)] * 2
    rows = frame(spark, asked, "p string, a string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 13)
    try:
        found = pieces.find_pieces(rows, "p", "a", frame(spark, list(texts.items()), "accession string, sequence string")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {(r["piece"], r["accession"]): (r["known"], r["length"], r["starts"], r["before"]) for r in found}
    want = {}
    for p, a in asked:
        t = texts.get(a)
        at = [i for i in range(len(t)) if t.startswith(p, i)] if t and p else []
        want[p, a] = (True, len(t), [i + 1 for i in at], "".join(t[max(i - 1, 0)] for i in at)) if at else (t is not None, None, None, None)
    assert got == want and len(found) == len(want)
    lists = rows.groupBy("a").agg(F.collect_list("p").alias("ps")).filter("a IS NOT NULL")
    as_lists = pieces.find_pieces(lists.unionAll(lists), "ps", "a", frame(spark, list(texts.items()), "accession string, sequence string")).collect()
    assert {(r["piece"], r["accession"]): (r["known"], r["length"], r["starts"], r["before"]) for r in as_lists} == {k: v for k, v in want.items() if None not in k}
    assert len(as_lists) == sum(None not in k for k in want)
    # Work for each text is arrays, not a call for each piece.
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(30_000))
    words = pa.array(text.split(" "))
    begin = time.perf_counter()
    n = sum(len(held) for held, *_ in pieces.places([pieces.Seeds(text)], words.unique()))
    assert n == len(set(text.split(" "))) and time.perf_counter() - begin < 0.9


def test_a_text_of_many_pieces_goes_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(pieces, "PIECES", 7)
    rows = [(f"{i:02d}", "A") for i in range(100)] + [("01", "B")]
    text = "".join(f"{i:02d}" for i in range(100))
    got = {(r["accession"], r["piece"]): r["starts"] for r in pieces.find_pieces(frame(spark, rows, "p string, a string"), "p", "a", frame(spark, [("A", text)], "accession string, sequence string")).collect()}
    assert got == {(a, p): [i + 1 for i in range(200) if text.startswith(p, i)] if a == "A" else None for p, a in rows}


def test_unique_assignment_matches_brute_force(spark):
    rng = random.Random(7)
    cases = []
    for _ in range(1500):
        n, k = rng.randint(1, 6), rng.randint(1, 6)
        cases.append((n, [sorted(rng.sample(range(n), rng.randint(0, n))) for _ in range(k)]))
    got = values(frame(spark, cases, "n int, fits array<array<int>>").select("n", "fits", sites.unique_assignment(F.col("fits"), F.col("n")).alias("x")), "n", "fits", "x")
    for n, fits, x in got:
        valid = [c for c in itertools.combinations(range(n), len(fits)) if all(m in f for m, f in zip(c, fits))]
        assert x == (list(valid[0]) if len(valid) == 1 else None), (n, fits)


def test_assignment_is_decided_at_any_size(spark):
    # 12 segments among 24 members are millions of choices, of which one fits.
    fits = [[i] for i in range(12)]
    df = frame(spark, [(24, fits), (12, fits)], "n int, fits array<array<int>>")
    got = dict(values(df.select("n", sites.unique_assignment(F.col("fits"), F.col("n")).alias("x")), "n", "x"))
    assert got[24] == list(range(12)) == got[12]


REGISTRY = [("Hydroxylation", ["K", "N"], 35, None, 1), ("Hydroxylation", ["P"], 36, None, 2), ("Odd", ["K"], None, 12.5, 3), ("Full on K", ["K"], 7, None, 4)]


def registry(spark):
    return frame(spark, REGISTRY, "name string, targets array<string>, unimod bigint, mass double, entry_order int")


@pytest.mark.parametrize("notation,proforma,base,unresolved", [
    ("PEPTIDE", "PEPTIDE", "PEPTIDE", []),
    ("AK[Common:Hydroxylation on K]P[Common:Hydroxylation on P]", "AK[UNIMOD:35]P[UNIMOD:36]", "AKP", []),
    ("[U:Full on K]AK", "[UNIMOD:7]-AK", "AK", []),
    ("AK[X:Odd on K|X:Full on K]", "AK[+12.500000][UNIMOD:7]", "AK", []),
    ("AL-[X:Nobody on L]", "AL-[Info:Nobody on L]", "AL", ["X:Nobody on L"]),
    ("A-K", "A-K", "A-K", []),
    ("AK[X:Odd[2] on K]C", "AK[Info:Odd[2] on K]C", "AKC", ["X:Odd[2] on K"]),
    ("[X:Nobody on K][X:Full on K]K", "[Info:Nobody on K][UNIMOD:7]-K", "K", ["X:Nobody on K"]),
])
def test_translation(spark, notation, proforma, base, unresolved):
    r = translate_notation(frame(spark, [(notation,), (notation,)], "s string"), "s", registry(spark)).collect()
    assert len(r) == 1
    assert (r[0]["proforma"], r[0]["base_sequence"], r[0]["unresolved"] or []) == (proforma, base, unresolved)


def test_lookup_prefers_target_then_accession(spark):
    rows = [("H", ["A"], None, 1.0, 1), ("H", ["B"], 5, None, 2), ("H", ["C"], None, 3.0, 3)]
    reg = frame(spark, rows, "name string, targets array<string>, unimod bigint, mass double, entry_order int")
    got = {(n, r): (u, m) for n, r, u, m in values(lookup_with_preference(frame(spark, [("H", "C"), ("H", "Z"), ("h on A", None), ("none", "A")], "name string, residue string"), reg), "name", "residue", "unimod", "mass")}
    assert got == {("H", "C"): (None, 3.0), ("H", "Z"): (5, None), ("h on A", None): (None, 1.0)}


def test_names_resolve_by_priority(spark):
    known = frame(spark, [("runA",), ("X.raw.thermo",), ("dup.raw.z",), ("dup.z",)], "name string")
    reported = frame(spark, [("RUNA-calib",), ("X.thermo",), ("dup.z",), ("gone",), ("gone",)], "r string")
    got = dict(values(ident.name_map(reported, "r", known, "name"), "reported", "resolved"))
    assert got == {"RUNA-calib": "runA", "X.thermo": "X.raw.thermo", "dup.z": "dup.z", "gone": None}
    assert values(ident.unmatched_names(reported, "r", known, "name"), "reported", "uses") == [("gone", 2)]


def test_all_rules_read_every_table_once(spark, tmp_path):
    frame(spark, [("d", 1, "x", ["1", "9"]), ("d", 2, "y", ["2"]), ("d", 2, None, None), ("e", None, "x", [])], "dataset_id string, id int, kind string, refs array<string>").write.parquet(f"{tmp_path}/child")
    frame(spark, [("d", "1"), ("d", "2"), ("e", "9")], "dataset_id string, pid string").write.parquet(f"{tmp_path}/parent")
    tables = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("child", "parent")}
    rules = [
        quality.unique_rule("child", ["id"]), quality.unique_rule("child", ["id", "kind"]), quality.nullsafe_rule("child", ["kind"], "kind"), quality.unique_rule("parent", ["pid"], []),
        quality.reference_rule("child", "refs[]", "parent", "pid"), quality.reference_rule("child", "id", "parent", "pid", []), quality.typed_rule("child", "kind", "dataset_id", {"x": ("parent", "dataset_id")}, []),
    ]
    found = quality.checked(tables, rules)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    got = {r["name"]: (r["kind"], r["ok"], r["observed"], r["detail"]) for r in found.collect()}
    assert got == {
        "child.id": ("unique", False, 1, "e.g. 2"), "child (id, kind)": ("unique", True, 0, None), "child.kind": ("engine-unique", False, 1, "e.g. x"), "parent.pid": ("unique", True, 0, None),
        "child.refs[] -> parent.pid": ("reference", False, 1, "e.g. 9"), "child.id -> parent.pid": ("reference", True, 0, None),
        "child.dataset_id -> parent.dataset_id": ("reference", True, 0, None), "child.kind y": ("reference", False, None, "names no table"),
    }
    assert quality.checked({n: df.limit(0) for n, df in tables.items()}, rules[:6]).filter("ok AND observed = 0").count() == 6


def test_ranks_and_running_sums_over_ranges(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 2).alias("k"), ((F.col("id") * 7919) % 5000).alias("o"))
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("o")).cast("bigint"))
    got = ident.occurrence_rank(df, ["k"], "o", "r")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    summed = ordering.running_sum(df, ["k"], ["o"], F.col("o"), "s")
    want = df.withColumn("s", F.sum("o").over(Window.partitionBy("k").orderBy("o")))
    assert summed.exceptAll(want).count() == 0 and want.exceptAll(summed).count() == 0
    assert ident.occurrence_rank(df.limit(0), ["k"], "o").count() == 0


def test_ranks_of_large_and_small_keys(spark):
    """Keys above the size go by ranges without a window over their rows, the others by one window; NULL is a key of either kind."""
    o = ((F.col("id") * 7919) % 5000).alias("o")
    for k in (F.when(F.col("id") % 3 > 0, F.col("id") % 40), F.when(F.col("id") % 3 == 0, F.lit(7))):
        df = spark.range(5000).select(F.when(k.isNull() | (k > 30), k).otherwise(F.col("id")).alias("k"), F.lit("a").alias("j"), o)
        want = df.withColumn("r", F.row_number().over(Window.partitionBy("k", "j").orderBy("o")).cast("bigint"))
        for many in (0, 60, 5000):
            got = ordering.ranked(df, ["k", "j"], ["o"], "r", many)
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    plan = ordering.ranked(df, [], ["o"], "r")._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "Window [sum(_value" not in plan


def test_one_key_of_a_million_rows_is_ranked_by_all_tasks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1_000_000, numPartitions=8).select(F.lit("x").alias("k"), F.pmod(F.col("id") * 48271, F.lit(1_000_003)).alias("o"))
        got = ident.occurrence_rank(df, ["k"], "o", "r").withColumn("task", F.spark_partition_id())
        assert got.agg(F.count_distinct("r"), F.min("r"), F.max("r")).first()[:] == (1_000_000, 1, 1_000_000)
        assert got.join(got.select((F.col("r") + 1).alias("r"), F.col("o").alias("before")), "r").filter("o <= before").count() == 0
        sizes = [n for _, n in got.groupBy("task").count().collect()]
        assert len(sizes) > 3 and max(sizes) < 500_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_entries_of_a_name_are_reduced_before_they_meet_names(spark):
    draw = random.Random(4)
    entries = [(draw.choice("hHk"), draw.sample(["A", "C", None, "Z"], draw.randint(0, 3)), draw.choice([None, i]), float(i), i) for i in range(300)]
    names = [(n, r) for n in ("h", "K on A", "h on c", "k on Q", "none on A") for r in ("A", "c", "Z", None)]
    reg = frame(spark, entries, "name string, targets array<string>, unimod int, mass double, entry_order int")
    want = {}
    for n, r in names:
        stem, _, tail = n.partition(" on ")
        for tier, key, target in ((0, n.lower(), r), (1, stem.lower() if tail else None, r or n.split(" on ")[-1][:1].upper())):
            for name, targets, unimod, mass, o in entries:
                if key is not None and name.lower() == key:
                    rank = 0 if target is not None and target.upper() in targets else 1 if unimod is not None else 2
                    want[n, r] = min(want.get((n, r), ((9,), None, None)), ((tier, rank, o), unimod, mass), key=lambda x: x[0])
    found = lookup_with_preference(frame(spark, names, "name string, residue string"), reg)
    assert {(r["name"], r["residue"]): (r["unimod"], r["mass"]) for r in found.collect()} == {k: v[1:] for k, v in want.items()} and len(want) == 16
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" in plan[plan.index("Join"):]


def test_lines_are_reduced_to_notations_before_they_meet_forms(spark):
    columns = {r: [r] for r in ("full_sequence", "accession", "q_value", "q_value_notch", "pep", "label")}
    lines = frame(spark, [(3, "A", "P3", "0.3", "D"), (2, "A", "P2", "0.4", "C"), (1, "B", "P1", "0.5", "D"), (4, "B", "P4", "0.1", "D"), (5, "X", "P5", "0.2", "D"), (6, "C", "P6", "0.6", "T"), (7, "C", "P7", "0.7", "D")],
                  "row_order int, full_sequence string, accession string, q_value string, label string")
    forms = frame(spark, [("A", "ab", "s"), ("B", "ab", "s"), ("C", "c", "t"), ("X", "", "u")], "notation string, proforma string, base_sequence string")
    out = ident.form_rows(lines, columns, "D", forms, frame(spark, [("ab", 4)], "peptidoform string, n_psms bigint"), frame(spark, [("D:P1",)], "protein_group_id string"))
    got = {r["peptidoform"]: (r["best_q_value"], r["target_decoy"], r["n_psms"], r["protein_group_id"], r["protein_accessions"], r["engine_full_sequences"]) for r in out.collect()}
    assert got == {"ab": (0.1, "decoy", 4, "D:P1", ["P1"], ["A", "B"]), "c": (0.6, "target", 0, None, ["P6"], ["C"])}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("min_by(protein_accessions") > 1


def test_acceptance_is_three_valued(spark):
    rows = frame(spark, [("target", 0.01, None, None), ("target", 0.01, 0.02, None), ("target", 0.0, 0.0, True), (None, 0.0, None, False), ("decoy", 0.0, None, False), ("contaminant", 0.01, None, False)],
                 "label string, q double, q2 double, amb boolean")
    assert filters.accepted_matches(rows, "label", "q", "q2", "amb").count() == 1
    assert filters.accepted_forms(rows, "label", "q", "q2").count() == 2
    assert filters.accepted_groups(rows, "label", "q").count() == 4  # a NULL label is dropped here
    assert ident.accepted_group_count(rows, "label", "q").first()[0] == 5  # and counted here


def test_accepted_counts_agree_with_the_view_except_on_compound_labels(spark):
    raw = frame(spark, [("T", "0.005"), ("T|T", "0.005"), ("C", "0.001"), ("T", "0.5")], "label string, q string")
    strict = ident.accepted_counts(raw, cells.lenient_float("q"), F.col("label") == "T").first()[0]
    typed = raw.select(rules.worst_label("label").alias("target_decoy"), cells.lenient_float("q").alias("q"), F.lit(None).cast("double").alias("q2"))
    assert strict == 1 and filters.accepted_forms(typed, q="q", q_notch="q2").count() == 2


TABLE = parse_columns("a string!, n long, f double, b boolean, d date, t timestamp, l array<string>")


def test_coercion(spark):
    raw = frame(spark, [(" x ", "3.7", "nan", "YES", "2024-01-02T05:00", "2024-01-02T05:00:00", "one"), ("", "bad", "1e3", "off", "", "2024-01-02T05:00:00+02:00", "")],
                "a string, n string, f string, b string, d string, t string, l string")
    r = coerce(raw, TABLE).collect()
    assert (r[0]["a"], r[0]["n"], r[0]["f"], r[0]["b"], str(r[0]["d"]), r[0]["l"]) == (" x ", 3, None, True, "2024-01-02", ["one"])
    assert (r[1]["a"], r[1]["n"], r[1]["f"], r[1]["b"], r[1]["d"], r[1]["l"]) == (None, None, 1000.0, False, None, None)
    assert values(coerce(raw, TABLE).select(F.date_format("t", "HH").alias("h")), "h") == ["05", "03"]
    assert {(v["column"], v["rule"], v["n"]) for v in coercion_violations(raw, TABLE).collect()} == {("a", "required", 1), ("n", "malformed", 1)}
    with pytest.raises(ValueError):
        coerce(raw.withColumn("zzz", F.lit(1)), TABLE)


def test_exact_copies_collapse_and_disagreements_stay(spark):
    rows = [("a", 1, ["x"]), ("a", 1, ["x"]), ("b", 1, ["x"]), ("b", 2, ["x"]), ("b", 2, ["x"]), (None, 1, None), (None, 1, None), ("c", 1, ["x", "y"]), ("c", 1, ["y", "x"])]
    kept, report = quality.collapse_exact_duplicates(frame(spark, rows, "k string, v int, l array<string>"), ["k"])
    assert sorted(values(kept, "k"), key=str) == ["None"] * 0 + sorted(["a", "b", "b", "b", "c", "c", None], key=str)
    assert sorted(values(report, "k", "written", "dropped"), key=str) == sorted([("a", 2, 1), (None, 2, 1)], key=str)


def test_keys_and_references(spark):
    rows = frame(spark, [("d", "x"), ("d", "x"), ("d", None), ("d", None), ("e", "x")], "dataset_id string, id string")
    check = quality.unique_key(rows, "t", ["id"]).first()
    assert (check["ok"], check["observed"], check["detail"]) == (False, 1, "e.g. x")
    assert quality.unique_key_nullsafe(rows, "t", ["dataset_id", "id"], "dataset_id").first()["observed"] == 2
    parent = frame(spark, [("d", "x")], "dataset_id string, pid string")
    bad = quality.dangling_references(rows, "t", "id", parent, "p", "pid").first()
    assert (bad["observed"], bad["detail"]) == (1, "e.g. x")  # x of another dataset does not count
    assert quality.dangling_references(rows, "t", "id", parent, "p", "pid", scope=[]).first()["ok"]


def test_typed_reference_without_a_target_fails(spark):
    rows = frame(spark, [("a", "1"), ("b", "2"), ("zz", "3"), (None, "4")], "t string, id string")
    targets = {"a": (frame(spark, [("1",)], "x string"), "x"), "b": (frame(spark, [("9",)], "x string"), "x")}
    got = {r["name"]: (r["ok"], r["observed"]) for r in quality.polymorphic_reference(rows, "q", "t", "id", targets, scope=[]).collect()}
    assert got == {"q.id -> a.x": (True, 0), "q.id -> b.x": (False, 1), "q.t zz": (False, None)}


def test_reconcile_does_not_judge_a_missing_side(spark):
    obs = frame(spark, [("a", 1), ("b", 2), ("c", None)], "name string, value int")
    exp = frame(spark, [("a", 1), ("b", 3), ("d", 4)], "name string, value int")
    got = {r["name"]: (r["comparable"], r["ok"]) for r in quality.reconcile(obs, exp, ["name"]).collect()}
    assert got == {"a": (True, True), "b": (True, False), "c": (False, True), "d": (False, True)}


def test_undeclared_definitions_are_checked_only_when_some_are_declared(spark):
    rows = frame(spark, [("a",), ("b",), ("",), (None,)], "d string")
    assert values(quality.undeclared_definitions(rows, "d", frame(spark, [("a",)], "d string"), "d"), "definition_id") == ["b"]
    assert quality.undeclared_definitions(rows, "d", frame(spark, [], "d string"), "d").count() == 0


def test_gate_refuses(spark):
    quality.enforce(frame(spark, [("n", "k", True, 0, 0, None)], quality.CHECK_COLUMNS))
    with pytest.raises(quality.GateRefused):
        quality.enforce(frame(spark, [("n", "k", False, 1, 0, "e")], quality.CHECK_COLUMNS))


def test_snapshot_choice(spark):
    rows = frame(spark, [("a", "aa1", 1), ("a", "ab2", 2), ("b", "bb1", 1)], "ds string, snap string, t int")
    pick = lambda **kw: (dict(values(latest_snapshot(rows, "ds", "snap", "t", **kw)[0], "ds", "snap")), dict(values(latest_snapshot(rows, "ds", "snap", "t", **kw)[1], "ds", "reason")))
    assert pick() == ({"b": "bb1"}, {"a": "2 snapshots and no pin"})
    assert pick(latest=True)[0] == {"a": "ab2", "b": "bb1"}
    assert pick(pins={"a": "aa"}) == ({"a": "aa1", "b": "bb1"}, {})
    assert pick(pins={"a": "a"})[1] == {"a": "the pin matches 2 of 2 snapshots"}
    assert pick(pins={"c": "x"})[1] == {"a": "2 snapshots and no pin", "c": "no snapshot"}
    assert pick(pins={"a": "aa1"}, release=True) == ({"a": "aa1"}, {"b": "a release needs a pin"})
    with pytest.raises(ValueError):
        pick(latest=True, release=True)


def test_snapshot_id_does_not_depend_on_partitions_or_order(spark):
    rows = [("k", f"role{i % 7}", f"p{i}", f"sha{i}") for i in range(200)]
    a = frame(spark, rows, "k string, role string, path string, sha256 string").repartition(1)
    b = frame(spark, rows[::-1], "k string, role string, path string, sha256 string").repartition(8)
    assert snapshot_id(a, ["k"], ["h"]).first() == snapshot_id(b, ["k"], ["h"]).first()
    assert snapshot_id(a, ["k"], ["h"]).first() != snapshot_id(a, ["k"], ["h2"]).first()


def test_declaration_digest_ignores_prose(spark):
    rows = frame(spark, [(1, "t", "why"), (2, "t", "other"), (3, None, "why")], "id int, title string, reason string")
    got = dict(values(declaration_digest(rows, ["id"], ["title"]), "id", "sha256"))
    assert got[1] == got[2] != got[3]


def test_zero_rule_belongs_to_the_column(spark):
    wide = frame(spark, [("g", "0", "0", "", "5")], "id string, Intensity_a string, SpectralCount_a string, Intensity_b string, SpectralCount_b string")
    got = set(values(quant.melt_measures(wide, ["id"], {"Intensity": False, "SpectralCount": True}), "run", "measure", "value"))
    assert got == {("a", "SpectralCount", 0.0), ("b", "SpectralCount", 5.0)}


def test_scope_gate_statuses(spark):
    f = lambda *ids: frame(spark, [(i,) for i in ids], "run_id string")
    status = lambda a, r, **kw: samples.scope_gate(a, r, "run_id", **kw)[3].first()["status"]
    assert status(f("a"), f("a")) == "trusted"
    assert status(f("a", "b"), f("a")) == "partial"
    assert status(f("a"), f("a", "b")) == "partial"
    assert status(f("c"), f("a")) == "unmatched"
    assert status(f("c").limit(0), f("a"), sheet_present=False) == "absent"


def test_run_map_must_cover_every_run(spark):
    runs = frame(spark, [("a",), ("b",)], "r string")
    given = frame(spark, [("a", "phospho"), ("c", "nonsense")], "run string, value string")
    _, problems = samples.assign_run_attribute(runs, "r", ["phospho"], False, given)
    assert {r["problem"] for r in problems.collect()} == {"unknown value", "not a run", "run without a value", "undeclared value"}
    full = frame(spark, [("a", "phospho"), ("b", "phospho")], "run string, value string")
    assert [r["problem"] for r in samples.assign_run_attribute(runs, "r", ["phospho"], True, full)[1].collect()] == ["mixed, but one value"]
    plain, none = samples.assign_run_attribute(runs, "r", ["phospho"], False, None)
    assert values(plain, "enrichment") == [["phospho"], ["phospho"]] and none.count() == 0
    assert values(samples.assign_run_attribute(runs, "r", ["phospho"], True, None)[0], "enrichment") == [None, None]


def test_repeated_sheet_headers_keep_their_cells(spark, tmp_path):
    path = tmp_path / "s.tsv"
    path.write_text("source name\tcharacteristics[x]\tcharacteristics[x]\tcomment[x source]\tcomment[characteristics source]\nS\tone\ttwo\tmine\trow\nS\tlater\n\nT\tnot available\n")
    sheet = files.read_sample_sheet(spark, str(path))
    long = values(samples.melt_sheet(sheet, "D"), "sample_id", "value", "value_reserved", "source")
    assert sorted(long) == [("D:S", "one", False, "mine"), ("D:S", "two", False, "mine"), ("D:T", "not available", True, None)]


def test_short_rows_are_padded_and_quotes_are_text(spark, tmp_path):
    path = tmp_path / "w.tsv"
    path.write_text('a\tb\tc\n1\t"x\n\n2\ty\tz\n')
    assert values(files.read_wide_tsv(spark, str(path)), "a", "b", "c") == [("1", '"x', None), ("2", "y", "z")]


def test_report_lines(spark, tmp_path):
    path = tmp_path / "r.txt"
    path.write_text("All target PSMs with q-value <= 0.01: 5\nAll target protein groups with q-value <= 0.01 (1% FDR): 3\nx - Target PSMs with q-value <= 0.01: 2\nx - All MS2 Scans: 7\nx - MS2 Scans: 8\nnoise: 9\nAll target PSMs with q-value <= 0.01: 6\n")
    assert set(values(files.read_report_counts(spark, str(path)), "scope", "name", "count")) == {("", "psms", 6), ("", "protein_groups", 3), ("x", "psms", 2), ("x", "ms2_scans", 8)}


def test_modification_list(spark, tmp_path):
    path = tmp_path / "m.txt"
    path.write_text("Header text\nID   One on C\nTG   C\nMM   x\nDR   Unimod; 4.\n//\nID   Two\nTG   Methionine.\nMM   1.5\nID   Three\nTG   K or Nxs\n// tail\nID   Four\n")
    got = {r["name"]: (r["targets"], r["unimod"], r["mass"]) for r in files.read_modification_list(spark, [str(path)]).collect()}
    assert got == {"One on C": (["C"], 4, None), "Two": (["M"], None, 1.5), "Three": (["K", "N"], None, None), "Four": ([], None, None)}


def test_bounded_answer_caps(spark):
    df = spark.range(10).select(F.col("id"), F.lit("x" * 9).alias("t"))
    assert search.bounded_answer(df).truncated_by is None
    cut = search.bounded_answer(df, rows=4)
    assert (len(cut.rows), cut.truncated_by) == (4, "rows")
    short = search.bounded_answer(df, chars=40)
    assert short.truncated_by == "characters" and len(short.rows) == 2
    assert search.bounded_answer(df, rows=10**9).max_rows == search.ROW_CAP


def test_wildcards_in_a_query_are_text(spark):
    df = frame(spark, [("50%",), ("500",)], "t string")
    assert values(df.filter(search.any_contains(["t"], "0%")), "t") == ["50%"]


def test_delivery_extension_is_not_sniffed(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("l", T.ArrayType(T.StringType()))])
    (tmp_path / "d.csv").write_text("a,l\n1,x; y;\n")
    assert values(files.read_delivery(spark, str(tmp_path / "d.csv"), schema), "a", "l") == [("1", ["x", "y"])]
    with pytest.raises(ValueError):
        files.read_delivery(spark, str(tmp_path / "d.txt"), schema)


def test_keys_are_hashed_and_examples_read_off_the_bad_ones(spark):
    rows = spark.createDataFrame([("d", 1, None, "b", ["x", "y"]), ("d", 1, None, "a", ["z", None]), ("d", 2, "k", "c", None)], "s string, n int, m string, other string, refs array<string>")
    targets = spark.createDataFrame([("d", "x"), ("e", "y")], "s string, id string")
    rules = [
        quality.unique_rule("rows", ["n"], ["s"]), quality.nullsafe_rule("rows", ["m", "n"], "n"), quality.nullsafe_rule("rows", ["n", "s"], "other"),
        quality.reference_rule("rows", "refs[]", "targets", "id", ["s"]), quality.typed_rule("rows", "other", "m", {"c": ("targets", "id"), "a": ("targets", "id")}, []),
    ]
    got = [tuple(r) for r in quality.checked({"rows": rows, "targets": targets}, rules).select("name", "ok", "observed", "detail").collect()]
    assert Counter(got) == Counter([
        ("rows.n", False, 1, "e.g. 1"), ("rows (m, n)", False, 1, "e.g. 1"), ("rows (n, s)", False, 1, "e.g. a"), ("rows.refs[] -> targets.id", False, 2, "e.g. y"),
        ("rows.m -> targets.id", False, 1, "e.g. k"), ("rows.m -> targets.id", False, 1, None), ("rows.other b", False, None, "names no table"),
    ])
    plan = quality.checked({"rows": rows, "targets": targets}, rules[:2])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[r#" in plan and not re.search(r"SortAggregate\(key=\[r#\d+, t#\d+, key#", plan)


def test_rows_are_not_shuffled_to_meet_a_few_names(spark):
    rows = spark.range(3_000_000).select(F.concat(F.lit("run"), (F.col("id") % 3).cast("string"), F.lit("-calib")).alias("file"), F.lit("x" * 50).alias("more"))
    known = spark.createDataFrame([("run0",), ("run1",)], "name string")
    got = ident.resolve_names(rows, "file", known, "name")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(file" not in plan
    assert {tuple(r) for r in got.select("file", "resolved").distinct().collect()} == {("run0-calib", "run0"), ("run1-calib", "run1"), ("run2-calib", None)}


def test_keys_are_not_counted_where_no_group_of_keys_is_large(spark, monkeypatch):
    rows = spark.range(20_000).select((F.col("id") % 7_000).alias("k"), F.when(F.col("id") % 2 == 0, F.lit("a")).alias("j"), F.col("id").alias("o"))

    def never(*a):
        raise AssertionError("keys were counted")

    monkeypatch.setattr(ordering, "materialise", never)
    got = ordering.ranked(rows, ["k", "j"], ["o"], "r", 50)
    assert got.count() == 20_000 and [tuple(r) for r in got.filter("k = 6").orderBy("o").select("o", "r").collect()] == [(6, 1), (7_006, 2), (14_006, 3)]


def test_numbers_are_read_as_if_stripped_first(spark):
    odd = [" 1.5 |x", "\x0b2\x0c", "\t\n3|4", "NaN", " nan ", "", " ", None, "|3", "1e3|", "abc", "Infinity", "-inf", "\u00a05", "\x016", "7d", "1 2", "8|", "0x1p3"]
    plain = F.btrim(F.split_part("c", F.lit("|"), F.lit(1)), F.lit(" \t\n\r\x0b\x0c")).try_cast("double")
    rows = frame(spark, [(x,) for x in odd], "c string").select("c", cells.lenient_float("c").alias("got"), F.when(~F.isnan(plain), plain).alias("want"))
    assert all(r["got"] == r["want"] for r in rows.collect())
