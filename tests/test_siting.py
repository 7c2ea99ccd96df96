"""Placement and assignment queries against brute force."""

import itertools
import random
from collections import Counter, defaultdict

import pytest

from veracat.operators import sites
from veracat.workload import REGISTRY

LETTERS = "a a a b b n an ana nan tion station \\E . (x banana".split(" ")


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    draw = random.Random(11)
    rows = [(i, " ".join(draw.choice(LETTERS) for _ in range(draw.randint(1, 40))).upper(), draw.choice(["de", "fr", "en"])) for i in range(40)] + [(40, "", "en"), (41, None, "en"), (42, "  Two  two ", "de")]
    folder = str(tmp_path_factory.mktemp("texts"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    return folder, rows


def starts(piece, body):
    return [i + 1 for i in range(len(body)) if body.startswith(piece, i)]


def pieces(body):
    return {w for w in body.split(" ") if w} | {"tion"}


def test_all_words_of_every_text_are_found(spark, texts):
    folder, rows = texts
    want = Counter()
    for doc_id, body, _ in rows:
        for piece in pieces((body or "").lower()):
            if found := starts(piece, (body or "").lower()):
                want[doc_id, piece, len(found), found[0], found[-1]] += 1
    got = REGISTRY["occurrences"][0](spark, folder).select("doc_id", "piece", "n", "first_place", "last_place")
    assert Counter(map(tuple, got.collect())) == want and len(want) > 250


def test_all_words_of_every_text_are_placed(spark, texts):
    folder, rows = texts
    want = Counter()
    for doc_id, body, lang in rows:
        for piece in pieces((body or "").lower()) if body is not None else ():
            n = len(starts(piece, body.lower())) if lang != "fr" else 0
            want[f"D{doc_id}", piece, n, "no_sequence" if lang == "fr" else None if n else "peptide_not_in_sequence"] += 1
    got = REGISTRY["place_peptides"][0](spark, folder).select("accession", "piece", "n_places", "reason")
    assert Counter(map(tuple, got.collect())) == want and len(want) > 250


def test_the_query_returns_every_place_with_its_letter_and_length(spark, texts):
    folder, rows = texts
    want = Counter()
    for doc_id, body, lang in rows:
        for piece in pieces((body or "").lower()) if body is not None and lang != "fr" else ():
            want.update((f"D{doc_id}", piece, i, body.lower()[i - 2:i - 1] if i > 1 else "", len(body)) for i in starts(piece, body.lower()))
    got = REGISTRY["place_peptides"][0](spark, folder).selectExpr("accession", "piece", "inline(from_json(places, 'array<struct<start:bigint,previous:string,length:bigint>>'))")
    assert Counter(map(tuple, got.collect())) == want and len(want) > 1000


def test_places_of_several_sequences_are_one_list(spark):
    """Astral letters in front, a place that two sequences have alike, one that differs by the letter in front or the length."""
    seqs = spark.createDataFrame([("A", "𝄞ab"), ("A", "éab"), ("A", "xab"), ("A", "abab"), ("A", "ab" + "éa"), ("B", "zz")], "accession string, sequence string")
    pairs = spark.createDataFrame([("ab", "A"), ("ab", "A"), ("b", "A"), ("q", "A"), ("ab", "B"), ("ab", "C")], "p string, a string")
    got = {(r["accession"], r["piece"]): (r["n_places"], r["reason"], r["places"] and sorted(map(tuple, r["places"]))) for r in sites.placed_lists(pairs, "p", "a", seqs).collect()}
    ab = sorted([(2, "𝄞", 3), (2, "é", 3), (2, "x", 3), (1, "", 4), (3, "b", 4)])
    b = sorted([(3, "a", 3), (2, "a", 4), (4, "a", 4)])
    none = (0, "peptide_not_in_sequence", None)
    assert got == {("A", "ab"): (5, None, ab), ("A", "b"): (3, None, b), ("A", "q"): none, ("B", "ab"): none, ("C", "ab"): (0, "no_sequence", None)}


def test_every_line_states_a_segment(spark, sf):
    names = {r["p_partkey"]: r["p_name"] for r in spark.read.parquet(f"{sf}/part.parquet").collect()}
    orders = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/lineitem.parquet").collect():
        orders[r["l_orderkey"]].append((r["l_linenumber"], r["l_partkey"], r["l_suppkey"], r["l_extendedprice"]))
    want, several = Counter(), Counter()
    for g, lines in orders.items():
        members = [k for _, k, *_ in sorted(lines)]

        def fits(stated, k):
            # A blank letter names no residue, and any residue fits.
            return all(a <= len(names[k]) and (names[stated][a - 1:a] in ("", " ") or names[k][a - 1:a] == names[stated][a - 1:a]) for a in (1, 3))

        for part, stated in ((0, members[::2]), (1, members[1::2]), (2, members)):
            valid = [c for c in itertools.combinations(range(len(members)), len(stated)) if all(fits(s, members[m]) for s, m in zip(stated, c))]
            for i in range(len(stated)):
                want[g, part, i, str(members[valid[0][i]]) if len(valid) == 1 else None] += 1
            several[len(stated) > 1 and part < 2, len(valid) == 1] += 1
    got = REGISTRY["assign_segments"][0](spark, sf).select("g", "part", "segment", "accession")
    assert Counter(map(tuple, got.collect())) == want
    assert several[True, True] and several[True, False]


def test_segments_are_assigned_without_a_row_for_each_member_and_question(spark, tmp_path):
    """A group of 400 members and 400 questions: entries and members are dealt by group, nothing by what is asked of whom."""
    letters = "ACDEFGHIKLMNPQRSTVWY"
    seqs = spark.createDataFrame([(f"P{i}", "".join(letters[(i * 7 + k * (i % 19 + 1)) % 20] for k in range(400))) for i in range(400)], "accession string, sequence string")
    members = spark.createDataFrame([("g", i, f"P{i}") for i in range(400)], "g string, member int, accession string")
    own = seqs.selectExpr("'g' AS g", "0 AS c", "int(substr(accession, 2)) AS segment", "sequence")
    entries = own.selectExpr("g", "c", "segment", "explode(sequence(bigint(1), 400, 7)) AS position", "sequence").selectExpr("g", "c", "segment", "position", "concat('Mark on ', substr(sequence, int(position), 1)) AS modification")
    # Beyond any sequence, before it, nowhere, and at its end.
    odd = spark.createDataFrame([("g", 1 + i, 0, p, "Mark on A") for i, p in enumerate((10**17, -3, None, 401))], "g string, c int, segment int, position bigint, modification string")
    got = sites.assign_segments(entries.unionByName(odd), ["c"], "g", members, seqs)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= 4
    rows = {(r["c"], r["segment"]): r["accession"] for r in got.collect()}
    assert len(rows) == 404 and all(rows[0, i] == f"P{i}" for i in range(400)) and all(rows[c, 0] is None for c in range(1, 5))
