"""Hard negatives, conversation repair and fingerprints against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import clashing, prose
from veracat.llm import fingerprints, hard_negatives, repair


def told(df):
    return Counter(tuple(r) for r in df.collect())


# Hard negatives

def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def mined(rows, **how):
    return hard_negatives.mine(hard_negatives.quantised(rows), F.coalesce(F.col("vec_id") % 10 == 0, F.lit(False)), **how)


def by_hand(rows, positives=5, negatives=5):
    kept = [(i, v, lab, [math.floor(256 * x) for x in e]) for i, (v, e, lab) in enumerate(rows) if lab is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = Counter()
    score = lambda a, b: sum(x * y for x, y in zip(a[3], b[3]))
    for a in (r for r in kept if r[1] is not None and r[1] % 10 == 0):
        order = sorted((b for b in kept if b[0] != a[0]), key=lambda b: (-score(a, b), b[1] is None, b[1] or 0))
        for p in [b for b in order if b[2] == a[2]][:positives]:
            inside = [b for b in order if b[2] != a[2] and 80 * score(a, p) <= 100 * score(a, b) <= 100 * score(a, p)][:negatives]
            out.update((a[1], p[1], k + 1, b[1], score(a, p), score(a, b)) for k, b in enumerate(inside))
    return out


def drawn(n, width=8, seed=5):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    # Halves of 1/8 are exact as floats of either size.
    return [(i, [round((c + draw.gauss(0, 0.4)) * 8) / 8 for c in centres[draw.randrange(6)]], draw.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("fanout, leaf", [(2, 4), (5, 16), (8, 10_000)])
def test_hard_negatives_are_exact_for_any_tree(spark, fanout, leaf):
    rows = drawn(400)
    assert told(mined(vectors(spark, rows), fanout=fanout, leaf=leaf)) == by_hand(rows)


def test_hard_negatives_of_odd_rows(spark):
    rows = drawn(60, seed=6)
    rows += [(100, None, 1), (110, [1.0, float("nan")], 1), (120, [1.0, None], 1), (130, [float("inf")], 1), (140, [1.0] * 8, None)]  # take no part
    rows += [(150, [], 1), (160, [2.0], 1), (None, [2.0] * 8, 1), (None, [2.0] * 8, 2), (170, [0.0] * 8, 2)]
    rows += [(180, [1.0] * 8, 3), (180, [1.0] * 8, 3), (181, [1.0] * 8, 1), (182, [1.0] * 8, 1), (182, [1.0] * 8, 1)]  # repeated rows and ties
    want = by_hand(rows)
    assert want and told(mined(vectors(spark, rows), leaf=4)) == want
    assert told(hard_negatives.mine(hard_negatives.quantised(clashing(vectors(spark, rows))), F.coalesce(F.col("vec_id") % 10 == 0, F.lit(False)))) == want
    assert mined(vectors(spark, [])).count() == 0
    assert mined(vectors(spark, [(1, [1.0], 1)])).count() == 0


def test_a_vector_that_is_a_third_of_the_rows(spark):
    rows = drawn(200, seed=7) + [(1000 + i, [1.0] * 8, i % 2) for i in range(100)]
    assert told(mined(vectors(spark, rows), fanout=3, leaf=8)) == by_hand(rows)


def test_large_components_stay_whole_numbers(spark):
    rows = [(10 * i, [float(2 ** 20 + i), 3.0], i % 2) for i in range(8)]
    assert told(mined(vectors(spark, rows))) == by_hand(rows)


def test_split_points_rule_out_subtrees(spark):
    """Far groups are not visited for a narrow window."""
    rows = [(i, [10.0 * (i % 4 == 0), 10.0 * (i % 4 == 1), 10.0 * (i % 4 == 2), 10.0 * (i % 4 == 3) + (i % 7) / 8], i % 3) for i in range(400)]
    tree, indexed = hard_negatives.index(hard_negatives.quantised(vectors(spark, rows)), leaf=16)
    one = indexed.where("vec_id = 0").withColumns({"low": F.expr("array(6000000L)"), "high": F.expr("array(7000000L)")})
    assert 0 < hard_negatives.probes(tree, one).count() < tree.leaves / 2


# Conversation repair

def talk(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def mended_by_hand(conv, rows):
    """All edits by a search over the rows from the last to the first."""
    said = lambda v: " " if v is None else str(v)
    rs = []
    for turn, role, text in rows:
        fate = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        rs += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, kinds = set(), []
    for _, role, text in rs:
        words = text.strip(" \t\n\x0b\x0c\r")
        kinds.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:]))
    turns = [t for t, _, _ in rs if t is not None]
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @cache
    def go(i, state, inserted):
        options = []
        if i == len(rs):
            options += [(0, "", ())] * (state in ("", "a"))
        else:
            _, role, text = rs[i]
            late = kinds[i] == "truncated"
            edits = [(3, "D", (), state)]
            if kinds[i] not in ("blank", "duplicate"):
                edits += [(late, "K", (f"{role}:{text}",), moves[state, role[:1]])] if (state, role[:1]) in moves else []
                edits += [(2 + late, "R", (f"{w}:{text}",), moves[state, w[0]]) for w in ("user", "assistant") if (state, w[0]) in moves]
            options += [(c + x[0], e + x[1], o + x[2]) for c, e, o, n in edits if (x := go(i + 1, n, 0))]
        if inserted < 3:
            options += [(2 + x[0], "I" + x[1], (f"{w}:",) + x[2]) for w in ("user", "assistant") if (state, w[0]) in moves and (x := go(i, moves[state, w[0]], inserted + 1))]
        return min(options, key=lambda o: o[:2]) if options else None

    cost, audit, lines = go(0, "", 0)
    counts = Counter(kinds)
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def all_by_hand(rows):
    groups = defaultdict(list)
    for conv, *row in rows:
        groups[conv].append(tuple(row))
    return Counter(mended_by_hand(conv, rs) for conv, rs in groups.items())


@pytest.fixture(scope="module")
def talks():
    draw = random.Random(3)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No", "Why?", "", " \n", None, "Well. And", "é\U0001F600!", "ok \t", "."]
    rows = [(c, draw.choice([t, t, t, None, t + 3]), draw.choice(roles), draw.choice(texts)) for c in range(150) for t in range(draw.randrange(1, 9))]
    return rows + [(None, 1, "user", "Hi."), (None, None, "assistant", "Lo."), (-5, 10**15, "user", "a" * 50_000), (-5, -(10**15), "system", "b.")] + [(900, 4, "user", "Same.")] * 7


def test_repair_against_all_edits(spark, talks):
    assert told(repair.repair(talk(spark, talks))) == all_by_hand(talks)


def test_repair_sql_of_odd_rows(talks):
    con = duckdb.connect()
    con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", talks)
    assert Counter(con.sql(repair.SQL).fetchall()) == all_by_hand(talks)


def test_a_conversation_of_many_chunks(spark):
    draw = random.Random(4)
    rows = [(1, t, draw.choice(["user", "assistant"]), draw.choice(["Yes.", "No", f"T{t}!", "."])) for t in range(150)] + [(2, None, "user", "x")] * 90
    for chunk in (2, 64):
        assert told(repair.repair(talk(spark, rows), chunk=chunk)) == all_by_hand(rows)


def test_repair_of_nothing_and_of_other_columns(spark, talks):
    assert repair.repair(talk(spark, [])).count() == 0
    gone = next((c, t) for c in range(100) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    row = repair.repair(talk(spark, [(*gone, "user", "Hello.")])).first()
    assert tuple(row) == (gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert told(repair.repair(clashing(talk(spark, talks)).withColumns({c: F.lit("x") for c in ("n", "digest", "chunk", "kind", "found", "cell")}))) == all_by_hand(talks)


def test_cells_hold_the_least_audit():
    assert repair.best(repair.spanned([])) == (0, "")
    assert repair.best(repair.row_cell("u", False, False)) == (2, "KI")
    assert repair.best(repair.row_cell("a", False, False)) == (2, "IK")
    assert repair.best(repair.row_cell("s", False, False)) == (3, "D")


# Fingerprints

def shingles(text, n=5):
    w = (text or "").encode().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edits_by_hand(rows):
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = Counter()
    for (d, t), (_, u) in zip(order, order[1:] + order[:1]):
        changed = t[:len(t) - len(t) // 2] + u[:len(t) // 2]
        out[d, len(t), hashlib.sha256(changed.encode()).hexdigest(), round(likeness(shingles(t), shingles(changed)), 9), round(likeness(shingles(t), shingles(u)), 9)] += 1
    return out


def paired(df):
    return told(df.select("doc_id", "n_chars", "edited_sha256", F.round("near_edited", 9), F.round("near_next", 9)))


def test_fingerprints_of_edited_texts(spark, documents):
    base = prose(9, 300)
    rows = [(i, prose(i % 40, 30 + 7 * (i % 40))) for i in range(150)] + [(200, base), (199, base + " end"), (198, None), (197, ""), (196, " \n "), (195, "one two"), (194, "one two"), (-3, "é\U0001F600 " * 3001), (None, "last one of all")]
    docs = documents(rows)
    # With room for every shingle the estimates are exact.
    assert paired(fingerprints.edited(docs, k=10_000)) == edits_by_hand(rows)
    estimates = {r["doc_id"]: r for r in fingerprints.edited(docs).collect()}
    assert abs(estimates[200]["near_next"] - likeness(shingles(base), shingles(base + " end"))) < 0.15
    assert estimates[195]["fingerprint"] == estimates[194]["fingerprint"] and estimates[195]["near_next"] == 1 and estimates[198]["near_next"] == 1
    assert all(len(r["fingerprint"]) <= 12 * fingerprints.K for r in estimates.values())
    assert paired(fingerprints.edited(clashing(docs), k=10_000)) == edits_by_hand(rows)


def test_fingerprints_of_odd_tables(spark, documents, odd, none):
    assert fingerprints.edited(none).count() == 0 and fingerprints.sketches(none, "text").count() == 0
    made = fingerprints.edited(odd)
    assert made.count() == odd.count()
    assert made.where("doc_id = 5").select("fingerprint", "n_chars").distinct().count() == 1
    alone = fingerprints.edited(documents([(1, "a b c d e f")])).first()
    assert alone["near_next"] == 1 and alone["edited_sha256"] == hashlib.sha256(b"a b c a b c").hexdigest()


def test_sketches_merge_and_estimate(spark, documents):
    a, b = prose(1, 3000), prose(1, 3000)[9000:] + " " + prose(2, 1500)
    parts = fingerprints.sketches(documents([(1, a), (2, b), (3, None)]), "text")
    whole = fingerprints.merged(parts.withColumn("k", F.lit(None).cast("string")), ["k"])
    both = parts.where("doc_id = 1").select(F.col("fingerprint").alias("a")).crossJoin(parts.where("doc_id = 2").select(F.col("fingerprint").alias("b"))).crossJoin(whole.select(F.col("fingerprint").alias("u")))
    r = both.select(fingerprints.resemblance("a", "b"), fingerprints.containment("b", "a"), fingerprints.distinct_shingles("a"), fingerprints.distinct_shingles("u"), fingerprints.distinct_shingles(F.lit("")), "u").first()
    x, y = shingles(a), shingles(b)
    assert abs(r[0] - likeness(x, y)) < 0.15 and abs(r[1] - len(x & y) / len(y)) < 0.2
    assert abs(r[2] / len(x) - 1) < 0.3 and abs(r[3] / len(x | y) - 1) < 0.3 and r[4] == 0
    hasher = fingerprints.Hasher()
    joint = sorted({*fingerprints.Hasher(k=10**6).of(a.encode()).tolist(), *fingerprints.Hasher(k=10**6).of(b.encode()).tolist()})[:fingerprints.K]
    assert r[5] == "".join(f"{h:012x}" for h in joint)
    assert hasher.of(("one " * 50_000).encode()).shape == (1,)
