"""Token files and counts, languages, archives, near duplicates, paragraphs and the pipeline against brute force."""

import base64
import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import clashing, prose
from veracat.llm import chosen_path, fingerprints, language, paragraphs, tokens, verify, warc
from veracat.llm.queries import word_bpe
from veracat.session import scratch_dir


def texts_of(docs):
    return sorted(((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()), key=lambda x: (x[0] is not None, x[0] or 0, np.uint64(xxhash.xxh64_intdigest(x[1].encode(), 42)).astype(np.int64)))


def library_ids(texts, literal=False):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(word_bpe())
    t.encode_special_tokens = literal
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


ODD_TEXTS = ["", "It's Straße, ÉTÉ... x́ é!?", "a\tb\x0bc d e\nf", "<|endoftext|> x<|startoftext|>", "\U0001F600 数据 1234 don't", "ǅ İ ΣΑΣ ß"]


def test_encoder_gives_the_librarys_ids():
    enc = tokens.Encoder(word_bpe(), False)
    assert enc.plain
    texts = [*ODD_TEXTS, prose(1, 500), prose(2, 500).upper()]
    assert [np.frombuffer(enc.encode(t), "<u4").tolist() for t in texts] == library_ids(texts)


def test_token_files_round_trip(spark, odd, none, documents):
    docs = odd.unionByName(documents([(100 + i, t) for i, t in enumerate(ODD_TEXTS)]))
    want, start = [], 0
    pairs = texts_of(docs)
    for (doc_id, _), ids in zip(pairs, library_ids([t for _, t in pairs])):
        ids = [*ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    path = scratch_dir(spark, "tokens")
    assert Counter(map(tuple, tokens.encode_to_orc(clashing(docs), word_bpe(), path).collect())) == Counter(want)
    stored = spark.read.orc(path)
    assert stored.where("doc_id = 4").select("ids").first()[0][-1] == 2
    assert tokens.encode_to_orc(none, word_bpe()).count() == 0


def test_counts_are_stitched_across_blocks(spark, odd, none, documents):
    docs = odd.unionByName(documents([(100 + i, t) for i, t in enumerate(ODD_TEXTS)]))
    pairs = texts_of(docs)
    want = Counter((d, len(ids)) for (d, _), ids in zip(pairs, library_ids([t for _, t in pairs], literal=True)))
    for block in (tokens.BLOCK, 2000):
        assert Counter(map(tuple, tokens.count_tokens(clashing(docs), word_bpe(), block=block).collect())) == want
    assert tokens.count_tokens(none, word_bpe()).count() == 0


def test_scan_of_files_without_a_last_separator(spark, tmp_path):
    files = {}
    for i, ids in enumerate([[], [9], [5, 5, 5], [1, 9, 2, 2, 9, 9, 3], [1] * 50 + [9] + [2] * 7, [9, 9, 9]]):
        name = f"{tmp_path}/{i}.bin"
        open(name, "wb").write(np.asarray(ids, "<u2").tobytes())
        parts = "".join(map(chr, ids)).split(chr(9))
        files[name] = [len(p) for p in parts[:-1]] + ([len(parts[-1])] if parts[-1] else [])
    names = spark.createDataFrame([(n,) for n in files], "file string")
    got = defaultdict(dict)
    for r in tokens.scan_flat(names, separator=9, block=6).collect():
        got[r["file"]][r["ordinal"]] = r["n_tokens"]
    assert {n: [got[n][i] for i in range(len(got[n]))] for n in files} == files


def test_languages_on_held_out_rows(spark, sf, odd, none):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    profiles = language.fit(docs.where(~held))
    rows = language.identify(docs.where(held), profiles).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) > 0.97 * len(rows) and all(0 <= r["score"] <= 1 for r in rows)
    told = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(clashing(odd), profiles).collect()}
    assert all(told[i] == ("und", 0.0) for i in (1, 2, 3, -9)) and told[4][0] in profiles
    assert language.identify(none, profiles).count() == 0
    assert language.fit(none) == {} and {r["lang_pred"] for r in language.identify(odd, {}).collect()} == {"und"}
    kept = language.keep_identified(clashing(odd), profiles)
    assert kept.columns == clashing(odd).columns and {r[0] for r in kept.select("doc_id").collect()} == {4, 5, 6, 7, 8, None}


def test_out_of_place_distance():
    grams = np.asarray([10, 20, 30])
    places = np.asarray([[0, 1, 2], [2, 1, 0]])
    assert language.nearest("", ["a", "b"], grams, places, 3) == ("und", 0.0)
    text = "ab"
    own = language.ranked(*language.gram_counts(text), 3)
    grams = np.sort(own)
    right = np.searchsorted(grams, own)
    places = np.full((2, 3), 3)
    places[0, right] = [2, 1, 0]
    places[1, right] = [0, 1, 2]
    assert language.nearest(text, ["a", "b"], grams, places, 3) == ("b", 1.0)


def archived(pages):
    rows = sorted(((r["page_id"], (r["html"] or "").encode()) for r in pages.select("page_id", "html").collect()), key=lambda x: (x[0] is None, x[0] or 0))
    first = {}
    for page, payload in rows:
        first.setdefault(payload, page)
    return Counter(
        (p, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "response" if first[h] == p else "revisit", None if first[h] == p else first[h]) for p, h in rows
    )


def test_archive_round_trip(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    again = pages.where("page_id % 3 = 0").withColumn("page_id", F.col("page_id") + 1000)
    odd = spark.createDataFrame([(5000, None, None), (5001, "http://x/\r\ny", ""), (None, "u", "alone"), (5003, "u", "é\U0001F600" * 200_000), (5004, "u", "\r\n\r\nWARC/1.1"), (5005, "v", "é\U0001F600" * 200_000)], "page_id long, url string, html string")
    docs = pages.unionByName(again).unionByName(odd)
    files = warc.write_archive(clashing(docs), scratch_dir(spark, "warc"))
    got = warc.read_archive(files)
    assert Counter(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())) == archived(docs)
    assert got.where("not digest_ok").count() == 0
    assert warc.archive(pages.limit(0)).count() == 0


def test_dictionary_leads_the_file(tmp_path):
    out = warc.Writer(f"{tmp_path}/a.warc.zst")
    made = [warc.record(i, f"http://x/{i}", prose(i % 40, 900).encode() + str(i).encode(), None) for i in range(600)]
    for r in made:
        out.add(r)
    out.close()
    raw = open(out.name, "rb").read()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == warc.DICTIONARY_FRAME and raw[8:12] == bytes.fromhex("37a430ec") and raw[8 + size:12 + size] == bytes.fromhex("28b52ffd")
    assert [int(h["X-Page-Id"]) for h, _ in warc.read_records(out.name)] == list(range(600))


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def near(docs, threshold=0.8):
    sets = [(d, shingles(t)) for d, t in docs]
    links, up = Counter(), list(range(len(sets)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, x) in enumerate(sets):
        for j in range(i):
            y = sets[j][1]
            both = len(x & y)
            if x and y and both >= threshold * (len(x) + len(y) - both):
                links[i] += 1
                links[j] += 1
                up[max(top(i), top(j))] = min(top(i), top(j))
    classes = defaultdict(list)
    for i, (d, _) in enumerate(sets):
        classes[top(i)].append(d)
    name = {c: min((d for d in m if d is not None), default=None) for c, m in classes.items()}
    return Counter((d, name[top(i)], links[i]) for i, (d, _) in enumerate(sets))


def edited(text, places):
    w = text.split(" ")
    for p in places:
        w[p] = "edited"
    return " ".join(w)


def test_chosen_paths_find_every_link(spark, odd, none, documents):
    base = prose(70, 200)
    docs = odd.unionByName(documents([(200 + i, edited(base, [i])) for i in range(150)] + [(400 + i, edited(prose(80 + i, 60), [5])) for i in range(20)] + [(430 + i, prose(80 + i, 60)) for i in range(20)] + [(460, base), (461, base)]))
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    got = Counter(map(tuple, chosen_path.join(clashing(docs)).select("doc_id", "class_id", "n_links").collect()))
    assert got == near(rows)
    assert chosen_path.join(none).count() == 0
    kept = chosen_path.keep_one(clashing(docs))
    assert kept.columns == clashing(docs).columns
    ids = Counter(r[0] for r in kept.select("doc_id").collect())
    assert ids == Counter([1, 2, 3, None, 4, None, 6, 7, 8, -9, 200, *range(400, 420), *([] if near(rows)[430, 400, 1] else range(430, 450))])


def test_blocks_and_slices_agree_with_plain_sets():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, 40)) for _ in range(30)]
    wanted = np.triu(np.ones((30, 30), bool), 1)
    got = verify.intersections(sets, wanted, width=7)
    assert all(got[i, j] == len(set(sets[i]) & set(sets[j])) for i in range(30) for j in range(i))
    groups = [np.unique(rng.integers(0, 12, 4)) for _ in range(30)]
    own = verify.owned_pairs(groups, 6, np.zeros(30, int), False)
    assert all(own[i, j] == (not any(g < 6 for g in set(groups[i]) & set(groups[j]))) for j in range(30) for i in range(j))


def test_passages_that_documents_share(documents, odd, none):
    passage = prose(900, 60) + "."
    rows = [(600, prose(601, 80) + ". " + passage), (601, passage + " " + prose(602, 70)), (602, prose(603, 30) + ".\n" + passage + "\n" + prose(604, 30)), (603, prose(605, 120)), (604, prose(606, 90) + ".\n" + prose(606, 90))]
    found = paragraphs.repeats(clashing(odd.unionByName(documents(rows))))
    got = {r["doc_id"]: r for r in paragraphs.per_document(found).collect()}
    assert set(got) == {4, 5, 600, 601, 602}
    assert got[600]["n_removed"] == 0 and got[601]["n_removed"] >= 20 and 600 in got[602]["first_docs"]
    cut = {r["doc_id"]: r["text"] for r in paragraphs.remove(clashing(documents(rows)), found).collect()}
    assert cut[600] == rows[0][1] and cut[603] == rows[3][1] and len(cut[602].split()) <= 100 and prose(604, 30) in cut[602]
    assert paragraphs.per_document(paragraphs.repeats(none)).count() == 0


def test_similar_passages_are_clustered(documents):
    words = prose(950, 45)
    rows = [(700, words), (701, edited(words, [43])), (702, prose(951, 45))]
    assert {r["doc_id"] for r in paragraphs.per_document(paragraphs.repeats(documents(rows))).collect()} == {700, 701}


def bare(seed, n):
    return prose(seed, n).replace(".", "")


def test_passages_without_lines_or_sentences_of_their_own(documents):
    wrapped = lambda words, n: "\n".join(" ".join(words[i:i + n]) for i in range(0, len(words), n))
    words = {k: bare(970 + k, 50).split() for k in range(3)}
    rows = [
        (800, wrapped(bare(980, 13).split() + words[0], 7)), (801, wrapped(words[0] + bare(981, 40).split(), 11)),  # lines of under 20 words
        (802, f"{bare(982, 60)} {' '.join(words[1])} {bare(983, 60)}"), (803, f"{bare(984, 90)}, {' '.join(words[1])}\u0964 {bare(985, 33)}"),  # one long line
        (804, f"{bare(986, 9)} {' '.join(words[2])} {bare(987, 70)}. {bare(988, 60)}."), (805, f"{bare(989, 30)}. {bare(990, 5)} {' '.join(words[2])} {bare(991, 80)}."),  # inside a sentence
        (806, wrapped(bare(992, 200).split(), 9)), (807, bare(993, 25) + "\n"), (808, wrapped(bare(993, 25).split(), 6)),
    ]
    found = paragraphs.repeats(documents(rows))
    assert {r["doc_id"]: r["first_docs"] for r in paragraphs.per_document(found).collect()} == {800: [], 801: [800], 802: [], 803: [802], 804: [], 805: [804], 807: [], 808: [807]}


def test_a_mark_is_counted_by_more_than_its_bit(spark):
    """What shares a bit of the table with another mark is not held by several documents for that."""
    codes = [5 << 36, (5 << 36) + (1 << 30), 9 << 36, 9 << 36, (1 << 62) + (7 << 36), 11 << 36, (11 << 36) + (3 << 24)]
    marks = np.asarray([(c << 1) * int(paragraphs.INVERSE) % (1 << 64) for c in codes], np.uint64).view(np.int64).tolist()
    assert paragraphs._codes(0, np.asarray(marks)).tolist() == codes
    rows = spark.createDataFrame([(m,) for m in marks], "mark bigint").repartition(3)
    table = paragraphs._opened(paragraphs.several(paragraphs.marked(rows, lambda batch: iter([paragraphs._codes(0, np.asarray(batch.column("mark")))]))))
    assert np.flatnonzero(np.unpackbits(table, bitorder="little")).tolist() == [9]
    assert paragraphs._read(table, paragraphs._bits(0, np.asarray(marks))).tolist() == [False, False, True, True, False, False, False]


def test_texts_behind_one_another_are_cut_as_by_themselves():
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, kinds, n).astype(np.uint64) for n in (0, 1, 4, 5, 18, 19, 20, 21, 49, 50, 51, 80, 300) for kinds in (1, 2, 5, 1 << 40)] * 2
    texts = [texts[i] for i in rng.permutation(len(texts))]
    h, ends = np.concatenate(texts), np.cumsum([len(t) for t in texts])
    (a, b), (first, last, seeds) = paragraphs.anchored(h, ends), paragraphs.contexts(h, ends, 19)
    together = sorted(zip(a, b, paragraphs._contents(h, (a, b))[0])), list(zip(first, last, seeds))
    alone = [], []
    for t, end in zip(texts, ends):
        if len(t):
            x, y = paragraphs.anchored(t, np.asarray([len(t)]))
            alone[0].extend(zip(x + end - len(t), y + end - len(t), paragraphs._contents(t, (x, y))[0]))
            alone[1].extend(zip(*(z + end - len(t) for z in paragraphs.contexts(t, np.asarray([len(t)]), 19))))
            assert len(x) >= (len(t) >= 5) and (len(t) < 20 or all(0 <= i <= len(t) - 20 for i in x))
    assert together == (sorted(alone[0]), alone[1]) and len(together[0]) > 50


def test_what_is_written_between_goes_again(documents, spark):
    import os

    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    found = paragraphs.repeats(documents([(1, bare(1400, 60)), (2, bare(1401, 9) + " " + bare(1400, 60)), (3, bare(1402, 30))]))
    assert {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before} == {"paragraphs", "clusters", "stretches", "edges"}
    assert {r["doc_id"] for r in paragraphs.per_document(found).collect()} == {1, 2}


def test_short_texts_are_one_paragraph(documents):
    rows = [(820, bare(1000, 19)), (821, bare(1000, 19)), (822, bare(1001, 5)), (823, bare(1001, 5)), (824, bare(1002, 4)), (825, bare(1002, 4)), (826, bare(1003, 12))]
    assert {r["doc_id"] for r in paragraphs.per_document(paragraphs.repeats(documents(rows))).collect()} == {820, 821, 822, 823}


def test_paragraphs_against_all_pairs(documents):
    """Every pair of paragraphs of two documents, by plain sets."""
    import random

    draw = random.Random(8)
    passages = [bare(1100 + k, 70) for k in range(4)]
    rows = [(900 + i, " ".join([bare(1200 + i, draw.randint(5, 60)), edited(draw.choice(passages), [draw.randrange(70)]) if i % 3 else "", bare(1300 + i, draw.randint(0, 30))])) for i in range(40)]
    cuts = {}
    for d, t in rows:
        words = t.split()
        starts, ends = paragraphs.spans(fingerprints.Hasher().words(t.encode()))
        cuts[d] = [{tuple(words[i:i + 5]) for i in range(a, b - 4)} for a, b in zip(starts.tolist(), ends.tolist())]
    alike = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    want = {d for d in cuts if any(alike(a, b) for e in cuts if e != d for a in cuts[d] for b in cuts[e])}
    got = {r["doc_id"] for r in paragraphs.per_document(paragraphs.repeats(documents(rows))).collect()}
    assert got <= want and len(got) >= 0.95 * len(want) and len(want) > 20


def test_fifty_common_words_hold_a_common_paragraph():
    rng = np.random.default_rng(12)
    for kinds in (2, 5, 1 << 40):  # also texts of few words, which repeat themselves
        for _ in range(200):
            common = rng.integers(0, kinds, 50)
            held = []
            for _ in range(2):
                before = int(rng.integers(0, 90))
                words = np.concatenate([rng.integers(0, kinds, before), common, rng.integers(0, kinds, int(rng.integers(0, 90)))])
                a, b = paragraphs.spans(words.astype(np.uint64))
                held.append({(x - before, y - before) for x, y in zip(a.tolist(), b.tolist()) if x >= before and y <= before + 50})
            assert held[0] & held[1]


@pytest.mark.parametrize("n", [20, 27, 34])
def test_passages_of_under_fifty_words(documents, n):
    rows = [(1400 + 2 * k + i, f"{bare(1500 + 4 * k + i, 17 + 3 * k)} {bare(1600 + k, n)} {bare(1700 + 4 * k + i, 40 - k)}") for k in range(8) for i in (0, 1)]
    got = {r["doc_id"]: r for r in paragraphs.per_document(paragraphs.repeats(documents(rows))).collect()}
    assert set(got) == {d for d, _ in rows}
    assert all(n <= r["n_repeated"] <= n + 2 and r["n_removed"] == d % 2 * r["n_repeated"] and r["first_docs"] == [d - 1] * (d % 2) for d, r in got.items())


def test_windows_at_every_place_against_brute_force(documents, odd):
    """Every 19 words in a row, of texts of few kinds of words and many borders too."""
    import random

    draw = random.Random(21)
    passages = [bare(1800 + k, 60).split() for k in range(3)] + [["a", "b", "a"] * 20]
    part = lambda: (lambda w, a: w[a:a + draw.randint(18, 40)])(draw.choice(passages), draw.randint(0, 25))
    rows = [(2000 + i, " ".join([*bare(1900 + i, draw.randint(1, 9)).split(), *part(), *bare(1950 + i, draw.randint(0, 2)).split(), *part()])) for i in range(60)]
    docs = clashing(odd.unionByName(documents(rows)))
    kinds, texts = {}, {(r["doc_id"], r["text"] or "") for r in docs.collect()}
    below = lambda d: (d[0] is not None, d[0] or 0)
    for d in texts:
        w = d[1].split()
        for i in range(len(w) - 18):
            kinds.setdefault(tuple(w[i:i + 19]), {}).setdefault(d, []).append(i)
    want = {}
    for held in kinds.values():
        if len(held) > 1:
            first = min(held, key=below)
            for d, places in held.items():
                want.setdefault(d[0], set()).update((j, first[0], d == first) for i in places for j in range(i, i + 19))
    shared = paragraphs.shared_marks(docs, "doc_id", "text", 3, 19)
    held = paragraphs.paragraphs(docs, "doc_id", "text", 3, 19, shared).where("seed IS NOT NULL")
    found = paragraphs.equal_windows(docs, "doc_id", "text", held, 19, shared)
    got = {}
    for r in found.collect():
        got.setdefault(r["doc_id"], set()).update((j, r["first_doc_id"], r["first"]) for j in range(r["start"], r["stop"]))
    assert got == want and len(want) > 50


def test_pipeline_against_brute_force(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, out = docs, corpus_pipeline.materialise(stage(spark, docs, sf), name)
        assert out.columns == before.columns
        if name == "language_id":
            assert {r[0] for r in out.select("doc_id").collect()} == {r[0] for r in before.where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}
        if name == "near_duplicates":
            classes = near([(r["doc_id"], r["text"]) for r in before.collect()])
            assert {r[0] for r in out.select("doc_id").collect()} == {d for d, c, _ in classes if d == c}
        docs = out
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_foreign_texts_and_gibberish_go_and_clean_ones_stay(spark):
    import random

    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    draw = random.Random(1)
    strange = [
        (10**9, "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä."),
        (10**9 + 1, "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa."),
        (10**9 + 2, " ".join("".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, 9))) for _ in range(200))),
    ]
    mixed = docs.unionByName(spark.createDataFrame(strange, "doc_id bigint, text string"), allowMissingColumns=True)
    kept = Counter(r[0] for r in corpus_pipeline.identify_language(spark, mixed, "").select("doc_id").collect())
    assert kept == Counter(r[0] for r in docs.where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect())


@pytest.mark.parametrize("n", [0, 1, 7, 4000])
def test_shingles_and_sketches_of_any_length(n):
    h = np.arange(n, dtype=np.int64) * 7919
    assert len(chosen_path.shingle_set(h)) == (0 if n == 0 else max(1, n - 4))
    assert len(chosen_path.sketch(chosen_path.shingle_set(h))) == chosen_path.SAMPLE
