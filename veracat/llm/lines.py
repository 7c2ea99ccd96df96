"""Line dedup: a suffix array over line ids by prefix doubling, and the repeated line runs that it reveals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracat.llm.common import light, running_sum, whole
from veracat.session import discard, materialise, materialise_in_buckets

#: Lines of a run that counts as repeated, at least: a line that stands alone between others is a run too.
LEAST = 1


#: Rows of a task that follow one another and are one block, as a power of two.
BLOCK = 13


def numbered(rows: DataFrame) -> DataFrame:
    """The rows, written once, with ``doc``, a number for each that counts on inside a task, and ``block``, that number
    less its last ``BLOCK`` bits. The rows of a block lie in one bucket."""
    # As many as a shuffle's partitions: fewer would have Spark move the rows after all.
    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = rows.withColumn("doc", F.monotonically_increasing_id())
    return materialise_in_buckets(known.withColumn("block", F.shiftright("doc", BLOCK)), "rows", "block", buckets)


def line_table(rows: DataFrame) -> DataFrame:
    """(doc, doc_id, size, place, line, h, h2): the lines of every row that hold a word, numbered from 0 to ``size``.

    Blank lines are no part of the sequence. ``h`` and ``h2`` are the line's id, two hashes of the whole line with
    128 bits together.
    """
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), F.xxhash64(x).alias("h"), F.xxhash64(F.lit("second"), x).alias("h2"), x.rlike(r"[^\x20\x09-\x0D]").alias("full")))
    full = rows.select("doc", "doc_id", F.filter(lines, lambda x: x["full"]).alias("lines"))
    return materialise(full.select("doc", "doc_id", F.size("lines").alias("size"), F.posexplode("lines").alias("place", "x")).select("doc", "doc_id", "size", "place", "x.line", "x.h", "x.h2"), "lines")


def suffix_array(lines: DataFrame) -> DataFrame:
    """(doc, place, doc_id, slot, h): the order of the suffixes that start with a line that occurs twice.

    Suffixes are compared by line ids; one ends at the end of its document, which comes first. A line that occurs
    once comes next, ordered by its place: it tells a suffix apart from all others, so only its kind is needed.
    ``slot`` is the place of a suffix's class, equal only for suffixes that are equal to their ends. A round doubles
    the length by which suffixes are told apart: a class is split by the class of the suffix that starts where its
    own length ends. Only classes of several suffixes take part, so a round shrinks to what is still alike. The pairs
    of classes are counted before they are ordered, so a line of a third of the rows is one row there.

    A suffix is looked up from its own document alone, so once a document has no class of several left, its suffixes
    leave the table that rounds look up. From the first round on ``h`` is the class of the first line.
    """
    repeated = materialise(lines.groupBy("h", "h2").agg(F.count("*").alias("n")).where("n > 1").transform(light), "repeated")
    slots = running_sum(repeated, ["h", "h2"], "n", "slot").select("h", "h2", "n", "slot")
    now = materialise(lines.join(slots, ["h", "h2"]).select("doc", "doc_id", "size", "place", F.col("slot").alias("h"), "slot", "n"), "suffixes")
    done, looked, length = None, None, 1
    while True:
        active, settled = now.where("n > 1"), now.where("n = 1").drop("n")
        done = settled if done is None else done.unionByName(settled)
        if active.isEmpty():
            return done.select("doc", "place", "doc_id", "h", "slot")
        still = settled.select("doc", "place", "slot")
        still = (still if looked is None else still.unionByName(looked)).join(active.select("doc").distinct(), "doc", "left_semi")
        before, looked = looked, materialise(light(still), "looked")
        if before is not None:
            discard(before)
        known = looked.unionByName(active.select("doc", "place", "slot"))
        ahead = known.select(F.col("doc").alias("d"), (F.col("place") - length).alias("p"), F.col("slot").alias("next"))
        paired = active.drop("n").join(ahead, (F.col("doc") == F.col("d")) & (F.col("place") == F.col("p")), "left").drop("d", "p")
        kind = F.when(F.col("next").isNotNull(), 2).when(F.col("place") + length >= F.col("size"), 0).otherwise(1)
        own = F.when(kind == 1, F.struct("doc", "place"))
        paired = materialise(paired.select("*", kind.alias("kind"), F.coalesce("next", F.lit(0)).alias("key"), own.alias("own")).drop("next").transform(light), "pairs")
        classes = materialise(paired.groupBy("slot", "kind", "key", "own").agg(F.count("*").alias("n")).transform(light), "classes")
        moved = running_sum(classes, ["slot", "kind", "key", "own"], "n", "before")
        base = moved.groupBy("slot").agg(F.min("before").alias("base"))
        moved = moved.join(base, "slot").select(F.col("slot").alias("s"), F.col("kind").alias("k"), F.col("key").alias("y"), F.col("own").alias("o"), "n", (F.col("slot") + F.col("before") - F.col("base")).alias("new"))
        same = (F.col("slot") == F.col("s")) & (F.col("kind") == F.col("k")) & (F.col("key") == F.col("y")) & F.col("own").eqNullSafe(F.col("o"))
        # Suffixes that have all ended are equal to their ends and stay one class.
        n = F.when(F.col("kind") == 2, F.col("n")).otherwise(F.lit(1).cast("bigint"))
        now = materialise(paired.join(moved, same).select("doc", "doc_id", "size", "place", "h", F.col("new").alias("slot"), n.alias("n")).transform(light), "suffixes")
        discard(paired, classes)
        length *= 2


def neighbours(order: DataFrame) -> DataFrame:
    """(doc, place, doc_id, rank, lcp): the suffixes in order, each with the length of the prefix that it shares
    with the one before it.

    A suffix whose line before it is the same as its neighbour's shares one line less than the suffix before it
    does; only the others are compared line by line, over offsets that double until all have found their end. The
    sum of their lengths is at most n log n for n lines.
    """
    keyed = order.withColumn("one", F.lit(1).cast("bigint"))
    ranked = materialise(running_sum(keyed, ["slot", "doc_id", "doc", "place"], "one", "rank").drop("one"), "ranked")
    before = ranked.select((F.col("rank") + 1).alias("rank"), F.col("doc").alias("doc2"), F.col("place").alias("place2"), F.col("h").alias("h2"))
    pairs = materialise(ranked.join(before, "rank").where(F.col("h") == F.col("h2")).select("rank", "doc", "place", "doc2", "place2"), "pairs")
    # Lines that occur once are not here, and share nothing.
    of = ranked.select(F.col("doc").alias("a"), F.col("place").alias("i"), "h")
    left = pairs.join(of, (F.col("doc") == F.col("a")) & (F.col("place") - 1 == F.col("i")), "left").select("rank", "doc", "place", "doc2", "place2", F.col("h").alias("left"))
    left = left.join(of, (F.col("doc2") == F.col("a")) & (F.col("place2") - 1 == F.col("i")), "left").select("rank", "doc", "place", "doc2", "place2", (F.col("left") == F.col("h")).alias("same"))
    left = materialise(left.withColumn("same", F.coalesce("same", F.lit(False))), "left")
    open_, known, start, width = left.where("not same").select("rank", "doc", "place", "doc2", "place2"), None, 1, 4
    while True:
        offsets = open_.withColumn("k", F.explode(F.sequence(F.lit(start), F.lit(start + width - 1))))
        met = offsets.join(of, (F.col("doc") == F.col("a")) & (F.col("place") + F.col("k") == F.col("i")), "left").select("rank", "k", "doc2", "place2", F.col("h").alias("x"))
        met = met.join(of, (F.col("doc2") == F.col("a")) & (F.col("place2") + F.col("k") == F.col("i")), "left").select("rank", "k", (F.col("x") == F.col("h")).alias("equal"))
        ends = materialise(met.groupBy("rank").agg(F.min(F.when(~F.coalesce("equal", F.lit(False)), F.col("k"))).alias("lcp")).transform(light), "ends")
        found = ends.where("lcp is not null")
        known = found if known is None else known.unionByName(found)
        rest = ends.where("lcp is null").select("rank")
        if rest.isEmpty():
            break
        open_, start, width = materialise(open_.join(rest, "rank"), "open"), start + width, width * 2
    measured = left.select("rank", "doc", "place").join(known, "rank", "left")
    # Along a document a shared prefix loses a line a step until the next one that was compared.
    last = F.last(F.col("lcp") + F.col("place"), ignorenulls=True).over(Window.partitionBy("doc").orderBy("place"))
    all_ = measured.select("rank", (last - F.col("place")).cast("bigint").alias("lcp"))
    return materialise(ranked.join(all_, "rank", "left").select("doc", "place", "doc_id", "rank", F.coalesce("lcp", F.lit(0).cast("bigint")).alias("lcp")), "neighbours")


def repeated_runs(lines: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc, place) of every line inside a later copy of a run of ``least`` lines or more.

    In suffix order the suffixes between two shared prefixes shorter than ``least`` are one interval: they start
    with the same run. Its first occurrence, by (doc_id, row as read, place) with NULL ids first, stays; the
    lines of all others are marked. Overlapping copies inside a document are copies too.
    """
    ordered = neighbours(suffix_array(lines))
    heads = running_sum(ordered.withColumn("head", F.when(F.col("lcp") < least, 1).otherwise(0).cast("bigint")), ["rank"], "head", "before")
    interval = materialise(heads.select("doc", "place", F.struct("doc_id", "doc", "place").alias("at"), (F.col("before") + F.col("head")).alias("interval"), "lcp"), "intervals")
    per = interval.groupBy("interval").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1")
    later = interval.join(per, "interval").where("at <> first")
    return materialise(later.select("doc", F.explode(F.sequence(F.col("place"), F.col("place") + (least - 1))).alias("place")).distinct(), "marked")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per row of ``docs``: doc_id, text (less the later copies of repeated line runs), n_lines (lines with a
    word), n_removed. A NULL text becomes an empty one; blank lines stay. Rows repeated in id and text are copies
    of each other, and all but one of them lose their runs. A text of any length is taken whole. An empty table gives
    no rows; other columns are ignored.

    The ids and texts are written once, with a number for each row, which later steps refer to. The texts stay where
    they are written: what is told about the rows of a block is one row, which goes to them.
    """
    rows = numbered(docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text")))
    lines = line_table(rows)
    marked = repeated_runs(lines, least)
    n_lines = lines.groupBy("doc").agg(F.max("size").cast("bigint").alias("n_lines"))
    cut = marked.join(lines, ["doc", "place"]).groupBy("doc").agg(F.array_sort(F.collect_list("line")).alias("cut"))
    # A flag for every line up to the last one that goes: the gaps between those, each followed by one.
    gap = lambda c, i: c - F.coalesce(F.get("cut", i - 1), F.lit(-1)) - 1
    flags = F.flatten(F.transform("cut", lambda c, i: F.concat(F.array_repeat(F.lit(False), gap(c, i)), F.array(F.lit(True)))))
    told = n_lines.join(cut.select("doc", F.size("cut").cast("bigint").alias("n_removed"), flags.alias("flags")), "doc", "left")
    # Rows of a block are numbered from 0 without a gap, so a row finds its own by its number.
    every = rows.select("doc").join(told, "doc", "left").select(F.shiftright("doc", BLOCK).alias("of"), F.struct("doc", "n_lines", "n_removed", "flags").alias("x"))
    per_block = materialise(every.groupBy("of").agg(F.array_sort(F.collect_list("x")).alias("told")), "told").hint("shuffle_hash")
    own = F.get("told", F.col("doc").bitwiseAND((1 << BLOCK) - 1).cast("int"))
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.coalesce(F.get("flags", i), F.lit(False))), "\n")
    zero = F.lit(0).cast("bigint")
    out = rows.join(per_block, F.col("block") == F.col("of"), "left").select("doc_id", "text", own["n_lines"].alias("n_lines"), own["n_removed"].alias("n_removed"), own["flags"].alias("flags"))
    return out.select("doc_id", F.when(F.col("flags").isNotNull(), left).otherwise(F.col("text")).alias("text"), F.coalesce("n_lines", zero).alias("n_lines"), F.coalesce("n_removed", zero).alias("n_removed"))


SQL = r"""
WITH l AS (
  SELECT r, doc_id, unnest(range(0, len(ls))) AS line, unnest(ls) AS x
  FROM (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), s AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY line) AS place FROM l WHERE regexp_matches(x, '[^ 	-
]')
), again AS (
  SELECT r, line, row_number() OVER (PARTITION BY x ORDER BY doc_id NULLS FIRST, r, place) AS nth FROM s
), cut AS (
  SELECT r, line FROM again WHERE nth > 1
), n AS (SELECT r, count(*) AS n_lines FROM s GROUP BY r), c AS (SELECT r, count(*) AS n_removed FROM cut GROUP BY r)
SELECT doc_id, coalesce(any_value(n_lines), 0)::BIGINT AS n_lines, coalesce(any_value(n_removed), 0)::BIGINT AS n_removed,
       md5(coalesce(string_agg(x, chr(10) ORDER BY line) FILTER (WHERE cut.r IS NULL), '')) AS text_md5
FROM l LEFT JOIN cut USING (r, line) LEFT JOIN n USING (r) LEFT JOIN c USING (r) GROUP BY r, doc_id
"""
