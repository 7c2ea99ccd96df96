"""Conversation structure repair: weighted CYK parsing over spans of turns, with minimum (cost, audit) cells."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from veracat.operators.ordering import ranked
from veracat.session import materialise

# Fixed: what an edit costs, by its initial; a truncated row that is not deleted costs one more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# Fixed: the roles that an edit can give, by their initials, and the pairs of initials that may be neighbours.
GIVEN = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
# Where a parse stands: 0 before any turn, then behind the turn of that initial; what may follow; and where it may end.
MOVES = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
STATES, ENDS = "0sua", ("0", "a")
#: Rows of a span that one task parses at once, and spans that are combined into one.
CHUNK = 4096
FAN = 16

Cell = dict[tuple[str, str], tuple[int, str]]


def better(cell: Cell, pair: tuple[str, str], cost: int, audit: str) -> None:
    if pair not in cell or (cost, audit) < cell[pair]:
        cell[pair] = (cost, audit)


def combined(left: Cell, right: Cell) -> Cell:
    """The binary rules [p to q] -> [p to r] [r to q] over two neighbouring spans."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            if (r, q) in right:
                more, rest = right[r, q]
                better(out, (p, q), cost + more, audit + rest)
    return out


@cache
def insertions() -> Cell:
    """The insertion closure: the cheapest insertions that lead from one state to another over no row at all."""
    cell: Cell = {(p, p): (0, "") for p in STATES}
    for (p, initial), q in MOVES.items():
        if initial in GIVEN:
            better(cell, (p, q), INSERT, "I")
    while (wider := combined(cell, cell)) != cell:
        cell = wider
    return cell


def closed(cell: Cell) -> Cell:
    return combined(combined(insertions(), cell), insertions())


@cache
def row_cell(initial: str, must_go: bool, truncated: bool) -> Cell:
    """The rules over one row: kept, given a role, or deleted, with insertions before and behind it."""
    cell: Cell = {(p, p): (DELETE, "D") for p in STATES}
    if not must_go:
        for (p, x), q in MOVES.items():
            if x == initial:
                better(cell, (p, q), KEEP + TRUNCATED * truncated, "K")
            if x in GIVEN:
                better(cell, (p, q), REROLE + TRUNCATED * truncated, "R")
    return closed(cell)


def deleted(n: int) -> Cell:
    return closed({(p, p): (DELETE * n, "D" * n) for p in STATES})


def spanned(cells: list[Cell]) -> Cell:
    """One cell over all the spans, from pairs of neighbours to pairs of pairs.

    Every state pair is a nonterminal, so any split of a span yields all its parses, and one split a span is enough.
    Two parses of a span with equal cost hold as many letters of rows and as many insertions, so none is the start of
    the other, and the least of a span is the least of its parts put together.
    """
    while len(cells) > 1:
        cells = [combined(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else insertions()


def best(cell: Cell) -> tuple[int, str]:
    return min(cell["0", q] for q in ENDS if ("0", q) in cell)


def repaired(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The (role, text) that the edits of an audit make of rows, in order."""
    state, at = "0", 0

    def given() -> str:
        nonlocal state
        state = "a" if state == "u" else "u"
        return GIVEN[state]

    for role, text in rows:
        while audit[at] == "I":
            yield given(), ""
            at += 1
        if audit[at] == "R":
            yield given(), text
        elif audit[at] == "K":
            state = role[:1]
            yield role, text
        at += 1
    for _ in audit[at:]:
        yield given(), ""


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of (conv_id, turn, role, text) after damage, equal ones counted in ``n``; a dropped row leaves a NULL role.

    NULLs of role and text become one space. The damage goes by crc32 of ``conv_id:turn``, so equal rows share it.
    """
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fate = F.crc32(F.concat_ws(":", *part)) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("fate"))
    changed = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    stays = F.col("fate") != 0
    return rows.select(
        "conv_id", F.when(stays, F.col("turn")).alias("turn"), F.when(stays, F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))).alias("role"),
        F.when(stays, changed).alias("text"), F.when(F.col("fate") == 3, 2).otherwise(1).cast("bigint").alias("n"),
    ).groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("digest", F.md5("text"))


def faults(runs: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, n, initial, blank, first, truncated) of what ``damaged`` gives, without the texts.

    ``first`` tells whether the first of the equal rows is the first of its role and text in the conversation: that is
    looked up as one row for each role and text, joined on the turn as well, so a text that a conversation repeats
    without end meets as many keys as it has turns.
    """
    rows = runs.filter("role IS NOT NULL")
    said = r"[^\x20\x09-\x0D]"
    light = rows.select(
        "conv_id", "turn", "role", "digest", "n", F.substr("role", F.lit(1), F.lit(1)).alias("initial"), (~F.col("text").rlike(said)).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
    )
    firsts = light.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.max(F.col("turn").isNull()).alias("unknown"), F.min("turn").alias("least"))
    firsts = firsts.select("c", "r", "d", F.when(~F.col("unknown"), F.col("least")).alias("t"), F.lit(True).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")) & F.col("turn").eqNullSafe(F.col("t"))
    return light.join(firsts, same, "left").drop("c", "r", "d", "t").withColumn("first", F.coalesce("first", F.lit(False)))


COUNTS = ("turns", "blank", "duplicate", "truncated", "illegal")


def _encoded(cell: Cell) -> list[dict]:
    return [{"pair": p + q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in cell.items()]


def _decoded(cell: list[dict]) -> Cell:
    return {(x["pair"][0], x["pair"][1]): (x["cost"], x["audit"]) for x in cell}


def _chunk(rows: list[dict]) -> dict:
    """What a chunk of a conversation's rows comes to; turns do not fall."""
    out = dict.fromkeys(COUNTS, 0) | {"low": None, "high": None, "head": rows[0]["initial"], "tail": rows[-1]["initial"]}
    cells, before = [], None
    for r in rows:
        if r["turn"] is not None:
            out["turns"] += r["turn"] != out["high"]
            out["low"], out["high"] = r["turn"] if out["low"] is None else out["low"], r["turn"]
        if before is not None:
            out["illegal"] += before + r["initial"] not in LEGAL
        out["illegal"] += (r["n"] - 1) * (r["initial"] * 2 not in LEGAL)
        before = r["initial"]
        again = not r["first"]
        out["blank"] += r["n"] * r["blank"]
        out["duplicate"] += 0 if r["blank"] else r["n"] - (not again)
        out["truncated"] += not r["blank"] and not again and r["truncated"]
        cells.append(row_cell(r["initial"], r["blank"] or again, r["truncated"]))
        if r["n"] > 1:
            cells.append(deleted(r["n"] - 1))
    return out | {"cell": _encoded(spanned(cells))}


def _together(parts: list[dict]) -> dict:
    """Chunks that follow each other, as one."""
    out = dict(parts[0])
    for p in parts[1:]:
        for c in COUNTS:
            out[c] += p[c]
        if p["low"] is not None:
            out["turns"] -= out["high"] == p["low"]
            out["low"], out["high"] = p["low"] if out["low"] is None else out["low"], p["high"]
        out["illegal"] += out["tail"] + p["head"] not in LEGAL
        out["tail"] = p["tail"]
    return out | {"cell": _encoded(spanned([_decoded(p["cell"]) for p in parts]))}


def _per_chunk(df: DataFrame, order: str, make, kind: str) -> DataFrame:
    """One row for each (conv_id, chunk), made of its rows in order: a chunk has a bounded number of rows."""
    arrow = pa.schema([
        ("conv_id", to_arrow_type(df.schema["conv_id"].dataType)), ("chunk", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("head", pa.string()), ("tail", pa.string()),
        *((c, pa.int64()) for c in COUNTS), ("cell", pa.list_(pa.struct([("pair", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        rows = (r for batch in batches for r in batch.to_pylist())
        for (conv, chunk), group in groupby(rows, lambda r: (r["conv_id"], r["chunk"])):
            done.append({"conv_id": conv, "chunk": chunk} | make(list(group)))
            if len(done) == 256:
                yield from pa.Table.from_pylist(done, arrow).to_batches()
                done = []
        yield from pa.Table.from_pylist(done, arrow).to_batches()

    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    out = f"conv_id {kind}, chunk bigint, low bigint, high bigint, head string, tail string, {counts}, cell array<struct<pair: string, cost: bigint, audit: string>>"
    dealt = df.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", order)
    return dealt.mapInArrow(run, out)


def parsed(conversations: DataFrame, runs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row for each conversation that has rows after damage: its counts and the cell over all its rows.

    A conversation is cut into chunks of its order, so one that holds much of the table is parsed by many tasks; the
    cells of the chunks are combined by spans that grow by a constant factor a round.
    """
    kind = dict(conversations.dtypes)["conv_id"]
    placed = ranked(faults(runs), ["conv_id"], ["turn", "role", "digest"], "place").withColumn("chunk", F.floor((F.col("place") - 1) / chunk))
    cells = materialise(_per_chunk(placed, "place", _chunk, kind), "cells")
    while (cells.agg(F.max("chunk")).first()[0] or 0) > 0:
        wider = cells.withColumnRenamed("chunk", "part").withColumn("chunk", F.floor(F.col("part") / FAN))
        cells = materialise(_per_chunk(wider, "part", _together, kind), "cells")
    return cells


def repair(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row for each conv_id: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``conversations`` has whole numbers conv_id and turn, and role and text; other columns are ignored. Rows are
    damaged first (see ``damaged``). They are ordered by turn, NULL first; rows of one turn by role, then by the md5
    of their text. Repeated rows are rows: all but the first are duplicates. A NULL conv_id is a conversation of its
    own. Blank texts are faults. One that has no row after damage gives zeros, an empty audit and the hash of nothing.
    An empty table gives no rows.

    The hash of a repaired conversation can only be taken in order: the rows of a conversation pass through one task
    as a sorted stream, of which it holds a batch and the audit.
    """
    kind = dict(conversations.dtypes)["conv_id"]
    runs = materialise(damaged(conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")), "damaged")
    heads = parsed(conversations, runs, chunk)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("bigint"))
    whole = F.filter("cell", lambda x: (x["pair"] == "00") | (x["pair"] == "0a"))
    least = F.array_min(F.transform(whole, lambda x: F.struct(x["cost"].alias("cost"), x["audit"].alias("audit"))))
    found = F.struct(gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", least["cost"].alias("cost"), least["audit"].alias("audit"))
    nothing = F.lit(None)
    # A conversation's findings come before its rows.
    both = heads.select(
        "conv_id", F.lit(0).alias("kind"), nothing.cast("bigint").alias("turn"), nothing.cast("string").alias("role"), nothing.cast("string").alias("digest"),
        nothing.cast("string").alias("text"), nothing.cast("bigint").alias("n"), found.alias("found"),
    ).unionByName(runs.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    sorted_ = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    arrow = pa.schema([("conv_id", to_arrow_type(conversations.schema["conv_id"].dataType)), *((c, pa.int64()) for c in names), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        rows = (r for batch in batches for r in batch.to_pylist())
        for conv, group in groupby(rows, lambda r: r["conv_id"]):
            head = next(group)
            out = head["found"] or dict.fromkeys(names, 0) | {"audit": ""}
            # Without findings every row was dropped.
            stay = ((r["role"], r["text"]) for r in group for _ in range(r["n"]) if r["role"] is not None)
            digest, separator = hashlib.sha256(), ""
            for role, text in repaired(out["audit"], stay if head["found"] else ()):
                digest.update(f"{separator}{role}:{text}".encode("utf-8", "replace"))
                separator = "\n"
            done.append({"conv_id": conv} | out | {"repaired_sha256": digest.hexdigest()})
            if len(done) == 256:
                yield from pa.Table.from_pylist(done, arrow).to_batches()
                done = []
        yield from pa.Table.from_pylist(done, arrow).to_batches()

    counts = ", ".join(f"{c} bigint" for c in names)
    return sorted_.mapInArrow(write, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")


def _least(p: str) -> str:
    """SQL of the best of a row's edits in state p, given the best of the rows behind it in every state."""
    def then(q: str, cost: str, letter: str, line: str) -> str:
        return f"{{'cost': {cost} + f{q}.cost, 'audit': '{letter}' || f{q}.audit, 'out': {line}f{q}.out}}"

    given = "a" if p == "u" else "u"
    edits = [then(p, "3", "D", ""), f"CASE WHEN ok THEN {then(given, '2 + late', 'R', f"'{GIVEN[given]}:' || text || chr(10) || ")} END"]
    edits += [f"CASE WHEN ok AND x = '{x}' THEN {then(q, 'late', 'K', "role || ':' || text || chr(10) || ")} END" for (of, x), q in MOVES.items() if of == p]
    return f"list_sort([{', '.join(edits)}], 'ASC', 'NULLS LAST')[1] AS g{p}"


def _filled(p: str) -> str:
    """SQL of the best in state p with no, one or two insertions in front."""
    a = "a" if p == "u" else "u"
    b = "a" if a == "u" else "u"
    one, two = f"'{GIVEN[a]}:' || chr(10) || ", f"'{GIVEN[b]}:' || chr(10) || "
    return (f"list_sort([g{p}, {{'cost': 2 + g{a}.cost, 'audit': 'I' || g{a}.audit, 'out': {one}g{a}.out}}, "
            f"{{'cost': 4 + g{b}.cost, 'audit': 'II' || g{b}.audit, 'out': {one}{two}g{b}.out}}])[1] AS f{p}")


# The rows of a conversation from the last to the first; crc32 is made bit by bit.
SQL = rf"""
WITH RECURSIVE src AS (
  SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), fates AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(k, ''), lambda c: list_concat([ascii(c)::BIGINT], list_transform(range(8), lambda i: -1::BIGINT))))),
    lambda a, v: CASE WHEN v >= 0 THEN xor(a, v) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295::BIGINT) % 20 AS fate FROM src
), damaged AS (
  SELECT r, conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM fates
), placed AS (
  SELECT conv_id, turn, role, text, role[1:1] AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), r, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, r, copy) AS nth FROM damaged
), judged AS (
  SELECT *, lag(x) OVER (PARTITION BY conv_id ORDER BY i) || x AS pair,
         CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE '' END AS fault FROM placed
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM judged GROUP BY conv_id
), walk AS (
  SELECT conv_id, n + 1 AS i, {{'cost': 0, 'audit': '', 'out': ''}} AS f0, {{'cost': 4, 'audit': 'II', 'out': 'user:' || chr(10) || 'assistant:' || chr(10)}} AS fs,
         {{'cost': 2, 'audit': 'I', 'out': 'assistant:' || chr(10)}} AS fu, {{'cost': 0, 'audit': '', 'out': ''}} AS fa FROM counts
  UNION ALL
  SELECT conv_id, i, {", ".join(map(_filled, STATES))} FROM (
    SELECT conv_id, i, {", ".join(map(_least, STATES))} FROM (
      SELECT w.* EXCLUDE (i), j.i, j.role, j.text, j.x, j.fault NOT IN ('blank', 'duplicate') AS ok, (j.fault = 'truncated')::INTEGER AS late
      FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i - 1))
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(f0.cost, 0)::BIGINT AS cost, coalesce(f0.audit, '') AS audit, sha256(coalesce(left(f0.out, greatest(length(f0.out) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN walk w ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND w.i = 1
"""
