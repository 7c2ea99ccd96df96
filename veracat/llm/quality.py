"""Quality rules as a ledger: every rule is evaluated once into a bit, policies are masks over the bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracat.llm.common import grams, let, whole, without, words
from veracat.session import materialise

WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

# Rule name to its failing condition over the measures. The position in this list is the bit, so new rules
# are only ever appended.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 25 * n_words"),
)
# A policy version is the set of rules that reject; a published version never changes.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": ("too_few_words", "repeated_windows", "symbols", "repeated_lines", "short_words", "long_words"),
}


def bit(rule: str) -> int:
    return 1 << [name for name, _ in RULES].index(rule)


def mask(policy: str) -> int:
    return sum(bit(rule) for rule in POLICIES[policy])


def repeated_words(items: Column, n: int = WINDOW) -> Column:
    """How many items lie in a window of n that stands twice or more in the list.

    The window hashes are sorted with their places, so equal ones are neighbours; the places of those are
    sorted again and each adds what it reaches beyond the place before it. That is n log n for any text.
    """
    hashes = grams(items, n)
    marked = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def equal_to(a: Column, at: Column, b: Column) -> Column:
        return F.coalesce(F.get(b, at)["h"] == a["h"], F.lit(False))

    def places(ordered: Column) -> Column:
        met = F.filter(ordered, lambda x, i: equal_to(x, i - 1, ordered) | equal_to(x, i + 1, ordered))
        return F.array_sort(F.transform(met, lambda x: x["i"]))

    def reach(at: Column) -> Column:
        return F.aggregate(at, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")), lambda s, p: F.struct((s["n"] + (p + n - F.greatest(p, s["end"]))).cast("bigint").alias("n"), (p + n).alias("end")), lambda s: s["n"])

    # Most texts repeat no window; these need no sort.
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(some, let(F.sort_array(marked), lambda o: let(places(o), reach))).otherwise(F.lit(0).cast("bigint"))


def measures(text: str) -> dict[str, Column]:
    """Expressions over a struct-free frame with the columns ``w`` (words) and ``t`` (text, NULL as empty)."""
    symbols = "#*$%&|<>"
    lines = F.filter(F.split(F.col("t"), "\n"), lambda x: F.translate(x, " \t\n\x0b\f\r", "") != "")
    return {
        "n_words": F.size("w").cast("bigint"),
        "word_chars": F.length(F.translate("t", " \t\n\x0b\f\r", "")).cast("bigint"),
        "n_symbols": (F.length("t") - F.length(F.translate("t", symbols, ""))).cast("bigint"),
        "n_lines": F.size(lines).cast("bigint"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
        "n_repeat_words": repeated_words(F.col("w")),
    }


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, the measures, and ``failures``, a bit for every rule that fails.

    A NULL or blank text has no words and fails ``too_few_words``. Rows are independent, so there is no
    shuffle; repeated rows get the same entry.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("t"), words(text).alias("w"))
    m = measures(text)
    measured = base.select("doc_id", *[m[c].alias(c) for c in MEASURES])
    failures = F.lit(0).cast("bigint")
    for name, failing in RULES:
        failures = failures.bitwiseOR(F.when(F.expr(failing), F.lit(bit(name)).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return measured.withColumn("failures", failures)


def stored_ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The ledger, written once to the shared folder: policies and ablations read its bits and never the texts."""
    return materialise(ledger(docs, doc_id, text), "ledger")


def apply_policy(entries: DataFrame, policy: str) -> DataFrame:
    """The ledger with ``policy`` and ``kept``: no bit of the policy is set. The texts are not read again."""
    return without(entries, "kept", "policy").withColumn("policy", F.lit(policy)).withColumn("kept", F.col("failures").bitwiseAND(F.lit(mask(policy)).cast("bigint")) == 0)


def ablations(entries: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents that the policy would keep without it."""
    under = F.col("failures").bitwiseAND(F.lit(mask(policy)).cast("bigint"))
    counts = entries.select(under.alias("f")).groupBy("f").agg(F.count("*").alias("n"))  # one row per bit pattern
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("bigint").alias("b")) for r in POLICIES[policy]])
    spread = counts.select("f", "n", F.explode(rules).alias("r")).select("f", "n", "r.rule", "r.b")
    return spread.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(F.col("f").bitwiseAND(F.col("b")) != 0, F.col("n"))), F.lit(0)).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("f") == F.col("b"), F.col("n"))), F.lit(0)).alias("only_this"),
    )


SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n
  FROM (SELECT r, i, w[i:i + 4] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w))
), repeated AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM windows, (SELECT unnest(range(0, 5)) AS k) WHERE n > 1 GROUP BY r
), lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM w) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT w.doc_id, len(w.w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM w LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words) AS kept,
       n_lines::BIGINT AS n_lines, 'v1' AS policy,
       ((n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT + 4 * (10 * n_symbols > n_words)::BIGINT
        + 8 * (100 * n_dup_lines > 30 * n_lines)::BIGINT + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 25 * n_words)::BIGINT)::BIGINT AS failures
FROM m
"""
