"""Acceptance rules and gates. Three-valued logic is part of each rule: see the docstrings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracat.functions.rules import is_decoy

THRESHOLD = 0.01


def _notch_ok(q_notch: str, t: float) -> Column:
    return F.col(q_notch).isNull() | (F.col(q_notch) <= t)


def accepted_matches(df: DataFrame, label: str = "target_decoy", q: str = "q_value", q_notch: str = "q_value_notch",
                     ambiguous: str = "notch_ambiguous", t: float = THRESHOLD) -> DataFrame:
    """Target, q at most t, second q absent or at most t, and not known to be ambiguous."""
    return df.filter((F.col(label) == "target") & (F.col(q) <= t) & _notch_ok(q_notch, t) & ~F.coalesce(F.col(ambiguous), F.lit(False)))


def form_rule(label: str = "target_decoy", q: str = "best_q_value", q_notch: str = "best_q_value_notch", t: float = THRESHOLD) -> Column:
    return (F.col(label) == "target") & (F.col(q) <= t) & _notch_ok(q_notch, t)


def accepted_forms(df: DataFrame, label: str = "target_decoy", q: str = "best_q_value", q_notch: str = "best_q_value_notch",
                   t: float = THRESHOLD) -> DataFrame:
    return df.filter(form_rule(label, q, q_notch, t))


def group_rule(label: str = "target_decoy", q: str = "q_value", t: float = THRESHOLD) -> Column:
    """Anything but a decoy, contaminants included. A group without a label is not accepted."""
    return (F.col(label) != "decoy") & (F.col(q) <= t)


def accepted_groups(df: DataFrame, label: str = "target_decoy", q: str = "q_value", t: float = THRESHOLD) -> DataFrame:
    return df.filter(group_rule(label, q, t))


def without_decoys(df: DataFrame, accession: str) -> DataFrame:
    return df.filter(~is_decoy(accession))


def status_gate(entries: DataFrame, status: str = "status", reason: str = "reason", allowed: Sequence[str] = ("include",)) -> tuple[DataFrame, DataFrame]:
    """(entries that may be used, the others with their reason)."""
    ok = F.coalesce(F.col(status).isin(list(allowed)), F.lit(False))
    why = F.coalesce(F.nullif(F.trim(reason), F.lit("")), F.lit("no reason given"))
    return entries.filter(ok), entries.filter(~ok).withColumn(reason, why)


def available_only(allowed: DataFrame, snapshots: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(allowed entries that have a snapshot, those that have none)."""
    have = snapshots.select(key).distinct()
    return allowed.join(have, key, "left_semi"), allowed.join(have, key, "left_anti")


def annotation_filter(rows: DataFrame, term: str, aspect: str, status: str, wanted: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a term of the wanted aspect, (reason, n) of the rows left out)."""
    has_term = F.coalesce(F.col(term) != "", F.lit(False))
    reason = F.when(~has_term, F.concat(F.lit("no term ("), F.col(status), F.lit(")"))) \
        .when(~F.coalesce(F.col(aspect) == wanted, F.lit(False)), F.concat(F.lit("aspect "), F.col(aspect)))
    left_out = rows.withColumn("reason", reason).filter("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))
    return rows.filter(has_term & (F.col(aspect) == wanted)), left_out
