"""Data-quality operators. A check is a row (name, kind, ok, observed, expected, detail)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracat.functions.cells import reserved_word, strip
from veracat.session import materialise

CHECK_COLUMNS = "name string, kind string, ok boolean, observed bigint, expected bigint, detail string"


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _label(table: str, cols: Sequence[str]) -> str:
    return f"{table}.{cols[0]}" if len(cols) == 1 else f"{table} ({', '.join(cols)})"


@dataclass(frozen=True)
class Rule:
    """One rule over tables by name: ``columns`` of ``table`` are unique, or, where ``targets`` is given, refer to one:
    (type, table, column) for each type, the type being None for a plain reference."""
    name: str
    kind: str
    table: str
    columns: tuple[str, ...]
    scope: tuple[str, ...] = ()
    nulls: bool = False
    example: str | None = None
    targets: tuple[tuple[str | None, str, str], ...] = ()
    type_column: str | None = None


def unique_rule(table: str, cols: Sequence[str], scope: Sequence[str] = ("dataset_id",), kind: str = "unique") -> Rule:
    """A key with a NULL part is skipped."""
    return Rule(_label(table, cols), kind, table, tuple(cols), tuple(s for s in scope if s not in cols))


def nullsafe_rule(table: str, cols: Sequence[str], example: str, kind: str = "engine-unique") -> Rule:
    """NULL is a value of the key."""
    return Rule(_label(table, cols), kind, table, tuple(cols), nulls=True, example=example)


def reference_rule(table: str, column: str, target: str, parent_column: str, scope: Sequence[str] = ("dataset_id",), kind: str = "reference") -> Rule:
    return Rule(f"{table}.{column} -> {target}.{parent_column}", kind, table, (column,), tuple(scope), targets=((None, target, parent_column),))


def typed_rule(table: str, type_column: str, id_column: str, targets: Mapping[str, tuple[str, str]], scope: Sequence[str] = ("dataset_id",)) -> Rule:
    """A type without a target fails."""
    return Rule(f"{table}.{type_column} ", "reference", table, (id_column,), tuple(scope), targets=tuple((k, t, c) for k, (t, c) in targets.items()), type_column=type_column)


_CLAIM = "struct<r:int,t:string,key:array<string>,example:string,role:int>"


def _claims(table: str, rules: Sequence[Rule]) -> Column | None:
    """What a row of the table says under all rules, as a list: that it holds a key (role 0), refers to one (1) or offers
    one (2). NULL entries say nothing. An example that is a part of its key is not named again."""

    def said(r: int, of: Column, key: Sequence[Column], role: int, example: Column = F.lit(None)) -> Column:
        return F.struct(F.lit(r).alias("r"), of.cast("string").alias("t"), F.array(*[k.cast("string") for k in key]).alias("key"), example.cast("string").alias("example"), F.lit(role).alias("role")).cast(_CLAIM)

    one, several = [], []

    def add(column: str, scope: Sequence[Column], r: int, of: Column, role: int, nulls: Column = F.lit(False)) -> None:
        if column.endswith("[]"):
            listed = F.filter(F.col(column.removesuffix("[]")), lambda v: nulls | v.isNotNull())
            several.append(F.coalesce(F.transform(listed, lambda v: said(r, of, [*scope, v], role)), F.array().cast(f"array<{_CLAIM}>")))
        else:
            one.append(F.when(nulls | F.col(column).isNotNull(), said(r, of, [*scope, F.col(column)], role)))

    for i, rule in enumerate(rules):
        scope = [F.col(c) for c in rule.scope]
        if rule.table == table:
            if not rule.targets:
                cols = [F.col(c) for c in rule.columns]
                held = F.lit(True) if rule.nulls else reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
                one.append(F.when(held, said(i, F.lit(None), [*scope, *cols], 0, F.lit(None) if _part(rule) is not None else F.col(rule.example))))
            elif rule.type_column:
                typed = F.col(rule.type_column)
                if rule.columns[0].endswith("[]"):
                    add(rule.columns[0], scope, i, F.when(typed.isNotNull(), typed), 1, F.lit(True))
                    several[-1] = F.when(typed.isNotNull(), several[-1]).otherwise(F.array().cast(f"array<{_CLAIM}>"))
                else:
                    one.append(F.when(typed.isNotNull(), said(i, typed, [*scope, F.col(rule.columns[0])], 1)))
            else:
                add(rule.columns[0], scope, i, F.lit(None), 1)
        for of, target, c in rule.targets:
            if target == table:
                add(c, scope, i, F.lit(of), 2)
    if not one and not several:
        return None
    return F.concat(F.array(*one), *several) if one and several else F.array(*one) if one else F.concat(*several)


def _part(rule: Rule) -> int | None:
    """The part of the rule's key that is its example; None where the example is no part of the key."""
    name = rule.example or rule.columns[0]
    return len(rule.scope) + rule.columns.index(name) if name in rule.columns else None


def checked(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """One check row for each rule, and for a typed reference one for each type that occurs.

    Every table is read once, however many rules name it: a row says all it has to say under all rules, and one
    aggregate, which combines in every task first, tells the keys held twice and the references without a parent. It
    adds up numbers alone, so Spark hashes keys and sorts none; examples are read off the bad keys.
    """
    spark = next(iter(tables.values())).sparkSession
    said = [df.select(F.explode(claims).alias("c")).filter("c IS NOT NULL").select("c.*") for name, df in tables.items() if (claims := _claims(name, rules)) is not None]
    role = F.col("role")
    elsewhere = [F.min("example").alias("example")] if any(not x.targets and _part(x) is None for x in rules) else []
    keys = union_all(said).groupBy("r", "t", "key").agg(
        F.count_if(role == 0).alias("held"), F.max(role == 1).alias("asked"), F.max(role == 2).alias("offered"), *elsewhere)
    bad = (F.col("held") > 1) | (F.col("asked") & ~F.col("offered"))
    example = F.get("key", F.get(F.array(*[F.lit(_part(x)).cast("int") for x in rules]), F.col("r")))
    example = F.when(bad, F.coalesce(example, "example") if elsewhere else example)
    # Keys that are not bad are one row of a rule and type here, so only examples are compared as texts.
    told = keys.groupBy("r", "t", example.alias("example")).agg(F.count_if(bad).alias("observed"), F.max("asked").alias("asked"))
    found = told.groupBy("r", "t").agg(F.sum("observed").alias("observed"), F.min("example").alias("example"), F.max("asked").alias("asked"))
    # As short as the rules.
    named = spark.createDataFrame([(i, x.name, x.kind, x.type_column is not None) for i, x in enumerate(rules)], "r int, name string, kind string, typed boolean")
    targets = [(i, of, f"{x.table}.{x.columns[0]} -> {t}.{c}") for i, x in enumerate(rules) if x.type_column for of, t, c in x.targets]
    full = spark.createDataFrame(targets, "r int, t string, target string")
    one = named.join(found, "r", "left").join(full, ["r", "t"], "left").filter("NOT typed OR asked")
    lost = F.col("typed") & F.col("target").isNull()
    observed = F.coalesce("observed", F.lit(0).cast("bigint"))
    return one.select(
        F.when(lost, F.concat("name", "t")).otherwise(F.coalesce("target", "name")).alias("name"), "kind", (~lost & (observed == 0)).alias("ok"),
        F.when(~lost, observed).alias("observed"), F.lit(0).cast("bigint").alias("expected"),
        F.when(lost, F.lit("names no table")).when(observed > 0, F.concat(F.lit("e.g. "), "example")).alias("detail"),
    )


def unique_key(df: DataFrame, table: str, cols: Sequence[str], scope: Sequence[str] = ("dataset_id",), kind: str = "unique") -> DataFrame:
    return checked({table: df}, [unique_rule(table, cols, scope, kind)])


def unique_key_nullsafe(df: DataFrame, table: str, cols: Sequence[str], example: str, kind: str = "engine-unique") -> DataFrame:
    return checked({table: df}, [nullsafe_rule(table, cols, example, kind)])


def _values(df: DataFrame, column: str, scope: Sequence[str], alias: str = "val") -> DataFrame:
    name = column.removesuffix("[]")
    value = F.explode(name) if column.endswith("[]") else F.col(name)
    return df.select(*scope, value.alias(alias)).filter(F.col(alias).isNotNull()).distinct()


def dangling_values(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                    scope: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """Distinct child values without a parent row. Both sides are reduced to distinct values before
    the anti join, so the join moves keys and not rows."""
    known = _values(parent, parent_column, scope)
    return _values(child, column, scope).join(known, [*scope, "val"], "left_anti")


def dangling_references(child: DataFrame, table: str, column: str, parent: DataFrame, target: str,
                        parent_column: str, scope: Sequence[str] = ("dataset_id",), kind: str = "reference") -> DataFrame:
    return checked({table: child, target: parent}, [reference_rule(table, column, target, parent_column, scope, kind)])


def polymorphic_reference(child: DataFrame, table: str, type_column: str, id_column: str,
                          targets: Mapping[str, tuple[DataFrame, str]], scope: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """One check row per type that occurs; a type without a target fails."""
    # The parents go by their types here: a target is a frame of its own.
    rule = typed_rule(table, type_column, id_column, {k: (k, c) for k, (_, c) in targets.items()}, scope)
    return checked({table: child, **{k: df for k, (df, _) in targets.items()}}, [rule])


def collapse_exact_duplicates(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(kept rows, report). Rows equal in every column become one; rows that share a key and differ
    anywhere all stay, for the key check to refuse. Report: key columns, written, dropped.

    Keys are counted first, which moves one row per key and task however often a row was written.
    Whole rows are compared only where a key repeats, and that is normally nowhere.
    """
    # As one struct the key equals itself where a part is NULL.
    keyed = df.withColumn("_k", F.struct(*key))
    repeated = materialise(keyed.groupBy("_k").agg(F.count("*").alias("_n")).filter("_n > 1").select("_k"), "repeated-keys")
    # Outer and inner joins on distinct keys say what semi and anti joins would, and the optimizer
    # does not try to push them through a union below.
    marked = keyed.join(repeated.withColumn("_again", F.lit(True)), "_k", "left")
    again = marked.filter("_again").drop("_again")
    variants = again.groupBy("_k", *df.columns).agg(F.count("*").alias("_copies"))
    per_key = materialise(
        variants.groupBy("_k").agg(F.count("*").alias("_variants"), F.sum("_copies").alias("_written")), "repeated-variants"
    )
    single, clash = per_key.filter("_variants = 1"), per_key.filter("_variants > 1")
    kept = union_all([
        marked.filter("_again IS NULL").select(*df.columns),
        variants.join(single.select("_k"), "_k").select(*df.columns),
        again.join(clash.select("_k"), "_k").select(*df.columns),
    ])
    report = single.select("_k.*", F.col("_written").alias("written"), (F.col("_written") - 1).alias("dropped"))
    return kept, report


def row_count_check(rows: DataFrame, expected: DataFrame, keys: Sequence[str], known_tables: Sequence[str] | None = None,
                    table: str | None = None) -> DataFrame:
    """Rows per key against a manifest (keys, expected). A manifest line whose table nobody knows fails."""
    observed = rows.groupBy(*keys).agg(F.count("*").alias("observed"))
    joined = expected.join(observed, list(keys), "left")
    seen = F.coalesce("observed", F.lit(0).cast("bigint"))
    known = F.col(table).isin(list(known_tables)) if known_tables is not None and table else F.lit(True)
    return joined.select(
        F.concat_ws("/", *keys).alias("name"), F.lit("row_count").alias("kind"),
        (known & (seen == F.col("expected"))).alias("ok"),
        F.when(known, seen).alias("observed"), F.col("expected").cast("bigint").alias("expected"),
        F.when(~known, F.lit("a table no schema knows")).alias("detail"),
    )


def reconcile(observed: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Observed against expected values (keys, value), zero tolerance. A missing side is not judged:
    it is ok and not comparable."""
    o = observed.select(*keys, F.col("value").alias("observed"))
    e = expected.select(*keys, F.col("value").alias("expected"))
    comparable = F.col("observed").isNotNull() & F.col("expected").isNotNull()
    return o.join(e, list(keys), "full").select(
        *keys, "observed", "expected", comparable.alias("comparable"),
        (~comparable | (F.col("observed") == F.col("expected"))).alias("ok"),
    )


FINDING_COLUMNS = ["finding_id", "dataset_id", "run_id", "code", "severity", "status", "message", "source"]


def findings(df: DataFrame, code: str | Column, severity: str | Column, message: Column, source: str,
             dataset: str = "dataset_id", run: Column | None = None, suffix: Column | None = None) -> DataFrame:
    """One open finding per row of ``df``."""
    d = F.col(dataset)
    code = F.lit(code) if isinstance(code, str) else code
    parts = [d, code] + ([suffix] if suffix is not None else [])
    return df.select(
        F.concat_ws(":", *parts).alias("finding_id"), d.alias("dataset_id"),
        (run if run is not None else F.lit(None)).cast("string").alias("run_id"), code.alias("code"),
        (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
        F.lit("open").alias("status"), message.alias("message"), F.lit(source).alias("source"),
    )


def mismatch_findings(checks: DataFrame, name: str = "name", dataset: str = "dataset_id", source: str = "reconciliation") -> DataFrame:
    bad = checks.filter("comparable AND NOT ok")
    message = F.format_string(
        "%s: these tables hold %s, the producer reported %s", F.col(name),
        F.col("observed").cast("string"), F.col("expected").cast("string"),
    )
    return findings(bad, "count_mismatch", "warning", message, source, dataset, suffix=F.col(name))


def metric_conflicts(metrics: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Keys that several rows give different values for; NULL is a value. One row per key: n_rows,
    lowest and highest value, and how many rows hold none."""
    grouped = metrics.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.min(value).alias("lowest"), F.max(value).alias("highest"),
        F.count_if(F.col(value).isNull()).alias("n_null"),
    )
    differ = (F.col("lowest") != F.col("highest")) | ((F.col("n_null") > 0) & (F.col("n_null") < F.col("n_rows")))
    return grouped.filter((F.col("n_rows") > 1) & differ)


def conflicting_values(metrics: DataFrame, keys: Sequence[str], value: str = "value", source: str = "source") -> DataFrame:
    """Every distinct (source, value) of a conflicting key, as rows: no list per key is built."""
    variants = metrics.groupBy(*keys, source, value).agg(F.count("*").alias("n_rows"))
    bad = metric_conflicts(metrics, keys, value).select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return variants.join(bad, same, "left_semi")


def reserved_flag_conflicts(df: DataFrame, flag: str, value: str) -> DataFrame:
    """Rows whose delivered flag disagrees with the flag computed from the value."""
    computed = reserved_word(value)
    text = F.lower(strip(F.coalesce(F.col(flag).cast("string"), F.lit(""))))
    delivered = F.when(text.isin("true", "1", "yes"), True).when(text.isin("false", "0", "no"), False)
    written = (strip(value) != "") & (text != "")
    # A delivered word that is neither true nor false cannot agree.
    disagrees = delivered.isNull() | (delivered != computed)
    return df.withColumn("computed_flag", computed).filter(written & disagrees)


def undeclared_definitions(df: DataFrame, column: str, declared: DataFrame, declared_column: str) -> DataFrame:
    """Definition ids a table uses and the delivery does not declare. A delivery that declares
    nothing is not checked."""
    any_declared = declared.select(declared_column).limit(1).select(F.lit(True).alias("_any"))
    missing = df.select(F.col(column).alias("definition_id")).filter(F.col(column) != "").distinct().join(
        declared.select(F.col(declared_column).alias("definition_id")).distinct(), "definition_id", "left_anti"
    )
    # At most one row on the right: the condition only switches the check off.
    return missing.join(F.broadcast(any_declared), F.lit(True), "left_semi")


def acceptance_checks(rows: DataFrame, expected: Mapping[str, str], outcome: str, outcomes: Sequence[str],
                      stored: Sequence[str]) -> DataFrame:
    """(rule, n) over an artefact's rows in one pass: columns without a place, digests and releases
    that differ from the record, outcomes outside the vocabulary, and no rows at all."""
    unknown = sorted(set(rows.columns) - set(stored))
    rules = [(f"differs: {c}", F.count_if(~F.coalesce(F.col(c).cast("string"), F.lit("")).eqNullSafe(v)))
             for c, v in expected.items()]
    rules.append((f"unknown {outcome}", F.count_if(~F.coalesce(F.col(outcome).isin(list(outcomes)), F.lit(False)))))
    rules.append(("no rows", F.when(F.count("*") == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")))
    rules.append(("unknown columns", F.lit(len(unknown)).cast("bigint")))
    one = rows.agg(*[n.alias(f"r{i}") for i, (_, n) in enumerate(rules)])
    out = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"r{i}").cast("bigint").alias("n")) for i, (r, _) in enumerate(rules)])
    return one.select(F.explode(out).alias("x")).select("x.*")


def engine_coverage(databases: DataFrame, artefacts: DataFrame, schema_version: str) -> DataFrame:
    """Per searched target database (dataset_id, sha256): artefacts that resolve it.

    ``artefacts``: (artefact_id, search_database, schema_version). status is covered, uncovered, or
    ambiguous when two artefacts of the current schema claim one database; ``n_stale`` counts those
    written under another schema.
    """
    per_db = databases.groupBy("sha256").agg(F.count_distinct("dataset_id").alias("n_datasets"))
    current = F.col("schema_version") == schema_version
    found = artefacts.groupBy(F.col("search_database").alias("sha256")).agg(
        F.count_if(current).alias("n_artefacts"), F.count_if(~current).alias("n_stale"),
        F.min(F.when(current, F.col("artefact_id"))).alias("artefact_id"),
    )
    n = F.coalesce("n_artefacts", F.lit(0).cast("bigint"))
    return per_db.join(found, "sha256", "left").select(
        "sha256", "n_datasets", n.alias("n_artefacts"),
        F.coalesce("n_stale", F.lit(0).cast("bigint")).alias("n_stale"),
        F.when(n == 1, F.col("artefact_id")).alias("artefact_id"),
        F.when(n == 0, F.lit("uncovered")).when(n == 1, F.lit("covered")).otherwise(F.lit("ambiguous")).alias("status"),
    )


def version_gate(manifests: DataFrame, key: str, versions: Mapping[str, str]) -> DataFrame:
    """(key, problem): more than one snapshot of a key, or a version column that is not the expected."""
    rules = [(F.count("*") > 1, F.lit("more than one snapshot"))]
    rules += [(F.count_if(~F.col(c).eqNullSafe(F.lit(v))) > 0, F.lit(f"{c} is not {v}")) for c, v in versions.items()]
    flagged = manifests.groupBy(key).agg(
        F.array(*[F.when(cond, text) for cond, text in rules]).alias("p")
    )
    return flagged.select(key, F.explode(F.filter("p", lambda x: x.isNotNull())).alias("problem"))


def build_gate(checks: DataFrame) -> DataFrame:
    """The failed checks. A build publishes only when there are none."""
    return checks.filter(~F.col("ok"))


class GateRefused(Exception):
    """A build whose checks fail publishes nothing."""


def enforce(checks: DataFrame, shown: int = 20) -> None:
    """Refuse when any check failed. Counts every failure, shows a few."""
    failed = build_gate(checks)
    rows = failed.orderBy("kind", "name").limit(shown).collect()
    if rows:
        lines = [f"{r['name']}: {r['observed']} vs {r['expected']} ({r['detail']})" for r in rows]
        raise GateRefused(f"{failed.count()} failed check(s), first ones:\n  " + "\n  ".join(lines))


def schema_drift(meta: DataFrame, column: str, served: str) -> DataFrame:
    """The catalogs whose declared schema version is not the one this code describes."""
    return meta.filter(~F.col(column).eqNullSafe(served))


def replaced_since(manifests: DataFrame, opened: DataFrame, key: str, time: str) -> DataFrame:
    """Snapshots whose file changed after it was opened; both frames hold (key, time)."""
    now = manifests.select(key, F.col(time).alias("time_now"))
    return opened.select(key, F.col(time).alias("time_opened")).join(now, key, "left").filter(
        ~F.col("time_now").eqNullSafe(F.col("time_opened"))
    )
