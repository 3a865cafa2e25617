"""Profiles, rules, expectations and audit comparison."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions import first_reason, holds
from hearthline.operators.joins import broadcast_if_small


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _long(one_row: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    """Turn columns ``names`` of an aggregate into rows (label, value)."""
    kept = [c for c in one_row.columns if c not in names]
    return one_row.unpivot(kept, names, label, value)


# Completeness


def null_profile(
    tables: dict[str, tuple[DataFrame, list[str]]], scope: Column | None = None
) -> DataFrame:
    """(table_name, column_name, n_null, total); one pass over each table."""
    profiles = []
    for name, (df, columns) in tables.items():
        scoped = df if scope is None else df.where(scope)
        counts = scoped.agg(
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
        )
        profiles.append(
            _long(counts, columns, "column_name", "n_null").select(
                F.lit(name).alias("table_name"), "column_name", "n_null", "total"
            )
        )
    return _union(profiles)


def null_profile_compared(
    df: DataFrame, columns: list[str], scope: Column, table_name: str
) -> DataFrame:
    """Null counts over the whole table beside those within ``scope``; one pass."""
    inside = holds(scope)
    named = []
    for c in columns:
        missing = F.col(c).isNull()
        named.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(missing).alias("n_null"),
                F.count(F.lit(1)).alias("total"),
                F.count_if(missing & inside).alias("n_null_in_scope"),
                F.count_if(inside).alias("total_in_scope"),
            )
        )
    return (
        df.agg(F.array(*named).alias("_profile"))
        .select(F.inline("_profile"))
        .select(F.lit(table_name).alias("table_name"), "*")
    )


def nulls_by_category(df: DataFrame, category: str, values: list, column: str) -> DataFrame:
    """Null count of ``column`` for each listed category that occurs."""
    return (
        df.where(F.col(category).isin(values))
        .groupBy(category)
        .agg(F.count_if(F.col(column).isNull()).alias("n_null"))
    )


# Uniqueness and constancy


def duplicate_groups(df: DataFrame, key: list[str], count: str = "n") -> DataFrame:
    """Keys found more than once: evidence to look at, nothing is removed."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def inconsistent_groups(df: DataFrame, key: str, column: str) -> DataFrame:
    """Groups in which ``column`` takes several values; NULLs are not a value."""
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(column).alias("n_values"),
        )
        .where((F.col("n_rows") > 1) & (F.col("n_values") > 1))
    )


# Row rules


@dataclass(frozen=True)
class Rule:
    """A row predicate that marks a suspicious row.

    ``action`` is what is done about it: ``keep`` only counts, ``nullify`` empties ``column``,
    ``quarantine`` holds the row back.
    """

    name: str
    table: str
    predicate: Column
    severity: str = "error"
    action: str = "keep"
    column: str | None = None


def rule_counts(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """(table_name, rule, severity, action, n_rows); one pass over each table."""
    counted = []
    for table in dict.fromkeys(r.table for r in rules):
        own = [r for r in rules if r.table == table]
        found = F.array(
            *[
                F.struct(
                    F.lit(table).alias("table_name"),
                    F.lit(r.name).alias("rule"),
                    F.lit(r.severity).alias("severity"),
                    F.lit(r.action).alias("action"),
                    F.count_if(holds(r.predicate)).alias("n_rows"),
                )
                for r in own
            ]
        )
        counted.append(tables[table].agg(found.alias("_found")).select(F.inline("_found")))
    return _union(counted)


def rule_rows(df: DataFrame, rule: Rule, columns: list[str]) -> DataFrame:
    """The rows a rule marks."""
    return df.where(rule.predicate).select(*columns)


# Referential integrity


def orphan_counts(relations: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(relation, n_orphans) for each (name, child, child key, parent, parent key).

    Children are counted by key before the check, so a hot key is one row in the join.
    """
    profiles = []
    for name, child, child_key, parent, parent_key in relations:
        keys = child.groupBy(F.col(child_key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
        known = parent.select(F.col(parent_key).alias("_key"))
        profiles.append(
            keys.join(known, "_key", "left_anti")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_orphans"))
            .select(F.lit(name).alias("relation"), "n_orphans")
        )
    return _union(profiles)


# Declared constraints


@dataclass(frozen=True)
class Expectation:
    """A declared constraint.

    ``kind`` is one of not_null, check, domain, max_length, unique and foreign_key.
    NULL passes every kind but not_null, as with SQL constraints.
    """

    kind: str
    column: str
    predicate: Column | None = None
    values: tuple = ()
    length: int | None = None
    parent: DataFrame | None = None
    parent_key: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}({self.column})"

    def broken(self) -> Column:
        """Violation of a constraint that one row decides alone."""
        value = F.col(self.column)
        if self.kind == "not_null":
            return value.isNull()
        if self.kind == "check":
            return holds(~self.predicate)
        if self.kind == "domain":
            return holds(~value.isin(list(self.values)))
        if self.kind == "max_length":
            return holds(F.length(value) > self.length)
        raise ValueError(f"{self.kind} is not decided by one row")

    @property
    def by_row(self) -> bool:
        return self.kind not in ("unique", "foreign_key")


def not_null(column: str) -> Expectation:
    return Expectation("not_null", column)


def check(column: str, predicate: Column) -> Expectation:
    return Expectation("check", column, predicate=predicate)


def domain(column: str, values: Iterable) -> Expectation:
    return Expectation("domain", column, values=tuple(values))


def max_length(column: str, length: int) -> Expectation:
    return Expectation("max_length", column, length=length)


def unique(column: str) -> Expectation:
    return Expectation("unique", column)


def foreign_key(column: str, parent: DataFrame, parent_key: str | None = None) -> Expectation:
    return Expectation("foreign_key", column, parent=parent, parent_key=parent_key or column)


def expectation_counts(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """(constraint_name, n_violations): row constraints in one pass, those of keys in another.

    The key columns of one type are counted together: each row gives one entry per column, which
    is counted before the shuffle, so that a hot key is one entry per task. All constraints of
    these columns are read off that one grouping, joined once to each parent.
    """
    results = []
    by_row = [e for e in expectations if e.by_row]
    if by_row:
        results.append(_named_counts(df, {e.name: F.count_if(e.broken()) for e in by_row}))
    kinds: dict[str, list[Expectation]] = {}
    for e in expectations:
        if not e.by_row:
            kinds.setdefault(df.schema[e.column].dataType.simpleString(), []).append(e)
    results += [_key_violations(df, own) for own in kinds.values()]
    return _union(results)


def _named_counts(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    cells = [
        F.struct(F.lit(name).alias("constraint_name"), n.alias("n_violations"))
        for name, n in counts.items()
    ]
    return df.agg(F.array(*cells).alias("_found")).select(F.inline("_found"))


def _key_violations(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """The same for unique and foreign_key constraints on columns of one type."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("_column"), F.col(c).alias("_key"))
        for c in dict.fromkeys(e.column for e in expectations)
    ])
    keys = df.select(F.inline(entries)).where("_key is not null")
    keys = keys.groupBy("_column", "_key").agg(F.count(F.lit(1)).alias("_n"))
    counts = {}
    for i, e in enumerate(expectations):
        own = F.col("_column") == e.column
        broken = F.col("_n") - 1
        if e.kind == "foreign_key":
            known = e.parent.select(F.col(e.parent_key).alias("_key")).dropna().distinct()
            # The column's name is part of the join, so the grouping's partitioning serves it.
            marked = known.select(
                F.lit(e.column).alias("_column"), "_key", F.lit(True).alias(f"_known{i}")
            )
            keys = keys.join(marked, ["_column", "_key"], "left")
            own, broken = own & F.col(f"_known{i}").isNull(), F.col("_n")
        counts[e.name] = F.coalesce(F.sum(F.when(own, broken)), F.lit(0))
    return _named_counts(keys, counts)


def with_reject_reason(
    df: DataFrame, expectations: list[Expectation], reason: str = "reject_reason"
) -> DataFrame:
    """Append the first broken row or foreign-key constraint, NULL for accepted rows.

    Repeated parent keys count once. The distinct keys are checkpointed before the join:
    with their aggregation directly below it Spark could not split a hot key of the child.
    """
    marked, rules = df, []
    for i, e in enumerate(expectations):
        if e.by_row:
            rules.append((e.name, e.broken()))
        elif e.kind == "foreign_key":
            keys = e.parent.select(F.col(e.parent_key).alias(e.column)).dropna().distinct()
            known = keys.checkpoint().withColumn(f"_known{i}", F.lit(True))
            marked = marked.join(known, e.column, "left")
            rules.append(
                (e.name, F.col(f"_known{i}").isNull() & F.col(e.column).isNotNull())
            )
    return marked.withColumn(reason, first_reason(*rules)).select(*df.columns, reason)


def enforce(
    df: DataFrame,
    expectations: list[Expectation],
    mode: str = "fail",
    order: list[str] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Apply constraints to a load: (accepted rows, rejected rows).

    ``fail`` raises when any is broken, ``drop`` keeps valid rows, ``quarantine`` also
    returns the others with their reason. With ``unique``, drop and quarantine keep the
    first row of a key in ``order``.
    """
    if mode == "fail":
        broken = expectation_counts(df, expectations).where("n_violations > 0")
        # At most one row per declared constraint.
        found = {r["constraint_name"]: r["n_violations"] for r in broken.collect()}
        if found:
            raise ValueError(f"constraints violated: {found}")
        return df, None
    if mode not in ("drop", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    judged = with_reject_reason(df, expectations)
    for e in expectations:
        if e.kind == "unique":
            if not order:
                raise ValueError("a unique constraint needs an order to say which is first")
            judged = reject_repeats(judged, e.column, e.name, order)
    accepted = judged.where("reject_reason is null").drop("reject_reason")
    rejected = judged.where("reject_reason is not null")
    return accepted, rejected if mode == "quarantine" else None


def reject_repeats(
    judged: DataFrame, column: str, name: str, order: list[str]
) -> DataFrame:
    """Mark all but the first of the still accepted rows of each non-null key.

    Only keys that do repeat are joined back, one row each; while they are few, the table
    itself is not shuffled by key.
    """
    place = F.struct(*order)
    open_row = F.col("reject_reason").isNull() & F.col(column).isNotNull()
    repeating = (
        judged.where(open_row)
        .groupBy(F.col(column).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
        .where("_n > 1")
        .drop("_n")
        .checkpoint()
    )
    placed = judged.join(
        broadcast_if_small(repeating), F.col(column) == F.col("_key"), "left"
    )
    repeated = open_row & F.col("_key").isNotNull() & ~place.eqNullSafe(F.col("_first"))
    reason = F.when(repeated, F.lit(name)).otherwise(F.col("reject_reason"))
    return placed.withColumn("reject_reason", reason).drop("_key", "_first")


# Cleaning gates and audit comparison


def reason_counts(judged: DataFrame, reason: str = "reject_reason") -> DataFrame:
    """Row accounting of a gate: rows per outcome, accepted rows as ``accepted``."""
    outcome = F.coalesce(F.col(reason), F.lit("accepted")).alias(reason)
    return judged.groupBy(outcome).agg(F.count(F.lit(1)).alias("n_rows"))


def audit_diff(
    before: DataFrame, after: DataFrame, keys: list[str], value: str = "metric_value"
) -> DataFrame:
    """Metrics of two runs of the same audit side by side with their difference."""
    left = before.select(*keys, F.col(value).alias("before_value"))
    right = after.select(*keys, F.col(value).alias("after_value"))
    delta = F.coalesce("after_value", F.lit(0)) - F.coalesce("before_value", F.lit(0))
    return left.join(right, keys, "full_outer").withColumn("delta", delta)
