"""Targeted corrections: a doubtful value becomes NULL, the row stays."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions import holds


def nullify_where(df: DataFrame, column: str, predicate: Column) -> DataFrame:
    """``column`` set to NULL where ``predicate`` is true."""
    kind = df.schema[column].dataType
    emptied = F.when(holds(predicate), F.lit(None).cast(kind)).otherwise(F.col(column))
    return df.withColumn(column, emptied)


def marked_via_join(
    df: DataFrame,
    parent: DataFrame,
    on: str,
    predicate: Column,
    parent_predicate: Column,
    mark: str,
) -> DataFrame:
    """Append ``mark``: whether the row and its parent both meet their predicate.

    Only doubtful rows meet the parent, so the others are neither shuffled nor looked up, and
    nothing is computed before the result is asked for. The parent's keys are first reduced to
    those of doubtful rows.
    """
    doubtful = df.where(predicate)
    qualified = parent.where(parent_predicate).select(on)
    hits = qualified.join(doubtful.select(on).distinct(), on, "left_semi").distinct()
    judged = doubtful.join(hits.withColumn(mark, F.lit(True)), on, "left")
    plain = df.where(~holds(predicate)).withColumn(mark, F.lit(False))
    return plain.unionByName(judged.withColumn(mark, holds(F.col(mark))))


def nullify_via_join(
    df: DataFrame,
    parent: DataFrame,
    on: str,
    column: str,
    predicate: Column,
    parent_predicate: Column,
) -> DataFrame:
    """``column`` set to NULL where the row and its parent both meet their predicate.

    Needs two scans of ``df``; see ``marked_via_join``.
    """
    marked = marked_via_join(df, parent, on, predicate, parent_predicate, "_hit")
    return nullify_where(marked, column, F.col("_hit")).select(*df.columns)


@dataclass(frozen=True)
class Decision:
    """One audited anomaly and what is done about it.

    ``action`` is ``"nullify"`` or ``"keep"``. ``parent`` (table, key, predicate) limits the
    correction to rows whose parent qualifies. ``grouped`` turns the table into the rows to
    judge, for anomalies of groups; those are always kept.
    """

    name: str
    table: str
    column: str
    predicate: Column
    action: str
    why: str
    parent: tuple[str, str, Column] | None = None
    grouped: Callable[[DataFrame], DataFrame] | None = None


def apply_corrections(
    tables: dict[str, DataFrame], decisions: list[Decision]
) -> dict[str, DataFrame]:
    """Tables with every ``nullify`` decision applied; parents are read uncorrected."""
    result = dict(tables)
    for decision in decisions:
        if decision.action == "keep":
            continue
        if decision.action != "nullify":
            raise ValueError(f"unknown action {decision.action!r}")
        df = result[decision.table]
        if decision.parent is None:
            df = nullify_where(df, decision.column, decision.predicate)
        else:
            parent, on, parent_predicate = decision.parent
            df = nullify_via_join(
                df, tables[parent], on, decision.column, decision.predicate, parent_predicate
            )
        result[decision.table] = df
    return result


def corrected_beside(
    tables: dict[str, DataFrame], table: str, decisions: list[Decision]
) -> tuple[DataFrame, dict[str, Column]]:
    """The table, with marks where a parent decides, and the corrected columns as expressions.

    For computing something of both states in one pass. Every decision judges the values as they
    were; two of them on one column both apply.
    """
    df, corrected = tables[table], {}
    for i, decision in enumerate(decisions):
        if decision.table != table or decision.action != "nullify":
            continue
        hit = holds(decision.predicate)
        if decision.parent is not None:
            parent, on, parent_predicate = decision.parent
            df = marked_via_join(
                df, tables[parent], on, decision.predicate, parent_predicate, f"_hit{i}"
            )
            hit = F.col(f"_hit{i}")
        value = corrected.get(decision.column, F.col(decision.column))
        corrected[decision.column] = F.when(~hit, value)
    return df, corrected


def decision_log(tables: dict[str, DataFrame], decisions: list[Decision]) -> DataFrame:
    """One row per decision with the number of rows it concerns before correction.

    Decisions on the rows of one table are counted in one pass.
    """
    passes: dict[tuple, list[Decision]] = {}
    for i, decision in enumerate(decisions):
        alone = decision.parent is not None or decision.grouped is not None
        passes.setdefault((decision.table, i if alone else None), []).append(decision)
    logs = []
    for members in passes.values():
        df = _concerned(tables, members[0])
        cells = [
            F.struct(
                F.lit(d.name).alias("decision"),
                F.lit(d.table).alias("table_name"),
                F.lit(d.column).alias("column_name"),
                F.lit(d.action).alias("action"),
                F.count_if(holds(d.predicate)).alias("n_rows"),
                F.lit(d.why).alias("why"),
            )
            for d in members
        ]
        logs.append(df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells")))
    return reduce(DataFrame.unionByName, logs)


def _concerned(tables: dict[str, DataFrame], decision: Decision) -> DataFrame:
    df = tables[decision.table]
    if decision.grouped is not None:
        df = decision.grouped(df)
    if decision.parent is None:
        return df
    parent, on, parent_predicate = decision.parent
    doubtful = df.where(decision.predicate)
    return doubtful.join(
        tables[parent].where(parent_predicate).select(on), on, "left_semi"
    )
