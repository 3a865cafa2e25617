"""Column expressions shared by batch plans, audits and streams. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "bucketize", "first_reason", "has_key", "holds", "in_domain", "json_row",
    "lenient_date", "lenient_decimal", "lenient_int", "minute_of", "or_empty",
    "ordered_category", "overflows", "rounded", "safe_ratio", "share_pct", "state_label",
]


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def holds(predicate: Column) -> Column:
    """Two-valued truth: an unknown (NULL) outcome counts as false.

    For negations and CASE branches. A filter drops unknown outcomes anyway and should
    get the plain predicate, which Spark can push into the scan.
    """
    return F.coalesce(predicate, F.lit(False))


def in_domain(column: Column | str, values: Sequence) -> Column:
    """Membership that rejects NULL, so a row lands on exactly one side of a split."""
    return holds(_col(column).isin(list(values)))


def has_key(*columns: Column | str) -> Column:
    """True when every identifier is present and not the empty string."""
    present = F.lit(True)
    for column in columns:
        present = present & (F.length(F.coalesce(_col(column).cast("string"), F.lit(""))) > 0)
    return present


def lenient_decimal(column: Column | str, precision: int, scale: int) -> Column:
    """Text to decimal; text that is no number, NaN and overflow become NULL."""
    return _col(column).try_cast(f"decimal({precision},{scale})")


def lenient_int(column: Column | str, type_name: str = "int") -> Column:
    """Text to a nullable whole number: ``'3.0'`` is 3; ``'3.5'`` and ``'x'`` are NULL."""
    number = _col(column).try_cast("decimal(38,6)")
    return F.when(number == F.floor(number), number.try_cast(type_name))


def overflows(column: Column | str, precision: int, scale: int) -> Column:
    """Text that is a number but does not fit the decimal type."""
    number = _col(column).try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))
    return finite & lenient_decimal(column, precision, scale).isNull()


def lenient_date(column: Column | str) -> Column:
    """Text ``yyyy-MM-dd`` to a date; any other form and impossible days become NULL."""
    text = _col(column).cast("string")
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.try_cast("date"))


def or_empty(column: Column | str) -> Column:
    """Default of a missing landed field."""
    return F.coalesce(_col(column).cast("string"), F.lit(""))


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient; a zero denominator gives NULL instead of an error."""
    below = _col(denominator)
    return _col(numerator) / F.when(below != 0, below)


def rounded(column: Column | str, digits: int = 0) -> Column:
    """Round half away from zero; the result is a double."""
    return F.round(_col(column), digits).cast("double")


def share_pct(predicate: Column) -> Column:
    """Aggregate: percentage of the group's rows for which ``predicate`` is true."""
    return safe_ratio(F.lit(100.0) * F.count_if(predicate), F.count(F.lit(1)))


def bucketize(column: Column | str, edges: Sequence, labels: Sequence[str]) -> Column:
    """Label of the half-open band holding the value; NULL stays NULL.

    ``labels`` has one entry more than ``edges``; the last is for values from the last
    edge on.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("labels must have one more entry than edges")
    value = _col(column)
    band = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        band = band.when(value < edge, F.lit(label))
    return band.otherwise(F.lit(labels[-1]))


def ordered_category(column: Column | str, values: Sequence[str]) -> Column:
    """Position of a category in a declared order, NULL for values outside it."""
    position = F.array_position(F.array(*[F.lit(v) for v in values]), _col(column))
    return F.when(position > 0, position - 1).cast("int")


def minute_of(column: Column | str) -> Column:
    return F.date_trunc("minute", _col(column)).cast("timestamp_ntz")


def json_row(*columns: str) -> Column:
    """The row as JSON text with explicit nulls."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def first_reason(*rules: tuple[str, Column]) -> Column:
    """Name of the first rule broken, in the order given; NULL when none is."""
    reason = F.lit(None).cast("string")
    for name, broken in reversed(rules):
        reason = F.when(holds(broken), F.lit(name)).otherwise(reason)
    return reason


def state_label(column: Column | str, labels: dict[float, str]) -> Column:
    """Text for coded gauge values, such as 0 and 1 for down and up."""
    value = _col(column)
    text = F.lit(None).cast("string")
    for code, label in labels.items():
        text = F.when(value == F.lit(code), F.lit(label)).otherwise(text)
    return text
