"""Registry of queries and helpers that make results comparable across engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.session import configure

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL that must give the same rows."""

    def register(build: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(configure(spark), sf_dir))

        run.__name__, run.__doc__ = name, build.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return build

    return register


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_SQL)


def plain(df: DataFrame) -> DataFrame:
    """Result types every engine prints alike.

    Decimals and small whole numbers, which may be missing, become doubles; dates and
    instants become text.
    """
    columns = []
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType)):
            value = value.cast("double")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def with_tables(parts: dict[str, str], names: list[str], body: str, **more: str) -> str:
    """SQL text: the named table definitions, then ``more`` definitions, then ``body``."""
    chosen = {**{n: parts[n] for n in names}, **more}
    ctes = ",\n".join(f"{n} AS (\n{text.strip()}\n)" for n, text in chosen.items())
    return f"WITH {ctes}\n{body.strip()}"


def instant(column: str, name: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"
