"""Global row numbers, skew-free predecessor lookup, top-k and exact quantiles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row position in its lower 33 bits


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows; end ``order`` with a unique key for a stable answer."""
    return df.orderBy(*order).limit(k)


def with_dense_ids(
    df: DataFrame, order: list[str], name: str, partitions: int | None = None
) -> DataFrame:
    """Append ids 1..n following ``order``, without sorting the table in one task.

    Rows are range-partitioned on the whole order, so a hot leading value still spreads.
    The sorted partitions are written to the checkpoint folder, which pins their bounds;
    the only global step adds up one row count per partition.
    """
    ranged = (
        df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    )
    placed = (
        ranged.sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_place", _LOCAL_BITS))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    # One row per partition of the range shuffle, so this side is always small.
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + position + 1).alias(name)
    )


def with_previous(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: dict[str, str],
    chunk_rows: int = 100_000,
) -> DataFrame:
    """Append the preceding row's values per key: ``columns`` maps source to new name.

    A plain ``lag`` puts all rows of a key in one task. Here rows are numbered globally
    and cut into chunks of ``chunk_rows`` regardless of key; the last row of a chunk is
    also sent to the next one, so every window holds at most ``chunk_rows + 1`` rows.
    """
    numbered = with_dense_ids(df, [*keys, *order], "_seq")
    own = F.floor((F.col("_seq") - 1) / F.lit(chunk_rows)).cast("long")
    closes_chunk = F.col("_seq") % chunk_rows == 0
    spread = numbered.withColumn("_own", own).withColumn(
        "_chunk",
        F.explode(
            F.when(closes_chunk, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(
                F.array(F.col("_own"))
            )
        ),
    )
    window = Window.partitionBy("_chunk").orderBy("_seq")
    same_key = F.lit(True)
    for key in keys:
        same_key = same_key & F.lag(key).over(window).eqNullSafe(F.col(key))
    return spread.select(
        *df.columns,
        "_own",
        "_chunk",
        *[F.when(same_key, F.lag(c).over(window)).alias(n) for c, n in columns.items()],
    ).filter(F.col("_own") == F.col("_chunk")).drop("_own", "_chunk")


def previous_in_time(
    df: DataFrame,
    keys: list[str],
    ts: str,
    ties: list[str],
    columns: dict[str, str],
    chunk: str = "day",
) -> DataFrame:
    """Append the preceding row's values per key in time: ``columns`` maps source to new name.

    Rows are shuffled once, by key and ``chunk`` (a unit of ``date_trunc``), so a hot key spreads
    over its days; choose a unit whose rows of one key fit a task. Only the first and the last
    row of each chunk meet those of the key's other chunks. Rows of one instant are ordered by
    ``ties``.
    """
    inside = Window.partitionBy(*keys, "_chunk").orderBy(ts, *ties)
    placed = df.withColumn("_chunk", F.date_trunc(chunk, ts)).withColumns({
        "_nth": F.row_number().over(inside),
        "_last": F.lead(F.lit(True)).over(inside).isNull(),
        **{name: F.lag(c).over(inside) for c, name in columns.items()},
    })
    names = [*df.columns, *columns.values()]
    edges = placed.where((F.col("_nth") == 1) | F.col("_last"))
    across = Window.partitionBy(*keys).orderBy("_chunk", "_nth")
    carried = edges.withColumns({n: F.lag(c).over(across) for c, n in columns.items()})
    return placed.where("_nth > 1").select(*names).unionByName(
        carried.where("_nth = 1").select(*names)
    )


def range_counts(
    df: DataFrame, number: Column, value: Column, low: int, high: int, buckets: int
) -> list[Row]:
    """(b, n, lo, hi) of each equal range of ``number`` between two bounds, in order.

    All rows count: those below ``low`` as range -1, those above ``high`` as the last one. ``lo``
    and ``hi`` are the least and greatest ``value`` of a range. At most ``buckets`` + 2 rows.
    """
    width = max(1, -(-(high - low + 1) // buckets))
    spot = F.when(number < low, F.lit(-1)).when(number > high, F.lit(buckets))
    # Offsets from the lower bound stay within 64 bits where the bounds do not differ by more.
    spot = spot.otherwise(F.floor((number - F.lit(low)) / F.lit(width)).cast("int"))
    found = df.groupBy(spot.alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")
    )
    return sorted(found.collect(), key=lambda r: r["b"])


def entry_at(entries: list[Row], rank: int) -> tuple[int, int]:
    """The entry that holds the row at ``rank``, counted from 0, and the rows before it."""
    before = 0
    for i, entry in enumerate(entries):
        if rank < before + entry["n"]:
            return i, before
        before += entry["n"]
    raise ValueError(f"there are only {before} rows")


#: Accuracy of the quantile sketch and how far around the wanted place its bounds are taken.
_SKETCH, _MARGIN = 1024, 0.005


def exact_quantile(
    df: DataFrame, column: str, fraction: float, buckets: int = 4096
) -> float | None:
    """Linearly interpolated quantile of a whole-number or decimal column, exact in all digits.

    Other types, and decimals of more than 18 digits, are refused: cast them first.

    Built-in ``percentile`` keeps every distinct value of the group in one task. Here
    values become scaled integers. A first pass makes a mergeable sketch, which bounds the wanted
    rank; a second one counts ``buckets`` equal ranges between the bounds and all rows beyond
    them. While the range that holds the rank has several values, or lies beyond the bounds, it
    becomes the new bounds for one more pass. The driver sees one row per range.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        scale = kind.scale
    elif isinstance(kind, T.IntegralType):
        scale = 0
    else:
        raise ValueError(f"{column} is {kind.simpleString()}; cast it to a decimal of 18 digits")
    unscaled = (F.col(column).cast(T.DecimalType(38, scale)) * F.lit(10**scale)).cast("long")
    values = df.select(unscaled.alias("v")).where("v is not null")
    sketch = F.kll_sketch_agg_bigint("v", F.lit(_SKETCH))
    about = [F.lit(min(1.0, max(0.0, fraction + m))) for m in (-_MARGIN, _MARGIN)]
    found = values.agg(F.count("v").alias("total"), sketch.alias("s")).select(
        "total",
        *[F.when(F.col("total") > 0, F.kll_sketch_get_quantile_bigint("s", at)).alias(name)
          for name, at in zip(("low", "high"), about)],
    ).first()
    if not found["total"]:
        return None
    position = fraction * (found["total"] - 1)
    rank = math.floor(position)
    low, high = found["low"], found["high"]
    while True:
        entries = range_counts(values, F.col("v"), F.col("v"), low, high, buckets)
        i, before = entry_at(entries, rank)
        low, high = entries[i]["lo"], entries[i]["hi"]
        if low == high:
            break
    above = low
    if position > rank and before + entries[i]["n"] == rank + 1:
        above = entries[i + 1]["lo"]
    return (low + (above - low) * (position - rank)) / 10**scale
