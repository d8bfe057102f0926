"""Ordered running values over long series, without one task per series.

A plain ``Window.partitionBy(key).orderBy(t)`` moves a key's whole history into one
task.  Here each key is cut into blocks by a column of the data, such as the day: the
window runs inside a block, one row per block carries the result of everything before
it, and the two are joined on (key, block).  The join reuses the window's partitioning,
so only the small carry side is shuffled for it.  Key and block travel as one struct, which
is never null itself: keys that are null are keys like others.  Results are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_PLACE = "_place"


def _placed(df: DataFrame, keys: list[str], block: str) -> DataFrame:
    return df.withColumn(_PLACE, F.struct(*keys, block))


def running(
    df: DataFrame,
    keys: list[str],
    block: str,
    order: str,
    sums: dict[str, Column] | None = None,
    maxima: dict[str, Column] | None = None,
) -> DataFrame:
    """Add running sums and maxima along ``order``, current row included."""
    wanted = [
        *((name, col, F.sum) for name, col in (sums or {}).items()),
        *((name, col, F.max) for name, col in (maxima or {}).items()),
    ]
    inside = Window.partitionBy(_PLACE).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = _placed(df, keys, block)
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        placed.groupBy(_PLACE, *keys, block)
        .agg(*[how(col).alias(f"_part_{name}") for name, col, how in wanted])
        .select(
            _PLACE,
            *[how(f"_part_{name}").over(before).alias(f"_carry_{name}") for name, _, how in wanted],
        )
    )

    def merged(name: str, how) -> Column:
        here, earlier = F.col(f"_in_{name}"), F.col(f"_carry_{name}")
        if how is F.max:
            return F.greatest(here, earlier)
        return F.coalesce(here, F.lit(0)) + F.coalesce(earlier, F.lit(0))

    return (
        placed.withColumns({f"_in_{name}": how(col).over(inside) for name, col, how in wanted})
        .join(carried, _PLACE)
        .select(*df.columns, *[merged(name, how).alias(name) for name, _, how in wanted])
    )


def previous(
    df: DataFrame, keys: list[str], block: str, order: str, values: dict[str, str]
) -> DataFrame:
    """Add the preceding row's value of each non-null column; null on a key's first row."""
    inside = Window.partitionBy(_PLACE).orderBy(order)
    across = Window.partitionBy(*keys).orderBy(block)
    placed = _placed(df, keys, block)
    carried = (
        placed.groupBy(_PLACE, *keys, block)
        .agg(*[F.max_by(col, order).alias(f"_last_{name}") for name, col in values.items()])
        .select(
            _PLACE,
            *[F.lag(f"_last_{name}").over(across).alias(f"_carry_{name}") for name in values],
        )
    )
    return (
        placed.withColumns({f"_in_{name}": F.lag(col).over(inside) for name, col in values.items()})
        .join(carried, _PLACE)
        .select(
            *df.columns,
            *[F.coalesce(f"_in_{name}", f"_carry_{name}").alias(name) for name in values],
        )
    )


def position(df: DataFrame, keys: list[str], block: str, order: str, name: str) -> DataFrame:
    """Zero-based dense position of each row within its key."""
    counted = running(df, keys, block, order, sums={name: F.lit(1).cast("long")})
    return counted.withColumn(name, F.col(name) - 1)
