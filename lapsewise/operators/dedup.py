"""First-wins / last-wins deduplication.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY o) = 1``.  Catalyst plans it
with a *partial* ``WindowGroupLimit`` before the shuffle: every map task
keeps only the first row per key, so a key holding a third of all rows is
reduced to one row per task before anything moves (checked in the tests).
The ordering is extended with the remaining orderable columns, so even
ties in ``order`` give a deterministic survivor (same result as taking the
minimum of ``struct(order..., row...)``, which was measured 25% slower: its
struct buffer forces a sort-based aggregate).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def _pick(df: DataFrame, keys, order, drop, newest: bool) -> DataFrame:
    keys, order = list(keys), list(order)
    tiebreak = [
        f.name for f in df.schema.fields
        if f.name not in keys and f.name not in order and _orderable(f.dataType)
    ]
    cols = [
        F.col(c).desc_nulls_last() if newest else F.col(c).asc_nulls_first()
        for c in order + tiebreak
    ]
    w = Window.partitionBy(*keys).orderBy(*cols)
    out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    return out.drop(*drop) if drop else out


def first_wins(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    drop: Sequence[str] = (),
) -> DataFrame:
    """Keep per ``keys`` the row that sorts first by ``order`` (ascending, nulls first).

    ``order`` columns may be hidden bookkeeping columns (file ordinal, line
    position); list them in ``drop`` to remove them from the output.
    """
    return _pick(df, keys, order, drop, newest=False)


def last_wins(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    drop: Sequence[str] = (),
) -> DataFrame:
    """Keep per ``keys`` the row that sorts last by ``order`` (newest wins, nulls lose)."""
    return _pick(df, keys, order, drop, newest=True)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``GROUP BY keys HAVING COUNT(*) > 1`` (nulls grouped like SQL)."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )
