"""Exact group median (``PERCENTILE_CONT(0.5) WITHIN GROUP``) at any skew.

Spark's ``percentile`` keeps every distinct value of a group in one
aggregation buffer, so a group holding a third of the table lands in one
task's memory.  This operator selects the middle ranks in rounds instead:

1. per group, a bounded quantile sketch (``percentile_approx``) gives bucket
   boundaries - a partial aggregate;
2. exact row counts per (group, bucket) - a partial aggregate, at most
   ``buckets`` rows per group;
3. running counts over each group's histogram (a bounded array of at most
   ``buckets`` entries) locate the bucket holding each middle rank;
4. only the rows of those buckets are kept, counted per distinct value.  While
   some middle bucket has more than ``most`` distinct values, it is sketched and
   divided again: a round leaves about one in ``buckets`` of them;
5. the values that are left, at most ``most`` per middle rank, are ranked.

The sketch only decides how rows are bucketed; exactness comes from the
exact counts, so a poor sketch can cost time but never correctness.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsewise.session import materialize

DEFAULT_BUCKETS = 128
DEFAULT_ACCURACY = 10000
#: Distinct values that one task ranks for a group.
MOST_RANKED = 20_000


def group_median(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    name: str = "median",
    buckets: int = DEFAULT_BUCKETS,
    accuracy: int = DEFAULT_ACCURACY,
    most: int = MOST_RANKED,
) -> DataFrame:
    """One row per group with a non-null value: ``groups`` + ``name`` (double)."""
    groups = list(groups)
    keys = [f"_k{i}" for i in range(len(groups))]
    vals = df.select(
        *[F.col(g).alias(k) for g, k in zip(groups, keys)],
        F.col(value).alias("_v"),
    ).where(F.col("_v").isNotNull())
    # 0-based ranks of the two middle values; ``_t`` tells which of them a part of a
    # group still holds (0: both, 1: the lower, 2: the upper)
    n = F.count(F.lit(1))
    left = _middle(
        vals.withColumn("_t", F.lit(0)).withColumn("_c", F.lit(1).cast("long")), keys, buckets, accuracy,
        [F.floor((n - 1) / 2).alias("_klo"), F.floor(n / 2).alias("_khi")])
    # a group's parts shrink to about 1/buckets of their distinct values in every round
    while _widest(left, keys) > most:
        left = _middle(left, keys, buckets, accuracy, [F.first("_klo").alias("_klo"), F.first("_khi").alias("_khi")])
    along = Window.partitionBy(*keys, "_t").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = left.withColumn("_before", F.coalesce(F.sum("_c").over(along), F.lit(0)))
    picks = ranked.select(
        *keys,
        F.when(_covers("_klo"), F.col("_v")).alias("_lo"),
        F.when(_covers("_khi"), F.col("_v")).alias("_hi"),
    )
    mids = picks.groupBy(*keys).agg(F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    vtype = df.schema[value].dataType
    if isinstance(vtype, T.DecimalType):
        # exact midpoint in decimal, one rounding when converting to double
        mid = ((F.col("_lo") + F.col("_hi")) / F.lit(2)).cast("double")
    else:
        mid = (F.col("_lo").cast("double") + F.col("_hi").cast("double")) / F.lit(2.0)
    return mids.select(
        *[F.col(k).alias(g) for g, k in zip(groups, keys)], mid.alias(name)
    )


def _covers(rank: str) -> F.Column:
    """Whether the rank (null: not held) falls on rows ``_before`` to ``_before + _c``."""
    k = F.col(rank)
    return F.coalesce((F.col("_before") <= k) & (k < F.col("_before") + F.col("_c")), F.lit(False))


def _widest(left: DataFrame, keys: Sequence[str]) -> int:
    """Most distinct values that a part of a group still has."""
    per_part = left.groupBy(*keys, "_t").agg(F.count(F.lit(1)).alias("n"))
    return per_part.agg(F.max("n")).first()[0] or 0


def _middle(vals: DataFrame, keys: list[str], buckets: int, accuracy: int, ranks: list[F.Column]) -> DataFrame:
    """One round: the rows of the buckets that hold a middle rank, with the rank inside the
    bucket.  ``vals`` has keys, _t, _v, _c (rows of that value); so has the result, with
    _klo and _khi, one row a distinct value, written."""
    part = [*keys, "_t"]
    probs = [i / buckets for i in range(1, buckets)]
    stats = vals.groupBy(*part).agg(*ranks, F.percentile_approx("_v", probs, accuracy).alias("_bounds"))
    # written (one row a group): Spark knows the size and joins without shuffling the
    # values by group as long as the groups are few
    stats = materialize(stats, "group_stats")
    # null-safe: a NULL group gets a median too (it never matches later)
    bucketed = _join_on_keys(vals.select(*part, "_v", "_c"), stats, part, ["_klo", "_khi", "_bounds"]).select(
        *part, "_v", "_c", "_klo", "_khi",
        F.size(F.filter("_bounds", lambda b: b < F.col("_v"))).alias("_b"),
    )
    hist = bucketed.groupBy(*part, "_klo", "_khi", "_b").agg(F.sum("_c").alias("_n"))
    # each histogram has at most ``buckets`` entries: gather it into one bounded array and
    # find the middle buckets with array functions (no window, no extra shuffle)
    per_part = hist.groupBy(*part, "_klo", "_khi").agg(
        F.array_sort(F.collect_list(F.struct("_b", "_n"))).alias("_h")
    )
    exploded = per_part.select(*part, "_klo", "_khi", F.inline(F.transform(
        "_h",
        lambda e, i: F.struct(
            e["_b"].alias("_b"), e["_n"].alias("_c"),
            F.aggregate(F.slice("_h", 1, i), F.lit(0).cast("long"), lambda acc, x: acc + x["_n"]).alias("_before"),
        ))))
    lo, hi = _covers("_klo"), _covers("_khi")
    targets = exploded.where(lo | hi).select(
        *part, "_b",
        F.when(lo & hi, F.lit(0)).when(lo, F.lit(1)).otherwise(F.lit(2)).alias("_now"),
        F.when(lo, F.col("_klo") - F.col("_before")).alias("_klo"),
        F.when(hi, F.col("_khi") - F.col("_before")).alias("_khi"),
    )
    targets = materialize(targets, "group_targets")
    kept = _join_on_keys(bucketed.select(*part, "_b", "_v", "_c"), targets, part + ["_b"], ["_now", "_klo", "_khi"])
    values = kept.groupBy(*keys, "_now", "_klo", "_khi", "_v").agg(F.sum("_c").alias("_c"))
    return materialize(values.select(*keys, F.col("_now").alias("_t"), "_v", "_c", "_klo", "_khi"), "middle_values")


def _join_on_keys(left: DataFrame, right: DataFrame, keys, carry) -> DataFrame:
    """Null-safe equi-join of ``left`` with ``right`` on ``keys``."""
    r = right.select(*[F.col(k).alias(f"{k}_r") for k in keys], *carry)
    cond = [left[k].eqNullSafe(r[f"{k}_r"]) for k in keys]
    return left.join(r, cond).drop(*[f"{k}_r" for k in keys])


def impute_group_median(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    flag: str | None = None,
    **median_kwargs,
) -> DataFrame:
    """Fill NULL ``value`` with its group's median; optionally flag them.

    The flag means "was missing": it is true even when the group has no
    known value and the result stays NULL.  NULL groups never match.
    """
    groups = list(groups)
    medians = materialize(group_median(df, groups, value, name="_median", **median_kwargs), "group_medians")
    joined = df.join(medians, groups, "left")
    cols = []
    for c in df.columns:
        if c == value:
            cols.append(F.coalesce(F.col(value), F.col("_median")).alias(value))
            if flag:
                cols.append(F.col(value).isNull().alias(flag))
        else:
            cols.append(F.col(c))
    return joined.select(*cols)
