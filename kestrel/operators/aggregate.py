"""Grouping, shares, top-k and correlation.

Scalars such as a grand total or a mean of group sizes stay inside the plan
as one-row scalar subqueries (``DataFrame.scalar()``) instead of being pulled
to the driver and pushed back as literals. With exchange reuse on (the
default), the subquery reads the grouped shuffle output of the main plan, so
the input is scanned and shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.numeric import percent_of


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def group_count(df: DataFrame, *keys: Column | str, name: str = "count") -> DataFrame:
    """Rows per key (A1). A null key forms its own group. Partial counts are
    combined map-side, so a hot key costs one row per task in the shuffle."""
    out = df.groupBy(*keys).count()
    return out if name == "count" else out.withColumnRenamed("count", name)


def with_share_of_total(grouped: DataFrame, count_col: str = "count",
                        name: str = "percentage") -> DataFrame:
    """Add ``count / sum(count) * 100``."""
    total = grouped.agg(F.sum(count_col)).scalar()
    return grouped.withColumn(name, percent_of(F.col(count_col), total))


def above_mean(grouped: DataFrame, count_col: str = "count") -> DataFrame:
    """Groups whose count is strictly above the mean group count."""
    mean = grouped.agg(F.avg(count_col)).scalar()
    return grouped.filter(F.col(count_col) > mean)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows under a total order (O3). Spark plans this as a
    per-partition top-k merged on one node (TakeOrderedAndProject), so only
    ``k`` rows per task move. Pass a tie-break so ties at the cut are stable."""
    return df.orderBy(*order).limit(k)


def distinct_count(df: DataFrame, col: str, name: str) -> DataFrame:
    """Exact number of distinct non-null values, as a one-row table (A2)."""
    return df.agg(F.count_distinct(F.col(col)).alias(name))


def row_count(df: DataFrame, name: str = "count") -> DataFrame:
    """Row count as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias(name))


def pearson(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation as an aggregate expression.

    Written as covariance over the product of standard deviations through
    ``try_divide``: a constant column yields null, where ``corr`` fails the
    query under ANSI mode. Pairs with a null on either side are skipped by
    all three aggregates alike (each side is masked where the other is
    null), so drop nulls first if a null should not simply be ignored."""
    x, y = _c(x), _c(y)
    xm = F.when(y.isNotNull(), x)
    ym = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym))


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Several correlations in a single pass: ``pairs`` is (x, y, alias)."""
    return df.agg(*[pearson(x, y).alias(name) for x, y, name in pairs])


def class_distribution(df: DataFrame, key: str, class_expr: Column,
                       class_name: str, per_key_name: str = "count") -> DataFrame:
    """Two-level aggregate (A12): rows per key, then keys per class.

    The first level is a regular grouped count; the second groups the (much
    smaller) per-key table by its class."""
    per_key = group_count(df, key, name=per_key_name)
    return group_count(per_key.withColumn(class_name, class_expr), class_name)


def category_order(col: Column | str, order: Sequence[str]) -> Column:
    """Sort key from a listed category order (V4): 1-based position, null
    for values not in the list (sort with ``asc_nulls_last``)."""
    listed = F.array(*[F.lit(v) for v in order])
    return F.nullif(F.array_position(listed, _c(col)), F.lit(0)).cast("int")


def with_category_order(df: DataFrame, col: str, order: Sequence[str],
                        name: str = "position") -> DataFrame:
    """Add the listed position of ``col`` and sort by it, unlisted last (V4)."""
    return (df.withColumn(name, category_order(col, order))
            .orderBy(F.col(name).asc_nulls_last(), F.col(col).asc_nulls_last()))
