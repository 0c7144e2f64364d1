"""Distribution statistics as in-plan scalars.

Each helper returns a ``Column`` backed by an uncorrelated scalar subquery
(``DataFrame.scalar()``): Spark evaluates the one-row aggregate once, with
partial aggregation on every executor, and inlines the value in the outer
plan. No value travels through driver code and no global window pulls all
rows into one task.

Exact quantiles are those of ``functions.quantiles``, as scalars of one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import column_values, exact_quantiles


def quantiles(df: DataFrame, column: str, probs: Sequence[float]) -> list[Column]:
    """Exact discrete quantiles of ``column`` as scalar columns (null for a
    column without values)."""
    found = exact_quantiles(column_values(df, column), ["column_name"], probs).select("quantiles").scalar()
    return [F.get(found, F.lit(i)) for i in range(len(probs))]


def approx_quantiles(df: DataFrame, column: str, probs: Sequence[float],
                     accuracy: int = 10000) -> list[Column]:
    """Quantile sketch (results may differ from exact)."""
    return [df.select(F.percentile_approx(column, float(p), accuracy).alias(f"q{i}")).scalar()
            for i, p in enumerate(probs)]


def mean(df: DataFrame, column: str) -> Column:
    return df.select(F.avg(column).alias("mean")).scalar()


def money_mean(df: DataFrame, column: str) -> Column:
    """Mean of a money column from its exact total."""
    from .columns import money_total
    return df.select((money_total(column).cast("double") / F.count(column)).alias("mean")).scalar()


def stddev(df: DataFrame, column: str) -> Column:
    return df.select(F.stddev_samp(column).alias("sd")).scalar()
