"""Exact discrete quantiles of any number of columns and groups in two scans.

Values are rows (keys, v): the columns of one or several tables unpivoted, or
the values of groups. The first scan makes a bounded sketch per key. For each
probability it brackets the quantile: the sketch's values a little below and
a little above it, farther apart than the sketch can be wrong. The second
scan counts, for each bracket, what lies below it and how often each value
inside it occurs. All of it is a partial aggregate, so only the values inside
the brackets (six in ``ACCURACY`` of the rows) are shuffled and put in order,
and a hot key is as good as any other.

The quantile is an element of the column: the smallest one whose share of
rows at or below it reaches the probability. Keys without values have none.
A bracket that does not hold its quantile is an error, never a wrong result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 4000             # a sketch's ranks are off by at most 1/ACCURACY of the rows
MARGIN = 3 / ACCURACY       # brackets reach this far below and above

LONG_KEYS = ("table_name", "column_name")


def long_values(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """table_name, column_name, v (as double) of some columns of some
    tables, each table read once; missing values are left out."""
    out = None
    for name, (df, columns) in tables.items():
        each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns])
        rows = df.select(F.lit(name).alias("table_name"), F.explode(each).alias("x")).select("table_name", "x.*")
        out = rows if out is None else out.unionByName(rows)
    return out.filter("v is not null")


def column_values(df: DataFrame, column: str) -> DataFrame:
    """column_name, v of one column, in its own type."""
    x = F.explode(F.array(F.struct(F.lit(column).alias("column_name"), F.col(column).alias("v"))))
    return df.select(x.alias("x")).select("x.*")


def sketched(rows: DataFrame, keys: Sequence[str], probs: Sequence[float], **more: Column) -> DataFrame:
    """One row per key: _n, brackets _low_i and _high_i, and ``more``
    aggregates of the same scan."""
    ends = [max(0.0, p - MARGIN) for p in probs] + [min(1.0, p + MARGIN) for p in probs]
    found = rows.groupBy(*keys).agg(F.count("v").alias("_n"), F.percentile_approx("v", ends, ACCURACY).alias("_ends"),
                                    *[c.alias(name) for name, c in more.items()])
    return found.select(*keys, "_n", *[F.get("_ends", F.lit(i)).alias(f"_low_{i}") for i in range(len(probs))],
                        *[F.get("_ends", F.lit(len(probs) + i)).alias(f"_high_{i}") for i in range(len(probs))], *more)


def counted(rows: DataFrame, keys: Sequence[str], brackets: DataFrame, n: int, carry: Sequence[str] = ()) -> DataFrame:
    """keys, target, low, high, total (rows of the key), v, rows: for each of
    ``n`` brackets how often each value inside it occurs, and with v null how
    many rows lie below it. ``carry``: columns of the brackets to keep."""
    v = F.col("v")

    def entry(i: int) -> Column:
        low, high = F.col(f"_low_{i}"), F.col(f"_high_{i}")
        return F.when(v <= high, F.struct(F.lit(i).alias("target"), low.alias("low"), high.alias("high"),
                                          F.when(v >= low, v).alias("v")))

    ends = [f"_{side}_{i}" for side in ("low", "high") for i in range(n)]
    met = rows.select(*keys, "v").join(brackets.select(*keys, F.col("_n").alias("total"), *carry, *ends), list(keys))
    each = met.select(*keys, "total", *carry, F.explode(F.array(*map(entry, range(n)))).alias("x")).filter("x is not null")
    return each.select(*keys, "total", *carry, "x.*").groupBy(*keys, "total", *carry, "target", "low", "high", "v").agg(
        F.count("*").alias("rows"))


def selected(counts: DataFrame, keys: Sequence[str], probs: Sequence[float], carry: Sequence[str] = ()) -> DataFrame:
    """keys, carried columns, quantiles (an array, in the order of ``probs``)."""
    by = [*keys, "target"]
    prob = F.get(F.array(*[F.lit(float(p)) for p in probs]), F.col("target"))
    upto = F.sum("rows").over(Window.partitionBy(*by).orderBy(F.asc_nulls_first("v")))
    ranked = counts.withColumns({"rank": F.when(prob.isNotNull(), F.greatest(F.ceil(prob * F.col("total")), F.lit(1))),
                                 "upto": upto})
    reached = F.col("upto") >= F.col("rank")
    kept = [F.first(c).alias(c) for c in carry]
    picked = ranked.groupBy(*by).agg(F.min(F.when(reached, F.col("v"))).alias("v"),
                                     F.bool_or(reached & F.col("v").isNull()).alias("below"),
                                     F.max("rank").alias("rank"), *kept)
    picked = picked.filter("rank is not null")     # brackets without a probability; asked here, not before the counts
    misses = F.raise_error(F.lit("a bracket does not hold its quantile"))
    found = F.when(F.col("below") | F.col("v").isNull(), misses.cast(counts.schema["v"].dataType)).otherwise(F.col("v"))
    listed = F.array_sort(F.collect_list(F.struct("target", found.alias("v"))))
    return picked.groupBy(*keys).agg(*kept, F.transform(listed, lambda x: x["v"]).alias("quantiles"))


def _few(keys: Sequence[str]) -> bool:
    """Keys that name tables and columns are as few as the caller wrote down,
    so what there is one row of for each may be broadcast."""
    return set(keys) <= set(LONG_KEYS)


def _join_ready(brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Brackets as the rows meet them. Those of groups are written, and
    broadcast if that is small: the rows of a few large groups are then
    neither shuffled nor sorted. Otherwise the join is a shuffle by group."""
    if _few(keys):
        return F.broadcast(brackets)
    import uuid

    from ..plans import physical, sinks
    return physical.broadcast_if_small(sinks.materialize(brackets, brackets.sparkSession, f"brackets-{uuid.uuid4().hex}"))


def exact_quantiles(rows: DataFrame, keys: Sequence[str], probs: Sequence[float], **more: Column) -> DataFrame:
    """One row per key that has values: keys, ``more`` aggregates of the
    first scan, quantiles. ``rows``: keys and v. Null keys are left out."""
    rows = rows.dropna(subset=[*keys, "v"])
    brackets = sketched(rows, keys, probs, **more)
    brackets = F.broadcast(brackets) if _few(keys) else brackets
    return selected(counted(rows, keys, brackets, len(probs), list(more)), keys, probs, list(more))


def outliers(rows: DataFrame, keys: Sequence[str], k: float = 1.5) -> DataFrame:
    """Tukey's fences per key, from exact quartiles, and the rows beyond
    them: keys, q1, q3, lower, upper, checked_rows, below, above. The fences
    lie in brackets too, so both scans serve the counts as well."""
    rows = rows.dropna(subset=[*keys, "v"])
    ends = sketched(rows, keys, (0.25, 0.75))
    l1, l3, h1, h3 = (F.col(c) for c in ("_low_0", "_low_1", "_high_0", "_high_1"))
    slack = F.lit(1e-9) * F.greatest(F.abs(l1), F.abs(h3), F.abs(h1), F.abs(l3))     # rounding of the fences
    fences = {"_low_2": l1 - k * (h3 - l1) - slack, "_high_2": h1 - k * (l3 - h1) + slack,
              "_low_3": l3 + k * (l3 - h1) - slack, "_high_3": h3 + k * (h3 - l1) + slack}
    ends = ends.withColumns(fences)
    counts = counted(rows, keys, _join_ready(ends, keys), 4)
    quartiles = selected(counts, keys, (0.25, 0.75)).select(*keys, F.col("quantiles")[0].alias("q1"),
                                                            F.col("quantiles")[1].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    quartiles = quartiles.withColumns({"lower": F.col("q1") - F.lit(k) * iqr, "upper": F.col("q3") + F.lit(k) * iqr})
    quartiles = F.broadcast(quartiles) if _few(keys) else quartiles
    tally = lambda target, cond: F.coalesce(F.sum(F.when((F.col("target") == target) & cond, F.col("rows"))), F.lit(0))
    beyond = (counts.join(quartiles, list(keys)).groupBy(*keys, "q1", "q3", "lower", "upper", F.col("total").alias("checked_rows"))
              .agg(tally(2, F.col("v").isNull() | (F.col("v") < F.col("lower"))).alias("below"),
                   tally(3, F.col("v").isNull() | (F.col("v") <= F.col("upper"))).alias("_upto")))
    return beyond.withColumn("above", F.col("checked_rows") - F.col("_upto")).drop("_upto")
