"""Exact quantiles of many columns and groups: results, scans and jobs."""

import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ordermart.functions import quantiles as QT
from ordermart.operators import kpis, quality
from ordermart.plans import physical
from ordermart.sources.adapter import SourceTables

PROBS = (0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0)


def brute(values, probs=PROBS):
    s = sorted(values)
    return [s[max(1, math.ceil(p * len(s))) - 1] for p in probs]


def by_group(rows):
    out = defaultdict(list)
    for g, v in rows:
        if g is not None and v is not None:
            out[g].append(v)
    return out


def test_groups_of_every_size(spark):
    """One group holds most rows, others one; ties, nulls, negative values."""
    rng = random.Random(3)
    rows = [("hot", rng.choice([rng.gauss(0, 100), 1.5, -2.0])) for _ in range(60_000)]
    rows += [(f"g{rng.randrange(300)}", round(rng.gauss(5, 2), 1)) for _ in range(3000)]
    rows += [("one", 7.0), ("nulls", None), (None, 1.0), ("same", 3.0), ("same", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r.g: r.quantiles for r in QT.exact_quantiles(df, ["g"], PROBS).collect()}
    assert got == {g: brute(v) for g, v in by_group(rows).items()}


def test_rows_of_a_hot_group_do_not_meet(spark):
    """What is shuffled of a hot group is what lies inside its brackets, by value."""
    df = spark.range(200_000).select(F.lit("hot").alias("g"), (F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    brackets = QT.sketched(df, ["g"], (0.25, 0.5))
    counts = QT.counted(df, ["g"], brackets, 2)
    inside, below = counts.filter("v is not null").count(), counts.filter("v is null").collect()
    assert inside <= 2 * 200_000 * 4 * QT.MARGIN and len(below) == 2
    assert re.search(r"hashpartitioning\([^()]*\bv#", physical.plan_text(counts))


def test_types_and_empty(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(1000)], "g int, v int")
    rows = QT.exact_quantiles(df, ["g"], (0.5,)).collect()
    assert {r.g: r.quantiles for r in rows} == {g: brute(v, (0.5,)) for g, v in by_group((r.g, r.v) for r in df.collect()).items()}
    assert isinstance(rows[0].quantiles[0], int)
    assert QT.exact_quantiles(df.limit(0), ["g"], (0.5,)).count() == 0
    assert QT.outliers(df.limit(0), ["g"]).count() == 0


def test_a_bad_bracket_is_an_error(spark):
    df = spark.range(1000).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("v"))
    bad = QT.sketched(df, ["g"], (0.5,)).withColumns({"_low_0": F.lit(900.0), "_high_0": F.lit(910.0)})
    with pytest.raises(Exception, match="bracket"):
        QT.selected(QT.counted(df, ["g"], bad, 1), ["g"], (0.5,)).collect()


def test_outliers(spark):
    rng = random.Random(8)
    rows = [(g, round(rng.gauss(0, 1 + i), 2) * (50 if rng.random() < 0.01 else 1)) for i, g in enumerate("abc") for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.q1, r.q3, r.checked_rows, r.below, r.above) for r in QT.outliers(df, ["g"]).collect()}
    for g, v in by_group(rows).items():
        q1, q3 = brute(v, (0.25, 0.75))
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert got[g] == (q1, q3, len(v), sum(x < lo for x in v), sum(x > hi for x in v))
    assert sum(x[3] + x[4] for x in got.values()) > 20


def run_counting(spark, df):
    """Rows, jobs and scans of files of one run."""
    import uuid
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    rows = df.collect()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return rows, jobs, len(re.findall(r"FileScan parquet", final))


def test_two_scans_of_a_table_for_all_columns(spark, small_dir):
    t = SourceTables(spark, small_dir)
    tables = {"order_items": (t.order_items, ["price", "freight_value"]), "order_payments": (t.order_payments, ["payment_value"])}
    for report in (quality.iqr_outliers(tables), quality.summary_stats(tables)):
        rows, jobs, scans = run_counting(spark, report)
        assert len(rows) == 3 and jobs <= 8 and scans <= 4
        plan = physical.plan_text(report, "simple")
        assert plan.count("BroadcastHashJoin") >= 2 and "Cartesian" not in plan     # no row is shuffled to meet its bracket


def test_price_quartiles_per_seller(spark):
    rows = [("s1", 10.0), ("s1", 30.0), ("s1", 20.0), ("s1", None), ("s2", 5.0), (None, 1.0), ("s3", None)]
    got = kpis.price_quartiles(spark.createDataFrame(rows, "seller_id string, price double")).collect()
    assert sorted(map(tuple, got)) == [("s1", 3, 10.0, 20.0, 30.0), ("s2", 1, 5.0, 5.0, 5.0)]


def test_drift_reads_its_input_once(spark, small_dir, scratch):
    from ordermart.operators import wide
    rows = wide.build_wide(SourceTables(spark, small_dir), ["order_year_month", "price"])
    plan = physical.plan_text(quality.numeric_drift(rows, "order_year_month", "price"))
    assert "lineitem.parquet" not in plan and "numeric-drift" in plan


def test_rows_of_few_groups_are_not_sorted_by_group(spark):
    """The brackets of few groups are broadcast: no join shuffles the rows by group."""
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    lines = physical.plan_text(QT.outliers(df, ["g"]), "simple").splitlines()
    scans = [i for i, line in enumerate(lines) if "Range (0, 20000" in line]
    assert scans
    for i in scans:             # upwards from the rows: the bracket join comes before any shuffle
        above = next(line for line in reversed(lines[:i]) if "Join" in line or "Exchange hash" in line)
        assert "BroadcastHashJoin" in above


def test_outliers_of_groups_read_their_input_once(spark, small_dir):
    from ordermart.operators import wide
    rows = wide.build_wide(SourceTables(spark, small_dir), ["product_category_name", "price"])
    plan = physical.plan_text(quality.group_outliers(rows, "product_category_name", "price"))
    assert "lineitem.parquet" not in plan and "group-values" in plan
