"""Row differences, numeric drift, observed writes, review chunks and keyed pseudonyms."""

import hashlib
import hmac
import math
from collections import Counter

from pyspark.sql import functions as F

from ordermart.catalog import spark_queries as SQ
from ordermart.operators import clean, preagg, quality, wide
from ordermart.plans import physical
from ordermart.sources.adapter import SourceTables

SCHEMA = "id long, a string, b string"


def test_row_differences_by_brute_force(spark):
    left = [(i, f"a{i}", f"b{i}") for i in range(500)] + [(7, "a7", "b7"), (None, "x", None), (900, None, "x")]
    right = [r for r in left if r[0] not in (3, 4)]
    right = [(i, "changed", b) if i == 10 else (i, a, b) for i, a, b in right] + [(800, "new", None)]
    right.remove((900, None, "x"))
    right.append((900, "x", None))                              # a null that moved is a change
    right.remove((7, "a7", "b7"))                               # one of two equal rows
    x, y = Counter(left), Counter(right)
    want = Counter()
    for side, only in (("left", x - y), ("right", y - x)):
        for r, n in only.items():
            want[r[0], side] += n
    for segments, fan in ((4096, 64), (3, 2)):
        frames = [spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (left, right)]
        got = {(r.id, r.side): r.rows for r in quality.row_differences(*frames, "id", segments, fan).collect()}
        assert got == dict(want)
    same = spark.createDataFrame(left, SCHEMA)
    assert quality.row_differences(same, same.repartition(5), "id").count() == 0
    assert quality.row_differences(same.limit(0), same.limit(0), "id").count() == 0


def test_only_rows_of_differing_parts_are_compared(spark, scratch):
    """One changed row among many: the last shuffle holds the rows of its part."""
    rows = spark.range(50_000).select("id", F.md5(F.col("id").cast("string")).alias("a"), F.lit("x").alias("b"))
    rows.write.parquet(f"{scratch}/left")
    rows.withColumn("b", F.when(F.col("id") == 123, "y").otherwise(F.col("b"))).write.parquet(f"{scratch}/right")
    left, right = (spark.read.parquet(f"{scratch}/{s}") for s in ("left", "right"))
    diff = quality.row_differences(left, right, "id")
    assert sorted(map(tuple, diff.collect())) == [(123, "left", 1), (123, "right", 1)]
    assert "LeftSemi" in physical.plan_text(diff, "simple")


def test_observed_counts_are_those_of_the_table(spark, small_dir, scratch):
    w = wide.build_wide(SourceTables(spark, small_dir))
    seen = {r.metric: r.value for r in quality.observed_write(w, f"{scratch}/final").collect()}
    back = spark.read.parquet(f"{scratch}/final")
    assert seen["rows"] == back.count() and seen["null_payment_value"] == back.filter("payment_value is null").count()
    assert {n: seen[f"without_{n}"] for n in quality.JOIN_KEYS} == {n: back.filter(F.col(c).isNull()).count() for n, c in quality.JOIN_KEYS.items()}
    stages = {r.stage_name: r for r in quality.join_reconciliation(wide.Silver(SourceTables(spark, small_dir))).collect()}
    assert stages["translation"].output_rows == seen["rows"]
    assert stages["payments"].null_payment_rows == seen["null_payment_value"]


def test_a_hot_orders_reviews_come_in_chunks(spark, small_dir):
    reviews = clean.clean_reviews(SourceTables(spark, small_dir).order_reviews)
    lists = {r.review_order_id: r for r in preagg.reviews_per_order(reviews).collect()}
    for r in preagg.reviews_in_chunks(reviews).collect():
        assert r.chunk == 0 and r.review_scores == lists[r.review_order_id].review_scores
        assert r.review_message == lists[r.review_order_id].review_message
    hot = reviews.limit(1).select(*[c for c in reviews.columns if c not in ("review_id", "review_order_id")]).crossJoin(
        spark.range(3000).select(F.concat(F.lit("r"), "id").alias("review_id"), F.lit("hot").alias("review_order_id")))
    chunks = preagg.reviews_in_chunks(reviews.unionByName(hot.select(*reviews.columns)), 200).filter("review_order_id = 'hot'").collect()
    assert len(chunks) == 15 and sum(len(r.review_scores) for r in chunks) == 3000
    assert max(len(r.review_scores) for r in chunks) < 300


def test_numeric_drift(spark):
    rows = [("2020-01", float(v)) for v in range(100)] + [("2020-02", float(v)) for v in range(100)]
    rows += [("2020-03", float(v)) for v in range(90, 100)] + [("2020-05", 1.0), (None, 2.0), ("2020-05", None)]
    got = {r.period: r for r in quality.numeric_drift(spark.createDataFrame(rows, "p string, v double"), "p", "v").collect()}
    assert (got["2020-01"].psi, got["2020-02"].psi, got["2020-05"].psi) == (None, 0.0, None)
    s = sorted(v for _, v in rows if v is not None)
    edges = [s[max(1, math.ceil(k / 8 * len(s))) - 1] for k in range(1, 8)]
    share = lambda p: [(sum(1 for q, v in rows if q == p and v is not None and sum(v > e for e in edges) == b) + 0.5)
                       / (sum(1 for q, v in rows if q == p and v is not None) + 4) for b in range(8)]
    want = sum((a - b) * math.log(a / b) for a, b in zip(share("2020-03"), share("2020-02")))
    assert abs(got["2020-03"].psi - want) < 1e-6 and want > 1


def test_keyed_pseudonyms_are_hmacs(spark):
    df = spark.createDataFrame([("id-1",), ("é",), ("",), (None,)], "v string")
    for key in (b"k", SQ.MASK_KEY, b"long" * 40):
        got = [r[0] for r in df.select(quality.keyed_pseudonym("v", key)).collect()]
        assert got == [None if r.v is None else hmac.new(key, r.v.encode(), hashlib.sha256).hexdigest() for r in df.collect()]
