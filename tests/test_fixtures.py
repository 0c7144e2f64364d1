"""Hand-made fixtures for edge cases the driver tables cannot hold."""

import datetime as dt
import math
import os

from pyspark.sql import Row
from pyspark.sql import functions as F

from ordermart.functions import columns as C
from ordermart.operators import clean, features, kpis, preagg, quality
from ordermart.sources import readers, schemas


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_quoted_newline_and_doubled_quote(spark, scratch):
    path = f"{scratch}/csv/reviews.csv"
    header = ",".join(schemas.column_names("order_reviews"))
    body = ('r1,o1,5,title,"line one\nline two",2018-01-02,2018-01-03 10:00:00\n'
            'r2,o2,4,"say ""hi""",plain,2018-01-02,2018-01-03 10:00:00\n')
    write_text(path, header + "\n" + body)
    multi = readers.read_csv(spark, path, "order_reviews", multiline=True)
    rows = {r.review_id: r for r in multi.collect()}
    assert set(rows) == {"r1", "r2"}
    assert rows["r1"].review_comment_message == "line one\nline two"
    assert rows["r2"].review_comment_title == 'say "hi"'
    naive = readers.read_csv(spark, path, "order_reviews", multiline=False)
    assert naive.count() == 3  # the embedded newline splits a record
    check = quality.line_count_check(spark, path, "order_reviews").first()
    assert (check.data_lines, check.records_multiline, check.records_naive) == (3, 2, 3)


def test_csv_bad_int_is_null_and_rejected(spark, scratch):
    path = f"{scratch}/csv/payments.csv"
    write_text(path, "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                     "o1,abc,boleto,1,10.5\n")
    df = readers.read_csv(spark, path, "order_payments", keep_rejects=True)
    r = df.first()
    assert r.payment_sequential is None
    assert r[readers.CORRUPT_COLUMN] is not None


def test_hex_ids_null_is_its_own_class(spark):
    df = spark.createDataFrame([(None,), ("a" * 31,), ("0123456789abcdef0123456789ABCDEF",)], "id string")
    r = quality.hex_id_report(df, "id").first()
    assert (r.valid, r.invalid, r.nulls) == (1, 1, 1)
    assert quality.valid_hex_ids(df, "id").count() == 1
    assert quality.invalid_hex_ids(df, "id").count() == 1


def test_missing_profile_counts_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    got = {r.column_name: r.missing_count for r in quality.missing_profile(df, "t").collect()}
    assert got == {"x": 2, "s": 1}
    nulls = {r.column_name: r.null_count for r in quality.null_profile(df, "t").collect()}
    assert nulls == {"x": 1, "s": 1}


def test_null_review_lists_label(spark):
    df = spark.createDataFrame(
        [(["No Review"], ["No Review"]), (None, None), (["t"], ["No Review"])],
        "review_titles array<string>, review_message array<string>")
    default = [r.l for r in df.select(features.review_label().alias("l")).collect()]
    assert default == [C.NO_REVIEW_FLAG, C.NO_REVIEW_FLAG, C.HAS_COMMENT]
    written = [r.l for r in df.select(features.review_label(as_written=True).alias("l")).collect()]
    assert written == [C.NO_REVIEW_FLAG, C.HAS_COMMENT, C.HAS_COMMENT]


def _feature_frame(spark, created, answered):
    return spark.createDataFrame([Row(
        order_status="delivered", price=10.0, freight_value=2.5,
        review_titles=["x"], review_message=["y"], review_creation_date=created,
        review_answer_timestamp=answered,
        order_purchase_timestamp=dt.datetime(2018, 1, 6, 15, 30),  # a Saturday
        order_delivered_customer_date=dt.datetime(2018, 1, 20), order_estimated_delivery_date=dt.datetime(2018, 1, 16),
    )]).withColumn("payment_value", F.lit(None).cast("double"))


def test_sentinel_dates_are_missing_by_default(spark):
    df = _feature_frame(spark, dt.date(1900, 1, 1), dt.datetime(2018, 1, 25))
    r = features.add_features(df).first()
    assert r.time_from_delivery_to_review is None and r.time_to_response is None
    kept = features.add_features(df, keep_sentinels=True).first()
    assert kept.time_to_response > 40000
    assert (r.hour_of_day, r.order_day_type, r.is_delivered, r.is_payment_missing) == (15, "Weekend", 1, 1)
    assert (r.actual_delivery_time, r.estimated_delivery_time, r.delivery_delay_time, r.is_late) == (14, 10, 4, 1)
    assert r.order_revenue == 12.5


def test_rank_and_dense_rank_ties(spark):
    prices = [100.0, 90.0, 90.0, 80.0, 70.0, 60.0, 50.0]
    df = spark.createDataFrame([("s1", f"o{i}", "1", p) for i, p in enumerate(prices)],
                               "seller_id string, order_id string, item_order_item_id string, price double")
    ranks = sorted(r["rank"] for r in kpis.top_items_per_seller(df, 5).collect())
    dense = sorted(r["dense_rank"] for r in kpis.top_items_per_seller(df, 5, dense=True).collect())
    assert ranks == [1, 2, 2, 4, 5]            # rank skips after the tie
    assert dense == [1, 2, 2, 3, 4, 5]         # dense_rank does not


def test_single_row_group_has_null_stddev(spark):
    df = spark.createDataFrame([("s1", "o1", 10.0, None)],
                               "seller_id string, order_id string, price double, review_scores array<int>")
    r = kpis.seller_scorecard(df).first()
    assert r.price_variability is None and r.total_revenue == 10.0 and r.avg_review_score is None


def test_encoding_report_finds_replacement_char(spark):
    df = spark.createDataFrame([("ok text",), ("bad � text",), ("bell\x07",)], "t string")
    r = quality.encoding_report(df, "x").first()
    assert r.bad_rows == 2


def test_clean_reviews_rules(spark):
    df = spark.createDataFrame([
        ("r1", "a" * 32, None, None, None, None, None),
        ("r2", "2018-01-01 10:00:00", 3, "t", "m", dt.date(2018, 1, 1), dt.datetime(2018, 1, 2)),
        ("r3", None, 4, "t", None, dt.date(2018, 1, 1), dt.datetime(2018, 1, 2)),
        (None, "b" * 32, 4, "t", "m", dt.date(2018, 1, 1), dt.datetime(2018, 1, 2)),
    ], schemas.ORDER_REVIEWS)
    out = clean.clean_reviews(df).collect()
    assert [r.review_id for r in out] == ["r1"]
    r = out[0]
    assert (r.review_score, r.review_comment_title, r.review_comment_message, r.has_review) == \
        (-1, "No Review", "No Review", "No Comment")
    assert r.review_creation_date == dt.date(1900, 1, 1)
    assert clean.invalid_review_rows(df).count() == 1


def test_clean_orders_approval_fill(spark):
    df = spark.createDataFrame([
        ("o1", "c1", "delivered", dt.datetime(2018, 1, 1, 9), None, None, None, None),
        ("o2", "c1", "canceled", dt.datetime(2018, 1, 1, 9), None, None, None, None),
        ("o3", None, "shipped", dt.datetime(2018, 1, 1, 9), None, None, None, None),
    ], schemas.ORDERS)
    got = {r.order_id: r.order_approved_at for r in clean.clean_orders(df).collect()}
    assert got == {"o1": dt.datetime(2018, 1, 1, 9), "o2": dt.datetime(1900, 1, 1)}


def test_payments_impute_and_recode(spark):
    df = spark.createDataFrame([("o1", 1, "boleto", 1, 10.0), ("o1", 2, None, 1, None),
                                ("o2", 1, "not_defined", 2, 20.0)], schemas.ORDER_PAYMENTS)
    out = {(r.payment_order_id, r.payment_sequential): r for r in clean.clean_payments(df).collect()}
    assert out[("o1", 2)].payment_value_imputed == 15.0
    assert out[("o1", 1)].payment_type == "Bank Transfer" and out[("o1", 2)].payment_type == "other"
    agg = {r.payment_order_id: r for r in preagg.payments_per_order(clean.clean_payments(df)).collect()}
    assert agg["o1"].payment_split_count == 2 and agg["o1"].payment_value == 10.0
    assert agg["o1"].payment_value_imputed == 25.0 and sorted(agg["o1"].payment_type) == ["Bank Transfer", "other"]


def test_product_size_quartile_bands(spark):
    rows = [(str(i), "cat", 1, 1, 1, None if w is None else float(w), 1.0, 1.0, 1.0) for i, w in enumerate([None, 1, 2, 3, 4, 5, 6, 7])]
    df = spark.createDataFrame(rows, schemas.PRODUCTS)
    out = {r.product_weight_g: r.product_size for r in clean.clean_products(df).collect()}
    # weights 0 (filled), 1..7: discrete quartiles 1, 3, 5
    assert out[0.0] == "Small" and out[1.0] == "Small" and out[2.0] == "Medium" and out[3.0] == "Medium"
    assert out[4.0] == "Large" and out[5.0] == "Large" and out[6.0] == "Extra Large"


def test_money_average_rounds_ties_half_up(spark):
    df = spark.createDataFrame([("a", 10.01), ("a", 10.02)], "k string, price double")
    r = df.groupBy("k").agg(C.money_avg("price").alias("m"), C.money_sum("price").alias("s")).first()
    assert r.m == 10.02 and r.s == 20.03


def test_failure_log_and_summary(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", -1.0), ("c", None)], "id string, v double")
    rules = {"negative": F.col("v") < 0, "missing": F.col("v").isNull()}
    log = sorted((r.record_id, r.rule) for r in quality.failure_log(df, "t", F.col("id"), rules).collect())
    assert log == [("b", "negative"), ("c", "missing")]
    summ = {r.rule: (r.failures, r.passed) for r in quality.failure_summary(df, "t", rules).collect()}
    assert summ == {"negative": (1, False), "missing": (1, False)}


def test_zscore_and_iqr(spark):
    vals = [10.0] * 20 + [1000.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    z = quality.zscore_outliers(df, "x").first()
    assert z.outliers == 1
    q = quality.iqr_outliers({"t": (df, ["x"])}).first()
    assert (q.below, q.above) == (0, 1)
    assert not math.isnan(q.upper_fence)


def test_global_rank_matches_window_rank(spark):
    from pyspark.sql import Window

    from ordermart.operators.ranking import global_rank
    vals = [5.0, 3.0, 3.0, None, 9.0, 1.0, 3.0, 9.0, 0.5, None, 7.0]
    df = spark.createDataFrame([(f"k{i}", v) for i, v in enumerate(vals)], "k string, v double")
    w = Window.orderBy(F.desc_nulls_last("v"))
    for dense in (False, True):
        want = {r.k: r.r for r in df.select("k", (F.dense_rank() if dense else F.rank()).over(w).alias("r")).collect()}
        got = {r.k: r.r for r in global_rank(df, "v", "r", dense=dense, partitions=4).collect()}
        assert got == want


def test_ml_imputer_matches_scalar_mean(spark):
    df = spark.createDataFrame([("o1", 1, "boleto", 1, 10.0), ("o1", 2, "voucher", 1, None),
                                ("o2", 1, "voucher", 2, 20.0)], schemas.ORDER_PAYMENTS)
    ml = {r.payment_sequential * 10 + len(r.order_id): r.payment_value_imputed
          for r in clean.impute_mean_ml(df).collect()}
    ours = {r.payment_sequential * 10 + len(r.payment_order_id): r.payment_value_imputed
            for r in clean.clean_payments(df).collect()}
    assert ml == ours


def test_registry_and_persist(spark):
    from ordermart.plans import physical, sinks
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert sinks.register({"tmp_registry_x": df}) == ["tmp_registry_x"]
    assert spark.table("tmp_registry_x").count() == 2
    p = physical.persist_for_reuse(df)
    assert "Disk" in physical.storage_level(p) or "disk" in physical.storage_level(p).lower()
    p.unpersist()


def test_exact_quantiles_match_sorting(spark):
    import random

    from ordermart.functions import stats
    rng, probs = random.Random(5), (0.0, 0.25, 0.5, 0.75, 0.999, 1.0)
    for n in (0, 1, 7, 4000):
        values = [rng.choice([rng.gauss(0, 1), 1.5, 2.5]) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in values + [None] * 3], "x double").repartition(4)
        got = df.agg(F.count("x")).select(*[q.alias(f"q{i}") for i, q in enumerate(stats.quantiles(df, "x", probs))]).first()
        s = sorted(values)
        assert list(got) == [s[max(1, math.ceil(p * n)) - 1] if n else None for p in probs]


def test_line_counts_over_several_files(spark, scratch):
    header = ",".join(schemas.column_names("order_reviews"))
    for k in range(3):
        write_text(f"{scratch}/many/part-{k}.csv", header + "\n" + "".join(
            f'r{k}{i},o1,5,title,"one\ntwo",2018-01-02,2018-01-03 10:00:00\n' for i in range(k)))
    check = quality.line_count_check(spark, f"{scratch}/many", "order_reviews").first()
    assert (check.data_lines, check.records_multiline, check.records_naive) == (6, 3, 6)


def test_schema_report(spark, small_dir):
    from ordermart.sources.adapter import SourceTables
    rows = quality.schema_report(spark, SourceTables(spark, small_dir).all()).collect()
    assert rows and {r.status for r in rows} <= {"ok", "type_mismatch"}
    bad = quality.schema_report(spark, {"sellers": spark.range(1)}).collect()
    assert {r.status for r in bad} == {"missing", "unexpected"}


def test_unit_join_leaves_unknown_units_null(spark):
    df = spark.createDataFrame([("p", 1500.0, 2.0)], "product_id string, w double, x double")
    rows = {r.measure: r.standard_value for r in quality.standardize_units(df, quality.unit_table(spark), {"w": "g", "x": "ell"}).collect()}
    assert rows == {"w": 1.5, "x": None}
