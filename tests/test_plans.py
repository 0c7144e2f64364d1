"""Physical-plan properties the design relies on."""

import uuid

import pytest
from pyspark.sql import functions as F

from ordermart.catalog import spark_queries as SQ
from ordermart.operators import clean, kpis, quality, segments, wide
from ordermart.plans import physical, sinks
from ordermart.sources.adapter import SourceTables


def test_wide_table_shape_and_no_duplicate_columns(spark, small_dir):
    w = wide.build_wide(SourceTables(spark, small_dir))
    assert len(w.columns) == 72
    assert quality.duplicate_columns(w) == []
    assert w.columns[0] == "product_category_name" and w.columns[-1] == "order_year_month"


def test_wide_rows_equal_items_with_an_order(spark, small_dir):
    t = SourceTables(spark, small_dir)
    w = wide.build_wide(t)
    o = clean.clean_orders(t.orders).select("order_id")
    expected = t.order_items.join(o, "order_id", "left_semi").count()
    assert w.count() == expected


def test_dimension_joins_are_broadcast_and_items_meet_orders_once(spark, small_dir):
    w = wide.build_wide(SourceTables(spark, small_dir))
    plan = physical.plan_text(w, "formatted")
    assert plan.count("BroadcastHashJoin") >= 4          # products, sellers, geo, translation
    # the item side meets the order side in exactly one equi-join on the order id
    joins = [ln for ln in physical.plan_text(w, "simple").splitlines()
             if "Join" in ln and "item_order_id" in ln]
    assert len(joins) == 1


def test_top_k_per_seller_uses_window_group_limit(spark, small_dir):
    df = kpis.top_items_per_seller(wide.build_wide(SourceTables(spark, small_dir)), 5)
    df.write.format("noop").mode("overwrite").save()
    assert "WindowGroupLimit" in physical.plan_text(df, "formatted")


def test_whole_rows_per_seller_are_read_by_address(spark, small_dir, scratch):
    """Seller, price and address are ranked; no other column is shuffled."""
    path = f"{scratch}/silver/final_df"
    sinks.write_wide(wide.build_wide(SourceTables(spark, small_dir)), path)
    seen = []
    write = sinks.materialize
    try:
        sinks.materialize = lambda df, *a: (seen.append(df), write(df, *a))[1]
        top = kpis.top_rows_per_seller(spark, path, 5)
    finally:
        sinks.materialize = write
    ranked = physical.plan_text(seen[0])
    read = [line for line in ranked.splitlines() if "ReadSchema" in line]
    assert "WindowGroupLimit" in ranked and len(read) == 1 and "seller_id" in read[0] and read[0].count(":") <= 4
    assert len(top.columns) == 73 and "Window" not in physical.plan_text(top)
    assert "Exchange hashpartitioning" not in physical.plan_text(top)          # the addresses are broadcast
    want = kpis.top_items_per_seller(spark.read.parquet(path), 5)
    key = ["seller_id", "price", "rank", "order_id", "item_order_item_id", "customer_city"]
    assert sorted(map(str, top.select(*key).collect())) == sorted(map(str, want.select(*key).collect()))


def test_uniqueness_reads_each_table_once(spark, small_dir):
    t = SourceTables(spark, small_dir)
    report = quality.uniqueness({"order_items": (t.order_items, ["order_id", "product_id", "seller_id"]),
                                 "sellers": (t.sellers, ["seller_id", "seller_city"])})
    plan = physical.plan_text(report, "simple")
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange") == 1
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (None,), (None,), (1.0,)], "x double")
    rows = quality.uniqueness({"z": (zeros, ["x"])}).collect()
    assert sorted((str(r.value), r["count"]) for r in rows) == [("0.0", 2), ("None", 2)]


def test_bucketed_tables_join_without_a_shuffle(spark, small_dir):
    joined = SQ.QUERIES["bucketed_orders_items"](spark, small_dir)
    plan = physical.plan_text(joined, "simple")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_as_written_geolocation_splits_a_hot_zip(spark, small_dir, monkeypatch):
    """The split join gives the rows of the plain one, and a zip's items go
    to as many tasks as it has slices."""
    t = SourceTables(spark, small_dir)
    columns = ["order_id", "item_order_item_id", "customer_zip_code_prefix", *wide.GEO_COLUMNS, "price"]
    plain = wide.build_wide(t, columns, geo_mode="as_written", max_bytes=1 << 60)
    monkeypatch.setattr(wide, "ZIP_ROWS", 50)
    split = wide.build_wide(t, columns, geo_mode="as_written", max_bytes=0)
    assert ["_slice" in physical.plan_text(df, "extended") for df in (split, plain)] == [True, False]
    assert _fingerprint(split) == _fingerprint(plain)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        split = wide.build_wide(t, columns, geo_mode="as_written", max_bytes=0)
        parts = (split.withColumn("part", F.spark_partition_id()).groupBy("customer_zip_code_prefix")
                 .agg(F.countDistinct("part").alias("n"), F.count("*").alias("rows")))
        assert parts.orderBy(F.desc("rows")).first().n >= 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_top_k_is_take_ordered(spark, small_dir):
    df = SQ.QUERIES["k09_top_products"](spark, small_dir)
    assert "TakeOrderedAndProject" in physical.plan_text(df, "simple")


def test_statistics_are_scalar_subqueries_not_cross_joins(spark, small_dir):
    t = SourceTables(spark, small_dir)
    for df in (clean.clean_payments(t.order_payments), clean.clean_products(t.products)):
        plan = physical.plan_text(df, "formatted")
        assert "Subquery" in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_silver_partition_pruning_and_column_pruning(spark, small_dir, scratch):
    path = f"{scratch}/silver/final_df"
    sinks.write_wide(wide.build_wide(SourceTables(spark, small_dir)), path)
    final = spark.read.parquet(path)
    months = [r.order_year_month for r in final.select("order_year_month").distinct().limit(1).collect()]
    q = kpis.state_volume(final.filter(F.col("order_year_month") == months[0]))
    plan = physical.plan_text(q, "formatted")
    assert "PartitionFilters: [isnotnull(order_year_month" in plan
    assert "PushedFilters: [IsNotNull(order_status), EqualTo(order_status,delivered)]" in plan
    read_schema = [ln for ln in plan.splitlines() if "ReadSchema" in ln][0]
    assert "price" in read_schema and "review_message" not in read_schema and "customer_city" not in read_schema


def test_broadcast_only_after_size_check(spark, small_dir):
    t = SourceTables(spark, small_dir)
    bound = physical.plan_bytes(t.order_items) - 1
    assert physical.plan_bytes(t.sellers) < bound
    small = physical.broadcast_if_small(t.sellers, bound)
    big = physical.broadcast_if_small(t.order_items, bound)
    assert "broadcast" in physical.plan_text(small, "extended").lower()
    assert "ResolvedHint" not in physical.plan_text(big, "extended")
    unknown = spark.createDataFrame([(1,)], "x int").rdd.toDF()
    assert not physical.is_small(unknown)


@pytest.fixture()
def jobs(spark):
    """Counts the jobs that run inside ``with jobs() as n``."""
    from contextlib import contextmanager

    @contextmanager
    def counted():
        group = f"count-{uuid.uuid4().hex}"
        spark.sparkContext.setJobGroup(group, group)
        found = []
        try:
            yield found
        finally:
            found += spark.sparkContext.statusTracker().getJobIdsForGroup(group)
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return counted


@pytest.mark.parametrize("key", ["k06_seller_revenue", "k18_row_count", "orders_items_inner", "k09_top_products", "dq_hex_ids"])
def test_building_a_query_runs_no_job_and_scans_items_once(spark, small_dir, jobs, key):
    with jobs() as ran:
        df = SQ.QUERIES[key](spark, small_dir)
        plan = physical.plan_text(df, "formatted")
    # reading a table's schema is the only job: one short footer read per table
    assert all(len(spark.sparkContext.statusTracker().getJobInfo(j).stageIds) == 1 for j in ran)
    tables = [ln for ln in plan.splitlines() if "Location" in ln]
    assert sum("lineitem.parquet" in ln for ln in tables) == (2 if key == "dq_hex_ids" else 1)


def test_build_joins_only_what_is_asked_for(spark, small_dir):
    t = SourceTables(spark, small_dir)
    plan = physical.plan_text(wide.build_wide(t, ["order_id", "price"]), "simple")
    assert plan.count("Join") == 1
    with pytest.raises(ValueError):
        wide.build_wide(t, ["no_such_column"])


def test_money_totals_do_not_depend_on_the_partitioning(spark):
    from ordermart.functions import columns as C
    df = spark.range(2_000_000).select(((F.col("id") * 7919 % 1_000_003) / 100).alias("v"))
    totals = {df.repartition(n).agg(C.money_sum("v"), C.money_avg("v")).first() for n in (4, 7, 64)}
    assert len(totals) == 1


def test_no_single_partition_fed_by_limits(spark, small_dir):
    for key in ("k06_seller_revenue", "wide_geo_default"):
        assert "LocalLimit" not in physical.plan_text(SQ.QUERIES[key](spark, small_dir), "formatted")


@pytest.mark.parametrize("dimension,key", [("products", "product_id"), ("sellers", "seller_id"),
                                           ("customers", "customer_id"), ("category_translation", "product_category_name")])
def test_segments_equal_the_wide_tables_own_aggregate_with_repeated_keys(spark, small_dir, dimension, key):
    t = SourceTables(spark, small_dir).all()
    t[dimension] = t[dimension].unionByName(t[dimension])
    w = wide.build_wide(t, ["order_customer_id", "order_id", "price", *wide.SEGMENT_COLUMNS])
    own = segments.customer_spend(w)
    got = w.select(F.col("order_customer_id"), "total_orders", "total_spent", "AOV").distinct()
    assert got.count() == own.count()
    assert got.exceptAll(own.select(*got.columns)).count() == 0


def test_reliable_lineage_cut(spark, small_dir):
    t = SourceTables(spark, small_dir)
    spend = t.order_items.groupBy("order_id").agg(F.sum("price").alias("s"))
    back = sinks.materialize(spend, spark, f"test-{uuid.uuid4().hex}")
    assert back.count() == spend.count()
    assert "Exchange" not in physical.plan_text(back, "simple")


def test_partition_histogram(spark, small_dir):
    t = SourceTables(spark, small_dir)
    sizes = physical.partition_sizes(t.order_items)
    assert sum(r["count"] for r in sizes.collect()) == t.order_items.count()


def _fingerprint(df):
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.agg(F.count("*").alias("n"), F.sum(F.pmod(h, F.lit(1000003))).alias("h")).first()


def test_large_dimensions_take_the_shuffle_path_with_same_result(spark, small_dir):
    t = SourceTables(spark, small_dir)
    default = wide.build_wide(t)
    forced = wide.build_wide(t, max_bytes=0)   # no dimension passes the size check
    assert _fingerprint(default) == _fingerprint(forced)


def test_review_summary_mode_gives_the_same_kpis(spark, small_dir):
    t = SourceTables(spark, small_dir)
    lists = wide.build_wide(t)
    summ = wide.build_wide(t, review_mode="summary")
    assert "review_scores" not in summ.columns and "review_count" in summ.columns
    for fn in (kpis.seller_scorecard, kpis.product_scorecard, kpis.seller_review):
        assert _fingerprint(fn(lists)) == _fingerprint(fn(summ))
    feats = ["order_id", "item_order_item_id", "has_review", "time_from_delivery_to_review", "time_to_response"]
    assert _fingerprint(lists.select(*feats)) == _fingerprint(summ.select(*feats))


def test_managed_partitioned_table(spark, small_dir):
    name = f"ordermart_gold_t.final_{uuid.uuid4().hex[:10]}"
    sinks.create_database(spark, name.split(".")[0])
    w = wide.build_wide(SourceTables(spark, small_dir))
    sinks.save_table(w, name)
    t = spark.table(name)
    assert t.count() == w.count() and sorted(t.columns) == sorted(w.columns) and len(t.columns) == 72
    assert "order_year_month" in [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def test_explicit_join_partitioning(spark, small_dir):
    t = SourceTables(spark, small_dir)
    default = wide.build_wide(t)
    parted = wide.build_wide(t, partitions=4)
    plan = physical.plan_text(parted, "simple")
    assert "REPARTITION_BY_NUM" in plan and "hashpartitioning(order_id" in plan
    assert _fingerprint(default) == _fingerprint(parted)


def test_a_hot_order_is_split_by_the_engine(spark):
    """The order side comes out of a join on the order id, as in the wide
    table, and the hot order's partition is still split at run time."""
    hot = "f" * 32
    orders = spark.range(401).select(
        F.when(F.col("id") == 400, F.lit(hot)).otherwise(F.md5(F.col("id").cast("string"))).alias("order_id"))
    paid = orders.select(F.col("order_id").alias("payment_order_id"), F.lit(1).alias("n")).groupBy("payment_order_id").agg(F.sum("n").alias("n"))
    items = spark.range(0, 80000, 1, 8).select(
        F.when(F.col("id") < 50000, F.lit(hot)).otherwise(F.md5((F.col("id") % 400).cast("string"))).alias("item_order_id"),
        F.md5(F.col("id").cast("string")).alias("note"))
    confs = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        joined = wide.order_item_join(orders.join(paid, F.col("order_id") == F.col("payment_order_id"), "left"), items)
        assert len(joined.collect()) == 80000
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["sql_path_scan", "sql_table_surface"])
def test_scans_of_the_silver_table_read_the_whole_wide_table(spark, small_dir, monkeypatch, name):
    written = []
    write = sinks.write_wide
    monkeypatch.setattr(sinks, "write_wide", lambda df, path: (write(df, path), written.append(path)))
    assert SQ.QUERIES[name](spark, small_dir).count() > 0
    assert len(spark.read.parquet(*written).columns) == 72


def test_whole_rows_are_written_without_a_shuffle(spark, scratch, jobs):
    """A write of the wide table shuffles no whole rows; months stay folders."""
    rows = spark.range(0, 4000, 1, 4).select("id", F.concat(F.lit("1998-0"), F.col("id") % 7 + 1).alias("order_year_month"),
                                             F.lit(None).cast("double").alias("payment_value"),
                                             *[F.col("id").alias(k) for k in sorted(set(quality.JOIN_KEYS.values()))])
    with jobs() as ran:
        sinks.write_wide(rows, f"{scratch}/a/final_df")
    with jobs() as observed:
        counts = quality.observed_write(rows, f"{scratch}/b/final_df").collect()
    info = spark.sparkContext.statusTracker().getJobInfo
    assert [len(info(j).stageIds) for j in ran] == [1]
    assert all(len(info(j).stageIds) == 1 for j in observed) and {r.metric: r.value for r in counts}["rows"] == 4000
    for x in "ab":
        back = spark.read.parquet(f"{scratch}/{x}/final_df")
        assert back.count() == 4000 and back.filter("order_year_month = '1998-03'").count() == rows.filter("order_year_month = '1998-03'").count()


def test_presence_build_has_the_nulls_of_the_wide_table(spark, small_dir):
    """Same rows, columns and nulls; texts and dates are not carried along.
    ``max_bytes=0`` joins the products before the orders."""
    t = SourceTables(spark, small_dir)
    full = quality.null_profile(wide.build_wide(t)).collect()
    for bound in (None, 0):
        marks = wide.build_wide(t, presence=True, max_bytes=bound)
        assert marks.columns == wide.WIDE_COLUMNS and marks.count() == wide.build_wide(t, ["order_id"]).count()
        assert sorted(map(str, quality.null_profile(marks).collect())) == sorted(map(str, full))
        assert {marks.schema[c].dataType.typeName() for c in ("review_message", "review_titles", "customer_city", "price")} == {"integer"}


def test_order_features_are_derived_once_an_order(spark, small_dir):
    """What holds for a whole order is computed below the join with its items."""
    built = wide.build_wide(SourceTables(spark, small_dir), ["order_id", "price", "order_revenue", "is_late", "order_year_month"])
    lines = physical.plan_text(built, "simple").splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "xxhash64" in line)
    for rule in ("date_format", "datediff"):
        assert any(rule in line for line in lines[join:]) and not any(rule in line for line in lines[:join])
    assert any("price" in line and "freight_value" in line and " + " in line for line in lines[:join])


def test_a_build_by_month_is_written_without_sorting_or_moving_whole_orders(spark, small_dir):
    """Order rows are sorted by month and look up their items: the wide rows
    are not sorted, and the order side is not shuffled for the item join."""
    t = SourceTables(spark, small_dir)
    built = sinks.cluster_for_write(wide.build_wide(t, by_month=True), [sinks.WIDE_PARTITION], "sort")
    lines = physical.plan_text(built, "simple").splitlines()
    join = next(i for i, line in enumerate(lines) if "ShuffledHashJoin" in line and "item_order_id" in line)
    assert not any("Sort [order_year_month" in line for line in lines[:join])
    assert sum("Sort [order_year_month" in line for line in lines[join:]) == 1
    by_order = [line for line in lines if "Exchange hashpartitioning(" in line and "REPARTITION_BY_NUM" in line]
    assert len(by_order) == 4                       # orders, payments, reviews, items
    assert not any("xxhash64" in line for line in lines)
    assert _fingerprint(wide.build_wide(t, by_month=True)) == _fingerprint(wide.build_wide(t))


def test_a_build_by_month_deals_its_rows_out_by_their_number(spark, small_dir, monkeypatch):
    t = SourceTables(spark, small_dir)
    rows = wide.build_wide(t, ["order_id"]).count()
    monkeypatch.setattr(wide, "TASK_ROWS", rows // 40)
    built = wide.build_wide(t, by_month=True)
    assert "hashpartitioning(item_order_id" in (plan := physical.plan_text(built, "simple")) and f", {-(-rows // (rows // 40))})" in plan
    assert _fingerprint(built) == _fingerprint(wide.build_wide(t))


def test_a_build_by_month_keeps_the_split_join_for_a_hot_order(spark, small_dir, monkeypatch):
    t = SourceTables(spark, small_dir)
    monkeypatch.setattr(wide, "ORDER_ROWS", 3)      # as if four items made an order hot
    built = wide.build_wide(t, by_month=True)
    joins = [line for line in physical.plan_text(built, "simple").splitlines() if "Join" in line and "item_order_id" in line]
    assert len(joins) == 1 and "SortMergeJoin" in joins[0] and "xxhash64" in joins[0]
    assert _fingerprint(built) == _fingerprint(wide.build_wide(t))


def test_a_build_by_month_keeps_the_sorted_join_for_a_hot_id_without_an_order(spark, small_dir):
    """Items of an id that no order has count: a hash join would hold them."""
    t = SourceTables(spark, small_dir).all()
    stray = t["order_items"].limit(1).withColumn("order_id", F.lit("none")).crossJoin(spark.range(wide.ORDER_ROWS + 1)).drop("id")
    t["order_items"] = t["order_items"].union(stray)
    silver = wide.Silver(t)
    built = wide.build_wide(silver, by_month=True)
    assert silver.row_figures[1] == wide.ORDER_ROWS + 1
    assert "ShuffledHashJoin" not in physical.plan_text(built, "simple")
    assert _fingerprint(built) == _fingerprint(wide.build_wide(t))
    assert silver.customer_segments().filter("order_customer_id is null").isEmpty()


def test_ids_of_any_form_survive_a_build_by_month(spark, small_dir):
    """Upper case, odd length, not hex, empty: equal to the plain build."""
    t = SourceTables(spark, small_dir).all()

    def odd(c):
        return (F.when(F.col(c).startswith("0"), F.upper(c)).when(F.col(c).startswith("1"), F.concat(F.lit("n°"), c))
                .when(F.col(c).startswith("2"), F.substring(c, 1, 31)).when(F.col(c).startswith("3"), F.concat(c, F.lit("00"))).otherwise(F.col(c)))
    for name in ("orders", "order_items", "order_payments", "order_reviews"):
        t[name] = t[name].withColumn("order_id", odd("order_id"))
    t["order_reviews"] = t["order_reviews"].withColumn("review_id", odd("review_id"))
    t["customers"] = t["customers"].withColumn("customer_unique_id", F.when(F.col("customer_id") % 5 != 0, odd("customer_unique_id")))
    t["order_items"] = t["order_items"].union(t["order_items"].limit(50).withColumn("order_id", F.lit(None).cast("string")))
    t["order_payments"] = t["order_payments"].union(t["order_payments"].limit(50).withColumn("order_id", F.lit(None).cast("string")))
    assert _fingerprint(wide.build_wide(t, by_month=True)) == _fingerprint(wide.build_wide(t))


def test_packed_ids_are_short_and_come_back(spark):
    from ordermart.functions import columns as C
    ids = ["", "a", "ab", "AB", "zz", "é", "\x01ab", "0g", "00", "00 ", None, "-1", "1" * 15, "x" * 17, "f" * 32, "F" * 32]
    df = spark.createDataFrame([(x,) for x in ids], "c string").withColumn("p", C.pack_id("c"))
    back = df.withColumn("back", C.unpack_id("p")).collect()
    assert all(r.back == r.c for r in back) and len({bytes(r.p) for r in back}) == len(ids)
    assert {len(r.p) for r in back if r.c == "f" * 32} == {17}


def test_whole_rows_are_written_with_zstd(spark, scratch):
    rows = spark.range(10).select("id", F.lit("1998-01").alias("order_year_month"))
    sinks.write_wide(rows, f"{scratch}/z/final_df")
    name = f"ordermart_gold_t.z_{uuid.uuid4().hex[:10]}"
    sinks.create_database(spark, name.split(".")[0])
    sinks.save_table(rows, name)
    for df in (spark.read.parquet(f"{scratch}/z/final_df"), spark.table(name)):
        assert df.count() == 10 and all(f.endswith(".zstd.parquet") for f in df.inputFiles())
