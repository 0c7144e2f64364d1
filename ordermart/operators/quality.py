"""Data-quality checks as ordinary DataFrames (tidy report rows).

Every check is a lazy aggregation over whole tables: per-column profiles
are a single pass (one ``agg`` of conditional counts, then ``unpivot``),
statistics are in-plan scalars, and nothing is collected to the driver.
Reports are small (one row per table/column/rule/offending key).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from ..functions import columns as C
from ..functions import stats
from ..functions.quantiles import LONG_KEYS, exact_quantiles, long_values, outliers
from ..sources import schemas


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _long(df: DataFrame, table: str, value_name: str) -> DataFrame:
    """One-row wide profile -> (table_name, column_name, value) rows."""
    return (df.unpivot([], df.columns, "column_name", value_name)
            .select(F.lit(table).alias("table_name"), "column_name", value_name))


# --- DQ1 row counts ------------------------------------------------------------
def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union(df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
                  for name, df in tables.items())


# --- DQ2 / DQ7 duplicate keys -------------------------------------------------
def duplicate_values(df: DataFrame, column: str, table: str = "") -> DataFrame:
    """Values of ``column`` that occur more than once, with their counts."""
    return uniqueness({table: (df, [column])})


def uniqueness(checks: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Duplicate values of some columns of some tables: each table is read
    once, its rows give one (table, column, value) per column, and all of
    them meet in one shuffle, added up before it. A value is compared as the
    text it is reported as (0.0 and -0.0 are the same)."""
    def entry(f) -> Column:
        c = F.col(f"`{f.name}`")
        c = c + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, (DoubleType, FloatType)) else c
        return F.struct(F.lit(f.name).alias("column_name"), c.cast("string").alias("value"))

    def rows(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        each = F.array(*[entry(df.schema[c]) for c in columns])
        return df.select(F.lit(table).alias("table_name"), F.explode(each).alias("x")).select("table_name", "x.*")

    return (_union(rows(t, df, columns) for t, (df, columns) in checks.items())
            .groupBy("table_name", "column_name", "value").count().filter("count > 1"))


# --- DQ3 / DQ4 / DQ5 null profiles ----------------------------------------------
def null_profile(df: DataFrame, table: str = "") -> DataFrame:
    """Null count of every column in one pass."""
    prof = df.select([F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _long(prof, table, "null_count")


def missing_profile(df: DataFrame, table: str = "") -> DataFrame:
    """Null count, plus NaN for floating-point columns, in one pass."""
    def missing(f):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            return F.count_if(F.isnan(c) | c.isNull())
        return F.count_if(c.isNull())
    prof = df.select([missing(f).alias(f.name) for f in df.schema.fields])
    return _long(prof, table, "missing_count")


# --- DQ6 hexadecimal ids --------------------------------------------------------
def valid_hex_ids(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is a 32-character hexadecimal id."""
    return df.filter(F.col(column).rlike(C.HEX_ID_PATTERN))


def invalid_hex_ids(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~F.col(column).rlike(C.HEX_ID_PATTERN))


def hex_id_report(df: DataFrame, column: str, table: str = "") -> DataFrame:
    """valid / invalid / null counts: nulls are a class of their own (they
    satisfy neither the pattern nor its negation)."""
    ok = F.col(column).rlike(C.HEX_ID_PATTERN)
    return df.agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"),
                  F.count_if(F.col(column).isNull()).alias("nulls")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "valid", "invalid", "nulls")


# --- DQ8 duplicate output columns -------------------------------------------------
def duplicate_columns(df: DataFrame) -> list[str]:
    """Plan-time check: column names that occur more than once."""
    names = df.columns
    return sorted({c for c in names if names.count(c) > 1})


# --- DQ9 / DQ10 join reconciliation -------------------------------------------------
def join_reconciliation(silver) -> DataFrame:
    """Row counts of the eight joins of the wide table in their original
    order, over the raw dimensions (repeated keys count).

    Each left join multiplies a row by max(1, matches of its key), so the
    count after stage j is the sum over (order, item) pairs of the running
    product of those multiplicities. The per-key match counts are small
    aggregates joined to one narrow base; no stage output is materialised.
    Items are scanned for the join and, without columns, for their count.
    """
    from . import clean
    o, i = silver.orders, silver.items
    products, sellers = clean.fill_products(silver.raw("products")), silver.raw("sellers")
    customers, translation = silver.raw("customers"), silver.raw("category_translation")

    def per_key(df, key, k, count_name, weighted_name=None, weight: Column | None = None):
        aggs = [F.count("*").alias(count_name)]
        if weight is not None:
            aggs.append(F.sum(weight).alias(weighted_name))
        return df.groupBy(F.col(key).alias(k)).agg(*aggs)

    one = F.lit(1)
    trans = translation.groupBy("product_category_name").agg(F.count("*").alias("_t"))
    prods = products.join(trans, "product_category_name", "left")
    geo_pts = silver.geo.groupBy("geolocation_zip_code_prefix").agg(F.count("*").alias("_g"))
    custs = customers.join(geo_pts, F.col("customer_zip_code_prefix") == F.col("geolocation_zip_code_prefix"), "left")
    # item-level multiplicities attach to items, order-level ones to orders;
    # the two sides then meet once on the order id
    item_side = (i.select("item_order_id", "item_product_id", "item_seller_id")
                 .join(per_key(prods, "product_id", "_k1", "P", "PT", F.greatest(F.coalesce("_t", F.lit(0)), one)),
                       F.col("item_product_id") == F.col("_k1"), "left")
                 .join(per_key(sellers, "seller_id", "_k2", "S"), F.col("item_seller_id") == F.col("_k2"), "left")
                 .select("item_order_id", "P", "PT", "S"))
    order_side = (o.select("order_id", "order_customer_id")
                  .join(per_key(custs, "customer_id", "_k4", "Cn", "CG", F.greatest(F.coalesce("_g", F.lit(0)), one)),
                        F.col("order_customer_id") == F.col("_k4"), "left")
                  .join(per_key(silver.payments, "payment_order_id", "_k3", "Y", "Ynull",
                                F.col("payment_value").isNull().cast("bigint")),
                        F.col("order_id") == F.col("_k3"), "left")
                  .join(per_key(silver.reviews, "review_order_id", "_k5", "R"), F.col("order_id") == F.col("_k5"), "left")
                  .select("order_id", "Cn", "CG", "Y", "Ynull", "R"))
    from .wide import order_item_join
    x = order_item_join(order_side, item_side)
    m = {c: F.coalesce(F.col(c), one).cast("bigint") for c in ("P", "PT", "S", "Y", "Cn", "CG", "R")}
    c2 = m["P"]
    c3 = c2 * m["S"]
    c4 = c3 * m["Y"]
    c5 = c4 * m["Cn"]
    c6 = c5 * m["R"]
    c7 = m["P"] * m["S"] * m["Y"] * m["CG"] * m["R"]
    c8 = m["PT"] * m["S"] * m["Y"] * m["CG"] * m["R"]
    counts = x.agg(
        F.count("*").alias("s1"), F.sum(c2).alias("s2"), F.sum(c3).alias("s3"), F.sum(c4).alias("s4"),
        F.sum(c5).alias("s5"), F.sum(c6).alias("s6"), F.sum(c7).alias("s7"), F.sum(c8).alias("s8"),
        # rows whose payment_value is null after the payments join: no
        # payment row, or payment rows whose values are all null
        F.sum(F.when(F.col("Y").isNull(), c3).otherwise(c3 * F.col("Ynull"))).alias("u4"),
    )
    names = ["orders_items", "products", "sellers", "payments", "customers", "reviews", "geolocation",
             "translation"]
    rights = [i, products, sellers, silver.payments, customers, silver.reviews, silver.geo, translation]
    right_counts = _union(r.agg(F.count("*").alias("right_rows")).select(F.lit(n).alias("stage_name"), "right_rows")
                          for n, r in zip(names, rights))
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(k + 1).alias("stage"), F.lit(n).alias("stage_name"),
                 F.col(f"s{k + 1}").cast("bigint").alias("output_rows"),
                 (F.coalesce(F.col("u4"), F.lit(0)) if n == "payments" else F.lit(None)).cast("bigint")
                 .alias("null_payment_rows"))
        for k, n in enumerate(names)])).alias("r")).select("r.*")
    return stacked.join(right_counts, "stage_name").select("stage", "stage_name", "right_rows", "output_rows",
                                                           "null_payment_rows")


#: columns of the wide table that are null where a left join found nothing
JOIN_KEYS = {"products": "product_id", "sellers": "seller_id", "payments": "payment_order_id", "customers": "customer_id",
             "reviews": "review_order_id", "geolocation": "geolocation_zip_code_prefix",
             "translation": "product_category_name_english"}


def observed_write(wide: DataFrame, path: str) -> DataFrame:
    """Write the wide table and report what was counted while its rows went
    to the files: all of them, those without a partner in each left join, and
    those without a payment value. Nothing is evaluated a second time; the
    counts belong to the tasks that wrote, so retried ones count once."""
    from pyspark.sql import Observation

    from ..plans import sinks
    counts = {"rows": F.count(F.lit(1)), "null_payment_value": F.count_if(F.col("payment_value").isNull())}
    counts |= {f"without_{name}": F.count_if(F.col(key).isNull()) for name, key in JOIN_KEYS.items()}
    seen = Observation("wide-write")
    sinks.write_wide(sinks.cluster_for_write(wide, [sinks.WIDE_PARTITION], "sort").observe(seen, *[c.alias(n) for n, c in counts.items()]),
                     path, how="none")
    return wide.sparkSession.createDataFrame(sorted(seen.get.items()), "metric string, value long")


# --- DQ11 / DQ12 -----------------------------------------------------------------------
def orders_per_key_having(spark: SparkSession, df: DataFrame, key: str = "order_id") -> DataFrame:
    """``GROUP BY key HAVING count(*) > 1`` through the SQL surface."""
    return spark.sql(f"SELECT {key}, count(*) AS count FROM {{t}} GROUP BY {key} HAVING count(*) > 1", t=df)


# --- DQ13 schema validation ------------------------------------------------------------
_COMPATIBLE = {("timestamp", "timestamp_ntz")}


def schema_report(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Declared vs actual columns/types per table: ok, type_mismatch,
    missing or unexpected. Built from table metadata (schemas), not data."""
    rows = []
    for name, df in tables.items():
        expected = {f.name: f.dataType.simpleString() for f in schemas.struct(name).fields}
        actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        for col in list(expected) + [c for c in actual if c not in expected]:
            e, a = expected.get(col), actual.get(col)
            if e is None:
                status = "unexpected"
            elif a is None:
                status = "missing"
            elif e == a or (e, a) in _COMPATIBLE:
                status = "ok"
            else:
                status = "type_mismatch"
            rows.append((name, col, e, a, status))
    return spark.createDataFrame(rows, "table_name string, column_name string, expected_type string, "
                                       "actual_type string, status string")


# --- DQ14 null thresholds ----------------------------------------------------------------
def null_thresholds(df: DataFrame, table: str, limits: Mapping[str, float],
                    default_limit: float = 1.0) -> DataFrame:
    """Null ratio per column against its allowed maximum."""
    prof = df.select(F.count("*").alias("_rows"),
                     *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = prof.unpivot(["_rows"], df.columns, "column_name", "null_count")
    limit = F.coalesce(F.element_at(F.create_map(*[x for k, v in limits.items()
                                                   for x in (F.lit(k), F.lit(float(v)))]),
                                    F.col("column_name")) if limits else F.lit(None),
                       F.lit(float(default_limit)))
    ratio = F.try_divide(F.col("null_count").cast("double"), F.col("_rows"))
    return long.select(F.lit(table).alias("table_name"), "column_name", "null_count",
                       F.col("_rows").alias("row_count"), F.round(ratio, 6).alias("null_ratio"),
                       limit.alias("max_ratio"), (F.coalesce(ratio, F.lit(0.0)) <= limit).alias("passed"))


# --- DQ15 duplicate rows -----------------------------------------------------------------------
def duplicate_rows(df: DataFrame, table: str = "") -> DataFrame:
    """Groups of identical full rows: how many groups and surplus rows."""
    g = df.groupBy(*df.columns).count().filter("count > 1")
    return g.agg(F.count("*").alias("duplicate_groups"),
                 F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("surplus_rows")).select(
        F.lit(table).alias("table_name"), "duplicate_groups", "surplus_rows")


# --- DQ16 / DQ17 / DQ18 / DQ20: rule counts ----------------------------------------------
def rule_counts(df: DataFrame, table: str, rules: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """For each rule (checked-rows predicate, violation predicate): how many
    rows were checked and how many violate it, in one pass."""
    aggs = []
    for name, (checked, bad) in rules.items():
        aggs += [F.count_if(checked).alias(f"{name}__checked"), F.count_if(checked & bad).alias(f"{name}__bad")]
    prof = df.agg(*aggs)
    return prof.select(F.explode(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(n).alias("rule"),
                 F.col(f"`{n}__checked`").alias("checked_rows"), F.col(f"`{n}__bad`").alias("violations"))
        for n in rules])).alias("r")).select("r.*")


def format_rule(column: str, pattern: str) -> tuple[Column, Column]:
    c = F.col(column)
    return c.isNotNull(), ~c.rlike(pattern)


EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def values_missing_from(df: DataFrame, table: str, column: str, reference: DataFrame,
                        ref_column: str) -> DataFrame:
    """Values of ``column`` absent from a reference table's column (null
    included), with row counts: an anti join, so the reference list may be
    as large as a dimension."""
    ref = reference.select(F.col(ref_column).alias("_ref")).distinct()
    return (df.join(ref, F.col(column) == F.col("_ref"), "left_anti").groupBy(column).count()
            .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                    F.col(column).cast("string").alias("value"), "count"))


def allowed_values(df: DataFrame, table: str, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the allowed list (null included), with row counts."""
    c = F.col(column)
    bad = ~F.coalesce(c.isin(list(allowed)), F.lit(False))
    return (df.filter(bad).groupBy(column).count()
            .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                    c.cast("string").alias("value"), "count"))


def range_rule(column: str, low=None, high=None) -> tuple[Column, Column]:
    c = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return c.isNotNull(), bad


def order_rule(earlier: str, later: str) -> tuple[Column, Column]:
    """``later >= earlier`` whenever both are present."""
    return F.col(earlier).isNotNull() & F.col(later).isNotNull(), F.col(later) < F.col(earlier)


# --- DQ19 outliers -------------------------------------------------------------------------
def iqr_outliers(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], k: float = 1.5) -> DataFrame:
    """Tukey fences from exact quartiles of some columns of some tables, and
    the rows below and above them: each table is read twice, whatever the
    number of columns."""
    found = outliers(long_values(tables), LONG_KEYS, k)
    return found.select(*LONG_KEYS, "q1", "q3", F.round("lower", 4).alias("lower_fence"),
                        F.round("upper", 4).alias("upper_fence"), "checked_rows", "below", "above")


def group_outliers(df: DataFrame, group: str, column: str, k: float = 1.5) -> DataFrame:
    """The same within each group (a hot one is no single task's work). Group
    and value are written once for both scans."""
    import uuid

    from ..plans.sinks import materialize
    rows = materialize(df.select(F.col(group), F.col(column).cast("double").alias("v")), df.sparkSession,
                       f"group-values-{uuid.uuid4().hex}")
    found = outliers(rows, [group], k)
    return found.select(group, "q1", "q3", F.round("lower", 4).alias("lower_fence"),
                        F.round("upper", 4).alias("upper_fence"), "checked_rows", "below", "above")


def zscore_outliers(df: DataFrame, column: str, table: str = "", limit: float = 3.0) -> DataFrame:
    """|x - mean| / stddev > limit, with the mean and deviation as in-plan
    scalars (a one-row aggregate, never a global window)."""
    mu, sd = stats.mean(df, column), stats.stddev(df, column)
    c = F.col(column)
    z = F.try_divide(c - mu, sd)
    return df.agg(F.count(c).alias("checked_rows"), F.count_if(F.abs(z) > limit).alias("outliers")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.round(mu, 4).alias("mean"),
        F.round(sd, 4).alias("stddev"), "checked_rows", "outliers")


# --- DQ21 reconciliation of totals -------------------------------------------------------------
def reconcile_totals(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str,
                     tolerance: float = 0.005) -> DataFrame:
    """Full outer join of two per-key totals (exact cents) with a status per key."""
    l = left.select(F.col(key).alias("key"), F.col(left_value).alias("left_total"))
    r = right.select(F.col(key).alias("key"), F.col(right_value).alias("right_total"))
    j = l.join(r, "key", "full")
    diff = F.round(F.col("left_total") - F.col("right_total"), 2)
    status = (F.when(F.col("right_total").isNull() & F.col("left_total").isNotNull(), "left_only")
              .when(F.col("left_total").isNull() & F.col("right_total").isNotNull(), "right_only")
              .when(F.abs(F.col("left_total") - F.col("right_total")) <= tolerance, "match")
              .otherwise("mismatch"))
    return j.select("key", "left_total", "right_total", diff.alias("difference"), status.alias("status"))


def row_differences(left: DataFrame, right: DataFrame, key: str, segments: int = 4096, fan: int = 64) -> DataFrame:
    """Rows of two tables of the same columns that have no equal in the
    other: key, side, rows. Checksums (rows, and sums of two hashes of the
    whole row) are compared by segments of the key's hash, then by ``fan``
    parts of the segments that differ; only rows of parts that differ are
    compared one by one. Equal tables shuffle checksums alone."""
    columns = [F.col(c) for c in sorted(left.columns)] + [F.col(c).isNull() for c in sorted(left.columns)]

    def hashed(df: DataFrame) -> DataFrame:
        h = F.xxhash64(F.lit(2), key)
        return df.select(F.col(key), F.pmod(h, F.lit(segments)).alias("_segment"),
                         F.pmod(F.floor(h / segments), F.lit(fan)).alias("_part"),
                         F.xxhash64(*columns).alias("_a"), F.xxhash64(F.lit(7), *columns).alias("_b"))

    sides = {"left": hashed(left), "right": hashed(right)}

    def unequal(by: list[str], frames: dict[str, DataFrame]) -> DataFrame:
        """The groups whose checksums differ: at most segments * fan rows."""
        sign = {"left": 1, "right": -1}
        both = _union(df.select(*by, F.lit(sign[s]).alias("_s"), "_a", "_b") for s, df in frames.items())
        total = lambda c: F.sum(F.col("_s") * F.col(c).cast("decimal(20,0)")).alias(c)
        return (both.groupBy(*by).agg(F.sum("_s").alias("_n"), total("_a"), total("_b"))
                .filter("_n <> 0 or _a <> 0 or _b <> 0").select(*by))

    within = lambda by, groups: {s: df.join(F.broadcast(groups), by, "left_semi") for s, df in sides.items()}
    first = unequal(["_segment"], sides)
    parts = unequal(["_segment", "_part"], within(["_segment"], first))
    rows = _union(df.select(F.col(key), F.lit(s).alias("side"), "_a", "_b") for s, df in within(["_segment", "_part"], parts).items())
    surplus = (rows.groupBy(key, "_a", "_b").agg(F.sum(F.when(F.col("side") == "left", 1).otherwise(-1)).alias("n"))
               .filter("n <> 0"))
    side = F.when(F.col("n") > 0, "left").otherwise("right")
    return surplus.groupBy(key, side.alias("side")).agg(F.sum(F.abs("n")).alias("rows"))


# --- DQ22 distribution drift -----------------------------------------------------------------
def category_drift(df: DataFrame, period: str, category: str) -> DataFrame:
    """Share of each category per period next to the previous period's."""
    counts = df.groupBy(period, category).agg(F.count("*").alias("rows"))
    totals = counts.groupBy(period).agg(F.sum("rows").alias("_total"))
    share = (counts.join(totals, period)
             .select(period, category, "rows", F.round(F.col("rows") / F.col("_total"), 6).alias("share")))
    prev_key = F.date_format(F.add_months(F.to_date(F.concat(F.col(period), F.lit("-01"))), 1), "yyyy-MM")
    prev = share.select(prev_key.alias(period), F.col(category), F.col("share").alias("prev_share"))
    return (share.join(prev, [period, category], "left")
            .withColumn("delta", F.round(F.col("share") - F.col("prev_share"), 6)))


def numeric_drift(df: DataFrame, period: str, column: str, bins: int = 8) -> DataFrame:
    """Population stability of a numeric column: the share of each of
    ``bins`` bins, which the exact quantiles of all rows bound, per period
    (a month, yyyy-MM) against the month before it. Bins without rows count
    half a row. period, rows, prev_rows, psi."""
    import uuid

    from ..functions.quantiles import column_values
    from ..plans.sinks import materialize
    # bounds and shares need several scans; what df is joined from is read for the first only
    df = materialize(df.select(period, column), df.sparkSession, f"numeric-drift-{uuid.uuid4().hex}")
    edges = exact_quantiles(column_values(df, column), ["column_name"], [k / bins for k in range(1, bins)])
    edge = edges.select("quantiles").scalar()
    below = sum((F.col(column) > F.get(edge, F.lit(k))).cast("int") for k in range(bins - 1))
    counts = (df.filter(F.col(period).isNotNull() & F.col(column).isNotNull())
              .groupBy(F.col(period).alias("period"), below.alias("_bin")).agg(F.count("*").alias("_n")))
    each = counts.groupBy("period").pivot("_bin", list(range(bins))).agg(F.first("_n"))      # one row a period
    n = [F.coalesce(F.col(f"`{k}`"), F.lit(0)) for k in range(bins)]
    now = each.select("period", sum(n[1:], n[0]).alias("rows"), F.array(*n).alias("_bins"))
    before = now.select(F.date_format(F.add_months(F.to_date(F.concat("period", F.lit("-01"))), 1), "yyyy-MM").alias("period"),
                        F.col("rows").alias("prev_rows"), F.col("_bins").alias("_prev"))
    share = lambda x, total: (x + F.lit(0.5)) / (total + F.lit(0.5 * bins))
    terms = F.zip_with("_bins", "_prev", lambda a, b: (share(a, F.col("rows")) - share(b, F.col("prev_rows")))
                       * F.ln(share(a, F.col("rows")) / share(b, F.col("prev_rows"))))
    psi = F.round(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), 6)
    return now.join(before, "period", "left").select("period", "rows", "prev_rows", psi.alias("psi"))


# --- DQ23 summary statistics -------------------------------------------------------------------------
def summary_stats(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Count, mean, deviation, range and exact quartiles of some columns of
    some tables; each table is read twice."""
    v = F.col("v")
    found = exact_quantiles(long_values(tables), LONG_KEYS, (0.25, 0.5, 0.75), count=F.count(v),
                            mean=F.round(F.avg(v), 4), stddev=F.round(F.stddev_samp(v), 4), min=F.min(v), max=F.max(v))
    q = F.col("quantiles")
    return found.select(*LONG_KEYS, "count", "mean", "stddev", "min", q[0].alias("p25"), q[1].alias("median"),
                        q[2].alias("p75"), "max")


# --- DQ24 file lines vs parsed records ---------------------------------------------------------------
def line_count_check(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Physical lines of headered CSV files against records parsed with and
    without multi-line quoting (a gap means embedded newlines). Every file
    that has a line has a header."""
    from ..sources.readers import read_csv
    multi = read_csv(spark, path, table, multiline=True).agg(F.count("*")).scalar()
    naive = read_csv(spark, path, table, multiline=False).agg(F.count("*")).scalar()
    files = spark.read.text(path).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("lines"))
    return files.agg(F.coalesce(F.sum(F.col("lines") - 1), F.lit(0)).alias("data_lines")).select(
        F.lit(table).alias("table_name"), "data_lines", multi.alias("records_multiline"),
        naive.alias("records_naive"))


# --- DQ25 encoding ---------------------------------------------------------------------------------------
BAD_TEXT_PATTERN = r"[\x{FFFD}\x{0000}-\x{0008}\x{000B}\x{000C}\x{000E}-\x{001F}\x{007F}]"


def encoding_report(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per text column holding U+FFFD or control characters."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    prof = df.select([F.count_if(F.col(c).rlike(BAD_TEXT_PATTERN)).alias(c) for c in cols])
    return _long(prof, table, "bad_rows")


# --- DQ26 freshness -------------------------------------------------------------------------------------------
def freshness(df: DataFrame, ts: str, table: str, as_of: str | None = None, max_days: int = 1) -> DataFrame:
    latest = F.max(ts)
    ref = F.lit(as_of).cast("date") if as_of else F.current_date()
    lag = F.datediff(ref, latest)
    return df.agg(latest.alias("latest"), lag.alias("lag_days")).select(
        F.lit(table).alias("table_name"), "latest", "lag_days", (F.col("lag_days") <= max_days).alias("fresh"))


# --- DQ27 masking -------------------------------------------------------------------------------------------
def keyed_pseudonym(value: Column | str, key: bytes) -> Column:
    """HMAC-SHA256 of a text, as hex: without the key a pseudonym can neither
    be made nor looked up by hashing all ids. The key comes from the caller
    (a secret store); it is part of the plan, so plans of such queries must
    not be logged where the key may not be seen."""
    import hashlib
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.unhex(F.lit(bytes(b ^ pad for b in key).hex())) for pad in (0x36, 0x5C))
    text = (F.col(value) if isinstance(value, str) else value).cast("binary")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, text), 256))), 256)


def mask_customers(customers: DataFrame, key: bytes | None = None) -> DataFrame:
    """Pseudonymise the person key, keep only the zip region, hide the city.
    With a ``key`` the pseudonym is keyed, without one it is a plain digest."""
    person = F.sha2("customer_unique_id", 256) if key is None else keyed_pseudonym("customer_unique_id", key)
    return customers.select(
        "customer_id",
        person.alias("customer_unique_id"),
        F.concat(F.substring("customer_zip_code_prefix", 1, 2), F.lit("***")).alias("customer_zip_code_prefix"),
        F.concat(F.substring("customer_city", 1, 1),
                 F.repeat(F.lit("*"), F.greatest(F.length("customer_city") - 1, F.lit(0)))).alias("customer_city"),
        "customer_state",
    )


# --- DQ28 units -------------------------------------------------------------------------------------------
#: fixed values: unit of a measure, the standard unit, and how many of the one make one of the other
UNITS = [("g", "kg", 1000.0), ("cm", "m", 100.0), ("mm", "m", 1000.0), ("kg", "kg", 1.0), ("m", "m", 1.0)]


def unit_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(UNITS, "unit string, standard_unit string, per_standard double")


def standardize_units(products: DataFrame, units: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    """Measures in their standard units, by a join with the unit table: one
    row per product and measure (``measures``: column -> unit). A unit that
    the table lacks leaves the value null."""
    long = products.select("product_id", F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.lit(u).alias("unit"), F.col(c).cast("double").alias("value"))
        for c, u in measures.items()])).alias("m")).select("product_id", "m.*")
    return (long.join(F.broadcast(units), "unit", "left")                       # UNITS: a handful of rows
            .select("product_id", "measure", "standard_unit", (F.col("value") / F.col("per_standard")).alias("standard_value")))


def standardize_product_units(products: DataFrame) -> DataFrame:
    """Grams -> kilograms, centimetres -> metres, plus volume in litres."""
    cm = ["product_length_cm", "product_height_cm", "product_width_cm"]
    vol = F.col(cm[0]) * F.col(cm[1]) * F.col(cm[2]) / F.lit(1000.0)
    return products.select(
        "product_id",
        (F.col("product_weight_g") / F.lit(1000.0)).alias("product_weight_kg"),
        *[(F.col(c) / F.lit(100.0)).alias(c.replace("_cm", "_m")) for c in cm],
        vol.alias("product_volume_l"),
    )


# --- DQ29 deprecated codes ---------------------------------------------------------------------------------
def deprecated_codes(df: DataFrame, table: str, column: str, legacy: Sequence[str]) -> DataFrame:
    c = F.col(column)
    return (df.filter(c.isin(list(legacy))).groupBy(column).count()
            .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                    c.alias("value"), "count"))


# --- DQ30 / DQ31 failure log and summary -------------------------------------------------------------------
def failure_log(df: DataFrame, table: str, record_id: Column, rules: Mapping[str, Column]) -> DataFrame:
    """One row per (record, failed rule): rules are evaluated as an array of
    names, filtered to the failing ones and exploded."""
    failed = F.filter(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]),
                      lambda x: x.isNotNull())
    return (df.select(record_id.alias("record_id"), failed.alias("_failed"))
            .select(F.lit(table).alias("table_name"), "record_id", F.explode("_failed").alias("rule")))


def failure_summary(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """Pass/fail summary per rule: checked rows, failures, pass rate."""
    prof = df.agg(F.count("*").alias("_n"),
                  *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    long = prof.unpivot(["_n"], list(rules), "rule", "failures")
    rate = F.round(F.lit(1.0) - F.col("failures") / F.col("_n"), 6)
    return long.select(F.lit(table).alias("table_name"), "rule", F.col("_n").alias("checked_rows"),
                       "failures", rate.alias("pass_rate"), (F.col("failures") == 0).alias("passed"))

