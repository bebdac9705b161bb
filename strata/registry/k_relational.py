"""Keys A1-A8 (scans, sources, sinks) and B1-B17 (projections, predicates, CASE)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.numeric import bin_label, bin_sort_key
from strata.registry import register
from strata.sources import sinks, staging
from strata.sources.staging import with_views
from strata.sources.tables import Tables
from strata.sources.tables import constant_frame

# --------------------------------------------------------------------------- A: scans, sources, sinks


@register("a01_scan_project", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def a01_scan_project(spark, sf_dir):
    return Tables(spark, sf_dir)("orders", "o_orderkey", "o_custkey", "o_orderdate")


@register("a02_scan_star", "SELECT * FROM orders")
def a02_scan_star(spark, sf_dir):
    return Tables(spark, sf_dir).orders


# Status -> target factor: fixed values of the inline relation.
KNOBS = [("F", 0.925), ("O", 0.925), ("P", 0.9)]
_KNOB_SQL = "SELECT * FROM (VALUES ('F', 0.925::DOUBLE), ('O', 0.925::DOUBLE), ('P', 0.9::DOUBLE)) AS k(o_orderstatus, knob)"


def knobs(spark):
    return constant_frame(spark, KNOBS, "o_orderstatus string, knob double")


@register("a03_inline_relation", with_views(
    "SELECT o_orderkey, o_orderstatus, knob, o_totalprice * knob AS target FROM orders JOIN knobs USING (o_orderstatus)",
    ctes=[("knobs", _KNOB_SQL)]))
def a03_inline_relation(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    # Three fixed rows: broadcasting them is bounded by construction.
    return (o.join(F.broadcast(knobs(spark)), "o_orderstatus")
             .select("o_orderkey", "o_orderstatus", "knob",
                     (F.col("o_totalprice") * F.col("knob")).alias("target")))


@register("a04_view_chain", with_views("""
    SELECT lot_name, CAST(totals AS DOUBLE) AS totals FROM (
      SELECT lot_name, txn_type, sum(CAST(round(amount, 2) AS DECIMAL(18,2))) AS totals
      FROM txn GROUP BY txn_type, lot_name) raw
    WHERE txn_type = 'revenue'""", "txn"))
def a04_view_chain(spark, sf_dir):
    staging.ledger(Tables(spark, sf_dir)).createOrReplaceTempView("strata_transactions")
    spark.sql("""CREATE OR REPLACE TEMP VIEW strata_snapshot_raw AS
        SELECT lot_name, txn_type, SUM(CAST(round(amount, 2) AS DECIMAL(18,2))) AS totals
        FROM strata_transactions GROUP BY txn_type, lot_name""")
    spark.sql("""CREATE OR REPLACE TEMP VIEW strata_snapshot_revenue AS
        SELECT lot_name, CAST(totals AS DOUBLE) AS totals FROM strata_snapshot_raw
        WHERE txn_type = 'revenue'""")
    return spark.table("strata_snapshot_revenue")


_TYPED_EVENTS_SQL = """SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS INTEGER) AS user_id,
    CAST(event_type AS VARCHAR) AS event_type, CAST(ts AS DATE) AS event_date,
    CAST(CAST(round(value, 2) AS DECIMAL(12,2)) AS DOUBLE) AS amount FROM events"""

_TYPED_EVENTS = {
    "event_id": "bigint", "user_id": "int", "event_type": "string",
    "event_date": "date", "amount": "decimal(12,2)",
}


def _typed_events(spark, sf_dir):
    e = Tables(spark, sf_dir)("events", "event_id", "user_id", "event_type", "ts", "value")
    e = e.withColumn("event_date", F.col("ts")).withColumn("amount", F.round("value", 2))
    return sinks.typed_staging(e, _TYPED_EVENTS)


@register("a05_typed_staging", _TYPED_EVENTS_SQL)
def a05_typed_staging(spark, sf_dir):
    return _typed_events(spark, sf_dir).withColumn("amount", F.col("amount").cast("double"))


@register("a06_materialise", _TYPED_EVENTS_SQL)
def a06_materialise(spark, sf_dir):
    table = sinks.materialise(_typed_events(spark, sf_dir), "typed_events")
    return table.withColumn("amount", F.col("amount").cast("double"))


@register("a07_export_mart", with_views(
    "SELECT location, date, CAST(cases AS BIGINT) AS cases, CAST(deaths AS BIGINT) AS deaths FROM daily", "daily"))
def a07_export_mart(spark, sf_dir):
    mart = staging.daily_series(Tables(spark, sf_dir))
    path = sinks.export_mart(mart, "daily_mart", partition_by=["location"])
    return sinks.read_mart(spark, path, mart.schema)


@register("a08_masked_export", """SELECT event_id,
    CASE event_type WHEN 'purchase' THEN 'type A' WHEN 'view' THEN 'type B' WHEN 'click' THEN 'type C'
      WHEN 'signup' THEN 'type D' WHEN 'error' THEN 'type E' ELSE event_type END AS event_type,
    round(value * (1 + 0.05 * (2 * (((abs(event_id) + 42) % 1000003) * 48271 % 1000003) / 1000003.0 - 1)), 2) AS value
    FROM events""")
def a08_masked_export(spark, sf_dir):
    # Replace categories, perturb numbers with noise seeded by the row key, drop
    # columns.
    e = Tables(spark, sf_dir)("events", "event_id", "user_id", "event_type", "value", "props")
    masked = sinks.mask(e, key="event_id",
                        replace={"event_type": {"purchase": "type A", "view": "type B", "click": "type C",
                                                "signup": "type D", "error": "type E"}},
                        perturb={"value": 0.05}, drop=["props", "user_id"])
    path = sinks.export_mart(masked, "masked_events")
    return sinks.read_mart(spark, path, masked.schema)


# --------------------------------------------------------------------------- B: projections, predicates


@register("b01_project_rename",
          "SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment FROM customer")
def b01_project_rename(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
                    F.col("c_mktsegment").alias("segment"))


@register("b02_star_plus", "SELECT *, p_retailprice * 2 AS double_price FROM part")
def b02_star_plus(spark, sf_dir):
    return Tables(spark, sf_dir).part.withColumn("double_price", F.col("p_retailprice") * 2)


@register("b03_labelled_output",
          'SELECT c_custkey AS "Customer Key", c_mktsegment AS "Market Segment" FROM customer')
def b03_labelled_output(spark, sf_dir):
    return Tables(spark, sf_dir)("customer", "c_custkey", "c_mktsegment").toDF("Customer Key", "Market Segment")


@register("b04_literal_column", """SELECT c_custkey AS "Customer Key", 'Total' AS "Total" FROM customer""")
def b04_literal_column(spark, sf_dir):
    c = Tables(spark, sf_dir)("customer", "c_custkey")
    return c.select(F.col("c_custkey").alias("Customer Key"), F.lit("Total").alias("Total"))


@register("b05_filter_and", """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def b05_filter_and(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return (o.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
             .select("o_orderkey", "o_totalprice"))


@register("b06_filter_or", """SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders
    WHERE o_orderstatus = 'O' OR (o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate <= TIMESTAMP '1998-12-31')""")
def b06_filter_or(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    d = F.col("o_orderdate")
    cond = (F.col("o_orderstatus") == "O") | ((d >= F.lit("1998-01-01").cast("timestamp_ntz"))
                                              & (d <= F.lit("1998-12-31").cast("timestamp_ntz")))
    return o.filter(cond).select("o_orderkey", "o_orderstatus", "o_orderdate")


@register("b07_null_test", with_views("""SELECT UniqueID, ParcelID,
    CASE WHEN PropertyAddress IS NOT NULL THEN 'Y' ELSE 'N' END AS has_address
    FROM prop WHERE PropertyAddress IS NULL OR SoldAsVacant = 'Y'""", "prop"))
def b07_null_test(spark, sf_dir):
    p = staging.properties(Tables(spark, sf_dir))
    return (p.filter(F.col("PropertyAddress").isNull() | (F.col("SoldAsVacant") == "Y"))
             .select("UniqueID", "ParcelID",
                     F.when(F.col("PropertyAddress").isNotNull(), "Y").otherwise("N").alias("has_address")))


@register("b08_like", """SELECT p_partkey, p_name,
    CASE WHEN p_type ILIKE '%small%' THEN 'Y' ELSE 'N' END AS small_type
    FROM part WHERE p_name LIKE '%ring%' AND p_brand NOT LIKE '%5'""")
def b08_like(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return (p.filter(F.col("p_name").like("%ring%") & ~F.col("p_brand").like("%5"))
             .select("p_partkey", "p_name",
                     F.when(F.col("p_type").ilike("%small%"), "Y").otherwise("N").alias("small_type")))


@register("b09_in_list", """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW') AND o_orderstatus IN ('F', 'O')""")
def b09_in_list(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return (o.filter(~F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW")
                     & F.col("o_orderstatus").isin("F", "O"))
             .select("o_orderkey", "o_orderstatus", "o_orderpriority"))


@register("b10_between_numeric", """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice BETWEEN 100000 AND 199999.99""")
def b10_between_numeric(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.filter(F.col("o_totalprice").between(100000, 199999.99)).select("o_orderkey", "o_totalprice")


@register("b11_between_string", """SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority BETWEEN '2-HIGH' AND '4-NOT SPECIFIED'""")
def b11_between_string(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return (o.filter(F.col("o_orderpriority").between("2-HIGH", "4-NOT SPECIFIED"))
             .select("o_orderkey", "o_orderpriority"))


@register("b12_comparison", """SELECT o_orderkey FROM orders
    WHERE o_orderstatus <> 'F' AND o_totalprice >= 200000
      AND o_orderdate > TIMESTAMP '1999-01-01' AND o_orderdate <= TIMESTAMP '2000-12-31'""")
def b12_comparison(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    d = F.col("o_orderdate")
    return (o.filter((F.col("o_orderstatus") != "F") & (F.col("o_totalprice") >= 200000)
                     & (d > F.lit("1999-01-01").cast("timestamp_ntz"))
                     & (d <= F.lit("2000-12-31").cast("timestamp_ntz")))
             .select("o_orderkey"))


@register("b13_case_searched", """SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'F' THEN 'Finished' WHEN o_orderstatus = 'O' THEN 'Open' END AS status_label,
    CASE WHEN o_totalprice >= 300000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'medium'
         ELSE 'small' END AS size_label
    FROM orders""")
def b13_case_searched(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    s, p = F.col("o_orderstatus"), F.col("o_totalprice")
    return o.select("o_orderkey",
                    F.when(s == "F", "Finished").when(s == "O", "Open").alias("status_label"),
                    F.when(p >= 300000, "large").when(p >= 100000, "medium").otherwise("small").alias("size_label"))


# Priority -> rank: fixed values.
PRIORITY_RANK = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4}


@register("b14_case_simple", """SELECT o_orderkey,
    CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
      WHEN '4-NOT SPECIFIED' THEN 4 END AS priority_rank
    FROM orders""")
def b14_case_simple(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderpriority")
    rank = None
    for k, v in PRIORITY_RANK.items():
        rank = F.when(F.col("o_orderpriority") == k, v) if rank is None else rank.when(F.col("o_orderpriority") == k, v)
    return o.select("o_orderkey", rank.alias("priority_rank"))


@register("b15_bin_and_sort_key", """SELECT o_orderkey, bin AS wage_bin,
    CASE bin WHEN '$0-25k' THEN 1 WHEN '$25k-50k' THEN 2 WHEN '$50k-75k' THEN 3
      WHEN '$75k-100k' THEN 4 WHEN '$100k +' THEN 5 WHEN 'None' THEN 6 END AS wage_bin_sort
    FROM (SELECT o_orderkey,
      CASE WHEN round(o_totalprice / 4) BETWEEN 0 AND 24999 THEN '$0-25k'
           WHEN round(o_totalprice / 4) BETWEEN 25000 AND 49999 THEN '$25k-50k'
           WHEN round(o_totalprice / 4) BETWEEN 50000 AND 74999 THEN '$50k-75k'
           WHEN round(o_totalprice / 4) BETWEEN 75000 AND 99999 THEN '$75k-100k'
           WHEN round(o_totalprice / 4) >= 100000 THEN '$100k +' ELSE 'None' END AS bin
      FROM orders) b""")
def b15_bin_and_sort_key(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_totalprice")
    b = o.select("o_orderkey", bin_label(F.round(F.col("o_totalprice") / 4)).alias("wage_bin"))
    return b.withColumn("wage_bin_sort", bin_sort_key("wage_bin"))


# Cohort rule matrix on the stand-in: (order year, lowest quarter, highest quarter).
RULES = [(1996, 1, 1), (1997, 1, 2), (1998, 1, 3), (1999, 1, 4)]


def rules(spark):
    return constant_frame(spark, RULES, "rule_year int, lo int, hi int")


@register("b16_rule_matrix", """SELECT o_orderkey,
    CASE WHEN year(o_orderdate) = 1996 AND quarter(o_orderdate) = 1 THEN 'Y'
         WHEN year(o_orderdate) = 1997 AND quarter(o_orderdate) BETWEEN 1 AND 2 THEN 'Y'
         WHEN year(o_orderdate) = 1998 AND quarter(o_orderdate) BETWEEN 1 AND 3 THEN 'Y'
         WHEN year(o_orderdate) = 1999 AND quarter(o_orderdate) BETWEEN 1 AND 4 THEN 'Y'
         ELSE 'N' END AS relevant_flag
    FROM orders""")
def b16_rule_matrix(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderdate")
    o = o.withColumns({"y": F.year("o_orderdate"), "q": F.quarter("o_orderdate")})
    r = rules(spark)  # four fixed rows: broadcast is bounded by construction
    j = o.join(F.broadcast(r), (o.y == r.rule_year) & o.q.between(r.lo, r.hi), "left")
    return j.select("o_orderkey", F.when(F.col("rule_year").isNotNull(), "Y").otherwise("N").alias("relevant_flag"))


@register("b17_string_number", with_views("""SELECT DISTINCT term_code,
    CAST(term_code AS INTEGER) - 100 AS same_season_last_year,
    CAST(substr(term_code, 1, 4) AS INTEGER) + 4 AS year_plus_4
    FROM o""", "o"))
def b17_string_number(spark, sf_dir):
    o = staging.orders_terms(Tables(spark, sf_dir))
    return (o.select("term_code",
                     (F.col("term_code").cast("int") - 100).alias("same_season_last_year"),
                     (F.substring("term_code", 1, 4).cast("int") + 4).alias("year_plus_4"))
             .distinct())

