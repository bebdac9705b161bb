"""Keys E1-E16 (windows), F1-F5 (sorts, limits), G1-G3 (set operations), R1-R3 (reshaping)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.cleaning import repeated_values
from strata.operators.joins import join_grouped
from strata.operators.reshape import pivot_fixed, template_grain
from strata.operators.windows import dense_rank_by, partition_agg, partition_aggs, row_number_by, running_sum, shift_by
from strata.plans import ledger
from strata.registry import register
from strata.sources import staging
from strata.sources.sinks import materialise
from strata.sources.staging import with_views
from strata.sources.tables import Tables

# --------------------------------------------------------------------------- E: windows


@register("e01_running_sum", with_views("""SELECT location, date, CAST(cases AS BIGINT) AS cases,
    CAST(sum(cases) OVER (PARTITION BY location ORDER BY location, date) AS BIGINT) AS running_cases
    FROM daily""", "daily"))
def e01_running_sum(spark, sf_dir):
    d = staging.daily_series(Tables(spark, sf_dir))
    # One row per (location, day) after the pre-aggregation: partitions are
    # bounded by the calendar, not by the event volume.
    return running_sum(d, ["location"], ["location", "date"], F.col("cases"), "running_cases").select(
        "location", "date", "cases", "running_cases")


@register("e02_duplicate_rows", """SELECT doc_id, lang, row_num FROM (
    SELECT doc_id, lang, CAST(row_number() OVER (PARTITION BY text ORDER BY doc_id) AS BIGINT) AS row_num
    FROM documents) d
    WHERE row_num > 1""")
def e02_duplicate_rows(spark, sf_dir):
    d = Tables(spark, sf_dir)("documents", "doc_id", "text", "lang")
    d = d.withColumn("__h", F.xxhash64("text"))
    # Only texts whose 8-byte hash occurs twice can repeat: find those hashes
    # (a shuffle of hashes, not texts), then number whole texts inside them.
    # The range-split row number keeps one hot text from landing in one task.
    dup = join_grouped(d, repeated_values(d, "__h"), ["__h"], "left_semi")
    numbered = row_number_by(dup, ["__h", "text"], ["doc_id"], name="row_num", size_keys=["__h"])
    return numbered.filter(F.col("row_num") > 1).select("doc_id", "lang", "row_num")


@register("e03_sequence", """SELECT o_orderkey, o_custkey,
    CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS seq FROM orders""")
def e03_sequence(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_custkey", "o_orderdate")
    return row_number_by(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], name="seq").select(
        "o_orderkey", "o_custkey", "seq")


@register("e04_latest_in_group", with_views("""SELECT o_orderkey, pidm, term_code,
    CAST(dense_rank() OVER (PARTITION BY pidm, substr(term_code, 1, 4) ORDER BY term_code DESC) AS BIGINT) AS seq
    FROM o""", "o"))
def e04_latest_in_group(spark, sf_dir):
    o = staging.orders_terms(Tables(spark, sf_dir)).withColumn("yr", F.substring("term_code", 1, 4))
    # Distinct (customer, year, term) pairs: at most three terms a year.
    return dense_rank_by(o, ["pidm", "yr"], "term_code", descending=True, name="seq", hot_rows=None).select(
        "o_orderkey", "pidm", "term_code", "seq")


@register("e05_global_dense_rank", """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y,
    CAST(dense_rank() OVER (ORDER BY year(o_orderdate) DESC) AS BIGINT) AS recency FROM orders""")
def e05_global_dense_rank(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderdate").withColumn("y", F.year("o_orderdate"))
    return dense_rank_by(o, [], "y", descending=True, name="recency").select("o_orderkey", "y", "recency")


def _year_starts(t):
    o = t("orders", "o_orderdate")
    return o.groupBy(F.year("o_orderdate").alias("y")).agg(F.to_date(F.min("o_orderdate")).alias("start_date"))


_YEAR_STARTS_SQL = ("ys", """SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(min(o_orderdate) AS DATE) AS start_date
    FROM orders GROUP BY 1""")


@register("e06_lag", with_views("""SELECT y, start_date,
    lag(start_date) OVER (ORDER BY y DESC) AS next_start FROM ys""", ctes=[_YEAR_STARTS_SQL]))
def e06_lag(spark, sf_dir):
    ys = _year_starts(Tables(spark, sf_dir))
    # One row per calendar year: the un-partitioned window is bounded by the calendar.
    return ys.withColumn("next_start", F.lag("start_date").over(Window.orderBy(F.desc("y"))))


@register("e07_lag_two", with_views("""SELECT y, start_date,
    lag(start_date, 2) OVER (ORDER BY y DESC) AS after_next_start FROM ys""", ctes=[_YEAR_STARTS_SQL]))
def e07_lag_two(spark, sf_dir):
    ys = _year_starts(Tables(spark, sf_dir))
    return ys.withColumn("after_next_start", F.lag("start_date", 2).over(Window.orderBy(F.desc("y"))))


@register("e08_lead_condition", with_views("""SELECT pidm, yr,
    CASE WHEN lead(yr) OVER (PARTITION BY pidm ORDER BY yr) = yr + 1 THEN 'Yes' ELSE 'No' END AS retained
    FROM yr""", "yr"))
def e08_lead_condition(spark, sf_dir):
    y = staging.student_years(Tables(spark, sf_dir))
    # One row per (student, year): a student's partition is bounded by the calendar.
    nxt = F.lead("yr").over(Window.partitionBy("pidm").orderBy("yr"))
    return y.select("pidm", "yr", F.when(nxt == F.col("yr") + 1, "Yes").otherwise("No").alias("retained"))


# Three statuses hold all orders: each is a group that no single task should get.
_HOT = 1_000


@register("e01_running_sum_ranged", """SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_orderstatus ORDER BY CAST(o_orderdate AS DATE)) AS BIGINT) AS cents_to_date
    FROM orders""")
def e01_running_sum_ranged(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    o = o.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"), F.round(F.col("o_totalprice") * 100).cast("long").alias("__c"))
    return running_sum(o, ["o_orderstatus"], ["day"], F.col("__c"), "cents_to_date", hot_rows=_HOT).drop("__c")


@register("e06_shift_ranged", """SELECT o_orderkey, o_orderstatus, lag(o_orderkey) OVER w AS before, lead(o_orderkey, 2) OVER w AS second_after
    FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey)""")
def e06_shift_ranged(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    return shift_by(o, ["o_orderstatus"], ["o_orderdate", "o_orderkey"], {"before": ("o_orderkey", -1), "second_after": ("o_orderkey", 2)},
                    hot_rows=_HOT).drop("o_orderdate")


@register("e09_partition_min", with_views("""SELECT o_orderkey, substr(term_code, 5) AS season,
    min(order_date) OVER (PARTITION BY substr(term_code, 5)) AS season_first_day FROM o""", "o"))
def e09_partition_min(spark, sf_dir):
    o = staging.orders_terms(Tables(spark, sf_dir)).withColumn("season", F.expr("substr(term_code, 5)"))
    return partition_agg(o, ["season"], {"season_first_day": F.min("order_date")}, few_groups=True).select(
        "o_orderkey", "season", "season_first_day")


@register("e10_partition_max", with_views("""SELECT pidm, yr, max(yr) OVER (PARTITION BY pidm) AS last_year
    FROM yr""", "yr"))
def e10_partition_max(spark, sf_dir):
    y = staging.student_years(Tables(spark, sf_dir))
    return partition_agg(y, ["pidm"], {"last_year": F.max("yr")}).select("pidm", "yr", "last_year")


@register("e11_partition_sums", with_views("""SELECT o_orderkey, pidm, term_code,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY pidm, term_code) AS DOUBLE) AS price_term,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY pidm, substr(term_code, 1, 4)) AS DOUBLE) AS price_year
    FROM o""", "o"))
def e11_partition_sums(spark, sf_dir):
    o = staging.orders_terms(Tables(spark, sf_dir)).withColumns({
        "yr": F.substring("term_code", 1, 4), "cents": F.col("o_totalprice").cast("decimal(18,2)")})
    # Read three times: written once, with the columns that are needed.
    o = materialise(o.select("o_orderkey", "pidm", "term_code", "yr", "cents"), "priced_terms")
    o = partition_aggs(o, [(["pidm", "term_code"], {"price_term": F.sum("cents").cast("double")}),
                           (["pidm", "yr"], {"price_year": F.sum("cents").cast("double")})])
    return o.select("o_orderkey", "pidm", "term_code", "price_term", "price_year")


@register("e12_degenerate_order", with_views("""SELECT l_orderkey, l_linenumber, pidm, term_code,
    sum(credits) OVER (PARTITION BY pidm, term_code ORDER BY term_code) AS credits_per_term FROM li""", "li"))
def e12_degenerate_order(spark, sf_dir):
    li = staging.line_terms(Tables(spark, sf_dir)).select("l_orderkey", "l_linenumber", "pidm", "term_code", "credits")
    li = materialise(li, "line_credits")   # read twice
    # Ordered by its own partition key, every row is a peer: the running sum is
    # the partition total.
    return partition_agg(li, ["pidm", "term_code"], {"credits_per_term": F.sum("credits")}).select(
        "l_orderkey", "l_linenumber", "pidm", "term_code", "credits_per_term")


_QUARTERS_SQL = ("q", """SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y,
    CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
    CAST(o_totalprice AS DECIMAL(18,2)) AS cents FROM orders""")


def _quarters(t):
    o = t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return o.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"),
                    F.concat(F.year("o_orderdate").cast("string"), F.lit("Q"),
                             F.quarter("o_orderdate").cast("string")).alias("quarter"),
                    F.col("o_totalprice").cast("decimal(18,2)").alias("cents"))


@register("e13_distinct_over_window", with_views("""SELECT o_orderkey, o_custkey, y,
    count(DISTINCT quarter) OVER (PARTITION BY o_custkey, y) AS n_quarters FROM q""", ctes=[_QUARTERS_SQL]))
def e13_distinct_over_window(spark, sf_dir):
    q = _quarters(Tables(spark, sf_dir))
    # Spark has no DISTINCT window aggregate; a grouped count distinct joined back
    # is exact and holds no per-group set in memory.
    return partition_agg(q, ["o_custkey", "y"], {"n_quarters": F.count_distinct("quarter")}).select(
        "o_orderkey", "o_custkey", "y", "n_quarters")


@register("e14_window_arithmetic", with_views("""SELECT o_custkey, y, round(CAST(paid AS DOUBLE) * (4 / quarters)) AS annualised
    FROM (SELECT o_custkey, y, sum(cents) AS paid FROM q GROUP BY ALL)
    JOIN (SELECT o_custkey, y, count(*) AS quarters FROM (SELECT DISTINCT o_custkey, y, quarter FROM q) GROUP BY ALL)
      USING (o_custkey, y)""", ctes=[_QUARTERS_SQL]))
def e14_window_arithmetic(spark, sf_dir):
    q = _quarters(Tables(spark, sf_dir))
    g = q.groupBy("o_custkey", "y").agg(F.sum("cents").cast("double").alias("s"),
                                        F.count_distinct("quarter").alias("n"))
    return g.select("o_custkey", "y", F.round(F.col("s") * F.try_divide(F.lit(4.0), F.col("n"))).alias("annualised"))


@register("e15_window_then_distinct", with_views("""SELECT DISTINCT pidm, term_code,
    sum(credits) OVER (PARTITION BY pidm, term_code) AS credits_term FROM li""", "li"))
def e15_window_then_distinct(spark, sf_dir):
    li = staging.line_terms(Tables(spark, sf_dir))
    # Window then DISTINCT on the partition keys is one grouped sum.
    return li.groupBy("pidm", "term_code").agg(F.sum("credits").alias("credits_term"))


@register("e16_filter_on_window", with_views("""SELECT o_orderkey, pidm, term_code FROM (
    SELECT o_orderkey, pidm, term_code,
      dense_rank() OVER (PARTITION BY pidm, substr(term_code, 1, 4) ORDER BY term_code DESC) AS seq FROM o) x
    WHERE seq = 1""", "o"))
def e16_filter_on_window(spark, sf_dir):
    o = staging.orders_terms(Tables(spark, sf_dir)).withColumn("yr", F.substring("term_code", 1, 4))
    # seq = 1 of a descending dense rank: rows holding the group's max term.
    latest = o.groupBy("pidm", "yr").agg(F.max("term_code").alias("term_code"))
    return o.join(latest, ["pidm", "yr", "term_code"], "left_semi").select("o_orderkey", "pidm", "term_code")


# --------------------------------------------------------------------------- F: sorts and limits


@register("f01_sort_multi", """SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
    ORDER BY o_orderstatus, o_orderpriority, o_totalprice DESC, o_orderkey""")
def f01_sort_multi(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return o.orderBy("o_orderstatus", "o_orderpriority", F.desc("o_totalprice"), "o_orderkey")


@register("f02_sort_ordinal", with_views("SELECT location, date, CAST(cases AS BIGINT) AS cases FROM daily ORDER BY 1, 2",
                                         "daily"))
def f02_sort_ordinal(spark, sf_dir):
    staging.daily_series(Tables(spark, sf_dir)).createOrReplaceTempView("strata_daily")
    return spark.sql("SELECT location, date, cases FROM strata_daily ORDER BY 1, 2")


@register("f03_sort_alias_desc", with_views("""SELECT location, max(total_cases / population) * 100 AS infection_rate
    FROM covid GROUP BY location ORDER BY infection_rate DESC""", "covid"))
def f03_sort_alias_desc(spark, sf_dir):
    c = staging.covid_deaths(Tables(spark, sf_dir))
    return (c.groupBy("location")
             .agg((F.max(F.try_divide(F.col("total_cases"), F.col("population").cast("double"))) * 100)
                  .alias("infection_rate"))
             .orderBy(F.desc("infection_rate")))


@register("f04_limit", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100")
def f04_limit(spark, sf_dir):
    # TOP (100): the limit is the feature; the order makes it deterministic.
    return Tables(spark, sf_dir).orders.orderBy("o_orderkey").limit(100)


@register("f05_top_k", """SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey FETCH FIRST 10 ROWS ONLY""")
def f05_top_k(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_totalprice")
    return o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


# --------------------------------------------------------------------------- G: set operations


@register("g01_union_all", """SELECT o_orderstatus AS status, 'orders' AS source FROM orders
    UNION ALL SELECT l_linestatus, 'lineitem' FROM lineitem""")
def g01_union_all(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = t("orders", "o_orderstatus").select(F.col("o_orderstatus").alias("status"), F.lit("orders").alias("source"))
    b = t("lineitem", "l_linestatus").select(F.col("l_linestatus").alias("status"), F.lit("lineitem").alias("source"))
    return a.unionByName(b)


@register("g02_union_distinct", "SELECT o_orderstatus AS status FROM orders UNION SELECT l_linestatus FROM lineitem")
def g02_union_distinct(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = t("orders", "o_orderstatus").select(F.col("o_orderstatus").alias("status"))
    b = t("lineitem", "l_linestatus").select(F.col("l_linestatus").alias("status"))
    return a.union(b).distinct()


@register("g03_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def g03_distinct(spark, sf_dir):
    return Tables(spark, sf_dir)("orders", "o_custkey", "o_orderstatus").distinct()


# --------------------------------------------------------------------------- R: reshaping


def _pivot_sql(key: str, name: str) -> str:
    cols = ",\n".join(
        f"CAST(sum(CAST(round(amount, 2) AS DECIMAL(18,2))) FILTER (WHERE txn_type = '{t}') AS DOUBLE) AS {c}"
        for t, c in zip(ledger.LEDGER_TYPES, ledger.LEDGER_COLUMNS))
    return with_views(f"SELECT NULLIF({key}, 'NULL') AS {name}, {cols} FROM txn GROUP BY 1", "txn")


def _pivot(spark, sf_dir, key, name):
    txn = ledger.clean_ledger(staging.ledger(Tables(spark, sf_dir)))
    wide = pivot_fixed(txn, [key], "txn_type", ledger.LEDGER_TYPES, F.col("amount"), ledger.LEDGER_COLUMNS)
    return wide.select(F.col(key).alias(name), *[F.col(c).cast("double").alias(c) for c in ledger.LEDGER_COLUMNS])


@register("r01_pivot_lot", _pivot_sql("lot_name", "LotName"))
def r01_pivot_lot(spark, sf_dir):
    return _pivot(spark, sf_dir, "lot_name", "LotName")


@register("r02_pivot_item", _pivot_sql("item_name", "ItemName"))
def r02_pivot_item(spark, sf_dir):
    return _pivot(spark, sf_dir, "item_name", "ItemName")


@register("r03_template_grain", """SELECT DISTINCT o_orderstatus AS status, o_orderpriority AS dim
      FROM orders JOIN customer ON o_custkey = c_custkey
    UNION SELECT DISTINCT o_orderstatus, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def r03_template_grain(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t("orders", "o_custkey", "o_orderstatus", "o_orderpriority")
    c = t("customer", "c_custkey", "c_mktsegment")
    src = o.join(c, o.o_custkey == c.c_custkey)
    return template_grain([src.select("o_orderstatus", "o_orderpriority"),
                           src.select("o_orderstatus", "c_mktsegment")], ["status", "dim"])
