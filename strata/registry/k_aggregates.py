"""Keys D1-D20: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.numeric import percent
from strata.operators.reshape import rollup_counts
from strata.registry import register
from strata.registry.k_relational import _KNOB_SQL, knobs
from strata.sources import staging
from strata.sources.staging import with_views
from strata.sources.tables import Tables


def _cents(c):
    return F.col(c).cast("decimal(18,2)")


@register("d01_group_sum", """SELECT o_orderstatus, o_orderpriority,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
    FROM orders GROUP BY o_orderpriority, o_orderstatus""")
def d01_group_sum(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return (o.groupBy("o_orderstatus", "o_orderpriority")
             .agg(F.sum(_cents("o_totalprice")).cast("double").alias("total_price")))


@register("d02_group_min_max", with_views("""SELECT term_code, min(order_date) AS first_day,
    max(order_date) AS last_day FROM o GROUP BY term_code""", "o"))
def d02_group_min_max(spark, sf_dir):
    o = staging.orders_terms(Tables(spark, sf_dir))
    return o.groupBy("term_code").agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))


@register("d03_count_nonnull", with_views("""SELECT LegalReference, count(*) AS n_rows,
    count(PropertyAddress) AS n_address FROM prop GROUP BY LegalReference""", "prop"))
def d03_count_nonnull(spark, sf_dir):
    p = staging.properties(Tables(spark, sf_dir))
    return p.groupBy("LegalReference").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.count("PropertyAddress").alias("n_address"))


@register("d04_count_distinct", with_views("""SELECT term_code, count(DISTINCT crn) AS sections
    FROM li GROUP BY term_code""", "li"))
def d04_count_distinct(spark, sf_dir):
    li = staging.line_terms(Tables(spark, sf_dir))
    return li.groupBy("term_code").agg(F.count_distinct("crn").alias("sections"))


@register("d05_cond_count_distinct", with_views("""SELECT term_code, campus,
    count(DISTINCT CASE continuing_ind WHEN 'N' THEN pidm END) AS new_stu,
    count(DISTINCT CASE continuing_ind WHEN 'Y' THEN pidm END) AS cont_stu,
    count(DISTINCT CASE WHEN budget_ind = 'Y' AND continuing_ind = 'N' THEN pidm END) AS new_br_stu,
    count(DISTINCT CASE WHEN budget_ind = 'Y' THEN crn END) AS br_sections
    FROM li GROUP BY term_code, campus""", "li"))
def d05_cond_count_distinct(spark, sf_dir):
    li = staging.line_terms(Tables(spark, sf_dir))
    new, cont, br = (F.col("continuing_ind") == "N"), (F.col("continuing_ind") == "Y"), (F.col("budget_ind") == "Y")
    return li.groupBy("term_code", "campus").agg(
        F.count_distinct(F.when(new, F.col("pidm"))).alias("new_stu"),
        F.count_distinct(F.when(cont, F.col("pidm"))).alias("cont_stu"),
        F.count_distinct(F.when(br & new, F.col("pidm"))).alias("new_br_stu"),
        F.count_distinct(F.when(br, F.col("crn"))).alias("br_sections"))


@register("d06_cond_sum", with_views("""SELECT term_code,
    sum(CASE continuing_ind WHEN 'N' THEN credits END) AS new_credits,
    round(sum(CASE continuing_ind WHEN 'Y' THEN credits END) / 15) AS cont_fte
    FROM li GROUP BY term_code""", "li"))
def d06_cond_sum(spark, sf_dir):
    li = staging.line_terms(Tables(spark, sf_dir))
    return li.groupBy("term_code").agg(
        F.sum(F.when(F.col("continuing_ind") == "N", F.col("credits"))).alias("new_credits"),
        F.round(F.sum(F.when(F.col("continuing_ind") == "Y", F.col("credits"))) / 15).alias("cont_fte"))


@register("d07_cond_count", with_views("""SELECT term_code,
    count(CASE WHEN budget_ind = 'Y' THEN crn END) AS br_lines FROM li GROUP BY term_code""", "li"))
def d07_cond_count(spark, sf_dir):
    li = staging.line_terms(Tables(spark, sf_dir))
    return li.groupBy("term_code").agg(F.count(F.when(F.col("budget_ind") == "Y", F.col("crn"))).alias("br_lines"))


@register("d08_sum_distinct", with_views("""SELECT term_code, sum(credits) AS credits,
    sum(DISTINCT CASE WHEN budget_ind = 'Y' THEN credits END) AS distinct_br_credits
    FROM li GROUP BY term_code""", "li"))
def d08_sum_distinct(spark, sf_dir):
    li = staging.line_terms(Tables(spark, sf_dir))
    return li.groupBy("term_code").agg(
        F.sum("credits").alias("credits"),
        F.sum_distinct(F.when(F.col("budget_ind") == "Y", F.col("credits"))).alias("distinct_br_credits"))


@register("d09_avg_times_factor", with_views("""SELECT o_orderstatus,
    round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) * max(knob)) AS target
    FROM orders JOIN knobs USING (o_orderstatus) GROUP BY o_orderstatus""", ctes=[("knobs", _KNOB_SQL)]))
def d09_avg_times_factor(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderstatus", "o_totalprice")
    # avg as exact decimal sum / count, so the result does not depend on the
    # order rows are added in.
    avg = F.sum(_cents("o_totalprice")).cast("double") / F.count("o_totalprice")
    return (o.join(F.broadcast(knobs(spark)), "o_orderstatus")
             .groupBy("o_orderstatus").agg(F.round(avg * F.max("knob")).alias("target")))


@register("d10_partial_rollup", with_views("""SELECT term_code,
    CASE WHEN grouping(campus) = 1 THEN 'All' WHEN campus IS NULL THEN 'Unknown' ELSE campus END AS campus,
    count(DISTINCT pidm) AS students, count(*) AS orders_n,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
    FROM o GROUP BY term_code, ROLLUP (campus)""", "o"))
def d10_partial_rollup(spark, sf_dir):
    o = staging.orders_terms(Tables(spark, sf_dir))
    out = rollup_counts(o, ["term_code"], "campus", {"pidm": {"students": None}},
                        {"orders_n": F.lit(1), "total_price": _cents("o_totalprice")})
    return out.withColumn("total_price", F.col("total_price").cast("double"))


@register("d11_rollup_label", """SELECT o_orderstatus,
    CASE WHEN grouping(prio) = 1 THEN 'All' WHEN prio IS NULL THEN 'Unknown' ELSE prio END AS prio_label,
    coalesce(prio, 'All') AS prio_nvl, count(*) AS n
    FROM (SELECT o_orderstatus, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS prio
          FROM orders) s GROUP BY o_orderstatus, ROLLUP (prio)""")
def d11_rollup_label(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderstatus", "o_orderpriority")
    s = o.select("o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prio"))
    g = s.groupingSets([["o_orderstatus", "prio"], ["o_orderstatus"]], "o_orderstatus", "prio").agg(
        F.grouping("prio").alias("g"), F.count(F.lit(1)).alias("n"))
    # The reference's nvl() form relabels a real NULL as 'All' too (H8); the
    # grouping() form keeps them apart.
    return g.select("o_orderstatus",
                    F.when(F.col("g") == 1, "All").when(F.col("prio").isNull(), "Unknown")
                     .otherwise(F.col("prio")).alias("prio_label"),
                    F.coalesce("prio", F.lit("All")).alias("prio_nvl"), "n")


@register("d12_global_agg", with_views("""SELECT CAST(sum(cases) AS BIGINT) AS total_cases,
    CAST(sum(deaths) AS BIGINT) AS total_deaths,
    CAST(sum(deaths) AS DOUBLE) / CAST(sum(cases) AS DOUBLE) * 100 AS death_rate FROM daily""", "daily"))
def d12_global_agg(spark, sf_dir):
    d = staging.daily_series(Tables(spark, sf_dir))
    return d.agg(F.sum("cases").alias("total_cases"), F.sum("deaths").alias("total_deaths"),
                 percent(F.sum("deaths"), F.sum("cases")).alias("death_rate"))


@register("d13_agg_over_cast", with_views("""SELECT location, max(TRY_CAST(total_deaths AS INTEGER)) AS total_death_count
    FROM covid WHERE continent IS NOT NULL GROUP BY location""", "covid"))
def d13_agg_over_cast(spark, sf_dir):
    c = staging.covid_deaths(Tables(spark, sf_dir))
    return (c.filter(F.col("continent").isNotNull()).groupBy("location")
             .agg(F.max(F.col("total_deaths").try_cast("int")).alias("total_death_count")))


@register("d14_ratio_of_sums", with_views("""SELECT date, CAST(sum(cases) AS BIGINT) AS total_cases,
    CAST(sum(deaths) AS BIGINT) AS total_deaths,
    CASE WHEN sum(cases) = 0 THEN NULL ELSE CAST(sum(deaths) AS DOUBLE) / CAST(sum(cases) AS DOUBLE) * 100 END AS global_death_rate
    FROM daily GROUP BY date""", "daily"))
def d14_ratio_of_sums(spark, sf_dir):
    d = staging.daily_series(Tables(spark, sf_dir))
    return d.groupBy("date").agg(F.sum("cases").alias("total_cases"), F.sum("deaths").alias("total_deaths"),
                                 percent(F.sum("deaths"), F.sum("cases")).alias("global_death_rate"))


@register("d15_max_of_ratio", with_views("""SELECT location, population, max(total_cases) AS highest_infection_count,
    max(total_cases / population) * 100 AS infection_rate FROM covid GROUP BY location, population""", "covid"))
def d15_max_of_ratio(spark, sf_dir):
    c = staging.covid_deaths(Tables(spark, sf_dir))
    return c.groupBy("location", "population").agg(
        F.max("total_cases").alias("highest_infection_count"),
        (F.max(F.try_divide(F.col("total_cases"), F.col("population").cast("double"))) * 100).alias("infection_rate"))


@register("d16_distinct_grouped", with_views("""SELECT DISTINCT term_code, min(order_date) AS first_day
    FROM o GROUP BY term_code""", "o"))
def d16_distinct_grouped(spark, sf_dir):
    # DISTINCT over a GROUP BY result is redundant: the group keys are unique.
    o = staging.orders_terms(Tables(spark, sf_dir))
    return o.groupBy("term_code").agg(F.min("order_date").alias("first_day"))


_WIDE_KEYS = ["term_code", "campus", "continuing_ind", "budget_ind", "o_orderstatus", "l_returnflag",
              "season", "order_year", "ship_year", "discount_band"]


@register("d17_wide_group", with_views("""SELECT term_code, campus, continuing_ind, budget_ind, o_orderstatus,
    l_returnflag, season, order_year, ship_year, discount_band, count(*) AS n, sum(credits) AS credits
    FROM (SELECT *, substr(term_code, 5) AS season, CAST(year(order_date) AS INTEGER) AS order_year,
            CAST(year(ship_date) AS INTEGER) AS ship_year,
            CASE WHEN l_discount >= 0.05 THEN 'high' ELSE 'low' END AS discount_band FROM li) x
    GROUP BY ALL""", "li"))
def d17_wide_group(spark, sf_dir):
    li = staging.line_terms(Tables(spark, sf_dir)).withColumns({
        "season": F.expr("substr(term_code, 5)"),
        "order_year": F.year("order_date"),
        "ship_year": F.year("ship_date"),
        "discount_band": F.when(F.col("l_discount") >= 0.05, "high").otherwise("low"),
    })
    return li.groupBy(*_WIDE_KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum("credits").alias("credits"))


@register("d18_hidden_group_key", with_views("""SELECT term_code, count(*) AS n
    FROM o GROUP BY term_code, campus""", "o"))
def d18_hidden_group_key(spark, sf_dir):
    # Grouped by a column that is not selected: one output row per hidden value,
    # so term_code repeats (H28); kept as the reference has it.
    o = staging.orders_terms(Tables(spark, sf_dir))
    return o.groupBy("term_code", "campus").agg(F.count(F.lit(1)).alias("n")).drop("campus")


@register("d19_distinct_rate", """SELECT event_type,
    CAST(count(DISTINCT CASE WHEN value > 50 THEN user_id END) AS DOUBLE) / count(DISTINCT user_id) AS rate
    FROM events GROUP BY event_type""")
def d19_distinct_rate(spark, sf_dir):
    e = Tables(spark, sf_dir)("events", "event_type", "user_id", "value")
    return e.groupBy("event_type").agg(
        F.try_divide(F.count_distinct(F.when(F.col("value") > 50, F.col("user_id"))).cast("double"),
                     F.count_distinct("user_id")).alias("rate"))


@register("d20_constancy_check", """SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_values
    FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority) > 1""")
def d20_constancy_check(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_custkey", "o_orderpriority")
    return (o.groupBy("o_custkey").agg(F.count_distinct("o_orderpriority").alias("n_values"))
             .filter(F.col("n_values") > 1))
