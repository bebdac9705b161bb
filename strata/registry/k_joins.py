"""Keys C1-C22: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.joins import binned_interval_join, few_rows, interval_join, join_grouped, join_small, membership_flag, null_safe_on, strict_on
from strata.operators.reshape import partial_rollup, template_grain
from strata.operators.windows import partition_agg
from strata.registry import register
from strata.sources import staging
from strata.sources.staging import with_views
from strata.sources.tables import Tables


@register("c01_star_join", """SELECT l_orderkey, l_linenumber, o_orderstatus, c_mktsegment, n_name, r_name, p_type, s_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
      JOIN supplier ON l_suppkey = s_suppkey""")
def c01_star_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    o = t("orders", "o_orderkey", "o_custkey", "o_orderstatus")
    geo = t("nation", "n_nationkey", "n_name", "n_regionkey").join(
        t("region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    cust = join_small(t("customer", "c_custkey", "c_nationkey", "c_mktsegment"), geo,
                      F.col("c_nationkey") == F.col("n_nationkey"))
    f = li.join(o, li.l_orderkey == o.o_orderkey)          # fact to fact: shuffle join on the order key
    f = join_small(f, cust, F.col("o_custkey") == F.col("c_custkey"))
    f = join_small(f, t("part", "p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    f = join_small(f, t("supplier", "s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    return f.select("l_orderkey", "l_linenumber", "o_orderstatus", "c_mktsegment", "n_name", "r_name",
                    "p_type", "s_name")


@register("c02_join_using", """SELECT o_custkey, o_orderkey, c_name FROM orders
    JOIN (SELECT c_custkey AS o_custkey, c_name FROM customer) c USING (o_custkey)""")
def c02_join_using(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t("customer", "c_custkey", "c_name").withColumnRenamed("c_custkey", "o_custkey")
    return t("orders", "o_custkey", "o_orderkey").join(c, "o_custkey").select("o_custkey", "o_orderkey", "c_name")


@register("c03_join_two_keys", with_views("""SELECT d.location, d.date, CAST(d.cases AS BIGINT) AS cases,
    v.new_vaccinations FROM daily d JOIN vac v ON d.location = v.location AND d.date = v.date""", "daily", "vac"))
def c03_join_two_keys(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return (staging.daily_series(t).join(staging.vaccinations(t), ["location", "date"])
            .select("location", "date", "cases", "new_vaccinations"))


@register("c04_join_const_predicate", """SELECT o_orderkey, c_name FROM orders
    JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'""")
def c04_join_const_predicate(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t("customer", "c_custkey", "c_name", "c_mktsegment").filter(F.col("c_mktsegment") == "BUILDING")
    o = t("orders", "o_orderkey", "o_custkey")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name")


@register("c05_left_join", """SELECT o_orderkey, l_linenumber, l_quantity FROM orders
    LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def c05_left_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t("orders", "o_orderkey")
    li = t("lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    return o.join(li, o.o_orderkey == li.l_orderkey, "left").select("o_orderkey", "l_linenumber", "l_quantity")


@register("c06_left_join_on_filter", """SELECT c_custkey, o_orderkey, o_orderdate FROM customer
    LEFT JOIN (SELECT o_custkey, o_orderkey, o_orderdate,
                 dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS seq FROM orders) o
      ON c_custkey = o_custkey AND seq = 1""")
def c06_left_join_on_filter(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t("orders", "o_custkey", "o_orderkey", "o_orderdate")
    # seq = 1 of a descending dense rank = the rows holding the customer's latest date.
    latest = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("o_orderdate"))
    firsts = o.join(latest, ["o_custkey", "o_orderdate"], "left_semi")
    c = t("customer", "c_custkey")
    return c.join(firsts, c.c_custkey == firsts.o_custkey, "left").select("c_custkey", "o_orderkey", "o_orderdate")


@register("c07_interval_join", """SELECT o_orderkey, count(l_orderkey) AS lines_within_30_days
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
      AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 30 DAY
    GROUP BY o_orderkey""")
def c07_interval_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t("orders", "o_orderkey", "o_orderdate")
    li = t("lineitem", "l_orderkey", "l_shipdate")
    j = interval_join(o, li, ["o_orderkey"], F.col("l_shipdate"), F.col("o_orderdate"),
                      F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"), "left", right_keys=["l_orderkey"])
    return j.groupBy("o_orderkey").agg(F.count("l_orderkey").alias("lines_within_30_days"))


@register("c07_interval_join_binned", """WITH promo AS (SELECT p_partkey, p_size, p_brand,
      CAST(DATE '1995-01-01' + CAST(p_partkey % 1500 AS INTEGER) AS DATE) AS opens FROM part WHERE p_size <= 5)
    SELECT p_partkey, count(o_orderkey) AS orders_in_time, CAST(coalesce(sum(o_orderkey), 0) AS BIGINT) AS key_sum
    FROM promo LEFT JOIN orders ON substr(p_brand, 7, 1) = substr(o_orderpriority, 1, 1)
      AND CAST(o_orderdate AS DATE) BETWEEN opens AND CAST(opens + CAST(p_size AS INTEGER) AS DATE)
    GROUP BY p_partkey""")
def c07_interval_join_binned(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # Five keys hold all points and intervals; the bins of a week spread them.
    promo = t("part", "p_partkey", "p_size", "p_brand").filter("p_size <= 5").select(
        "p_partkey", F.substring("p_brand", 7, 1).alias("kind"),
        F.expr("date_add(DATE'1995-01-01', CAST(p_partkey % 1500 AS INT))").alias("opens"), "p_size")
    promo = promo.withColumn("closes", F.expr("date_add(opens, CAST(p_size AS INT))"))
    o = t("orders", "o_orderkey", "o_orderdate", "o_orderpriority").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), F.substring("o_orderpriority", 1, 1).alias("level"))
    j = binned_interval_join(o, promo, ["level"], "day", "opens", "closes", 7 * 86_400, keep="intervals",
                             interval_keys=["kind"], interval_id="p_partkey")
    return j.groupBy("p_partkey").agg(F.count("o_orderkey").alias("orders_in_time"),
                                      F.coalesce(F.sum("o_orderkey"), F.lit(0).cast("long")).alias("key_sum"))


@register("c08_theta_join", """WITH ay AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders
      WHERE o_orderstatus = 'F' ORDER BY y DESC LIMIT 6)
    SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS transfer_date FROM orders
    JOIN ay ON year(o_orderdate) >= ay.y WHERE o_orderstatus = 'P'""")
def c08_theta_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t("orders", "o_custkey", "o_orderdate", "o_orderstatus")
    ay = (o.filter(F.col("o_orderstatus") == "F").select(F.year("o_orderdate").alias("y"))
           .distinct().orderBy(F.desc("y")).limit(6))   # the calendar: newest six years
    # "year >= some calendar year" is "year >= the smallest one": a scalar
    # subquery, pushed into the scan, instead of a nested-loop theta join.
    first_year = ay.select(F.min("y")).scalar()
    return (o.filter((F.col("o_orderstatus") == "P") & (F.year("o_orderdate") >= first_year))
             .select("o_custkey", F.to_date("o_orderdate").alias("transfer_date")).distinct())


@register("c09_self_join", with_views("""SELECT a.UniqueID, a.ParcelID, count(*) AS partners,
      min(b.PropertyAddress) AS donor_address
    FROM prop a JOIN prop b ON a.ParcelID = b.ParcelID AND a.UniqueID <> b.UniqueID
    WHERE a.PropertyAddress IS NULL GROUP BY a.UniqueID, a.ParcelID""", "prop"))
def c09_self_join(spark, sf_dir):
    p = staging.properties(Tables(spark, sf_dir)).select("UniqueID", "ParcelID", "PropertyAddress")
    # The pairs (a, b) of one parcel are summarised per parcel instead of being
    # emitted: partners = rows in the parcel - 1; the donor (a's own address is
    # NULL) = the parcel's smallest address.
    g = partition_agg(p, ["ParcelID"], {"__n": F.count(F.lit(1)), "donor_address": F.min("PropertyAddress")})
    return (g.filter(F.col("PropertyAddress").isNull() & (F.col("__n") > 1) & F.col("ParcelID").isNotNull())
             .select("UniqueID", "ParcelID", (F.col("__n") - 1).alias("partners"), "donor_address"))


@register("c10_cross_join", """SELECT c_custkey, y FROM customer
    CROSS JOIN (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders) ys""")
def c10_cross_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    years = t("orders", "o_orderdate").select(F.year("o_orderdate").alias("y")).distinct()
    # The year list (one entry per calendar year) is a scalar subquery; each
    # customer row is exploded against it: no join, no shuffle of the spine.
    year_list = years.select(F.sort_array(F.collect_list("y"))).scalar()
    return t("customer", "c_custkey").select("c_custkey", F.explode(year_list).alias("y"))


@register("c11_concat_key_join", with_views("""SELECT o_orderkey, substr(o.term_code, 5) AS season, o.campus,
      CAST(t.n AS BIGINT) AS target_n
    FROM o LEFT JOIN (SELECT substr(term_code, 5) AS season, campus, count(*) AS n FROM o GROUP BY 1, 2) t
      ON substr(o.term_code, 5) = t.season AND o.campus = t.campus""", "o"))
def c11_concat_key_join(spark, sf_dir):
    o = staging.orders_terms(Tables(spark, sf_dir)).withColumn("season", F.expr("substr(term_code, 5)"))
    # Seasons x campuses: a few rows, so the orders are not exchanged on that key.
    target = few_rows(o.groupBy("season", "campus").agg(F.count(F.lit(1)).alias("target_n")), "targets")
    # Two-column key instead of season || campus: no collisions, NULL-correct.
    return o.join(target, ["season", "campus"], "left").select("o_orderkey", "season", "campus", "target_n")


@register("c12_offset_key_join", """SELECT g.o_orderkey, count(w.o_orderkey) AS wage_rows
    FROM orders g LEFT JOIN orders w ON w.o_custkey = g.o_custkey
      AND year(w.o_orderdate) = year(g.o_orderdate) + 4 AND w.o_orderstatus = 'O'
    WHERE g.o_orderstatus = 'F' GROUP BY g.o_orderkey""")
def c12_offset_key_join(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    grads = o.filter(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_custkey", (F.year("o_orderdate") + 4).alias("wage_year"))
    # Pre-aggregate the right side to one row per (customer, year): the left
    # join then cannot fan out, and a hot customer is combined map-side.
    wages = (o.filter(F.col("o_orderstatus") == "O")
              .groupBy("o_custkey", F.year("o_orderdate").alias("wage_year"))
              .agg(F.count(F.lit(1)).alias("n")))
    return (join_grouped(grads, wages, ["o_custkey", "wage_year"], "left")
                 .select("o_orderkey", F.coalesce("n", F.lit(0)).alias("wage_rows")))


_C13_SQL = """WITH src AS (SELECT o_orderstatus AS status,
      CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS prio,
      c_mktsegment AS segment FROM orders JOIN customer ON o_custkey = c_custkey),
    tpl AS (SELECT DISTINCT status, prio FROM src UNION SELECT DISTINCT status, segment FROM src),
    m AS (SELECT status, prio, count(*) AS n FROM src GROUP BY status, prio)
    SELECT tpl.status, tpl.prio, CAST(ms.n AS BIGINT) AS n_strict, CAST(mn.n AS BIGINT) AS n_null_safe
    FROM tpl LEFT JOIN m ms ON tpl.status = ms.status AND tpl.prio = ms.prio
      LEFT JOIN m mn ON tpl.status IS NOT DISTINCT FROM mn.status AND tpl.prio IS NOT DISTINCT FROM mn.prio"""


@register("c13_template_join", _C13_SQL)
def c13_template_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t("orders", "o_custkey", "o_orderstatus", "o_orderpriority")
    c = t("customer", "c_custkey", "c_mktsegment")
    src = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderstatus").alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prio"),
        F.col("c_mktsegment").alias("segment"))
    tpl = template_grain([src.select("status", "prio"), src.select("status", "segment")], ["status", "prio"])
    m = src.groupBy("status", "prio").agg(F.count(F.lit(1)).alias("n"))
    ms = m.select(F.col("status").alias("s1"), F.col("prio").alias("p1"), F.col("n").alias("n_strict"))
    mn = m.select(F.col("status").alias("s2"), F.col("prio").alias("p2"), F.col("n").alias("n_null_safe"))
    out = tpl.join(ms, strict_on(tpl, ms, ["status", "prio"], ["s1", "p1"]), "left")
    out = out.join(mn, null_safe_on(out, mn, ["status", "prio"], ["s2", "p2"]), "left")
    return out.select("status", "prio", "n_strict", "n_null_safe")


@register("c14_semi_flag", with_views("""SELECT o_orderkey, term_code,
    CASE WHEN term_code IN (SELECT DISTINCT term_code FROM o ORDER BY term_code DESC LIMIT 3) THEN 'Y' END AS recent_term
    FROM o""", "o"))
def c14_semi_flag(spark, sf_dir):
    o = staging.orders_terms(Tables(spark, sf_dir)).select("o_orderkey", "term_code")
    top3 = o.select("term_code").distinct().orderBy(F.desc("term_code")).limit(3)
    # At most three rows (LIMIT): broadcast bounded by construction.
    return membership_flag(o, ["term_code"], F.broadcast(top3), "recent_term", yes="Y", no=None)


@register("c15_anti_filter", with_views("""SELECT o_orderkey, term_code FROM o
    WHERE term_code NOT IN (SELECT DISTINCT max(term_code) OVER (PARTITION BY substr(term_code, 5)) FROM o)""", "o"))
def c15_anti_filter(spark, sf_dir):
    o = staging.orders_terms(Tables(spark, sf_dir)).select("o_orderkey", "term_code")
    # One row per season, written once: the list and its NULL test read the written rows.
    latest = few_rows(o.groupBy(F.expr("substr(term_code, 5)")).agg(F.max("term_code").alias("latest")), "latest_terms")
    # NOT IN: rows whose term is NULL, or any NULL in the list, are excluded.
    if not latest.filter(F.col("latest").isNull()).isEmpty():
        return o.limit(0)
    return o.filter(F.col("term_code").isNotNull()).join(latest, o.term_code == latest.latest, "left_anti")


_ENROLLED_2001 = "SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2001"


def _enrolled_2001(t):
    return t("orders", "o_custkey", "o_orderdate").filter(F.year("o_orderdate") == 2001)


@register("c16_anti_flag", f"""SELECT c_custkey,
    CASE WHEN c_custkey NOT IN (SELECT o_custkey FROM ({_ENROLLED_2001}) p WHERE o_custkey IS NOT NULL)
         THEN 'Y' ELSE 'N' END AS dropout_flag FROM customer""")
def c16_anti_flag(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return membership_flag(t("customer", "c_custkey"), ["c_custkey"], _enrolled_2001(t), "dropout_flag",
                           yes="N", no="Y", member_keys=["o_custkey"])


@register("c17_left_null_flag", f"""SELECT c_custkey,
    CASE WHEN p.o_custkey IS NULL THEN 'Y' ELSE 'N' END AS dropout_flag
    FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM ({_ENROLLED_2001}) q) p ON p.o_custkey = c_custkey""")
def c17_left_null_flag(spark, sf_dir):
    t = Tables(spark, sf_dir)
    perm = _enrolled_2001(t).select("o_custkey").distinct()   # distinct: no row multiplication (H30)
    c = t("customer", "c_custkey")
    j = c.join(perm, c.c_custkey == perm.o_custkey, "left")
    return j.select("c_custkey", F.when(F.col("o_custkey").isNull(), "Y").otherwise("N").alias("dropout_flag"))


@register("c18_scalar_subquery", """SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey >= (SELECT max(o_custkey) - 700 FROM orders)""")
def c18_scalar_subquery(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_custkey")
    bound = o.select(F.max("o_custkey") - 700).scalar()
    return o.filter(F.col("o_custkey") >= bound)


@register("c19_join_aggregates", with_views("""SELECT p.lot_name AS LotName, CAST(p.total AS DOUBLE) AS PurchaseTotal,
      CAST(s.total AS DOUBLE) AS SalesTotal
    FROM (SELECT lot_name, sum(CAST(round(amount, 2) AS DECIMAL(18,2))) AS total FROM txn
          WHERE txn_type = 'purchase' GROUP BY lot_name) p
    JOIN (SELECT lot_name, sum(CAST(round(amount, 2) AS DECIMAL(18,2))) AS total FROM txn
          WHERE txn_type = 'revenue' GROUP BY lot_name) s ON p.lot_name = s.lot_name""", "txn"))
def c19_join_aggregates(spark, sf_dir):
    txn = staging.ledger(Tables(spark, sf_dir))
    amt = F.round("amount", 2).cast("decimal(18,2)")
    tt = F.col("txn_type")
    # Both aggregates come from one shuffle; the inner join of the two views is
    # "the lot has at least one row of each type".
    g = (txn.filter(tt.isin("purchase", "revenue")).groupBy("lot_name")
            .agg(F.sum(F.when(tt == "purchase", amt)).alias("p"), F.sum(F.when(tt == "revenue", amt)).alias("s"),
                 F.count_if(tt == "purchase").alias("np"), F.count_if(tt == "revenue").alias("ns")))
    return (g.filter((F.col("np") > 0) & (F.col("ns") > 0) & F.col("lot_name").isNotNull())
             .select(F.col("lot_name").alias("LotName"), F.col("p").cast("double").alias("PurchaseTotal"),
                     F.col("s").cast("double").alias("SalesTotal")))


@register("c20_role_playing", """SELECT l_orderkey, l_linenumber, cn.n_name AS customer_nation, sn.n_name AS supplier_nation
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN supplier ON l_suppkey = s_suppkey
      JOIN nation sn ON s_nationkey = sn.n_nationkey""")
def c20_role_playing(spark, sf_dir):
    t = Tables(spark, sf_dir)
    nation = t("nation", "n_nationkey", "n_name")
    cn = nation.alias("cn")
    sn = nation.alias("sn")
    cust = join_small(t("customer", "c_custkey", "c_nationkey"), cn, F.col("c_nationkey") == F.col("cn.n_nationkey"))
    supp = join_small(t("supplier", "s_suppkey", "s_nationkey"), sn, F.col("s_nationkey") == F.col("sn.n_nationkey"))
    li = t("lineitem", "l_orderkey", "l_linenumber", "l_suppkey")
    o = t("orders", "o_orderkey", "o_custkey")
    f = li.join(o, li.l_orderkey == o.o_orderkey)
    f = join_small(f, cust, F.col("o_custkey") == F.col("c_custkey"))
    f = join_small(f, supp, F.col("l_suppkey") == F.col("s_suppkey"))
    return f.select("l_orderkey", "l_linenumber", F.col("cn.n_name").alias("customer_nation"),
                    F.col("sn.n_name").alias("supplier_nation"))


@register("c21_lookup_label", """WITH r AS (
      SELECT CASE WHEN grouping(c_nationkey) = 1 THEN 'All' ELSE CAST(c_nationkey AS VARCHAR) END AS nation_code,
             count(*) AS n_customers
      FROM customer GROUP BY ROLLUP (c_nationkey))
    SELECT nation_code, CAST(n_customers AS BIGINT) AS n_customers,
      CASE WHEN nation_code = 'All' THEN 'All' ELSE n_name END AS nation_label
    FROM r LEFT JOIN nation ON nation_code = CAST(n_nationkey AS VARCHAR)""")
def c21_lookup_label(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t("customer", "c_nationkey").withColumn("nation_code", F.col("c_nationkey").cast("string"))
    r = partial_rollup(c, [], "nation_code", {"n_customers": F.count(F.lit(1))}, null_label=None)
    n = t("nation", "n_nationkey", "n_name").withColumn("code", F.col("n_nationkey").cast("string"))
    j = join_small(r, n, r.nation_code == n.code, "left")
    return j.select("nation_code", "n_customers",
                    F.when(F.col("nation_code") == "All", "All").otherwise(F.col("n_name")).alias("nation_label"))


@register("c22_detail_join", with_views("""SELECT txn_id, t.lot_name, d.segment FROM txn t
    JOIN (SELECT 'lot ' || CAST(c_custkey AS VARCHAR) AS lot_name, c_mktsegment AS segment FROM customer) d
      ON t.lot_name = d.lot_name""", "txn"))
def c22_detail_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    txn = staging.ledger(t)
    details = t("customer", "c_custkey", "c_mktsegment").select(
        F.concat(F.lit("lot "), F.col("c_custkey").cast("string")).alias("lot_name"),
        F.col("c_mktsegment").alias("segment"))
    return txn.join(details, "lot_name").select("txn_id", "lot_name", "segment")
