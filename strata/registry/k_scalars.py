"""Keys I1-I19 (scalar functions), J1-J10 (cleaning steps), K2-K3 (composition)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.functions.dates import elapsed_years, month_abbrev, parse_date_key, year_diff
from strata.functions.numeric import percent
from strata.functions.text import before_delimiter, concat_null_as_empty, part_from_right, split_first
from strata.operators.cleaning import fill_from_group, fill_zero, recode, repeated_values, sentinel_to_null
from strata.operators.joins import join_grouped
from strata.operators.reshape import pivot_fixed
from strata.operators.windows import keep_first
from strata.plans import ledger
from strata.plans.properties import VACANT_LABELS
from strata.registry import register
from strata.sources import sinks, staging
from strata.sources.staging import with_views
from strata.sources.tables import Tables

AS_OF = dt.date(2001, 6, 1)

# --------------------------------------------------------------------------- I: scalar functions


@register("i01_substr", with_views("""SELECT DISTINCT term_code, substr(term_code, 5) AS season,
    substr(term_code, 1, 4) AS term_year, substr(term_code, 1, 4) AS term_year_from_zero FROM o""", "o"))
def i01_substr(spark, sf_dir):
    o = staging.orders_terms(Tables(spark, sf_dir))
    # Oracle substr(s, 0, 4) treats start 0 as 1; so does Spark's substring.
    return o.select("term_code", F.expr("substr(term_code, 5)").alias("season"),
                    F.substring("term_code", 1, 4).alias("term_year"),
                    F.substring("term_code", 0, 4).alias("term_year_from_zero")).distinct()


@register("i02_before_delimiter", """SELECT p_partkey,
    NULLIF(CASE WHEN strpos(p_name, ' ') > 0 THEN substr(p_name, 1, strpos(p_name, ' ') - 1) ELSE p_name END, '') AS first_word,
    NULLIF(CASE WHEN strpos(p_name, ':') > 0 THEN substr(p_name, 1, strpos(p_name, ':') - 1) ELSE p_name END, '') AS program
    FROM part""")
def i02_before_delimiter(spark, sf_dir):
    p = Tables(spark, sf_dir)("part", "p_partkey", "p_name")
    return p.select("p_partkey", before_delimiter("p_name", " ").alias("first_word"),
                    before_delimiter("p_name", ":").alias("program"))


@register("i03_split_first", """SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN trim(substr(url, 1, strpos(url, '://') - 1)) END AS scheme,
    CASE WHEN strpos(url, '://') > 0 THEN trim(substr(url, strpos(url, '://') + 3)) END AS rest
    FROM pages""")
def i03_split_first(spark, sf_dir):
    p = Tables(spark, sf_dir)("pages", "page_id", "url")
    scheme, rest = split_first("url", "://")
    return p.select("page_id", scheme.alias("scheme"), rest.alias("rest"))


@register("i04_split_right", """SELECT page_id, trim(string_split(url, '/')[-1]) AS last_part,
    trim(string_split(url, '/')[-2]) AS second_last, trim(string_split(url, '/')[-3]) AS third_last
    FROM pages""")
def i04_split_right(spark, sf_dir):
    p = Tables(spark, sf_dir)("pages", "page_id", "url")
    return p.select("page_id", part_from_right("url", 1, "/").alias("last_part"),
                    part_from_right("url", 2, "/").alias("second_last"),
                    part_from_right("url", 3, "/").alias("third_last"))


@register("i05_replace", "SELECT page_id, replace(url, '/', '.') AS dotted FROM pages")
def i05_replace(spark, sf_dir):
    p = Tables(spark, sf_dir)("pages", "page_id", "url")
    return p.select("page_id", F.replace("url", F.lit("/"), F.lit(".")).alias("dotted"))


@register("i06_concat", with_views("""SELECT UniqueID, CAST(ParcelID AS VARCHAR) || ':' || PropertyAddress AS strict_key,
    concat(CAST(ParcelID AS VARCHAR), ':', PropertyAddress) AS oracle_key FROM prop""", "prop"))
def i06_concat(spark, sf_dir):
    p = staging.properties(Tables(spark, sf_dir))
    pid = F.col("ParcelID").cast("string")
    return p.select("UniqueID", F.concat(pid, F.lit(":"), "PropertyAddress").alias("strict_key"),
                    concat_null_as_empty(pid, F.lit(":"), "PropertyAddress").alias("oracle_key"))


@register("i07_coalesce", with_views("""SELECT UniqueID, coalesce(PropertyAddress, OwnerAddress) AS address
    FROM prop""", "prop"))
def i07_coalesce(spark, sf_dir):
    p = staging.properties(Tables(spark, sf_dir))
    return p.select("UniqueID", F.coalesce("PropertyAddress", "OwnerAddress").alias("address"))


@register("i08_parse_date", """SELECT o_orderkey, k AS dim_date_key, CAST(strptime(CAST(k AS VARCHAR), '%Y%m%d') AS DATE) AS calendar_date
    FROM (SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS k FROM orders) x""")
def i08_parse_date(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderdate")
    o = o.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("dim_date_key"))
    return o.withColumn("calendar_date", parse_date_key("dim_date_key"))


@register("i09_to_date", "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem")
def i09_to_date(spark, sf_dir):
    li = Tables(spark, sf_dir)("lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
    return li.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_date"))


@register("i10_date_part", """SELECT o_orderkey, upper(strftime(o_orderdate, '%b')) AS mon,
    CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders""")
def i10_date_part(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", month_abbrev("o_orderdate").alias("mon"), F.year("o_orderdate").alias("yr"))


@register("i11_year_diff", """SELECT o_orderkey, CAST(2001 - year(o_orderdate) AS INTEGER) AS age FROM orders""")
def i11_year_diff(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", year_diff(AS_OF, F.col("o_orderdate")).alias("age"))


@register("i12_date_sub", """SELECT y, CAST(min(o_orderdate) AS DATE) - 1 AS prior_end
    FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderdate FROM orders) x GROUP BY y""")
def i12_date_sub(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderdate")
    g = o.groupBy(F.year("o_orderdate").alias("y")).agg(F.to_date(F.min("o_orderdate")).alias("start"))
    return g.select("y", F.date_sub("start", 1).alias("prior_end"))


@register("i13_elapsed_years", with_views("""SELECT l_orderkey, l_linenumber,
    round(datediff('day', order_date, ship_date) / 365.25, 2) + 0.0 AS years FROM li""", "li"))
def i13_elapsed_years(spark, sf_dir):
    li = staging.line_terms(Tables(spark, sf_dir))
    return li.select("l_orderkey", "l_linenumber", elapsed_years("ship_date", "order_date").alias("years"))


@register("i14_as_of", "SELECT o_orderkey, DATE '2001-06-01' AS as_of FROM orders")
def i14_as_of(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderkey")
    return o.select("o_orderkey", F.lit(AS_OF).alias("as_of"))


@register("i15_round", """SELECT event_id, CAST(round(CAST(value AS DECIMAL(12,2)), 1) AS DOUBLE) AS one_place,
    CAST(round(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS whole FROM events""")
def i15_round(spark, sf_dir):
    e = Tables(spark, sf_dir)("events", "event_id", "value")
    v = F.col("value").cast("decimal(12,2)")
    return e.select("event_id", F.round(v, 1).cast("double").alias("one_place"),
                    F.round(v).cast("double").alias("whole"))


@register("i16_percent", with_views("""SELECT location, date,
    CAST(deaths AS DOUBLE) / CAST(cases AS DOUBLE) * 100 AS death_rate FROM daily""", "daily"))
def i16_percent(spark, sf_dir):
    d = staging.daily_series(Tables(spark, sf_dir))
    return d.select("location", "date", percent("deaths", "cases").alias("death_rate"))


@register("i17_int_div", with_views("""SELECT location, date,
    CASE WHEN cases <> 0 THEN CAST(deaths * 100 // cases AS BIGINT) END AS death_rate_truncated FROM daily""", "daily"))
def i17_int_div(spark, sf_dir):
    d = staging.daily_series(Tables(spark, sf_dir))
    # Integer division, as the reference's int-typed temp table computes it (H2).
    return d.select("location", "date",
                    F.when(F.col("cases") != 0, F.expr("(deaths * 100) div cases")).alias("death_rate_truncated"))


@register("i18_cast", """SELECT p_partkey, CAST(substr(p_brand, 7) AS INTEGER) AS brand_no,
    TRY_CAST(substr(p_name, 1, 3) AS INTEGER) AS dirty FROM part""")
def i18_cast(spark, sf_dir):
    p = Tables(spark, sf_dir)("part", "p_partkey", "p_brand", "p_name")
    return p.select("p_partkey", F.expr("substr(p_brand, 7)").cast("int").alias("brand_no"),
                    F.substring("p_name", 1, 3).try_cast("int").alias("dirty"))


@register("i19_arithmetic", """SELECT l_orderkey, l_linenumber,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem""")
def i19_arithmetic(spark, sf_dir):
    li = Tables(spark, sf_dir)("lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    return li.select("l_orderkey", "l_linenumber",
                     (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"))


# --------------------------------------------------------------------------- J: cleaning steps


@register("j01_rewrite_column", with_views("""SELECT txn_id, CAST(CAST(round(amount, 2) AS DECIMAL(18,2)) AS DOUBLE) AS amount
    FROM txn""", "txn"))
def j01_rewrite_column(spark, sf_dir):
    txn = staging.ledger(Tables(spark, sf_dir))
    return txn.select("txn_id", F.round("amount", 2).cast("decimal(18,2)").cast("double").alias("amount"))


@register("j02_sentinel_to_null", "SELECT event_id, NULLIF(event_type, 'error') AS event_type FROM events")
def j02_sentinel_to_null(spark, sf_dir):
    e = Tables(spark, sf_dir)("events", "event_id", "event_type")
    return sentinel_to_null(e, "event_type", "error")


@register("j03_fill_from_group", with_views("""SELECT UniqueID, ParcelID,
    coalesce(PropertyAddress, donor) AS PropertyAddress
    FROM prop LEFT JOIN (SELECT ParcelID AS parcel, min(PropertyAddress) AS donor FROM prop GROUP BY ParcelID) ON ParcelID = parcel""", "prop"))
def j03_fill_from_group(spark, sf_dir):
    p = staging.properties(Tables(spark, sf_dir)).select("UniqueID", "ParcelID", "PropertyAddress")
    return fill_from_group(p, ["ParcelID"], "PropertyAddress")


@register("j04_fill_zero", with_views("""SELECT NULLIF(lot_name, 'NULL') AS LotName, """ + ",\n".join(
    f"CAST(coalesce(sum(CAST(round(amount, 2) AS DECIMAL(18,2))) FILTER (WHERE txn_type = '{t}'), 0) AS DOUBLE) AS {c}"
    for t, c in zip(ledger.LEDGER_TYPES, ledger.LEDGER_COLUMNS)) + " FROM txn GROUP BY 1", "txn"))
def j04_fill_zero(spark, sf_dir):
    txn = ledger.clean_ledger(staging.ledger(Tables(spark, sf_dir)))
    wide = pivot_fixed(txn, ["lot_name"], "txn_type", ledger.LEDGER_TYPES, F.col("amount"), ledger.LEDGER_COLUMNS)
    wide = fill_zero(wide, ledger.LEDGER_COLUMNS)
    return wide.select(F.col("lot_name").alias("LotName"),
                       *[F.col(c).cast("double").alias(c) for c in ledger.LEDGER_COLUMNS])


@register("j05_add_derived", with_views("""SELECT UniqueID, CAST(SaleDate AS DATE) AS SaleDateConverted FROM prop""", "prop"))
def j05_add_derived(spark, sf_dir):
    p = staging.properties(Tables(spark, sf_dir))
    return p.withColumn("SaleDateConverted", F.to_date("SaleDate")).select("UniqueID", "SaleDateConverted")


@register("j06_drop_columns", with_views("""SELECT UniqueID, ParcelID, SalePrice, LegalReference, SoldAsVacant
    FROM prop""", "prop"))
def j06_drop_columns(spark, sf_dir):
    p = staging.properties(Tables(spark, sf_dir))
    return p.drop("OwnerAddress", "TaxDistrict", "PropertyAddress", "SaleDate")


@register("j07_dedupe_keep_first", """SELECT doc_id, lang FROM (
    SELECT doc_id, lang, row_number() OVER (PARTITION BY text ORDER BY doc_id NULLS FIRST) AS rn FROM documents) d WHERE rn = 1""")
def j07_dedupe_keep_first(spark, sf_dir):
    d = Tables(spark, sf_dir)("documents", "doc_id", "text", "lang").withColumn("__h", F.xxhash64("text"))
    # Rows with a unique text hash are kept as they are; whole texts are
    # compared only inside repeated hashes (exact: equal texts share a hash).
    cand = repeated_values(d, "__h")
    unique = join_grouped(d, cand, ["__h"], "left_anti")
    firsts = keep_first(join_grouped(d, cand, ["__h"], "left_semi"), ["__h", "text"], "doc_id")
    return unique.unionByName(firsts).select("doc_id", "lang")


@register("j08_append", """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
    UNION ALL SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' OR o_orderdate IS NULL""")
def j08_append(spark, sf_dir):
    # INSERT INTO t SELECT: a typed table filled from one query, then appended
    # with the rest of the table.
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    types = {"o_orderkey": "bigint", "o_orderstatus": "string"}
    cut = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    first = sinks.typed_staging(o.filter(cut), types)
    more = sinks.typed_staging(o.filter(~cut | F.col("o_orderdate").isNull()), types)
    return first.unionByName(more)


@register("j09_recode", with_views("""SELECT UniqueID,
    CASE WHEN SoldAsVacant = 'Y' THEN 'Yes' WHEN SoldAsVacant = 'N' THEN 'No' ELSE SoldAsVacant END AS SoldAsVacant
    FROM prop""", "prop"))
def j09_recode(spark, sf_dir):
    p = staging.properties(Tables(spark, sf_dir))
    return p.select("UniqueID", recode("SoldAsVacant", VACANT_LABELS, default="SoldAsVacant").alias("SoldAsVacant"))


@register("j10_category_profile", with_views("""SELECT SoldAsVacant, count(SoldAsVacant) AS n
    FROM prop GROUP BY SoldAsVacant ORDER BY 2""", "prop"))
def j10_category_profile(spark, sf_dir):
    p = staging.properties(Tables(spark, sf_dir))
    return p.groupBy("SoldAsVacant").agg(F.count("SoldAsVacant").alias("n")).orderBy("n")


# --------------------------------------------------------------------------- K: composition


@register("k02_cte_columns", """WITH p (status, n) AS (SELECT o_orderstatus, count(*) FROM orders GROUP BY 1)
    SELECT *, CAST(n AS DOUBLE) / sum(n) OVER () * 100 AS share FROM p""")
def k02_cte_columns(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders", "o_orderstatus")
    p = o.groupBy("o_orderstatus").agg(F.count(F.lit(1))).toDF("status", "n")
    # One row per status value: the un-partitioned total is over a bounded set.
    return p.withColumn("share", F.col("n").cast("double") / F.sum("n").over(Window.partitionBy()) * 100)


@register("k03_derived_table", with_views("""SELECT lot_name, txn_type, CAST(amount AS DOUBLE) AS amount FROM (
    SELECT NULLIF(lot_name, 'NULL') AS lot_name, txn_type, CAST(round(amount, 2) AS DECIMAL(18,2)) AS amount FROM txn) x
    WHERE txn_type IN ('revenue', 'purchase')""", "txn"))
def k03_derived_table(spark, sf_dir):
    x = ledger.clean_ledger(staging.ledger(Tables(spark, sf_dir))).select("lot_name", "txn_type", "amount")
    return (x.filter(F.col("txn_type").isin("revenue", "purchase"))
             .select("lot_name", "txn_type", F.col("amount").cast("double").alias("amount")))
