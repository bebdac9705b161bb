"""Stand-in relations derived from the provided tables.

The reference's jobs run on institutional tables (terms, enrollments, ledgers,
properties) that are not provided.  Each stand-in below is a deterministic
projection of the driver tables into the shape a job expects, written twice:
once as a Spark DataFrame, once as SQL text for the DuckDB oracle.  Both must
stay in step; the registry's oracle check compares them on every key.

All stand-ins keep every input row: NULLs and sentinels are injected by rules
on data values, never by dropping rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.sources.tables import Tables
from strata.sources.tables import constant_frame


def _season(month: Column) -> Column:
    return F.when(month <= 4, "20").when(month <= 8, "30").otherwise("40")


def orders_terms(t: Tables) -> DataFrame:
    """``o``: orders with customer attributes and a term code per order."""
    o = t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
          "o_orderdate", "o_orderpriority")
    c = t("customer", "c_custkey", "c_mktsegment", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey",
        F.col("o_custkey").alias("pidm"),
        "o_orderstatus",
        "o_totalprice",
        F.to_date("o_orderdate").alias("order_date"),
        "o_orderpriority",
        F.concat(F.year("o_orderdate").cast("string"), _season(F.month("o_orderdate"))).alias("term_code"),
        F.col("c_mktsegment").alias("campus"),
        "c_nationkey",
        F.when(F.col("o_orderstatus") == "F", "N").otherwise("Y").alias("continuing_ind"),
    )


def order_terms_light(t: Tables) -> DataFrame:
    """Orders with their term code, without customer attributes."""
    o = t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return o.select(
        "o_orderkey", F.col("o_custkey").alias("pidm"), "o_orderstatus", "o_totalprice",
        F.to_date("o_orderdate").alias("order_date"), "o_orderpriority",
        F.concat(F.year("o_orderdate").cast("string"), _season(F.month("o_orderdate"))).alias("term_code"))


def line_terms(t: Tables) -> DataFrame:
    """``li``: line items with their order's term, student and campus."""
    li = t("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
           "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    o = orders_terms(t)
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.col("l_partkey").alias("crn"),
        F.col("l_quantity").alias("credits"),
        "l_extendedprice", "l_discount", "l_returnflag",
        F.to_date("l_shipdate").alias("ship_date"),
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("budget_ind"),
        "pidm", "term_code", "campus", "continuing_ind", "order_date", "o_orderstatus",
    )


# Event type -> ledger transaction type (fixed values of the stand-in).
TXN_TYPES = {
    "purchase": "revenue",
    "view": "purchase",
    "error": "fee",
    "click": "shipseller",
    "signup": "shipbuyer",
}


def ledger(t: Tables) -> DataFrame:
    """``txn``: events as a sales ledger (lot, item, type, amount)."""
    e = t("events", "event_id", "ts", "user_id", "event_type", "value")
    ttype = F.lit(None).cast("string")
    for src, dst in reversed(list(TXN_TYPES.items())):
        ttype = F.when(F.col("event_type") == src, dst).otherwise(ttype)
    return e.select(
        F.col("event_id").alias("txn_id"),
        F.when(F.col("value") < 1, F.lit("NULL"))
         .otherwise(F.concat(F.lit("lot "), F.col("user_id").cast("string"))).alias("lot_name"),
        F.concat(F.lit("item "), (F.col("user_id") % 20).cast("string")).alias("item_name"),
        F.when(F.col("value") >= 5, "doll").otherwise("accessory").alias("item_type"),
        ttype.alias("txn_type"),
        F.col("value").alias("amount"),
        "ts",
    )


def daily_series(t: Tables) -> DataFrame:
    """``daily``: events per (event type, day): the epidemic series stand-in."""
    e = t("events", "ts", "event_type", "value")
    return (e.groupBy(F.col("event_type").alias("location"), F.to_date("ts").alias("date"))
             .agg(F.count(F.lit(1)).alias("cases"),
                  F.count_if(F.col("value") > 100).alias("deaths")))


# Population per location and continent: fixed values of the stand-in.
POPULATION = [("view", 5000), ("click", 4000), ("purchase", 2000), ("signup", 1000), ("error", 500)]
CONTINENT = {"view": "Engagement", "click": "Engagement", "purchase": "Commerce", "signup": "Commerce"}


def population(t: Tables) -> DataFrame:
    return constant_frame(t.spark, POPULATION, "location string, population int")


def covid_deaths(t: Tables) -> DataFrame:
    """CovidDeaths-shaped stand-in: totals as running sums, deaths as text."""
    d = daily_series(t)
    cont = F.lit(None).cast("string")
    for loc, c in CONTINENT.items():
        cont = F.when(F.col("location") == loc, c).otherwise(cont)
    # One row per (location, day): the running totals' window is bounded by the calendar.
    w = W.partitionBy("location").orderBy("date")
    return (d.join(F.broadcast(population(t)), "location")
             .select(cont.alias("continent"), "location", "date", "population",
                     F.sum("cases").over(w).cast("double").alias("total_cases"),
                     F.col("cases").cast("double").alias("new_cases"),
                     F.sum("deaths").over(w).cast("string").alias("total_deaths"),
                     F.col("deaths").cast("string").alias("new_deaths")))


def vaccinations(t: Tables) -> DataFrame:
    """``vac``: events of value under 10 per (location, day), counted as text; a day
    without any has the count 0."""
    e = t("events", "ts", "event_type", "value")
    return (e.groupBy(F.col("event_type").alias("location"), F.to_date("ts").alias("date"))
             .agg(F.count_if(F.col("value") < 10).cast("string").alias("new_vaccinations")))


def properties(t: Tables) -> DataFrame:
    """``prop``: orders as property sales; parcel = customer.  Some addresses and
    parcels are NULL, and every tenth order is entered twice (the second entry has
    the negative id), so rows repeat under the five dedupe keys."""
    o = t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
          "o_orderdate", "o_orderpriority")
    c = t("customer", "c_custkey", "c_name", "c_nationkey")
    n = t("nation", "n_nationkey", "n_name", "n_regionkey")
    r = t("region", "r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey)
    cust = c.join(geo, c.c_nationkey == geo.n_nationkey)
    street_city = F.concat_ws(", ", "c_name", "n_name")
    entries = F.when(F.col("o_orderkey") % 10 == 0, F.array(F.lit(1), F.lit(-1))).otherwise(F.array(F.lit(1)))
    return o.join(cust, o.o_custkey == cust.c_custkey).withColumn("entry", F.explode(entries)).select(
        (F.col("o_orderkey") * F.col("entry")).alias("UniqueID"),
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_custkey")).alias("ParcelID"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
         .otherwise(street_city).alias("PropertyAddress"),
        F.concat_ws(", ", "c_name", "n_name", "r_name").alias("OwnerAddress"),
        F.col("o_orderdate").alias("SaleDate"),
        F.col("o_totalprice").alias("SalePrice"),
        F.col("o_orderpriority").alias("LegalReference"),
        F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", "N")
         .otherwise("No").alias("SoldAsVacant"),
        F.col("n_name").alias("TaxDistrict"),
    )


def student_years(t: Tables) -> DataFrame:
    """``yr``: distinct (customer, order year)."""
    o = t("orders", "o_custkey", "o_orderdate")
    return o.select(F.col("o_custkey").alias("pidm"), F.year("o_orderdate").alias("yr")).distinct()


BUILDERS = {
    "o": orders_terms,
    "li": line_terms,
    "txn": ledger,
    "daily": daily_series,
    "covid": covid_deaths,
    "vac": vaccinations,
    "prop": properties,
    "yr": student_years,
}

# The same stand-ins as SQL text, for the DuckDB oracle.  (name, sql, deps)
_SEASON_SQL = ("CASE WHEN month({c}) <= 4 THEN '20' WHEN month({c}) <= 8 THEN '30' ELSE '40' END")

VIEW_SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    "o": ("""SELECT o_orderkey, o_custkey AS pidm, o_orderstatus, o_totalprice,
        CAST(o_orderdate AS DATE) AS order_date, o_orderpriority,
        CAST(year(o_orderdate) AS VARCHAR) || """ + _SEASON_SQL.format(c="o_orderdate") + """ AS term_code,
        c_mktsegment AS campus, c_nationkey,
        CASE WHEN o_orderstatus = 'F' THEN 'N' ELSE 'Y' END AS continuing_ind
      FROM orders JOIN customer ON o_custkey = c_custkey""", ()),
    "li": ("""SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey AS crn, l_quantity AS credits,
        l_extendedprice, l_discount, l_returnflag, CAST(l_shipdate AS DATE) AS ship_date,
        CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS budget_ind,
        pidm, term_code, campus, continuing_ind, order_date, o_orderstatus
      FROM lineitem JOIN o ON l_orderkey = o_orderkey""", ("o",)),
    "txn": ("""SELECT event_id AS txn_id,
        CASE WHEN value < 1 THEN 'NULL' ELSE 'lot ' || CAST(user_id AS VARCHAR) END AS lot_name,
        'item ' || CAST(user_id % 20 AS VARCHAR) AS item_name,
        CASE WHEN value >= 5 THEN 'doll' ELSE 'accessory' END AS item_type,
        CASE event_type WHEN 'purchase' THEN 'revenue' WHEN 'view' THEN 'purchase'
          WHEN 'error' THEN 'fee' WHEN 'click' THEN 'shipseller' WHEN 'signup' THEN 'shipbuyer' END AS txn_type,
        value AS amount, ts
      FROM events""", ()),
    "daily": ("""SELECT event_type AS location, CAST(ts AS DATE) AS date,
        count(*) AS cases, count_if(value > 100) AS deaths
      FROM events GROUP BY 1, 2""", ()),
    "pop": ("SELECT * FROM (VALUES " + ", ".join(f"('{l}', {p})" for l, p in POPULATION)
            + ") AS p(location, population)", ()),
    "covid": ("""SELECT CASE location WHEN 'view' THEN 'Engagement' WHEN 'click' THEN 'Engagement'
          WHEN 'purchase' THEN 'Commerce' WHEN 'signup' THEN 'Commerce' END AS continent,
        location, date, CAST(population AS INTEGER) AS population,
        CAST(sum(cases) OVER (PARTITION BY location ORDER BY date) AS DOUBLE) AS total_cases,
        CAST(cases AS DOUBLE) AS new_cases,
        CAST(sum(deaths) OVER (PARTITION BY location ORDER BY date) AS VARCHAR) AS total_deaths,
        CAST(deaths AS VARCHAR) AS new_deaths
      FROM daily JOIN pop USING (location)""", ("daily", "pop")),
    "vac": ("""SELECT event_type AS location, CAST(ts AS DATE) AS date,
        CAST(count(*) FILTER (WHERE value < 10) AS VARCHAR) AS new_vaccinations
      FROM events GROUP BY 1, 2""", ()),
    "prop": ("""SELECT o_orderkey * entry AS UniqueID, CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END AS ParcelID,
        CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE c_name || ', ' || n_name END AS PropertyAddress,
        c_name || ', ' || n_name || ', ' || r_name AS OwnerAddress,
        o_orderdate AS SaleDate, o_totalprice AS SalePrice, o_orderpriority AS LegalReference,
        CASE WHEN o_orderstatus = 'F' THEN 'Y' WHEN o_orderstatus = 'O' THEN 'N' ELSE 'No' END AS SoldAsVacant,
        n_name AS TaxDistrict
      FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        JOIN (VALUES (1), (-1)) AS entries(entry) ON entry = 1 OR o_orderkey % 10 = 0""", ()),
    "yr": ("""SELECT DISTINCT o_custkey AS pidm, CAST(year(o_orderdate) AS INTEGER) AS yr
      FROM orders""", ()),
}


def with_views(body: str, *names: str, ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with a WITH clause holding the named stand-ins (and their
    dependencies, in order), followed by any extra ``(name, sql)`` CTEs."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEW_SQL[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({VIEW_SQL[n][0]})" for n in order]
    parts += [f"{n} AS ({s})" for n, s in (ctes or [])]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
