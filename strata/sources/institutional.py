"""Institutional stand-ins: terms, sections, enrollment facts, graduates, wages,
transfers, students and attendance, all derived from the provided tables.

Terms: every order falls in a term named year + season ('20' Jan-Apr, '30'
May-Aug, '40' Sep-Dec); an academic year runs Fall to Summer ('1995-96' holds
199540, 199620, 199630), so it ends in August, as in the reference.  Students
are customers, sections are parts, enrollments are orders and line items.
Each builder has a SQL twin in ``SQL`` for the DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources import staging
from strata.sources.snapshots import DailyTable
from strata.sources.tables import Tables
from strata.sources.tables import constant_frame, input_version, table_path

# Season suffix -> (label, first month): fixed values of the stand-in.
SEASONS = {"20": ("Spring", 1), "30": ("Summer", 5), "40": ("Fall", 9)}
REGISTRATION_LEAD_DAYS = 30
DROP_DEADLINE_DAYS = 14


def _by_season(suffix: Column, idx: int) -> Column:
    out = None
    for k, v in SEASONS.items():
        out = F.when(suffix == k, F.lit(v[idx])) if out is None else out.when(suffix == k, F.lit(v[idx]))
    return out


# Stand-in dimensions are derived from the facts (one scan of orders each), so
# they are built once per session and written to the shared checkpoint folder;
# every later reference reads the small written table instead of rescanning the
# fact.  Keyed by (application, state of the tables read, name, as-of): rows that
# are appended later are another state.
_BUILT: dict[tuple, DataFrame] = {}


def built_once(t: Tables, name: str, as_of: dt.date | None, build, reads: tuple[str, ...] = ("orders",),
               partition_by: Sequence[str] = ()) -> DataFrame:
    from strata.sources.sinks import materialise
    state = tuple(input_version(t.spark, table_path(t.sf_dir, r)) for r in reads)
    key = (t.spark.sparkContext.applicationId, state, name, as_of)
    df = _BUILT.get(key)
    if df is None or df.sparkSession is not t.spark:
        df = _BUILT[key] = materialise(build(), f"dim_{name}", partition_by=partition_by)
    return df


def dim_term(t: Tables, as_of: dt.date) -> DataFrame:
    return built_once(t, "term", as_of, lambda: _dim_term(t, as_of))


def _dim_term(t: Tables, as_of: dt.date) -> DataFrame:
    terms = staging.order_terms_light(t).select("term_code").distinct()
    y = F.substring("term_code", 1, 4).cast("int")
    sfx = F.expr("substr(term_code, 5)")
    start = F.make_date(y, _by_season(sfx, 1), F.lit(1))
    ay_start = F.when(sfx == "40", y).otherwise(y - 1)
    out = terms.select(
        F.col("term_code").cast("int").alias("dim_term_key"), "term_code",
        start.alias("term_start_date"),
        F.date_sub(F.add_months(start, 4), 1).alias("term_end_date"),
        _by_season(sfx, 0).alias("term_season"),
        F.concat(_by_season(sfx, 0), F.lit(" "), F.substring("term_code", 1, 4)).alias("term_name"),
        F.concat(ay_start.cast("string"), F.lit("-"),
                 F.lpad(((ay_start + 1) % 100).cast("string"), 2, "0")).alias("academic_year"),
    )
    out = out.withColumns({
        "registration_start_date": F.date_sub("term_start_date", REGISTRATION_LEAD_DAYS),
        "registration_drop_deadline": F.date_add("term_start_date", DROP_DEADLINE_DAYS),
        "current_term_ind": F.when(F.lit(as_of).between(F.col("term_start_date"), F.col("term_end_date")), "Y")
                             .otherwise("N"),
    })
    return out


def dim_section(t: Tables) -> DataFrame:
    p = t("part", "p_partkey", "p_type", "p_size", "p_brand")
    return p.select(
        F.col("p_partkey").alias("dim_section_key"),
        F.when(F.col("p_partkey") % 17 != 0, F.substring("p_type", 1, 3)).alias("campus_code"),   # some unknown
        F.col("p_type").alias("campus"),
        F.when(F.col("p_size") > 25, "Y").otherwise("N").alias("budget_related_ind"),
        F.when(F.col("p_size") > 40, F.col("p_brand")).alias("cross_list_group"),
        F.col("p_size").alias("students_enrolled_section"),
        (F.col("p_size") * 2).alias("students_enrolled_group"),
        F.lit(50).alias("max_enrollment_section"),
        F.lit(100).alias("max_enrollment_group"),
        F.greatest(F.col("p_size") - 45, F.lit(0)).alias("students_enrolled_waitlist"),
    )


def dim_course(t: Tables) -> DataFrame:
    return t("part", "p_partkey").select(F.col("p_partkey").alias("dim_course_key"))


def dim_student_term(t: Tables) -> DataFrame:
    o = t("orders", "o_orderkey", "o_orderstatus")
    return o.select(F.col("o_orderkey").alias("dim_student_term_key"),
                    F.when(F.col("o_orderstatus") == "F", "N").otherwise("Y").alias("continuing_student_ind"))


def fact_daily_enrollments(t: Tables, as_of: dt.date) -> DataFrame:
    li = t("lineitem", "l_orderkey", "l_partkey", "l_quantity")
    o = staging.order_terms_light(t).select("o_orderkey", "pidm", "order_date", "term_code")
    terms = dim_term(t, as_of).select("term_code", "registration_start_date")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(terms, "term_code")
    return j.select(
        "term_code",
        F.date_format("order_date", "yyyyMMdd").cast("int").alias("dim_date_key"),
        F.datediff("order_date", "registration_start_date").alias("days_since_reg_start"),
        "pidm",
        F.col("l_quantity").alias("credits_attempted"),
        F.col("l_partkey").alias("crn"),
        # order key of the line: the student-term record
        F.col("l_orderkey").alias("dim_student_term_key"),
        F.col("l_partkey").alias("dim_course_key"),
        F.col("term_code").cast("int").alias("dim_term_key"),
        F.col("l_partkey").alias("dim_section_key"),
    )


# One row a term and day with sections: what ``section_days`` keeps.
SECTION_DAYS = "term_code string, days_since_reg_start int, sections bigint, enrollments bigint"


def section_days(t: Tables, as_of: dt.date, path: str | None = None) -> DataFrame:
    """The section snapshot by day (``SECTION_DAYS``), kept as an incremental table: the
    enrollments are read for new days and days whose orders have changed, or for
    all if line items have.  Without ``path`` the table goes with the application."""
    from strata.session import application_folder
    state = zlib.crc32(repr(input_version(t.spark, table_path(t.sf_dir, "lineitem"))).encode())
    where = path or f"{application_folder(t.spark, 'tables')}/section_days-{zlib.crc32(t.sf_dir.encode()):08x}"
    table = DailyTable(t.spark, where, StructType.fromDDL(SECTION_DAYS), "term_code")
    o = staging.order_terms_light(t).select("o_orderkey", "order_date", "term_code").filter(F.col("order_date").isNotNull())
    marks = o.groupBy(F.col("order_date").alias("day")).agg(
        F.concat_ws(":", F.count(F.lit(1)), F.sum(F.xxhash64("o_orderkey", "term_code") % (1 << 31)), F.lit(state)).alias("mark"))

    def rows_of(days: list[dt.date]) -> DataFrame:
        cut = F.col("order_date").between(F.lit(days[0]), F.lit(days[-1])) if days else F.lit(False)
        chosen = o.filter(cut)  # reaches the scan
        if len(days) <= 366:
            chosen = chosen.filter(F.col("order_date").isin(days))
        li = t("lineitem", "l_orderkey", "l_partkey")
        terms = dim_term(t, as_of).select("term_code", "registration_start_date")
        j = chosen.join(li, chosen.o_orderkey == li.l_orderkey).join(terms, "term_code")
        since = F.datediff("order_date", "registration_start_date").alias("days_since_reg_start")
        return j.groupBy("term_code", F.col("order_date").alias("day"), since).agg(
            F.count_distinct("l_partkey").alias("sections"), F.count(F.lit(1)).alias("enrollments"))

    table.refresh(marks, rows_of)
    return table.read()


def registration_days(t: Tables, as_of: dt.date) -> DataFrame:
    """(term_code, days_since_reg_start) of every day with an enrollment in a section."""
    return section_days(t, as_of).select("term_code", "days_since_reg_start")


def _season_sql(c: str, idx: int) -> str:
    return "CASE " + " ".join(f"WHEN {c} = '{k}' THEN {repr(v[idx]) if idx == 0 else v[idx]}"
                              for k, v in SEASONS.items()) + " END"


def sql_views(as_of: dt.date) -> list[tuple[str, str]]:
    """CTEs (name, sql) for the enrollment stand-ins; needs the ``o`` and ``li`` views."""
    a = as_of.isoformat()
    sfx = "substr(term_code, 5)"
    y = "CAST(substr(term_code, 1, 4) AS INTEGER)"
    ay = f"CASE WHEN {sfx} = '40' THEN {y} ELSE {y} - 1 END"
    return [
        ("dt0", f"""SELECT CAST(term_code AS INTEGER) AS dim_term_key, term_code,
            make_date({y}, {_season_sql(sfx, 1)}, 1) AS term_start_date,
            {_season_sql(sfx, 0)} AS term_season,
            {_season_sql(sfx, 0)} || ' ' || substr(term_code, 1, 4) AS term_name,
            CAST({ay} AS VARCHAR) || '-' || lpad(CAST(({ay} + 1) % 100 AS VARCHAR), 2, '0') AS academic_year
          FROM (SELECT DISTINCT term_code FROM o) x"""),
        ("dim_term", f"""SELECT *, CAST(term_start_date + INTERVAL 4 MONTH - INTERVAL 1 DAY AS DATE) AS term_end_date,
            CAST(term_start_date - INTERVAL {REGISTRATION_LEAD_DAYS} DAY AS DATE) AS registration_start_date,
            CAST(term_start_date + INTERVAL {DROP_DEADLINE_DAYS} DAY AS DATE) AS registration_drop_deadline,
            CASE WHEN DATE '{a}' BETWEEN term_start_date
                 AND CAST(term_start_date + INTERVAL 4 MONTH - INTERVAL 1 DAY AS DATE) THEN 'Y' ELSE 'N' END AS current_term_ind
          FROM dt0"""),
        ("dim_section", """SELECT p_partkey AS dim_section_key, CASE WHEN p_partkey % 17 <> 0 THEN substr(p_type, 1, 3) END AS campus_code,
            p_type AS campus,
            CASE WHEN p_size > 25 THEN 'Y' ELSE 'N' END AS budget_related_ind,
            CASE WHEN p_size > 40 THEN p_brand END AS cross_list_group,
            p_size AS students_enrolled_section, p_size * 2 AS students_enrolled_group,
            50 AS max_enrollment_section, 100 AS max_enrollment_group,
            greatest(p_size - 45, 0) AS students_enrolled_waitlist FROM part"""),
        ("dim_course", "SELECT p_partkey AS dim_course_key FROM part"),
        ("dim_student_term", "SELECT o_orderkey AS dim_student_term_key, continuing_ind AS continuing_student_ind FROM o"),
        ("fde", """SELECT li.term_code, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS dim_date_key,
            CAST(datediff('day', registration_start_date, order_date) AS INTEGER) AS days_since_reg_start,
            pidm, credits AS credits_attempted, crn, l_orderkey AS dim_student_term_key, crn AS dim_course_key,
            CAST(li.term_code AS INTEGER) AS dim_term_key, crn AS dim_section_key
          FROM li JOIN dim_term ON li.term_code = dim_term.term_code"""),
    ]


# --------------------------------------------------------------------------- attendance stand-ins
# Students are customers, classes are orders, terms are half-years of a
# calendar school year, programs are nations.  Status and class numbers are
# read off the order.  Status table: fixed values (key, deleted, enrolled).
ATT_STATUS = [(1, "N", "Y"), (2, "N", "Y"), (3, "N", "N")]


def _att_orders(t: Tables) -> DataFrame:
    """Orders with their student's first year and nation and their term: the one pass
    over the raw tables, written once by term, so a reader that joins the terms of a
    few school years (or the current term) prunes to those."""
    return built_once(t, "att_orders", None, lambda: _build_att_orders(t), ("orders", "customer"), partition_by=["TERM_KEY"])


def _att_students(t: Tables) -> DataFrame:
    """(o_custkey, first_year): one row a student with an order."""
    def build() -> DataFrame:
        o = t("orders", "o_custkey", "o_orderdate")
        return o.groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("first_year"))
    return built_once(t, "att_students", None, build)


def _build_att_orders(t: Tables) -> DataFrame:
    o = t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    o = o.withColumn("y", F.year("o_orderdate"))
    f, c = _att_students(t).withColumnRenamed("o_custkey", "__k"), t("customer", "c_custkey", "c_nationkey")
    o = o.join(f, o.o_custkey.eqNullSafe(f["__k"]), "left").drop("__k")
    o = o.join(c, o.o_custkey == c.c_custkey, "left").drop("c_custkey")
    return o.withColumn("TERM_KEY", F.col("y") * 10 + F.when(F.month("o_orderdate") <= 6, 1).otherwise(2))


def _att_values(t: Tables) -> DataFrame:
    """The values of all small dimensions, one row of sets from one aggregate over the
    written pass; each set is bounded by the calendar or by the priorities."""
    def build() -> DataFrame:
        o = _att_orders(t)
        known = F.col("c_nationkey").isNotNull()
        return o.agg(F.collect_set(F.when(known, F.col("y") - F.col("first_year") + 1)).alias("student_types"),
                     F.collect_set("TERM_KEY").alias("terms"),
                     F.collect_set(F.substring("o_orderpriority", 1, 1).cast("bigint")).alias("employees"))
    return built_once(t, "att_values", None, build, ("orders", "customer"))


def att_fact(t: Tables) -> DataFrame:
    o = _att_orders(t).where("c_nationkey IS NOT NULL")
    absent = F.floor(F.col("o_totalprice") / 100000).cast("int")
    return o.select(
        F.col("o_custkey").alias("STUDENT_KEY"),
        F.col("o_orderkey").alias("CLASS_KEY"),
        "TERM_KEY",
        F.col("c_nationkey").cast("bigint").alias("PROGRAM_KEY"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3).alias("STATUS_KEY"),
        (F.col("y") - F.col("first_year") + 1).alias("BUSINESS_STUDENT_TYPE_KEY"),
        absent.alias("ABSENT_COUNT"),
        F.lit(1).alias("FIRST_ATTENDED_CLASS_COUNT"),
        (10 - absent).alias("ATTENDED_COUNT"),
        (10 - absent).alias("PHYSICALLY_PRESENT_COUNT"),
        F.when(10 - absent >= 8, 1).otherwise(0).alias("RECEIVED_CREDIT_COUNT"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("DROPPED_COUNT"),
    )


def att_student(t: Tables) -> DataFrame:
    o = _att_students(t)
    c = t("customer", "c_custkey", "c_acctbal", "c_nationkey")
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    return j.select(F.col("c_custkey").alias("STUDENT_KEY"),
                    F.when(F.col("c_acctbal") >= 0, "F").otherwise("M").alias("GENDER"),
                    F.when(F.col("c_nationkey") < 10, "English").otherwise("Spanish").alias("PRIMARY_LANGUAGE"),
                    (F.col("first_year") + 4).alias("SEMINARY_GRADUATION_YEAR"))


def att_student_type(t: Tables) -> DataFrame:
    k = _att_values(t).select(F.explode("student_types").alias("STUDENT_TYPE_KEY"))
    return k.select("STUDENT_TYPE_KEY", F.col("STUDENT_TYPE_KEY").alias("YEAR_IN_SEMINARY"),
                    (F.col("STUDENT_TYPE_KEY") + 13).alias("AGE_IN_YEARS"),
                    F.when(F.col("STUDENT_TYPE_KEY") <= 3, "Y").otherwise("N").alias("MEMBERSHIP_YN_FLAG"))


def att_class(t: Tables) -> DataFrame:
    o = _att_orders(t)
    return o.select(F.col("o_orderkey").alias("CLASS_KEY"),
                    F.substring("o_orderpriority", 1, 1).cast("bigint").alias("INSTRUCTOR_EMPLOYEE_ID"),
                    F.col("o_orderpriority").alias("COURSE_TITLE"),
                    F.when(F.col("o_orderstatus") == "F", "Morning").when(F.col("o_orderstatus") == "O", "Released")
                     .otherwise("Evening").alias("TIME_OF_DAY_DESCRIPTION"),
                    F.lit(10).alias("CLASS_SESSION_COUNT"))


def att_term(t: Tables, as_of: dt.date) -> DataFrame:
    k = _att_values(t).select(F.explode("terms").alias("TERM_KEY"))
    y = (F.col("TERM_KEY") / 10).cast("int")
    current = as_of.year * 10 + (1 if as_of.month <= 6 else 2)
    yy = lambda c: F.lpad((c % 100).cast("string"), 2, "0")
    return k.select("TERM_KEY", (F.col("TERM_KEY") % 10).cast("int").alias("TERM_NUMBER"),
                    F.concat(y.cast("string"), F.lit(" ("), yy(y), F.lit("-"), yy(y + 1), F.lit(")"))
                     .alias("SCHOOL_YEAR_NAME"),
                    F.when(F.col("TERM_KEY") == current, "Y").otherwise("N").alias("CURRENT_TERM_YN_FLAG"))


def att_program(t: Tables) -> DataFrame:
    n = t("nation", "n_nationkey", "n_name", "n_regionkey")
    r = t("region", "r_regionkey", "r_name")
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    return j.select(
        F.col("n_nationkey").cast("bigint").alias("PROGRAM_KEY"),
        F.when(F.col("n_regionkey") == 1, F.concat("n_name", F.lit(" Release Time")))
         .otherwise(F.concat("n_name", F.lit(" Seminary"))).alias("PROGRAM_NAME"),
        F.when(F.col("n_regionkey") == 4, "INS").otherwise("SEM").alias("PROGRAM_TYPE_GROUP_CODE"),
        F.col("n_name").alias("POLITICAL_PLACE_NAME"),
        F.when(F.col("r_name") == "EUROPE", "Elsewhere").otherwise("United States").alias("POLITICAL_PLACE_COUNTRY"),
        F.col("r_name").alias("POLITICAL_PLACE_CONTINENT"))


def att_status(t: Tables) -> DataFrame:
    return constant_frame(t.spark, ATT_STATUS, "STATUS_KEY int, DELETED_YN_FLAG string, ENROLLED_YN_FLAG string")


def att_employee(t: Tables) -> DataFrame:
    ids = _att_values(t).select(F.explode("employees").alias("EMPLOYEE_ID"))
    return ids.select("EMPLOYEE_ID", F.when(F.col("EMPLOYEE_ID") <= 2, "F").otherwise("M").alias("GENDER"),
                      F.make_date((1950 + F.col("EMPLOYEE_ID") * 5).cast("int"), F.lit(1), F.lit(1)).alias("BIRTH_DATE"))


def att_term_fact(t: Tables) -> DataFrame:
    return att_fact(t).select("STUDENT_KEY", "TERM_KEY", "STATUS_KEY", "BUSINESS_STUDENT_TYPE_KEY",
                              "PROGRAM_KEY").distinct()


def attendance_sources(t: Tables, as_of: dt.date) -> dict[str, DataFrame]:
    """The attendance star: fact and dimensions over the one written pass."""
    return {
        "fact": att_fact(t), "student": att_student(t), "student_type": att_student_type(t),
        "class_": att_class(t), "term": att_term(t, as_of), "program": att_program(t),
        "status": att_status(t), "employee": att_employee(t), "term_fact": att_term_fact(t),
    }


def attendance_sql(as_of: dt.date) -> list[tuple[str, str]]:
    current = as_of.year * 10 + (1 if as_of.month <= 6 else 2)
    status = " UNION ALL ".join(f"SELECT {k} AS STATUS_KEY, '{d}' AS DELETED_YN_FLAG, '{e}' AS ENROLLED_YN_FLAG"
                                for k, d, e in ATT_STATUS)
    yy = "lpad(CAST(({c}) % 100 AS VARCHAR), 2, '0')"
    return [
        ("ao", """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS y,
            CAST(min(year(o_orderdate)) OVER (PARTITION BY o_custkey) AS INTEGER) AS first_year FROM orders"""),
        ("att_fact", """SELECT o_custkey AS STUDENT_KEY, o_orderkey AS CLASS_KEY,
            y * 10 + CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS TERM_KEY,
            CAST(c_nationkey AS BIGINT) AS PROGRAM_KEY,
            CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2 ELSE 3 END AS STATUS_KEY,
            y - first_year + 1 AS BUSINESS_STUDENT_TYPE_KEY,
            CAST(floor(o_totalprice / 100000) AS INTEGER) AS ABSENT_COUNT,
            1 AS FIRST_ATTENDED_CLASS_COUNT,
            10 - CAST(floor(o_totalprice / 100000) AS INTEGER) AS ATTENDED_COUNT,
            10 - CAST(floor(o_totalprice / 100000) AS INTEGER) AS PHYSICALLY_PRESENT_COUNT,
            CASE WHEN 10 - CAST(floor(o_totalprice / 100000) AS INTEGER) >= 8 THEN 1 ELSE 0 END AS RECEIVED_CREDIT_COUNT,
            CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS DROPPED_COUNT
          FROM ao JOIN customer ON o_custkey = c_custkey"""),
        ("att_student", """SELECT c_custkey AS STUDENT_KEY, CASE WHEN c_acctbal >= 0 THEN 'F' ELSE 'M' END AS GENDER,
            CASE WHEN c_nationkey < 10 THEN 'English' ELSE 'Spanish' END AS PRIMARY_LANGUAGE,
            f.first_year + 4 AS SEMINARY_GRADUATION_YEAR
          FROM customer LEFT JOIN (SELECT DISTINCT o_custkey, first_year FROM ao) f ON c_custkey = f.o_custkey"""),
        ("att_student_type", """SELECT k AS STUDENT_TYPE_KEY, k AS YEAR_IN_SEMINARY, k + 13 AS AGE_IN_YEARS,
            CASE WHEN k <= 3 THEN 'Y' ELSE 'N' END AS MEMBERSHIP_YN_FLAG
          FROM (SELECT DISTINCT BUSINESS_STUDENT_TYPE_KEY AS k FROM att_fact) x"""),
        ("att_class", """SELECT o_orderkey AS CLASS_KEY, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS INSTRUCTOR_EMPLOYEE_ID,
            o_orderpriority AS COURSE_TITLE,
            CASE WHEN o_orderstatus = 'F' THEN 'Morning' WHEN o_orderstatus = 'O' THEN 'Released' ELSE 'Evening' END
              AS TIME_OF_DAY_DESCRIPTION, 10 AS CLASS_SESSION_COUNT FROM orders"""),
        ("att_term", f"""SELECT TERM_KEY, CAST(TERM_KEY % 10 AS INTEGER) AS TERM_NUMBER,
            CAST(TERM_KEY // 10 AS VARCHAR) || ' (' || {yy.format(c='TERM_KEY // 10')} || '-'
              || {yy.format(c='TERM_KEY // 10 + 1')} || ')' AS SCHOOL_YEAR_NAME,
            CASE WHEN TERM_KEY = {current} THEN 'Y' ELSE 'N' END AS CURRENT_TERM_YN_FLAG
          FROM (SELECT DISTINCT TERM_KEY FROM att_fact) x"""),
        ("att_program", """SELECT CAST(n_nationkey AS BIGINT) AS PROGRAM_KEY,
            CASE WHEN n_regionkey = 1 THEN n_name || ' Release Time' ELSE n_name || ' Seminary' END AS PROGRAM_NAME,
            CASE WHEN n_regionkey = 4 THEN 'INS' ELSE 'SEM' END AS PROGRAM_TYPE_GROUP_CODE,
            n_name AS POLITICAL_PLACE_NAME,
            CASE WHEN r_name = 'EUROPE' THEN 'Elsewhere' ELSE 'United States' END AS POLITICAL_PLACE_COUNTRY,
            r_name AS POLITICAL_PLACE_CONTINENT
          FROM nation JOIN region ON n_regionkey = r_regionkey"""),
        ("att_status", status),
        ("att_employee", """SELECT EMPLOYEE_ID, CASE WHEN EMPLOYEE_ID <= 2 THEN 'F' ELSE 'M' END AS GENDER,
            make_date(CAST(1950 + EMPLOYEE_ID * 5 AS INTEGER), 1, 1) AS BIRTH_DATE
          FROM (SELECT DISTINCT INSTRUCTOR_EMPLOYEE_ID AS EMPLOYEE_ID FROM att_class) x"""),
        ("att_term_fact", """SELECT DISTINCT STUDENT_KEY, TERM_KEY, STATUS_KEY, BUSINESS_STUDENT_TYPE_KEY, PROGRAM_KEY
          FROM att_fact"""),
    ]


# --------------------------------------------------------------------------- program stand-ins
# Programs are order priorities (name 'priority:status', so the text before ':'
# is the program), degrees are order statuses, areas group priorities.
# Graduations are finished orders (graduated when the price passes 400000),
# wages are open orders, transfers out are pending orders.  Fixed values:
PROGRAM_AREAS = {"1": "Health", "2": "Health", "3": "Trades", "4": "General", "5": "General"}
DEGREES = {"F": "AS", "O": "AA", "P": "CER"}
INSTITUTIONS = [(2, "2-year"), (4, "4-year")]


# Degree of a second program entry: fixed value of the stand-in.
SECOND_DEGREE = "SECOND"


def _program_entries(t: Tables) -> DataFrame:
    """Orders as program entries: every 50th has a second one, and every 49th stands under
    a key that no enrollment or graduation refers to."""
    o = t("orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    k = F.col("o_orderkey")
    one, two = F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))
    o = o.withColumn("entry_key", F.when(k % 49 == 0, -k).otherwise(k))
    return o.withColumn("entry", F.explode(F.when(k % 50 == 0, two).otherwise(one)))


def _program_cols(prefix: str = "") -> list[Column]:
    digit = F.substring("o_orderpriority", 1, 1)
    area = None
    for k, v in PROGRAM_AREAS.items():
        area = F.when(digit == k, v) if area is None else area.when(digit == k, v)
    degree = None
    for k, v in DEGREES.items():
        degree = F.when(F.col("o_orderstatus") == k, v) if degree is None else degree.when(F.col("o_orderstatus") == k, v)
    return [area.alias(f"{prefix}area_of_study"),
            F.concat("o_orderpriority", F.lit(":"), "o_orderstatus").alias(f"{prefix}program_name"),
            F.when(F.col("entry") == 1, degree).otherwise(SECOND_DEGREE).alias(f"{prefix}degree_code"),
            F.concat(F.lit("CIP-"), digit).alias(f"{prefix}major_cip")]


def _orders_terms(t: Tables) -> DataFrame:
    return staging.orders_terms(t)


def course_history(t: Tables) -> DataFrame:
    o = staging.order_terms_light(t)
    return o.select("pidm", "term_code", F.col("term_code").cast("int").alias("dim_term_key"),
                    F.col("o_orderkey").alias("dim_student_term_key"),
                    F.floor(F.col("o_totalprice") / 100000).cast("double").alias("gpa_quality_points"),
                    F.when(F.col("o_orderstatus") == "F", 3.0).when(F.col("o_orderstatus") == "O", 4.0)
                     .otherwise(1.0).alias("gpa_credits"))


def pgm_student_term(t: Tables) -> DataFrame:
    o = t("orders", "o_orderkey")
    return o.select(F.col("o_orderkey").alias("dim_student_term_key"),
                    F.col("o_orderkey").alias("dim_pgm_of_study_term_key"))


def pgm_of_study_term(t: Tables) -> DataFrame:
    return _program_entries(t).select(F.col("entry_key").alias("dim_pgm_of_study_term_key"), *_program_cols("term_"))


def grad_outcomes(t: Tables) -> DataFrame:
    o = staging.order_terms_light(t).filter(F.col("o_orderstatus") == "F")
    return o.select("pidm", "term_code", F.col("order_date").alias("graduation_date"),
                    F.when(F.col("o_totalprice") > 400000, "Y").otherwise("N").alias("ug_ap_graduated_ind"),
                    F.when(F.col("o_totalprice").between(380000, 400000), "Y").otherwise("N").alias("sat_graduated_ind"),
                    F.col("pidm").alias("dim_student_key"),
                    F.col("term_code").cast("int").alias("dim_term_key"),
                    F.col("o_orderkey").alias("dim_program_of_study_key"),
                    F.floor(F.col("o_totalprice") / 100000).cast("double").alias("cum_institution_gpa"),
                    (60 + 15 * (F.col("o_orderkey") % 3)).cast("double").alias("cum_institution_credits"))


def program_of_study(t: Tables) -> DataFrame:
    return _program_entries(t).select(F.col("entry_key").alias("dim_program_of_study_key"), *_program_cols())


def student_wages(t: Tables) -> DataFrame:
    o = t("orders", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return (o.filter(F.col("o_orderstatus") == "O")
             .select(F.col("o_custkey").alias("pidm"),
                     F.concat(F.year("o_orderdate").cast("string"), F.lit("Q"),
                              F.quarter("o_orderdate").cast("string")).alias("quarter"),
                     F.floor(F.col("o_totalprice") / 10).cast("double").alias("wages")))


def nsc_enrollments(t: Tables) -> DataFrame:
    o = _orders_terms(t).filter(F.col("o_orderstatus") == "P")
    return o.select("pidm", F.col("order_date").alias("enrollment_begin_date"),
                    F.concat(F.lit("0052"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("opeid"),
                    F.when(F.col("o_totalprice") > 200000, 4).otherwise(2).alias("dim_institution_key"))


def institutions(t: Tables) -> DataFrame:
    return constant_frame(t.spark, INSTITUTIONS, "dim_institution_key int, institution_level string")


def dim_student(t: Tables) -> DataFrame:
    return built_once(t, "student", None, lambda: _dim_student(t))


def _dim_student(t: Tables) -> DataFrame:
    o = staging.order_terms_light(t).groupBy("pidm").agg(F.min("term_code").alias("first_term_non_concurrent"))
    c = t("customer", "c_custkey", "c_mktsegment", "c_nationkey")
    geo = t("nation", "n_nationkey", "n_regionkey").join(t("region", "r_regionkey", "r_name"),
                                                         F.col("n_regionkey") == F.col("r_regionkey"))
    c = c.join(geo, c.c_nationkey == geo.n_nationkey)
    c = c.join(o, c.c_custkey == o.pidm, "left")
    k = F.col("c_nationkey")
    return c.select(F.col("c_custkey").alias("dim_student_key"), F.col("c_custkey").alias("pidm"),
                    "first_term_non_concurrent", F.col("c_mktsegment").alias("gender"), F.col("r_name").alias("race"),
                    F.when(k < 8, "Y").when(k < 20, "N").otherwise("X").alias("hispanic_ind"),
                    F.when(k < 6, "Y").when(k < 14, "N").when(k < 22, "U").otherwise("X").alias("first_generation_ind"))


def program_sources(t: Tables, as_of: dt.date) -> dict[str, DataFrame]:
    return {
        "dim_term": dim_term(t, as_of), "course_history": course_history(t), "student_term": pgm_student_term(t),
        "pgm_term": pgm_of_study_term(t), "grads": grad_outcomes(t), "program_of_study": program_of_study(t),
        "wages": student_wages(t), "nsc": nsc_enrollments(t), "institutions": institutions(t),
        "dim_student": dim_student(t),
    }


def _program_cols_sql(prefix: str = "") -> str:
    digit = "substr(o_orderpriority, 1, 1)"
    area = "CASE " + " ".join(f"WHEN {digit} = '{k}' THEN '{v}'" for k, v in PROGRAM_AREAS.items()) + " END"
    degree = "CASE " + " ".join(f"WHEN o_orderstatus = '{k}' THEN '{v}'" for k, v in DEGREES.items()) + " END"
    return (f"{area} AS {prefix}area_of_study, o_orderpriority || ':' || o_orderstatus AS {prefix}program_name, "
            f"CASE WHEN entry = 1 THEN {degree} ELSE '{SECOND_DEGREE}' END AS {prefix}degree_code, 'CIP-' || {digit} AS {prefix}major_cip")


def program_sql(as_of: dt.date) -> list[tuple[str, str]]:
    """CTEs for the program stand-ins (needs the ``o`` view and ``sql_views``)."""
    inst = " UNION ALL ".join(f"SELECT {k} AS dim_institution_key, '{v}' AS institution_level" for k, v in INSTITUTIONS)
    entries = "orders JOIN (VALUES (1), (2)) AS e(entry) ON entry = 1 OR o_orderkey % 50 = 0"
    key = "CASE WHEN o_orderkey % 49 = 0 THEN -o_orderkey ELSE o_orderkey END"
    return [
        ("fsch", """SELECT pidm, term_code, CAST(term_code AS INTEGER) AS dim_term_key, o_orderkey AS dim_student_term_key,
            CAST(floor(o_totalprice / 100000) AS DOUBLE) AS gpa_quality_points,
            CASE WHEN o_orderstatus = 'F' THEN 3.0 WHEN o_orderstatus = 'O' THEN 4.0 ELSE 1.0 END::DOUBLE AS gpa_credits
          FROM o"""),
        ("pst", "SELECT o_orderkey AS dim_student_term_key, o_orderkey AS dim_pgm_of_study_term_key FROM orders"),
        ("dpost", f"SELECT {key} AS dim_pgm_of_study_term_key, {_program_cols_sql('term_')} FROM {entries}"),
        ("fsgo", """SELECT pidm, term_code, order_date AS graduation_date,
            CASE WHEN o_totalprice > 400000 THEN 'Y' ELSE 'N' END AS ug_ap_graduated_ind, 
            CASE WHEN o_totalprice BETWEEN 380000 AND 400000 THEN 'Y' ELSE 'N' END AS sat_graduated_ind,
            pidm AS dim_student_key, CAST(term_code AS INTEGER) AS dim_term_key, o_orderkey AS dim_program_of_study_key,
            CAST(floor(o_totalprice / 100000) AS DOUBLE) AS cum_institution_gpa, (60 + 15 * (o_orderkey % 3))::DOUBLE AS cum_institution_credits
          FROM o WHERE o_orderstatus = 'F'"""),
        ("dpos", f"SELECT {key} AS dim_program_of_study_key, {_program_cols_sql()} FROM {entries}"),
        ("fsw", """SELECT o_custkey AS pidm, CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
            CAST(floor(o_totalprice / 10) AS DOUBLE) AS wages FROM orders WHERE o_orderstatus = 'O'"""),
        ("fne", """SELECT pidm, order_date AS enrollment_begin_date, '0052' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS opeid,
            CASE WHEN o_totalprice > 200000 THEN 4 ELSE 2 END AS dim_institution_key FROM o WHERE o_orderstatus = 'P'"""),
        ("di", inst),
        ("ds", """SELECT c_custkey AS dim_student_key, c_custkey AS pidm, f.first_term_non_concurrent,
            c_mktsegment AS gender, r_name AS race,
            CASE WHEN c_nationkey < 8 THEN 'Y' WHEN c_nationkey < 20 THEN 'N' ELSE 'X' END AS hispanic_ind,
            CASE WHEN c_nationkey < 6 THEN 'Y' WHEN c_nationkey < 14 THEN 'N' WHEN c_nationkey < 22 THEN 'U' ELSE 'X' END
              AS first_generation_ind
          FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
            LEFT JOIN (SELECT pidm, min(term_code) AS first_term_non_concurrent FROM o GROUP BY pidm) f
              ON c_custkey = f.pidm"""),
    ]
