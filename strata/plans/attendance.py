"""Attendance and dropout job.

``attendance_base`` is the star join of the class-attendance fact with seven
dimensions, the cohort rule and a per-term registration number;
``currently_enrolled`` is the set of students enrolled in the current term;
``dropout_labels`` flags students of the base who are not currently enrolled
and the point at which they left; ``dropout_rate`` is the share of dropped
students by any attribute.

Skew: a student's rows are not assumed small.  Per-term and per-student
totals come from one grouped aggregate joined back; the registration number uses the
range-split row number; the dropout flag is a hash join on distinct keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.dates import year_diff
from strata.functions.numeric import percent
from strata.operators.joins import join_small, membership_flag, null_safe_on
from strata.operators.windows import row_number_by
from strata.sources.sinks import materialise
from strata.sources.tables import constant_frame

# Point of dropout by (highest year in program, highest term number in the
# school year): fixed labels of the reference; any other pair is 'None'.
DROPOUT_POINTS = {
    (1, 1): "Mid-Freshman", (1, 2): "Post-Freshman",
    (2, 1): "Mid-Sophomore", (2, 2): "Post-Sophomore",
    (3, 1): "Mid-Junior", (3, 2): "Post-Junior",
    (4, 1): "Mid-Senior",
}
# Year in program as a label (the reference's notes for the dashboard).
YEAR_LABELS = {1: "Freshman", 2: "Sophomore", 3: "Junior", 4: "Senior"}


def cohort_rules(spark, rules: Sequence[tuple[str, int, int]]) -> DataFrame:
    """Rule matrix: (school year name, lowest year in program, highest)."""
    return constant_frame(spark, list(rules), "rule_year string, lo int, hi int")


def attendance_base(src: Mapping[str, DataFrame], rules: Sequence[tuple[str, int, int]],
                    school_years: tuple[str, str], country: str | None, min_grad_year: int,
                    as_of: dt.date, program_type: str = "SEM", numbered: bool = True) -> DataFrame:
    """``numbered=False`` leaves out ``rownumber`` (and the window behind it) for
    callers that do not keep it."""
    f = src["fact"]
    s = src["student"].select("STUDENT_KEY", F.col("GENDER").alias("Student_Gender"), "PRIMARY_LANGUAGE",
                              "SEMINARY_GRADUATION_YEAR")
    st = src["student_type"].select(F.col("STUDENT_TYPE_KEY").alias("BUSINESS_STUDENT_TYPE_KEY"),
                                    "MEMBERSHIP_YN_FLAG", F.col("AGE_IN_YEARS").alias("Student_Age"),
                                    "YEAR_IN_SEMINARY")
    c = src["class_"]
    t = src["term"].select("TERM_KEY", "TERM_NUMBER", "SCHOOL_YEAR_NAME")
    p = src["program"]
    x = src["status"].filter((F.col("DELETED_YN_FLAG") == "N") & (F.col("ENROLLED_YN_FLAG") == "Y")) \
                     .select("STATUS_KEY")
    e = src["employee"].select(F.col("EMPLOYEE_ID").alias("INSTRUCTOR_EMPLOYEE_ID"),
                               F.col("GENDER").alias("Teacher_Gender"), "BIRTH_DATE")
    # Dimension filters go on the dimensions, before the joins.
    p = p.filter(F.col("PROGRAM_TYPE_GROUP_CODE") == program_type)
    if country is not None:
        p = p.filter(F.col("POLITICAL_PLACE_COUNTRY") == country)
    t = t.filter(F.col("SCHOOL_YEAR_NAME").between(*school_years))
    s = s.filter(F.col("SEMINARY_GRADUATION_YEAR") >= min_grad_year)

    j = join_small(f, x, "STATUS_KEY")
    j = join_small(j, t, "TERM_KEY")
    j = join_small(j, p, "PROGRAM_KEY")
    j = join_small(j, st, "BUSINESS_STUDENT_TYPE_KEY")
    j = j.join(s, "STUDENT_KEY")
    j = j.join(join_small(c, e, "INSTRUCTOR_EMPLOYEE_ID"), "CLASS_KEY")

    # The cohort rule matrix is a handful of fixed rows: broadcast by construction.
    r = F.broadcast(cohort_rules(f.sparkSession, rules))
    j = j.join(r, (F.col("SCHOOL_YEAR_NAME") == r.rule_year)
               & F.col("YEAR_IN_SEMINARY").between(r.lo, r.hi), "left")
    j = j.withColumns({
        "Relevant_YN_Flag": F.when(F.col("rule_year").isNotNull(), "Y").otherwise("N"),
        "Teacher_Age": year_diff(as_of, F.col("BIRTH_DATE")),
        "Released_Time_YN_Flag": F.when(F.col("PROGRAM_NAME").ilike("%release%"), "Y").otherwise("N"),
    })
    # Registered classes in the term: numbered before the cohort filter (H31),
    # class key as the tie-breaker.
    # Hot (student, term) groups are found on the raw fact: its groups contain
    # the joined ones, and counting it avoids running the star join twice.
    if numbered:
        j = row_number_by(j, ["STUDENT_KEY", "TERM_KEY"], ["CLASS_KEY"], name="rownumber",
                          sizes_from=f.select("STUDENT_KEY", "TERM_KEY"))
    return j.select(
        "STUDENT_KEY", "Student_Gender", "MEMBERSHIP_YN_FLAG", "Student_Age", "PRIMARY_LANGUAGE",
        "YEAR_IN_SEMINARY", "SEMINARY_GRADUATION_YEAR", "CLASS_KEY", "COURSE_TITLE", "TIME_OF_DAY_DESCRIPTION",
        "Teacher_Gender", "Teacher_Age", "TERM_KEY", "TERM_NUMBER", "SCHOOL_YEAR_NAME", "PROGRAM_NAME",
        "Released_Time_YN_Flag",
        F.col("POLITICAL_PLACE_NAME").alias("State"),
        F.col("POLITICAL_PLACE_COUNTRY").alias("Country"),
        F.col("POLITICAL_PLACE_CONTINENT").alias("Continent"),
        "ABSENT_COUNT", "CLASS_SESSION_COUNT", "FIRST_ATTENDED_CLASS_COUNT", "ATTENDED_COUNT",
        "PHYSICALLY_PRESENT_COUNT", "RECEIVED_CREDIT_COUNT", "DROPPED_COUNT", *(["rownumber"] if numbered else []),
        "Relevant_YN_Flag")


def currently_enrolled(src: Mapping[str, DataFrame], country: str | None) -> DataFrame:
    """Distinct students enrolled in the current term (the reference lists a
    student once per program and status row; distinct keys avoid multiplying
    rows later, H30)."""
    f = src["term_fact"]
    t = src["term"].filter(F.col("CURRENT_TERM_YN_FLAG") == "Y").select("TERM_KEY")
    x = src["status"].filter((F.col("DELETED_YN_FLAG") == "N") & (F.col("ENROLLED_YN_FLAG") == "Y")) \
                     .select("STATUS_KEY")
    st = src["student_type"].select(F.col("STUDENT_TYPE_KEY").alias("BUSINESS_STUDENT_TYPE_KEY"))
    p = src["program"]
    if country is not None:
        p = p.filter(F.col("POLITICAL_PLACE_COUNTRY") == country)
    j = join_small(f, t, "TERM_KEY")
    j = join_small(j, x, "STATUS_KEY")
    j = join_small(j, st, "BUSINESS_STUDENT_TYPE_KEY")
    j = join_small(j, p.select("PROGRAM_KEY"), "PROGRAM_KEY")
    return j.select("STUDENT_KEY").filter(F.col("STUDENT_KEY").isNotNull()).distinct()


def dropout_labels(base: DataFrame, enrolled: DataFrame) -> DataFrame:
    """Relevant rows with per-term totals, the dropout flag and the point of
    dropout (for dropped students only)."""
    # The relevant rows feed the totals and the flag join: written once as parquet (so
    # each reader prunes columns) instead of recomputing the star join for each.
    rel = materialise(base.filter(F.col("Relevant_YN_Flag") == "Y"), "relevant_rows")
    # One aggregate for all totals, a row per (student, school year, term): map-side
    # combined, so a student's rows are now bounded by its terms and the windows over
    # them fit a task.  One join brings them back.
    keys = ["STUDENT_KEY", "SCHOOL_YEAR_NAME", "TERM_KEY"]
    t = rel.groupBy(*keys).agg(F.sum("ABSENT_COUNT").alias("__absent"), F.sum("ATTENDED_COUNT").alias("__attended"),
                               F.max("YEAR_IN_SEMINARY").alias("__year"), F.max("TERM_NUMBER").alias("__number"))
    over = lambda *by: Window.partitionBy(*by)
    t = t.repartition("STUDENT_KEY").select(
        *[F.col(k).alias(f"__t{i}") for i, k in enumerate(keys)],
        F.sum("__absent").over(over("STUDENT_KEY", "TERM_KEY")).alias("Absences_per_Term"),
        F.sum("__attended").over(over("STUDENT_KEY", "TERM_KEY")).alias("Attended_per_Term"),
        F.max("__year").over(over("STUDENT_KEY")).alias("__max_year"),
        F.max("__number").over(over("STUDENT_KEY", "SCHOOL_YEAR_NAME")).alias("__max_term"))
    names = [f"__t{i}" for i in range(len(keys))]
    rel = rel.join(t, null_safe_on(rel, t, keys, names), "left").drop(*names)
    # NOT IN (enrolled) with NULL keys ignored (H17): a hash join on distinct keys.
    rel = membership_flag(rel, ["STUDENT_KEY"], enrolled, "Dropout_YN_Flag", yes="N", no="Y")
    point = None
    for (yr, term), label in DROPOUT_POINTS.items():
        cond = (F.col("__max_year") == yr) & (F.col("__max_term") == term)
        point = F.when(cond, label) if point is None else point.when(cond, label)
    point = F.when(F.col("Dropout_YN_Flag") == "Y", point.otherwise("None")).otherwise("None")
    return rel.withColumn("Point_of_Dropout", point).drop("__max_year", "__max_term")


def in_order(labels: DataFrame) -> DataFrame:
    """The report's order: student, school year, term, class (NULL first)."""
    return labels.orderBy("STUDENT_KEY", "SCHOOL_YEAR_NAME", "TERM_NUMBER", "CLASS_KEY")


def dropout_rate(labels: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct dropped students / distinct students, per ``by``."""
    k = F.col("STUDENT_KEY")
    return labels.groupBy(*by).agg(
        F.try_divide(F.count_distinct(F.when(F.col("Dropout_YN_Flag") == "Y", k)).cast("double"),
                     F.count_distinct(k)).alias("Dropout_Rate"))


def attendance_percentage(df: DataFrame) -> DataFrame:
    """Attended / sessions x 100 in real arithmetic (the reference's integer
    division gave only 0 or 100, H2)."""
    return df.withColumn("Attendance_Percentage", percent("ATTENDED_COUNT", "CLASS_SESSION_COUNT"))


def year_label(df: DataFrame) -> DataFrame:
    """Year in program as Freshman..Senior; credit and dropped counts as Y/N."""
    lab = None
    for k, v in YEAR_LABELS.items():
        lab = F.when(F.col("YEAR_IN_SEMINARY") == k, v) if lab is None else lab.when(F.col("YEAR_IN_SEMINARY") == k, v)
    yn = lambda c: F.when(F.col(c) > 0, "Y").otherwise("N")
    return df.withColumns({"Year_Label": lab, "Received_Credit_YN": yn("RECEIVED_CREDIT_COUNT"),
                           "Dropped_YN": yn("DROPPED_COUNT")})
