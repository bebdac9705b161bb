"""Enrollment snapshot job (L1-L5): enrollment at a comparable point of the
registration window, per term and campus with an 'All' total, against targets
averaged from past terms.

Plan shape: the fact is first cut to the comparable day of each term (a
broadcast of the small ``periods`` relation, one row per term), so every later
join and the rollup run on that slice only; distinct counts are sums of flags kept per
student and per section, merged from the campuses into the total (no copies of rows).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.dates import parse_date_key
from strata.operators.joins import few_rows, join_small, membership_flag
from strata.operators.reshape import rollup_counts
from strata.sources.sinks import materialise
from strata.sources.tables import constant_frame

# Target factor per season: fixed values of the reference.
DEFAULT_KNOBS = [("Fall", 0.925), ("Spring", 0.925), ("Summer", 0.925)]
MEASURES = ["new_stu", "cont_stu", "new_br_stu", "cont_br_stu", "new_fte", "cont_fte", "new_br_fte", "cont_br_fte"]
SNAPSHOT_KEYS = ["term_code", "registration_drop_deadline", "term_season", "term_name", "dim_date_key",
                 "days_since_reg_start"]


def current_terms(dim_term: DataFrame, as_of: dt.date) -> DataFrame:
    """Terms flagged current, or with registration open (start >= as_of) and
    term started (<= as_of); never a '...50' term."""
    a = F.lit(as_of)
    cond = (F.col("current_term_ind") == "Y") | ((F.col("registration_start_date") >= a)
                                                 & (F.col("term_start_date") <= a))
    return dim_term.filter(cond & ~F.col("term_code").like("%50")).select("term_code")


def comparable_periods(section_facts: DataFrame, current: DataFrame, years_back: int = 7,
                       extra: Sequence[tuple[str, int]] = ()) -> DataFrame:
    """Per term in the last ``years_back`` years: its last day since registration
    start; ``dsrs`` = the smallest such day over terms of the same season, minus
    one (the warehouse loads a day late).  ``extra`` rows are appended as the
    reference appends its constant row (UNION ALL)."""
    bound = current.select(F.max(F.col("term_code").cast("int")) - 100 * years_back).scalar()
    tp = (section_facts.filter(F.col("term_code").cast("int") >= bound)
                       .groupBy("term_code").agg(F.max("days_since_reg_start").alias("days_since_reg_start")))
    if extra:
        spark = section_facts.sparkSession
        tp = tp.unionByName(constant_frame(spark, list(extra), "term_code string, days_since_reg_start int"))
    # One row per term: a window over the season is bounded by the calendar.
    w = Window.partitionBy(F.expr("substr(term_code, 5)"))
    return tp.select("term_code", "days_since_reg_start",
                     (F.min("days_since_reg_start").over(w) - 1).alias("dsrs")).distinct()


def duplicate_terms(periods: DataFrame) -> DataFrame:
    """Terms listed more than once in ``periods`` (H11: they double sums)."""
    return periods.groupBy("term_code").count().filter(F.col("count") > 1)


def enrollment_snapshot(facts: DataFrame, dim_student_term: DataFrame, dim_course: DataFrame,
                        dim_term: DataFrame, dim_section: DataFrame, periods: DataFrame) -> DataFrame:
    """``dse``: 13 measures per (term, comparable day) and campus, plus the 'All'
    rollup row per term."""
    p = periods.select(F.col("term_code").alias("p_term"), F.col("dsrs"))
    # periods: one row per term; Spark sizes this join itself.
    f = join_small(facts, p, (F.col("term_code") == F.col("p_term"))
                   & (F.col("days_since_reg_start") == F.col("dsrs"))).drop("p_term", "dsrs")
    dst = dim_student_term.withColumnRenamed("dim_student_term_key", "__dst_key")
    f = f.join(dst, f.dim_student_term_key == dst.__dst_key)
    f = join_small(f, dim_course, "dim_course_key")   # unused columns, but it filters (H27)
    f = join_small(f, dim_term.select("dim_term_key", "term_season", "term_name", "registration_drop_deadline"),
                   "dim_term_key")
    f = join_small(f, dim_section, "dim_section_key")

    new, cont = F.col("continuing_student_ind") == "N", F.col("continuing_student_ind") == "Y"
    br = F.col("budget_related_ind") == "Y"
    cr = F.col("credits_attempted")
    crossed = F.col("cross_list_group").isNotNull()
    half = lambda group, own: F.when(crossed, F.col(group) / 2).otherwise(F.col(own).cast("double"))
    # The slice is read once for the students and once for the sections.
    f = materialise(f.select(
        *SNAPSHOT_KEYS, "campus_code", "pidm", "crn", new.alias("new"), cont.alias("cont"), br.alias("br"), cr.alias("credits"),
        half("students_enrolled_group", "students_enrolled_section").alias("enrolled"),
        half("max_enrollment_group", "max_enrollment_section").alias("capacity"),
        F.col("students_enrolled_waitlist").cast("bigint").alias("waitlisted")), "snapshot_rows")
    new, cont, br = F.col("new"), F.col("cont"), F.col("br")
    fte = lambda who: F.when(who, F.col("credits"))
    dse = rollup_counts(f, SNAPSHOT_KEYS, "campus_code", {
        "pidm": {"new_stu": new, "cont_stu": cont, "new_br_stu": br & new, "cont_br_stu": br & cont},
        "crn": {"sections": None, "br_sections": br},
    }, {"new_fte": fte(new), "cont_fte": fte(cont), "new_br_fte": fte(br & new), "cont_br_fte": fte(br & cont),
        "enrolled": F.col("enrolled"), "capacity": F.col("capacity"), "waitlisted": F.col("waitlisted")})
    dse = dse.withColumns({c: F.round(F.col(c) / 15) for c in ("new_fte", "cont_fte", "new_br_fte", "cont_br_fte")})
    # recent_term: among the top three *rows* of periods by term code.
    top3 = periods.select("term_code").orderBy(F.desc("term_code")).limit(3)
    dse = membership_flag(dse, ["term_code"], F.broadcast(top3), "recent_term", yes="Y", no=None)
    return dse.select("term_code", "recent_term", "term_season", "term_name", "campus_code", "dim_date_key",
                      "days_since_reg_start", "new_stu", "cont_stu", "new_br_stu", "cont_br_stu", "new_fte", "cont_fte",
                      "new_br_fte", "cont_br_fte", "sections", "br_sections", "enrolled", "capacity", "waitlisted")


def repeated_snapshot_rows(dse: DataFrame) -> DataFrame:
    """Snapshot keys that occur more than once (H28: the drop deadline is grouped
    but not selected, so a term with two deadlines repeats its rows)."""
    keys = ["term_code", "campus_code", "dim_date_key", "days_since_reg_start"]
    return dse.groupBy(*keys).count().filter(F.col("count") > 1)


def enrollment_targets(dse: DataFrame, periods: DataFrame,
                       knobs: Sequence[tuple[str, float]] = DEFAULT_KNOBS,
                       all_from_totals_only: bool = False) -> DataFrame:
    """Per (campus, season): round(avg(measure) x knob) over past terms (not the
    latest term of each season).  The 'All' target averages *every* row of the
    season, campus rows and total rows alike, as the reference does (H9);
    ``all_from_totals_only=True`` averages the 'All' rows only (a college-wide
    average)."""
    spark = dse.sparkSession
    k = constant_frame(spark, list(knobs), "term_season string, knob double")
    # One row per season of the written periods: counted, then broadcast.
    latest = few_rows(periods.groupBy(F.expr("substr(term_code, 5)")).agg(F.max("term_code").alias("latest")), "latest_terms")
    base = dse.join(F.broadcast(k), "term_season")          # a handful of fixed rows
    # NOT IN (subquery): no row passes if the list holds a NULL.
    has_null = latest.filter(F.col("latest").isNull()).exists()
    base = (base.filter(F.col("term_code").isNotNull() & ~has_null)
                .join(latest, base.term_code == latest.latest, "left_anti"))
    tgt = [F.round(F.avg(m) * F.max("knob")).alias(f"{m}_tar") for m in MEASURES]
    by_campus = (base.filter(F.col("campus_code") != "All")
                     .groupBy("campus_code", "term_season").agg(*tgt))
    src = base.filter(F.col("campus_code") == "All") if all_from_totals_only else base
    overall = src.groupBy("term_season").agg(*tgt).withColumn("campus_code", F.lit("All"))
    return by_campus.unionByName(overall).distinct()


def enrollment_dashboard(dse: DataFrame, targets: DataFrame, dim_section: DataFrame,
                         as_of: dt.date) -> DataFrame:
    """Snapshot with its targets, campus names ('All' for the total) and dates."""
    t = targets.select("term_season", "campus_code", *[f"{m}_tar" for m in MEASURES])
    agg = dse.join(t, ["term_season", "campus_code"], "left")
    campus = dim_section.select(F.col("campus_code").alias("__cc"), "campus").distinct()
    out = agg.join(campus, agg.campus_code == campus.__cc, "left")
    cols = [c for c in dse.columns] + [f"{m}_tar" for m in MEASURES]
    return out.select(*cols,
                      F.when(F.col("campus_code") == "All", "All").otherwise(F.col("campus")).alias("campus"),
                      parse_date_key("dim_date_key").alias("calendar_date"),
                      F.lit(as_of).alias("as_of"))
