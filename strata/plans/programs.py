"""Program outcomes job (L6-L15): six academic years of enrollment,
retention, graduation, wages and transfers, rolled into a template-grain mart.

Plan notes.  Every step from ``enrollment_detail`` on is keyed by the student
(``pidm``).  Raw rows are first reduced map-side to a student's distinct programs
of a term and distinct graduations (so a hot student has no more of these than
others) and laid out by student once; sums, ranks and places are windows over
that layout.  The calendar (at most ``n`` rows) reaches the rows as a scalar subquery, so the
student x year spine and the transfer windows are ``explode``s, not joins.
Transfers are reduced to one first date per (student, year) before they meet
the spine, so two range joins cannot multiply each other's rows.  Programs and
graduations of a student's year stay two relations (``Sides``): only the keys
that ask for the combined rows themselves multiply them out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.dates import elapsed_years, month_abbrev
from strata.functions.numeric import WAGE_BIN_NONE, WAGE_BINS, bin_label, bin_sort_key
from strata.functions.text import before_delimiter
from strata.operators.cleaning import recode
from strata.operators.windows import HOT_GROUP_ROWS, dense_rank_by, row_number_by, shift_by
from strata.sources.sinks import materialise

EXCLUDED_YEARS = ["Unknown", "None"]
# Own institutions' codes, left out of transfers: fixed values of the reference.
OWN_OPEIDS = ["005220", "005221"]
HISPANIC_LABELS = {"Y": "Hispanic or Latinx", "N": "Not Hispanic or Latinx"}
HISPANIC_OTHER = "Prefer not to Say"
FIRST_GEN_LABELS = {"Y": "Yes", "N": "No", "U": "Unknown"}

MART_DIMS = ["academic_year", "area_of_study", "program", "degree_code", "cip", "gender", "race",
             "hispanic_origin", "first_generation", "wage_bin"]
GRAD_DIMS = ["academic_year", "grad_area_of_study", "grad_program", "grad_degree_code", "grad_cip", "gender",
             "race", "hispanic_origin", "first_generation", "wage_bin"]
MEASURES = {"quality_points": "Quality Points", "gpa_credits": "GPA Credits", "enrolled_headcount": "Enrolled Headcount",
            "retained_numerator": "Retained Numerator", "retained_denominator": "Retained Denominator",
            "grad_headcount": "Grad Headcount", "grad_quality_points": "Grad Quality Points",
            "grad_gpa_credits": "Grad GPA Credits", "years_to_completion": "Sum of Years To Completion"}
MART_LABELS = ["Academic Year", "Area of Study", "Program", "Degree Code", "CIP", "Gender", "Race",
               "Hispanic Origin", "First Generation", "Wage Bin"]


def exact(c: Column | str) -> Column:
    """A sum of these does not depend on the order of its rows."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,4)")


def academic_years(dim_term: DataFrame, as_of: dt.date, n: int = 6) -> DataFrame:
    """The ``n`` newest academic years started by ``as_of``, with this-year and
    next-year windows.  A year ending in August runs to the day before the next
    year starts (NULL for the newest year, H24)."""
    base = dim_term.filter((F.col("term_start_date") <= F.lit(as_of))
                           & ~F.col("academic_year").isin(EXCLUDED_YEARS)
                           & ~F.col("term_code").like("%50"))
    raw = (base.groupBy("academic_year")
               .agg(F.min("term_start_date").alias("ay_start_date"), F.max("term_end_date").alias("ay_end_date"))
               .orderBy(F.desc("academic_year")).limit(n))
    # At most n rows: an un-partitioned window over them is bounded.
    w = Window.orderBy(F.desc("academic_year"))
    nxt_start, nxt_end = F.lag("ay_start_date").over(w), F.lag("ay_end_date").over(w)
    return raw.select(
        "academic_year", "ay_start_date",
        F.when(month_abbrev("ay_end_date") != "AUG", F.col("ay_end_date"))
         .otherwise(F.date_sub(nxt_start, 1)).alias("ay_end_date"),
        nxt_start.alias("ny_start_date"),
        F.when(month_abbrev(nxt_end) != "AUG", nxt_end)
         .otherwise(F.date_sub(F.lag("ay_start_date", 2).over(w), 1)).alias("ny_end_date"))


def _year_list(ay: DataFrame) -> Column:
    """The calendar as one array value (scalar subquery, at most n entries)."""
    return ay.select(F.collect_list(F.struct(*ay.columns))).scalar()


def _in_years(df: DataFrame, ay: DataFrame) -> DataFrame:
    """Rows whose academic year is in the calendar (semi join on <= n keys)."""
    return df.join(F.broadcast(ay.select("academic_year")), "academic_year", "left_semi")


def student_population(course_history: DataFrame, grads: DataFrame, dim_term: DataFrame,
                       ay: DataFrame) -> DataFrame:
    """Students enrolled, or graduated (either flag), in the calendar years."""
    terms = dim_term.select("dim_term_key", "academic_year")
    enrolled = _in_years(course_history.select("pidm", "dim_term_key").join(terms, "dim_term_key"), ay)
    graduated = grads.filter((F.col("ug_ap_graduated_ind") == "Y") | (F.col("sat_graduated_ind") == "Y"))
    graduated = _in_years(graduated.select("pidm", "dim_term_key").join(terms, "dim_term_key"), ay)
    return enrolled.select("pidm").union(graduated.select("pidm")).distinct()


def spine(pop: DataFrame, ay: DataFrame) -> DataFrame:
    """One row per student and calendar year (the reference's cross join)."""
    return pop.select("pidm", F.explode(_year_list(ay)).alias("__ay")).select("pidm", "__ay.*")


def enrollment_detail(course_history: DataFrame, student_term: DataFrame, dim_term: DataFrame,
                      pgm_term: DataFrame, ay: DataFrame) -> DataFrame:
    """Distinct enrollment rows with term and year GPA points and the term's
    rank from the latest within the year (``seq`` = 1 is the latest)."""
    f = course_history.join(student_term, "dim_student_term_key")
    f = f.join(dim_term.select("dim_term_key", "term_name", "term_start_date", "academic_year"), "dim_term_key")
    f = f.join(pgm_term, f.dim_pgm_of_study_term_key == pgm_term.dim_pgm_of_study_term_key)
    f = _in_years(f, ay)
    f = f.select("pidm", "term_code", "term_name", "term_start_date", "academic_year",
                 F.col("term_area_of_study").alias("area_of_study"),
                 before_delimiter("term_program_name", ":").alias("program"),
                 F.col("term_degree_code").alias("degree_code"), F.col("term_major_cip").alias("cip"),
                 exact(F.col("gpa_quality_points") * F.col("gpa_credits")).alias("__qp"), exact("gpa_credits").alias("__gc"))
    # One early aggregate: a row per student, term and program with partial sums
    # (map-side combined), then one layout by student.  A student's rows are now its
    # distinct programs of a term, so plain windows by term and by year are bounded,
    # and all of them, like the steps after this one, share that layout.
    rows = [c for c in f.columns if not c.startswith("__")]
    f = f.groupBy(*rows).agg(F.sum("__qp").alias("__qp"), F.sum("__gc").alias("__gc")).repartition("pidm")
    term, year = Window.partitionBy("pidm", "term_code"), Window.partitionBy("pidm", "academic_year")
    total = lambda c, w: F.sum(c).over(w).cast("double")
    return f.withColumns({
        "quality_points_term": total("__qp", term), "gpa_credits_term": total("__gc", term),
        "quality_points_ay": total("__qp", year), "gpa_credits_ay": total("__gc", year),
        "seq": F.dense_rank().over(year.orderBy(F.col("term_code").desc_nulls_first())).cast("long"),
    }).drop("__qp", "__gc")


def graduate_outcomes(grads: DataFrame, dim_student: DataFrame, wages: DataFrame, dim_term: DataFrame,
                      program_of_study: DataFrame, ay: DataFrame, preaggregate_wages: bool = False) -> DataFrame:
    """Graduates with annualised wages four calendar years after graduation and
    years to completion.  In the reference the wage rows multiply the graduations
    before the per-term sums (H12); here wages are one row per (student, wage year)
    with their sum, their number of rows and of quarters, and the sums are
    multiplied by those numbers, so no pairs are ever made.  A graduate with no
    wage row gets NULL wages (the reference's 4 / 0, H14).
    ``preaggregate_wages=True`` leaves the multiplication out: the GPA sums and the
    wages are then those of single rows."""
    g = grads.filter((F.col("ug_ap_graduated_ind") == "Y") | (F.col("sat_graduated_ind") == "Y"))
    g = g.join(dim_student.select("dim_student_key", "first_term_non_concurrent"), "dim_student_key")
    w = (wages.select(F.col("pidm").alias("w_pidm"), F.substring("quarter", 1, 4).alias("wage_year"), "quarter", "wages")
         .groupBy("w_pidm", "wage_year").agg(F.sum(exact("wages")).alias("__paid"), F.count(F.lit(1)).alias("__rows"),
                                             F.count_distinct("quarter").alias("__quarters")))
    g = g.join(w, (g.pidm == w.w_pidm) & (w.wage_year.cast("int") == F.year("graduation_date") + 4), "left")
    dt_ = dim_term.filter(~F.col("academic_year").isin(EXCLUDED_YEARS)).select(
        F.col("term_code").alias("__tc"), F.col("term_name").alias("grad_term_name"),
        F.col("academic_year").alias("grad_year"))
    g = g.join(dt_, g.term_code == dt_.__tc)
    g = g.join(program_of_study, "dim_program_of_study_key")
    g = g.join(F.broadcast(ay.select(F.col("academic_year").alias("grad_year"))), "grad_year", "left_semi")
    first = dim_term.select(F.col("term_code").alias("__ftc"), F.col("term_start_date").alias("__first_start"))
    g = g.join(first, g.first_term_non_concurrent == first.__ftc, "left")
    g = g.select(
        "pidm", F.col("term_code").alias("grad_term_code"), "grad_term_name", F.col("graduation_date").alias("grad_date"),
        "grad_year", F.col("area_of_study").alias("grad_area_of_study"),
        before_delimiter("program_name", ":").alias("grad_program"), F.col("degree_code").alias("grad_degree_code"),
        F.col("major_cip").alias("grad_cip"), "wage_year", "__paid", "__rows", "__quarters",
        elapsed_years("graduation_date", "__first_start").alias("years_to_completion"),
        exact(F.col("cum_institution_gpa") * F.col("cum_institution_credits")).alias("__qp"),
        exact("cum_institution_credits").alias("__gc"))
    # One early aggregate: a row per distinct graduation with sums and how many rows
    # it stands for, then one layout by student for both sums (a student's distinct
    # graduations are bounded by its terms and programs).
    rows = [c for c in g.columns if c not in ("__qp", "__gc")]
    g = g.groupBy(*rows).agg(F.sum("__qp").alias("__qp"), F.sum("__gc").alias("__gc"), F.count(F.lit(1)).alias("__n")).repartition("pidm")
    times = F.lit(1) if preaggregate_wages else F.coalesce("__rows", F.lit(1))
    term, paid_year = Window.partitionBy("pidm", "grad_term_code"), Window.partitionBy("pidm", "wage_year")
    paid = F.max("__paid") if preaggregate_wages else F.sum(F.col("__paid") * F.col("__n"))
    total = lambda c: F.sum(F.col(c) * times).over(term).cast("double")
    return g.select(
        "pidm", "grad_term_code", "grad_term_name", "grad_date", "grad_year", "grad_area_of_study", "grad_program",
        "grad_degree_code", "grad_cip", total("__qp").alias("grad_quality_points"), total("__gc").alias("grad_gpa_credits"), "wage_year",
        F.round(paid.over(paid_year).cast("double") * F.try_divide(F.lit(4.0), F.col("__quarters"))).alias("adjusted_annual_wages"),
        "years_to_completion")


def transfers(nsc: DataFrame, institutions: DataFrame, ay: DataFrame,
              own_opeids: Sequence[str] = OWN_OPEIDS) -> DataFrame:
    """Distinct transfers out, from the first calendar year on, own codes
    excluded.  "Year >= some calendar year" is "year >= the first one": a
    scalar subquery instead of the reference's theta join."""
    first_year = ay.select(F.min(F.substring("academic_year", 1, 4).cast("int"))).scalar()
    t = nsc.join(institutions, "dim_institution_key")
    t = t.filter((F.year("enrollment_begin_date") >= first_year) & ~F.col("opeid").isin(list(own_opeids)))
    # Calendar days: a begin date carrying a time of day still falls inside a
    # window that ends on that day.
    return t.select("pidm", F.to_date("enrollment_begin_date").alias("transfer_date"),
                    "institution_level").distinct()


def _first_transfers(tr: DataFrame, ay: DataFrame) -> DataFrame:
    """Per student and calendar year the first transfer inside this year's and next
    year's window: one aggregate for both."""
    t = tr.select("pidm", "transfer_date", F.explode(_year_list(ay)).alias("__ay"))
    within = lambda a, b: F.min(F.when(F.col("transfer_date").between(F.col(f"__ay.{a}"), F.col(f"__ay.{b}")), F.col("transfer_date")))
    return t.groupBy("pidm", F.col("__ay.academic_year").alias("academic_year")).agg(
        within("ay_start_date", "ay_end_date").alias("transfer_date_this_year"),
        within("ny_start_date", "ny_end_date").alias("transfer_date_next_year"))


# Columns of the two sides of a (student, year), in the order that sorts their rows.
ENROLLED = ["program", "degree_code", "area_of_study", "cip", "quality_points", "gpa_credits"]
GRADUATED = ["grad_term_code", "grad_date", "grad_area_of_study", "grad_program", "grad_degree_code", "grad_cip",
             "grad_quality_points", "grad_gpa_credits", "wage_year", "adjusted_annual_wages", "years_to_completion"]
YEAR = ["pidm", "academic_year"]


@dataclass
class Sides:
    """The combined rows, factorised.  A student's year is the product of its enrolled
    programs and its graduations (either side is one row of NULLs where it is
    empty); the sides stay apart, each row knowing its place:

    * ``enrolled``: ``e_rank`` in its program, ``e_place`` in the year, ``e_count``;
    * ``graduated``: ``g_place`` and ``g_count``;
    * ``years``: one row a student and calendar year with transfers, the sizes of the
      sides, the wage bins of its graduations (first, last, all), what its last row
      holds, and the retention outcome of that row.

    All of a year's rows but the last are followed by a row of the same year, so
    the lead over a student's rows needs only the years, at most as many rows
    a student as the calendar has.
    """

    enrolled: DataFrame
    graduated: DataFrame
    years: DataFrame


def sides(spine_df: DataFrame, ay: DataFrame, enroll: DataFrame, grads: DataFrame, transfers_df: DataFrame) -> Sides:
    """The latest enrollments of a year, graduations and first transfers on the spine.
    The groups below are a student's *distinct* programs or graduations of a year."""
    last = lambda cols: [F.col(c).asc_nulls_last() for c in cols]
    year = Window.partitionBy(*YEAR)
    e = enroll.filter(F.col("seq") == 1).select(
        *YEAR, "area_of_study", "program", "degree_code", "cip",
        F.col("quality_points_ay").alias("quality_points"), F.col("gpa_credits_ay").alias("gpa_credits"))
    # Both sides come laid out by student, which serves the distinct rows and all numbers.
    e = e.distinct().withColumns({
        "e_rank": F.row_number().over(Window.partitionBy(*YEAR, "program").orderBy(*last(ENROLLED[1:]))),
        "e_place": F.row_number().over(year.orderBy(*last(ENROLLED))),
        "e_count": F.count(F.lit(1)).over(year), "__named": F.count("program").over(year)})
    e = materialise(e, "enrolled")
    g = grads.select("pidm", F.col("grad_year").alias("academic_year"), *GRADUATED)
    g = g.distinct().withColumn("wage_bin", bin_label("adjusted_annual_wages"))
    place = year.orderBy(*last(GRADUATED))
    g = g.withColumns({"g_place": F.row_number().over(place), "g_count": F.count(F.lit(1)).over(year),
                       "__first_bin": F.first("wage_bin").over(place),
                       "__bins": F.collect_set("wage_bin").over(year)})
    g = materialise(g, "graduated")
    e_last = e.filter(F.col("e_place") == F.col("e_count")).select(
        *YEAR, "e_count", "__named", F.col("program").alias("__program"))
    g_last = g.filter(F.col("g_place") == F.col("g_count")).select(
        *YEAR, "g_count", F.col("__first_bin").alias("first_bin"), F.col("wage_bin").alias("last_bin"),
        F.sort_array("__bins").alias("bins"), F.col("grad_program").alias("__grad_program"))
    y = spine_df.select(*YEAR)
    for side in (e_last, g_last, _first_transfers(transfers_df, ay)):
        y = y.join(side, YEAR, "left")
    # At most a row a calendar year: a student's years fit a task.
    nxt = Window.partitionBy("pidm").orderBy(F.col("academic_year").asc_nulls_last())
    starts = lambda c: F.substring(c, 1, 4).cast("int")
    retained = (F.lead("__named").over(nxt) > 0) & (starts(F.lead("academic_year").over(nxt)) == starts("academic_year") + 1)
    fate = F.when(F.col("__program").isNull(), "Not Enrolled").when(retained, "Yes")
    y = y.withColumns({
        "last_numerator": fate.otherwise("No"),
        "last_denominator": fate.when(F.col("__grad_program").isNotNull(), "No")
                                .when(F.col("transfer_date_next_year").isNotNull(), "No").otherwise("Yes")})
    none = F.lit(WAGE_BIN_NONE)
    one = F.lit(1).cast("long")
    y = y.withColumns({"e_count": F.coalesce("e_count", one), "g_count": F.coalesce("g_count", one),
                       "first_bin": F.coalesce("first_bin", none), "last_bin": F.coalesce("last_bin", none),
                       "bins": F.coalesce("bins", F.array(none))}).drop("__named", "__program", "__grad_program")
    return Sides(e.drop("__named"), g.drop("__first_bin", "__bins"), y)


def _product(s: Sides) -> DataFrame:
    """Every enrolled program of a student's year with every graduation."""
    e, g = s.enrolled.drop("e_count"), s.graduated.drop("g_count")
    c = s.years.join(e, YEAR, "left").join(g, YEAR, "left")
    return c.withColumns({"wage_bin": F.coalesce("wage_bin", F.lit(WAGE_BIN_NONE)),
                          **{k: F.coalesce(k, F.lit(1)) for k in ("e_rank", "e_place", "g_place")}})


COMBINED = ["pidm", "academic_year", "area_of_study", "program", "degree_code", "cip", "quality_points", "gpa_credits",
            "grad_date", "grad_term_code", "grad_area_of_study", "grad_program", "grad_degree_code", "grad_cip",
            "grad_quality_points", "grad_gpa_credits", "wage_year", "adjusted_annual_wages", "wage_bin", "years_to_completion",
            "transfer_date_this_year", "transfer_date_next_year"]


def combine(spine_df: DataFrame, ay: DataFrame, enroll: DataFrame, grads: DataFrame, transfers_df: DataFrame) -> DataFrame:
    """Spine rows with the latest enrollment of the year, graduation, wage bin and
    the first transfer inside this year's and next year's windows."""
    return _product(sides(spine_df, ay, enroll, grads, transfers_df)).select(*COMBINED)


def demographics(dim_student: DataFrame) -> DataFrame:
    """Students with the labels of the report."""
    hisp = F.when(F.col("hispanic_ind") == "Y", HISPANIC_LABELS["Y"]) \
            .when(F.col("hispanic_ind") == "N", HISPANIC_LABELS["N"]).otherwise(HISPANIC_OTHER)
    return dim_student.select(F.col("pidm").alias("__spidm"), "first_term_non_concurrent", "gender", "race",
                              hisp.alias("hispanic_origin"), recode("first_generation_ind", FIRST_GEN_LABELS).alias("first_generation"))


def _with_student(c: DataFrame, dim_student: DataFrame, dim_term: DataFrame) -> DataFrame:
    ds = demographics(dim_student)
    c = c.join(ds, c.pidm == ds.__spidm, "left")
    first = dim_term.select(F.col("term_code").alias("__ftc"), F.col("term_start_date").alias("first_term_nc_start_date"))
    c = c.join(first, c.first_term_non_concurrent == first.__ftc, "left")
    # A student without demographics has no row of labels: the default label stands for a missing flag.
    return c.withColumn("hispanic_origin", F.coalesce("hispanic_origin", F.lit(HISPANIC_OTHER))).drop("__spidm", "__ftc")


def retention_rows(s: Sides, dim_student: DataFrame, dim_term: DataFrame) -> DataFrame:
    """``calc`` (see ``retention``) from the two sides: sequence and outcome of a row follow
    from its places, so no window runs over the combined rows."""
    c = _product(s)
    is_last = (F.col("e_place") == F.col("e_count")) & (F.col("g_place") == F.col("g_count"))
    outcome = lambda last: F.when(is_last, F.col(last)).when(F.col("program").isNull(), "Not Enrolled").otherwise("Same Year")
    c = c.select(*COMBINED, ((F.col("e_rank") - 1) * F.col("g_count") + F.col("g_place")).cast("long").alias("enrolled_seq"),
                 outcome("last_numerator").alias("retained_numerator"), outcome("last_denominator").alias("retained_denominator"))
    return _with_student(c, dim_student, dim_term)


def mart_of_sides(s: Sides, dim_student: DataFrame, null_safe: bool = False) -> DataFrame:
    """``program_mart`` without the combined rows: each side is aggregated with the
    multiplicity that the other side gives it.

    A program's GPA counts once, under the wage bin of the year's first graduation; the
    retention outcome counts at the year's last program, under the last one's bin; the
    other bins of the year only add their keys.  A graduation counts once for every
    program of the year.  No aggregate needs a distinct count: a student has one
    first row a program and one last row a year.
    """
    ds = demographics(dim_student).drop("first_term_non_concurrent")
    labels = ["gender", "race", "hispanic_origin", "first_generation"]
    y = s.years.drop("transfer_date_this_year", "transfer_date_next_year")
    y = y.join(ds, y.pidm == ds.__spidm, "left").drop("__spidm").withColumn("hispanic_origin", F.coalesce("hispanic_origin", F.lit(HISPANIC_OTHER)))
    y = materialise(y, "student_years")
    known = F.col("pidm").isNotNull()
    e = y.select(*YEAR, *labels, "e_count", "bins", "first_bin", "last_bin", "last_numerator", "last_denominator").join(
        s.enrolled.drop("e_count"), YEAR, "left")
    first, is_last = F.coalesce("e_rank", F.lit(1)) == 1, F.coalesce("e_place", F.lit(1)) == F.col("e_count")
    dims = [d for d in MART_DIMS if d != "wage_bin"]
    # First by the set of bins, then by bin: the copies are made of groups, not of rows.
    e = e.groupBy(*dims, "bins", "first_bin", "last_bin").agg(
        F.sum(F.when(first, exact("quality_points"))).alias("__points"), F.sum(F.when(first, exact("gpa_credits"))).alias("__credits"),
        F.count_if(first & F.col("program").isNotNull() & known).alias("__headcount"),
        F.count_if(is_last & (F.col("last_numerator") == "Yes") & known).alias("__numerator"),
        F.count_if(is_last & (F.col("last_denominator") == "Yes") & known).alias("__denominator"))
    e = e.withColumn("wage_bin", F.explode("bins"))
    at = lambda which, c: F.sum(F.when(F.col("wage_bin") == F.col(which), F.col(c)))
    count = lambda which, c: F.coalesce(at(which, c), F.lit(0).cast("long"))
    e = e.groupBy(*MART_DIMS).agg(
        at("first_bin", "__points").cast("double").alias("quality_points"), at("first_bin", "__credits").cast("double").alias("gpa_credits"),
        count("first_bin", "__headcount").alias("enrolled_headcount"),
        count("last_bin", "__numerator").alias("retained_numerator"), count("last_bin", "__denominator").alias("retained_denominator"))
    g = y.select(*YEAR, *labels, "e_count").join(s.graduated.drop("g_count"), YEAR, "left")
    g = g.withColumn("wage_bin", F.coalesce("wage_bin", F.lit(WAGE_BIN_NONE)))
    times = F.col("e_count").cast("decimal(10,0)")
    g = g.groupBy(*GRAD_DIMS).agg(
        F.sum(exact("grad_quality_points") * times).cast("double").alias("grad_quality_points"),
        F.sum(exact("grad_gpa_credits") * times).cast("double").alias("grad_gpa_credits"),
        F.coalesce(F.sum(F.when(F.col("grad_program").isNotNull() & known, F.col("e_count"))), F.lit(0).cast("long")).alias("grad_headcount"),
        F.sum(F.col("years_to_completion").cast("decimal(18,2)") * times).cast("double").alias("years_to_completion"))
    return _mart(e, g, null_safe)


# Total order inside a student's rows, used by both sequence columns (H16:
# the reference orders by a column that ties).
TIE_BREAK = ["area_of_study", "cip", "quality_points", "gpa_credits", "grad_term_code", "grad_date",
             "grad_area_of_study", "grad_program", "grad_degree_code", "grad_cip", "grad_quality_points",
             "grad_gpa_credits", "wage_year", "adjusted_annual_wages", "years_to_completion",
             "transfer_date_this_year", "transfer_date_next_year"]


def retention(combined: DataFrame, dim_student: DataFrame, dim_term: DataFrame,
              hot_rows: int | None = HOT_GROUP_ROWS) -> DataFrame:
    """``calc`` from combined rows: demographics, the within-program sequence and the retention
    numerator and denominator (first rule that holds):

    no program -> Not Enrolled; next row in the same year -> Same Year; next row
    has a program and is the next year -> Yes; then for the denominator only:
    graduated -> No, transferred next year -> No, otherwise Yes.
    """
    ties = [F.col(c).asc_nulls_last() for c in TIE_BREAK]
    # ``combined`` is distinct: a (student, year, program) group holds one row per
    # distinct degree / graduation / wage / transfer combination, bounded by
    # those domains, so a plain window is safe.
    c = row_number_by(combined, ["pidm", "academic_year", "program"],
                      [F.col("degree_code").asc_nulls_last(), *ties], name="enrolled_seq", hot_rows=None)
    c = _with_student(c, dim_student, dim_term)
    # The next row of the student, however many rows there are (``retention_rows`` needs none of this).
    order = [F.col(k).asc_nulls_last() for k in ("academic_year", "program", "degree_code")]
    c = shift_by(c, ["pidm"], [*order, *ties], {"__next_year": ("academic_year", 1), "__next_program": ("program", 1)}, hot_rows=hot_rows)
    next_year, prog = F.col("__next_year"), F.col("program")
    same_year = prog.isNotNull() & (next_year == F.col("academic_year"))
    retained = (prog.isNotNull() & F.col("__next_program").isNotNull()
                & (F.substring(next_year, 1, 4).cast("int") == F.substring("academic_year", 1, 4).cast("int") + 1))
    fate = F.when(prog.isNull(), "Not Enrolled").when(same_year, "Same Year").when(retained, "Yes")
    return c.withColumns({
        "retained_numerator": fate.otherwise("No"),
        "retained_denominator": fate.when(F.col("grad_program").isNotNull(), "No")
                                    .when(F.col("transfer_date_next_year").isNotNull(), "No").otherwise("Yes"),
    }).drop("__next_year", "__next_program")


def program_mart(calc: DataFrame, null_safe: bool = False) -> DataFrame:
    """Template grain (every enrolled-side and graduate-side combination of ten
    dimensions) with enrolled and graduate measures joined on all ten.  With
    ``null_safe=False`` a NULL dimension loses its measures, as in the
    reference (H13).

    ``calc`` is read by both aggregates, so the columns they need are written once
    as parquet.
    """
    used = dict.fromkeys([*MART_DIMS, *GRAD_DIMS, "pidm", "enrolled_seq", "quality_points", "gpa_credits", "retained_numerator",
                          "retained_denominator", "grad_quality_points", "grad_gpa_credits", "years_to_completion"])
    calc = materialise(calc.select(*used), "retention")
    seq1 = F.col("enrolled_seq") == 1
    e = calc.groupBy(*MART_DIMS).agg(
        F.sum(F.when(seq1, exact("quality_points"))).cast("double").alias("quality_points"),
        F.sum(F.when(seq1, exact("gpa_credits"))).cast("double").alias("gpa_credits"),
        F.count_distinct(F.when(F.col("program").isNotNull() & seq1, F.col("pidm"))).alias("enrolled_headcount"),
        F.count_distinct(F.when(F.col("retained_numerator") == "Yes", F.col("pidm"))).alias("retained_numerator"),
        F.count_distinct(F.when(F.col("retained_denominator") == "Yes", F.col("pidm"))).alias("retained_denominator"))
    g = calc.groupBy(*GRAD_DIMS).agg(
        F.sum(exact("grad_quality_points")).cast("double").alias("grad_quality_points"),
        F.sum(exact("grad_gpa_credits")).cast("double").alias("grad_gpa_credits"),
        F.count(F.when(F.col("grad_program").isNotNull(), F.col("pidm"))).alias("grad_headcount"),
        F.sum(F.col("years_to_completion").cast("decimal(18,2)")).cast("double").alias("years_to_completion"))
    return _mart(e, g, null_safe)


def _mart(e: DataFrame, g: DataFrame, null_safe: bool) -> DataFrame:
    """The template (all keys of both aggregates) with the measures of each.  A key has at
    most one row in either, so both are laid on top of each other and grouped once:
    no template to make first, no ten-key joins.  Joined strictly, a key with a NULL
    would find neither row, so such rows bring their key only."""
    def side(df: DataFrame, dims: Sequence[str]) -> DataFrame:
        whole = F.lit(True) if null_safe else reduce(Column.__and__, [F.col(c).isNotNull() for c in dims])
        measures = [c for c in df.columns if c not in dims]
        return df.select(*[F.col(c).alias(lab) for c, lab in zip(dims, MART_LABELS)],
                         *[F.when(whole, F.col(c)).alias(MEASURES[c]) for c in measures])

    both = side(e, MART_DIMS).unionByName(side(g, GRAD_DIMS), allowMissingColumns=True)
    return both.groupBy(*MART_LABELS).agg(*[F.max(c).alias(c) for c in MEASURES.values()])


def present(mart: DataFrame, as_of: dt.date, ay: DataFrame | None = None) -> DataFrame:
    """Report columns: 'Total', the wage-bin sort key, year recency (dense rank,
    newest = 1) and the as-of date.

    Every calendar year reaches the mart through the spine, so with ``ay`` given
    the recency is ranked on the calendar (at most n rows, broadcast) instead of
    on a second pass over the mart's distinct years.
    """
    out = mart.withColumns({"Total": F.lit("Total"),
                            "Wage Bin Sort": bin_sort_key(F.col("`Wage Bin`"), WAGE_BINS)})
    if ay is not None:
        ranks = ay.select(F.col("academic_year").alias("__ay"),
                          F.dense_rank().over(Window.orderBy(F.desc("academic_year"))).cast("long").alias("AY Recency"))
        out = out.join(F.broadcast(ranks), out["Academic Year"] == ranks["__ay"], "left").drop("__ay")
    else:
        # Distinct years are bounded by the calendar.
        out = dense_rank_by(out.withColumnRenamed("Academic Year", "__ay"), [], "__ay", descending=True,
                            name="AY Recency", hot_rows=None).withColumnRenamed("__ay", "Academic Year")
    return out.withColumn("As of Date", F.lit(as_of))
