"""The composed jobs on small fixtures holding the hazards of SURVEY 7.4."""
import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from strata.plans import attendance, enrollment, epidemic, ledger, programs, properties

D = dt.date


def _ledger(spark):
    return spark.createDataFrame([
        (1, "lot A", "i1", "doll", "purchase", 10.004),
        (2, "lot A", "i1", "doll", "Revenue", 25.0),        # capitals (H6)
        (3, "NULL", "i2", "doll", "purchase", 5.0),         # sentinel lot
        (4, "lot B", "i3", "doll", "purchase", 7.0),        # bought, never sold (H29)
        (5, "lot C", "i4", "doll", "revenue", 9.0),
        (6, "lot C", "i4", "doll", "revenue", 9.0),
        (7, "lot C", "i4", "doll", "purchase", 3.0),        # sold more than bought
        (8, "lot A", "i1", "doll", "refund", 1.0),          # unlisted type (H21)
        (9, "lot A", "i1", "doll", "fee", 0.5),
    ], "txn_id int, lot_name string, item_name string, item_type string, txn_type string, amount double")


def test_lot_pnl(spark):
    out = ledger.lot_pnl(_ledger(spark))
    got = {r.LotName: (r.Revenue, r.Purchases, r.Fees, r.ShipSeller, r.ShipBuyer, r.Profit, r.AllExpenses)
           for r in out.collect()}
    assert got == {
        "lot A": (25.0, 10.0, 0.5, 0.0, 0.0, 14.5, 10.5),
        None: (0.0, 5.0, 0.0, 0.0, 0.0, -5.0, 5.0),
        "lot B": (0.0, 7.0, 0.0, 0.0, 0.0, -7.0, 7.0),
        "lot C": (18.0, 3.0, 0.0, 0.0, 0.0, 15.0, 3.0),
    }
    assert ledger.total_profit(out).first().TOTAL == 17.5
    assert rows(ledger.unlisted_types(_ledger(spark))) == [("refund", 1)]


def test_item_pnl_zero_fills_every_bucket(spark):
    out = ledger.item_pnl(_ledger(spark))
    assert [r.ItemName for r in out.collect()][0] == "i4"          # highest profit first
    assert all(r.Fees is not None and r.ShipBuyer is not None for r in out.collect())


def test_sell_through_and_oversold(spark):
    sell = ledger.sell_through(_ledger(spark))
    assert rows(sell) == [("lot A", 1, 1), ("lot C", 1, 2)]          # lot B and the NULL lot drop out
    assert rows(ledger.oversold(sell), "LotName") == [("lot C",)]


def _houses(spark):
    t = dt.datetime
    return spark.createDataFrame([
        (1, "P1", "1 Main St, Town", "1 Main St, Town, TN", t(2013, 4, 9), 100.0, "L1", "Y", "D1"),
        (2, "P1", None, "1 Main St, Town, TN", t(2014, 1, 1), 200.0, "L2", "N", "D1"),
        (3, "P2", None, "4 A.B St, Xville, TN", t(2015, 1, 1), 300.0, "L3", "Yes", "D2"),   # only NULLs
        (4, "P3", "No Comma Road", "x, y, z", t(2016, 1, 1), 400.0, "L4", "No", "D3"),
        (5, "P1", "1 Main St, Town", "1 Main St, Town, TN", t(2013, 4, 9), 100.0, "L1", "Y", "D1"),  # dup
    ], "UniqueID int, ParcelID string, PropertyAddress string, OwnerAddress string, SaleDate timestamp_ntz, "
       "SalePrice double, LegalReference string, SoldAsVacant string, TaxDistrict string")


def test_clean_properties(spark):
    df = _houses(spark)
    out = properties.clean_properties(df)
    assert set(out.columns).isdisjoint(properties.DROPPED)
    got = {r.UniqueID: r for r in out.collect()}
    assert sorted(got) == [1, 2, 3, 4]                                # id 5 is the duplicate
    assert (got[2].PropertySplitAddress, got[2].PropertySplitCity) == ("1 Main St", "Town")  # filled, trimmed
    assert got[3].PropertySplitAddress is None                        # nothing to fill from
    assert (got[4].PropertySplitAddress, got[4].PropertySplitCity) == (None, None)   # no comma (H18)
    assert (got[3].OwnerSplitAddress, got[3].OwnerSplitCity, got[3].OwnerSplitState) == ("4 A.B St", "Xville", "TN")
    assert [got[i].SoldAsVacant for i in (1, 2, 3, 4)] == ["Yes", "No", "Yes", "No"]
    assert got[1].SaleDateConverted == D(2013, 4, 9)
    dups = properties.duplicates(properties.fill_addresses(df))
    assert rows(dups, "UniqueID", "RowNum") == [(5, 2)]
    # invariant: kept + listed duplicates = input rows
    assert out.count() + dups.count() == df.count()


def _cases(spark):
    return spark.createDataFrame([
        ("Eu", "A", D(2021, 1, 1), 100, 10.0, 10.0, "1", "1"),
        ("Eu", "A", D(2021, 1, 2), 100, 10.0, 0.0, "abc", None),      # zero new cases, dirty text (H1, H3)
        (None, "World", D(2021, 1, 1), 1000, 50.0, 50.0, "9", "9"),   # aggregate row: no continent
    ], "continent string, location string, date date, population int, total_cases double, new_cases double, "
       "total_deaths string, new_deaths string")


def test_epidemic_rates(spark):
    c = _cases(spark)
    rates = {(r.location, r.date): (r.DeathRate, r.InfectionRate) for r in epidemic.case_rates(c).collect()}
    assert rates[("A", D(2021, 1, 1))] == (10.0, 10.0)
    assert rates[("A", D(2021, 1, 2))] == (None, 10.0)
    g = {r.date: (r.TotalCases, r.TotalDeaths, r.GlobalDeathRate) for r in epidemic.global_rates(c).collect()}
    assert g[D(2021, 1, 2)] == (0.0, None, None)                       # 0 / 0 is NULL, not an error
    assert rows(epidemic.death_counts(c, "location")) == [("A", 1)]
    assert epidemic.bad_counts(c).first().total_deaths == 1


def test_running_share_ties_and_nulls(spark):
    vacc = spark.createDataFrame([("A", D(2021, 1, 1), "5"), ("A", D(2021, 1, 2), "3"), ("A", D(2021, 1, 2), None)],
                                 "location string, date date, new_vaccinations string")
    out = epidemic.running_share(_cases(spark), vacc)
    assert rows(out, "date", "RollingVaccinations", "PercentPopVaccinated") == [
        (D(2021, 1, 1), 5, 5.0), (D(2021, 1, 2), 8, 8.0), (D(2021, 1, 2), 8, 8.0)]   # RANGE frame (H7)


def test_dropout_labels(spark):
    base = spark.createDataFrame([
        (1, 11, "2019 (19-20)", 1, 1, 1, 9, "Y"), (1, 11, "2019 (19-20)", 1, 1, 2, 8, "Y"),   # two classes
        (1, 12, "2019 (19-20)", 2, 1, 0, 10, "Y"),
        (2, 21, "2020 (20-21)", 1, 2, 3, 7, "Y"),
        (3, 21, "2020 (20-21)", 1, 1, 0, 10, "N"),                                            # not in cohort
        (4, 21, "2020 (20-21)", 1, 3, 0, 10, "Y"),
    ], "STUDENT_KEY int, TERM_KEY int, SCHOOL_YEAR_NAME string, TERM_NUMBER int, YEAR_IN_SEMINARY int, "
       "ABSENT_COUNT int, ATTENDED_COUNT int, Relevant_YN_Flag string")
    enrolled = spark.createDataFrame([(4,), (4,), (None,)], "STUDENT_KEY int")   # repeat and NULL (H17, H30)
    out = attendance.dropout_labels(base, enrolled)
    got = rows(out, "STUDENT_KEY", "TERM_KEY", "Absences_per_Term", "Dropout_YN_Flag", "Point_of_Dropout")
    assert got == [(1, 11, 3, "Y", "Post-Freshman"), (1, 11, 3, "Y", "Post-Freshman"),
                   (1, 12, 0, "Y", "Post-Freshman"), (2, 21, 3, "Y", "Mid-Sophomore"), (4, 21, 0, "N", "None")]
    rate = attendance.dropout_rate(out, []).first().Dropout_Rate
    assert abs(rate - 2 / 3) < 1e-12
    pct = attendance.attendance_percentage(base.withColumn("CLASS_SESSION_COUNT", F.lit(10)))
    assert sorted(r.Attendance_Percentage for r in pct.collect())[0] == 70.0      # real division (H2)


def test_enrollment_targets_average_all_rows(spark):
    dse = spark.createDataFrame([
        ("201940", "Fall", "A", 10), ("201940", "Fall", "B", 20), ("201940", "Fall", "All", 30),
        ("202040", "Fall", "A", 99), ("202040", "Fall", "All", 99),       # latest Fall term: excluded
    ], "term_code string, term_season string, campus_code string, new_stu long")
    for m in enrollment.MEASURES[1:]:
        dse = dse.withColumn(m, F.lit(0).cast("long"))
    periods = spark.createDataFrame([("201940", 100, 99), ("202040", 101, 99)],
                                    "term_code string, days_since_reg_start int, dsrs int")
    got = {r.campus_code: r.new_stu_tar for r in enrollment.enrollment_targets(dse, periods).collect()}
    assert got == {"A": 9.0, "B": 19.0, "All": 19.0}      # 'All' = avg(10, 20, 30) x .925 (H9)
    assert enrollment.duplicate_terms(periods).count() == 0


def test_current_terms_and_periods(spark):
    dim_term = spark.createDataFrame([
        ("202040", "N", D(2020, 8, 1), D(2020, 9, 1)), ("202120", "Y", D(2020, 12, 1), D(2021, 1, 1)),
        ("202150", "Y", D(2021, 4, 1), D(2021, 5, 1)),                      # '...50' terms never count
    ], "term_code string, current_term_ind string, registration_start_date date, term_start_date date")
    ct = enrollment.current_terms(dim_term, D(2021, 2, 1))
    assert rows(ct) == [("202120",)]
    facts = spark.createDataFrame([("202040", 5), ("202040", 9), ("201940", 12), ("202120", 3), ("201320", 50)],
                                  "term_code string, days_since_reg_start int")
    p = enrollment.comparable_periods(facts, ct, years_back=7, extra=[("201920", 192)])
    assert rows(p) == [("201920", 192, 2), ("201940", 12, 8), ("202040", 9, 8), ("202120", 3, 2)]


def test_academic_years_august_edge(spark):
    terms = []
    for y in (2019, 2020):
        ay = f"{y}-{(y + 1) % 100:02d}"
        terms += [(ay, f"{y}40", D(y, 9, 1), D(y, 12, 31)), (ay, f"{y + 1}20", D(y + 1, 1, 1), D(y + 1, 4, 30)),
                  (ay, f"{y + 1}30", D(y + 1, 5, 1), D(y + 1, 8, 31))]
    terms.append(("Unknown", "000040", D(1900, 1, 1), D(1900, 2, 1)))
    dim_term = spark.createDataFrame(terms, "academic_year string, term_code string, term_start_date date, "
                                            "term_end_date date")
    ay = {r.academic_year: r for r in programs.academic_years(dim_term, D(2021, 6, 1)).collect()}
    assert set(ay) == {"2019-20", "2020-21"}
    assert ay["2020-21"].ay_end_date is None                           # newest year ending in August (H24)
    assert ay["2019-20"].ay_end_date == D(2020, 8, 31)
    assert (ay["2019-20"].ny_start_date, ay["2019-20"].ny_end_date) == (D(2020, 9, 1), None)


def test_program_mart_null_keys(spark):
    calc = spark.createDataFrame([
        (1, "2020-21", "Health", "1-URGENT", "AS", "CIP-1", None, None, None, None, "M", "Asia", "Yes", None,
         "None", 1, 4.0, 3.0, "Yes", "Yes", None, None, None, None),
        (2, "2020-21", None, None, None, None, "Health", "1-URGENT", "AS", "CIP-1", "M", "Asia", "Yes", "Yes",
         "None", 1, None, None, "Not Enrolled", "Not Enrolled", 10.0, 60.0, 1.5, "x"),
    ], "pidm int, academic_year string, area_of_study string, program string, degree_code string, cip string, "
       "grad_area_of_study string, grad_program string, grad_degree_code string, grad_cip string, gender string, "
       "race string, hispanic_origin string, first_generation string, wage_bin string, enrolled_seq int, "
       "quality_points double, gpa_credits double, retained_numerator string, retained_denominator string, "
       "grad_quality_points double, grad_gpa_credits double, years_to_completion double, grad_term_code string")
    strict = programs.program_mart(calc)
    safe = programs.program_mart(calc, null_safe=True)
    def pick(df, program, fg):
        return [r for r in df.collect() if r["Program"] == program and r["First Generation"] == fg]
    # first_generation NULL on pidm 1: strict equality loses its measures
    assert [r["Enrolled Headcount"] for r in pick(strict, "1-URGENT", None)] == [None]
    assert [r["Enrolled Headcount"] for r in pick(safe, "1-URGENT", None)] == [1]
    assert [r["Grad Headcount"] for r in pick(strict, "1-URGENT", "Yes")] == [1]
    # template keys are unique
    assert strict.count() == strict.select(*programs.MART_LABELS).distinct().count()


def test_enrollment_snapshot_hazards(spark):
    facts = spark.createDataFrame([
        ("202040", 20201010, 10, 1, 3.0, "A", 11, 1, 202040, 101),
        ("202040", 20201010, 10, 2, 4.0, "B", 12, 1, 202040, 102),     # section with a NULL campus (H8)
        ("202040", 20201010, 10, 3, 5.0, "A", 13, 9, 202040, 101),     # course 9 not in dim_course (H27)
        ("202040", 20201009, 9, 1, 6.0, "A", 11, 1, 202040, 101),      # not the comparable day
    ], "term_code string, dim_date_key int, days_since_reg_start int, pidm int, credits_attempted double, "
       "crn string, dim_student_term_key int, dim_course_key int, dim_term_key int, dim_section_key int")
    dst = spark.createDataFrame([(11, "N"), (12, "Y"), (13, "N")], "dim_student_term_key int, continuing_student_ind string")
    course = spark.createDataFrame([(1,)], "dim_course_key int")
    term = spark.createDataFrame([(202040, "Fall", "Fall 2020", D(2020, 9, 15))],
                                 "dim_term_key int, term_season string, term_name string, registration_drop_deadline date")
    section = spark.createDataFrame([
        (101, "M", "Main", "Y", None, 20, 99, 30, 99, 2),
        (102, None, None, "N", "X", 99, 40, 99, 60, 0),                # cross-listed: group figures halved
    ], "dim_section_key int, campus_code string, campus string, budget_related_ind string, cross_list_group string, "
       "students_enrolled_section int, students_enrolled_group int, max_enrollment_section int, "
       "max_enrollment_group int, students_enrolled_waitlist int")
    periods = spark.createDataFrame([("202040", 11, 10)], "term_code string, days_since_reg_start int, dsrs int")
    dse = enrollment.enrollment_snapshot(facts, dst, course, term, section, periods)
    got = {r.campus_code: r for r in dse.collect()}
    assert set(got) == {"M", "Unknown", "All"}
    m, u, a = got["M"], got["Unknown"], got["All"]
    assert (m.new_stu, m.cont_stu, m.new_br_stu, m.sections, m.enrolled, m.capacity, m.waitlisted) == \
        (1, 0, 1, 1, 20.0, 30.0, 2)
    assert (u.new_stu, u.cont_stu, u.br_sections, u.enrolled, u.capacity, u.cont_fte, u.new_fte) == \
        (0, 1, 0, 20.0, 30.0, 0.0, None)
    assert (a.new_stu, a.cont_stu, a.sections, a.enrolled, a.capacity, a.waitlisted) == (1, 1, 2, 40.0, 60.0, 2)
    assert all(r.recent_term == "Y" for r in dse.collect())


def test_graduate_wages_fan_out_and_missing(spark):
    grads = spark.createDataFrame([
        (1, "201630", D(2016, 5, 10), "Y", "N", 1, 201630, 501, 3.0, 60.0),
        (2, "201630", D(2016, 5, 10), "N", "Y", 2, 201630, 502, 3.0, 60.0),    # no wage rows (H14)
        (3, "201630", D(2016, 5, 10), "Y", "Y", 3, 201630, 503, 3.0, 60.0),    # five wage rows (H12)
        (4, "201630", D(2016, 5, 10), "N", "N", 4, 201630, 504, 3.0, 60.0),    # not graduated
    ], "pidm int, term_code string, graduation_date date, ug_ap_graduated_ind string, sat_graduated_ind string, "
       "dim_student_key int, dim_term_key int, dim_program_of_study_key int, cum_institution_gpa double, "
       "cum_institution_credits double")
    students = spark.createDataFrame([(k, "201340") for k in (1, 2, 3, 4)],
                                     "dim_student_key int, first_term_non_concurrent string")
    wages = spark.createDataFrame([(1, "2020Q1", 1000.0), (1, "2020Q2", 1000.0), (1, "2019Q4", 7.0),
                                   (3, "2020Q1", 500.0), (3, "2020Q1", 500.0), (3, "2020Q2", 1000.0),
                                   (3, "2020Q3", 1000.0), (3, "2020Q4", 1000.0)],
                                  "pidm int, quarter string, wages double")
    dim_term = spark.createDataFrame([("201630", "Summer 2016", "2015-16", D(2016, 5, 1)),
                                      ("201340", "Fall 2013", "2013-14", D(2013, 9, 1))],
                                     "term_code string, term_name string, academic_year string, term_start_date date")
    pos = spark.createDataFrame([(k, "Health", "Nursing:RN", "AS", "51") for k in (501, 502, 503, 504)],
                                "dim_program_of_study_key int, area_of_study string, program_name string, "
                                "degree_code string, major_cip string")
    ay = spark.createDataFrame([("2015-16",)], "academic_year string")
    out = programs.graduate_outcomes(grads, students, wages, dim_term, pos, ay)
    got = {r.pidm: r for r in out.collect()}
    assert sorted(got) == [1, 2, 3]
    assert (got[1].adjusted_annual_wages, got[1].wage_year, got[1].grad_program) == (4000.0, "2020", "Nursing")
    assert got[2].adjusted_annual_wages is None and got[2].wage_year is None
    assert got[3].adjusted_annual_wages == 4000.0
    assert got[1].grad_quality_points == 360.0 and got[3].grad_quality_points == 900.0   # fan-out kept (H12)
    assert got[1].years_to_completion == 2.69


def test_retention_rules(spark):
    cols = ("pidm int, academic_year string, area_of_study string, program string, degree_code string, cip string, "
            "quality_points double, gpa_credits double, grad_date date, grad_term_code string, "
            "grad_area_of_study string, grad_program string, grad_degree_code string, grad_cip string, "
            "grad_quality_points double, grad_gpa_credits double, wage_year string, adjusted_annual_wages double, "
            "wage_bin string, years_to_completion double, transfer_date_this_year date, transfer_date_next_year date")

    def row(pidm, year, program, degree="AS", grad=None, transfer_next=None):
        return (pidm, year, "Area", program, degree if program else None, "C", None, None, None, None, None, grad,
                None, None, None, None, None, None, "None", None, None, transfer_next)
    combined = spark.createDataFrame([
        row(1, "2019-20", "P"), row(1, "2020-21", "P"),                    # retained into next year
        row(2, "2019-20", "A"), row(2, "2019-20", "B"),                    # two programs in one year
        row(3, "2019-20", "P", grad="P"),                                  # graduated
        row(4, "2019-20", "P", transfer_next=D(2020, 10, 1)),              # transferred out next year
        row(5, "2019-20", None),                                           # not enrolled
        row(6, "2019-20", "P"), row(6, "2020-21", None),                   # next row has no program
        row(7, "2019-20", "Q", degree=None), row(7, "2019-20", "Q", degree="AS"),   # NULL degree sorts last (H5)
    ], cols)
    students = spark.createDataFrame([
        (1, "201940", "F", "Asia", "Y", "U"), (2, "201940", "M", "Asia", "X", "X"),
    ] + [(k, "201940", "F", "Asia", "N", "Y") for k in (3, 4, 5, 6, 7)],
        "pidm int, first_term_non_concurrent string, gender string, race string, hispanic_ind string, "
        "first_generation_ind string")
    terms = spark.createDataFrame([("201940", D(2019, 9, 1))], "term_code string, term_start_date date")
    calc = programs.retention(combined, students, terms)
    got = {(r.pidm, r.academic_year, r.program, r.degree_code): (r.retained_numerator, r.retained_denominator)
           for r in calc.collect()}
    assert got[(1, "2019-20", "P", "AS")] == ("Yes", "Yes")
    assert got[(1, "2020-21", "P", "AS")] == ("No", "Yes")
    assert got[(2, "2019-20", "A", "AS")] == ("Same Year", "Same Year")
    assert got[(2, "2019-20", "B", "AS")] == ("No", "Yes")
    assert got[(3, "2019-20", "P", "AS")] == ("No", "No")
    assert got[(4, "2019-20", "P", "AS")] == ("No", "No")
    assert got[(5, "2019-20", None, None)] == ("Not Enrolled", "Not Enrolled")
    assert got[(6, "2019-20", "P", "AS")] == ("No", "Yes")
    seq = {r.degree_code: r.enrolled_seq for r in calc.collect() if r.pidm == 7}
    assert seq == {"AS": 1, None: 2}
    demo = {r.pidm: (r.hispanic_origin, r.first_generation, r.first_term_nc_start_date) for r in calc.collect()}
    assert demo[1] == ("Hispanic or Latinx", "Unknown", D(2019, 9, 1))
    assert demo[2] == ("Prefer not to Say", None, D(2019, 9, 1))
    # invariant: the numerator's students are a subset of the denominator's
    num = {r.pidm for r in calc.collect() if r.retained_numerator == "Yes"}
    den = {r.pidm for r in calc.collect() if r.retained_denominator == "Yes"}
    assert num <= den


def test_transfer_on_the_last_day_with_a_time(spark):
    import datetime as _dt
    nsc = spark.createDataFrame([
        (1, _dt.datetime(2020, 8, 31, 15, 0), "000001", 2),      # last day of 2019-20, afternoon (H25)
        (2, _dt.datetime(2020, 9, 1, 0, 0), "005220", 2),        # own institution: excluded
        (3, _dt.datetime(2018, 5, 1, 0, 0), "000001", 2),        # before the first calendar year
    ], "pidm int, enrollment_begin_date timestamp_ntz, opeid string, dim_institution_key int")
    inst = spark.createDataFrame([(2, "2-year")], "dim_institution_key int, institution_level string")
    ay = spark.createDataFrame([("2019-20", D(2019, 9, 1), D(2020, 8, 31), D(2020, 9, 1), None)],
                               "academic_year string, ay_start_date date, ay_end_date date, ny_start_date date, "
                               "ny_end_date date")
    tr = programs.transfers(nsc, inst, ay)
    assert rows(tr) == [(1, D(2020, 8, 31), "2-year")]
    spine = spark.createDataFrame([(1, "2019-20")], "pidm int, academic_year string")
    empty = lambda schema: spark.createDataFrame([], schema)
    enroll = empty("pidm int, academic_year string, area_of_study string, program string, degree_code string, "
                   "cip string, quality_points_ay double, gpa_credits_ay double, seq int")
    grads = empty("pidm int, grad_year string, grad_date date, grad_term_code string, grad_area_of_study string, "
                  "grad_program string, grad_degree_code string, grad_cip string, grad_quality_points double, "
                  "grad_gpa_credits double, wage_year string, adjusted_annual_wages double, "
                  "years_to_completion double")
    c = programs.combine(spine, ay, enroll, grads, tr).first()
    assert (c.transfer_date_this_year, c.transfer_date_next_year, c.wage_bin) == (D(2020, 8, 31), None, "None")


def test_corrected_options(spark):
    # Keep lots that bought but never sold
    sell = ledger.sell_through(_ledger(spark), keep_unsold=True)
    assert rows(sell) == [("lot A", 1, 1), ("lot B", 1, 0), ("lot C", 1, 2)]
    # H9: the 'All' target from total rows only
    dse = spark.createDataFrame([("201940", "Fall", "A", 10), ("201940", "Fall", "B", 20),
                                 ("201940", "Fall", "All", 30), ("202040", "Fall", "All", 99)],
                                "term_code string, term_season string, campus_code string, new_stu long")
    for m in enrollment.MEASURES[1:]:
        dse = dse.withColumn(m, F.lit(0).cast("long"))
    periods = spark.createDataFrame([("201940", 1, 0), ("202040", 1, 0)],
                                    "term_code string, days_since_reg_start int, dsrs int")
    got = {r.campus_code: r.new_stu_tar
           for r in enrollment.enrollment_targets(dse, periods, all_from_totals_only=True).collect()}
    assert got["All"] == 28.0                                    # round(30 x .925)


def test_preaggregated_wages_remove_the_fan_out(spark):
    grads = spark.createDataFrame([(3, "201630", D(2016, 5, 10), "Y", "N", 3, 201630, 503, 3.0, 60.0)],
                                  "pidm int, term_code string, graduation_date date, ug_ap_graduated_ind string, "
                                  "sat_graduated_ind string, dim_student_key int, dim_term_key int, "
                                  "dim_program_of_study_key int, cum_institution_gpa double, "
                                  "cum_institution_credits double")
    students = spark.createDataFrame([(3, "201340")], "dim_student_key int, first_term_non_concurrent string")
    wages = spark.createDataFrame([(3, "2020Q1", 500.0), (3, "2020Q1", 500.0), (3, "2020Q2", 1000.0)],
                                  "pidm int, quarter string, wages double")
    dim_term = spark.createDataFrame([("201630", "Summer 2016", "2015-16", D(2016, 5, 1)),
                                      ("201340", "Fall 2013", "2013-14", D(2013, 9, 1))],
                                     "term_code string, term_name string, academic_year string, term_start_date date")
    pos = spark.createDataFrame([(503, "Health", "Nursing", "AS", "51")],
                                "dim_program_of_study_key int, area_of_study string, program_name string, "
                                "degree_code string, major_cip string")
    ay = spark.createDataFrame([("2015-16",)], "academic_year string")
    faithful = programs.graduate_outcomes(grads, students, wages, dim_term, pos, ay).first()
    fixed = programs.graduate_outcomes(grads, students, wages, dim_term, pos, ay, preaggregate_wages=True).first()
    assert faithful.adjusted_annual_wages == fixed.adjusted_annual_wages == 4000.0
    assert (faithful.grad_quality_points, fixed.grad_quality_points) == (540.0, 180.0)


def test_two_drop_deadlines_repeat_snapshot_rows(spark):
    facts = spark.createDataFrame([("202040", 20201010, 10, 1, 3.0, "A", 11, 1, 202040, 101)],
                                  "term_code string, dim_date_key int, days_since_reg_start int, pidm int, "
                                  "credits_attempted double, crn string, dim_student_term_key int, "
                                  "dim_course_key int, dim_term_key int, dim_section_key int")
    dst = spark.createDataFrame([(11, "N")], "dim_student_term_key int, continuing_student_ind string")
    course = spark.createDataFrame([(1,)], "dim_course_key int")
    term = spark.createDataFrame([(202040, "Fall", "Fall 2020", D(2020, 9, 15)),
                                  (202040, "Fall", "Fall 2020", D(2020, 9, 22))],      # two deadlines (H28)
                                 "dim_term_key int, term_season string, term_name string, "
                                 "registration_drop_deadline date")
    section = spark.createDataFrame([(101, "M", "Main", "Y", None, 20, 99, 30, 99, 2)],
                                    "dim_section_key int, campus_code string, campus string, "
                                    "budget_related_ind string, cross_list_group string, "
                                    "students_enrolled_section int, students_enrolled_group int, "
                                    "max_enrollment_section int, max_enrollment_group int, "
                                    "students_enrolled_waitlist int")
    periods = spark.createDataFrame([("202040", 11, 10)], "term_code string, days_since_reg_start int, dsrs int")
    dse = enrollment.enrollment_snapshot(facts, dst, course, term, section, periods)
    assert dse.count() == 4                                   # (M, All) x two deadlines, as the reference gives
    assert rows(enrollment.repeated_snapshot_rows(dse), "campus_code", "count") == [("All", 2), ("M", 2)]
