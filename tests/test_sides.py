"""The program job from its two sides equals the job over the combined rows."""
import datetime as dt
import random

import pytest

from conftest import rows
from strata.plans import programs

YEARS = ["2018-19", "2019-20", "2020-21"]


@pytest.fixture(scope="module")
def job(spark):
    rng = random.Random(11)
    pick = lambda *x: rng.choice(x)
    day = lambda y: dt.date(y, rng.randint(1, 12), rng.randint(1, 28))
    pidms = [*range(1, 30), None]
    enroll = [(p, y, rng.choice(["A", None]), pick("P", "Q", "R", None), pick("AS", "AA", None), pick("c", "d"), pick(1.5, 2.0, None), pick(3.0, 4.0), pick(1, 1, 2))
              for p in pidms for y in YEARS for _ in range(rng.choice([0, 0, 1, 1, 2, 4]))]
    grads = [(p, f"{y[:4]}40", y, day(int(y[:4])), pick("A", "B", None), pick("P", "Q", None), pick("AS", None), "c", pick(10.0, None), 60.0, pick("2024", None),
              pick(None, 10_000.0, 30_000.0, 200_000.0), pick(1.5, 2.25, None)) for p in pidms for y in YEARS for _ in range(rng.choice([0, 0, 0, 1, 2, 3]))]
    enroll, grads = enroll + enroll[:9], grads + grads[:5]  # repeated rows
    students = [(p, "201840", pick("F", "M", None), pick("X", "Y"), pick("Y", "N", None), pick("Y", "U", "Z")) for p in range(1, 27)]
    ay = spark.createDataFrame([(y, dt.date(int(y[:4]), 8, 1), dt.date(int(y[:4]) + 1, 7, 31), dt.date(int(y[:4]) + 1, 8, 1), dt.date(int(y[:4]) + 2, 7, 31))
                                for y in YEARS], "academic_year string, ay_start_date date, ay_end_date date, ny_start_date date, ny_end_date date")
    frame = lambda data, schema: spark.createDataFrame(data, schema).repartition(4)
    e = frame(enroll, "pidm int, academic_year string, area_of_study string, program string, degree_code string, cip string, "
                      "quality_points_ay double, gpa_credits_ay double, seq int")
    g = frame(grads, "pidm int, grad_term_code string, grad_year string, grad_date date, grad_area_of_study string, grad_program string, grad_degree_code string, "
                     "grad_cip string, grad_quality_points double, grad_gpa_credits double, wage_year string, adjusted_annual_wages double, years_to_completion double")
    tr = frame([(rng.choice(pidms), day(rng.randint(2018, 2021))) for _ in range(25)], "pidm int, transfer_date date")
    ds = frame(students, "pidm int, first_term_non_concurrent string, gender string, race string, hispanic_ind string, first_generation_ind string")
    terms = spark.createDataFrame([("201840", dt.date(2018, 9, 1))], "term_code string, term_start_date date")
    spine = programs.spine(frame([(p,) for p in pidms if p], "pidm int"), ay)
    return spine, ay, e, g, tr, ds, terms


def test_rows_of_the_sides_equal_the_window_over_combined_rows(job):
    *parts, ds, terms = job
    combined = programs.combine(*parts)
    assert combined.count() == combined.distinct().count() > 120
    got = programs.retention_rows(programs.sides(*parts), ds, terms)
    for hot in (None, 3):
        want = programs.retention(combined, ds, terms, hot_rows=hot)
        assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("null_safe", [False, True])
def test_mart_of_the_sides_equals_the_mart_of_the_rows(job, null_safe):
    *parts, ds, terms = job
    want = programs.program_mart(programs.retention(programs.combine(*parts), ds, terms), null_safe)
    got = programs.mart_of_sides(programs.sides(*parts), ds, null_safe)
    assert got.columns == want.columns and rows(got) == rows(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_no_aggregate_meets_the_product(job):
    *parts, ds, terms = job
    s = programs.sides(*parts)
    e, g, y = s.enrolled.count(), s.graduated.count(), s.years.count()
    assert y == parts[0].count()
    both = programs.combine(*parts).count()
    assert both > max(e, g, y)  # the product is larger; the mart joins each side with the years only
    assert s.years.join(s.enrolled.drop("e_count"), programs.YEAR, "left").count() <= e + y
