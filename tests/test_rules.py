"""Rows that the provided data never shows: NULL and tied ids, NULL groups, mixed
case, literal delimiters, long suffixes, appended rows, and a session without a
shared folder."""
import datetime as dt
import os
import tempfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strata import session
from strata.functions.text import part_from_right
from strata.operators.cleaning import fill_from_group, recode, sentinel_to_null
from strata.operators.windows import keep_first, row_number_by
from strata.plans import enrollment, ledger, properties
from strata.sources import institutional, tables


def test_keep_first_keeps_one_row_of_every_group(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", 3, 5), ("b", 3, 4), ("b", 9, 0), ("c", None, 7),
                                ("c", 1, 6), (None, 2, 1), (None, 2, 1)], "k string, id int, v int")
    kept = keep_first(df, ["k"], "id")
    assert rows(kept) == sorted([("a", None, 1), ("b", 3, 4), ("c", None, 7), (None, 2, 1)], key=repr)
    later = row_number_by(df, ["k"], ["id", "v"], name="n").filter("n > 1")
    assert kept.count() + later.count() == df.count()
    assert dict(later.dtypes)["n"] == "bigint"


def test_duplicates_and_dedupe_add_up(spark):
    cols = "UniqueID int, ParcelID string, PropertyAddress string, SalePrice int, SaleDate string, LegalReference string"
    data = [(i, p, "x", 1, "2020-01-01", "r") for i, p in [(1, "p"), (2, "p"), (None, "p"), (2, "p"), (5, None), (6, None)]]
    df = spark.createDataFrame(data, cols)
    kept, gone = properties.dedupe(df), properties.duplicates(df)
    assert rows(kept, "UniqueID", "ParcelID") == sorted([(None, "p"), (5, None)], key=repr)
    assert kept.count() + gone.count() == df.count()


def test_rows_without_a_group_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x"), (3, "p", None), (4, "p", "y")], "id int, g string, a string")
    assert rows(fill_from_group(df, ["g"], "a"), "id", "a") == [(1, None), (2, "x"), (3, "y"), (4, "y")]


def test_case_does_not_matter(spark):
    df = spark.createDataFrame([("l", "i", "Doll", "Purchase", 1.0, 1), ("l", "i", "doll", "REVENUE", 3.0, 2),
                                ("null", "i", "DOLL", "fee", 1.0, 3)],
                               "lot_name string, item_name string, item_type string, txn_type string, amount double, txn_id int")
    assert rows(ledger.sell_through(df, item_type="Doll")) == [("l", 1, 1)]
    assert rows(ledger.clean_ledger(df), "lot_name") == sorted([("l",), ("l",), (None,)], key=repr)
    flags = spark.createDataFrame([("y",), ("N",), ("No",), (None,)], "SoldAsVacant string")
    assert rows(properties.recode_vacant(flags)) == sorted([("Yes",), ("No",), ("No",), (None,)], key=repr)
    assert rows(flags.select(recode("SoldAsVacant", {"Y": "Yes"}).alias("v"))) == [(None,)] * 4
    assert rows(sentinel_to_null(flags, "SoldAsVacant", "n"), "SoldAsVacant") == sorted([("y",), (None,), ("No",), (None,)], key=repr)


@pytest.mark.parametrize("delim", [".", "|", "/", "\\E", "a+", "$"])
def test_delimiters_are_literal(spark, delim):
    df = spark.createDataFrame([(delim.join(["one", "two", "three"]),), ("one",), (None,)], "s string")
    got = [r[0] for r in df.select(part_from_right("s", 1, delim)).collect()]
    assert got == ["three", "one", None]
    assert df.select(part_from_right("s", 2, delim)).first()[0] == "two"


def test_long_season_suffixes_stay_apart(spark):
    facts = spark.createDataFrame([("200020", 9), ("200020X", 3), ("200120", 4), ("200120X", 8)],
                                  "term_code string, days_since_reg_start int")
    facts = facts.withColumn("term_code", F.col("term_code"))
    current = spark.createDataFrame([("200120",)], "term_code string")
    bound = facts.filter("length(term_code) = 6")
    assert rows(enrollment.comparable_periods(bound, current), "term_code", "dsrs") == [("200020", 3), ("200120", 3)]
    season = F.expr("substr(term_code, 5)")
    assert rows(facts.groupBy(season.alias("s")).count()) == [("20", 2), ("20X", 2)]


def test_appended_orders_reach_the_dimensions(spark):
    folder = tempfile.mkdtemp(prefix="strata-append-", dir="/tmp")
    cols = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
            "o_orderpriority string")
    row = lambda k, y: (k, 1, "F", 1.0, dt.datetime(y, 2, 1), "1-URGENT")
    path = os.path.join(folder, "orders.parquet")
    spark.createDataFrame([row(1, 2000)], cols).write.parquet(path)
    t = tables.Tables(spark, folder)
    as_of = dt.date(2001, 6, 1)
    assert rows(institutional.dim_term(t, as_of), "term_code") == [("200020",)]
    spark.createDataFrame([row(2, 2001)], cols).write.mode("append").parquet(path)
    assert rows(institutional.dim_term(t, as_of), "term_code") == [("200020",), ("200120",)]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        def __init__(self, master):
            self.master = master

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, path):
            self.path = path

    class Session:
        conf = {}

        def __init__(self, master):
            self.sparkContext = Context(master)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session("spark://host:7077"))
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session("local-cluster[2,1,1024]"))
    assert os.path.isdir(session.checkpoint_dir(Session("local[4]")))


def test_only_what_a_key_needs_runs(spark):
    """Defining and running these keys reads no more rows than their relations hold."""
    from strata.registry import QUERIES, load_all
    load_all()
    sf = "/root/testdata/sf0.001"
    QUERIES["l01_current_term"](spark, sf).collect()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("l01-again", "defined twice")
    frame = QUERIES["l01_current_term"](spark, sf)
    assert len(tracker.getJobIdsForGroup("l01-again")) == 0
    frame.collect()
    spark.sparkContext.setJobGroup("", "")


def test_graduations_never_meet_wages_in_pairs(spark):
    """10,000 graduations and 10,000 wage rows of one student in one year: the sums
    are those of 100 million pairs, the time is not."""
    from strata.plans import programs
    n = 10_000
    base = spark.range(n)
    grads = base.select(F.lit(1).alias("pidm"), F.lit("200020").alias("term_code"), F.lit("2000-05-01").cast("date").alias("graduation_date"),
                        F.lit("Y").alias("ug_ap_graduated_ind"), F.lit("N").alias("sat_graduated_ind"), F.lit(1).alias("dim_student_key"),
                        F.lit(200020).alias("dim_term_key"), F.lit(7).alias("dim_program_of_study_key"),
                        F.lit(2.0).alias("cum_institution_gpa"), F.lit(60.0).alias("cum_institution_credits"))
    wages = base.select(F.lit(1).alias("pidm"), F.concat(F.lit("2004Q"), (F.col("id") % 2 + 1).cast("string")).alias("quarter"),
                        F.lit(10.0).alias("wages"))
    student = spark.createDataFrame([(1, "199920")], "dim_student_key int, first_term_non_concurrent string")
    terms = spark.createDataFrame([("200020", "Spring", "1999-00", dt.date(2000, 1, 1)), ("199920", "Spring", "1998-99", dt.date(1999, 1, 1))],
                                  "term_code string, term_name string, academic_year string, term_start_date date")
    program = spark.createDataFrame([(7, "A", "P:x", "D", "C")],
                                    "dim_program_of_study_key int, area_of_study string, program_name string, degree_code string, major_cip string")
    ay = spark.createDataFrame([("1999-00",)], "academic_year string")
    out = programs.graduate_outcomes(grads, student, wages, terms, program, ay).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["grad_quality_points"], r["grad_gpa_credits"]) == (120.0 * n * n, 60.0 * n * n)
    assert r["adjusted_annual_wages"] == 10.0 * n * n * 4 / 2
    single = programs.graduate_outcomes(grads, student, wages, terms, program, ay, preaggregate_wages=True).collect()[0]
    assert (single["grad_quality_points"], single["adjusted_annual_wages"]) == (120.0 * n, 10.0 * n * 4 / 2)
