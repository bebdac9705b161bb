"""Epidemic jobs: case and death rates, counts by area, global rates, running
vaccinations as a share of the population (L16-L17).

Input ``cases``: continent (NULL for aggregates), location, date, population,
total_cases, new_cases, total_deaths (text), new_deaths (text).
Input ``vacc``: location, date, new_vaccinations (text, may be NULL).
Text counts are converted with ``try_cast``: a dirty value becomes NULL
instead of failing the job (H3); ``bad_counts`` reports how many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import percent
from strata.operators.windows import running_sum


def case_rates(cases: DataFrame) -> DataFrame:
    """Per row: death rate = deaths / cases x 100, infection rate = cases /
    population x 100 (NULL instead of a division by zero)."""
    deaths = F.col("total_deaths").try_cast("double")
    return cases.select("location", "date", "population", "total_cases", "total_deaths",
                        percent(deaths, "total_cases").alias("DeathRate"),
                        percent("total_cases", "population").alias("InfectionRate"))


def infection_by_location(cases: DataFrame) -> DataFrame:
    """Highest infection count and rate per (location, population)."""
    return cases.groupBy("location", "population").agg(
        F.max("total_cases").alias("HighestInfectionCount"),
        (F.max(F.try_divide(F.col("total_cases"), F.col("population").cast("double"))) * 100).alias("InfectionRate"))


def death_counts(cases: DataFrame, by: str = "location") -> DataFrame:
    """Highest total deaths per ``by`` (location or continent); aggregate rows
    (continent NULL) are left out."""
    return (cases.filter(F.col("continent").isNotNull()).groupBy(by)
                 .agg(F.max(F.col("total_deaths").try_cast("int")).alias("TotalDeathCount")))


def global_rates(cases: DataFrame, daily: bool = True) -> DataFrame:
    """New cases, new deaths and their ratio x 100, per date or overall."""
    new_deaths = F.col("new_deaths").try_cast("int")
    aggs = [F.sum("new_cases").alias("TotalCases"), F.sum(new_deaths).alias("TotalDeaths"),
            percent(F.sum(new_deaths), F.sum("new_cases")).alias("GlobalDeathRate")]
    src = cases.filter(F.col("continent").isNotNull())
    return src.groupBy("date").agg(*aggs) if daily else src.agg(*aggs)


def running_share(cases: DataFrame, vacc: DataFrame) -> DataFrame:
    """Running vaccinations per location over date (RANGE frame: tied dates
    share a total) and their share of the population.

    The series is one row per (location, date), so each location's window is
    bounded by the calendar, not by the raw event volume.
    """
    j = (cases.filter(F.col("continent").isNotNull())
              .select("continent", "location", "date", "population")
              .join(vacc.select("location", "date", "new_vaccinations"), ["location", "date"]))
    j = running_sum(j, ["location"], ["location", "date"],
                    F.col("new_vaccinations").try_cast("bigint"), "RollingVaccinations")
    return j.select("continent", "location", "date", "population", "new_vaccinations", "RollingVaccinations",
                    percent("RollingVaccinations", "population").alias("PercentPopVaccinated"))


def bad_counts(cases: DataFrame, cols=("total_deaths", "new_deaths")) -> DataFrame:
    """Number of non-NULL text counts that do not parse as integers, per column."""
    return cases.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("int").isNull()).alias(c)
                       for c in cols])


def population_constancy(cases: DataFrame) -> DataFrame:
    """Locations whose population is not constant over the series."""
    return (cases.groupBy("location").agg(F.count_distinct("population").alias("n_values"))
                 .filter(F.col("n_values") > 1))
