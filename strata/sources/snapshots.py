"""A snapshot kept by day: an incremental table that reads its source only for the
days it does not hold yet, or that have changed.

The table lies in folders of a coarser column (the term), so a reader prunes to the
terms it asks for and thousands of days do not become thousands of folders.  Beside
it lies what the source last said of every day (any comparable value: a count, a
sum of hashes).  ``refresh`` compares that with the source, builds the rows of new and
changed days, and overwrites only the folders that those days touch
(``partitionOverwriteMode=dynamic``): their other days are taken from the table
itself.  Days that the source no longer has are removed the same way.  The marks are
replaced last, so days of a refresh that broke off are built again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.joins import join_grouped
from strata.sources.sinks import materialise

DAY, MARK = "__day", "__mark"


class DailyTable:
    """``schema``: the rows' columns; ``folder``: the one that names the folders."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, folder: str):
        self.spark, self.path, self.folder, self.names = spark, path, folder, schema.fieldNames()
        self.schema = StructType([*schema.fields, *StructType.fromDDL(f"{DAY} date").fields])
        self.marks = f"{path.rstrip('/')}-marks"

    def _read(self, path: str, schema: StructType) -> DataFrame:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def read(self) -> DataFrame:
        return self._read(self.path, self.schema).select(*self.names)

    def _differing(self, now: DataFrame) -> list:
        """(day, built) for each day whose mark is not the one kept: bounded by the calendar."""
        then = self._read(self.marks, StructType.fromDDL("__d date, __m string"))
        both = now.join(then, now[DAY] == then["__d"], "full")
        return both.filter(~F.col(MARK).eqNullSafe(F.col("__m"))).select(
            F.coalesce(DAY, "__d").alias("day"), F.col(DAY).isNotNull().alias("built")).collect()

    def refresh(self, marks: DataFrame, rows_of: Callable[[list[dt.date]], DataFrame]) -> list[dt.date]:
        """Bring the table up to ``marks`` (day, mark: one row a day of the source).  ``rows_of(days)``
        builds the rows of these days, with ``day``.  Returns the days it built, at most
        one entry a calendar day."""
        held = self._read(self.path, self.schema)
        now = marks.select(F.col("day").alias(DAY), F.col("mark").cast("string").alias(MARK))
        if not self._differing(now):
            return []
        now = materialise(now, "marks")  # kept as it is compared, whatever the source does meanwhile
        differs = self._differing(now)
        built = sorted(r["day"] for r in differs if r["built"])
        days = self.spark.createDataFrame([(d,) for d in built], "__b date")
        gone = self.spark.createDataFrame([(r["day"],) for r in differs], "__gone date")
        fresh = rows_of(built).withColumnRenamed("day", DAY).join(F.broadcast(days), F.col(DAY) == F.col("__b"))
        fresh = fresh.select(*self.names, DAY)
        fresh = materialise(fresh, "fresh_days")
        old = join_grouped(held, gone, [DAY], "left_semi", ["__gone"]).select(self.folder)
        touched = fresh.select(self.folder).union(old).distinct().withColumnRenamed(self.folder, "__f")
        kept = held.join(touched, held[self.folder].eqNullSafe(touched["__f"]), "left_semi")
        kept = join_grouped(kept, gone, [DAY], "left_anti", ["__gone"])
        # Written aside first: the folders that it replaces are the ones it is read from.
        out = materialise(kept.unionByName(fresh), "touched_terms")
        emptied = touched.join(out.select(F.col(self.folder).alias("__o")).distinct(), F.col("__f").eqNullSafe(F.col("__o")), "left_anti").collect()
        (out.repartition(self.folder).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.folder).parquet(self.path))
        for r in emptied:  # a folder without days left: dynamic overwrite does not see it
            value = "__HIVE_DEFAULT_PARTITION__" if r["__f"] is None else r["__f"]
            p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{self.folder}={value}")
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        materialise(now.select(F.col(DAY).alias("__d"), F.col(MARK).alias("__m")), "marks", self.marks)
        return built
