"""Readers for the provided parquet tables.

Every reader projects only the columns a caller asks for, so the parquet scan's
``ReadSchema`` stays narrow; filters written later are pushed into the scan by
Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


# Schema per state of a file, so repeated reads while a plan is built skip parquet
# schema inference.  Each read is still a fresh relation (fresh attribute ids), so
# the same table can appear on both sides of a join.
_SCHEMAS: dict[tuple, StructType] = {}


def input_version(spark: SparkSession, path: str) -> tuple:
    """What tells one state of a table from another: (name, length, time) of its
    files, from the file system Spark itself reads it with."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return (path,)
    return (path, *sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(where)))


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    path = table_path(sf_dir, name)
    version = input_version(spark, path)
    schema = _SCHEMAS.get(version)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[version] = df.schema
    else:
        df = spark.read.schema(schema).parquet(path)
    return df.select(*cols) if cols else df


class Tables:
    """Lazy accessors bound to one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __call__(self, name: str, *cols: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, *cols)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)


def constant_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small fixed relation built on the JVM (``inline`` of literal structs),
    so no Python worker is needed to scan it, unlike ``createDataFrame`` on a
    local list."""
    from pyspark.sql import functions as F

    st = StructType.fromDDL(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, st.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
