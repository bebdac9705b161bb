"""Typed staging, materialisation and export.

Everything written goes under the shared checkpoint folder the session names
(``spark.checkpoint.dir``), never a machine-local folder, so a table written by
one job survives the loss of the executors that wrote it.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from strata.operators.cleaning import recode
from strata.session import application_folder


def typed_staging(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """``CREATE TABLE #t (c type, ...)`` + ``INSERT INTO #t SELECT``: a select that
    casts each declared column (strict cast: bad values raise, as the insert would)."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])


def _new_path(spark: SparkSession, kind: str, name: str) -> str:
    return os.path.join(application_folder(spark, kind), f"{name}-{uuid.uuid4().hex[:12]}")


def materialise(df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """``SELECT ... INTO t``: write the result as parquet and read it back, which
    also cuts the lineage (a lost executor does not recompute the query).

    Rows go to ``path`` in one step: they are written beside it and the folder is
    renamed, so a reader sees the table as it was or as it is, never a part of it.
    Without ``path`` the table belongs to the application: it lies in the shared
    folder under the application's id and goes with it (``session.stop``).
    ``partition_by`` lays it out in folders that readers prune.
    """
    spark = df.sparkSession
    target = f"{path.rstrip('/')}.new-{uuid.uuid4().hex[:12]}" if path else _new_path(spark, "tables", name)
    path = path or target
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(target)
    if target != path:
        _replace(spark, target, path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _replace(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``; what was there is moved aside first and
    removed last, so there is a whole table under one of the two names at any time."""
    src, fs = _file_system(spark, new)
    dst, _ = _file_system(spark, path)
    old, _ = _file_system(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:12]}")
    had = fs.exists(dst)
    if had and not fs.rename(dst, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(src, dst):
        if had:
            fs.rename(old, dst)
        raise OSError(f"cannot move {new} to {path}")
    if had:
        fs.delete(old, True)


def export_mart(df: DataFrame, name: str, partition_by: Sequence[str] | None = None,
                fmt: str = "parquet", path: str | None = None) -> str:
    """Write a result for a dashboard, partitioned (by term or year, say) so a
    reader prunes to the slice it shows.  Returns the path."""
    spark = df.sparkSession
    path = path or _new_path(spark, "exports", name)
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def read_mart(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    r = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", "true")
    return r.load(path).select(*schema.fieldNames())


# Noise for masking: a Lehmer-style mix of an integer key, small enough never to
# overflow 64 bits and simple enough to be reproduced by any SQL engine.
NOISE_MODULUS = 1_000_003
NOISE_MULTIPLIER = 48_271


def key_noise(key: str, df: DataFrame, seed: int = 42) -> Column:
    """A value in [0, 1) that depends only on the row key (and the seed)."""
    k = F.col(key)
    if isinstance(df.schema[key].dataType, IntegralType):
        # pmod first: no overflow for any 64-bit key; equals (|k| + seed) mod M
        # for the non-negative keys of the provided tables.
        mixed = ((F.pmod(k, F.lit(NOISE_MODULUS)) + seed) % NOISE_MODULUS) * NOISE_MULTIPLIER % NOISE_MODULUS
        return mixed / float(NOISE_MODULUS)
    return (F.abs(F.xxhash64(k, F.lit(seed))) % NOISE_MODULUS) / float(NOISE_MODULUS)


def mask(df: DataFrame, key: str, replace: Mapping[str, Mapping[str, str]] | None = None,
         perturb: Mapping[str, float] | None = None, drop: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """Mask a result before export: replace category values, perturb numbers by
    up to +/- ``fraction`` with noise seeded from the row key (reproducible, no
    driver state), drop columns."""
    out = df
    for col, mapping in (replace or {}).items():
        out = out.withColumn(col, recode(col, mapping, default=col))
    u = key_noise(key, df, seed)
    for col, fraction in (perturb or {}).items():
        out = out.withColumn(col, F.round(F.col(col) * (1 + fraction * (2 * u - 1)), 2))
    return out.drop(*drop)
