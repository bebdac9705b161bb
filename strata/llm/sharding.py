"""Sharding by proportional stratified interleaving.

Every source (stratum) is shuffled by a seeded hash and its rows are ranked;
row ``r`` (from 0) of a source with ``n`` rows gets the fractional rank
``(r + start) / n``, where ``start`` in [0, 1) is a hash of the source, so that
small sources do not all fall on one place.  Sorted by fractional rank, any
stretch of the order holds every source in proportion to its size (to within
one or two rows), and the order is cut into shards whose row counts differ by
at most one.

Ranks and the global order are found without a group or an order in one task:
rows fall into about ``2 * sqrt(n)`` buckets by value (of the shuffle hash, then
of the fractional rank), buckets are counted, a running sum over the small
bucket table gives each bucket's first rank, and rows are numbered inside their
buckets only.  A source with a third of all rows is spread over all buckets.

Defined results: a null source is a stratum of its own; null and repeated
doc_ids, repeated rows and equal texts are all placed (ties are broken by every
carried column, and rows equal in all of them are interchangeable); a null text
has no bytes; an empty table gives no rows; other columns are ignored, or kept
under their own names by ``assign_shards``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import documents

#: Bytes of a row besides its text.
ROW_OVERHEAD = 8


def unit(h: Column) -> Column:
    """A 64-bit hash as a number in [0, 1)."""
    return F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53)


def ranked(df: DataFrame, value: str, buckets: int, out: str, ties: list[str],
              group: list[str]) -> DataFrame:
    """0-based rank of every row by (value, ties), per ``group``; ``value`` lies in [0, 1)."""
    bucket = F.least(F.floor(F.col(value) * buckets), F.lit(buckets - 1)).cast("int")
    df = df.withColumn("_bucket", bucket)
    per = df.groupBy(*group, "_bucket").agg(F.count("*").alias("_rows"))
    w = Window.partitionBy(*group).orderBy("_bucket")
    start = per.select(
        *[F.col(c).alias(f"_g_{c}") for c in group], F.col("_bucket").alias("_b"),
        (F.sum("_rows").over(w) - F.col("_rows")).alias("_start"))
    on = df["_bucket"] == start["_b"]
    for c in group:
        on = on & df[c].eqNullSafe(start[f"_g_{c}"])
    inside = Window.partitionBy(*group, "_bucket").orderBy(value, *ties)
    return (df.join(start, on).withColumn(out, F.col("_start") + F.row_number().over(inside) - 1)
              .drop("_bucket", "_b", "_start", *[f"_g_{c}" for c in group]))


def assign_shards(rows: DataFrame, shards: int, stratum: str, key: list[str], seed: int = 17) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (0.. inside it).

    ``key`` orders rows whose shuffle hash is equal; the hash is of all key columns."""
    if shards < 1:
        raise ValueError("shards must be positive")
    cols = rows.columns
    base = rows.select(
        F.col(stratum).alias("_stratum"), F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"),
        *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(key)])
    keys = [f"_k{i}" for i in range(len(key))]
    base = base.withColumn("_u", unit(F.xxhash64(F.lit(seed), *keys)))
    total = rows.count()
    buckets = max(1, 2 * math.isqrt(total))
    order = ranked(base, "_u", buckets, "_rank", keys, ["_stratum"])
    size = base.groupBy("_stratum").agg(F.count("*").alias("_n")).withColumnRenamed("_stratum", "_s")
    placed = order.join(size, F.col("_stratum").eqNullSafe(F.col("_s"))).withColumn(
        "_f", (F.col("_rank") + unit(F.xxhash64(F.lit(seed + 1), "_stratum"))) / F.col("_n"))
    placed = placed.select("_row", "_f", "_u", *keys)
    placed = ranked(placed, "_f", buckets, "_at", ["_u", *keys], [])
    at = F.col("_at")
    shard = F.expr(f"(_at * {shards}) div {max(total, 1)}")
    first = F.expr(f"(_shard * {max(total, 1)}L + {shards - 1}) div {shards}")
    return (placed.withColumn("_shard", shard)
                  .select("_row.*", F.col("_shard").cast("int").alias("shard"), (at - first).alias("slot")))


def op5_stratified_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "source")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", "source", (F.octet_length(text).cast("long") + ROW_OVERHEAD).alias("size"),
                       F.crc32(text).alias("text_crc32"))
    out = assign_shards(rows, 24, "source", ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
