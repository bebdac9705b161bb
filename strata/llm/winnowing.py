"""Document fingerprints by winnowing.

Every run of ``k`` code points is hashed (rolling: a hash of 2k code points is
made from two neighbouring hashes of k); of every ``window`` neighbouring hashes
the smallest is chosen, the rightmost of equal ones, and kept with its position.
Two texts that share a passage of ``window + k - 1`` code points share a
fingerprint of it; no passage shorter than ``k`` is ever matched.

Defined results: a text of fewer than ``k`` code points (not empty) has one
fingerprint, a hash of all of it, at position 0; one with fewer than ``window``
hashes has one, the smallest of them; null and empty texts have none; equal
texts have equal fingerprints.  Likeness is intersection over union of the
hashes; two texts without fingerprints are alike (1).  Repeated rows and ids are
ordered by (id, text); null ids come first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents, mix, slices

#: Code points in a hashed run (a power of two), and hashes in a window.
K, WINDOW = 16, 16
#: Low bits of a position in a packed print; the other bits are the hash.
PLACE = 24
#: Windows looked at at once.
PIECE = 1 << 22
_LOW = np.uint64((1 << PLACE) - 1)
#: Text bytes worked on at once.
PART = 1 << 18


def _grams(points: np.ndarray, k: int) -> np.ndarray:
    h = mix((points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    span, factor = 1, 0xC2B2AE3D27D4EB4F
    while span < k:
        h = h[:-span] * np.uint64(factor) + h[span:] if len(h) > span else h[:0]
        factor = factor * factor % (1 << 64)
        span *= 2
    return mix(h)


def _smallest(h: np.ndarray, window: int) -> np.ndarray:
    """Place of the smallest of every window, the rightmost of equal ones."""
    out = [np.zeros(0, np.int64)]
    for a in range(0, len(h) - window + 1, PIECE):
        part = h[a:a + PIECE + window - 1]
        # Smallest first, then rightmost: the place in the piece counts down in the low bits.
        least = (part & ~_LOW) | (_LOW - np.arange(len(part), dtype=np.uint64))
        span = 1
        while span * 2 <= window:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < window:
            least = np.minimum(least[:len(least) - (window - span)], least[window - span:])
        out.append(a + (_LOW - (least & _LOW)).astype(np.int64))
    return np.concatenate(out)


def winnow(texts: list[str], k: int = K, window: int = WINDOW) -> list[np.ndarray]:
    """Per text: chosen hashes with positions, as hash << 24 | position, in order (of
    positions the low 24 bits; ``places`` gives all of them)."""
    if k & (k - 1):
        raise ValueError("k must be a power of two")
    size = np.array([len(t) for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    h = _grams(points, k)
    place = _smallest(h, window)
    grams = np.maximum(size - k + 1, 0)
    out = []
    for t, a, g in zip(texts, first[:-1].tolist(), grams.tolist()):
        if not t:
            out.append(np.zeros(0, np.uint64))
        elif not g:
            whole = int.from_bytes(hashlib.blake2b(t.encode("utf-8"), digest_size=5).digest(), "big")
            out.append(np.array([whole << PLACE], np.uint64))
        else:
            if g >= window:
                at = place[a:a + g - window + 1]
                at = at[np.concatenate([[True], at[1:] != at[:-1]])]
            else:
                at = np.array([a + g - 1 - int((h[a:a + g] >> np.uint64(PLACE))[::-1].argmin())])
            out.append((h[at] & ~_LOW) | ((at - a).astype(np.uint64) & _LOW))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    x, y = set((a >> np.uint64(PLACE)).tolist()), set((b >> np.uint64(PLACE)).tolist())
    return len(x & y) / len(x | y) if x or y else 1.0


def places(chosen: np.ndarray) -> np.ndarray:
    """Whole positions of a text's fingerprints: they rise by less than 24 bits each."""
    low = (chosen & _LOW).astype(np.int64)
    return low + (np.cumsum(np.diff(low, prepend=0) < 0) << PLACE)


def digest(chosen: np.ndarray) -> str:
    """18 hex digits a fingerprint: 10 of the hash, 8 of the position."""
    out = np.empty((len(chosen), 9), np.uint8)
    out[:, :5] = (chosen >> np.uint64(PLACE)).astype(">u8")[:, None].view(np.uint8)[:, 3:]
    out[:, 5:] = places(chosen).astype(">u4")[:, None].view(np.uint8)
    return out.tobytes().hex()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """(key, prints array<struct<hash, position>>) for every row of ``docs``."""
    kind = docs.schema[key].dataType.simpleString()
    item = pa.struct([("hash", pa.int64()), ("position", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PART):
            prints = winnow([t or "" for t in b.column("text").to_pylist()], k, window)
            flat = np.concatenate([*prints, np.zeros(0, np.uint64)])
            values = pa.StructArray.from_arrays([pa.array((flat >> np.uint64(PLACE)).astype(np.int64)),
                                                 pa.array(np.concatenate([*map(places, prints), np.zeros(0, np.int64)]).astype(np.int32))], fields=list(item))
            ends = np.concatenate([[0], np.cumsum([len(p) for p in prints])])
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
                                             ["key", "prints"])

    out = docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text").mapInArrow(
        run, f"key {kind}, prints array<struct<hash: long, position: int>>")
    return out.withColumnRenamed("key", key)


def with_successor(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """(doc_id, text, _bucket, _tail): rows dealt into ranges of doc_id, in order inside
    each partition and bucket, every bucket followed by the first rows of the next
    one (``_tail`` 1; after the last comes the first).

    Split points are approximate quantiles; only they and one id a bucket reach the
    driver.  A text is shuffled once, and a second time if it begins a bucket."""
    spark = docs.sparkSession
    buckets = buckets or 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    splits = np.unique(np.array(docs.approxQuantile(
        "doc_id", [i / buckets for i in range(1, buckets)], 0.25 / buckets), np.float64)).astype(np.int64)

    @F.arrow_udf("int")
    def bucket_of(ids: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(splits, ids.to_numpy(zero_copy_only=False), "right").astype(np.int32))

    lowest = F.lit(-(1 << 63)).cast("long")
    bucket = bucket_of(F.coalesce("doc_id", lowest))
    docs = docs.select("doc_id", "text", bucket.alias("_bucket"))
    firsts = sorted((r["_bucket"], r["id"]) for r in docs.groupBy("_bucket").agg(
        F.min(F.coalesce("doc_id", lowest)).alias("id")).collect())
    border = [(i, firsts[n - 1][0]) for n, (_, i) in enumerate(firsts)] or [(0, 0)]
    border = spark.createDataFrame(border, "_first long, _previous int")
    rows = docs.join(F.broadcast(border), F.coalesce("doc_id", lowest) == F.col("_first"), "left")
    own = F.struct(F.col("_bucket").alias("to"), F.lit(0).alias("tail"))
    tail = F.struct(F.col("_previous").alias("to"), F.lit(1).alias("tail"))
    both = F.when(F.col("_previous").isNull(), F.array(own)).otherwise(F.array(own, tail))
    rows = rows.select("doc_id", "text", F.explode(both).alias("_at"))
    rows = rows.select("doc_id", "text", F.col("_at.to").alias("_bucket"), F.col("_at.tail").alias("_tail"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "_bucket").sortWithinPartitions("_bucket", "_tail", F.asc_nulls_first("doc_id"), "text")


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its text with the second half taken from the next document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row before, with its fingerprints
        for b in slices(batches, "text", PART):
            rows = list(zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(),
                            b.column("_bucket").to_pylist(), b.column("_tail").to_pylist()))
            rows = [(i, t or "", k, tail) for i, t, k, tail in rows]
            line = ([last[0]] if last else []) + rows
            pairs = [(n, line[n], line[n + 1]) for n in range(len(line) - 1)
                     if line[n][2] == line[n + 1][2] and not line[n][3]]
            edited = [x[1][:len(x[1]) - len(x[1]) // 2] + y[1][:len(x[1]) // 2] for _, x, y in pairs]
            made = winnow([r[1] for r in rows] + edited)
            own = ([last[1]] if last else []) + made[:len(rows)]
            last = (line[-1], own[-1])
            out = []
            for (n, x, _), text, prints in zip(pairs, edited, made[len(rows):]):
                out.append((x[0], len(x[1]), hashlib.sha256(text.encode("utf-8")).hexdigest(), digest(own[n]), digest(prints),
                            likeness(own[n], prints), likeness(own[n], own[n + 1])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return with_successor(documents(spark, sf_dir, "doc_id", "text")).mapInArrow(run, schema)
