"""Helpers the training-data operators share.

Texts travel as Arrow record batches.  ``slices`` cuts a batch into parts of
bounded text size, so the numpy work arrays of a task stay small however many
rows Spark puts into a batch; one text longer than the bound is a part of its
own (a whole text is never cut).  ``Words`` finds the words
``[^\\x20\\x09-\\x0D]+`` of all texts of a part at once and gives each a 64-bit
hash.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import application_folder

#: Text bytes worked on at once.
SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.default_rng(20240517)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application.  Only the workers of a
    local master share the driver's folder and PYTHONPATH and may find it there."""
    root = Path(__file__).resolve().parents[2]
    app, master = spark.sparkContext.applicationId, spark.sparkContext.master
    found = Path.cwd() == root or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if app in _SHIPPED or found and (master == "local" or master.startswith("local[")):
        return
    with tempfile.NamedTemporaryFile(prefix="strata-", suffix=".zip", delete=False) as f, zipfile.ZipFile(f, "w") as z:
        for path in sorted((root / "strata").rglob("*.py")):
            z.write(path, path.relative_to(root))
    spark.sparkContext.addPyFile(f.name)
    _SHIPPED.add(app)


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    ship_package(spark)
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*cols) if cols else df


def crc_mod(column: str, divisor: int):
    """crc32(column as text) mod divisor; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet into the shared checkpoint folder and read back:
    the lineage is cut there and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession) -> str:
    """Of this application; ``strata.session.clean`` and ``stop`` remove it."""
    return application_folder(spark, "llm")


def discard(*frames: DataFrame) -> None:
    """Remove the files behind tables made by ``written`` that are read no more."""
    for df in frames:
        spark = df.sparkSession
        for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        off = _offsets(batch.column(column))
        ends = off[1:] - off[0]
        at = 0
        while at < n:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
        pa.default_memory_pool().release_unused()


def _offsets(col: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    raw = col.buffers()[1]
    if raw is None:
        return np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(raw, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows (null: empty)."""
    off = _offsets(col)
    raw = col.buffers()[2]
    if raw is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]]
    off = off - off[0]
    if col.null_count:
        keep = np.repeat(np.asarray(col.is_valid()), np.diff(off))
        size = np.where(np.asarray(col.is_valid()), np.diff(off), 0)
        data, off = data[keep], np.concatenate([[0], np.cumsum(size)])
    return data, off


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


class Words:
    """The words of a string column: ``start``/``end`` byte places in ``data``,
    ``first`` (row offsets into the words), ``hash`` (64 bits of each word;
    ``lower`` folds A-Z first).  ``space``: for each byte, whether it parts words."""

    def __init__(self, col: pa.Array, lower: bool = False, space: np.ndarray = _SPACE):
        self.data, self.off = utf8(col)
        data = self.data
        if lower and len(data):
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        word = ~space[data]
        begins = np.empty(len(data), bool)
        if len(data):
            begins[0] = True
            np.logical_not(word[:-1], out=begins[1:])
            begins[self.off[:-1][self.off[:-1] < len(data)]] = True
            begins &= word
        self.start = np.flatnonzero(begins)
        self.first = np.searchsorted(self.start, self.off)
        nxt = np.append(self.start[1:], len(data))
        if not len(self.start):
            self.hash = np.zeros(0, np.uint64)
            self.end = self.start
            return
        lead = int(self.start[0])
        place = np.arange(lead, len(data)) - np.repeat(self.start, nxt - self.start)
        inside = word[lead:]
        longest = int(place[inside].max()) + 1
        power = np.cumprod(np.full(longest, _BASE, np.uint64))
        part = np.where(inside, _BYTE[data[lead:]] * power[np.minimum(place, longest - 1)], np.uint64(0))
        at = self.start - lead
        self.end = self.start + np.add.reduceat(inside, at, dtype=np.int64)
        self.hash = mix(np.add.reduceat(part, at) + (self.end - self.start).astype(np.uint64))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``k`` words inside a row, and row offsets into them."""
        n = np.maximum(self.counts - k + 1, 0)
        first = np.concatenate([[0], np.cumsum(n)])
        total = len(self.hash) - k + 1
        if total <= 0 or not first[-1]:
            return np.zeros(0, np.uint64), first
        h = gram_hash(self.hash, k)
        at = np.arange(first[-1]) - np.repeat(first[:-1], n) + np.repeat(self.first[:-1], n)
        return h[at], first


def gram_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` neighbouring values (order matters)."""
    total = len(h) - k + 1
    out = np.zeros(max(total, 0), np.uint64)
    step = np.uint64(0x9FB21C651E98DF25)
    for j in range(k):
        out *= step
        out += h[j:j + total]
    return mix(out)
