"""Best-fit packing after Martello-Toth dominance reduction.

Documents become pieces of at most ``capacity`` tokens, and pieces are packed
into as few sequences of that capacity as the method finds.  How many pieces
there are of each length is all that a packing needs, and that histogram has at
most ``capacity`` rows whatever the input, so the packing is planned on it:

* Reduction.  From the longest length down, a set with that length is fixed if
  it provably dominates every other set that could hold it (Martello and Toth):
  the piece alone if nothing fits beside it; it and the longest partner that
  fits, if the two fill the sequence, or no two others fit beside it, or no pair
  that fits is longer than that partner; it and the pair of largest sum, if
  nothing else of at most three pieces could use the space better.  A set found
  for one piece of a length holds for all of them while its members last, so it
  is fixed that many times at once.
* Best fit, longest first, places the rest: always into the fullest sequences
  that have room, many equal sequences at a time.

The plan is a list of (pattern, how often); each pattern gives its lengths runs
of ranks, and a piece finds its sequence and offset from the rank it has among
the pieces of its length.  Ranks come from ``ranked`` (bucket counts and running
sums), so no length is numbered in one task.  Sequences of one piece (a full one
above all) go the same way.

Defined results: null and empty texts are one piece with the end token only;
repeated rows and ids are packed as so many documents; a very long text becomes
many pieces (only the first may be shorter than the capacity); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bpe import PATTERN, Encoder, default_vocabulary, encoder
from strata.llm.common import documents, slices, written
from strata.llm.sharding import ranked, unit

CAPACITY = 1024
END = 2
#: White-space characters in a row from which a text leaves ``tiktoken`` (which fails at about a million).
LONG_BLANK = 50_000


@lru_cache(maxsize=2)
def _tokens(path: str):
    import tiktoken

    enc = Encoder(path)
    special = {k.decode(): v for k, v in enc.special.items()}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=enc.vocab, special_tokens=special)


def token_ids(text: str, path: str) -> np.ndarray:
    """The ids of a text.  ``tiktoken`` keeps a stack entry for every character of a run
    of white space; texts with a long run go through the encoder of ``bpe``, which
    gives the same ids."""
    if len(text) >= LONG_BLANK and any(len(x) >= LONG_BLANK for x in re.findall(r"\s+", text)):
        return np.frombuffer(encoder(path).encode_column(pa.array([text], pa.large_string()))[0], "<u4")
    return np.asarray(_tokens(path).encode(text, allowed_special="all"), "<u4")


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids): the ids of every text and
    the end id, cut into pieces of ``capacity``, the first one shorter if need be."""
    path = path or default_vocabulary()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            row, piece, start, length, crc, body = [], [], [], [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                ids = np.append(token_ids(text or "", path), np.uint32(end)).astype("<u4")
                n = len(ids)
                head = n if n <= capacity else (n % capacity or capacity)
                cuts = [0, *range(head, n + 1, capacity)]
                for k, (a, z) in enumerate(zip(cuts, cuts[1:])):
                    raw = ids[a:z].tobytes()
                    row.append(i), piece.append(k), start.append(a), length.append(z - a)
                    crc.append(zlib.crc32(raw)), body.append(raw)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(body, pa.binary())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary")


def reduce_instance(counts: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Martello-Toth reduction; takes the fixed sets out of ``counts`` and returns (set, times)."""
    fixed = []

    def fix(*items: int) -> None:
        need = Counter(items)
        times = min(counts[x] // k for x, k in need.items())
        fixed.append((items, times))
        for x, k in need.items():
            counts[x] -= k * times

    for j in sorted(counts, reverse=True):
        while counts[j]:
            chosen = _dominating(counts, j, capacity - j)
            if chosen is None:
                break
            fix(j, *chosen)
    for x in [x for x, n in counts.items() if not n]:
        del counts[x]
    return fixed


def _dominating(counts: Counter, j: int, room: int) -> tuple[int, ...] | None:
    """What to put beside one ``j`` so that the set dominates, or None."""
    left = sorted(x for x, n in counts.items() if n - (x == j) > 0 and x <= room)
    have = lambda x: counts[x] - (x == j)
    if not left:
        return ()
    low: list[int] = []
    for x in left:
        low += [x] * min(3 - len(low), have(x))
        if len(low) == 3:
            break
    top = left[-1]
    if top == room or len(low) < 2 or low[0] + low[1] > room:
        return (top,)
    if len(low) == 3 and sum(low) <= room:
        return None
    best, i = (0, 0, 0), 0
    for a in reversed(left):  # pair of largest sum; both pointers move one way
        while i < len(left) and left[i] + a <= room:
            i += 1
        for b in left[max(0, i - 2):i]:
            if b < a or b == a and have(a) > 1:
                best = max(best, (a + b, a, b))
    total, a, b = best
    if top >= total:
        return (top,)
    if top == a:
        between = []
        for x in left:
            if b < x:
                between += [x] * min(2, have(x) - (x == a))
        if len(between) < 2 or between[0] + between[1] > room:
            return (a, b)
    return None


def best_fit(counts: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on the histogram: (pattern, times)."""
    open_: dict[int, list[list]] = {}  # room left -> [pattern, times]
    done: list[tuple[tuple[int, ...], int]] = []
    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            room = min((r for r, g in open_.items() if r >= size and g), default=None)
            if room is None:
                # New sequences; best fit fills each before it opens the next.
                per = capacity // size
                if n >= per:
                    times, pattern = n // per, (size,) * per
                else:
                    times, pattern = 1, (size,) * n
                open_.setdefault(capacity - size * len(pattern), []).append([pattern, times])
                n -= times * len(pattern)
                continue
            pattern, times = open_[room].pop()
            # Fill each of these as far as the size allows before the next one.
            per = room // size
            if n >= per:
                used, add = min(times, n // per), per
            else:
                used, add = 1, n
            if used < times:
                open_[room].append([pattern, times - used])
            open_.setdefault(room - add * size, []).append([pattern + (size,) * add, used])
            n -= used * add
    for groups in open_.values():
        done += [(p, t) for p, t in groups]
    return done


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, times, first sequence, offset): the pieces of the
    length with ranks first..first+times-1 go to sequences first sequence.. at that offset."""
    counts = Counter({int(k): int(v) for k, v in histogram.items()})
    patterns = reduce_instance(counts, capacity)
    patterns += best_fit(counts, capacity)
    slots, rank, sequence = [], Counter(), 0
    for pattern, times in patterns:
        offset = 0
        for size, repeat in sorted(Counter(pattern).items(), reverse=True):
            for _ in range(repeat):
                slots.append((size, rank[size], times, sequence, offset))
                rank[size] += times
                offset += size
        sequence += times
    return slots


def pack(items: DataFrame, capacity: int = CAPACITY, key: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``items`` (with ``length`` from 1 to capacity) with ``sequence_id`` and ``offset``.

    ``items`` is read three times (count by length, bucket counts, rows), so it should be a table."""
    spark = items.sparkSession
    histogram = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(k is None or not 1 <= k <= capacity for k in histogram):
        raise ValueError(f"lengths must lie in 1..{capacity}")
    slots = plan(histogram, capacity)
    table = spark.createDataFrame(slots or [(0, 0, 0, 0, 0)],
                                  "length long, first long, times long, sequence long, offset long")
    table = table.groupBy("length").agg(F.sort_array(F.collect_list(
        F.struct("first", "times", "sequence", "offset"))).alias("_slots"))
    buckets = max(1, 2 * math.isqrt(sum(histogram.values())))
    keys = [F.col(k) for k in key]
    rows = ranked(items.withColumn("_u", unit(F.xxhash64(F.lit(11), *keys))), "_u", buckets, "_rank", list(key), ["length"])
    slot = F.element_at(F.filter("_slots", lambda s: (s["first"] <= F.col("_rank")) & (F.col("_rank") < s["first"] + s["times"])), 1)
    rows = rows.join(F.broadcast(table), "length").withColumn("_slot", slot)
    return rows.select(*[F.col(f"`{c}`") for c in items.columns],
                       (F.col("_slot.sequence") + F.col("_rank") - F.col("_slot.first")).alias("sequence_id"),
                       F.col("_slot.offset").alias("offset"))


def op2_dominance_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = written(pieces(documents(spark, sf_dir, "doc_id", "text")).drop("ids"), "pieces")
    return pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
