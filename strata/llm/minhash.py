"""Near-duplicate groups by min-max hashing.

A document is the set of its distinct word shingles.  Under every permutation
both the smallest and the largest value are kept, so ``bands * rows`` signature
values cost half as many permutations; each of the two agrees between two
documents with the probability of their likeness J.  Bands of ``rows`` values
are bucket keys; two documents at the threshold miss each other in all bands
with the probability given at ``BANDS``.

Candidates are not all pairs of a bucket:

1. Documents with the same set are one class, represented by its smallest id.
2. Every bucket has a pivot (the class with most copies, then the smallest id);
   each member is compared with the pivot, on full sets.
3. What remains are pairs of members of one pivot of which at least one is not
   linked to it.  A member is then described by its difference from the pivot.
   For two members to be linked they must share a number of difference elements
   that follows from the sizes, so they share one among the first few of each in
   order of rarity (prefix filtering).  Those pairs are compared on full sets,
   unless both are linked to one pivot already.
   No pair above the threshold that met in a bucket is lost, and a group of any
   size is joined on its rare differences only.
4. Links are closed to components.

Defined results: a null, empty or blank text has no shingles, is linked with
nothing and is kept; a text of fewer words than a shingle is one shingle; equal
rows are one class; a null id counts as the largest id and its component is the
smallest other id in its group (null if there is none); an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import Words, discard, documents, mix, slices, written
from strata.llm.components import components
from strata.operators.joins import join_grouped

#: Words in a shingle and least likeness in percent, unless a caller says otherwise.
SHINGLE, LEAST = 5, 80
#: Values in a band and bands, by least likeness: misses 2e-7 at 85 %, 6e-7 at 80 %.
BANDS = {85: (7, 40), 80: (6, 48)}
#: Ids of compared documents are broadcast up to this many (8 bytes each), else joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Text bytes worked on at once.
PART = 1 << 19
NULL_ID = (1 << 63) - 1


def shingle_sets(col: pa.Array, k: int) -> list[np.ndarray]:
    """Per text the sorted distinct shingle hashes; none for a text without words."""
    w = Words(col, lower=True)
    h, first = w.grams(k)
    out = []
    for i, n in enumerate(w.counts.tolist()):
        if n >= k:
            out.append(np.unique(h[first[i]:first[i + 1]]))
        elif n:
            raw = w.hash[w.first[i]:w.first[i + 1]].tobytes()
            out.append(np.frombuffer(hashlib.blake2b(raw, digest_size=8).digest(), np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def permutations(count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 32, count, dtype=np.uint32))


def signatures(sets: list[np.ndarray], rows: int, bands: int) -> np.ndarray:
    """Band keys (texts x bands) of non-empty sets: the first half of the values are
    the minima, the second half the maxima, under the same permutations."""
    half = (rows * bands + 1) // 2
    a, b = permutations(half)
    v = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    values = np.empty((2 * half, len(sets)), np.uint64)
    t = np.empty_like(v)
    for j in range(half):
        np.multiply(v, a[j], out=t)
        t += b[j]
        t ^= t >> np.uint32(15)
        values[j] = np.minimum.reduceat(t, first)
        values[half + j] = np.maximum.reduceat(t, first)
    keys = np.empty((len(sets), bands), np.uint64)
    for i in range(bands):
        h = np.full(len(sets), i + 1, np.uint64)
        for value in values[i * rows:(i + 1) * rows]:
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + value)
        keys[:, i] = h
    return keys.view(np.int64)


def sketches(docs: DataFrame, k: int, rows: int, bands: int) -> DataFrame:
    """(id, th, n_shingles, set_key, bands): null key and bands for a text without words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PART):
            sets = shingle_sets(b.column("text"), k)
            some = [i for i, s in enumerate(sets) if len(s)]
            keys: list[bytes | None] = [None] * len(sets)
            lists: list[np.ndarray | None] = [None] * len(sets)
            if some:
                for i, band in zip(some, signatures([sets[i] for i in some], rows, bands)):
                    keys[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    lists[i] = band
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("th"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(lists, pa.list_(pa.int64()))], ["id", "th", "n_shingles", "set_key", "bands"])

    return docs.mapInArrow(run, "id long, th long, n_shingles long, set_key binary, bands array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(id, members binary): sorted 64-bit shingle hashes of the documents in ``ids``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PART):
            raw = [s.tobytes() for s in shingle_sets(b.column("text"), k)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(raw, pa.binary())], ["id", "members"])

    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    chosen = docs.join(side, "id", "left_semi")
    return chosen.mapInArrow(run, "id long, members binary")


def compare(pairs: DataFrame, sets: DataFrame, differences: bool = False) -> DataFrame:
    """``pairs`` (p, x, wanted boolean) with set sizes, intersection and, where wanted,
    the elements in which x differs from p."""
    left = sets.select(F.col("id").alias("x"), F.col("members").alias("mx"))
    right = sets.select(F.col("id").alias("p"), F.col("members").alias("mp"))
    rows = pairs.join(left, "x").join(right, "p").select("p", "x", "wanted", "mp", "mx")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices([batch], "mx", 1 << 22):
                np_, nx, inter, diff = [], [], [], []
                last, mp = None, np.zeros(0, np.uint64)
                ps = b.column("p").to_pylist()
                for i, (p, want) in enumerate(zip(ps, b.column("wanted").to_pylist())):
                    if p != last:
                        last, mp = p, np.frombuffer(b.column("mp")[i].as_py(), np.uint64)
                    mx = np.frombuffer(b.column("mx")[i].as_py(), np.uint64)
                    at = np.minimum(np.searchsorted(mp, mx), len(mp) - 1)
                    both = mp[at] == mx
                    np_.append(len(mp)), nx.append(len(mx)), inter.append(int(both.sum()))
                    if want and differences:
                        gone = np.ones(len(mp), bool)
                        gone[at[both]] = False
                        diff.append(np.concatenate([mp[gone], mx[~both]]).view(np.int64))
                    else:
                        diff.append(None)
                yield pa.RecordBatch.from_arrays(
                    [b.column("p"), b.column("x"), pa.array(np_, pa.int64()), pa.array(nx, pa.int64()),
                     pa.array(inter, pa.int64()), pa.array(diff, pa.list_(pa.int64()))],
                    ["p", "x", "np", "nx", "both", "diff"])

    return rows.mapInArrow(run, "p long, x long, np long, nx long, both long, diff array<long>")


def _linked(least: int):
    return F.col("both") * 100 >= (F.col("np") + F.col("nx") - F.col("both")) * least


def remaining_pairs(stars: DataFrame, least: int) -> DataFrame:
    """Pairs (p, x, wanted) of members of one pivot, not both linked to it, that can be linked."""
    s = least / 100.0
    theta = least / (100.0 + least)
    # A member's label is the smallest pivot that it is linked to: members of one label are connected.
    labels = stars.where(_linked(least)).groupBy(F.col("x").alias("_x")).agg(F.min("p").alias("label"))
    rest = stars.where(F.col("diff").isNotNull()).withColumn("linked", _linked(least))
    rest = rest.join(labels, F.col("x") == F.col("_x"), "left").withColumn("label", F.coalesce("label", "x")).drop("_x")
    mixed = (rest.groupBy("p").agg(F.min("linked").alias("_all"), F.min("label").alias("_low"), F.max("label").alias("_high"))
             .where("NOT _all AND _low < _high").select("p"))
    rest = join_grouped(rest, mixed, ["p"], "left_semi")
    # Least number of difference elements a partner must share (partner size chosen to make it smallest).
    other = F.least(F.greatest(F.col("np"), s * F.col("nx")), F.col("nx") / s)
    tau = F.greatest(F.lit(1), F.ceil(theta * (F.col("nx") + other) - F.col("both")
                                      + F.greatest(F.lit(0.0), F.col("np") - other) - 1e-6))
    rest = rest.withColumn("_prefix", F.size("diff") - tau + 1).where("_prefix > 0")
    items = rest.select("p", "x", "np", "nx", "both", "linked", "label", "_prefix", F.size("diff").alias("_size"), F.explode("diff").alias("e"))
    often = items.groupBy("p", "e").agg(F.count("*").alias("_df")).where("_df > 1")
    shared = join_grouped(items, often, ["p", "e"])
    # Elements of one member only come first in order of rarity and match nothing.
    count = F.count("*").over(Window.partitionBy("p", "x"))
    place = F.row_number().over(Window.partitionBy("p", "x").orderBy("_df", "e"))
    # Elements of x from this one on, in order of rarity.
    shared = (shared.withColumn("_on", count - place + 1).where(F.col("_size") - F.col("_on") < F.col("_prefix")))
    side = lambda s: [F.col(c).alias(f"{c}_{s}") for c in ("x", "nx", "both", "linked", "label", "_on")]
    one, two = shared.select("p", "e", "np", *side("a")), shared.select(F.col("p").alias("p2"), F.col("e").alias("e2"), *side("b"))
    # The pair must share this many difference elements, all of them from its first common one on.
    need = theta * (F.col("nx_a") + F.col("nx_b")) + F.col("np") - F.col("both_a") - F.col("both_b") - 1e-6
    on = ((F.col("p") == F.col("p2")) & (F.col("e") == F.col("e2")) & (F.col("x_a") < F.col("x_b"))
          & ~(F.col("linked_a") & F.col("linked_b")) & (F.col("label_a") != F.col("label_b")) & (need <= F.least("_on_a", "_on_b"))
          & (F.col("nx_a") * 100 >= F.col("nx_b") * least) & (F.col("nx_b") * 100 >= F.col("nx_a") * least))
    return one.join(two, on).select(F.col("x_a").alias("p"), F.col("x_b").alias("x"), F.lit(False).alias("wanted")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, least: int = LEAST,
                    bands: tuple[int, int] | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, th) for every row of ``docs`` (doc_id, text);
    ``th`` is xxhash64 of the text (null: empty)."""
    rows, count = bands or BANDS[least]
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), "text")
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    sketch = written(sketches(docs.select("id", th.alias("th"), "text"), shingle, rows, count), "sketches")
    classes = written(sketch.where("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands")), "classes")
    member = classes.select("rep", "copies", F.explode("bands").alias("bucket"))
    bucket = (member.groupBy("bucket").agg(F.count("*").alias("m"), F.max(F.struct("copies", (-F.col("rep")).alias("r"))).alias("top"))
              .where("m > 1").select(F.col("bucket").alias("_b"), (-F.col("top.r")).alias("p")))
    pairs = (join_grouped(member, bucket, ["bucket"], grouped_keys=["_b"]).where("rep != p")
             .select("p", F.col("rep").alias("x")).distinct())
    pairs = written(pairs, "pairs")
    size = pairs.groupBy("p").agg((F.count("*") > 1).alias("wanted"))
    ids = written(pairs.select(F.col("p").alias("id")).union(pairs.select("x")).distinct(), "ids")
    sets = written(full_sets(docs, ids, shingle), "sets")
    stars = written(compare(join_grouped(pairs, size, ["p"]), sets, differences=True), "stars")
    rest = compare(remaining_pairs(stars, least), sets)
    links = (stars.drop("diff").union(rest.drop("diff")).where(_linked(least))
             .select(F.col("p").alias("a"), F.col("x").alias("b")))
    found = components(links)
    discard(sets, stars, pairs, ids)
    of_class = classes.select("set_key", "rep").join(found, F.col("rep") == F.col("node"), "left").select(
        F.col("set_key").alias("_key"), F.coalesce("component", "rep").alias("_component"))
    out = sketch.select("id", "th", "n_shingles", "set_key").join(of_class, F.col("set_key") == F.col("_key"), "left")
    component = F.coalesce("_component", "id")
    null = lambda c: F.when(c != F.lit(NULL_ID), c)
    return out.select(null(F.col("id")).alias("doc_id"), "n_shingles", null(component).alias("component_id"),
                      (F.col("id") == component).alias("kept"), "th")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """``docs`` with one document (the smallest id) of each group; rows that repeat an
    id and its text are one document and stay together."""
    gone = near_duplicates(docs.select("doc_id", "text"), shingle, least).where("NOT kept").select(
        F.col("doc_id").alias("__llm_gone"), F.col("th").alias("__llm_gone_th")).distinct()
    gone = written(gone, "gone")
    side = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    on = F.col("doc_id").eqNullSafe(F.col("__llm_gone")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__llm_gone_th"))
    return docs.join(side, on, "left_anti")


def op7_min_max_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir, "doc_id", "text"), shingle=3, least=85).drop("th")


def oracle(shingle: int = 3, least: int = 85) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    run = lambda n: f"array_to_string(w[i:i + {n} - 1], ' ')"
    return rf"""
    WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w
                             FROM documents),
    sets AS (SELECT DISTINCT doc_id, {run(shingle)} AS s
             FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {shingle - 2}, 2))) AS i FROM texts WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
    met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT x, y FROM met JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * common >= {least} * (p.n + q.n - common)),
    reached AS (SELECT doc_id AS x, doc_id AS y FROM texts UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y),
    least_of AS (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY 1)
    SELECT t.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, t.doc_id = component_id AS kept
    FROM texts t JOIN least_of USING (doc_id) LEFT JOIN sizes USING (doc_id)
    """
