"""Ranked lexical search by presence masks.

For every item (a query text) the documents with the highest term-weight scores.
The score of a document is the sum over the item's terms, repeats included, of

    w * ((1000000000 * tf) div (1000 * tf + 12 * m)),   m = 75 + (25 * n * N) div L

with w = floor(1000 * ln((2N + 2) / (2df + 1))) >= 0.

* Index.  One pass over all documents keeps, per document, its number of terms and
  the occurrences of the terms that some item asks for (whole texts, exact terms).
  It is written once; N, L and every df are sums over it.
* Search.  A slice of documents becomes a presence bit matrix and a matrix of
  contributions, which do not depend on the item.  For an item, the bits of its
  terms are packed into one mask a document and the documents are grouped by mask.
  A mask's maximum score is the sum of the largest contributions that its terms
  have in the slice.  Masks are evaluated in descending order of that maximum and
  the item is finished when it is below the score of the last place held: no
  document of the remaining masks can enter, not even by a tie.  The places won are
  kept from slice to slice of a task.
* Merge.  Each task gives at most ``top`` documents an item; these are ranked in
  256 groups by id first and then together, so no task ranks more than
  256 * ``top`` rows of an item however many tasks there were.

Items are dealt into blocks of about ``BLOCK_BYTES`` of text (one block unless the
items are many), and each block makes its own pass: the terms of one block are what
a worker is sent.

Defined results: null and empty texts of documents or items have no terms and give
no rows (documents without terms do not count in N); items that repeat id and text
count once, items with one id and different texts are ranked apart under that id;
repeated rows of documents are ranked as so many documents; a null doc_id comes
after all others; equal scores go by ascending doc_id; empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import discard, documents, slices, written

TOP = 20
#: Text bytes of the items that one pass answers.
BLOCK_BYTES = 1 << 22
#: Cells (terms x documents) of a slice's matrices.
CELLS = 1 << 22
#: Bytes of a text whose terms are held at once.
PART = 1 << 20
NULL_ID = (1 << 63) - 1

#: Bytes of the UTF-8 form that belong to a term: ASCII digits and letters and all that is not ASCII.
_TERMS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def term_counts(text: bytes | None) -> Counter:
    """Occurrences of the terms of a UTF-8 text, A-Z folded."""
    if not text:
        return Counter()
    found: Counter = Counter()
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + PART)
        to = gap.start() if gap else len(text)
        found.update(_TERMS.findall(text[at:to].lower()))
        at = to
    return found


def index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf): number of terms of every document that has one, and how
    often it holds those of ``vocabulary``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows, n, terms, tf, ends = [], [], [], [], [0]
            for i, text in enumerate(b.column("text").cast(pa.binary()).to_pylist()):
                found = term_counts(text)
                if not found:
                    continue
                rows.append(i), n.append(found.total())
                for t in found.keys() & vocabulary.keys():
                    terms.append(vocabulary[t]), tf.append(found[t])
                ends.append(len(terms))
            lists = lambda v, kind: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, kind))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(rows, pa.int32())), pa.array(n, pa.int64()),
                 lists(terms, pa.int32()), lists(tf, pa.int64())], ["doc_id", "n", "terms", "tf"])

    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<long>")


class Item:
    """The distinct terms of an item, how often it has each, and the places won so far."""

    def __init__(self, terms: Counter):
        self.terms = np.array(sorted(terms), np.int64)
        self.times = np.array([terms[t] for t in sorted(terms)], np.int64)
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def masks(self, present: np.ndarray) -> np.ndarray:
        """One mask of 64-bit words a document (documents x words) of the terms it holds."""
        bits = np.packbits(present[self.terms], axis=0, bitorder="little")
        wide = np.zeros((present.shape[1], -(-len(bits) // 8) * 8), np.uint8)
        wide[:, :len(bits)] = bits.T
        return wide.view("<u8")

    def search(self, present: np.ndarray, gain: np.ndarray, most: np.ndarray, ids: np.ndarray, top: int) -> int:
        """Evaluate the documents of a slice (``gain``: contributions, terms x documents;
        ``most``: the largest of each term); returns how many were evaluated."""
        masks = self.masks(present)
        if masks.shape[1] == 1:
            groups, of = np.unique(masks[:, 0], return_inverse=True)
            groups = groups[:, None]
        else:
            groups, of = np.unique(masks, axis=0, return_inverse=True)
        held = np.unpackbits(np.ascontiguousarray(groups).view(np.uint8), axis=1, bitorder="little")[:, :len(self.terms)]
        bound = held.astype(np.int64) @ (self.times * most[self.terms])
        order = np.argsort(-bound, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        rank = place[of.ravel()]
        docs = np.argsort(rank, kind="stable")
        ends = np.cumsum(np.bincount(rank, minlength=len(order)))  # documents up to and with each mask
        done = mask = 0
        while mask < len(order) and bound[order[mask]] > 0:
            least = self.scores[-1] if len(self.scores) == top else 0
            if bound[order[mask]] < least:
                break
            # The next masks: as many as hold some documents, none that is already out of reach.
            to = int(np.searchsorted(ends, done + max(2 * top, done), "left")) + 1
            to = min(to, mask + int(np.searchsorted(-bound[order[mask:]], -max(least, 1), "right")))
            chosen = docs[done:ends[to - 1]]
            self.keep(ids[chosen], self.times @ gain[np.ix_(self.terms, chosen)], top)
            done, mask = int(ends[to - 1]), to
        return done

    def keep(self, ids: np.ndarray, scores: np.ndarray, top: int) -> None:
        ids, scores = np.concatenate([self.ids, ids[scores > 0]]), np.concatenate([self.scores, scores[scores > 0]])
        best = np.lexsort((ids, -scores))[:top]
        self.ids, self.scores = ids[best], scores[best]


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def search(postings: DataFrame, items: list[Counter], weight: np.ndarray,
           n_docs: int, n_terms: int, top: int = TOP, cells: int = CELLS) -> DataFrame:
    """(item, doc_id, score): the best ``top`` documents of each task for each item (its place in ``items``)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [Item(terms) for terms in items]
        step = max(1, cells // max(len(weight), 1))
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                b = batch.slice(a, step)
                ids = b.column("doc_id").to_numpy()
                n = b.column("n").to_numpy().astype(np.int64)
                terms, tf = b.column("terms"), b.column("tf").flatten().to_numpy().astype(np.int64)
                row = np.repeat(np.arange(len(ids)), np.diff(terms.offsets.to_numpy()))
                at = terms.flatten().to_numpy()
                m = 75 + (25 * n * n_docs) // n_terms
                present = np.zeros((len(weight), len(ids)), bool)
                present[at, row] = True
                gain = np.zeros((len(weight), len(ids)), np.int64)
                gain[at, row] = weight[at] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))
                most = gain.max(axis=1, initial=0)
                for x in asked:
                    x.search(present, gain, most, ids, top)
        at = np.repeat(np.arange(len(asked), dtype=np.int32), [len(x.ids) for x in asked])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(np.concatenate([x.ids for x in asked])), pa.array(np.concatenate([x.scores for x in asked]))],
            ["item", "doc_id", "score"])

    return postings.mapInArrow(run, "item int, doc_id long, score long")


def ranked(docs: DataFrame, queries: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES, cells: int = CELLS) -> DataFrame:
    """(item_id, rank, doc_id, score) for ``queries`` (item_id, text) over ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    queries = queries.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    item_type = queries.schema["item_id"].dataType.simpleString()
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    empty = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, [
        found for k in range(blocks)
        if (found := _block(docs, queries.where(block == k).collect(), top, item_type, cells)) is not None] or [empty])


def _block(docs: DataFrame, rows: list, top: int, item_type: str, cells: int) -> DataFrame | None:
    counted = [(r["item_id"], term_counts(r["text"].encode())) for r in rows]
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in counted for t in c}))}
    asked = [(i, Counter({vocabulary[t]: n for t, n in c.items()})) for i, c in counted if c]
    if not asked:
        return None
    postings = written(index(docs, vocabulary), "postings")
    n_docs, n_terms = postings.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    # At most one row a term of the block.
    for r in postings.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
        df[r["t"]] = r["df"]
    won = written(search(postings, [c for _, c in asked], weights(df, n_docs), n_docs, n_terms, top, cells), "won")
    discard(postings)

    def best(frame: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id")
        return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    first = best(won.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(256))), "item", "part").drop("rank", "part")
    names = docs.sparkSession.createDataFrame([(k, i) for k, (i, _) in enumerate(asked)], f"item int, item_id {item_type}")
    # One row an item of the block, which BLOCK_BYTES bounds.
    return best(first, "item").join(F.broadcast(names), "item").select("item_id", "rank", F.nullif("doc_id", F.lit(NULL_ID)).alias("doc_id"), "score")


def op13_presence_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest-scoring documents of every benchmark item."""
    return ranked(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def oracle(top: int = TOP) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    terms = rf"unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
    return rf"""
    WITH postings AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {terms} AS term FROM documents) GROUP BY 1, 2),
    sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY 1),
    corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
    items AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {terms} AS term FROM benchmark) GROUP BY 1, 2),
    weight AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
               FROM postings, corpus GROUP BY 1),
    scores AS (SELECT i.item_id, p.doc_id, sum(i.times * w.w * ((1000000000 * p.tf) //
                      (1000 * p.tf + 12 * (75 + (25 * s.n * c.docs) // c.terms))))::BIGINT AS score
               FROM items i JOIN postings p USING (term) JOIN weight w USING (term) JOIN sizes s USING (doc_id), corpus c
               GROUP BY 1, 2)
    SELECT item_id, rank, doc_id, score
    FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
          FROM scores WHERE score > 0)
    WHERE rank <= {top}
    """
