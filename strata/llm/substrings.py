"""Removal of word sequences that an earlier document has, by suffix automata.

A word is removed if it lies in a run of ``WINDOW`` words of its document that is
also a run of words of a document with a smaller id.

The reference is the corpus itself, so automata of all of it cannot be broadcast
within a size bound.  The reference is therefore cut into shards by content, and
each document goes only to the shards that can hold a match of it:

1. Anchors.  The hashes of 8-word runs are winnowed: of every 43 neighbouring ones
   the smallest (rightmost of equal ones) is an anchor.  A window of 50 words has
   exactly 43 of them, so two documents that share a window share an anchor of
   it, at the same place inside it.  Anchors of one document only are dropped.
2. The context of an anchor is the up to 92 words that the windows around it
   reach.  Equal contexts of one anchor are one: all but the smallest id's are
   removed as a whole.
3. The different contexts of an anchor are its reference shard.  In order of id
   they go into suffix automata of at most ``SHARD`` contexts each; before that,
   each context is streamed through the automata of smaller ids, which give for
   every word the longest match ending there (matching statistics).  Spans of at
   least 50 words are removed.
4. An anchor with more than ``MOST`` contexts (a line that stands in many
   documents, say) would be a large group in one task.  A window has at least 21
   words on the left of its anchor or at least 21 on the right of it, so such
   contexts are dealt out once by the 21 words on the left and once by those on
   the right, and the shards are those of anchor and neighbours.  Where even such
   a shard has more than ``MOST`` contexts, its windows are hashed and take the
   smallest id by an aggregation, which is exact as well and of any size.

Defined results: null, empty and blank texts have no words and lose none; equal
ids do not remove from each other, whatever their texts; rows equal in id and
text have equal results; a null id counts as larger than any id; an empty table
gives no rows; other columns are kept by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Words, discard, documents, mix, slices, written
from strata.operators.joins import join_grouped

WINDOW, GRAM = 50, 8
SIDE = (WINDOW - GRAM) // 2
#: Contexts in one automaton, and most contexts of an anchor that one task takes.
SHARD, MOST = 512, 4096
#: Ids are broadcast up to this many (8 bytes each), else joined by a shuffle.
BROADCAST_IDS = 1_000_000
PART = 1 << 19
NULL_ID = (1 << 63) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Runs looked at together: their places in a step fit the low 24 bits.
STEP = 1 << 23
_LOW = np.uint64((1 << 24) - 1)


def _row_key(docs: DataFrame) -> DataFrame:
    """(id, th, text): a row is known by its id and a hash of its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.xxhash64(text).alias("th"), "text")


def _selected(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all 8-word runs, their row offsets, and for every window of a row the
    run it begins with and the run that is its anchor (places among all runs)."""
    per = WINDOW - GRAM + 1
    g, first = w.grams(GRAM)
    if len(g) < per:
        return g, first, np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = []  # of the least hash from each run on, rightmost among ties
    for a in range(0, len(g) - per + 1, STEP):
        part = g[a:a + STEP + per - 1]
        least, span = (part & ~_LOW) | (_LOW - np.arange(len(part), dtype=np.uint64)), 1
        while span * 2 <= per:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[:len(least) - (per - span)], least[per - span:])
        place.append(a + (_LOW - (least & _LOW)).astype(np.int64))
    n = np.diff(first)
    windows = np.maximum(n - per + 1, 0)
    at = np.arange(windows.sum()) - np.repeat(np.concatenate([[0], np.cumsum(windows)[:-1]]), windows) + np.repeat(first[:-1], windows)
    return g, first, at, np.concatenate(place)[at]


def find_anchors(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word places (in all texts of the part) at which an anchor begins, ascending, and their hashes."""
    g, first, _, chosen = _selected(w)
    gram = np.unique(chosen)
    row = np.searchsorted(first, gram, "right") - 1
    return gram - first[row] + w.first[row], g[gram]


def anchors(docs: DataFrame) -> DataFrame:
    """(anchor, context, id, th, at): every anchor, the hash of its context, its word place in the text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PART):
            w = Words(b.column("text"))
            place, gram = find_anchors(w)
            row = np.searchsorted(w.first, place, "right") - 1
            begin = np.maximum(place - (WINDOW - GRAM), w.first[row])
            end = np.minimum(place + WINDOW, w.first[row + 1])
            n = len(w.hash) + 1
            power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE, np.uint64)]))
            back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _INVERSE, np.uint64)]))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.hash * power[:n - 1], dtype=np.uint64)])
            h = (total[end] - total[begin]) * back[begin]
            context = mix(h * np.uint64(3) + ((end - begin) * 64 + (place - begin)).astype(np.uint64))
            rows = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), b.column("id").take(rows),
                 b.column("th").take(rows), pa.array((place - w.first[row]).astype(np.int32))],
                ["anchor", "context", "id", "th", "at"])

    return docs.mapInArrow(run, "anchor long, context long, id long, th long, at int")


class SuffixAutomaton:
    """Of several word sequences; ``longest`` gives matching statistics."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.size = [-1], [0]
        self.sequences = 0

    def add(self, words: list) -> None:
        last = 0
        self.sequences += 1
        nxt, link, size = self.next, self.link, self.size
        for c in words:
            q = nxt[last].get(c)
            if q is not None:  # the sequence so far is known already
                last = q if size[q] == size[last] + 1 else self._clone(last, c, q)
                continue
            new = len(nxt)
            nxt.append({}), link.append(0), size.append(size[last] + 1)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[new] = q if size[q] == size[p] + 1 else self._clone(p, c, q)
            last = new

    def _clone(self, p: int, c, q: int) -> int:
        nxt, link, size = self.next, self.link, self.size
        new = len(nxt)
        nxt.append(dict(nxt[q])), link.append(link[q]), size.append(size[p] + 1)
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        link[q] = new
        return new

    def longest(self, words: list) -> list[int]:
        """For every word the length of the longest known sequence that ends with it."""
        nxt, link, size = self.next, self.link, self.size
        state, n, out = 0, 0, []
        for c in words:
            while c not in nxt[state] and state:
                state = link[state]
                n = size[state]
            if c in nxt[state]:
                state = nxt[state][c]
                n += 1
            out.append(n)
        return out


def spans_of(matches: list[int], least: int) -> list[tuple[int, int]]:
    """Maximal spans [begin, end) covered by matches of at least ``least``."""
    out: list[tuple[int, int]] = []
    for i, n in enumerate(matches):
        if n >= least:
            begin = i + 1 - n
            if out and begin <= out[-1][1]:
                begin = min(begin, out.pop()[0])
            out.append((begin, i + 1))
    return out


def match_group(contexts: list[tuple[int, list]], least: int = WINDOW) -> list[list[tuple[int, int]]]:
    """Spans of each (id, words), ids ascending, that are in one with a smaller id."""
    shards: list[SuffixAutomaton] = []
    waiting: list[list] = []
    out, last = [], None
    for i, words in contexts:
        if i != last:
            for known in waiting:
                if not shards or shards[-1].sequences >= SHARD:
                    shards.append(SuffixAutomaton())
                shards[-1].add(known)
            waiting, last = [], i
        found = [0] * len(words)
        for s in shards:
            found = list(map(max, found, s.longest(words)))
        out.append(spans_of(found, least))
        waiting.append(words)
    return out


def match_contexts(contexts: DataFrame) -> DataFrame:
    """(id, th, begin, end) from (anchor, part, id, th, first, words): the contexts of
    an anchor and part together, in order of id."""
    ordered = contexts.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "id", "th", "first")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []

        def spans() -> list[tuple]:
            found = match_group([(g[1], g[4]) for g in group])
            return [(g[1], g[2], g[3] + a, g[3] + z) for g, s in zip(group, found) for a, z in s]

        names, kinds = ["id", "th", "begin", "end"], [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        pack = lambda out: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        for b in batches:
            out = []
            for a, part, i, th, first, words in zip(*[b.column(c).to_pylist() for c in ("anchor", "part", "id", "th", "first", "words")]):
                if group and group[0][0] != (a, part):
                    out += spans()
                    group = []
                group.append(((a, part), i, th, first, words.split(b" ")))
            if out:
                yield pack(out)
        if group and (out := spans()):
            yield pack(out)

    return ordered.mapInArrow(run, "id long, th long, begin int, end int")


def cut_contexts(wanted: DataFrame, docs: DataFrame, by_neighbours: bool = False) -> DataFrame:
    """(anchor, part, side, place, id, th, first, words) of ``wanted`` (anchor, id, th, at):
    the context's words joined by a space, the anchor's place among them and the
    context's place in its text.  ``by_neighbours``: once for the ``SIDE`` words on
    the left of the anchor (side -1) and once for those on the right (1), ``part``
    being a hash of them; else part and side are 0."""
    per_doc = wanted.groupBy("id", "th").agg(F.collect_list(F.struct("anchor", "at")).alias("places"))
    rows = docs.join(per_doc, ["id", "th"]).select("id", "th", "text", "places")

    def part_of(side: bytes, words: list[bytes]) -> int:
        return int.from_bytes(hashlib.blake2b(side + b" ".join(words), digest_size=8).digest(), "little", signed=True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PART):
            out = []
            for i, th, text, places in zip(*[b.column(c).to_pylist() for c in ("id", "th", "text", "places")]):
                words = text.encode("utf-8").split()
                for p in places:
                    at = p["at"]
                    first = max(0, at - (WINDOW - GRAM))
                    context = b" ".join(words[first:at + WINDOW])
                    left, right = words[max(0, at - SIDE):at], words[at + GRAM:at + GRAM + SIDE]
                    parts = [(0, 0)] if not by_neighbours else [
                        (part_of(k, x), side) for side, k, x in ((-1, b"<", left), (1, b">", right)) if len(x) == SIDE]
                    out += [(p["anchor"], part, side, at - first, i, th, first, context) for part, side in parts]
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 ["anchor", "part", "side", "place", "id", "th", "first", "words"])

    return rows.mapInArrow(run, "anchor long, part long, side int, place int, id long, th long, first int, words binary")


def match_windows(contexts: DataFrame) -> DataFrame:
    """(id, th, begin, end) as ``match_contexts``, by hashes of single windows (any
    number of contexts).  A window is taken once: by the context of its own anchor
    and by one of the anchor's sides."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "words", PART):
            _, runs, begins, chosen = _selected(Words(b.column("words")))
            row = np.searchsorted(runs, begins, "right") - 1
            begin, anchor = begins - runs[row], chosen - runs[row]
            place, side = (np.asarray(b.column(c))[row] for c in ("place", "side"))
            left = place - begin >= SIDE  # the window holds the left neighbours
            own = (anchor == place) & ((side == 0) | (left == (side < 0)))
            row, begin = row[own], begin[own]
            words = [x.split(b" ") for x in b.column("words").to_pylist()]
            h = [hashlib.blake2b(b" ".join(words[r][k:k + WINDOW]), digest_size=16).digest() for r, k in zip(row.tolist(), begin.tolist())]
            at = pa.array(row, pa.int64())
            start = (np.asarray(b.column("first"))[row] + begin).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.binary()), b.column("id").take(at), b.column("th").take(at), pa.array(start)],
                                             ["h", "id", "th", "begin"])

    windows = contexts.mapInArrow(run, "h binary, id long, th long, begin int")
    owner = windows.groupBy("h").agg(F.min("id").alias("owner"), F.max("id").alias("_last")).where("owner < _last").select("h", "owner")
    return join_grouped(windows, owner, ["h"]).where("id > owner").select("id", "th", "begin", (F.col("begin") + WINDOW).alias("end"))


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(id, th, spans array<struct<begin, end>>) of the words to remove, for rows with any."""
    found = written(anchors(rows), "anchors")
    shared = found.groupBy("anchor").agg(F.min("id").alias("_a"), F.max("id").alias("_z")).where("_a < _z").select("anchor")
    hits = written(join_grouped(found, shared, ["anchor"]), "hits")
    discard(found)
    owner = written(hits.groupBy("anchor", "context").agg(F.min(F.struct("id", "th", "at")).alias("own")), "owners")
    many = owner.groupBy("anchor").agg(F.count("*").alias("contexts")).where("contexts > 1")
    copies = (hits.join(owner.select("anchor", "context", F.col("own.id").alias("first_id")), ["anchor", "context"])
              .where("id > first_id").select("id", "th", F.greatest(F.col("at") - (WINDOW - GRAM), F.lit(0)).alias("begin"),
                                             (F.col("at") + WINDOW).alias("end")))
    wanted = written(join_grouped(owner, many, ["anchor"]).select("anchor", "own.*", "contexts"), "wanted")
    ids = wanted.select("id").distinct()
    holders = rows.join(F.broadcast(ids), "id", "left_semi") if ids.count() <= BROADCAST_IDS else rows
    few, most = wanted.where(f"contexts <= {MOST}"), wanted.where(f"contexts > {MOST}")
    spans = copies.union(match_contexts(cut_contexts(few, holders)))
    if not most.isEmpty():
        dealt = written(cut_contexts(most, holders, by_neighbours=True), "contexts")
        size = dealt.groupBy("anchor", "part").agg(F.count("*").alias("_n")).where("_n > 1")
        dealt = join_grouped(dealt, size, ["anchor", "part"])
        spans = spans.union(match_contexts(dealt.where(f"_n <= {MOST}").drop("_n")))
        if not size.where(f"_n > {MOST}").isEmpty():
            spans = spans.union(match_windows(dealt.where(f"_n > {MOST}")))
    out = written(spans.groupBy("id", "th").agg(F.collect_set(F.struct("begin", "end")).alias("spans")), "spans")
    discard(hits, owner, wanted)
    return out


def kept_words(text: str | None, spans: list[dict] | None) -> tuple[int, list[bytes]]:
    words = (text or "").encode("utf-8").split()
    if not spans:
        return len(words), words
    gone = bytearray(len(words))
    for s in spans:
        a, z = s["begin"], min(s["end"], len(words))
        gone[a:z] = b"\x01" * (z - a)
    return len(words), [w for w, g in zip(words, gone) if not g]


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__llm_spans`` (null where nothing is removed); texts without spans are not shuffled."""
    key = _row_key(docs)
    spans = repeated_spans(key)
    ids = spans.select("id").distinct()
    keyed = docs.withColumn("__llm_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))).withColumn(
        "__llm_th", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    named = spans.select(F.col("id").alias("__llm_i"), F.col("th").alias("__llm_t"), F.col("spans").alias("__llm_spans"))
    on = (F.col("__llm_id") == F.col("__llm_i")) & (F.col("__llm_th") == F.col("__llm_t"))
    if ids.count() > BROADCAST_IDS:
        return keyed.join(named, on, "left").drop("__llm_id", "__llm_th", "__llm_i", "__llm_t")
    touched = F.broadcast(ids.withColumnRenamed("id", "__llm_touched"))
    clean = keyed.join(touched, F.col("__llm_id") == F.col("__llm_touched"), "left_anti").withColumn(
        "__llm_spans", F.lit(None).cast(spans.schema["spans"].dataType))
    other = keyed.join(touched, F.col("__llm_id") == F.col("__llm_touched"), "left_semi").join(named, on, "left")
    return clean.drop("__llm_id", "__llm_th").union(other.drop("__llm_id", "__llm_th", "__llm_i", "__llm_t"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeats taken out of ``text``: kept words joined by one space
    where any was removed, the text as it was elsewhere; ``n_chars`` follows."""
    names = docs.columns

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        rows = zip(texts.to_pylist(), spans.to_pylist())
        return pa.array([b" ".join(kept_words(t, s)[1]).decode("utf-8") if s else t for t, s in rows], pa.string())

    out = with_spans(docs).withColumn("text", F.when(F.col("__llm_spans").isNull(), F.col("text")).otherwise(cut("text", "__llm_spans")))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("__llm_spans").isNull(), F.col("n_chars")).otherwise(
            F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*[F.col(f"`{c}`") for c in names])


def op10_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            n, gone, sha = [], [], []
            for text, spans in zip(b.column("text").to_pylist(), b.column("__llm_spans").to_pylist()):
                total, kept = kept_words(text, spans)
                n.append(total), gone.append(total - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    docs = with_spans(documents(spark, sf_dir, "doc_id", "text"))
    return docs.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def oracle(window: int = WINDOW) -> str:
    return rf"""
    WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
    windows AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + {window - 1}], ' ')) AS h
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - {window - 2})) AS i FROM texts)),
    owners AS (SELECT h, min(doc_id) AS owner FROM windows GROUP BY h),
    gone AS (SELECT DISTINCT doc_id, i + k AS i FROM windows JOIN owners USING (h), range({window}) AS r(k) WHERE doc_id > owner),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM texts t LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1) g USING (doc_id)
    """
