"""Phrase collocations from an FM-index per shard.

A phrase is a run of words inside a piece of a text (pieces end at ``.,;:!?`` and
line ends; A-Z folded), counted per language.  For every phrase of 2 to ``depth``
words that is found often enough, the weakest cut of it into two parts gives its
score, ``floor(10^6 * a * a / (l * r))``.

* A shard is about ``SHARD`` words of whole texts.  Its words (with their language)
  get ids in the shard, a separator stands between pieces, and the rows of the
  index are the text positions in the order of their first words, as deep as the
  phrases asked for: down to that depth the intervals are those of the full
  index.  ``Index`` holds the transformed text (the symbol before each row), and
  ``extend`` extends all intervals of a level by all symbols at once.
* The index is bidirectional: rows of the text extend a phrase to the left, rows of
  the reversed text to the right, and an extension in one gives the interval in
  the other by the number of smaller symbols in the extended interval.
* Levels.  Shards give counts of words; sums across shards that reach ``least``
  are the frequent words.  Only phrases of frequent words are enumerated next, and
  only those of k words whose first and last k-1 words are frequent after that.
  The frequent phrases of a level go to the shards as a Bloom filter of fixed size
  (``BITS``): it keeps every frequent phrase, whatever else it keeps falls by the
  exact sum.  So every phrase with a count of ``least`` or more is counted exactly.

Sums, cuts, the rule on longer phrases and the ranking are joins and aggregates of
the written levels; products are decimals of 38 digits (exact for counts under 10^15).
Word and language are known in the shuffle by a 64-bit hash.

Defined results: a null lang is ``und``; null and empty texts have no words; repeated
rows count as often as they are there; ties go by the shortest first part, then by
the order stated at ``ranked``; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import Words, discard, documents, mix, slices, written

DEPTH, LEAST, SHARE, TOP = 3, 10, 50, 2000
#: Words of a shard (a longer text is a shard of its own).
SHARD = 750_000
#: Bits of the filter of frequent phrases that every shard is sent (8 MB).
BITS = 1 << 26

_PIECE = np.zeros(256, np.uint8)
_PIECE[[*b".,;:!?\n\x0b\x0c\r"]] = 1
_APART = _PIECE.astype(bool)
_APART[[0x20, 0x09]] = True


# ------------------------------------------------------------------ one shard


def sequence(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, Words, np.ndarray]:
    """Hashes of the words of all texts with a 0 before each piece, the place of each
    word in them, the words, and the row of each word."""
    w = Words(batch.column("text"), lower=True, space=_APART)
    row = np.repeat(np.arange(batch.num_rows), w.counts)
    langs, of = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
    lang = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs], np.uint64)
    if not len(row):
        return np.zeros(1, np.uint64), row, w, row
    h = np.maximum(mix(w.hash ^ lang[of][row]), np.uint64(1))
    piece = np.cumsum(_PIECE[w.data])[w.start]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (piece[1:] != piece[:-1])
    at = np.arange(len(row)) + np.cumsum(fresh)
    out = np.zeros(at[-1] + 1, np.uint64)
    out[at] = h
    return out, at, w, row


class Index:
    """Rows: positions of ``ids`` (0 parts pieces) in the order of the ``depth`` symbols from
    there on; ``before``: the symbol in front of each row; ``first``: where the rows of
    each symbol begin."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.size = int(ids.max(initial=0)) + 1
        rank, ranks = ids, self.size
        for j in range(1, depth):
            key = rank * self.size + np.roll(ids, -j)
            rank = np.unique(key, return_inverse=True)[1] if j + 1 < depth and ranks * self.size ** 2 >= 1 << 62 else key
            ranks *= self.size
        order = np.argsort(rank, kind="stable")
        self.before = np.roll(ids, 1)[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=self.size))])
        self._last_to_first: np.ndarray | None = None

    def last_to_first(self, rows: np.ndarray) -> np.ndarray:
        """The row of the position in front of each row."""
        if self._last_to_first is None:
            self._last_to_first = np.empty(len(self.before), np.int64)
            self._last_to_first[np.argsort(self.before, kind="stable")] = np.arange(len(self.before))
        return self._last_to_first[rows]

    def extend(self, low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """All extensions of the intervals [low, low + count) by one symbol: (interval,
        symbol, occurrences, a row of this index before them, smaller symbols)."""
        start = np.cumsum(count) - count
        rows = np.arange(int(count.sum())) + np.repeat(low - start, count)
        of = np.repeat(np.arange(len(low)), count)
        key = of * self.size + self.before[rows]
        order = np.argsort(key, kind="stable")
        key = key[order]
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        n = np.diff(np.append(cut, len(key)))
        interval, symbol = np.divmod(key[cut], self.size)
        real = symbol > 0  # a phrase does not reach over the end of a piece
        return interval[real], symbol[real], n[real], rows[order[cut[real]]], (cut - start[interval])[real]


def phrases(h: np.ndarray, length: int, frequent: Sequence[np.ndarray | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the words (one array a place) and occurrences of the phrases of ``length``
    words in ``h``.  ``frequent[k]``: filter of the frequent phrases of k words, if any."""
    names, ids = np.unique(np.append(h, np.uint64(0)), return_inverse=True)  # 0 is always there, as id 0
    text, back = Index(ids, 1), Index(ids[::-1], length - 1) if length > 2 else None
    word = np.arange(1, text.size)
    low, count = text.first[word], np.diff(text.first)[word]
    if length == 1:
        return [names[word]], count
    # To the left in the text; the interval in the reversed text follows.
    of, symbol, n, _, smaller = text.extend(low, count)
    found = [symbol, word[of]]
    for k in range(2, length):
        hold = _may(frequent[k], [names[x] for x in found])
        found, n = [x[hold] for x in found], n[hold]
        if k == 2:
            reverse = back.first[found[1]] + smaller[hold]
        else:
            reverse = reverse[hold]
        # To the right: the rows of the reversed text that begin with the phrase read backwards.
        of, symbol, n, row, _ = back.extend(reverse, n)
        reverse = back.last_to_first(row) if k + 1 < length else reverse
        found = [x[of] for x in found] + [symbol]
        hold = _may(frequent[k], [names[x] for x in found[1:]])
        found, n = [x[hold] for x in found], n[hold]
        if k + 1 < length:
            reverse = reverse[hold]
            smaller = None
    return [names[x] for x in found], n


# ------------------------------------------------------------------ filters of frequent phrases


def _places(h: Sequence[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    g = h[0]
    for i, x in enumerate(h[1:], 1):
        turn = np.uint64(21 * i % 64)
        g = g ^ (x << turn | x >> (np.uint64(64) - turn))
    return g & np.uint64(bits - 1), g >> np.uint64(32) & np.uint64(bits - 1)


def _may(bits: np.ndarray | None, h: Sequence[np.ndarray]) -> np.ndarray:
    """Which phrases the filter keeps (all, without one)."""
    hold = np.ones(len(h[0]), bool)
    if bits is not None:
        for p in _places(h, 8 * len(bits)):
            hold &= (bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return hold


def filter_of(level: DataFrame, length: int, bits: int = BITS) -> np.ndarray:
    """The filter of the phrases h1..h``length`` of ``level``; at most ``bits`` / 8 bytes reach the driver."""
    g = F.col("h1")
    for i in range(1, length):
        turn = 21 * i % 64
        x = F.col(f"h{i + 1}")
        g = g.bitwiseXOR(F.shiftleft(x, turn).bitwiseOR(F.shiftrightunsigned(x, 64 - turn)))
    low = lambda x: x.bitwiseAND(F.lit(bits - 1))
    place = level.select(F.explode(F.array(low(g), low(F.shiftrightunsigned(g, 32)))).alias("p")).select((F.col("p") + 1).alias("p"))
    parts = (place.groupBy(F.bitmap_bucket_number("p").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("part")))
    out = np.zeros(bits // 8, np.uint8)
    for r in parts.collect():
        part = np.frombuffer(r["part"], np.uint8)[:len(out)]
        out[(r["bucket"] - 1) * 4096:][:len(part)] = part
    return out


# ------------------------------------------------------------------ sums across shards


def _shards(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[list[pa.RecordBatch]]:
    held, n = [], 0
    for b in slices(batches, "text"):
        held.append(b)
        n += b.column("text").nbytes // 6
        if n >= words:
            yield held
            held, n = [], 0
    if held:
        yield held


def words(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """(h1, lang, word, n): the words of ``docs`` (lang, text) and their counts, summed across shards."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _shards(batches, shard):
            hashes, langs, spelt, count = [], [], [], []
            for b in held:
                h, at, w, row = sequence(b)
                names, place = np.unique(h[at], return_index=True)
                (names_of,), n = phrases(h, 1, [])
                hashes.append(names_of), count.append(n)
                langs += b.column("lang").take(pa.array(row[place])).to_pylist()
                spelt += [w.data[a:z].tobytes().lower() for a, z in zip(w.start[place].tolist(), w.end[place].tolist())]
            names, place, of = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
            n = np.bincount(of, np.concatenate(count), len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), pa.array(langs, pa.string()).take(pa.array(place)),
                 pa.array(spelt, pa.binary()).take(pa.array(place)).cast(pa.string()), pa.array(n)], ["h1", "lang", "word", "n"])

    return (docs.mapInArrow(run, "h1 long, lang string, word string, n long")
            .groupBy("h1", "lang", "word").agg(F.sum("n").alias("n")))


def level(docs: DataFrame, length: int, frequent: Sequence[np.ndarray | None], least: int = LEAST, shard: int = SHARD) -> DataFrame:
    """(h1..h``length``, n): the phrases of ``length`` words found ``least`` times or more."""
    names = [f"h{i + 1}" for i in range(length)]
    sent = docs.sparkSession.sparkContext.broadcast(list(frequent))  # fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = sent.value
        for held in _shards(batches, shard):
            parts = []
            for b in held:
                h = sequence(b)[0]
                h[~_may(filters[1], [h])] = 0  # no frequent phrase holds another word
                parts.append(h)
            found, n = phrases(np.concatenate(parts), length, filters)
            yield pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64)) for x in found), pa.array(n)], [*names, "n"])

    out = docs.mapInArrow(run, ", ".join(f"{x} long" for x in [*names, "n"]))
    return out.groupBy(*names).agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def collocations(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, share: int = SHARE, shard: int = SHARD,
                 bits: int = BITS) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all candidates of 2 to ``depth`` words that no longer
    candidate with at least ``share`` percent of their count holds; ``docs``: lang, text."""
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    every = written(words(docs, shard), "words")
    total = every.groupBy(F.col("lang").alias("_lang")).agg(F.sum("n").alias("total"))
    levels: list[DataFrame] = [None, written(every.where(F.col("n") >= least), "level")]  # type: ignore[list-item]
    filters: list[np.ndarray | None] = [None, filter_of(levels[1], 1, bits)]
    for k in range(2, depth + 1):
        levels.append(written(level(docs, k, filters, least, shard), "level"))
        if k < depth:
            filters.append(filter_of(levels[k], k, bits))
    found = []
    for k in range(2, depth + 1):
        longer = [d for d in range(k + 1, depth + 1)]
        found.append(_spelt(_scored(_outstanding(levels, k, longer, share), levels, k), levels[1], k))
    every_found = written(reduce(DataFrame.unionByName, found), "found")
    # A handful of rows: one a language.
    out = every_found.join(written(total, "total"), F.col("lang") == F.col("_lang")).select(
        "lang", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
    discard(every, *levels[1:])
    return out


def _outstanding(levels: Sequence[DataFrame], k: int, longer: Sequence[int], share: int) -> DataFrame:
    """The phrases of ``k`` words (h1.., a) without those inside a longer one that is found often enough."""
    names = [f"h{i + 1}" for i in range(k)]
    own = levels[k].withColumnRenamed("n", "a")
    if not longer:
        return own
    inside = reduce(DataFrame.unionByName, [
        levels[d].select(*[F.col(f"h{s + i + 1}").alias(f"_{names[i]}") for i in range(k)], "n")
        for d in longer for s in range(d - k + 1)])
    most = written(inside.groupBy(*[f"_{x}" for x in names]).agg(F.max("n").alias("_most")), "most")
    on = reduce(Column.__and__, [F.col(x) == F.col(f"_{x}") for x in names])
    return (own.join(most, on, "left").where(F.col("_most").isNull() | (F.col("_most") * 100 < F.col("a") * share))
            .select(*names, "a"))


def _scored(rows: DataFrame, levels: Sequence[DataFrame], k: int) -> DataFrame:
    """``rows`` with l, r and score of the lowest-scoring cut (ties: the shortest first part)."""
    names = [f"h{i + 1}" for i in range(k)]
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    for cut in range(1, k):
        for part, side in ((names[:cut], "l"), (names[cut:], "r")):
            other = levels[len(part)].select(*[F.col(f"h{i + 1}").alias(f"_p{i}") for i in range(len(part))], F.col("n").alias(f"{side}{cut}"))
            on = reduce(Column.__and__, [F.col(x) == F.col(f"_p{i}") for i, x in enumerate(part)])
            rows = rows.join(other, on).drop(*[f"_p{i}" for i in range(len(part))])
        score = F.expr(f"(cast(1000000 AS decimal(7,0)) * (cast(a AS decimal(15,0)) * cast(a AS decimal(15,0))))"
                       f" div (cast(l{cut} AS decimal(15,0)) * cast(r{cut} AS decimal(15,0)))")
        rows = rows.withColumn(f"_cut{cut}", F.struct(score.cast("long").alias("score"), F.lit(cut).alias("k"),
                                                      F.col(f"l{cut}").alias("l"), F.col(f"r{cut}").alias("r")))
    cuts = [F.col(f"_cut{c}") for c in range(1, k)]
    lowest = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return rows.withColumn("_low", lowest).select(*names, "a", "_low.l", "_low.r", "_low.score")


def _spelt(rows: DataFrame, spelling: DataFrame, k: int) -> DataFrame:
    for i in range(1, k + 1):
        cols = [F.col("h1").alias("_h"), F.col("word").alias(f"w{i}"), *([F.col("lang")] if i == 1 else [])]
        rows = rows.join(spelling.select(*cols), F.col(f"h{i}") == F.col("_h")).drop("_h")
    return rows.select("lang", F.concat_ws(" ", *[f"w{i}" for i in range(1, k + 1)]).alias("phrase"), "a", "l", "r", "score")


def ranked(found: DataFrame, top: int = TOP, parts: int = 64) -> DataFrame:
    """Each language's first ``top`` by score and count (descending) and phrase; first in ``parts``
    groups of a language, so no task ranks all candidates of one."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    first = (found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
             .where(F.col("rank") <= top).drop("rank", "part"))
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op12_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language."""
    return ranked(collocations(documents(spark, sf_dir, "lang", "text")))


def oracle(least: int = LEAST, share: int = SHARE, top: int = TOP) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    WITH texts AS (SELECT row_number() OVER () AS t, coalesce(lang, 'und') AS lang, translate(text, '{upper}', '{lower}') AS text FROM documents),
    pieces AS (SELECT t, lang, unnest(p) AS piece, generate_subscripts(p, 1) AS k
               FROM (SELECT t, lang, regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]') AS p FROM texts)),
    words AS (SELECT t, lang, k, unnest(w) AS word, generate_subscripts(w, 1) AS i
              FROM (SELECT t, lang, k, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces)),
    runs AS (SELECT lang, word AS w1, lead(word) OVER s AS w2, lead(word, 2) OVER s AS w3 FROM words
             WINDOW s AS (PARTITION BY t, k ORDER BY i)),
    f1 AS (SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL),
    f2 AS (SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL),
    f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {least}),
    total AS (SELECT lang, count(*) AS n FROM words GROUP BY 1),
    two AS (SELECT b.lang, b.w1 || ' ' || b.w2 AS phrase, b.f AS a, x.f AS l, y.f AS r, 1 AS k
            FROM f2 b JOIN f1 x ON x.lang = b.lang AND x.w1 = b.w1 JOIN f1 y ON y.lang = b.lang AND y.w1 = b.w2
            WHERE b.f >= {least} AND NOT EXISTS (
                SELECT 1 FROM f3 c WHERE c.lang = b.lang AND 100 * c.f >= {share} * b.f
                AND (c.w1 = b.w1 AND c.w2 = b.w2))
            AND NOT EXISTS (
                SELECT 1 FROM f3 c WHERE c.lang = b.lang AND 100 * c.f >= {share} * b.f
                AND (c.w2 = b.w1 AND c.w3 = b.w2))),
    three AS (SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3 AS phrase, c.f AS a, x.f AS l, y.f AS r, 1 AS k
              FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1
              JOIN f2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
              UNION ALL
              SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, x.f, y.f, 2
              FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2
              JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w3),
    cuts AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM (FROM two UNION ALL FROM three)),
    best AS (SELECT lang, phrase, a, l, r, score FROM cuts
             QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT lang, rank, phrase, a, l, r, n, score
    FROM (SELECT b.*, t.n, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
          FROM best b JOIN total t USING (lang))
    WHERE rank <= {top}
    """
