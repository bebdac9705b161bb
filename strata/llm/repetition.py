"""Quality rules from the suffix array of a text.

The words of a text are sorted as suffixes (prefix doubling on the ranks of all
texts of a batch at once; a suffix ends with its text), and the longest common
prefixes of neighbouring suffixes give the longest repeat that starts at each
word.  Longest-common-prefix intervals are the repeated substrings that cannot
be extended to the right; those preceded by different words cannot be extended
to the left either and are the maximal repeats.  The spans of all repeats of at
least ``min_words`` words are united.  A text is rejected if they cover more
than ``max_covered`` of its words, or if one repeat is longer than
``max_longest`` of its words (and than ``min_longest`` words).

Defined results: a null, empty or blank text has no words and covers nothing
(ratio 0, not rejected by this rule); equal texts get equal figures; very long
texts are whole; an empty table gives no rows; other columns are kept by
``repetition`` only under ``doc_id``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Words, documents, slices

#: Repeats shorter than this many words are ordinary language.
MIN_WORDS = 8
#: Largest fraction of words that repeats may cover.
MAX_COVERED = 0.25
#: A single repeat may be this fraction of the words, and any repeat this long is let pass.
MAX_LONGEST, MIN_LONGEST = 0.15, 20
#: Base rules.
BASE_WORDS, BASE_WINDOW, BASE_PERCENT = 20, 8, 30
SYMBOLS = b"#*$%&|<>"


def suffix_array(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of all texts together and the lcp of each suffix with the one
    before it (0 where the text changes).  ``first``: row offsets of the texts."""
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = np.repeat(first[1:], np.diff(first))
    # Ranks start from (text, word); every later key keeps that order.
    order = np.lexsort((symbols, text))
    same = (symbols[order][1:] == symbols[order][:-1]) & (text[order][1:] == text[order][:-1])
    head = np.concatenate([[0], np.where(same, 0, np.arange(1, n))])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(head)
    # Places in the order whose suffix agrees with the one before it so far.
    done = np.concatenate([[False], same])
    width = 1
    while done.any():
        # Sort again only suffixes in groups of more than one.
        group_next = np.append(done[1:], False)
        open_ = np.flatnonzero(done | group_next)
        at = order[open_]
        nxt = at + width
        key = np.where(nxt < end[at], rank[np.minimum(nxt, n - 1)] + 1, 0)
        old = rank[at]
        again = np.lexsort((key, old))
        at, key, old = at[again], key[again], old[again]
        order[open_] = at
        equal = np.concatenate([[False], (key[1:] == key[:-1]) & (old[1:] == old[:-1]) & (key[1:] > 0)])
        # Ranks are the place of the first of a group in the whole order.
        new = np.where(equal, 0, open_)
        rank[at] = np.maximum.accumulate(new)
        done = np.zeros(n, bool)
        done[open_] = equal
        width *= 2
    return order, _lcp(symbols, order, end)


def _lcp(symbols: np.ndarray, order: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Common prefix of every suffix with its predecessor in the order, found from
    the text order: it shrinks by at most one from one place to the next (Kasai),
    so runs are measured where they begin and count down inside."""
    n = len(order)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.where(place > 0, order[np.maximum(place - 1, 0)], -1)
    phi = before.copy()
    same_text = (phi >= 0) & (end[np.maximum(phi, 0)] == end)
    # A place is reducible if the word before it equals the word before its
    # predecessor: its lcp is then one less than the lcp of the place before.
    i = np.arange(n)
    reducible = same_text & (i > 0) & (phi > 0)
    left, left_phi = np.maximum(i - 1, 0), np.maximum(phi - 1, 0)
    reducible &= (end[left] == end) & (end[left_phi] == end) & (symbols[left] == symbols[left_phi])
    plcp = np.zeros(n, np.int64)
    live = np.flatnonzero(same_text & ~reducible)
    depth = 0
    while len(live):
        a, b = live + depth, phi[live] + depth
        on = (a < end[live]) & (b < end[live])
        on &= symbols[np.minimum(a, n - 1)] == symbols[np.minimum(b, n - 1)]
        plcp[live[~on]] = depth
        live = live[on]
        depth += 1
    # Reducible places count down from the irreducible one before them.
    if reducible.any():
        base = np.maximum.accumulate(np.where(reducible, 0, i))
        plcp = np.where(reducible, plcp[base] - (i - base), plcp)
    return plcp[order]


def maximal_repeats(symbols: np.ndarray, order: np.ndarray, lcp: np.ndarray, end: np.ndarray, first_of: np.ndarray,
                    least: int) -> tuple[np.ndarray, np.ndarray]:
    """LCP intervals of at least ``least`` words that are left-maximal: (a place
    of the repeat, its length), one a maximal repeat."""
    place, length = [], []
    runs = np.flatnonzero(np.diff(np.concatenate([[0], (lcp >= least).view(np.int8), [0]])))
    for a, z in zip(runs[::2].tolist(), runs[1::2].tolist()):
        values = lcp[a:z].tolist()
        suffix = order[a - 1:z].tolist()
        # Word before each suffix; the start of a text equals nothing.
        before = [(-1 - k) if s == first_of[s] else int(symbols[s - 1]) for k, s in enumerate(suffix)]
        stack: list[list] = []  # [lcp, a suffix, words before: one value or None if several]
        carry = before[0]
        for v, s, b in zip(values + [0], suffix, before[1:] + [0]):
            last = carry
            while stack and stack[-1][0] > v:
                depth, at, left = stack.pop()
                left = left if left == last else None
                if left is None:
                    place.append(at), length.append(depth)
                last = left
            if not v:
                break
            if stack and stack[-1][0] == v:
                if stack[-1][2] != last:
                    stack[-1][2] = None
            else:
                stack.append([v, s, last])
            carry = b
    return np.array(place, np.int64), np.array(length, np.int64)


def covered(order: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """Words inside a repeat of at least ``least`` words (every occurrence counts)."""
    n = len(order)
    long = np.zeros(n, np.int64)
    both = np.maximum(lcp, np.append(lcp[1:], 0))
    long[order] = np.where(both >= least, both, 0)
    reach = np.maximum.accumulate(np.arange(n) + long) if n else long
    return reach > np.arange(n)


def measure(col: pa.Array, min_words: int = MIN_WORDS, window: int = BASE_WINDOW) -> dict[str, np.ndarray]:
    """Per text: n_words, covered_words, longest_repeat, n_maximal, and the words in repeated windows."""
    w = Words(col)
    rows = len(col)
    text = np.repeat(np.arange(rows), w.counts)
    symbols = w.hash
    order, lcp = suffix_array(symbols, w.first)
    end, begin = np.repeat(w.first[1:], w.counts), np.repeat(w.first[:-1], w.counts)
    count = lambda mask: np.bincount(text[mask], minlength=rows)
    longest = np.zeros(rows, np.int64)
    place, length = maximal_repeats(symbols, order, lcp, end, begin, min_words)
    np.maximum.at(longest, text[place], length)
    return {"n_words": w.counts, "covered_words": count(covered(order, lcp, min_words)), "longest_repeat": longest,
            "n_maximal": np.bincount(text[place], minlength=rows), "n_repeat_words": count(covered(order, lcp, window)),
            "word_chars": _per_row(w, _in_words(w) & ((w.data & 0xC0) != 0x80)),
            "n_symbols": _per_row(w, np.isin(w.data, np.frombuffer(SYMBOLS, np.uint8)))}


def _in_words(w: Words) -> np.ndarray:
    inside = np.zeros(len(w.data) + 1, np.int8)
    inside[w.start] += 1
    np.subtract.at(inside, w.end, 1)
    return np.cumsum(inside[:-1], dtype=np.int8) > 0


def _per_row(w: Words, mask: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[w.off[1:]] - total[w.off[:-1]]


def repeated_lines(texts: list[str | None]) -> list[int]:
    out = []
    for t in texts:
        lines = [x for x in (t or "").encode("utf-8").split(b"\n") if x.split()]
        out.append(len(lines) - len(set(lines)))
    return out


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "covered_words long, longest_repeat long, n_maximal long")


def repetition(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS,
               max_covered: float = MAX_COVERED, max_longest: float = MAX_LONGEST,
               min_longest: int = MIN_LONGEST) -> DataFrame:
    """(key, figures, base_failed, repeats_failed, kept), one row a row of ``docs``."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            col = b.column("text")
            m = measure(col, min_words)
            m["n_dup_lines"] = np.array(repeated_lines(col.to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), *[pa.array(np.asarray(m[n], np.int64)) for n in names]], ["key", *names])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text").mapInArrow(run, f"key {kind}, {SCHEMA}")
    n = F.col("n_words")
    base = (n < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_PERCENT * n)
    repeats = (F.col("covered_words") > max_covered * n) | (
        (F.col("longest_repeat") > min_longest) & (F.col("longest_repeat") > max_longest * n))
    return (out.withColumn("base_failed", base).withColumn("repeats_failed", repeats)
               .withColumn("kept", ~base & ~repeats).withColumnRenamed("key", key))


def passes(docs: DataFrame, text: str = "text", out: str = "kept", **limits) -> DataFrame:
    """``docs`` with the verdict of ``repetition`` on every row; other columns do not pass through Python."""

    @F.arrow_udf("boolean")
    def verdict(texts: pa.Array) -> pa.Array:
        kept = [np.ones(0, bool)]
        for b in slices([pa.record_batch([texts], ["text"])]):
            m = measure(b.column("text"), limits.get("min_words", MIN_WORDS))
            n = m["n_words"]
            base = (n < BASE_WORDS) | (100 * m["n_repeat_words"] > BASE_PERCENT * n)
            long = m["longest_repeat"]
            repeats = (m["covered_words"] > limits.get("max_covered", MAX_COVERED) * n) | (
                (long > limits.get("min_longest", MIN_LONGEST)) & (long > limits.get("max_longest", MAX_LONGEST) * n))
            kept.append(~base & ~repeats)
        return pa.array(np.concatenate(kept))

    return docs.withColumn(out, verdict(F.col(text)))


def op1_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "repeats_failed", "covered_words", "longest_repeat", "n_maximal")
