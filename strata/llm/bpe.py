"""Byte-pair encoding and decoding with forced boundaries.

A pair of bytes that stands next to each other in no token of the vocabulary can
never be merged across, so a cut between the two is certain.  A text is cut at
all certain cuts (found for a whole batch by one table lookup a byte), the
fragments are encoded independently, each distinct fragment once, and their ids
are concatenated.

The pre-tokeniser reads a pattern over characters, so a cut must not change what
the pattern sees.  Cuts are therefore taken only
  * between two ASCII bytes, the left one not white space (the pattern looks one
    character past white space), or between a two-byte character from U+00C0 on
    (never white space) and ASCII white space,
  * not between two punctuation bytes if the right one is an apostrophe (which
    would begin a contraction there);
special tokens are cut out first.  Not cutting is always right.

Inside a fragment the pattern is applied and the merges of the vocabulary are
made in rank order.  Ids equal those of the tokenizers library with
add_special_tokens=False; decoding concatenates token bytes and replaces
malformed UTF-8 as that library does.

Defined results: null and empty texts have no ids and decode to the empty text;
equal rows give equal rows; very long texts are whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import documents, slices, utf8

#: The byte-level pre-tokeniser's pattern (a fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Distinct fragments a worker keeps; beyond it the cache starts anew.
CACHE = 1_000_000
NEVER = 1 << 30


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for
    the characters from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Encoder(dict):
    """Fragment -> its ids as little-endian 32-bit integers; fills itself."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.vocab = {raw(t): i for t, i in spec["model"]["vocab"].items() if t.encode() not in self.special}
        self.byte = [self.vocab[bytes([b])] for b in range(256)]
        self.rank, self.made = {}, []  # pair of ids -> rank; rank -> id of the merged token
        for r, pair in enumerate(spec["model"]["merges"]):
            left, right = map(raw, pair if isinstance(pair, list) else pair.split(" "))
            self.rank[self.vocab[left] << 17 | self.vocab[right]] = r
            self.made.append(self.vocab[left + right])
        self.token = [b""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for t, i in [*self.vocab.items(), *self.special.items()]:
            self.token[i] = t
        self.pieces = regex.compile(PATTERN).findall
        self.cuts = self._cut_table()

    def _cut_table(self) -> np.ndarray:
        inside = np.zeros(1 << 16, bool)
        for t in self.vocab:
            b = np.frombuffer(t, np.uint8).astype(np.int64)
            inside[b[:-1] * 256 + b[1:]] = True
        byte = np.arange(256)
        space = np.isin(byte, [0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)])
        letter = ((byte | 32) >= 97) & ((byte | 32) <= 122) & (byte < 128)
        digit = (byte >= 48) & (byte <= 57)
        mark = (byte < 128) & ~space & ~letter & ~digit
        left = (byte < 128) & ~space
        allowed = left[:, None] & (byte < 128)[None, :]
        allowed &= ~(mark[:, None] & (byte == 39)[None, :])
        allowed |= (byte >= 128)[:, None] & space[None, :]  # see boundaries()
        return (~inside).reshape(256, 256) & allowed

    def __missing__(self, fragment: bytes) -> bytes:
        if fragment in self.special:
            ids = [self.special[fragment]]
        elif fragment.isalpha() or fragment[:1] == b" " and fragment[1:].isalpha():
            ids = self._merge(fragment)  # ASCII letters: one piece of the pattern
        else:
            ids = []
            for piece in self.pieces(fragment.decode("utf-8")):
                ids += self._merge(piece.encode("utf-8"))
        out = pack(f"<{len(ids)}I", *ids)
        if len(self) >= CACHE:
            self.clear()
        self[fragment] = out
        return out

    def _merge(self, piece: bytes) -> list[int]:
        """Merge neighbouring tokens, lowest rank first, leftmost first among equals."""
        ids = [self.byte[b] for b in piece]
        if len(ids) > 400:
            return self._merge_long(ids)
        rank, made = self.rank.get, self.made
        ranks = [rank(a << 17 | b, NEVER) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            ids[i] = new = made[best]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 17 | new, NEVER)
            if i < len(ranks):
                ranks[i] = rank(new << 17 | ids[i + 1], NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges with a heap and a linked list, for very long pieces."""
        n, rank = len(ids), self.rank
        prev, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank.get(a << 17 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j] = self.made[r], -1
            after[i] = after[j]
            if after[j] >= 0:
                prev[after[j]] = i
            for x, y in ((prev[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := rank.get(ids[x] << 17 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def boundaries(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Places of all cuts in the joined texts, row offsets included."""
        cut = np.zeros(len(data) + 1, bool)
        if len(data):
            cut[1:-1] = self.cuts.ravel()[(data[:-1].astype(np.uint16) << 8) | data[1:]]
            late = np.flatnonzero(cut[1:-1] & (data[:-1] >= 128))
            lead = data[np.maximum(late - 1, 0)]
            cut[late[(lead < 0xC3) | (lead > 0xDF)] + 1] = False
            blob = data.tobytes()
            for special in self.special:
                at = blob.find(special)
                while at >= 0:
                    row = int(np.searchsorted(off, at, "right"))
                    if at + len(special) <= off[row]:
                        cut[at:at + len(special) + 1] = False
                        cut[[at, at + len(special)]] = True
                        at = blob.find(special, at + len(special))
                    else:
                        at = blob.find(special, at + 1)
        cut[off] = True
        return np.flatnonzero(cut)

    def encode_column(self, col: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        data, off = utf8(col)
        at = self.boundaries(data, off)
        blob, places = data.tobytes(), at.tolist()
        ids = [self[blob[a:b]] for a, b in zip(places, places[1:])]
        rows = np.searchsorted(at, off).tolist()
        return [b"".join(ids[a:b]) for a, b in zip(rows, rows[1:])]

    def decode(self, ids: bytes) -> str:
        token = self.token
        return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a worker process and vocabulary."""
    return Encoder(path)


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids binary): the ids of every text, little-endian unsigned 32-bit.
    ``path``: the vocabulary file, readable on every worker."""
    path = path or default_vocabulary()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches, "text"):
            ids = pa.array(enc.encode_column(b.column("text")), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("key"), ids], ["key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text").mapInArrow(run, f"key {kind}, ids binary")
    return out.withColumnRenamed("key", key)


def decode(ids: DataFrame, path: str | None = None, key: str = "doc_id") -> DataFrame:
    """(key, text) from (key, ids)."""
    path = path or default_vocabulary()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches, "ids", 1 << 22):
            text = pa.array([enc.decode(x or b"") for x in b.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("key"), text], ["key", "text"])

    kind = ids.schema[key].dataType.simpleString()
    out = ids.selectExpr(f"`{key}` AS key", "ids").mapInArrow(run, f"key {kind}, text string")
    return out.withColumnRenamed("key", key)


def op9_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text and of their decoded text."""
    path = default_vocabulary()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches, "text"):
            ids = enc.encode_column(b.column("text"))
            back = [enc.decode(x).encode("utf-8") for x in ids]
            sha = lambda parts: pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), sha(ids), sha(back)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = documents(spark, sf_dir, "doc_id", "text")
    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
