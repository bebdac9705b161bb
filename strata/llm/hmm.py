"""Hidden Markov language model, trained by Baum-Welch, and exact likelihoods.

Words (lower-cased A-Z) are counted over all training texts.  Every training word
is a symbol with emissions of its own (a fixed part of them shared with the words
of its class, which end alike), and so is the end of a text.  Words that
are not in the training texts belong to one of ``CLASSES`` classes by their last
bytes; those of a class are one more word, which takes its smoothed share of what
the training words of that class gather.  The probabilities of all texts add up to
one (unseen words of a class taken as one word).

Training: in all rounds but the last a word that makes up less than one in ``SHARE``
training tokens is emitted as its class (tied states); the last round takes the
expected counts of every word on its own, so the model has a row for each training
word, however many there are.  A round runs the scaled forward and backward
recursions over all training texts and adds up expected counts (first states,
transitions, emissions) across tasks.  The words above the share, at most ``SHARE``
in any corpus, and the classes go through the driver and a broadcast.  In the last
round texts are dealt into chunks of bounded size; a chunk sends the counts of its
other words, in blobs by hash range, to where they are added up over all chunks,
and gets the sums back for the score, so nothing of the size of the vocabulary is
held in one place.  The sums are kept as 16-bit shares of a word's count; what the
emissions are divided by is added up after that rounding.  Texts are worked
on side by side, longest first, one word of each at a time; no text is cut.
Scoring runs the forward recursion once more over all texts.

The other words are known by a 64-bit hash after they have been counted (two words of
equal hash would share a count: expected once in 6 billion distinct words).

Defined results: null, empty and blank texts consist of the end only; equal
texts have equal scores; without training texts every count is 0 and all states emit
alike; null ids are the empty text for the fold; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import crc_mod, discard, documents, mix, slices, written

STATES, ROUNDS = 12, 5
SHARE, CLASSES, TAIL = 100_000, 256, 3
FOLDS, ADD = 10, 0.1
#: Weight of the corpus frequencies in every state's emissions, in words.
PRIOR = 20.0
#: Part of every word's expected counts that is taken from its class, by its share of the class's tokens.
MIX = 0.3
#: Words worked on side by side, words a task counts before it hands them on, steps between rescalings,
#: words whose transitions are added up at once.
TOKENS, FLUSH, RESCALE, BLOCK = 150_000, 300_000, 16, 2048
#: Tokens of a chunk, and rows (a word of a chunk) that are added up together, on average at most.
CHUNK, BUCKET = 5_000_000, 1_000_000
#: Bytes of blobs that a task hands on at once.
BLOB = 1 << 20


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, n long) over ``text``; each task adds up its own words first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                              ["word", "n"])

        for b in slices(batches, "text"):
            for t in b.column("text").to_pylist():
                if t:
                    seen.update(t.encode("utf-8").lower().split())
            if len(seen) > FLUSH:
                yield table()
                seen.clear()
        if seen:
            yield table()

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-TAIL:]) % CLASSES


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join([hashlib.blake2b(w, digest_size=8).digest() for w in words]), "<u8")


@dataclass
class Symbols:
    """What is known of the words.  Numbers: frequent words, the end, the classes, then
    (in the last round and the score) the other words of a chunk."""

    hot: dict[bytes, int]
    counts: np.ndarray  # of the frequent words and the end, in training tokens
    noise: np.ndarray  # hashes of the frequent words, for the start
    classes: np.ndarray  # of every frequent word
    words: np.ndarray  # training words of every class
    mass: np.ndarray  # their tokens
    tokens: int  # N
    distinct: int  # V

    @property
    def end(self) -> int:
        return len(self.hot)

    @property
    def fixed(self) -> int:
        return len(self.hot) + 1 + CLASSES

    @property
    def base_log(self) -> float:
        return math.log10(self.tokens + ADD * (self.distinct + 1))

    @property
    def whole(self) -> float:
        """What counts (with ``ADD``) are divided by: all words, the end and one unseen word."""
        return self.tokens + ADD * (self.words.sum() + 2)

    @property
    def cold_words(self) -> np.ndarray:
        return self.words - np.bincount(self.classes, minlength=CLASSES)

    @property
    def cold_mass(self) -> np.ndarray:
        return self.mass - np.bincount(self.classes, self.counts[:self.end], CLASSES)

    def prior(self, tied: bool) -> np.ndarray:
        """Of the frequent words, the end and of every class its unseen word, if ``tied``
        with the training words that are not frequent."""
        unseen = ADD * (self.words + 1) / (self.words + 1).sum()
        if tied:
            unseen = unseen + self.cold_mass + ADD * self.cold_words
        return np.concatenate([self.counts + ADD, unseen]) / self.whole

    def unseen_share(self) -> np.ndarray:
        return ADD / (self.mass + ADD * (self.words + 1))


def symbols(counts: DataFrame, texts: int, share: int) -> Symbols:
    """From the word counts and the number of training texts; only the words that make up
    one in ``share`` tokens (so at most ``share`` of them) and a row a class reach the driver."""
    tail = F.crc32(F.expr(f"substr(word, greatest(1, octet_length(word) - {TAIL - 1}))")) % CLASSES
    words, mass = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.groupBy(tail.alias("c")).agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect():
        words[r["c"]], mass[r["c"]] = r["v"], r["n"]
    least = -(-int(mass.sum()) // share)
    top = sorted(counts.where(F.col("n") >= least).withColumn("h", F.xxhash64("word")).collect(), key=lambda r: (-r["n"], r["word"]))
    return Symbols({bytes(r["word"]): i for i, r in enumerate(top)}, np.array([*[r["n"] for r in top], texts], float),
                   np.array([r["h"] for r in top], np.int64), np.array([class_of(bytes(r["word"])) for r in top], np.int64),
                   words, mass, int(mass.sum()) + texts, int(words.sum()) + (texts > 0))


def packed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as one compressed blob, bytes of equal weight together."""
    return pa.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True) if len(values) else b""


def unpacked(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, "<u4")
    raw = np.frombuffer(pa.decompress(blob, 4 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, n).T).view("<u4")[:, 0]


#: Columns of a row of coded texts, besides their ids.
TEXTS = "held_out array<boolean>, n_tokens array<long>, symbols binary, rare binary"


def lists(cols: dict[str, pa.Array]) -> list[pa.Array]:
    """One row with each column as a list."""
    return [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in cols.values()]


class Numbers(dict):
    """Numbers of words: those of the frequent words, and below 0 (-1, -2, ..) of others as they
    are met; ``classes`` and ``hashes`` have the others in order, once ``learn`` was called."""

    def __init__(self, known: Symbols):
        super().__init__(known.hot)
        self.end, self.size, self.met = known.end, 0, []
        self.classes, self.hashes = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self.met.append(word)
        self.size = i = self.size + 1
        self[word] = -i
        return -i

    def learn(self) -> None:
        classes = np.array([class_of(w) for w in self.met], np.int64) + self.end + 1
        self.classes = np.concatenate([self.classes, classes])
        self.hashes = np.concatenate([self.hashes, hashes_of(self.met)])
        self.met.clear()


def encode(docs: DataFrame, known: Symbols) -> DataFrame:
    """Rows of some texts of (doc_id, held_out, text) each: ``symbols`` has the frequent words,
    ends and classes, ``rare`` the hashes of the words that stand as their class."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, numbers = shared.value, None
        for b in slices(batches, "text"):
            if numbers is None or numbers.size > FLUSH:
                numbers = Numbers(s)
            number, ids, sizes = numbers.__getitem__, [], []
            for t in b.column("text").to_pylist():
                words = (t or "").encode("utf-8").lower().split()
                ids.extend(map(number, words))
                ids.append(s.end)
                sizes.append(len(words) + 1)
            numbers.learn()
            sym = np.fromiter(ids, np.int64, len(ids))
            late = sym < 0
            others = -1 - sym[late]
            sym[late] = numbers.classes[others]
            cols = {"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "n_tokens": pa.array(sizes, pa.int64())}
            yield pa.RecordBatch.from_arrays([*lists(cols), pa.array([packed(sym)], pa.binary()),
                                              pa.array([numbers.hashes[others].astype("<u8").tobytes()], pa.binary())], [*cols, "symbols", "rare"])

    return docs.mapInArrow(run, f"doc_id array<{kind}>, {TEXTS}")


class Coded:
    """Texts of some rows: their symbols one after the other, sizes and folds."""

    def __init__(self, rows: list[dict]):
        self.sizes = np.concatenate([np.zeros(0, np.int64), *[np.array(r["n_tokens"], np.int64) for r in rows]])
        self.held = np.concatenate([np.zeros(0, bool), *[np.array(r["held_out"], bool) for r in rows]])
        self.sym, at = np.empty(int(self.sizes.sum()), "<u4"), 0
        for r in rows:
            n = sum(r["n_tokens"])
            self.sym[at:at + n] = unpacked(r["symbols"], n)
            at += n

    def texts(self, sym: np.ndarray, keep: np.ndarray | None = None) -> list[np.ndarray]:
        parts = np.split(sym, np.cumsum(self.sizes)[:-1]) if len(self.sizes) else []
        return parts if keep is None else [x for x, k in zip(parts, keep, strict=True) if k]


def blob_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of coded texts, their blobs as they lie in the batch."""
    for i in range(batch.num_rows):
        yield {f: batch.column(f)[i].as_buffer() if f in ("symbols", "rare") else batch.column(f)[i].as_py() for f in batch.schema.names}


def gathered_rows(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[list[dict]]:
    """Rows with about ``limit`` tokens together (one row at least)."""
    rows, size = [], 0
    for b in batches:
        for r in blob_rows(b):
            n = sum(r["n_tokens"])
            if rows and size + n > limit:
                yield rows
                rows, size = [], 0
            rows.append(r)
            size += n
    if rows:
        yield rows


@dataclass
class Model:
    first: np.ndarray  # K
    move: np.ndarray  # K x K
    emit: np.ndarray  # symbols x K
    #: Counts a token of each class, and what the emissions of the other words are divided by.
    rate: np.ndarray | None = None
    total: np.ndarray | None = None


def noise(hashes: np.ndarray, states: int) -> np.ndarray:
    """Standard normal numbers from 64-bit hashes, a row each."""
    h = hashes.astype(np.int64).view(np.uint64)[:, None]
    step = np.arange(1, 2 * states + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    u = ((mix(h + step) >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
    return np.sqrt(-2 * np.log(u[:, :states])) * np.cos(2 * np.pi * u[:, states:])


def start_model(known: Symbols, states: int = STATES) -> Model:
    """Every state begins as the corpus frequencies, shaken by noise from each word's
    hash; states tend to stay."""
    emit = known.prior(True)[:, None] * np.exp(noise(np.concatenate([known.noise, np.arange(1 + CLASSES)]), states))
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(0))


def maximise(known: Symbols, first: np.ndarray, moves: np.ndarray, emitted: np.ndarray, own: np.ndarray | None = None) -> Model:
    """The model from expected counts.  ``emitted``: of the frequent words, the end and
    the other words by class.  ``own``: the others' counts by state as they are kept, in the last round."""
    end, first, moves = known.end, first + 0.1, moves + 0.1
    cold, classes = emitted[end + 1:], emitted[end + 1:].copy()
    for i in range(classes.shape[1]):
        classes[:, i] += np.bincount(known.classes, emitted[:end, i], CLASSES)
    rate = classes / np.maximum(known.mass, 1)[:, None]
    unseen = known.unseen_share()[:, None] * classes
    emit = emitted[:end + 1].copy()
    emit[:end] = (1 - MIX) * emit[:end] + MIX * known.counts[:end, None] * rate[known.classes]
    from_class = MIX * known.cold_mass[:, None] * rate
    if own is None:
        emit = np.concatenate([emit, (1 - MIX) * cold + from_class + unseen]) + PRIOR * known.prior(True)[:, None]
        total = emit.sum(0)
    else:
        total = emit.sum(0) + (1 - MIX) * own + from_class.sum(0) + unseen.sum(0) + PRIOR
        emit = np.concatenate([emit, unseen]) + PRIOR * known.prior(False)[:, None]
    return Model(first / first.sum(), moves / moves.sum(1)[:, None], emit / total, rate, total)


def own_emissions(model: Model, known: Symbols, n: np.ndarray, cls: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Of words that are not frequent, from their counts and classes and the share of them in
    every state; words without a count are unseen."""
    gathered = n[:, None] * ((1 - MIX) * share + MIX * model.rate[cls])
    emit = (gathered + PRIOR * ((n + ADD) / known.whole)[:, None]) / model.total
    return np.where((n > 0)[:, None], emit, model.emit[known.end + 1 + cls])


def groups(texts: list[np.ndarray], limit: int = TOKENS) -> Iterator[list[int]]:
    """Places of texts in order of length, longest first, in groups of bounded size (one text at least)."""
    group, size = [], 0
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        if group and size + len(texts[i]) > limit:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(texts[i])
    if group:
        yield group


def side_by_side(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols word by word (the first of every text, then the second, ..) and the
    number of texts at each word; ``texts`` are longest first."""
    size = np.array([len(t) for t in texts])
    active = len(texts) - np.searchsorted(np.sort(size), np.arange(size[0]), "right")
    at = np.concatenate([[0], np.cumsum(active)])
    word = np.concatenate([np.arange(n) for n in size])
    out = np.empty(at[-1], np.int64)
    out[at[word] + np.repeat(np.arange(len(texts)), size)] = np.concatenate(texts)
    return out, active


_ROOM: dict[str, np.ndarray] = {}


def room(name: str, rows: int, states: int) -> np.ndarray:
    """An array for the numbers of a group, taken again for the next group (fresh pages cost
    as much as the work on them); a group of one very long text gets its own."""
    size = rows * states
    if size > TOKENS * STATES:
        return np.empty((rows, states))
    if name not in _ROOM:
        _ROOM[name] = np.empty(TOKENS * STATES)
    return _ROOM[name][:size].reshape(rows, states)


def emissions(model: Model, sym: np.ndarray) -> np.ndarray:
    out = room("emit", len(sym), len(model.first))
    return np.take(model.emit, sym, axis=0, out=out, mode="clip")


def last_words(active: np.ndarray) -> np.ndarray:
    """The place of the last word of every text."""
    texts = np.arange(int(active[0]))
    size = len(active) - np.searchsorted(active[::-1], texts, "right")
    return (np.cumsum(active) - active)[size - 1] + texts


def forward(model: Model, sym: np.ndarray, active: np.ndarray, keep: bool,
            emit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Scaled forward recursion: log-likelihoods, alpha (in the place of the emissions unless
    they are to be kept) and what the words of every rescaled step were divided by."""
    emit = emissions(model, sym) if emit is None else emit
    alpha = room("alpha", *emit.shape) if keep else emit
    like, scales = np.zeros(int(active[0])), []
    moved = np.empty((len(like), len(model.first)))
    a, at = model.first, 0
    for t, n in enumerate(active.tolist()):
        if t:
            a = np.dot(a[:n], model.move, out=moved[:n])
        a = np.multiply(a, emit[at:at + n], out=alpha[at:at + n])
        if t % RESCALE == 0:
            c = a.sum(1)
            a /= c[:, None]
            like[:n] += np.log(c)
            scales.append(c)
        at += n
    return like + np.log(alpha[last_words(active)].sum(1)), alpha, scales


def expected(model: Model, sym: np.ndarray, active: np.ndarray, into: np.ndarray | None = None,
             counted: np.ndarray | None = None, once: np.ndarray | None = None) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood and expected counts of first states, transitions and emissions (states x
    symbols, added to ``into``, of the symbols ``counted`` if they differ from those emitted;
    of those beyond ``into``, which occur once, they go to ``once`` and are added as what was emitted).
    A text's beta begins as one over the sum of its last alpha and is rescaled where alpha was,
    so alpha times beta is the share of every state at a word without another division."""
    emit = emissions(model, sym)
    like, alpha, scales = forward(model, sym, active, True, emit)
    k, texts = len(model.first), int(active[0])
    into = np.zeros((k, len(model.emit))) if into is None else into
    counted = sym if counted is None else counted
    beta = np.repeat(1 / alpha[last_words(active)].sum(1), k).reshape(texts, k)
    after, back, to = beta.copy(), model.move.T.copy(), len(sym)
    for t in range(len(active) - 1, 0, -1):
        n = int(active[t])
        x = emit[to - n:to]
        x *= beta[:n]  # emission times beta, kept for the transitions
        if t % RESCALE == 0:
            x /= scales[t // RESCALE][:, None]
        np.dot(x, back, out=after[:n])
        beta, after, to = after, beta, to - n
    beta *= alpha[:texts]
    emit[:texts] = beta
    moves = np.zeros((k, k))
    previous = np.arange(texts, len(sym)) - np.repeat(active[:-1], active[1:])
    for at in range(0, len(previous), BLOCK):
        before = alpha[previous[at:at + BLOCK]]
        x = emit[texts + at:texts + at + BLOCK]
        moves += before.T @ x
        x *= before @ model.move  # alpha times beta
    width = max(BLOCK, into.shape[1])
    for at in range(0, len(sym), width):
        part = counted[at:at + width]
        single = np.flatnonzero(part >= into.shape[1])
        if len(single):
            alone, part = part[single] - into.shape[1], part.copy()
            part[single] = sym[at + single]
        for i in range(k):
            got = np.bincount(part, emit[at:at + width, i])
            into[i, :len(got)] += got  # as long as the largest symbol
            if len(single):
                once[i, alone] = emit[at + single, i]
    return float(like.sum()), beta.sum(0), model.move * moves, into


_NONE = np.zeros(0, np.int64)


class Counts:
    """Expected counts that a task adds up: likelihood, first states, transitions, emissions."""

    def __init__(self, states: int, fixed: int):
        self.like, self.first, self.moves = 0.0, np.zeros(states), np.zeros((states, states))
        self.emitted = np.zeros((states, fixed))

    def add(self, model: Model, texts: list[np.ndarray], late: np.ndarray = _NONE, n: np.ndarray = _NONE) -> np.ndarray:
        """Of ``texts``, whose symbols beyond the fixed ones are emitted as the classes ``late`` and
        occur ``n`` times, most often first; returns their shares by state, in 16 bits.  Only those
        that occur twice are added up: a share of one that occurs once is what it gets there."""
        k, fixed, often = len(self.first), self.emitted.shape[1], int(np.count_nonzero(n > 1))
        emitted = np.zeros((k, fixed + often)) if len(late) else self.emitted
        emitted_as = np.concatenate([np.arange(fixed), fixed - CLASSES + late])
        share = np.zeros((k, len(late)), np.float16)
        for g in groups(texts):
            full, active = side_by_side([texts[i] for i in g])
            like, first, moves, _ = expected(model, emitted_as[full] if len(late) else full, active, emitted, full, share[:, often:])
            self.like, self.first, self.moves = self.like + like, self.first + first, self.moves + moves
        if len(late):
            self.emitted += emitted[:, :fixed]
        for i in range(k if often else 0):
            self.emitted[i, fixed - CLASSES:] += np.bincount(late[:often], emitted[i, fixed:], CLASSES)
            share[i, :often] = emitted[i, fixed:] / n[:often]
        return share

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts by state: likelihood, first states, transitions, then every symbol."""
        k = len(self.first)
        seen = np.flatnonzero(self.emitted.any(0))
        return (np.concatenate([np.arange(2 + k), 2 + k + seen]),
                np.concatenate([np.full((1, k), self.like), self.first[None], self.moves, self.emitted[:, seen].T]))


def columns(states: int, kind: str) -> str:
    return ", ".join(f"s{i} {kind}" for i in range(states))


def summed(parts: DataFrame, states: int, fixed: int) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Counts of all tasks (key, s0..): a row a key, at most ``SHARE`` and the classes."""
    names = [f"s{i}" for i in range(states)]
    rows = parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in names]).toPandas()
    got = np.zeros((2 + states + fixed, states))
    got[rows["key"].to_numpy()] = rows[names].to_numpy()
    return float(got[0, 0]), got[1], got[2:2 + states], got[2 + states:]


def tied_round(coded: DataFrame, model: Model, known: Symbols) -> tuple[Model, float]:
    """One Baum-Welch step in which words that are not frequent are emitted as their class."""
    shared = coded.sparkSession.sparkContext.broadcast(model)
    k, fixed = len(model.first), known.fixed

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(k, fixed)
        for rows in gathered_rows(batches, CHUNK):
            c = Coded(rows)
            counts.add(shared.value, c.texts(c.sym, ~c.held))
        at, values = counts.rows()
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *[pa.array(x) for x in values.T.astype(np.float32)]],
                                         ["key", *[f"s{i}" for i in range(k)]])

    parts = coded.select("held_out", "n_tokens", "symbols").mapInArrow(run, f"key long, {columns(k, 'float')}")
    like, *rest = summed(parts, k, fixed)
    shared.unpersist()
    return maximise(known, *rest), like


def listed(rare: np.ndarray, cls: np.ndarray, training: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct hashes in order, their classes and times in training, and every word's place
    among them; a range of hashes at a time, so little more is held than what is returned."""
    parts = 1 + len(rare) // TOKENS
    part = ((rare >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype("<u2")
    place, found, at = np.empty(len(rare), "<u4"), [], 0
    for i in range(parts):
        mine = np.flatnonzero(part == i)
        words, first, inverse = np.unique(rare[mine], return_index=True, return_inverse=True)
        place[mine] = at + inverse
        found.append((words, cls[mine[first]], np.bincount(inverse[training[mine]], minlength=len(words)).astype("<u4")))
        at += len(words)
    return *[np.concatenate(x) for x in zip(*found, strict=True)], place


def dealt(coded: DataFrame, model: Model, known: Symbols, buckets: int) -> DataFrame:
    """The last round's expected counts, and the texts in chunks.  Rows: texts of a chunk as in
    ``coded``, ``rare`` now the places of words in its list; blobs (``bucket`` and its words, a
    range of hashes) of the list: hash, class, count and shares by state; sums (``key``)."""
    shared = coded.sparkSession.sparkContext.broadcast((model, known))
    k, fixed = len(model.first), known.fixed
    kind = coded.schema["doc_id"].dataType.simpleString()
    width = -(-(1 << 64) // buckets)
    fields = ["chunk", "doc_id", "held_out", "n_tokens", "symbols", "rare", "bucket", "words", "key", *[f"s{i}" for i in range(k)]]
    types = [pa.int64(), None, pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64(), pa.binary(),
             pa.int64(), *[pa.float32()] * k]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, s = shared.value
        counts, chunk = Counts(k, fixed), TaskContext.get().partitionId() << 32

        def batch(n: int, **cols: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([cols.get(f, pa.nulls(n, t)) for f, t in zip(fields, types, strict=True)], fields)

        for rows in gathered_rows(watched(batches), CHUNK):
            c = Coded(rows)
            late = c.sym > s.end
            words, cls, n, place = listed(np.concatenate([np.frombuffer(r["rare"], "<u8") for r in rows]),
                                          (c.sym[late] - np.uint32(s.end + 1)).astype(np.uint8), ~np.repeat(c.held, c.sizes)[late])
            order = np.argsort(n, kind="stable")[::-1].astype("<u4")  # as the counts want them
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order), dtype="<u4")
            c.sym[late] = rank[place] + np.uint32(fixed)
            del late, place
            share = counts.add(m, c.texts(c.sym, ~c.held), cls[order].astype(np.int64), n[order])
            at, size, out = 0, 0, []

            def blobs() -> pa.RecordBatch:
                return batch(len(out), chunk=pa.array([chunk] * len(out)), bucket=pa.array([b for b, _ in out], pa.int64()),
                             words=pa.array([b for _, b in out], pa.binary()))

            cuts = np.searchsorted(words, np.array([i * width for i in range(1, buckets)], np.uint64)).tolist()
            for bucket, to in enumerate([*cuts, len(words)]):
                if to > at:
                    out.append((bucket, b"".join([words[at:to].tobytes(), cls[at:to].tobytes(), n[at:to].tobytes(),
                                                  share[:, rank[at:to]].tobytes()])))
                    size += len(out[-1][1])
                if size > BLOB:
                    yield blobs()
                    size, out = 0, []
                at = to
            if out:
                yield blobs()
            del share, rank, words, cls, n, out
            at = 0
            for r in rows:
                size = sum(r["n_tokens"])
                sym = c.sym[at:at + size]
                yield batch(1, chunk=pa.array([chunk]), doc_id=pa.array([r["doc_id"]], types[1]), held_out=pa.array([r["held_out"]], types[2]),
                            n_tokens=pa.array([r["n_tokens"]], types[3]), symbols=pa.array([r["symbols"].to_pybytes()], pa.binary()),
                            rare=pa.array([packed(order[sym[sym >= fixed] - np.uint32(fixed)])], pa.binary()))
                at += size
            del c, order
            chunk += 1
        _ROOM.clear()
        if chunk & 0xFFFFFFFF:
            at, values = counts.rows()
            yield batch(len(at), key=pa.array(at, pa.int64()), **{f"s{i}": pa.array(x) for i, x in enumerate(values.T.astype(np.float32))})

    def watched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            types[1] = b.schema.field("doc_id").type
            yield b

    return coded.mapInArrow(run, f"chunk long, doc_id {kind}, {TEXTS}, bucket long, words binary, key long, {columns(k, 'float')}")


def read_words(blob: bytes, states: int) -> tuple[np.ndarray, ...]:
    """Hashes, classes, counts and shares (states x words) of a blob."""
    n = len(blob) // (13 + 2 * states)
    return (np.frombuffer(blob, "<u8", n), np.frombuffer(blob, np.uint8, n, 8 * n), np.frombuffer(blob, "<u4", n, 9 * n),
            np.frombuffer(blob, np.float16, states * n, 13 * n).reshape(states, n))


def added_up(blobs: DataFrame, states: int) -> DataFrame:
    """For every blob of (chunk, bucket, words) its words with the sums over all chunks, in the
    same order; and per bucket (chunk is null) the counts by state as they are kept."""

    def run(t: pa.Table) -> pa.Table:
        parts = [read_words(x, states) for x in t.column("words").to_pylist()]
        _, first, place = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
        n = np.concatenate([p[2] for p in parts])
        total = np.bincount(place, n, len(first))
        share = np.empty((states, len(first)), np.float16)
        for i in range(states):
            share[i] = np.bincount(place, n * np.concatenate([p[3][i] for p in parts]).astype(float), len(first)) / np.maximum(total, 1)
        out, at = [], 0
        for hashes, cls, _, _ in parts:
            to = place[at:at + len(hashes)]
            out.append(b"".join([cls.tobytes(), total[to].astype("<u4").tobytes(), share[:, to].tobytes()]))
            at += len(hashes)
        own = share.astype(float) @ total
        return pa.table({"chunk": pa.concat_arrays([t.column("chunk").combine_chunks().cast(pa.int64()), pa.nulls(1, pa.int64())]),
                         "bucket": pa.array([t.column("bucket")[0].as_py()] * (len(out) + 1), pa.int64()),
                         "words": pa.array([*out, own.astype("<f8").tobytes()], pa.binary())})

    return blobs.groupBy("bucket").applyInArrow(run, "chunk long, bucket long, words binary")


def own_round(coded: DataFrame, model: Model, known: Symbols, buckets: int) -> tuple[Model, DataFrame, DataFrame, float]:
    """The last Baum-Welch step, every word on its own: the model, the texts in chunks, what
    each chunk gets of its words, and the likelihood before.  ``coded`` is removed on the way."""
    k = len(model.first)
    parts = written(dealt(coded, model, known, buckets), "dealt")
    discard(coded)  # its texts stand in chunks now
    like, *rest = summed(parts.where("key IS NOT NULL").select("key", *[f"s{i}" for i in range(k)]), k, known.fixed)
    replies = written(added_up(parts.where("words IS NOT NULL").select("chunk", "bucket", "words"), k), "replies")
    sums = replies.where("chunk IS NULL").select("words").mapInArrow(by_state(k), columns(k, "double"))
    own = np.array([x or 0.0 for x in sums.agg(*[F.sum(f"s{i}") for i in range(k)]).first()])
    return (maximise(known, *rest, own), parts.where("symbols IS NOT NULL").select("chunk", "doc_id", "held_out", "n_tokens", "symbols", "rare"),
            replies.where("chunk IS NOT NULL"), like)


def by_state(states: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([np.frombuffer(w, "<f8") for w in b.column("words").to_pylist()]).reshape(-1, states)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in x.T], [f"s{i}" for i in range(states)])

    return run


def train(coded: DataFrame, known: Symbols, buckets: int, states: int = STATES,
          rounds: int = ROUNDS) -> tuple[Model, DataFrame, DataFrame, list[float]]:
    """The model, the texts in chunks, the words of every chunk, and the likelihood before every round."""
    model, likes = start_model(known, states), []
    for _ in range(rounds - 1):
        model, like = tied_round(coded, model, known)
        likes.append(like)
    model, texts, words, like = own_round(coded, model, known, buckets)
    return model, texts, words, [*likes, like]


def likelihoods(texts: DataFrame, words: DataFrame, model: Model, known: Symbols) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base_log, score): log10 of the probability of the
    symbols, and the sum of the logarithms of their counts."""
    shared = texts.sparkSession.sparkContext.broadcast((model, known))
    kind = texts.schema["doc_id"].dataType.elementType.simpleString()
    k = len(model.first)

    def run(chunk: pa.Table, replies: pa.Table) -> pa.Table:
        base, s = shared.value
        _ROOM.clear()  # a worker may have been at the training
        pa.default_memory_pool().release_unused()
        # Buckets are ranges of hashes: in their order the words stand as in the chunk's list.
        order = np.argsort(replies.column("bucket").to_numpy())
        blobs = [replies.column("words")[int(i)].as_buffer() for i in order]
        n, at = np.zeros(sum(len(b) for b in blobs) // (5 + 2 * k)), 0
        m = replace(base, emit=np.empty((s.fixed + len(n), k)))
        m.emit[:s.fixed] = base.emit
        for b in blobs:
            size = len(b) // (5 + 2 * k)
            n[at:at + size] = np.frombuffer(b, "<u4", size, size)
            m.emit[s.fixed + at:s.fixed + at + size] = own_emissions(
                base, s, n[at:at + size], np.frombuffer(b, np.uint8, size).astype(np.int64),
                np.frombuffer(b, np.float16, k * size, 5 * size).reshape(k, size).T.astype(float))
            at += size
        del blobs
        counts = np.concatenate([s.counts, np.zeros(CLASSES), n])
        logs, seen = np.log10(counts + ADD), counts > 0
        rows = [r for b in chunk.to_batches() for r in blob_rows(b)]
        c = Coded(rows)
        late = c.sym > s.end
        ends = np.cumsum([0, *[sum(r["n_tokens"]) for r in rows]])
        c.sym[late] = s.fixed + np.concatenate([unpacked(r["rare"], int(np.count_nonzero(late[a:b])))
                                                for r, a, b in zip(rows, ends, ends[1:], strict=False)])
        coded, ids = c.texts(c.sym), [i for r in rows for i in r["doc_id"]]
        del rows, late
        out = np.zeros(len(coded))
        for g in groups(coded):
            out[g] = forward(m, *side_by_side([coded[i] for i in g]), False)[0] / math.log(10)
        return pa.table([pa.array(ids, chunk.schema.field("doc_id").type.value_type),
                         pa.array(c.held), pa.array(c.sizes), pa.array([int(seen[x].sum()) for x in coded], pa.int64()),
                         pa.array([float(logs[x].sum()) for x in coded], pa.float64()), pa.array(out)],
                        ["doc_id", "held_out", "n_tokens", "n_known", "base_log", "score"])

    return texts.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_log double, score double")


def score(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, share: int = SHARE, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``."""
    rows = docs.select("doc_id", (crc_mod("doc_id", FOLDS) == 0).alias("held_out"), "text")
    training = rows.where("NOT held_out")
    counts = written(word_counts(training.select("text")), "counts")
    known = symbols(counts, training.count(), share)
    discard(counts)
    coded = written(encode(rows, known), "coded")
    model, texts, words, _ = train(coded, known, 1 + int(known.cold_mass.sum()) // bucket, states, rounds)
    return likelihoods(texts, words, model, known).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base_log") - F.col("n_tokens") * known.base_log).alias("base_score"), "score")


def op3_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir, "doc_id", "text"))
