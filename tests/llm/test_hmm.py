import math
import random
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from strata.llm import hmm


def plain_forward(model, sym):
    a = model.first * model.emit[sym[0]]
    for s in sym[1:]:
        a = (a @ model.move) * model.emit[s]
    return a.sum()


def random_model(rng, k, n):
    f, m, e = rng.random(k), rng.random((k, k)), rng.random((n, k))
    return hmm.Model(f / f.sum(), m / m.sum(1)[:, None], e / e.sum(0))


def test_forward_equals_the_plain_sum():
    rng = np.random.default_rng(1)
    m = random_model(rng, 3, 7)
    texts = sorted((rng.integers(0, 7, n) for n in [40, 33, 17, 16, 5, 1, 1]), key=len, reverse=True)
    like, _, _ = hmm.forward(m, *hmm.side_by_side(texts), False)
    assert np.allclose(like, [math.log(plain_forward(m, t)) for t in texts])


def test_probabilities_of_all_texts_add_up():
    rng = np.random.default_rng(2)
    m = random_model(rng, 3, 4)
    import itertools
    assert math.isclose(sum(plain_forward(m, t) for t in itertools.product(range(4), repeat=5)), 1.0)


def test_expected_counts_equal_enumeration():
    import itertools
    rng = np.random.default_rng(3)
    m = random_model(rng, 2, 3)
    texts = [np.array([0, 2, 1, 1]), np.array([2, 0, 1]), np.array([1])]
    like, first, moves, emitted = hmm.expected(m, *hmm.side_by_side(texts))
    f, mv, em, total = np.zeros(2), np.zeros((2, 2)), np.zeros((2, 3)), 0.0
    for t in texts:
        p = {}
        for path in itertools.product(range(2), repeat=len(t)):
            q = m.first[path[0]] * m.emit[t[0], path[0]]
            for a, b, s in zip(path, path[1:], t[1:]):
                q *= m.move[a, b] * m.emit[s, b]
            p[path] = q
        z = sum(p.values())
        total += math.log(z)
        for path, q in p.items():
            f[path[0]] += q / z
            for s, a in zip(t, path):
                em[a, s] += q / z
            for a, b in zip(path, path[1:]):
                mv[a, b] += q / z
    assert math.isclose(like, total)
    assert np.allclose(first, f) and np.allclose(moves, mv) and np.allclose(emitted, em)


def test_long_texts_keep_their_scale():
    rng = np.random.default_rng(4)
    m = random_model(rng, 4, 500)
    long = rng.integers(0, 500, 5000)
    like, *_ = hmm.expected(m, *hmm.side_by_side([long, long[:3]]))
    logs, a = 0.0, None
    for i, s in enumerate(long):
        a = (m.first if a is None else a @ m.move) * m.emit[s]
        logs += math.log(a.sum())
        a = a / a.sum()
    assert math.isclose(like, logs + math.log(plain_forward(m, long[:3])), rel_tol=1e-9)


def test_a_training_step_keeps_two_arrays_of_a_group(monkeypatch):
    rng = np.random.default_rng(5)
    m, tokens = random_model(rng, hmm.STATES, 60_000), 60_000
    monkeypatch.setattr(hmm, "TOKENS", tokens)
    monkeypatch.setattr(hmm, "_ROOM", {})
    group = hmm.side_by_side([rng.integers(0, 60_000, n) for n in sorted(rng.integers(1, 300, 400), reverse=True)])
    into = np.zeros((hmm.STATES, 60_000))
    assert len(group[0]) < tokens
    tracemalloc.start()
    try:
        gamma = hmm.expected(m, *group, into)[3]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert math.isclose(gamma.sum(), len(group[0])) and gamma is into
    # Emissions and alpha of a group; the rest is of the size of a step, of a block or of one state.
    assert peak < 3 * tokens * hmm.STATES * 8


def test_words_of_a_chunk_are_listed_in_order_of_hash(monkeypatch):
    monkeypatch.setattr(hmm, "TOKENS", 100)
    rng = np.random.default_rng(7)
    for size in (0, 1, 5000):
        some = rng.integers(0, 1 << 64, 900, np.uint64)
        rare, training = rng.choice(some, size), rng.random(size) < 0.8
        cls = (rare % np.uint64(hmm.CLASSES)).astype(np.uint8)
        words, kinds, n, place = hmm.listed(rare, cls, training)
        assert (words == np.unique(rare)).all() and (words[place] == rare).all() and (kinds[place] == cls).all()
        assert n.tolist() == [int((training & (rare == w)).sum()) for w in words]


class Broadcast:
    sparkContext = property(lambda self: self)

    def broadcast(self, value):
        self.value = value
        return self


class Chunks:
    """Stands for a table of coded texts whose tasks run here."""

    def __init__(self, rows):
        self.sparkSession, self.rows = Broadcast(), rows
        self.schema = StructType([StructField("doc_id", ArrayType(LongType()))])

    def mapInArrow(self, run, _):
        return list(run(iter(self.rows)))


def test_the_last_round_holds_little_more_than_its_words_besides_the_chunk(monkeypatch):
    monkeypatch.setattr(hmm, "TOKENS", 3000)
    monkeypatch.setattr(hmm.groups, "__defaults__", (3000,))
    monkeypatch.setattr(hmm, "_ROOM", {})
    monkeypatch.setattr(hmm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rng = np.random.default_rng(8)
    sizes, k = [200] * 1000, hmm.STATES
    tokens = sum(sizes)
    hot = {b"%d" % i: i for i in range(50)}
    mass = np.full(hmm.CLASSES, 1000.0)
    known = hmm.Symbols(hot, np.full(51, 500.0), np.arange(50), np.arange(50), np.full(hmm.CLASSES, 400.0), mass, 256_000, 102_400)
    hashes = rng.integers(0, 1 << 64, 100_000, np.uint64)
    pick = np.concatenate([rng.permutation(80_000), rng.integers(80_000, 100_000, 120_000)])  # 80,000 words occur once
    rare = hashes[pick]
    sym = (rare % np.uint64(hmm.CLASSES)).astype(np.int64) + 51
    model = hmm.start_model(known)
    schema = pa.schema([("doc_id", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("n_tokens", pa.list_(pa.int64())),
                        ("symbols", pa.binary()), ("rare", pa.binary())])
    row = pa.RecordBatch.from_pydict({"doc_id": [list(range(1000))], "held_out": [[False] * 1000], "n_tokens": [sizes],
                                      "symbols": [hmm.packed(sym)], "rare": [rare.tobytes()]}, schema)
    hmm.dealt(Chunks([row]), model, known, 4)  # what is imported on the way does not count
    tracemalloc.start()
    try:
        out = hmm.dealt(Chunks([row]), model, known, 4)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    got, total = {}, np.zeros(k)
    for x in (x for b in out for x in b.column("words").to_pylist() if x):
        h, cls, n, share = hmm.read_words(x, k)
        got |= dict(zip(h.tolist(), n.tolist()))
        total += share.astype(float) @ n
        assert np.allclose(share.astype(float).sum(0), 1, atol=0.01) and (cls == h % np.uint64(hmm.CLASSES)).all()
    assert got == dict(Counter(rare.tolist()))
    assert math.isclose(total.sum(), tokens, rel_tol=1e-3)
    # Counts of 20,000 words by state and the 16-bit shares of 100,000; the rest is a few numbers a token.
    assert peak < 20_000 * k * 8 + 100_000 * k * 2 + 40 * tokens


def rows_of(seed, n):
    rng = random.Random(seed)
    langs = [[f"{p}{i}" for i in range(60)] for p in "abc"]
    rows = []
    for i in range(n):
        v = langs[i % 3]
        rows.append((i, " ".join(rng.choice(v) if rng.random() < 0.9 else f"x{rng.randrange(2000)}"
                                 for _ in range(rng.choice([0, 1, 5, 60, 200])))))
    return rows + [(n, None), (n + 1, "  \n"), (n + 2, "A0 a0 B7 b7")]


def test_scores(spark):
    rows = rows_of(1, 150)
    df = spark.createDataFrame(rows + [rows[3], (None, "a1 a2")], "doc_id long, text string").repartition(3)
    out = {r["doc_id"]: r for r in hmm.score(df, states=3, rounds=8, share=150).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    tokens = {i: (t or "").lower().split() + ["</s>"] for i, t in rows}
    c = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    c.update(["</s>"] * (not held[3]) + tokens[3][:-1] * (not held[3]))
    # The row without an id falls into fold 0: it is held out.
    n, v = sum(c.values()), len(c)
    for i, t in tokens.items():
        r = out[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(t), n)
        assert r["n_known"] == sum(c[w] > 0 for w in t)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9, abs_tol=1e-9)
    test = [out[i] for i in tokens if held[i] and len(tokens[i]) > 20]
    assert sum(r["score"] for r in test) > sum(r["base_score"] for r in test) + 10


def test_scores_do_not_depend_on_chunks_and_buckets(spark, monkeypatch):
    rows = rows_of(2, 90)
    one = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    runs = [hmm.score(one, states=3, rounds=4, share=150).collect(),
            hmm.score(one.repartition(5), states=3, rounds=4, share=150, bucket=200).collect()]
    monkeypatch.setattr(hmm, "CHUNK", 300)
    runs.append(hmm.score(one.repartition(2), states=3, rounds=4, share=150, bucket=500).collect())
    first, *others = [{r["doc_id"]: r for r in run} for run in runs]
    for i, r in first.items():
        for other in others:
            # Shares of a word's count are rounded to 16 bits in every chunk.
            assert math.isclose(r["score"], other[i]["score"], rel_tol=1e-3)
            assert math.isclose(r["base_score"], other[i]["base_score"], rel_tol=1e-9)
            assert r["n_known"] == other[i]["n_known"]


def plain_scores(rows, states, rounds, share):
    """The same model by dictionaries in one place: emissions by word, no chunks, no blobs."""
    texts = {i: (t or "").lower().encode().split() for i, t in rows}
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for t in train for w in t)
    n = sum(c.values())
    hot = sorted((w for w in c if c[w] >= -(-n // share)), key=lambda w: (-c[w], w))
    cold = sorted(set(c) - set(hot))
    v, mass = Counter(map(hmm.class_of, c)), Counter()
    for w in c:
        mass[hmm.class_of(w)] += c[w]
    whole = n + len(train) + 0.1 * (len(c) + 2)
    total_v = sum(v[k] + 1 for k in range(256))
    unseen = {k: 0.1 * (v[k] + 1) / total_v / whole for k in range(256)}
    prior = {w: (c[w] + 0.1) / whole for w in c} | {"end": (len(train) + 0.1) / whole}
    tied = {w: prior[w] for w in [*hot, "end"]} | {k: unseen[k] + sum(prior[w] for w in cold if hmm.class_of(w) == k) for k in range(256)}
    return texts, train, c, hot, cold, v, mass, prior, unseen, tied


@pytest.mark.parametrize("share", [150, 1, 10**9])
def test_scores_equal_a_plain_training(spark, share):
    states, rounds, rows = 3, 3, rows_of(5, 60)
    texts, train, c, hot, cold, v, mass, prior, unseen, tied = plain_scores(rows, states, rounds, share)
    assert math.isclose(sum(tied.values()), 1.0) and math.isclose(sum(prior.values()) + sum(unseen.values()), 1.0)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    hashes = {bytes(r["w"]): r["h"] for r in spark.createDataFrame([(w,) for w in c], "w binary").selectExpr("w", "xxhash64(w) h").collect()}
    names = [*hot, "end", *range(256)]
    start = np.array([tied[x] for x in names])[:, None] * np.exp(
        hmm.noise(np.array([*[hashes[w] for w in hot], *range(257)], np.int64), states))
    emit = dict(zip(names, start / start.sum(0)))
    first, move = np.full(states, 1 / states), np.where(np.eye(states) > 0, 0.9, 0.1 / (states - 1))
    for step in range(rounds):
        last = step == rounds - 1
        got = {x: np.zeros(states) for x in [*names, *cold]}
        f, m = np.full(states, 0.1), np.full((states, states), 0.1)
        for t in train:
            seq = [*t, "end"]
            e = np.array([emit[x if x in emit else hmm.class_of(x)] for x in seq])
            a, b = np.zeros((len(seq), states)), np.ones((len(seq), states))
            a[0] = first * e[0] / (first * e[0]).sum()
            for i in range(1, len(seq)):
                a[i] = (a[i - 1] @ move) * e[i]
                a[i] /= a[i].sum()
            for i in range(len(seq) - 1, 0, -1):
                b[i - 1] = move @ (e[i] * b[i])
                b[i - 1] /= b[i - 1].sum()
                x = move * np.outer(a[i - 1], e[i] * b[i])
                m += x / x.sum()
            g = a * b / (a * b).sum(1)[:, None]
            f += g[0]
            for x, y in zip(seq, g):
                got[x if x in got else hmm.class_of(x)] += y
        by_class = {k: sum((got[w] for w in c if hmm.class_of(w) == k), np.zeros(states)) for k in range(256)}
        rate = {k: by_class[k] / max(mass[k], 1) for k in range(256)}
        smoothed = {w: 0.7 * got[w] + 0.3 * c[w] * rate[hmm.class_of(w)] + 20 * prior[w] for w in c} | {"end": got["end"] + 20 * prior["end"]}
        rest = {k: 0.1 / (mass[k] + 0.1 * (v[k] + 1)) * by_class[k] + 20 * unseen[k] for k in range(256)}
        total = sum(smoothed.values()) + sum(rest.values())
        if not last:
            rest = {k: rest[k] + sum((smoothed[w] for w in cold if hmm.class_of(w) == k), np.zeros(states)) for k in range(256)}
            smoothed = {w: smoothed[w] for w in [*hot, "end"]}
        emit = {x: y / total for x, y in [*smoothed.items(), *rest.items()]}
        assert np.allclose(sum(emit.values()), 1.0)
        first, move = f / f.sum(), m / m.sum(1)[:, None]
    assert set(emit) == {*c, "end", *range(256)}  # every training word has emissions of its own
    for r in hmm.score(df, states=states, rounds=rounds, share=share).collect():
        log, a = 0.0, None
        for x in [*texts[r["doc_id"]], "end"]:
            a = (first if a is None else a @ move) * emit[x if x in emit else hmm.class_of(x)]
            log, a = log + math.log10(a.sum()), a / a.sum()
        assert math.isclose(r["score"], log, rel_tol=1e-3)


def test_long_text_repeated_rows_and_other_columns(spark):
    long = " ".join(f"w{i % 700}" for i in range(40_000))
    rows = [(1, long, "a"), (2, long, "b"), (2, long, "c"), (3, "", None), (4, None, None), (None, None, None)]
    out = hmm.score(spark.createDataFrame(rows, "doc_id long, text string, symbols string"), states=2, rounds=2, share=50)
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = out.collect()
    assert sorted(r["n_tokens"] for r in got) == [1, 1, 1, 40_001, 40_001, 40_001]
    assert len({r["score"] for r in got if r["n_tokens"] > 1}) == 1


def test_only_empty_and_held_out_texts(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    out = hmm.score(spark.createDataFrame([(held, "a b"), (held, None)], "doc_id long, text string"), states=2, rounds=2).collect()
    assert {(r["held_out"], r["n_known"], r["train_tokens"]) for r in out} == {(True, 0, 0)}
    assert all(math.isfinite(r["score"]) for r in out)


def test_numbers_come_back_from_their_blob():
    rng = np.random.default_rng(6)
    for n in (0, 1, 1000):
        x = rng.integers(0, 1 << 32, n).astype("<u4")
        assert (hmm.unpacked(hmm.packed(x), n) == x).all()


def test_empty_table(spark):
    assert hmm.score(spark.createDataFrame([], "doc_id long, text string"), states=2, rounds=1).collect() == []


@pytest.mark.parametrize("words", [[], [b"a"], [b"xyz", b"uvxyz"]])
def test_classes_depend_on_the_end_of_a_word(words):
    assert len({hmm.class_of(w) for w in words}) <= 1
