import hashlib
import random

import pyarrow as pa
import pytest

from strata.llm import substrings


def brute(rows, window=50):
    """(id, text) -> (n_words, n_removed, digest of the kept words)."""
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passages = [[word() for _ in range(rng.choice([49, 50, 51, 60, 130]))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = [word() for _ in range(rng.choice([0, 3, 20, 80, 300]))]
        for _ in range(rng.choice([0, 1, 1, 2])):
            p = list(rng.choice(passages))
            if rng.random() < 0.4:
                p[rng.randrange(len(p))] = word()
            at = rng.randint(0, len(w))
            w[at:at] = p
        if rng.random() < 0.15 and rows:
            w = rows[rng.randrange(len(rows))].split()
            if rng.random() < 0.5 and w:
                w[rng.randrange(len(w))] = word()
        if rng.random() < 0.06:
            w = ["same"] * rng.choice([30, 60, 120]) + w
        rows.append(rng.choice([" ", "\n", "  "]).join(w))
    return list(enumerate(rows, 3))


def got(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    out = []
    for r in substrings.with_spans(df).collect():
        n, kept = substrings.kept_words(r["text"], r["__llm_spans"])
        out.append((r["doc_id"], n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed, 150)
    assert got(spark, rows) == sorted(brute(rows), key=str)


def test_large_groups_by_neighbours_and_windows(spark, monkeypatch):
    rows = corpus(3, 120)
    monkeypatch.setattr(substrings, "MOST", 3)
    assert got(spark, rows) == sorted(brute(rows), key=str)


def test_small_shards(monkeypatch):
    rng = random.Random(5)
    group = sorted((rng.randrange(20), [rng.choice("ab") for _ in range(rng.randint(1, 30))]) for _ in range(60))
    monkeypatch.setattr(substrings, "SHARD", 4)
    found = substrings.match_group(group, 6)
    for (i, w), spans in zip(group, found):
        inside = [any(a <= k < z for a, z in spans) for k in range(len(w))]
        seen = {tuple(v[k:k + 6]) for j, v in group if j < i for k in range(len(v) - 5)}
        want = [any(tuple(w[s:s + 6]) in seen and len(w[s:s + 6]) == 6 for s in range(max(0, k - 5), k + 1)) for k in range(len(w))]
        assert inside == want


def test_nulls_repeats_and_rest_of_a_row(spark):
    p = " ".join(f"x{i}" for i in range(55))
    rows = [(1, p, "a", 9), (1, p + " end", "b", 9), (2, "one  two\n" + p, "c", 9), (None, p, "d", 9), (3, None, "e", None),
            (4, "", None, 0), (5, "short  text", "g", 11)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string, n_chars long")
    out = {(r["doc_id"], r["id"]): (r["text"], r["n_chars"]) for r in substrings.remove_repeats(df).collect()}
    assert out == {(1, "a"): (p, 9), (1, "b"): (p + " end", 9), (2, "c"): ("one two", 7), (None, "d"): ("", 0),
                   (3, "e"): (None, None), (4, None): ("", 0), (5, "g"): ("short  text", 11)}
    assert substrings.remove_repeats(df.limit(0)).collect() == []


def test_anchors_do_not_depend_on_the_step(monkeypatch):
    rng = random.Random(9)
    words = [rng.choice(["a", "b"]) for _ in range(900)] + ["x"] * 300  # many ties
    w = substrings.Words(pa.array([" ".join(words), " ".join(words[100:700])]))
    whole = substrings.find_anchors(w)
    for step in (1, 7, 64, 1000):
        monkeypatch.setattr(substrings, "STEP", step)
        assert all((x == y).all() for x, y in zip(substrings.find_anchors(w), whole))


def test_query_equals_its_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    cur = con.execute(substrings.oracle())
    df = substrings.op10_suffix_automata(spark, sf).select(*[c[0] for c in cur.description])
    assert sorted(map(tuple, df.collect())) == sorted(cur.fetchall())
