"""Phrase collocations against a plain version and their SQL."""
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import phrases

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER))]


def plain(rows, depth, least, share):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for p in pieces(text):
            n[lang] += len(p)
            f.update((lang, *p[i:i + k]) for k in range(1, depth + 1) for i in range(len(p) - k + 1))
    out = []
    candidates = [g for g, a in f.items() if len(g) > 2 and a >= least]
    most = defaultdict(int)
    for lang, *g in candidates:
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                most[(lang, *g[i:i + k])] = max(most[(lang, *g[i:i + k])], f[(lang, *g)])
    for g in candidates:
        a, (lang, *w) = f[g], g
        if g in most and 100 * most[g] >= share * a:
            continue
        s, k = min((10**6 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, f[(lang, *w[:k])], f[(lang, *w[k:])], n[lang], s))
    return sorted(out)


def table(spark, rows):
    extra = {c: F.lit("?") for c in ("h1", "n", "word", "a", "l", "r", "phrase", "score", "total", "rank", "part", "_h")}
    return spark.createDataFrame(rows, "lang string, text string").withColumns(extra).repartition(4)


@pytest.mark.parametrize("depth", [2, 3, 4, 5])
def test_index_enumerates_all_phrases(depth):
    rng = np.random.default_rng(depth)
    h = rng.integers(0, 5, 400).astype(np.uint64) * np.uint64(1 << 60)  # 0 parts pieces
    found, n = phrases.phrases(h, depth, [None] * depth)
    want = Counter(tuple(h[i:i + depth].tolist()) for i in range(len(h) - depth + 1) if h[i:i + depth].all())
    assert dict(zip(zip(*(x.tolist() for x in found)), n.tolist())) == want


def test_sequence_of_words_and_pieces():
    texts = ["One two. ONE\ttwo", None, "", "...", "a,b c", "A", "É é\x0bx"]
    langs = ["en", "en", "fr", "fr", "en", "fr", "en"]
    h, at, w, row = phrases.sequence(pa.record_batch([pa.array(langs), pa.array(texts)], ["lang", "text"]))
    spelt = iter(zip((langs[r] for r in row), (w.data[a:z].tobytes().lower() for a, z in zip(w.start, w.end))))
    ids, got = {}, []
    for x in h.tolist():
        got.append(0 if not x else ids.setdefault(next(spelt), x))
    assert got == h.tolist() and len(set(ids.values())) == len(ids)  # equal words have equal hashes, others not
    want = [len(p) for t in texts for p in pieces(t) if p]
    assert [len(x) for x in "".join("0" if not x else "1" for x in got).split("0") if x] == want


@pytest.mark.parametrize("depth, least, share, bits", [(3, 10, 50, 1 << 26), (3, 3, 50, 8), (2, 2, 50, 1 << 16), (4, 4, 70, 1 << 16), (5, 2, 100, 1 << 18)])
def test_collocations_equal_plain_version(spark, depth, least, share, bits):
    rng = random.Random(depth + least)
    words = ["the", "The", "of", "new", "york", "city", "a", "été", "x-y", "(b)"]
    def text():
        return "".join(rng.choice([rng.choice(words), "new york city", "of the"]) + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n"])
                       for _ in range(rng.randint(0, 30)))
    rows = [(rng.choice(["en", "en", "fr", None, "und"]), text()) for _ in range(150)]
    rows += [("en", None), ("fr", ""), (None, ". , ;"), ("en", "new york " * 400), ("de", "new york city. " * 12)]
    got = phrases.collocations(table(spark, rows), depth, least, share, shard=300, bits=bits)
    assert sorted(map(tuple, got.select("lang", "phrase", "a", "l", "r", "n", "score").collect())) == plain(rows, depth, least, share)


def test_empty_table_and_ranks(spark):
    assert phrases.ranked(phrases.collocations(table(spark, [("en", "a b")]).limit(0))).collect() == []
    rows = [("en", f"p{i} q{i}. " * (10 + i % 3)) for i in range(20)] + [("fr", "a b. " * 10)]
    got = phrases.ranked(phrases.collocations(table(spark, rows)), top=7).orderBy("lang", "rank").collect()
    want = sorted((r for r in plain(rows, 3, 10, 50)), key=lambda r: (r[0], -r[6], -r[2], r[1]))
    en = [r for r in want if r[0] == "en"][:7]
    assert [(r["lang"], r["rank"], r["phrase"]) for r in got] == [("en", i, r[1]) for i, r in enumerate(en, 1)] + [("fr", 1, "a b")]


def test_scores_of_counts_beyond_64_bits(spark):
    big = [(1, 2, 10**14 + 7, 3 * 10**14 + 1, 2 * 10**14 + 3)]
    rows = spark.createDataFrame(big, "h1 long, h2 long, a long, x long, y long")
    one = spark.createDataFrame([(1, big[0][3]), (2, big[0][4])], "h1 long, n long")
    got = phrases._scored(rows.select("h1", "h2", "a"), [None, one], 2).first()
    assert got["score"] == 10**6 * big[0][2]**2 // (big[0][3] * big[0][4])


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = phrases.op12_phrase_index(spark, SF)
    cur = con.execute(phrases.oracle())
    assert sorted(map(tuple, df.collect())) == sorted(cur.fetchall()) and df.columns == [c[0] for c in cur.description]
