"""Ranked lexical search against a plain version and its SQL."""
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import lexical

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(docs, items, top=20):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        asked, scored = Counter(terms(text)), []
        for i, c in counts:
            m = 75 + 25 * c.total() * n_docs // n_terms
            s = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t, k in asked.items() if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    extra = {c: F.lit("?") for c in ("n", "terms", "tf", "rank", "score", "item", "part")}
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns(extra).repartition(5)
    return d, spark.createDataFrame(items, "item_id int, text string").withColumns(extra)


def rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_terms_of_whole_texts(monkeypatch):
    monkeypatch.setattr(lexical, "PART", 5)
    for t in ["", "A b-C_d É日本 x\x00y\x7fz", "aaa " * 50, "é" * 40, "  .  ", "0Z`[{@/:", "a" * 30 + " b"]:
        want = Counter(x.encode() for x in terms(t))
        assert lexical.term_counts(t.encode()) == want
    assert lexical.term_counts(None) == Counter()


@pytest.mark.parametrize("top, cells, block", [(20, 1 << 22, 1 << 22), (3, 200, 500)])
def test_ranking_equals_plain_version(spark, top, cells, block):
    rng = random.Random(top)
    word = lambda: rng.choice("abcdefghij") * rng.choice([1, 1, 2]) + rng.choice(["", "É", "X"])
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 25)))) for i in range(200)]
    docs += [(None, "aa bb cc"), (5, "a b c d"), (5, "a b c d"), (300, None), (301, ""), (302, "..."), (303, "a " * 3000)]
    items = [(i, " ".join(word() for _ in range(rng.randint(0, 12)))) for i in range(12)]
    items += [(3, "a b c"), (3, "a b c"), (20, None), (21, ""), (22, "zzz"), (23, "a a a A"), (None, "b c"),
              (24, " ".join(f"{x}{y}" for x in "abcdefghij" for y in "abcdefghij") + " a b c dd")]
    d, q = frames(spark, docs, items)
    assert rows(lexical.ranked(d, q, top=top, block_bytes=block, cells=cells)) == plain(docs, items, top)


def test_empty_tables(spark):
    d, q = frames(spark, [(1, "a")], [(1, "a")])
    for x, y in ((d.limit(0), q), (d, q.limit(0)), (d.where("false"), q.where("false")), (d.withColumn("text", F.lit("..")), q)):
        assert rows(lexical.ranked(x, y)) == []


def test_search_stops_before_hopeless_masks():
    rng = np.random.default_rng(3)
    n, k = 4000, 12
    present = rng.random((k, n)) < 0.3
    gain = np.where(present, rng.integers(90, 100, (k, n)), 0)
    item = lexical.Item(Counter({t: 1 + t % 2 for t in range(k)}))
    done = item.search(present, gain, gain.max(axis=1), np.arange(n), 20)
    score = (gain * (1 + np.arange(k) % 2)[:, None]).sum(0)
    best = np.lexsort((np.arange(n), -score))[:20]
    assert item.ids.tolist() == best.tolist() and item.scores.tolist() == score[best].tolist()
    assert done < n / 4
    assert len(np.unique(item.masks(present)[:, 0])) == len({x.tobytes() for x in present.T})


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = lexical.op13_presence_masks(spark, SF)
    cur = con.execute(lexical.oracle())
    assert rows(df) == sorted(cur.fetchall(), key=repr) and df.columns == [c[0] for c in cur.description]
