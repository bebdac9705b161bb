"""Packing, sharding and the pipeline."""
import itertools
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import bpe, packing, sharding

SF = "/root/testdata/sf0.001"


def least_bins(items, capacity):
    """Fewest bins, by trying every first bin (small instances)."""
    items = sorted(items, reverse=True)
    if not items:
        return 0
    first, rest, best = items[0], items[1:], len(items)
    for k in range(len(rest) + 1):
        for extra in set(itertools.combinations(range(len(rest)), k)):
            if first + sum(rest[i] for i in extra) <= capacity:
                left = [x for i, x in enumerate(rest) if i not in extra]
                best = min(best, 1 + least_bins(left, capacity))
    return best


def test_fixed_sets_never_cost_a_bin():
    rng = random.Random(1)
    for _ in range(150):
        items = [rng.randint(1, 12) for _ in range(rng.randint(1, 7))]
        counts = Counter(items)
        fixed = packing.reduce_instance(counts, 12)
        assert all(sum(s) <= 12 and t > 0 for s, t in fixed)
        assert sum(t for _, t in fixed) + least_bins(list(counts.elements()), 12) == least_bins(items, 12), items


def test_plan_places_every_piece_once():
    rng = random.Random(2)
    for low, high, n in [(1, 1024, 5000), (1, 60, 3000), (300, 700, 4000), (1024, 1024, 10), (1, 1, 5000)]:
        h = Counter(rng.randint(low, high) for _ in range(n))
        fill, placed = defaultdict(list), Counter()
        for size, first, times, sequence, offset in packing.plan(h):
            assert first == placed[size]
            placed[size] += times
            for i in range(times):
                fill[sequence + i].append((offset, size))
        assert placed == h
        for parts in fill.values():
            at = 0
            for offset, size in sorted(parts):
                assert offset == at
                at += size
            assert at <= 1024
        total = sum(k * v for k, v in h.items())
        assert len(fill) <= 1.03 * -(-total // 1024) + 1


def check_pieces(rows, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.default_vocabulary())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for i, parts in by_doc.items():
        ids = np.array(t.encode(texts[i] or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for n, r in enumerate(sorted(parts, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (n, at)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            assert r["length"] == 1024 or n == 0
            at += r["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_packed_documents(spark, tmp_path):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    rows = packing.op2_dominance_packing(spark, SF).collect()
    check_pieces(rows, texts)
    tokens = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= 1.05 * tokens / 1024 + 1
    odd = [(1, None), (2, ""), (3, "<|endoftext|> x"), (4, "word " * 3000), (5, "a")]
    spark.createDataFrame([(*r, "z", 3) for r in odd], "doc_id long, text string, piece string, length int").write.parquet(
        f"{tmp_path}/documents.parquet")
    check_pieces(packing.op2_dominance_packing(spark, str(tmp_path)).collect(), dict(odd))
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert packing.op2_dominance_packing(spark, f"{tmp_path}/none").collect() == []


def test_repeated_ids_are_packed_as_so_many(spark):
    df = spark.createDataFrame([(1, 0, 600)] * 3 + [(None, 0, 400)] * 2, "doc_id long, piece int, length long")
    rows = packing.pack(df).collect()
    assert len(rows) == 5 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 5
    assert len({r["sequence_id"] for r in rows}) == 3


def shard_rows(n, hot):
    rng = random.Random(n)
    return [(i, rng.choice([None, "a", "b", "c"]) if rng.random() > hot else "hot") for i in range(n)]


@pytest.mark.parametrize("n,hot", [(0, 0), (1, 0.5), (23, 0.5), (24, 0), (1000, 0.4)])
def test_shards_hold_the_mixture(spark, n, hot):
    rows = shard_rows(n, hot)
    df = spark.createDataFrame(rows, "doc_id long, source string").withColumn("shard_", F.lit(1)).repartition(3)
    got = sharding.assign_shards(df, 24, "source", ["doc_id"]).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(n))
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    if n >= 24:
        assert set(by) == set(range(24))
        assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    total = Counter(s for _, s in rows)
    for part in by.values():
        for s, k in Counter(r["source"] for r in part).items():
            assert abs(k - total[s] * len(part) / n) <= 2
    again = sharding.assign_shards(df.repartition(5), 24, "source", ["doc_id"]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again)) if not any(None in tuple(r) for r in got) else len(again) == n


def test_shards_of_repeated_and_single_rows(spark):
    df = spark.createDataFrame([(1, "a")] * 50 + [(i, f"s{i}") for i in range(50)] + [(None, None)] * 4, "doc_id long, source string")
    got = sharding.assign_shards(df, 7, "source", ["doc_id"]).collect()
    assert Counter(r["shard"] for r in got) == Counter({i: 104 // 7 + (i < 104 % 7) for i in range(7)}) or \
        max(Counter(r["shard"] for r in got).values()) - min(Counter(r["shard"] for r in got).values()) <= 1
    assert len({(r["shard"], r["slot"]) for r in got}) == 104


def test_shard_query(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    rows = sharding.op5_stratified_interleave(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "rows", None)


# ------------------------------------------------------------------ pipeline


def write(spark, folder, docs, labels, cols="doc_id long, text string, lang string, source string, n_chars long, id string, _id string, _th string, _score string"):
    spark.createDataFrame(docs, cols).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_pipeline_equals_its_stages_one_by_one(spark, tmp_path):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() + rng.choice(["", "", ".", ","]) for _ in range(n))
    texts = [prose(rng.randint(60, 200)) for _ in range(60)]
    junk = ["buy " * rng.randint(60, 90) for _ in range(25)]
    passage = prose(60)
    texts[5] = passage + " " + texts[5]
    texts[9] = texts[9] + " " + passage
    texts[20] = texts[11]
    texts[21] = " ".join(texts[12].split()[:-1])
    block = prose(30)
    texts[30] = prose(60) + f" {block} and {block}"
    docs = [(i, t, "en", "s", len(t), "q", "i", "t", "x") for i, t in enumerate(texts + junk + ["", "few words"])] + [(None,) * 9]
    labels = [(i, 1, 0) for i in range(60)] + [(i, 0, 0) for i in range(60, 85)]
    write(spark, tmp_path, docs, labels)
    docs_df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    cur = docs_df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, cur, str(tmp_path))
        assert out.columns == docs_df.columns
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        cur = spark.read.parquet(path)
        kept[name] = {r["doc_id"]: r["text"] for r in cur.collect()}
    assert not any(i is not None and 60 <= i < 85 for i in kept["quality_classifier"])
    assert set(range(60)) <= set(kept["quality_classifier"])
    assert set(kept["quality_rules"]) == set(range(60)) - {30}
    assert set(kept["near_duplicates"]) == set(range(60)) - {30, 20, 21}
    last = kept["substring_dedup"]
    assert last[5] == texts[5] and last[9].split() == texts[9].split()[:-60]
    assert {i: t for i, t in last.items() if i != 9} == {i: t for i, t in kept["near_duplicates"].items() if i != 9}
    rows = corpus_pipeline.STAGES[-1][1](spark, cur, str(tmp_path)).collect()
    check_pieces(rows, last)
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, rows))


def test_pipeline_of_an_empty_table(spark, tmp_path):
    write(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("blank", [" ", "\t", "\n"])
def test_a_million_blanks_in_a_row(spark, blank):
    from tokenizers import Tokenizer
    texts = ["a" + blank * 1_100_000 + "b c", blank * 60_000, "x " * 60_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tok = Tokenizer.from_file(bpe.default_vocabulary())
    got = defaultdict(list)
    for r in sorted(packing.pieces(docs).collect(), key=lambda r: (r["doc_id"], r["piece"])):
        got[r["doc_id"]] += np.frombuffer(r["ids"], "<u4").tolist()
    for i in (0, 1, 2) if blank == " " else (0, 1):
        assert got[i] == [*tok.encode(texts[i], add_special_tokens=False).ids, packing.END]


def test_packing_stage_takes_long_blanks(spark, tmp_path):
    rows = [(1, "a" + " " * 1_200_000 + "b", "en", "s", 1), (2, "\n" * 1_200_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)["best_fit_packing"]
    for got in (stage(spark, docs, str(tmp_path)), packing.op2_dominance_packing(spark, str(tmp_path))):
        ends = got.groupBy("doc_id").agg(F.max(F.col("start") + F.col("length")).alias("n")).collect()
        assert {r["doc_id"] for r in ends} == {1, 2} and all(r["n"] > 2 for r in ends)
