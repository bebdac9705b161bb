"""Operators on single texts, each against a plain version: repetition, byte-pair
encoding, winnowing, licences, quality statistics."""
import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import bpe, common, licences, quality, repetition, winnowing

SF = "/root/testdata/sf0.001"
ODD = ["", None, " \n\t ", "a", "é", "日本 日本", "x" * 5000, "\x00 \x1c\x85  ", "<|endoftext|>", "don't  we'LL\r\n\r\n 'S", "🙂🙂 ’s"]


def table(spark, texts, extra=True):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    # Columns that operators use inside must not get in the way.
    return df.withColumns({c: F.lit("?") for c in ("key", "id", "th", "ids", "x", "score", "kept", "n_words")}) if extra else df


# ------------------------------------------------------------------ words and slices


def test_words_are_those_of_the_pattern():
    import re
    texts = ["a b", "", None, "\x1c x\x85y", "tab\tnew\nline\x0b\x0cend\r", "  lead", "trail  ", "é ü z"]
    w = common.Words(pa.array(texts))
    for i, t in enumerate(texts):
        want = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        got = [w.data[a:z].tobytes().decode() for a, z in zip(w.start[w.first[i]:w.first[i + 1]], w.end[w.first[i]:w.first[i + 1]])]
        assert got == want
    same = common.Words(pa.array(["Ab cd", "aB CD é", "ab", "ba"]), lower=True).hash
    assert same[0] == same[2] and same[1] == same[3] and len(set(same.tolist())) == 4


def test_slices_are_whole_rows_of_bounded_size():
    texts = ["a" * n for n in [10, 0, 50, 3, 3, 3, 200, 1]] + [None]
    batch = pa.record_batch([pa.array(texts)], ["text"]).slice(1)
    parts = list(common.slices([batch, batch.slice(0, 0)], limit=60))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts[1:]
    assert all(sum(len(t or "") for t in p.column("text").to_pylist()) <= 60 or p.num_rows == 1 for p in parts)


# ------------------------------------------------------------------ repetition


def plain_repeats(words, least):
    n, cov, longest, found = len(words), set(), 0, set()
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and words[i + k] == words[j + k]:
                k += 1
            if k >= least:
                cov |= set(range(i, i + k)) | set(range(j, j + k))
                longest = max(longest, k)
                if i == 0 or words[i - 1] != words[j - 1]:
                    found.add(tuple(words[i:i + k]))
    return len(cov), longest, len(found)


def test_repetition_equals_all_pairs_of_places():
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(0, 40))) for _ in range(250)] + ODD
    m = repetition.measure(pa.array(texts), 3, 4)
    for i, t in enumerate(texts):
        words = (t or "").encode().split()
        assert (m["covered_words"][i], m["longest_repeat"][i], m["n_maximal"][i]) == plain_repeats(words, 3)
        assert m["n_repeat_words"][i] == plain_repeats(words, 4)[0]


def base_of(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    again = set()
    for i, x in enumerate(windows):
        if windows.count(x) > 1:
            again |= set(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(len(x.decode()) for x in words), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(again),
            len(words) < 20 or 100 * len(again) > 30 * len(words))


def test_base_figures_and_verdict(spark):
    rng = random.Random(8)
    texts = ODD + ["one # two\n\none # two\n  \n|<>", " ".join(f"w{i}" for i in range(60))]
    texts += [" ".join(rng.choice("abcdefgh") + str(rng.randrange(3)) for _ in range(rng.randint(10, 90))) for _ in range(30)]
    block = " ".join(f"b{i}" for i in range(25))
    texts += [" ".join(f"w{i}" for i in range(70)) + f" {block} middle {block}"]
    df = table(spark, texts)
    got = {r["doc_id"]: r for r in repetition.repetition(df).collect()}
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for i, t in enumerate(texts):
        assert tuple(got[i][n] for n in names) == base_of(t), t
        assert not (got[i]["base_failed"] and got[i]["kept"])
    assert got[len(ODD) + 1]["kept"] and not got[len(texts) - 1]["kept"]
    same = {r["doc_id"]: r["kept"] for r in repetition.passes(df.drop("kept")).collect()}
    assert same == {i: r["kept"] for i, r in got.items()}
    assert repetition.repetition(df.limit(0)).collect() == []


# ------------------------------------------------------------------ byte pairs


def plain_tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.default_vocabulary())


def test_ids_equal_the_library():
    t, enc = plain_tokenizer(), bpe.encoder(bpe.default_vocabulary())
    rng = random.Random(9)
    parts = ["a", "b", "'", "s", "t", "re", "'ll", " ", "  ", "\n", "\t", "é", "ß", "日", "!", "(", "1", "23", "　", "\x1c", "\x85",
             "<|endoftext|>", "<|end", "A", "...", "\r\n", "’s", "🙂", "\x00", "qz", " ", "ñ "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(6000)]
    texts += [x or "" for x in ODD] + ["ab" * 3000 + " z", "'" * 900, "é" * 700]
    texts += [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    for text, ids in zip(texts, enc.encode_column(pa.array(texts))):
        want = t.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text[:80]
        assert enc.decode(ids) == t.decode(want, skip_special_tokens=False) == text


def test_broken_utf8_is_replaced_as_the_library_does():
    t, enc = plain_tokenizer(), bpe.encoder(bpe.default_vocabulary())
    rng = random.Random(3)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(6)]
        assert enc.decode(np.array(ids, "<u4").tobytes()) == t.decode(ids, skip_special_tokens=False)


def test_fragments_are_cut_at_pairs_that_no_token_holds():
    enc = bpe.encoder(bpe.default_vocabulary())
    data, off = common.utf8(pa.array(["one two, three"]))
    at = enc.boundaries(data, off).tolist()
    assert {3, 7, 8} <= set(at)
    for i in at[1:-1]:
        assert not any(data[i - 1:i + 1].tobytes() in tok for tok in enc.vocab)


def test_encode_and_decode_frames(spark):
    df = table(spark, ODD)
    ids = bpe.encode(df)
    back = {r["doc_id"]: r["text"] for r in bpe.decode(ids).collect()}
    assert back == {i: t or "" for i, t in enumerate(ODD)}
    rows = bpe.op9_forced_boundary_bpe(spark, SF).collect()
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    t = plain_tokenizer()
    assert len(rows) == len(texts)
    for r in rows:
        ids = t.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


# ------------------------------------------------------------------ winnowing


def test_winnowing_equals_every_window():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 60))) for _ in range(200)] + ["a" * 50, ""]
    for k, w in ((4, 5), (2, 7), (8, 1), (4, 16)):
        for t, got in zip(texts, winnowing.winnow(texts, k, w)):
            points = np.frombuffer(t.encode("utf-32-le"), np.uint32)
            h = [int(winnowing._grams(points[i:i + k], k)[0]) >> 24 for i in range(len(t) - k + 1)]
            want = []
            for s in range(max(1, len(h) - w + 1)) if h else []:
                part = h[s:s + w]
                p = s + max(i for i, x in enumerate(part) if x == min(part))
                if (min(part) << 24 | p) not in want:
                    want.append(min(part) << 24 | p)
            assert got.tolist() == want or not h


def test_a_shared_passage_is_always_found():
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    for _ in range(60):
        passage = word(winnowing.WINDOW + winnowing.K - 1)
        a, b = winnowing.winnow([word(rng.randint(0, 200)) + passage + word(50), word(rng.randint(0, 200)) + passage])
        shared = set((a >> np.uint64(24)).tolist()) & set((b >> np.uint64(24)).tolist())
        assert shared


def test_fingerprints_of_edited_texts(spark, tmp_path):
    rng = random.Random(5)
    texts = [("".join(rng.choice("abcdefgh é\n") for _ in range(rng.choice([0, 1, 15, 16, 400, 1500])))) for _ in range(70)]
    texts += [texts[3], None, "", "x"]
    ids = list(range(0, 3 * len(texts), 3))
    spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in winnowing.op4_winnowing(spark, str(tmp_path)).collect()}
    assert sorted(got) == ids
    for n, (i, t) in enumerate(zip(ids, texts)):
        t, nxt = t or "", texts[(n + 1) % len(texts)] or ""
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        own, other, edit = winnowing.winnow([t, nxt, edited])
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (winnowing.digest(own), winnowing.digest(edit))
        assert (r["near_edited"], r["near_next"]) == (winnowing.likeness(own, edit), winnowing.likeness(own, other))
    prints = {r["doc_id"]: r["prints"] for r in winnowing.fingerprints(table(spark, ODD)).collect()}
    assert len(prints) == len(ODD) and prints[0] == [] and prints[1] == [] and len(prints[3]) == 1


def test_positions_of_a_very_long_text():
    n = (1 << 24) + 500
    chosen, = winnowing.winnow(["a" * n])
    # All hashes are equal: the rightmost of every window is chosen, each place from the first window's last one on.
    assert (winnowing.places(chosen) == np.arange(winnowing.WINDOW - 1, n - winnowing.K + 1)).all()
    few = winnowing.digest(np.array([5 << 24 | 7, 6 << 24 | 3], np.uint64))
    assert few == f"{5:010x}{7:08x}{6:010x}{(1 << 24) + 3:08x}"


def test_half_a_short_text_leaves_a_common_print():
    rng = random.Random(11)
    for _ in range(300):
        n = rng.randint(62, 230)
        text, other = ("".join(rng.choice("abcdefghij ") for _ in range(n)) for _ in range(2))
        own, edit = winnowing.winnow([text, text[:n - n // 2] + other[:n // 2]])
        assert winnowing.likeness(own, edit) > 0


@pytest.mark.parametrize("rows", [[], [(5, "only one text here")], [(1, "a b"), (1, "a b"), (None, "c d")]])
def test_successors_of_few_rows(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = winnowing.op4_winnowing(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
    if len(rows) == 1:
        assert got[0]["near_next"] == 1.0


# ------------------------------------------------------------------ licences


def test_licences_up_to_form(spark):
    mit = licences.KNOWN["MIT"]
    texts = ["Copyright (c) 2020 Someone\n\n" + mit.upper(), mit.replace("sublicense", "sub-license"), "x " + mit,
             "Released under the MIT licence!", "(c) A\n© B\nLicensed under the Apache License -- version 2.0", None, "",
             "First line\nreleased under the M I T license\nReleased   under the MIT License.\nLICENSED UNDER CC BY NC 4.0"]
    df = table(spark, texts)
    known = licences.known_digests(spark)
    got = {r["doc_id"]: r["text_licence"] for r in licences.scan(df, known).collect()}
    assert got == {0: "MIT", 1: None, 2: None, 3: "MIT-line", 4: "Apache-2.0-line", 5: None, 6: None, 7: None}
    found = {(r["doc_id"], r["licence"], r["lines"]) for r in licences.notices(df, known).collect()}
    assert {x for x in found if x[0] == 7} == {(7, "MIT-line", 1), (7, "CC-BY-NC-4.0-line", 1)}
    assert {x[0] for x in found} == {3, 4, 7}
    assert licences.scan(df.limit(0), known).collect() == []


def test_usual_files_of_licences(spark):
    from pathlib import Path
    lines = "MIT License\n\nCopyright (c) 2024 Someone\n\n" + licences.KNOWN["MIT"]
    marked = lambda mark: "\n".join(f"{mark} {x}" for x in lines.split("\n"))
    unlicense = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
    want = [(lines, "MIT"), (marked("#"), "MIT"), (marked("//"), "MIT"), ("/*\n" + marked(" *") + "\n */", "MIT"), (unlicense, "Unlicense"),
            ("ISC License\n\n" + licences.KNOWN["ISC"], "ISC"), ("zlib License\n\n; (c) A\n" + licences.KNOWN["Zlib"], "Zlib"),
            ("Other title\n\n" + licences.KNOWN["MIT"], None), ("# no copyright here\n" + licences.KNOWN["MIT"], None)]
    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0",
             "CC0-1.0": "CC0-1.0"}
    want += [((folder / f).read_text(encoding="utf-8"), k) for f, k in names.items() if (folder / f).exists()]
    got = {r["doc_id"]: r["text_licence"] for r in licences.scan(table(spark, [t for t, _ in want]), licences.known_digests(spark)).collect()}
    assert got == {i: k for i, (_, k) in enumerate(want)}


def test_lines_of_a_million_marks(spark):
    marks = ["|", "#", "*", "-", "/", ";", "%", "!", "'", '"', "(", "{", "<", "| ", "# \t", "//!", "<!--", "(c", "/* "]
    texts = ["copyright\n" + m * (1_000_000 // len(m)) + "\n" + licences.KNOWN["MIT-line"] for m in marks]
    got = {r["doc_id"]: r["text_licence"] for r in licences.scan(table(spark, texts).repartition(4), licences.known_digests(spark)).collect()}
    assert got == {i: "MIT-line" if m != "(c" else None for i, m in enumerate(marks)}


def test_commented_licence_in_query_and_sql(spark, tmp_path):
    marked = "\n".join(f"{m} {x}" for m, x in zip("#-;*|" * 9, ("MIT License\n(c) 2024 A\n" + licences.KNOWN["MIT"]).split("\n")))
    texts = [marked, "// (c) 2020 B\n" + licences.KNOWN["ISC"], "((c) x\nReleased under the MIT License.", None, "", "copyright |||| ("]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    df = licences.op8_licence_digest(spark, str(tmp_path))
    cur = con.execute(licences.oracle())
    want = sorted(cur.fetchall())
    assert sorted(map(tuple, df.select(*[c[0] for c in cur.description]).collect())) == want
    assert [r[2] for r in want] == ["MIT", "ISC", "MIT-line", None, None, None]


def test_licence_query_is_native_and_equals_its_sql(spark):
    df = licences.op8_licence_digest(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cur = con.execute(licences.oracle())
    names = [c[0] for c in cur.description]
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(cur.fetchall(), key=repr)


# ------------------------------------------------------------------ quality


def test_scores_tell_junk_from_prose(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.classify(docs.withColumn("x", F.lit(1)), labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in got)
    assert len(got) > 40 and right / len(got) > 0.95


def test_factors_give_the_gaussian_densities(spark):
    rng = np.random.default_rng(1)
    d = len(quality.FEATURES)
    x = np.concatenate([rng.normal(0, 1, (60, d)), rng.normal(0.7, 1.4, (90, d))])
    y = np.array([0] * 60 + [1] * 90)
    rows = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, y)], "x array<double>, label long").repartition(4)
    m = quality.fit(rows, temper=1.0)
    cov = [np.cov(x[y == c].T, bias=True) for c in (0, 1)]
    both = (60 * cov[0] + 90 * cov[1]) / 150
    logs = []
    for c in (0, 1):
        own = (1 - quality.POOLED) * cov[c] + quality.POOLED * both
        s = (1 - quality.RIDGE) * own + quality.RIDGE * (np.trace(both) / d + 1e-9) * np.eye(d)
        z = x - x[y == c].mean(0)
        logs.append(-0.5 * (z * np.linalg.solve(s, z.T).T).sum(1) - 0.5 * np.linalg.slogdet(s)[1] + np.log((y == c).sum()))
    assert np.allclose(m.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_scores_without_examples_and_of_odd_texts(spark):
    df = table(spark, ODD)
    labels = spark.createDataFrame([(0, 1), (1, None)], "doc_id long, quality int")
    got = quality.classify(df, labels).collect()
    assert len(got) == len(ODD) and len({r["score"] for r in got}) == 1
    assert quality.classify(df.limit(0), labels.limit(0)).collect() == []
    same = quality.statistics(pa.array(["a b", "a b", None, ""]))
    assert (same[0] == same[1]).all() and (same[2] == same[3]).all() and np.isfinite(quality.statistics(pa.array(ODD))).all()


def test_every_known_text_holds_a_stem():
    for body in licences.KNOWN.values():
        assert any(s in body.lower() for s in licences.STEMS)
    for word, same in licences.EQUIVALENT.items():
        assert all((s in word) == (s in same) for s in licences.STEMS)
