import random

from pyspark.sql import functions as F

from strata.llm import components, minhash


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, least):
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= least * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, size):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(size):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 5, 40, 120, 300]))]
        for _ in range(rng.choice([1, 1, 2, 25])):
            w = list(base)
            kind = rng.random()
            if kind < 0.5:
                for _ in range(rng.randint(0, max(1, len(w) // 25))):
                    w[rng.randrange(len(w))] = rng.choice(vocab)
            elif kind < 0.7:
                w = w[:rng.randint(len(w) * 7 // 10, len(w))] or w
            elif kind < 0.8:
                w += [rng.choice(vocab) for _ in range(rng.randint(0, len(w) // 5 + 1))]
            text = " ".join(w)
            rows.append(text.upper() if rng.random() < 0.1 else text)
    rows += ["", None, "   "]
    rng.shuffle(rows)
    return list(enumerate(rows, 5))


def check(spark, rows, k, least):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(df, shingle=k, least=least).collect()}
    want = brute(rows, k, least)
    assert set(got) == set(want)
    for i, (n, c) in want.items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, c, c == i), (i, got[i], n, c)


def test_equals_brute_force(spark):
    check(spark, corpus(1, 40), 3, 85)
    check(spark, corpus(2, 40), 5, 80)


def test_one_large_group_without_its_base(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(rng.randint(0, 7)):
            w[rng.randrange(150)] = f"x{rng.randrange(60)}"
        rows.append((i, " ".join(w)))
    check(spark, rows, 3, 85)


def test_empty_nulls_repeats_and_extra_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(df).collect() == []
    same = " ".join("abcdefgh")
    df = spark.createDataFrame([(1, same), (1, same), (4, same), (None, same), (2, None), (None, "")],
                               "doc_id long, text string").withColumn("bands", F.lit(1)).withColumn("id", F.lit(2))
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (4, 1, False), (None, 1, False), (2, 2, True), (None, None, True)], key=str)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (901, 900)], "a long, b long")
    got = dict((r["node"], r["component"]) for r in components.components(links).collect())
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}


def test_query_equals_its_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    cur = con.execute(minhash.oracle())
    df = minhash.op7_min_max_hash(spark, sf).select(*[c[0] for c in cur.description])
    assert sorted(map(tuple, df.collect())) == sorted(cur.fetchall())
