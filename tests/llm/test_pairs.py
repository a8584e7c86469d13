"""op8, op9 and op10 against brute force on small tables."""

import random

import numpy as np

from pyspark.sql import types as T
from riskloom.llm import embedding_dedup, minhash_forest, substring_dedup
from riskloom.llm.bloom import bitmap_of
from riskloom.llm.common import ship_package
from riskloom.llm.components import components
from tests.llm.fixtures import ascii_lower, docs_df, find_components, mixed_docs, sentence, white_words


def shingles(text):
    w = white_words(ascii_lower(text))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = list(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    found = find_components(ids, links)
    return sorted((i, len(sets[i]), found[i], found[i] == i) for i in ids)


def test_near_duplicates(spark):
    ship_package(spark)
    rows = mixed_docs()
    got = sorted(tuple(r) for r in minhash_forest.near_duplicates(docs_df(spark, rows)).collect())
    assert got == plain_groups(rows)


def test_a_full_region_and_repeated_rows(spark):
    """One source with many differing copies: most copies link with the source only."""
    ship_package(spark)
    rng = random.Random(5)
    source = sentence(rng, 150, 10**6).split()
    rows = [(10**6, " ".join(source))]
    for i in range(150):
        w = list(source)
        for at in rng.sample(range(5, 145), rng.choice([1, 2, 2, 3, 4])):
            w[at] = f"edit{rng.randrange(10**9)}"
        rows.append((i, " ".join(w)))
    rows += [(500, None), (501, "")]
    got = sorted(tuple(r) for r in minhash_forest.near_duplicates(docs_df(spark, [*rows, rows[7], rows[7]])).collect())
    want = plain_groups(rows)
    assert got == sorted(want + [w for w in want if w[0] == rows[7][0]] * 2)


def template_docs(seed=11):
    """A template of 350 words filled in 300 ways, most pairs of them at about 0.8, and 20 pairs at about 0.865."""
    rng = random.Random(seed)
    template = sentence(rng, 350, 10**6).split()
    rows = []
    for i in range(300):
        w = list(template)
        for at in rng.sample(range(2, 348, 5), 4):
            w[at] = f"fill{rng.randrange(10**9)}"
        rows.append((rng.randrange(10**9), " ".join(w)))
    for i in range(20):
        w = rows[i * 15][1].split()
        for at in rng.sample(range(4, 348, 5), 5):
            w[at] = f"copy{rng.randrange(10**9)}"
        rows.append((rng.randrange(10**9), " ".join(w)))
    rng.shuffle(rows)
    return rows


def test_pairs_within_a_large_template_group(spark, monkeypatch):
    """Nodes of hundreds of documents are full for a region of 4, and are compared in several tiles."""
    ship_package(spark)
    monkeypatch.setattr(minhash_forest, "REGION", 4)
    monkeypatch.setattr(minhash_forest, "TILE", 32)
    rows = template_docs()
    want = plain_groups(rows)
    assert 200 < sum(keep for *_, keep in want) < 310
    got = sorted(tuple(r) for r in minhash_forest.near_duplicates(docs_df(spark, rows)).collect())
    assert got == want


def test_common_counts(monkeypatch):
    monkeypatch.setattr(minhash_forest, "COLUMNS", 7)
    rng = np.random.default_rng(4)
    left, right = ([np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(n)] for n in (9, 6))
    assert minhash_forest.common_counts(left, right).tolist() == [[len(np.intersect1d(a, b)) for b in right] for a in left]
    apart = [s + np.uint64(100) for s in right]
    assert not minhash_forest.common_counts(left, apart).any()


def test_no_documents(spark):
    ship_package(spark)
    assert minhash_forest.near_duplicates(docs_df(spark, [])).count() == 0
    assert substring_dedup.remove_repeats(docs_df(spark, [])).count() == 0
    got = minhash_forest.near_duplicates(docs_df(spark, [(1, None), (2, " "), (None, "a b")])).collect()
    assert sorted((r[0] or 0, r[1], r[2], r[3]) for r in got) == [(0, 1, None, False), (1, 0, 1, True), (2, 0, 2, True)]


def plain_removal(rows, window=50):
    first = {}
    words = {i: white_words(t) for i, t in rows}
    for i in sorted(words):
        for s in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][s:s + window]), i)
    out = []
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < i:
                gone.update(range(s, s + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def test_substring_dedup(spark):
    ship_package(spark)
    rng = random.Random(9)
    rows = mixed_docs(4)
    same = "a " * 130  # one window again and again
    rows += [(10, same), (11, "b " + same), (12, sentence(rng, 49)), (13, sentence(rng, 50))]
    rows += [(14, rows[-1][1]), (15, rows[-2][1])]
    got = sorted(tuple(r) for r in substring_dedup.remove_repeats(docs_df(spark, rows)).collect())
    assert got == plain_removal(rows)


def test_substring_dedup_keeps_other_columns_and_clean_texts(spark):
    ship_package(spark)
    rng = random.Random(2)
    passage = sentence(rng, 60)
    rows = [(1, "keep \n  this"), (2, passage), (3, "x  y " + passage + " z"), (None, passage), (4, passage), (4, passage)]
    out = substring_dedup.remove_repeats(docs_df(spark, rows), carry=["class", "version"], as_is=True).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"], r["kept"], r["class"], r["version"]) for r in out) == sorted(
        [(0, 0, passage, 1, "v"), (1, 0, "keep \n  this", 1, "v"), (2, 0, passage, 1, "v"), (3, 60, "x y z", 1, "v"),
         (4, 60, "", 1, "v"), (4, 60, "", 1, "v")])


VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                    T.StructField("label", T.IntegerType()), T.StructField("tile", T.StringType()), T.StructField("a", T.StringType())])


def plain_vectors(rows, threshold):
    def ok(v, label):
        return label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    good = [(i, np.array(v, np.float32).astype(float), label) for i, v, label in rows if ok(v, label)]
    links = [(a, b) for k, (a, u, x) in enumerate(good) for b, v, y in good[:k]
             if x == y and len(u) == len(v) and u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= threshold]
    ids = [r[0] for r in rows]
    found = find_components(ids, links)
    return sorted((i, sum(i in x for x in links), found[i], found[i] == i) for i in ids)


def test_near_vectors(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(embedding_dedup, "TILE", 16)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + 0.12 * rng.normal(size=24)).astype(np.float32).tolist(), i % 3 if i % 11 else None) for i in range(200)]
    rows += [(300 + i, rows[1][1], rows[1][2]) for i in range(5)]
    rows += [(400, None, 1), (401, [0.0] * 24, 1), (402, [float("nan")] + [1.0] * 23, 1), (403, [None] + [1.0] * 23, 1),
             (404, [float("inf")] * 24, 1), (405, [1.0, 2.0], 1), (406, [2.0, 4.0], 1), (407, [], 1)]
    df = spark.createDataFrame([(i, v, label, "t", "a") for i, v, label in rows], VEC)
    got = sorted(tuple(r) for r in embedding_dedup.near_vectors(df, 0.97).collect())
    want = plain_vectors(rows, 0.97)
    assert got == want
    assert 20 < sum(r[1] > 0 for r in want) < 200
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_any_length(spark):
    """Lengths that overflow or vanish in double precision."""
    ship_package(spark)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(4, 16))
    rows = [(10 * k + i, (base[i] * size).tolist(), "x") for k, size in enumerate([1.0, 1e300, 1e-300]) for i in range(4)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in got} == {(10 * k + i, 2, i) for k in range(3) for i in range(4)}


def test_rounding_bound_holds_and_spares_work():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(300, 64))
    b = np.concatenate([a[:50] + 0.1 * rng.normal(size=(50, 64)), rng.normal(size=(300, 64))])
    exact = (a @ b.T) / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1)[None]
    links, computed = embedding_dedup.tile_links(a, b, 0.98)
    assert (links == (exact >= 0.98)).all() and links.any()
    assert computed < 200


def test_components(spark):
    ship_package(spark)
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(250)]
    links += [(1000, x) for x in range(1001, 1100)]
    df = spark.createDataFrame(links, "a long, b long").repartition(4)
    got = {r["node"]: r["component"] for r in components(df).collect()}
    ids = {x for link in links for x in link}
    want = find_components(ids, links)
    assert got == {i: c for i, c in want.items() if i != c}
    assert components(df.limit(0)).count() == 0


def test_bitmap_never_forgets(spark):
    ship_package(spark)
    rng = np.random.default_rng(2)
    held, other = rng.integers(-2**63, 2**63 - 1, 3000), rng.integers(-2**63, 2**63 - 1, 3000)
    found = bitmap_of(spark.createDataFrame([(int(x),) for x in held], "h long").repartition(3), "h")
    assert found.has(held.view(np.uint64)).all()
    assert found.has(other.view(np.uint64)).mean() < 0.02
    assert not bitmap_of(spark.createDataFrame([], "h long"), "h").has(other.view(np.uint64)).any()
