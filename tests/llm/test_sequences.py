"""op11, op12 and op13 against brute force."""

import hashlib
import math
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from riskloom.llm import packing, periodic_runs, whitening
from riskloom.llm.common import ship_package
from riskloom.llm.queries import QUERIES
from riskloom.llm.words import word_batches
from tests.llm.fixtures import docs_df, mixed_docs, white_words

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_runs(words):
    """All runs, by looking at every period."""
    out = {}
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def plain_collapse(words):
    gone = {p for s, n, q in plain_runs(words) for p in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(words) if i not in gone)


def runs_by_row(texts):
    out = [[] for _ in texts]
    for a, _, w in word_batches(pa.array(texts, pa.string()), False):
        for start, length, period in periodic_runs.runs_of(w):
            out[a + int(w.row[start])].append((start - int(w.first[w.row[start]]), length, period))
    return [sorted(r) for r in out]


PART = st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=5), st.integers(1, 9)).map(lambda x: x[0] * x[1])


@given(st.lists(st.lists(PART, max_size=5).map(lambda x: [w for part in x for w in part]), min_size=1, max_size=4))
@settings(max_examples=300, deadline=None)
def test_maximal_pairs_are_the_runs(docs):
    assert runs_by_row([" ".join(d) for d in docs]) == [plain_runs(d) for d in docs]


def test_long_unary_and_nested_runs():
    texts = [" ".join(["lol"] * 30_000), " ".join((["a"] * 7 + ["b"]) * 500), " ".join((["x", "y"] * 4 + ["z"]) * 40), None, ""]
    found = runs_by_row(texts)
    assert found[0] == [(0, 30_000, 1)]
    assert found[1] == sorted([(0, 4000, 8)] + [(8 * k, 7, 1) for k in range(500)])
    assert found[2] == plain_runs(texts[2].split())
    assert found[3:] == [[], []]


def test_words_of_one_hash_are_told_apart(monkeypatch):
    texts = ["a b c d e f g h", "a a a a a a a b"]
    (_, _, w), = word_batches(pa.array(texts), False)
    w.hash[:] = 7
    got = periodic_runs.runs_of(w)
    assert [(s, n, q) for s, n, q in got] == [(8, 7, 1)]


def run_docs():
    rng = random.Random(9)
    rows = mixed_docs() + [(i, " ".join(rng.choices("abcd", k=rng.randint(0, 90)))) for i in range(1000, 1080)]
    rows += [(2000, "ha " * 400), (2000, "ha " * 400), (None, "x y " * 9), (2001, "One one ONE " * 5)]
    return rows


def test_runs_of_a_table(spark):
    ship_package(spark)
    rows = run_docs()
    got = periodic_runs.periodic_runs(docs_df(spark, rows)).collect()
    want = []
    for i, t in rows:
        words = white_words(t)
        want.append((str(i), len(words), plain_runs(words), plain_collapse(words)))
    assert sorted((str(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got) == sorted(want)
    assert periodic_runs.periodic_runs(docs_df(spark, [])).count() == 0


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_op11_digests(spark, tmp_path):
    rows = run_docs()
    docs_df(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t in rows:
        words = planted(i, white_words(t))
        runs = plain_runs(words)
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in sorted(runs, key=lambda r: (r[0], r[2])))
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, plain_collapse(words))]
        want.append((i, len(runs), s, n, q, 1000 * n // q if runs else None, *digests))
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sum(w[2] is not None for w in want) > 20
    assert sorted(got, key=str) == sorted(want, key=str)


def check_packing(rows, pieces, window):
    """Every token in one piece, sequences without gaps or padding. ``pieces``: (doc, start, ids, doc_tokens, sequence, offset)."""
    library = Tokenizer.from_file(PATH)
    texts = sorted([*library.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, ids, total, sequence, offset in pieces:
        assert 0 < len(ids) <= window
        by_doc[doc, total].append((start, ids))
        by_sequence[sequence].append((offset, len(ids)))
    for parts in by_sequence.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end == window or end < window and end & (end - 1) == 0
    assert sum(sum(n for _, n in p) < window for p in by_sequence.values()) <= window.bit_length()
    return by_doc, texts


def test_packing_of_a_table(spark):
    ship_package(spark)
    rows = [(k, t) for k, (_, t) in enumerate(mixed_docs())]
    for window, parts in ((2048, 3), (64, 70), (2, 1)):
        df = docs_df(spark, rows).repartition(parts)
        got = packing.pack(df, PATH, window, 4).collect()
        pieces = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"], r["sequence_id"], r["offset"]) for r in got]
        assert all(r["length"] == len(p[2]) for r, p in zip(got, pieces, strict=True))
        by_doc, texts = check_packing(rows, pieces, window)
        whole = []
        for (_, total), parts_ in by_doc.items():
            ids = []
            for start, part in sorted(parts_):
                assert start == len(ids)
                ids += part
            assert len(ids) == total
            whole.append(ids)
        assert sorted(whole) == texts


def test_packing_merges_leftovers_in_rounds(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(packing, "FAN", 2)
    rows = [(k, "some words here " * (k % 9)) for k in range(60)]
    got = packing.pack(docs_df(spark, rows).repartition(9), PATH, 64, 3).collect()
    assert len({r["sequence_id"] >> packing.ROUND_BITS for r in got}) > 2
    pieces = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"], r["sequence_id"], r["offset"]) for r in got]
    by_doc, texts = check_packing(rows, pieces, 64)
    assert sorted([x for _, p in sorted(parts) for x in p] for parts in by_doc.values()) == texts


def test_packing_of_repeated_and_no_rows(spark):
    ship_package(spark)
    assert packing.pack(docs_df(spark, []), PATH).count() == 0
    got = packing.pack(docs_df(spark, [(7, None), (7, None), (None, "")]), PATH).orderBy("sequence_id", "offset").collect()
    assert [(r["doc_id"], r["length"], r["doc_tokens"]) for r in got if r["doc_id"] == 7] == [(7, 1, 1)] * 2
    assert sum(r["length"] for r in got) == 3 and len({r["sequence_id"] for r in got}) == 2


def test_best_fit_and_fullest():
    def piece(name, n):
        return [(name, n, 0, np.zeros(n, np.int32))]

    windows = packing.OpenWindows(10, 2, 0)
    for name, n in (("a", 6), ("b", 8), ("c", 2), ("d", 3)):
        windows.place(piece(name, n))
    # c goes where it leaves the least room: into b's window, which is then full; d fits beside a
    assert [(r[0], r[5]) for r in windows.done] == [("b", 0), ("c", 8)]
    windows.place(piece("e", 5))
    windows.place(piece("f", 7))
    # f fits nowhere: a's window, the fullest, takes its first token
    assert [(r[0], r[1], len(r[2]) // 4) for r in windows.done[2:5]] == [("a", 0, 6), ("d", 0, 3), ("f", 0, 1)]
    windows.finish()
    assert [r[3] for r in windows.done if r[0] == "f"] == [7] * sum(r[0] == "f" for r in windows.done)


def test_packing_equals_the_library_query(spark, tmp_path):
    rows = [(k, t) for k, (_, t) in enumerate(mixed_docs())]
    docs_df(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(PATH)
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    got = QUERIES["op12_pack_sequences"](spark, str(tmp_path)).collect()
    for r in got:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
    assert sum(r["length"] for r in got) == sum(map(len, ids.values()))


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("n", T.StringType()), T.StructField("x", T.StringType()), T.StructField("component", T.StringType())])


def vectors_df(spark, rows):
    return spark.createDataFrame([(i, v, "n", "x", "c") for i, v in rows], VECTORS)


def plain_whitening(rows, count):
    """Exact covariance with fractions."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    dim = max({len(v) for _, v in usable}, key=lambda d: (sum(len(v) == d for _, v in usable), d))
    x = [(i, tuple(math.floor(Fraction(c) * 64) + 1_000_000 for c in v)) for i, v in usable if len(v) == dim]
    lists = sorted({v for _, v in x})
    n = len(lists)
    total = [sum(v[k] for v in lists) for k in range(dim)]
    off = {v: [n * c - s for c, s in zip(v, total, strict=True)] for v in lists}
    cov = np.array([[float(Fraction(sum(o[i] * o[j] for o in off.values()), n**3)) for j in range(dim)] for i in range(dim)])
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1][:count], basis[:, ::-1][:, :count]
    out = {}
    for i, v in x:
        w = np.array([o / n for o in off[v]]) @ basis / np.sqrt(values)
        out[i] = (n, sum(o * o for o in off[v]), w, values / np.trace(cov))
    return out


def test_whitening(spark):
    ship_package(spark)
    rng = np.random.default_rng(4)
    mixing = rng.normal(size=(6, 6))
    rows = [(i, (rng.normal(size=6) @ mixing + 5).tolist()) for i in range(400)]
    rows += [(400 + i, rows[3][1]) for i in range(200)]  # copies weigh once
    rows += [(900, None), (901, []), (902, [1.0] * 5 + [None]), (903, [float("nan")] * 6), (904, [float("inf")] * 6), (905, [1.0, 2.0])]
    got = whitening.whiten(vectors_df(spark, rows), 4).collect()
    want = plain_whitening(rows, 4)
    assert len(got) == 4 * len(want) == 4 * 600
    sign = {}
    for r in got:
        n, deviation, w, explained = want[r["vec_id"]]
        k = r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["explained"] / explained[k] - 1) < 1e-12 and r["identity_error"] < 1e-12
        sign.setdefault(k, 1 if w[k] * r["whitened"] > 0 else -1)
        assert abs(sign[k] * r["whitened"] - w[k]) < 1e-9


def test_whitening_of_large_entries(spark):
    """Exact where longs overflow."""
    ship_package(spark)
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=3) * 10.0**rng.integers(0, 9)).tolist()) for i in range(50)]
    got = whitening.whiten(vectors_df(spark, rows)).collect()
    want = plain_whitening(rows, 3)
    for r in got:
        n, deviation, w, explained = want[r["vec_id"]]
        assert r["deviation"] == (deviation if deviation < 2**63 else None)
        assert abs(abs(r["whitened"]) - abs(w[r["component"] - 1])) < 1e-9
    huge = whitening.whiten(vectors_df(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])])).collect()
    assert len(huge) == 6


def test_whitening_without_variance(spark):
    ship_package(spark)
    assert whitening.whiten(vectors_df(spark, [])).count() == 0
    assert whitening.whiten(vectors_df(spark, [(1, None)])).count() == 0
    got = whitening.whiten(vectors_df(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert len(got) == 6
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(1, 0, None, None, None)}
    line = whitening.whiten(vectors_df(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])).where(F.col("whitened").isNotNull())
    assert {r["component"] for r in line.collect()} == {1}
