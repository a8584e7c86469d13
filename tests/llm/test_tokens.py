"""op2 and op7 against the tokenizer library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pyspark.sql import functions as F
from riskloom.llm import bpe, token_counts
from riskloom.llm.bpe_core import LONG_WORD, vocabulary
from riskloom.llm.common import ship_package
from riskloom.llm.pretokens import split
from riskloom.llm.transducer import Lexicon, compile_lexicon, map_lexicon
from tests.llm.fixtures import docs_df, mixed_docs

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return LIBRARY


def encode_all(texts):
    vocab = vocabulary(PATH)
    p = split(texts, vocab.special, vocab.own_split)
    ids, counts = vocab.merge([p.text(i).encode() for i in range(len(p.start))])
    out = [[] for _ in texts]
    for doc, special, part in zip(p.doc, p.special, np.split(ids, np.cumsum(counts)[:-1]), strict=False):
        out[doc] += [vocab.special_id] if special else part.tolist()
    return out


PARTS = ["a", "b", "Zz", "'", "'s", "'ll", "re", " ", "  ", "\n", "\t", "\r\n", "1", "23", "!", "?!", "é", "漢", " ", "　",
         " ", "\x1f", "😀", "\U0001e6c0", "͸", "<|endoftext|>", "<|endoftext", "x" * 7]


@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=14).map("".join), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_split_and_merge_equal_the_library(texts):
    assert encode_all(texts) == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


@given(st.text(max_size=60))
@settings(max_examples=150, deadline=None)
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert encode_all([text]) == [LIBRARY.encode(text, add_special_tokens=False).ids]


def test_long_words(library):
    rng = random.Random(1)
    texts = ["a" * (LONG_WORD + n) for n in (-1, 0, 1, 500)] + ["".join(rng.choices("abcdeth", k=3000))]
    assert encode_all(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_counts_and_round_trip(spark, library):
    ship_package(spark)
    rows = mixed_docs() + [(100, "again")]
    df = docs_df(spark, rows)
    want = sorted((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    got = token_counts.token_counts(df, PATH).collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)
    want = sorted((i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows)
    encoded = bpe.encode(df, PATH)
    for back in (bpe.decode(encoded, PATH), bpe.round_trip(df, PATH)):
        got = back.select("*", F.sha2("ids", 256).alias("sha")).collect()
        assert sorted((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in got) == want
        assert all(r["n_tokens"] * 4 == len(r["ids"]) and r["sha"] == hashlib.sha256(r["ids"]).hexdigest() for r in got)
    assert sorted((r["doc_id"], r["ids"]) for r in bpe.ids_of(encoded).collect()) == [w[:2] for w in want]


def test_empty_tables(spark):
    ship_package(spark)
    none = docs_df(spark, [])
    assert token_counts.token_counts(none, PATH).count() == 0
    assert bpe.round_trip(none, PATH).count() == 0
    only_null = docs_df(spark, [(1, None)])
    assert token_counts.token_counts(only_null, PATH).head()["n_tokens"] == 0
    assert bpe.encode(only_null, PATH).select("n_tokens", F.length("ids")).head() == (0, 0)


def test_length_table_probes_past_collisions():
    hashes = np.array([8, 16, 24, 40, 1 << 40], np.uint64)
    table = token_counts.LengthTable(hashes, np.arange(1, 6))
    assert table.find(np.append(hashes, np.uint64(32))).tolist() == [1, 2, 3, 4, 5, -1]


def test_lexicon_is_minimal_and_survives_the_file():
    words = sorted(w.encode() for w in ("walking", "talking", "walk", "talk", "walked", "talked", "stalk", "é"))
    ids = np.arange(2 * len(words))
    lexicon = compile_lexicon(words, ids, np.full(len(words), 2))
    again = map_lexicon(lexicon.to_bytes())
    for lex in (lexicon, again):
        assert lex.find([*words, b"wal", b"walks", b""]).tolist() == [*range(len(words)), -1, -1, -1]
        assert lex.id_start.tolist() == list(range(0, 2 * len(words) + 1, 2))
    # endings are shared: "walk" and "talk" go on in the same states, which a trie would hold twice
    assert len(lexicon.final) < len({w[:k] for w in words for k in range(len(w) + 1)}) - 6
    empty = compile_lexicon([], np.zeros(0, int), np.zeros(0, int))
    assert empty.find([b"a"]).tolist() == [-1]
    assert isinstance(again, Lexicon)
