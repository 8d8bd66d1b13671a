import base64
import hashlib
import random
import struct
import sys

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from skeinwork.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(PATH)


def same(own, library, texts):
    for text, ids, want in zip(texts, own.encode(texts), library.encode_ordinary_batch(texts)):
        assert ids.tolist() == want, repr(text)[:200]
        assert own.decode(ids) == text.encode()


def test_every_code_point_in_context(own, library):
    points = [c for c in range(0, sys.maxunicode + 1, 7) if not 0xD800 <= c < 0xE000] + list(range(0x3100))
    same(own, library, [f"a{chr(c)}a {chr(c)}1" for c in points])


def test_contractions_and_spaces(own, library):
    rng = random.Random(5)
    same(own, library, ["".join(rng.choice("abst'mdrevl1 \n\t.!é界") for _ in range(rng.randint(0, 24))) for _ in range(20_000)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(), max_size=5))
def test_any_text(own, library, texts):
    same(own, library, [t.encode("utf-8", "ignore").decode() for t in texts])


def test_very_long_pieces_and_texts(own, library):
    same(own, library, ["a" * 3000, " " * 5000 + "x", "ab" * 2000, "!?" * 2000, "word " * 200_000])


def test_a_small_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(bpe, "BATCH_CHARS", 10)
    same(bpe.Encoder(PATH), library, ["one two three", "two three four five", "", "six"] * 5)


def test_prefix_products_by_pairs_equal_those_in_order():
    products, n = bpe.automaton()[2], len(bpe.automaton()[3])
    elements = np.random.default_rng(1).integers(0, n, 1001).astype(products.dtype)
    want = [int(elements[0])]
    for e in elements[1:].tolist():
        want.append(int(products[want[-1] * n + e]))
    assert bpe.scan(elements, products, n).tolist() == want


def test_digests(spark, library):
    texts = [None, "", "hello  world", "hello  world", "é" * 50, "<|endoftext|>"]
    docs = spark.createDataFrame([(None if i == 4 else i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    rows = bpe.token_digests(docs, PATH).collect()
    assert len(rows) == len(texts) and [r["doc_id"] for r in rows] == [0, 1, 2, 3, None, 5]
    for t, r in zip(texts, rows):
        ids = library.encode_ordinary(t or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.token_digests(docs.limit(0), PATH).count() == 0


def test_columns_of_clashing_names_are_kept(spark):
    docs = spark.createDataFrame([(1, "a b", "x")], "doc_id long, text string, _tokens string")
    row = bpe.with_tokens(docs, PATH).first()
    assert row["_tokens"] == "x" and row["intact"] and row["n_tokens"] == len(row["ids"])
    out = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH).first()
    assert bytes(out["decoded"]) == b"a b"


def test_columns_of_the_names_of_the_result_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 7, "y")], "doc_id long, text string, ids string, n_tokens int, intact string")
    out = bpe.with_tokens(docs, PATH)
    row = out.first()
    assert sorted(out.columns) == sorted(docs.columns) and row["intact"] is True and row["n_tokens"] == len(row["ids"]) == 2
