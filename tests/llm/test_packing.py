import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skeinwork.llm import packing as P
from skeinwork.llm import queries, tokenfiles

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


LIBRARY = Tokenizer.from_file(PATH)


def plain(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


def check(got, texts):
    """Pieces against the library: each id in one piece, one piece a sequence, lengths powers of two, buckets by length."""
    docs, sequences, buckets = defaultdict(list), set(), defaultdict(list)
    for r in got:
        docs[r["doc_id"]].append(r)
        assert r["sequence_id"] not in sequences and r["offset"] == 0
        assert r["length"] & (r["length"] - 1) == 0 and 0 < r["length"] <= 2048
        sequences.add(r["sequence_id"])
        buckets[r["length"]].append(r["sequence_id"])
    assert set(docs) == set(texts)
    for doc_id, rows in docs.items():
        ids, rows = plain(texts[doc_id]), sorted(rows, key=lambda r: r["start"])
        assert [r["start"] for r in rows] == [sum(x["length"] for x in rows[:i]) for i in range(len(rows))]
        assert sum(r["length"] for r in rows) == len(ids)
        # Two pieces of one length below 2048 would be one piece of twice the length.
        below = [r["length"] for r in rows if r["length"] < 2048]
        assert len(below) == len(set(below)) and len(rows) == len(ids) // 2048 + bin(len(ids) % 2048).count("1")
        for r in rows:
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes())
    ranges = sorted((min(v), max(v)) for v in buckets.values())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_the_query_on_whole_texts(spark):
    got = queries.op11_packing(spark, SF).collect()
    check(got, {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()})


@pytest.mark.parametrize("parts", [1, 5])
def test_odd_rows(spark, tmp_path, parts):
    long = "word and another WORD, " * 4000
    rows = [(1, None), (2, ""), (3, "   \n"), (-4, long), (2**60, "é 42 <|endoftext|> it's"), (None, "no id"), (7, "日本 ＡＢ İstanbul")]
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, start int, IDS string").repartition(parts)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    check(queries.op11_packing(spark, str(tmp_path)).collect(), dict(rows))
    twice = docs.union(docs)
    pieces = P.pack(twice, PATH, 1).collect()
    assert len({r["sequence_id"] for r in pieces}) == len(pieces) == 2 * P.pack(docs, PATH, 1).count()


def test_an_empty_table(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, text string"), PATH, 1).count() == 0


def test_lengths_are_the_bits():
    assert P.binary_lengths(0, 8) == [] and P.binary_lengths(1, 8) == [1] and P.binary_lengths(8, 8) == [8]
    assert P.binary_lengths(31, 8) == [8, 8, 8, 4, 2, 1]
    for n in range(1, 5000):
        cut = P.binary_lengths(n, 2048)
        assert sum(cut) == n and cut == sorted(cut, reverse=True) and all(x & (x - 1) == 0 and x <= 2048 for x in cut)
    for bad in (0, 3, 1 << 19):
        with pytest.raises(ValueError):
            P.pack(None, PATH, 1, bad)


def test_shorter_sequences(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "doc_id long, text string")
    assert [r["length"] for r in P.pack(docs, PATH, 1, 4).orderBy("start").collect()] == [4, 4, 2, 1]


def test_matches_and_whole_texts_have_the_same_ids():
    rng = random.Random(5)
    common = [chr(c) for c in range(0x250)] + list("‐…‧‰⁞₠€₿")
    texts = [f"a{c}b {c}{c} 1{c}2 '{c}S \n{c} {c}\n  {c}x" for c in common]
    texts += ["".join(rng.choices(common, k=rng.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rng.choices("aB1'SlLreVEd \n\t.,éÉß²", k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["We'LL  they'Ve 'TWAS   I'd\n\n x", "<|endoftext|>", "a <|startoftext|>b", "日本語 ТЕКСТ ا ΑΣ", "é Å", "\x1c \x1f", "X" * 50_000, "Word " * 20_000, "", " "]
    own = P.LowercaseEncoder(PATH, np.dtype("<u4"))
    assert own.cuts and sum(1 for t in texts if not tokenfiles.UNCOMMON.search(t)) > 4000
    for text in texts:
        assert np.frombuffer(own.ids(text), dtype="<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, text


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = P.LowercaseEncoder(path, np.dtype("<u4"))
    assert not own.cuts
    assert np.frombuffer(own.ids("Some WORDS"), dtype="<u4").tolist() == Tokenizer.from_file(path).encode("Some WORDS", add_special_tokens=False).ids
