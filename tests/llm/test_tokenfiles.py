import json
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skeinwork.llm import tokenfiles as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("parts", ["1", "5"])
def test_documents_come_back_in_order(spark, parts):
    library = Tokenizer.from_file(PATH)
    big = 2**60 + 1
    rows = [(9, "nine é"), (big, "big"), (3, None), (3, "three again"), (-5, ""), (None, "no id"), (7, "word " * 5000), (9, "nine é")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start int").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in T.round_trip(docs, PATH, 2).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, []
    for i, t in order:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((start, i, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert got == want


def test_an_empty_table(spark):
    assert T.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH, 2).count() == 0


def test_files_hold_16_bit_ids_and_bases_are_prefix_sums(spark, tmp_path):
    docs = spark.range(50).selectExpr("id AS doc_id", "repeat('word ', CAST(id AS int)) AS text")
    rows = T.write_shards(docs, str(tmp_path / "t"), PATH, 2).orderBy("shard").collect()
    total = 0
    for r in rows:
        assert r["base_ids"] == total and r["id_bytes"] == 2
        assert (tmp_path / "t" / f"{r['name']}.ids").stat().st_size == 2 * r["n_ids"]
        assert (tmp_path / "t" / f"{r['name']}.off").stat().st_size == 8 * (r["n_docs"] + 1)
        total += r["n_ids"]
    assert sum(r["n_docs"] for r in rows) == 50


def test_pieces_and_whole_texts_have_the_same_ids():
    library = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    common = [chr(c) for c in range(0x250)] + list("\u2010\u2026\u2027\u2030\u205e\u20a0\u20ac\u20bf")
    texts = [f"a{c}b {c}{c} 1{c}2 '{c}s \n{c} {c}\n  {c}x" for c in common]
    texts += ["".join(rng.choices(common, k=rng.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rng.choices("ab1'sl \n\t.,éß²", k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["we'll  they've 'twas   I'd\n\n x", "<|endoftext|>", "a <|endoftext|>b", "日本語 текст ا", "\x1c \x1f", "x" * 100_000, "word " * 50_000, "", " ", "  ", "a  "]
    own = T.Encoder(PATH, np.dtype("<u4"))
    assert own.cuts and sum(1 for t in texts if not T.UNCOMMON.search(t)) > 4000
    for text in texts:
        assert np.frombuffer(own.ids(text), dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_rows_of_one_id_part_over_shards(spark, tmp_path):
    docs = spark.range(4000).selectExpr("CAST(NULL AS bigint) AS doc_id", "IF(id % 2 = 0, 'the same text', concat('text ', id)) AS text").repartition(4)
    manifest = T.write_shards(docs, str(tmp_path / "hot"), PATH, 2)
    assert manifest.count() == 4 and manifest.agg({"n_docs": "max"}).first()[0] < 2000
    got = T.read_documents(manifest, str(tmp_path / "hot"))
    assert got.count() == 4000 and got.filter("doc_id IS NOT NULL").count() == 0 and got.select("start").distinct().count() == 4000


def test_other_tokenizers_encode_whole_texts(tmp_path):
    rules = json.loads(open(PATH, encoding="utf-8").read())
    rules["normalizer"] = {"type": "Lowercase"}
    path = str(tmp_path / "lower.json")
    (tmp_path / "lower.json").write_text(json.dumps(rules), encoding="utf-8")
    own = T.Encoder(path, np.dtype("<u4"))
    assert not own.cuts
    assert np.frombuffer(own.ids("Some WORDS"), dtype="<u4").tolist() == Tokenizer.from_file(path).encode("Some WORDS", add_special_tokens=False).ids
