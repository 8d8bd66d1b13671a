import hashlib
import resource

import pytest
from pyspark.sql import functions as F

from skeinwork.functions.jsonlines import canonical, leading_values
from skeinwork.operators import quality as V
from skeinwork.sources import jsonl as S
from skeinwork.sources import sinks
from skeinwork.streaming import ingest as T


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.jsonl").write_text('\n \n{"id":1}\n{"a":1\n{"id":1}{"id":2}\n')
    (tmp_path / "b.jsonl").write_text('{"id":1,"id":2}\n{"v":NaN}\n12\n{"id":1} xx\n {"id":1}{"id":2}\n')
    (tmp_path / "c.txt").write_text("version https://x\noid sha256:1\nsize 2\n")
    return str(tmp_path)


def parsed(spark, folder, glob="*.jsonl"):
    lines = S.with_line_no(S.read_lines(spark, folder, glob)).withColumn("file", F.regexp_extract("file", "[^/]*$", 0))
    return S.parse_lines(lines)


def test_bad_lines_are_numbered_and_blank_lines_count(spark, folder):
    got = {r["file"]: r["valid_lines"] for r in V.validate_lines(parsed(spark, folder)).collect()}
    bad = sorted((r["file"], r["line_no"]) for r in V.invalid_lines(parsed(spark, folder)).collect())
    assert (got["a.jsonl"], got["b.jsonl"]) == (1, 3)
    assert bad == [("a.jsonl", 4), ("a.jsonl", 5), ("b.jsonl", 4), ("b.jsonl", 5)]


def test_a_pointer_file_is_invalid(spark, folder):
    assert V.validate_lines(parsed(spark, folder, "*.txt")).first()["invalid_lines"] == 3


def test_concatenated_values_are_recovered_up_to_the_first_failure():
    assert leading_values('{"id":1}{"id":2}') == ['{"id": 1}', '{"id": 2}']
    assert leading_values('{"id":1} xx') == ['{"id": 1}']
    assert leading_values(' {"id":1}{"id":2}') == []


def test_the_last_of_a_repeated_key_counts(spark, folder):
    docs = [r[0] for r in S.read_jsonl(spark, folder, "b.jsonl").select("doc").collect()]
    assert docs == ['{"id": 2}', '{"v": NaN}', "12"]


def test_repair_keeps_good_lines_and_rejects_apart(spark, folder):
    good, rejects = V.repair(parsed(spark, folder))
    assert good.count() == 4 and rejects.count() == 4
    assert good.count() + rejects.count() == parsed(spark, folder).count()


def test_line_numbers_hold_when_files_are_split(spark, tmp_path):
    (tmp_path / "long.txt").write_text("".join(f"{i}\n" for i in range(1, 3001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        lines = S.with_line_no(S.read_lines(spark, str(tmp_path / "long.txt")))
        assert lines.filter(F.col("value").cast("int") != F.col("line_no")).count() == 0
        assert lines.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_canonical_form_sorts_keys_and_leaves_out_dates():
    assert canonical('{"b":1,"a":"é","scraped_date":2}', ("scraped_date",)) == '{"a": "\\u00e9", "b": 1}'
    assert canonical("x", ()) is None and canonical(None, ()) is None


def test_batches_hold_their_size_but_the_last(spark, tmp_path):
    sinks.write_batches(spark.range(25).withColumn("x", F.col("id")), 10, str(tmp_path / "b"), ["id"])
    counts = spark.read.json(str(tmp_path / "b")).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in counts] == [10, 10, 5]


def test_a_file_of_three_gigabytes_is_digested_in_pieces(tmp_path):
    path = tmp_path / "big.bin"
    with path.open("wb") as f:
        f.write(b"start")
        f.truncate(3 << 30)
    peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    want = hashlib.md5(b"start" + bytes((1 << 20) - 5))
    for _ in range((3 << 10) - 1):
        want.update(bytes(1 << 20))
    assert S.digest_in_pieces(f"file:{path}") == want.hexdigest()
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - peak < 200_000  # KB


def test_files_whole_or_in_pieces_have_the_same_digest(spark, tmp_path):
    for i, data in enumerate([b"", b"a\n", b"x" * 9_000_000, bytes(range(256)) * 100]):
        (tmp_path / f"f {i}.gz").write_bytes(data)
    rows = [{r["file"]: (r["bytes"], r["md5"]) for r in S.scan_files(spark, str(tmp_path), "*.gz", whole=w).collect()} for w in (1 << 30, 100, -1)]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 3  # the empty one is not listed
    assert {v[1] for v in rows[0].values()} == {hashlib.md5(p.read_bytes()).hexdigest() for p in tmp_path.iterdir() if p.stat().st_size}


def test_lines_come_in_once_and_bad_ones_apart(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.jsonl").write_text('{"id": 1}\n{"id": 1}\nbad\n\n{"id": 2}{"id": 3}\n[1]\n')
    before = spark.conf.get(T._PROVIDER, None)
    assert T.ingest_lines(spark, str(source), out, "id")["rows"] == 1
    (source / "b.jsonl").write_text('{"id": 1, "x": 2}\n{"id": 4}\nbad\n{"id": null}\n')
    size = T.ingest_lines(spark, str(source), out, "id")
    assert size["rows"] == 2 and size["files"] > 0 and spark.conf.get(T._PROVIDER, None) == before
    assert sorted(r["key"] for r in spark.read.parquet(f"{out}/kept").collect()) == ["1", "4"]
    bad = sorted((r["file"][-7:], r["value"], r["reason"]) for r in T.rejects(spark, out).collect())
    why = "not one JSON value"
    assert bad == [("a.jsonl", "[1]", "no id"), ("a.jsonl", "bad", why), ("a.jsonl", '{"id": 2}{"id": 3}', why), ("b.jsonl", "bad", why), ("b.jsonl", '{"id": null}', "no id")]


def test_a_run_that_died_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.jsonl").write_text('{"id": 1}\n{"id": 2}\nbad\n')
    with monkeypatch.context() as m:
        m.setattr(T, "seen_once", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            T.ingest_lines(spark, str(source), out, "id")
    (source / "b.jsonl").write_text('{"id": 2}\n{"id": 3}\n')
    T.ingest_lines(spark, str(source), out, "id")
    assert sorted(r["key"] for r in spark.read.parquet(f"{out}/kept").collect()) == ["1", "2", "3"] and T.rejects(spark, out).count() == 1


def test_reports_of_many_rows_are_not_put_in_one_task(spark, tmp_path):
    sinks.write_report({"few": spark.range(20, numPartitions=3), "many": spark.range(30, numPartitions=3)}, str(tmp_path), one_file=20)
    assert [len(list((tmp_path / n).glob("part-*"))) for n in ("few", "many")] == [1, 3]
