import threading
import uuid

import pytest
from pyspark.sql import functions as F

from skeinwork.sources import versions as V


def hundreds(spark, n):
    return spark.range(0, 100, 1, 3).select(F.lit(n).alias("version"), "id")


def test_a_reader_always_has_a_whole_version(spark, tmp_path, monkeypatch):
    """Twenty publishes, one of which dies in its job and one between data and pointer."""
    path, seen, stop, faults = str(tmp_path / "t"), [], threading.Event(), []
    V.publish(hundreds(spark, 0), path)

    def read():
        while not stop.is_set():
            try:
                rows = V.read_version(spark, path).groupBy("version").count().collect()
                seen.append([tuple(r) for r in rows])
            except Exception as e:  # noqa: BLE001
                faults.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in range(1, 21):
            V.publish(hundreds(spark, n), path)
            if n == 7:
                with pytest.raises(Exception, match="halfway"):
                    V.publish(hundreds(spark, 99).withColumn("bad", F.when(F.col("id") > 80, F.raise_error(F.lit("halfway")))), path)
            if n == 13:
                with monkeypatch.context() as m:
                    m.setattr(V, "put_if_absent", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
                    with pytest.raises(KeyboardInterrupt):
                        V.publish(hundreds(spark, 99), path)
    finally:
        stop.set()
        reader.join()
    assert not faults, faults
    assert len(seen) > 3
    assert all(len(rows) == 1 and rows[0][1] == 100 and rows[0][0] != 99 for rows in seen)
    assert [r[0][0] for r in seen] == sorted(r[0][0] for r in seen)
    assert V.versions(spark, path) == list(range(1, 22)) and V.read_version(spark, path, 3).first()["version"] == 2


def test_of_two_writers_one_is_told(spark, tmp_path):
    path = str(tmp_path / "t")
    base = V.publish(hundreds(spark, 1), path)
    assert V.publish(hundreds(spark, 2), path, base=base) == 2
    with pytest.raises(V.VersionConflict):
        V.publish(hundreds(spark, 3), path, base=base)
    assert V.read_version(spark, path).first()["version"] == 2
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("data-")]) == 2


def test_writers_at_once_make_each_version_once(spark, tmp_path):
    path, told = str(tmp_path / "t"), []

    def write(n):
        try:
            told.append(V.publish(hundreds(spark, n), path, base=0))
        except V.VersionConflict:
            told.append(0)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(told) == [0, 0, 0, 0, 0, 1] and V.versions(spark, path) == [1]


def test_a_file_is_put_once_by_either_way(spark, tmp_path):
    path = f"file://{tmp_path}/p.json"
    assert V.put_if_absent(spark, path, "one") and not V.put_if_absent(spark, path, "two")
    assert (tmp_path / "p.json").read_text() == "one" and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["p.json"]
    store, where = V._store(spark, f"file://{tmp_path}/q.json")
    for text in ("one", "two"):
        _, aside = V._store(spark, f"file://{tmp_path}/{uuid.uuid4().hex}")
        V._write(store, aside, text)
        if text == "one":
            V._rename(spark, aside, where)
        else:
            with pytest.raises(Exception, match="AlreadyExists"):
                V._rename(spark, aside, where)
    assert (tmp_path / "q.json").read_text() == "one"


def test_no_version_and_unknown_versions(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        V.read_version(spark, str(tmp_path / "none"))
    assert V.current(spark, str(tmp_path / "none")) == 0


def test_append_takes_only_new_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    df = lambda *rows: spark.createDataFrame(rows, "id string, x int")
    first = V.append_new(df(("a", 1), ("b", 1), ("a", 1), (None, 1)), path, "id")
    assert sorted(r["id"] for r in first.collect()) == ["a", "b"]
    assert sorted(r["id"] for r in V.append_new(df(("b", 2), ("c", 2)), path, "id").collect()) == ["c"]
    assert V.append_new(df(("b", 3)), path, "id").count() == 0 and V.current(spark, path) == 2
    wider = spark.createDataFrame([("d", 2, "y")], "id string, x int, more string")
    assert V.append_new(wider, path, "id").count() == 1
    assert sorted((r["id"], r["x"], r["more"]) for r in V.read_version(spark, path).collect()) == [("a", 1, None), ("b", 1, None), ("c", 2, None), ("d", 2, "y")]
    with pytest.raises(ValueError, match="x is int"):
        V.append_new(spark.createDataFrame([("e", "1")], "id string, x string"), path, "id")
    with pytest.raises(ValueError, match="64 buckets"):
        V.append_new(wider, path, "id", buckets=8)
    V.publish(df(("z", 9)), path)
    assert [r["id"] for r in V.append_new(df(("z", 1), ("a", 1)), path, "id").collect()] == ["a"]
    assert sorted((r["id"], r["x"]) for r in V.read_version(spark, path).collect()) == [("a", 1), ("z", 9)]
    with pytest.raises(ValueError):
        V.append_new(wider.withColumn(V.BUCKET, F.lit(1)), path, "id")


def test_append_reads_the_touched_buckets_once(spark, tmp_path):
    path = str(tmp_path / "t")
    V.append_new(spark.range(5000).withColumn("payload", F.repeat(F.lit("x"), 50)), path, "id")
    few = spark.createDataFrame([(7,), (9000,)], "id long").withColumn(V.BUCKET, F.pmod(F.xxhash64("id"), F.lit(64)).cast("int"))
    touched = sorted(r[0] for r in few.select(V.BUCKET).distinct().collect())
    plan = V.unseen(few, V._held(spark, path, V._entry(spark, path, 1)), "id", touched)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1 and "payload" not in scans[0] and all(str(b) in scans[0].split("PartitionFilters")[1] for b in touched)
    assert [r["id"] for r in V.append_new(spark.createDataFrame([(7, "p"), (9000, "p")], "id long, payload string"), path, "id").collect()] == [9000]


def test_a_slower_appender_compares_again(spark, tmp_path, monkeypatch):
    path, real, calls = str(tmp_path / "t"), V.put_if_absent, []
    V.append_new(spark.range(3), path, "id")

    def beaten(session, where, text):
        calls.append(where)
        if len(calls) == 1:  # another writer brings 3 and 4 meanwhile
            V.append_new(spark.range(5), path, "id")
        return real(session, where, text)

    monkeypatch.setattr(V, "put_if_absent", beaten)
    assert sorted(r["id"] for r in V.append_new(spark.range(7), path, "id").collect()) == [5, 6]
    assert sorted(r["id"] for r in V.read_version(spark, path).collect()) == list(range(7))


def test_expiry_keeps_what_is_named(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        V.publish(hundreds(spark, n), path)
    hundreds(spark, 9).write.parquet(f"{path}/data-orphan")
    assert len(V.expire(spark, path, 2)) == 2 and V.versions(spark, path) == [3, 4]
    assert V.read_version(spark, path, 3).count() == 100 and (tmp_path / "t" / "data-orphan").exists()
    assert V.expire(spark, path, 2, orphan_hours=-1) == ["data-orphan"]
    V.append_new(spark.range(3), str(tmp_path / "a"), "id")
    V.append_new(spark.range(6), str(tmp_path / "a"), "id")
    assert V.expire(spark, str(tmp_path / "a"), 1) == [] and V.read_version(spark, str(tmp_path / "a")).count() == 6
    with pytest.raises(ValueError):
        V.expire(spark, path, 0)
