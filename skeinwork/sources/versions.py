"""Tables in versions: data in folders that never change, and one small file a version that names them.

A reader takes the version of the largest number, so it has a whole table whatever writers do meanwhile. A writer puts
the file behind the version it started from; a store lets one writer put it, and tells the others.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

#: Stores whose files appear whole when they are closed, and which can refuse to replace one then.
OBJECT_STORES = ("s3a", "gs", "abfs", "abfss")
LOG, RUN, BUCKET = "_versions", "_run", "_key_bucket"


class VersionConflict(Exception):
    """Another writer has put the version that this one was to be."""


def _store(spark: SparkSession, path: str):
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def _write(store, where, text: str) -> None:
    out = store.create(where, False)
    out.write(bytearray(text.encode()))
    out.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Puts a file with all of its text at once, unless there is one; says whether it did.

    A local file is written aside and linked; an object store gets it in one conditional put; other stores rename without
    replacing, which they do at once.
    """
    store, where = _store(spark, path)
    jvm, scheme = spark.sparkContext._jvm, store.getUri().getScheme()
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    try:
        if scheme in OBJECT_STORES:
            _write(store, where, text)
            return True
        _write(store, aside, text)
        if scheme == "file":
            local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(where), local(aside))
        else:
            _rename(spark, aside, where)
        return True
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        if scheme not in OBJECT_STORES:
            store.delete(aside, False)


def _rename(spark: SparkSession, source, target) -> None:
    sc = spark.sparkContext
    kind = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = sc._gateway.new_array(kind, 1)
    how[0] = kind.NONE
    sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), sc._jsc.hadoopConfiguration()).rename(source, target, how)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions that are there, in order."""
    store, log = _store(spark, f"{path}/{LOG}")
    names = [s.getPath().getName() for s in store.listStatus(log)] if store.exists(log) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def current(spark: SparkSession, path: str) -> int:
    """The number of the newest version; 0 if there is none."""
    return max(versions(spark, path), default=0)


def _entry(spark: SparkSession, path: str, version: int) -> dict:
    store, where = _store(spark, f"{path}/{LOG}/{version:020d}.json")
    stream = store.open(where)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version, of the newest by default. It stays what it is while others write."""
    version = current(spark, path) if version is None else version
    if not version:
        raise FileNotFoundError(f"{path} has no version")
    entry = _entry(spark, path, version)
    names = [f["name"] for f in entry["schema"]["fields"]]
    return _held(spark, path, entry).select(*[F.col(f"`{n}`") for n in names])


def _held(spark: SparkSession, path: str, entry: dict) -> DataFrame:
    """The rows of a version, with RUN and BUCKET, which name the folders of appended rows; null for published ones."""
    schema = StructType.fromJson(entry["schema"])
    plain = [f"{path}/{f}" for f in entry["folders"] if not f.startswith(f"{RUN}=")]
    runs = [f"{path}/{f}" for f in entry["folders"] if f.startswith(f"{RUN}=")]
    whole = StructType([*schema.fields]).add(RUN, StringType()).add(BUCKET, IntegerType())
    parts = [spark.read.schema(schema).parquet(*plain).withColumns({RUN: F.lit(None).cast("string"), BUCKET: F.lit(None).cast("int")})] if plain else []
    parts += [spark.read.schema(whole).option("basePath", path).parquet(*runs)] if runs else []
    return parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]


def _commit(spark: SparkSession, path: str, base: int, folders: list[str], schema: StructType, buckets: int | None = None) -> int:
    entry = json.dumps({"folders": folders, "schema": schema.jsonValue(), "buckets": buckets})
    if not put_if_absent(spark, f"{path}/{LOG}/{base + 1:020d}.json", entry):
        store, written = _store(spark, f"{path}/{folders[-1]}")
        store.delete(written, True)
        raise VersionConflict(f"{path}: version {base + 1} is another writer's")
    return base + 1


def publish(df: DataFrame, path: str, base: int | None = None) -> int:
    """Writes df as the version behind `base`, the one it was made from (by default the newest as the writing begins), and
    returns its number. VersionConflict if another writer was there first: its version stays, this one's data goes.

    A job that dies leaves a folder that no version names; see expire().
    """
    spark = df.sparkSession
    base = current(spark, path) if base is None else base
    folder = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    return _commit(spark, path, base, [folder], df.schema)


def _joined(old: StructType, new: StructType) -> StructType:
    """The fields of both; one of a name has to be of one type."""
    kinds = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        if kinds.get(f.name, f.dataType) != f.dataType:
            raise ValueError(f"{f.name} is {kinds[f.name].simpleString()} in the table, {f.dataType.simpleString()} in the new rows")
    return StructType([*old.fields, *[f for f in new.fields if f.name not in kinds]])


def unseen(df: DataFrame, held: DataFrame, key: str, touched: list[int]) -> DataFrame:
    """The rows of df whose key `held` has not; of the appended runs only the folders of the touched buckets are read, of all only the
    keys, once."""
    seen = held.filter(F.col(BUCKET).isNull() | F.col(BUCKET).isin(touched)).select(key)
    return df.join(seen, key, "left_anti")


def append_new(df: DataFrame, path: str, key: str, buckets: int = 64, attempts: int = 5) -> DataFrame:
    """Appends the rows whose key the table at path does not hold (one of each key; null keys are dropped) as a new version,
    and returns their keys.

    A run's rows lie in a folder of its own, by a hash of the key: the next run reads the keys of the buckets that its own
    rows fall into (and of what was published), and the keys returned come from the run's folder alone. Where another
    writer was first, the rows are compared again with what it wrote. A run without new rows makes no version. All runs of a table
    take the same number of buckets.
    """
    if {RUN, BUCKET} & {c.lower() for c in df.columns}:
        raise ValueError(f"{RUN} and {BUCKET} are the sink's own columns")
    spark = df.sparkSession
    rows = df.filter(F.col(key).isNotNull()).dropDuplicates([key])
    own = rows.withColumn(BUCKET, F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int"))
    for _ in range(attempts):
        base, folder = current(spark, path), f"{RUN}={uuid.uuid4().hex}"
        entry = _entry(spark, path, base) if base else {"folders": [], "schema": df.schema.jsonValue(), "buckets": buckets}
        if entry.setdefault("buckets", buckets) not in (None, buckets):
            raise ValueError(f"the runs of {path} have {entry['buckets']} buckets")
        schema = _joined(StructType.fromJson(entry["schema"]), df.schema)
        new = own
        if base:
            touched = [r[0] for r in own.select(BUCKET).distinct().collect()]  # `buckets` numbers at most
            new = unseen(own, _held(spark, path, entry), key, touched)
        # A file a bucket; several, from several tasks, where a bucket is large.
        new.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
        added = spark.read.schema(own.schema).parquet(f"{path}/{folder}").select(key)
        if added.isEmpty():
            store, written = _store(spark, f"{path}/{folder}")
            store.delete(written, True)
            return spark.createDataFrame([], added.schema)
        try:
            _commit(spark, path, base, [*entry["folders"], folder], schema, buckets)
            return added
        except VersionConflict:
            continue
    raise VersionConflict(f"{path}: other writers were first {attempts} times")


def expire(spark: SparkSession, path: str, keep: int, orphan_hours: float = 24) -> list[str]:
    """Deletes all but the newest `keep` versions, the folders that only they name, and folders that no version names and that
    are older than any writer still at work; returns the folders deleted."""
    if keep < 1:
        raise ValueError("the newest version stays")
    store, root = _store(spark, path)
    numbers = versions(spark, path)
    named = {f for n in numbers[-keep:] for f in _entry(spark, path, n)["folders"]}
    old = {f for n in numbers[:-keep] for f in _entry(spark, path, n)["folders"]} - named
    for n in numbers[:-keep]:
        store.delete(_store(spark, f"{path}/{LOG}/{n:020d}.json")[1], False)
    before = spark.sparkContext._jvm.java.lang.System.currentTimeMillis() - orphan_hours * 3_600_000
    for status in store.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(("data-", f"{RUN}=")) and name not in named and status.getModificationTime() < before:
            old.add(name)
    for name in sorted(old):
        store.delete(_store(spark, f"{path}/{name}")[1], True)
    return sorted(old)
