"""Micro-batch upsert into a table of hash buckets. A batch rewrites only the buckets it touches."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import upsert
from ..operators.quality import dedupe
from ..sources.files import path_exists

#: How often a batch is merged anew because another writer was first.
TRIES = 20


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _marks(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that have a mark, oldest first."""
    if not path_exists(spark, f"{path}/_versions"):
        return []
    fs, p = _fs(spark, f"{path}/_versions")
    return sorted(int(n) for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.isdigit())


def _mark(path: str, version: int) -> str:
    return f"{path}/_versions/{version:012d}"


def _manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest whole version: its number, how many buckets the table has, the folder of each bucket, and the last batch of each source."""
    for version in reversed(_marks(spark, path)):
        try:
            return json.loads("\n".join(r[0] for r in spark.read.text(_mark(path, version)).collect()))
        except ValueError:  # its writer died while it wrote the mark
            continue
    return None


def _commit(spark: SparkSession, path: str, after: dict) -> bool:
    """Writes the mark of a version unless there is one: of two writers of a version the second is told no."""
    fs, mark = _fs(spark, _mark(path, after["version"]))
    try:
        out = fs.create(mark, False)
    except Py4JJavaError as exc:
        if "FileAlreadyExists" in str(exc.java_exception) or fs.exists(mark):
            return False
        raise
    out.write(json.dumps(after).encode())
    out.close()
    return True


def _read(spark: SparkSession, path: str, folders) -> DataFrame:
    return spark.read.parquet(*[f"{path}/{f}" for f in sorted(folders)])


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version."""
    now = _manifest(spark, path)
    return None if now is None or not now["buckets"] else _read(spark, path, now["buckets"].values())


def merge_batch(batch: DataFrame, batch_id: int, path: str, key: str, order: list, buckets: int, defaults: dict | None = None, source: str = "") -> None:
    """Latest row per key of the batch merged into the table as a new version.

    A version counts once its mark is written; the mark names the folder of every bucket and the last batch of each
    ``source`` (a stream's own id). A batch that is run again finds itself there and does nothing, or, when the earlier
    attempt died before the mark, writes its buckets again. A stream that starts anew has another id, so its batches are
    merged whatever their numbers. If another writer has taken the version meanwhile, the batch is merged into that one's
    table instead. ``order`` ranks the rows of one batch; a later batch replaces what earlier ones wrote. ``buckets`` is
    the number a new table begins with; ``rebucket`` changes it. The version before stays for readers.
    """
    spark = batch.sparkSession
    updates = dedupe(batch.filter(F.col(key).isNotNull()), [key], order, last=True)
    for _ in range(TRIES):
        now = _manifest(spark, path) or {"version": -1, "count": buckets, "buckets": {}, "seen": {}}
        if now["seen"].get(source, -1) >= batch_id:
            return
        # a mark that its writer did not finish keeps its number
        version = max([now["version"], *_marks(spark, path)[-1:]]) + 1
        bucket = _bucket(key, now["count"])
        # at most as many numbers as there are buckets
        touched = [r[0] for r in updates.select(bucket.alias("b")).distinct().collect()]
        old = [now["buckets"][str(b)] for b in touched if str(b) in now["buckets"]]
        base = _read(spark, path, old) if old else updates.limit(0)
        folder = f"v={version}-{uuid.uuid4().hex}"
        if touched:
            upsert(base, updates, key, defaults).withColumn("_bucket", bucket).write.partitionBy("_bucket").parquet(f"{path}/{folder}")
        after = {"version": version, "count": now["count"], "buckets": now["buckets"] | {str(b): f"{folder}/_bucket={b}" for b in touched},
                 "seen": now["seen"] | {source: batch_id}}
        if _commit(spark, path, after):
            _tidy(spark, path, now, after)
            return
    raise RuntimeError(f"{path}: other writers were first {TRIES} times")


def _bucket(key: str, count: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(count)).cast("int")


def rebucket(spark: SparkSession, path: str, key: str, buckets: int) -> None:
    """The whole table dealt out to another number of buckets, as a new version; for a table that has grown."""
    for _ in range(TRIES):
        now = _manifest(spark, path)
        if now is None or now["count"] == buckets:
            return
        version = max([now["version"], *_marks(spark, path)[-1:]]) + 1
        folder, placed = f"v={version}-{uuid.uuid4().hex}", {}
        if now["buckets"]:
            rows = _read(spark, path, now["buckets"].values()).withColumn("_bucket", _bucket(key, buckets))
            rows.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{path}/{folder}")
            fs, p = _fs(spark, f"{path}/{folder}")
            names = (s.getPath().getName() for s in fs.listStatus(p))
            placed = {n.split("=")[1]: f"{folder}/{n}" for n in names if n.startswith("_bucket=")}
        after = {**now, "version": version, "count": buckets, "buckets": placed}
        if _commit(spark, path, after):
            _tidy(spark, path, now, after)
            return
    raise RuntimeError(f"{path}: other writers were first {TRIES} times")


def _tidy(spark: SparkSession, path: str, before: dict, after: dict) -> None:
    """Removes marks before the version before, and bucket folders of versions up to it that neither it nor the newest uses."""
    fs, p = _fs(spark, path)
    for number in _marks(spark, path):
        if number < before["version"]:
            fs.delete(_fs(spark, _mark(path, number))[1], False)
    used = {f.split("/")[0] for m in (before, after) for f in m["buckets"].values()}
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        # another writer may be at work on a later version
        if name.startswith("v=") and int(name[2:].split("-")[0]) <= before["version"] and name not in used:
            fs.delete(status.getPath(), True)


def foreach_batch_upsert(stream: DataFrame, key: str, path: str, checkpoint: str, order: list, buckets: int, defaults: dict | None = None, **trigger):
    spark = stream.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        # the stream's id lives and dies with its checkpoint
        source = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"].replace("-", "")
        merge_batch(batch, batch_id, path, key, order, buckets, defaults, source)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
