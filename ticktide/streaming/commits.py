"""Batch sinks with a commit log, and a compacted table that rewrites touched buckets only.

A batch is data in a folder of its own and then one small file in ``log``, put
there by a rename. Readers look at the log first, so a batch that fails between
its data and its commit is not seen, and one that runs again after its commit is
left out. Log entries hold one number per bucket at most; no rows pass through
the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ticktide.operators import tables

Handler = Callable[[DataFrame, int], None]


class CommitLog:
    """Finished batches of a table and what each says about it."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self.folder, self.data = f"{path}/log", f"{path}/data"
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def batches(self) -> list[int]:
        """Ids of the finished batches, in order."""
        folder = self._path(self.folder)
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def read(self, batch_id: int) -> dict:
        stream = self._fs.open(self._path(f"{self.folder}/{batch_id}"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, batch_id: int, entry: dict) -> None:
        """The entry appears whole or not at all."""
        hidden = self._path(f"{self.folder}/_{batch_id}")
        stream = self._fs.create(hidden, True)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        if not self._fs.rename(hidden, self._path(f"{self.folder}/{batch_id}")):
            raise OSError(f"batch {batch_id} of {self.folder} was not committed")

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


def committed_folder(path: str) -> Handler:
    """A sink in which a batch counts once, from its commit on."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        log = CommitLog(batch.sparkSession, path)
        if batch_id not in log.batches():
            batch.write.mode("overwrite").parquet(f"{log.data}/batch={batch_id}")
            log.commit(batch_id, {})

    return handle


def committed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all finished batches of `committed_folder`."""
    log = CommitLog(spark, path)
    return _read(spark, [f"{log.data}/batch={b}" for b in log.batches()], schema)


def _read(spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def compacted_table(path: str, keys: list[str], version: str | list[str], buckets: int = 64, keep: int = 2) -> Handler:
    """Keep the latest row per key of a stream.

    Keys lie in hash buckets. A batch reads and rewrites the buckets that it
    touches, beside the live ones; its commit names the batch that wrote each
    bucket. Buckets that none of the last ``keep`` commits names are deleted, so
    that a reader has the time of ``keep - 1`` batches to finish. A batch with few
    keys costs few buckets, whatever the size of the table.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = CommitLog(spark, path)
        done = log.batches()
        if batch_id in done:
            return
        live = {int(k): b for k, b in log.read(done[-1])["buckets"].items()} if done else {}
        bucket = bucket_of(keys, buckets)
        # At most as many numbers as there are buckets.
        touched = sorted(r[0] for r in batch.select(bucket.alias("bucket")).distinct().collect())
        schema = batch.schema
        before = _read(spark, [f"{log.data}/batch={live[b]}/bucket={b}" for b in touched if b in live], schema)
        newest = tables.latest_per_key(before.unionByName(tables.latest_per_key(batch, keys, version)), keys, version)
        (newest.withColumn("bucket", bucket).repartition("bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{log.data}/batch={batch_id}"))
        now = {**live, **dict.fromkeys(touched, batch_id)}
        log.commit(batch_id, {"buckets": now, "rewritten": len(touched)})
        wanted = {(int(k), b) for d in [*done, batch_id][-keep:] for k, b in log.read(d)["buckets"].items()}
        if len(done) >= keep:
            for k, b in log.read(done[-keep])["buckets"].items():
                if (int(k), b) not in wanted:
                    log.delete(f"{log.data}/batch={b}/bucket={k}")

    return handle


def compacted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as of its last commit; only live buckets are read."""
    log = CommitLog(spark, path)
    done = log.batches()
    live = log.read(done[-1])["buckets"] if done else {}
    return _read(spark, [f"{log.data}/batch={b}/bucket={k}" for k, b in sorted(live.items())], schema)
