"""Append only new keys, as a stream."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tamarack.operators.tabular import anti_join_seen, one_per_key
from tamarack.sources.sinks import newest_version, read_layout, write_layout

# The rows of a history are foldered by the bucket of the key and the batch they came with.
FOLDERS = ["bucket", "part"]


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, key: str, buckets: int, part: str, whole: bool = False) -> DataFrame:
    """Write rows as one part; a part written before is replaced, and all of them with ``whole``."""
    placed = rows.withColumns({"bucket": _bucket(key, buckets), "part": F.lit(part)})
    # One file per bucket and part: a bucket is read as a whole.
    writer = placed.repartition("bucket").write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "static" if whole else "dynamic")
    writer.partitionBy(*FOLDERS).parquet(path)
    return placed


def _folder(spark: SparkSession, path: str) -> str:
    """Where the rows of the newest layout are."""
    return f"{path}/rows-{newest_version(spark, f'{path}/_layout')}"


def start_history(history: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Write the rows known so far, none or many, in folders by the hash of ``key``."""
    version = newest_version(history.sparkSession, f"{path}/_layout") + 1
    placed = _write(history, f"{path}/rows-{version}", key, buckets, "start", whole=True)
    write_layout(placed, path, buckets, f"rows-{version}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All rows appended so far."""
    return read_layout(spark, path)[0].drop(*FOLDERS)


def compact_history(spark: SparkSession, path: str, key: str) -> None:
    """Write the parts of all batches as one, with one file per bucket.

    The new rows count once they are complete, so a job that dies leaves the history as it was. The
    rows of the layout before stay for readers that have begun; older ones are deleted. Not for while a
    stream runs; a batch that is run again afterwards finds its rows in the history.
    """
    rows, buckets = read_layout(spark, path)
    version = newest_version(spark, f"{path}/_layout")
    placed = _write(rows.drop(*FOLDERS), f"{path}/rows-{version + 1}", key, buckets, "start", whole=True)
    write_layout(placed, path, buckets, f"rows-{version + 1}")
    for old in range(version):
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/rows-{old}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def seen_rows(spark: SparkSession, path: str, batch: DataFrame, key: str, but: str) -> tuple[DataFrame, int]:
    """Rows of the history in the buckets that ``batch`` touches, without part ``but``, and the bucket count."""
    history, buckets = read_layout(spark, path)
    touched = [r[0] for r in batch.select(_bucket(key, buckets)).distinct().collect()]  # at most `buckets` numbers
    return history.filter(F.col("bucket").isin(touched) & (F.col("part") != but)), buckets


def _stream_name(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def append_stream(stream: DataFrame, path: str, key: str, checkpoint: str) -> StreamingQuery:
    """Run what has arrived in ``stream`` into the history at ``path``.

    Each micro-batch writes a part of its own, named after the checkpoint and
    the batch. When a batch is run again after a failure it compares with all
    parts but its own and replaces that, so every key, NULL included, is stored
    once. Only the key column of the buckets that the batch touches is read.
    """
    stream_name = _stream_name(checkpoint)

    def append(batch: DataFrame, batch_id: int) -> None:
        spark, part = batch.sparkSession, f"{stream_name}-{batch_id}"
        seen, buckets = seen_rows(spark, path, batch, key, part)
        _write(anti_join_seen(one_per_key(batch, key), seen, key), _folder(spark, path), key, buckets, part)

    writer = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def first_of_keys(stream: DataFrame, key: str) -> DataFrame:
    """The rows whose key the stream has not brought in an earlier batch, one per key: the smallest of its batch.

    For output mode update. Which keys were seen is state of the stream, restored with the checkpoint: an
    aggregate per key of its smallest row and of the times of the batches that brought it, of which a batch
    that is run again keeps its own. Set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB
    provider where the keys are more than executors can hold.
    """
    now = F.current_timestamp()  # one time for all rows of a batch
    held = F.struct("__at", *[c for c in stream.columns if c != key])
    state = stream.withColumn("__at", now).groupBy(key).agg(F.min(held).alias("__row"), F.max("__at").alias("__last"))
    # A clock set back must not make a known key a new one, so both times are those of the batch.
    new = state.filter((F.col("__row.__at") == now) & (F.col("__last") == now))
    return new.select(*[key if c == key else F.col("__row")[c].alias(c) for c in stream.columns])


def append_stateful(stream: DataFrame, path: str, key: str, checkpoint: str) -> StreamingQuery:
    """:func:`append_stream` with the keys of earlier batches as state: only parts of others are read.

    A batch that is run again starts from the state before it, gives the same rows, and replaces its part.
    """
    stream_name = _stream_name(checkpoint)

    def append(batch: DataFrame, batch_id: int) -> None:
        spark, part = batch.sparkSession, f"{stream_name}-{batch_id}"
        seen, buckets = seen_rows(spark, path, batch, key, part)
        others = seen.filter(~F.col("part").startswith(stream_name))
        _write(anti_join_seen(batch, others, key), _folder(spark, path), key, buckets, part)

    writer = first_of_keys(stream, key).writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
