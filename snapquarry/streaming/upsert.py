"""Streaming upsert: a table of records kept current as they arrive, in buckets of which only touched ones are written anew.

Below ``out``: ``buckets/v<batch>/bucket=<k>`` holds the records of a bucket of keys as of a
batch; ``log/v<batch>`` has a row for each bucket with the batch that wrote it. A version of
the table is a log with the buckets that it names. A batch reads and writes the buckets that
its records touch, and those with keys that have vanished, and then the log; a batch that is
run again writes the same.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

BUCKETS, KEEP = 64, 3  # buckets of keys; finished versions that stay readable


def newest(records: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last record of each key; a grouped maximum, so Spark combines before the shuffle."""
    rest = [c for c in records.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return records.groupBy(key).agg(last.alias("r")).select(key, "r.*").select(*records.columns)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def versions(spark: SparkSession, out: str) -> list[int]:
    """The finished versions, ascending; at most a few more than are kept."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(out)
    done = top.getFileSystem(conf).globStatus(jvm.org.apache.hadoop.fs.Path(top, "log/v*/_SUCCESS"))
    return sorted(int(s.getPath().getParent().getName()[1:]) for s in done or [])


def named_buckets(spark: SparkSession, out: str, version: int) -> dict[int, int]:
    """The batch that wrote each bucket of a version: one number for each of a fixed number of buckets."""
    return {r.bucket: r.batch for r in spark.read.schema("bucket int, batch bigint").parquet(f"{out}/log/v{version:09d}").collect()}


def read_buckets(spark: SparkSession, out: str, named: dict[int, int], schema) -> DataFrame:
    paths = [f"{out}/buckets/v{batch:09d}/bucket={k}" for k, batch in sorted(named.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge_batch(spark: SparkSession, batch: DataFrame, batch_id: int, out: str, key: str, order: Sequence[str], present: Callable[[], DataFrame] | None = None, buckets: int = BUCKETS, keep: int = KEEP) -> None:
    """Merge a micro-batch into version ``batch_id``. ``present`` gives the keys that are still there: records of others leave, of this batch and of the table."""
    done = [v for v in versions(spark, out) if v < batch_id]
    named = named_buckets(spark, out, done[-1]) if done else {}
    there = present().select(key).distinct() if present else None
    new = newest(batch, key, order)
    touched = {r.bucket for r in new.select(bucket_of(key, buckets)).distinct().collect()}
    if there is not None and named:
        gone = read_buckets(spark, out, named, batch.schema).select(key).join(there, key, "left_anti")
        touched |= {r.bucket for r in gone.select(bucket_of(key, buckets)).distinct().collect()}
    old = read_buckets(spark, out, {k: v for k, v in named.items() if k in touched}, batch.schema)
    merged = newest(old.unionByName(new), key, order)
    if there is not None:
        merged = merged.join(there, key, "left_semi")
    at = f"{out}/buckets/v{batch_id:09d}"
    merged.withColumn("bucket", bucket_of(key, buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(at)
    wrote = {r.bucket for r in spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(at).select("bucket").distinct().collect()} if touched else set()
    now = [(k, v) for k, v in named.items() if k not in touched] + [(k, batch_id) for k in sorted(wrote)]
    spark.createDataFrame(now, "bucket int, batch bigint").coalesce(1).write.mode("overwrite").parquet(f"{out}/log/v{batch_id:09d}")
    drop_old(spark, out, [*done, batch_id], keep)


def drop_old(spark: SparkSession, out: str, done: Sequence[int], keep: int) -> None:
    """Delete the versions before the last ``keep``, and the buckets that none of those names."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    store = path(out).getFileSystem(conf)
    live = {(k, v) for x in done[-keep:] for k, v in named_buckets(spark, out, x).items()}
    for v in done[:-keep]:
        store.delete(path(f"{out}/log/v{v:09d}"), True)
    for s in store.globStatus(path(f"{out}/buckets/v*/bucket=*")) or []:
        k, v = int(s.getPath().getName().split("=")[1]), int(s.getPath().getParent().getName()[1:])
        if (k, v) not in live and v <= done[-1]:
            store.delete(s.getPath(), True)


def upsert_stream(source: DataFrame, out: str, checkpoint: str, key: str, order: Sequence[str], every: str | None = "5 seconds", present: Callable[[], DataFrame] | None = None, buckets: int = BUCKETS, keep: int = KEEP) -> StreamingQuery:
    """Keep ``out`` current; ``every`` None reads what is there and ends. Late records need no watermark: order decides. A restart with the same checkpoint goes on with the last finished version."""
    spark = source.sparkSession
    writer = source.writeStream.foreachBatch(lambda df, i: merge_batch(spark, df, i, out, key, order, present, buckets, keep)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def latest_version(spark: SparkSession, out: str, schema) -> DataFrame:
    """The records of the newest finished version. A restart that finds nothing new names a batch without one, so the logs decide."""
    done = versions(spark, out)
    if not done:
        raise FileNotFoundError(f"no version below {out}")
    return read_buckets(spark, out, named_buckets(spark, out, done[-1]), schema)
