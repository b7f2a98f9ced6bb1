"""Incremental state with Structured Streaming: newest-wins merges, once-per-day and content deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factweave.operators.facts import upsert_newest


def stream_files(spark: SparkSession, path: str, schema: str, file_format: str = "parquet") -> DataFrame:
    """New files of a folder; the checkpoint is the high-water mark, so each file is read once."""
    return spark.readStream.schema(schema).format(file_format).load(path)


def once_per_day(events: DataFrame, key: str, time: str, delay: str = "1 day") -> DataFrame:
    """S14 as a stream: the first event of each key and day, with state dropped behind the watermark."""
    marked = events.withWatermark(time, delay).withColumn("day", F.to_date(time))
    return marked.dropDuplicatesWithinWatermark([key, "day"])


def once_per_content(resources: DataFrame) -> DataFrame:
    """S13 as a stream: each content once."""
    return resources.dropDuplicates(["resource"])


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Events per key and window; late ones count until the watermark has passed."""
    return events.withWatermark(time, delay).groupBy(F.window(time, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


#: Snapshots are kept in so many buckets by the hash of their keys.
BUCKETS = 64


def _bucket(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _generations(spark: SparkSession, path: str, version: int) -> dict[int, list[int]]:
    """The versions of each bucket up to one, by the names of the folders (``version=/bucket=``)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[int, list[int]] = {}
    for folder in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/bucket=*")) or []:
        where = folder.getPath()
        number, bucket = (int(x.getName().partition("=")[2]) for x in (where.getParent(), where))
        if number <= version and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), "_SUCCESS")):
            out.setdefault(bucket, []).append(number)
    return {b: sorted(v) for b, v in out.items()}


def latest_snapshot(spark: SparkSession, path: str, version: int, buckets: list[int] | None = None) -> DataFrame | None:
    """The state after a batch: the newest version of every bucket (or of some); None if there is none."""
    held = _generations(spark, path, version)
    folders = [f"{path}/version={v[-1]}/bucket={b}" for b, v in held.items() if buckets is None or b in buckets]
    return spark.read.parquet(*folders) if folders else None


def _tidy(spark: SparkSession, path: str, version: int) -> None:
    """Remove versions of buckets that a later one, not after ``version``, has replaced."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for bucket, versions in _generations(spark, path, version).items():
        for old in versions[:-1]:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={old}/bucket={bucket}"), True)


def merge_newest(facts: DataFrame, path: str, keys: list[str], checkpoint: str, date: str = "entry_date", buckets: int = BUCKETS) -> StreamingQuery:
    """O12 as a stream: a batch rewrites the buckets that its keys fall in, as a version of its own. A batch that is repeated
    after a failure starts from the same earlier versions and overwrites its own, so the result is exactly once; versions
    that no repetition needs any more are removed."""
    spark = facts.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        new = upsert_newest(batch.limit(0), batch, keys, date).persist()
        touched = [r[0] for r in new.select(_bucket(keys, buckets)).distinct().collect()]  # at most ``buckets``
        held = latest_snapshot(spark, path, number - 1, touched) if number else None
        merged = new if held is None else upsert_newest(held, new, keys, date)
        merged.withColumn("bucket", _bucket(keys, buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={number}")
        new.unpersist()
        _tidy(spark, path, number - 1)

    return facts.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
