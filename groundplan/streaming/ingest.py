"""Resumable ingestion: new files or rows only, each key once, failures to a table of their own, fetch errors again.

Which keys have come is the state of the query, kept by Spark in RocksDB and checkpointed as a log of changes: a batch reads
its own rows and writes its own keys, however many came before. A batch that is repeated after a loss starts from the state
before it, so it gets the same rows and overwrites its own folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

#: Settings of queries with state.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def file_stream(spark: SparkSession, path: str, fmt: str, schema: T.StructType, files_per_trigger: int = 1000, **options) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


BINARY = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())]
)


def watch_images(spark: SparkSession, path: str, glob: str = "*.{png,jpg,jpeg,tif,tiff,bmp}", backlog: bool = True) -> DataFrame:
    """A stream of image files as they appear, for writers that rename them into place; without backlog the newest come first.

    streaming.settle waits for files that are written in place.
    """
    return file_stream(spark, path, "binaryFile", BINARY, pathGlobFilter=glob, latestFirst=not backlog)


@contextmanager
def state_settings(spark: SparkSession, **more: str) -> Iterator[None]:
    """STATE and more (with dots as two underscores) in the session while a query starts, which takes a copy; then what was there before."""
    new = STATE | {k.replace("__", "."): v for k, v in more.items()}
    before = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def first_seen(stream: DataFrame, *keys: str, within: tuple[str, str] | None = None) -> DataFrame:
    """The first row of each key (null as any other) that the stream brings.

    within=(time column, delay) forgets a key when the watermark has passed its first row by the delay; without it, keys are
    kept for good, at the size of a key each, in the state store of the task that owns their hash.
    """
    if within is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(*within).dropDuplicatesWithinWatermark(list(keys))


def ingest(
    stream: DataFrame, key: str, parse: Callable[[DataFrame], DataFrame], out: str, dead: str, checkpoint: str, every: str | None = None, seen: str | None = None,
    retry: str | None = None, tries: int | None = None, within: tuple[str, str] | None = None, name: str | None = None,
) -> StreamingQuery:
    """Write each key's parsed rows once to `out` and failed rows to `dead`, each with the `batch` that brought them.

    parse gives a batch a boolean `parsed`: true goes to `out`, false (a page that can't be read) to `dead`, both for good.
    null (a page that couldn't be fetched) goes to `retry`, if given, whose files are a part of the stream: the next run, or
    the next trigger, tries the key again, up to `tries` times in all, then it goes to `dead`.

    Keys that came before are skipped, also within a batch; so are those of the table `seen`, which each batch reads. A batch
    is a folder of its own, named by checkpoint and number: a batch repeated after a loss between writes overwrites its own
    folders, so it adds nothing twice and loses nothing. every: a processing-time trigger, None: what is there now, then stop.
    """
    spark = stream.sparkSession
    run = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex[:12]
    turn = "_try"
    rows = stream.withColumn(turn, F.lit(0))
    if retry:
        p = spark._jvm.org.apache.hadoop.fs.Path(retry)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
        rows = rows.unionByName(file_stream(spark, retry, "parquet", T.StructType([*stream.schema.fields, T.StructField(turn, T.IntegerType())]), recursiveFileLookup="true"))
    rows = first_seen(rows.withColumn(turn, F.coalesce(turn, F.lit(0))), key, turn, within=within)  # never null, whichever side has rows: the state's type stays

    def one(batch: DataFrame, number: int) -> None:
        folder = f"batch={run}-{number}"
        if seen:
            batch = batch.join(spark.read.parquet(seen).select(F.col(key).alias("_known")), F.col(key).eqNullSafe(F.col("_known")), "left_anti")
        done = parse(batch).persist()
        again = F.col("parsed").isNull() & F.lit(retry is not None) & (F.lit(tries is None) | (F.col(turn) + 1 < (tries or 0)))
        try:
            done.filter("parsed").drop("parsed", turn).write.mode("overwrite").parquet(f"{out}/{folder}")
            done.filter(~F.coalesce("parsed", F.lit(False)) & ~again).drop("parsed", turn).write.mode("overwrite").parquet(f"{dead}/{folder}")
            if retry:
                done.filter(again).withColumn(turn, F.col(turn) + 1).select(*rows.columns).write.mode("overwrite").parquet(f"{retry}/{folder}")
        finally:
            done.unpersist()

    writer = rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    with state_settings(spark):
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def counters(parsed: DataFrame, site: str) -> DataFrame:
    """Parsed and failed rows of each site."""
    return parsed.groupBy(site).agg(F.count_if("parsed").alias("parsed"), F.count_if(~F.col("parsed")).alias("failed"))


def windowed_counts(stream: DataFrame, time: str, key: str, value: str, width: str, late: str) -> DataFrame:
    """Event-time windows with a watermark: n and total by key."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def latest_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run a complete-mode query to its end; each batch replaces the table at `path`, which executors write."""
    one = lambda batch, number: batch.write.mode("overwrite").parquet(path)
    with state_settings(stream.sparkSession):
        return stream.writeStream.outputMode("complete").foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
