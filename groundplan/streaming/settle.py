"""Files that writers are still writing: a path is passed on once its length stays the same over two looks.

A look is a listing of the folder, written by Spark as a small table. The looks are a stream; a stateful operator keeps the
length of each path at its last look, and a processing-time timer for each path that isn't settled. A path comes once: at
the first look at which it has the length, above zero, of the look before, or when its patience is over and it still grows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from groundplan.streaming.ingest import file_stream, state_settings

IMAGES = "*.{png,jpg,jpeg,tif,tiff,bmp,PNG,JPG,JPEG,TIF,TIFF,BMP}"
LOOK = "path string, modified timestamp, length long, look long"
SETTLED = "path string, modified timestamp, length long, settled boolean"


class Settling(StatefulProcessor):
    """State of a path: its length and time of modification at its last look, and whether it has been passed on."""

    def __init__(self, patience: float):
        self.patience = int(1000 * patience)

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "length long, modified timestamp, told boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802  Spark's name
        known = self.last.get() if self.last.exists() else None
        if known is None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience)
        length, told = (known[0], known[2]) if known else (None, False)
        for r in sorted(rows, key=lambda r: r.look):
            if not told and r.length == length and r.length:
                told = True
                yield Row(path=key[0], modified=r.modified, length=r.length, settled=True)
            length = r.length
            self.last.update((r.length, r.modified, told))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802  Spark's name
        length, modified, told = self.last.get()
        if not told:
            self.last.update((length, modified, True))
            yield Row(path=key[0], modified=modified, length=length, settled=False)

    def close(self) -> None:
        pass


def look(spark: SparkSession, folder: str, looks: str, number: int, glob: str = IMAGES, since: int | None = None) -> None:
    """Write one listing of the folder to `looks`; since: files modified after that epoch second only (without a backlog)."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", F.col("modificationTime").alias("modified"), "length")
    if since is not None:
        listed = listed.filter(F.col("modified") > F.timestamp_seconds(F.lit(since)))
    listed.withColumn("look", F.lit(number).cast("long")).coalesce(1).write.mode("overwrite").parquet(f"{looks}/look={number:012d}")


def settled(spark: SparkSession, looks: str, patience: float = 5.0) -> DataFrame:
    """The stream of SETTLED paths over the looks, one look a batch."""
    rows = file_stream(spark, looks, "parquet", spark.createDataFrame([], LOOK).schema, files_per_trigger=1, recursiveFileLookup="true")
    return rows.groupBy("path").transformWithState(Settling(patience), SETTLED, "Append", "ProcessingTime")


def watch(stream: DataFrame, take: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Give each batch of settled paths to `take`, in order of their modification; one task a batch, as a batch is new files only."""
    one = lambda batch, number: take(batch.coalesce(1).sortWithinPartitions("modified", "path"), number)
    writer = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    # With timers about, Spark would run batch after batch without data; here each look is a batch, and timers end with it.
    with state_settings(stream.sparkSession, spark__sql__streaming__noDataMicroBatches__enabled="false"):
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
