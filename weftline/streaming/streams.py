"""The same operators over files that arrive: an extension, as all inputs of the batch operators are finite."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weftline.functions.seq import canonical


def arriving(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 16) -> DataFrame:
    """A stream over the Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def events(spark: SparkSession, path: str, schema: T.StructType, lateness: str = "10 minutes") -> DataFrame:
    """Events with a watermark; a time without a zone is taken as that of the session."""
    return arriving(spark, path, schema).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)


def dedup(stream: DataFrame, *keys: str) -> DataFrame:
    """The first row of each key within the watermark."""
    return stream.dropDuplicatesWithinWatermark(list(keys))


def window_counts(rows: DataFrame, size: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Events and summed values of each type in tumbling or sliding windows; serves batches too."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return rows.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(rows: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of each user, closed by a gap; serves batches too."""
    return rows.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what there is and stop; a later call goes on from there."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


class _FirstSeen(StatefulProcessor):
    """Keeps of each key the id of the first row: the one that came in the first batch, the smallest there."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "id string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = min(rows, key=lambda r: r["id"], default=None)  # rows are read to their end, whether they count or not
        if best is not None and not self.seen.exists():
            self.seen.update((best["id"],))
            yield Row(sample=best["sample"], id=best["id"], seq=best["seq"])

    def close(self) -> None:
        pass


def first_of_either_strand(reads: DataFrame) -> DataFrame:
    """``sample, id, seq`` of the reads (the same columns, strings) whose sequence no read before has on either strand, per sample.

    What is kept for each sequence is its first read's id, for as long as the stream's checkpoint stands: a restart goes on with
    it. Within a batch the smallest id is first. Rows without a sequence or an id are left out. Needs :func:`run_stateful`."""
    keyed = reads.where("seq IS NOT NULL AND id IS NOT NULL").select("sample", "id", "seq", F.xxhash64(canonical(F.col("seq"))).alias("_h"), canonical(F.col("seq")).alias("_c"))
    return keyed.groupBy("sample", "_h", "_c").transformWithState(statefulProcessor=_FirstSeen(), outputStructType="sample string, id string, seq string", outputMode="Append", timeMode="none")


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def run_stateful(stream: DataFrame, path: str, checkpoint: str) -> None:
    """:func:`run_available` for streams whose state is our own: it is kept by RocksDB, which the setting names while they run."""
    conf = stream.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        run_available(stream, path, checkpoint)
    finally:
        conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)
