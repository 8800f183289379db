"""Micro-batch forms: raw records into a deduplicated store, an event log into its
latest state, and counts in windows of event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.records import insert_once


def once_per_key(stream: DataFrame, keys: list[str], time_col: str, late: str = "30 days") -> DataFrame:
    """Records seen again are dropped; the state of a key is kept as long as late ones are awaited."""
    return stream.withWatermark(time_col, late).dropDuplicatesWithinWatermark(keys)


def exists(spark: SparkSession, path: str) -> bool:
    """Is there anything at the path, on whatever file system it names?"""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at))  # noqa: SLF001


def ingest_raw(stream: DataFrame, store: str, keys: list[str], order: str, checkpoint: str) -> StreamingQuery:
    """Write-once ingest: each micro-batch appends the records whose key the store lacks.
    A batch writes below its own number, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        path = f"{store}/batch={number}"
        fresh = insert_once(batch.limit(0), batch, keys, order)
        if exists(spark, store):  # an error of reading it is not taken for an empty store
            # only the keys are read
            fresh = fresh.join(spark.read.parquet(store).filter(F.col("batch") != number).select(*keys), keys, "left_anti")
        fresh.select(*batch.columns).write.mode("overwrite").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_state(log: DataFrame, key: str, time_col: str) -> DataFrame:
    """The state of each entity of an append-only log: its row of the latest time; for streams in update mode."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(time_col)).alias("r")).select(key, "r.*")


def windowed_counts(stream: DataFrame, time_col: str, group: str, value: str, width: str, late: str, slide: str | None = None) -> DataFrame:
    """Rows and the sum of a value in tumbling or sliding windows of event time; rows later than `late` are left out."""
    window = F.window(time_col, width, slide) if slide else F.window(time_col, width)
    watermarked = stream.withWatermark(time_col, late) if stream.isStreaming else stream
    return watermarked.groupBy(window.alias("w"), group).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), group, "n", "total")


def read_stream(spark: SparkSession, path: str, schema: object, files: int = 1) -> DataFrame:
    """Parquet files below path as a stream, so many for each micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)  # type: ignore[arg-type]


def run_to_table(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Run a stream to its present end, its rows into files below path, and return them. In complete mode
    each micro-batch replaces the whole, in append mode each writes below its own number, so
    that a repeated one replaces itself; nothing passes through the driver."""
    place = f"{path}/rows"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(place if mode == "complete" else f"{place}/batch={number}")

    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    spark = stream.sparkSession
    return spark.read.parquet(place).drop("batch") if exists(spark, place) else spark.createDataFrame([], stream.schema)
