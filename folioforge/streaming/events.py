"""Structured Streaming forms of the batch analogues: idempotent upsert, windowed counts, sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.sources.files import scratch


def replay(spark: SparkSession, path: str, like: DataFrame, files_per_trigger: int = 1) -> DataFrame:
    """A table's folder as a stream."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed_counts(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, late: str = "1 hour", gap: str = "30 minutes") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))


def drained(stream: DataFrame, mode: str = "complete") -> DataFrame:
    """The stream run over all that is there, into a Parquet table in the shared folder; for finite replays.

    Each batch has its own folder, so one that runs again replaces its own rows. In complete mode there is one folder for
    all, since the last batch is the result.
    """
    spark, schema, place = stream.sparkSession, stream.schema, scratch(stream.sparkSession, "drained")
    spark.createDataFrame([], schema).write.parquet(f"{place}/none")

    def batch(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{place}/{'all' if mode == 'complete' else f'batch-{number}'}")

    query = stream.writeStream.foreachBatch(batch).outputMode(mode).option("checkpointLocation", scratch(spark, "stream")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(schema).parquet(f"{place}/*")


def upserting(stream: DataFrame, target: str, key: Sequence[str], order: str):
    """A stream into a keyed table at `target`, one version for each batch: running a batch again changes nothing.

    The row of a key that is last by `order` wins, whatever batch brings it. A reader takes the `newest` version; the
    older ones can be removed.
    """

    def batch(rows: DataFrame, number: int) -> None:
        if number:
            rows = rows.unionByName(rows.sparkSession.read.schema(rows.schema).parquet(f"{target}/v{number - 1}"))
        last = rows.groupBy(*key).agg(F.max_by(F.struct(*rows.columns), order).alias("_r")).select("_r.*")
        last.write.mode("overwrite").parquet(f"{target}/v{number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{target}/_checkpoint").trigger(availableNow=True)


def newest(spark: SparkSession, target: str) -> DataFrame:
    """The newest whole version of a table that `upserting` keeps."""
    versions = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/v*/_SUCCESS")
    found = versions.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(versions)
    number = max(int(f.getPath().getParent().getName()[1:]) for f in found)
    return spark.read.parquet(f"{target}/v{number}")
