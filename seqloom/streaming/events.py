"""Streams of timed events: sessions, windows, and a stateful cap; each has the batch operators' semantics."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.formats import scratch_path
from ..workers import importable


def read_stream(spark: SparkSession, path: str, files_per_trigger: int = 8) -> DataFrame:
    """A table's files as a stream, a bounded number for each trigger."""
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if _is_folder(spark, path):
        return r.parquet(path)
    folder, name = path.rsplit("/", 1)
    return r.option("pathGlobFilter", name).parquet(folder)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def sessions(events: DataFrame, key: str, gap: str, time: str = "ts", late: str = "10 minutes") -> DataFrame:
    """(key, first, last, n) of a key's events less than a gap apart."""
    w = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return w.select(key, F.col("w.start").alias("first"), F.col("w.end").alias("last"), "n")


def windows(events: DataFrame, key: str, width: str, slide: str | None = None, time: str = "ts", value: str = "value", late: str = "10 minutes") -> DataFrame:
    """(key, start, n, total) per tumbling or sliding window."""
    w = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, width, slide).alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return w.select(key, F.col("w.start").alias("start"), "n", "total")


def capped(events: DataFrame, key: str, most: int) -> DataFrame:
    """The first ``most`` events of each key to arrive; the state of a key is one number."""
    importable(events.sparkSession)
    schema = events.schema

    def step(_: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        seen = state.get[0] if state.exists else 0
        for b in batches:
            keep = b.iloc[: max(0, most - seen)]
            seen += len(keep)
            yield keep
        state.update((seen,))

    return events.groupBy(key).applyInPandasWithState(step, schema, "seen long", "append", "NoTimeout")


def run_to_end(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there and returns its result as a table. append_rest: what the watermark still holds counts too."""
    spark = stream.sparkSession
    path, at = scratch_path(spark, "stream"), scratch_path(spark, "progress")
    if mode == "append_rest":
        # Every trigger's updated groups are kept with its number; the last one of a group is its result.
        keys = [c for c in stream.columns if c not in ("n", "total", "last")]

        def keep(batch: DataFrame, i: int) -> None:
            batch.withColumn("_i", F.lit(i)).write.mode("append").parquet(path)

        stream.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", at).trigger(availableNow=True).start().awaitTermination()
        rows = spark.read.parquet(path)
        last = rows.agg(F.max("_i").alias("_m"))
        return rows.join(F.broadcast(last), F.col("_i") == F.col("_m")).drop("_i", "_m").dropDuplicates(keys)
    stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", at).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)

