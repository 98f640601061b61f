"""What the operators of this subpackage share: Arrow batches, cut lineage, input tables."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workers import importable, shared_folder

#: Rows of a batch handed to Python; with long texts this bounds a worker's memory.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, stem: str) -> str:
    """A column name that df doesn't have, in whatever case."""
    have, name = {c.lower() for c in df.columns}, f"_{stem}"
    while name.lower() in have:
        name += "_"
    return name


def small_batches(spark: SparkSession) -> None:
    """Arrow batches are bounded in rows and, where Spark can, in bytes: one may hold only very long texts. Python workers on this file's path can import it."""
    importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def arrow_map(df: DataFrame, f: Callable[..., Iterator[dict]], schema: str) -> DataFrame:
    """mapInArrow where f gets each batch as lists of columns and returns a dict of columns in the schema's order."""
    small_batches(df.sparkSession)
    wanted = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = f(*(c.to_pylist() for c in batch.columns))
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, type=t.type) for x, t in zip(made, out, strict=True)], schema=out)

    return df.mapInArrow(run, schema)


def tidy(spark: SparkSession) -> None:
    """Lets go of the shuffle files of jobs that have ended; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: lineage ends here, and a lost executor costs nothing that was done before. The table goes when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_at = path
    return back


def free(df: DataFrame) -> None:
    """Deletes a table made by cut() that nothing reads any more, and the shuffle files of jobs that have ended."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(df.written_at)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    tidy(spark)


def components(edges: DataFrame, *, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges as rows (node, comp), comp the smallest node reachable.

    Alternating large-star and small-star steps (each a shuffle and a partial minimum per node) until the edges stand
    still; every round's edges are a written table. Only counts and sums reach the driver. No edges: no rows.
    """
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v").distinct()
    e = cut(e, "edges")
    last = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: each node's smaller neighbours all go to the smallest of them.
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        e = cut(down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("comp"))
    roots = e.select(F.col("v").alias("node")).distinct().join(nodes.select("node"), "node", "left_anti").select("node", F.col("node").alias("comp"))
    return nodes.union(roots)
