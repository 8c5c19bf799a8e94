"""Incremental work: what is left to do, what is stale, and exactly-once ingestion by micro-batches."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def todo(sample: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return sample.join(done.select(key).distinct(), key, "left_anti")


def stale(docs: DataFrame, current: int) -> DataFrame:
    """Documents of another converter version, or of none."""
    return docs.where(~F.col("converter_version").eqNullSafe(current))


def ingest(spark: SparkSession, source: str, schema, target: str, checkpoint: str, convert) -> None:
    """Reads new files once, converts each micro-batch and writes it under its batch id, so a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        convert(batch).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    q = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def keep_bytes(files: DataFrame, path: str) -> None:
    """Appends files (doc_id, exchange, content) that the bronze table doesn't hold yet, by the digest of their bytes, under their exchange."""
    spark = files.sparkSession
    new = files.where("content IS NOT NULL").withColumn("sha", F.sha2("content", 256)).dropDuplicates(["doc_id", "sha"])
    try:
        held = spark.read.parquet(path).select("doc_id", "sha")
    except AnalysisException:  # the first time there is no table
        held = None
    if held is not None:
        new = new.join(held, ["doc_id", "sha"], "left_anti")
    new.withColumn("bytes", F.octet_length("content")).write.mode("append").partitionBy("exchange").parquet(path)
