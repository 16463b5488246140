"""Structured Streaming over event files: windowed tallies and incremental ingest.

The catalogue itself is a batch product; these extend it to inputs that keep arriving.
State lives in the checkpoint folder of the query, so a restart goes on where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.scratch import scratch


def daily(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Windowed counts and sums per day and type; rows later than the watermark are dropped by design of the stream."""
    marked = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return marked.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def daily_tally(spark: SparkSession, path: str) -> DataFrame:
    """Run the stream over all files there are now, batch by batch, and return the final windows."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    # A single file is picked by name from its folder; a folder of files is read as it is.
    plain = spark.read.parquet(path).inputFiles()
    single = len(plain) == 1 and plain[0].endswith(name)
    reader = spark.readStream.schema(schema)
    stream = reader.option("pathGlobFilter", name).parquet(folder) if single else reader.parquet(path)
    out, state = scratch(spark, "daily"), scratch(spark, "state")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = daily(stream).writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    last = spark.read.parquet(out)
    final = last.filter(F.col("batch") == last.agg(F.max("batch")).first()[0])
    return final.select(F.to_date(F.col("w.start")).cast("string").alias("first_day"), "event_type", "n", F.round("total", 4).alias("total"))


def ingest_new(spark: SparkSession, source: str, schema: str, key: str, ledger: str, state: str) -> int:
    """Append rows of new files whose key the ledger does not hold yet, once per key; returns how many rows were added."""
    added = [0]

    def upsert(batch: DataFrame, number: int) -> None:
        try:
            known = spark.read.parquet(ledger).select(key)
            fresh = batch.dropDuplicates([key]).join(known, key, "left_anti")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            fresh = batch.dropDuplicates([key])
        fresh = fresh.persist()
        added[0] += fresh.count()
        fresh.write.mode("append").parquet(ledger)
        fresh.unpersist()

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(source)
    query = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return added[0]
