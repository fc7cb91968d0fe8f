"""Latest request states as a stream over files that arrive (an extension: the log is otherwise read in batches)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def arriving(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """Parquet files of the request log as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def latest_states(log: DataFrame) -> DataFrame:
    """(request_id, state, updated_at), kept up to date; late rows don't replace newer ones."""
    newest = F.max(F.struct("updated_at", "log_id", "state"))
    return log.groupBy("request_id").agg(newest.alias("l")).select("request_id", "l.state", "l.updated_at")


def hourly_states(log: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """(hour, state, n) of log rows, each hour once it is past the watermark."""
    at = log.withColumn("at", F.timestamp_seconds("updated_at")).withWatermark("at", lateness)
    return at.groupBy(F.window("at", "1 hour").alias("w"), "state").agg(F.count("*").alias("n")).select(F.col("w.start").alias("hour"), "state", "n")


def run_to_end(df: DataFrame, folder: str, mode: str = "complete") -> DataFrame:
    """Runs over what is there and gives the result of the last trigger, which the executors write to ``folder``, shared
    by all of them; the state stays in their stores, and no row comes to the driver. ``complete`` and ``update`` results
    are those of one trigger: with ``update`` start from a folder that was not run before."""

    def keep(result: DataFrame, number: int) -> None:
        # A repeated trigger has the same number and replaces what it left.
        result.write.mode("overwrite").parquet(f"{folder}/result/trigger={number}")

    q = df.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    every = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("trigger", T.LongType())])).parquet(f"{folder}/result")
    last = every.agg(F.max("trigger")).first()[0]
    return every.where(F.col("trigger") == last).drop("trigger")
