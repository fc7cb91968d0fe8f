"""The log of captioning requests: latest states, counters, attempts, resumption."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shardloom.functions.text import base_request_id
from shardloom.operators.ordered import running

#: States in which a request isn't sent again.
SENT = ("submitted", "succeeded")


def latest(log: DataFrame, key: str = "request_id") -> DataFrame:
    """(key, state, attempt, error_message, batch_id, updated_at) of each request's newest row; the greatest log_id of equally new ones."""
    cols = ["state", "attempt", "error_message", "batch_id", "updated_at"]
    newest = F.max_by(F.struct(*cols), F.struct("updated_at", "log_id"))
    return log.groupBy(key).agg(newest.alias("l")).select(key, "l.*")


def counters(log: DataFrame) -> DataFrame:
    """(batch_id, total, succeeded, failed, pending, percent) by latest state."""
    failed = F.startswith(F.col("state"), F.lit("failed"))
    by = latest(log).groupBy("batch_id").agg(F.count("*").alias("total"), F.count_if(F.col("state") == "succeeded").alias("succeeded"), F.count_if(failed).alias("failed"))
    done = F.col("succeeded") + F.col("failed")
    return by.select("*", (F.col("total") - done).alias("pending"), (done * 100 / F.col("total")).alias("percent"))


def attempts(log: DataFrame) -> DataFrame:
    """(base_id, attempt, sent, next_id): highest attempt of each base request, whether any of its requests was sent, and
    the id to use next, null if it was."""
    based = log.select(base_request_id(F.col("request_id")).alias("base_id"), "attempt", F.col("state").isin(*SENT).alias("s"))
    by = based.groupBy("base_id").agg(F.max("attempt").alias("attempt"), F.bool_or("s").alias("sent"))
    return by.select("*", F.when(~F.col("sent"), F.concat("base_id", F.lit("_a"), (F.coalesce("attempt", F.lit(0)) + 1).cast("string"))).alias("next_id"))


def unsent(wanted: DataFrame, log: DataFrame) -> DataFrame:
    """The ``wanted`` rows (request_id, ...) whose latest state isn't a sent one."""
    sent = latest(log).where(F.col("state").isin(*SENT)).select("request_id")
    return wanted.join(sent, "request_id", "left_anti")


def failed_paths(log: DataFrame) -> DataFrame:
    """(batch_id, path_rel) of requests whose latest state is a failure, each once."""
    now = latest(log).where(F.startswith(F.col("state"), F.lit("failed"))).select("request_id", "batch_id")
    place = log.groupBy("request_id").agg(F.max_by("path_rel", F.struct("updated_at", "log_id")).alias("path_rel"))
    return now.join(place, "request_id").select("batch_id", "path_rel").distinct()


def upsert_log(runs: DataFrame, keys: list[str], tagger: str, when: str) -> DataFrame:
    """(keys, taggers, processed_at): the sorted set of taggers that ran over each item, and the last time."""
    return runs.groupBy(*keys).agg(F.array_sort(F.collect_set(tagger)).alias("taggers"), F.max(when).alias("processed_at"))


def unprocessed(items: DataFrame, processed: DataFrame, keys: list[str], requested: list[str]) -> DataFrame:
    """The items that not all ``requested`` taggers ran over."""
    done = processed.where(F.size(F.array_except(F.array(*(F.lit(r) for r in requested)), "taggers")) == 0).select(*keys)
    return items.join(done, keys, "left_anti")


def rolling_count(calls: DataFrame, at: str, seconds: int, key: str) -> DataFrame:
    """(key, at, calls): how many calls lie in the ``seconds`` up to and including each call. Calls of one moment are
    counted first; moments are partitioned by stretches of that length, each with a copy of those before it, so that
    no task sees the whole order. Without a time there is no count."""
    us = F.unix_micros(F.col(at).cast("timestamp"))
    width = seconds * 1_000_000
    timed = calls.select(key, at, us.alias("us"))
    own = timed.groupBy("us").agg(F.count("*").alias("n")).withColumn("bucket", F.floor(F.col("us") / width)).withColumn("own", F.lit(True))
    both = own.unionByName(own.withColumn("bucket", F.col("bucket") + 1).withColumn("own", F.lit(False)))
    trailing = Window.partitionBy("bucket").orderBy("us").rangeBetween(-width, 0)
    moments = both.withColumn("calls", F.sum("n").over(trailing)).where("own").select("us", "calls")
    return timed.join(moments, "us", "left").select(key, at, "calls")


def zero_streaks(polls: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """(key, streak): the longest run of polls in order whose value is 0."""
    zero = F.coalesce(F.col(value) == 0, F.lit(False))
    marked = running(polls.select(key, *order, zero.alias("z")), [key], order, F.when(F.col("z"), 0).otherwise(1), "island")
    return marked.groupBy(key, "island").agg(F.count_if("z").alias("run")).groupBy(key).agg(F.max("run").alias("streak"))


def drifted(batches: DataFrame) -> DataFrame:
    """(prompt_profile, systems, users, drift): different prompt hashes of each profile; null hashes are unknown, not different."""
    by = batches.groupBy("prompt_profile").agg(F.count_distinct("system_prompt_sha256").alias("systems"), F.count_distinct("user_prompt_template_sha256").alias("users"))
    return by.withColumn("drift", (F.col("systems") > 1) | (F.col("users") > 1))
