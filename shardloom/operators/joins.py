"""Joins of frames, videos, requests and responses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frame_values(frames: DataFrame, video: str, value: str, order: list[str], every: DataFrame | None = None) -> DataFrame:
    """(video, value): of a video's frames the last value, in order, that isn't empty; empty if none has one. Videos of
    ``every`` without frames come out empty too."""
    filled = F.coalesce(F.col(value), F.lit("")) != ""
    last = F.max_by(F.when(filled, F.col(value)), F.when(filled, F.struct(*order)))
    got = frames.groupBy(video).agg(F.coalesce(last, F.lit("")).alias(value))
    if every is None:
        return got
    return every.select(video).distinct().join(got, video, "left").select(video, F.coalesce(value, F.lit("")).alias(value))


def merged_extras(frames: DataFrame, video: str, order: list[str], tags: str) -> DataFrame:
    """(video, tags): tags of all frames of a video, those of the primary (first) frame before, each at its first place."""
    held = F.array_sort(F.collect_list(F.struct(*order, F.coalesce(tags, F.array().cast("array<string>")).alias("tags"))))
    return frames.groupBy(video).agg(held.alias("f")).select(video, F.array_distinct(F.flatten("f.tags")).alias(tags))


def by_custom_id(results: DataFrame, paths: DataFrame, path: str = "path") -> DataFrame:
    """The ``results`` (custom_id, ...) with the path whose SHA-1 is their id; results of unknown paths are left out."""
    keyed = paths.select(path).where(F.col(path).isNotNull()).distinct().withColumn("custom_id", F.sha1(F.col(path)))
    return results.join(keyed, "custom_id")


def by_position(requests: DataFrame, responses: DataFrame, group: str, ordinal: str, value: str) -> DataFrame:
    """The ``requests`` (group, ordinal, ...) with the response of the same place in their group: null beyond the last
    response; responses beyond the last request are left out. Places are given, never taken from the order of rows."""
    return requests.join(responses.select(group, ordinal, value), [group, ordinal], "left")


def result_files(results: DataFrame, requests: DataFrame, files: DataFrame, relative_first: bool = False) -> DataFrame:
    """(request_id, file) of each result whose request names a file that exists: by its absolute path, then by its
    relative one, or the other way round; null if neither is there. Results of unknown requests are left out."""
    asked = requests.groupBy("request_id").agg(F.max(F.struct("path", "path_rel")).alias("r")).select("request_id", "r.path", "r.path_rel")
    there = files.select("path").where("path is not null").distinct()
    named = results.select("request_id").distinct().join(asked, "request_id")
    named = named.join(there.select(F.col("path").alias("by_path")), F.col("path") == F.col("by_path"), "left")
    named = named.join(there.select(F.col("path").alias("by_rel")), F.col("path_rel") == F.col("by_rel"), "left")
    found = ("by_rel", "by_path") if relative_first else ("by_path", "by_rel")
    return named.select("request_id", F.coalesce(*found).alias("file"))


def frame_columns(frames: DataFrame, key: str, index: str, value: str, count: int = 5) -> DataFrame:
    """(key, f0 ... f<count - 1>): a column for each frame number, null for a missing one; the greatest value of equal ones."""
    return frames.groupBy(key).agg(*(F.max(F.when(F.col(index) == i, F.col(value))).alias(f"f{i}") for i in range(count)))


def left_chain(base: DataFrame, sides: list[DataFrame], keys: list[str], defaults: dict[str, Column]) -> DataFrame:
    """Left joins of ``base`` with each of ``sides`` (one row per key), and what stands for what is missing."""
    joined = reduce(lambda df, side: df.join(side, keys, "left"), sides, base)
    return joined.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def with_categories(tags: DataFrame, vocab: DataFrame, key: list[str], tag: str = "tag", category: Column | None = None) -> DataFrame:
    """(key, tag, category) of exploded tags: a tag is looked up trimmed and lower-cased, as the vocabulary spells it and
    with spaces for underscores; of entries that meet on one spelling the last, by (tag_id, name), wins. ``general``
    without an entry. The vocabulary is a fixed table of at most a few thousand rows: Spark broadcasts it by its size."""
    low = F.lower(F.trim("name"))
    spelled = vocab.select("tag_id", "name", (category if category is not None else F.col("category")).alias("category"), F.explode(F.array_distinct(F.array(low, F.replace(low, F.lit("_"), F.lit(" "))))).alias("spelling"))
    last = spelled.groupBy("spelling").agg(F.max_by("category", F.struct("tag_id", "name")).alias("category"))
    found = tags.withColumn("spelling", F.lower(F.trim(tag))).join(last, "spelling", "left")
    return found.select(*key, tag, F.coalesce("category", F.lit("general")).alias("category"))
