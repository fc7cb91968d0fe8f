"""Folders of files: listings, sidecars, vocabularies, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.tags import strip
from shardloom.sources.state import exists, file_system


def listing(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """(path, length, modification_time) of the files of a folder; their content is never read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return raw.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length", F.col("modificationTime").alias("modification_time"))


def contents(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, content) of the files whose names fit ``pattern``."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return raw.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "content")


def broken_images(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of the images that Spark's image source can't decode."""
    raw = spark.read.format("image").option("recursiveFileLookup", "true").load(folder)
    return raw.where("image.width < 0").select(F.col("image.origin").alias("path"))


def sidecars(spark: SparkSession, folder: str, ext: str = ".txt") -> DataFrame:
    """(stem, text): stripped text of each sidecar."""
    raw = contents(spark, folder, f"*{ext}")
    return raw.select(F.regexp_replace("path", r"\.[^./]*$", "").alias("stem"), strip(F.decode("content", "utf-8")).alias("text"))


def report(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON array."""
    return spark.read.option("multiLine", "true").json(path)


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(tag_id, name, category) of a CSV with header."""
    return spark.read.option("header", "true").csv(path).select("tag_id", "name", "category")


def thresholds(spark: SparkSession, path: str, lower: bool = True) -> dict[str, float]:
    """Category to threshold from a small CSV: columns category or name and threshold under a header, else the first
    and last column; bad rows are skipped, the last of a category wins, ``name`` wins over ``category``."""
    rows = [[c.strip() for c in r["value"].split(",")] for r in spark.read.text(path).collect() if r["value"].strip()]
    head = [c.lower() for c in rows[0]] if rows else []
    named = next((head.index(c) for c in ("name", "category") if c in head), None)
    value = head.index("threshold") if "threshold" in head else -1
    out = {}
    for r in rows[1:] if named is not None else rows:
        try:
            key = r[named or 0]
            if key:
                out[key.lower() if lower else key] = float(r[value])
        except (ValueError, IndexError):
            continue
    return out


def prompt_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """(mode, profile, system, user) of ``<mode>/<profile>/{system,user}_prompt.md``; a profile needs a system prompt."""
    raw = contents(spark, folder, "*_prompt.md")
    parts = F.split("path", "/")
    at = raw.select(F.element_at(parts, -3).alias("mode"), F.element_at(parts, -2).alias("profile"), F.element_at(parts, -1).alias("file"), strip(F.decode("content", "utf-8")).alias("t"))
    by = at.groupBy("mode", "profile").agg(*(F.max(F.when(F.col("file") == f"{n}_prompt.md", F.col("t"))).alias(n) for n in ("system", "user")))
    return by.where("system is not null").orderBy("mode", F.when(F.col("profile") == "default", 0).otherwise(1), "profile")


def prompt(folder: str, kind: str, mode: str, profile: str, override: str | None = None, default: str = "") -> str:
    """The text of ``<kind>_prompt.md``, stripped: of the ``override`` file, which must exist if it is given, else the first
    that exists of ``<folder>/<mode>/<profile>``, ``<folder>/<mode>`` and ``<folder>``, else ``default``."""
    if override is not None:
        fs, path = file_system(override)
        with fs.open_input_stream(path) as f:
            return f.read().decode("utf-8").strip()
    root = folder.rstrip("/")
    for at in (f"{root}/{mode}/{profile}", f"{root}/{mode}", root):
        if exists(uri := f"{at}/{kind}_prompt.md"):
            fs, path = file_system(uri)
            with fs.open_input_stream(path) as f:
                return f.read().decode("utf-8").strip()
    return default
