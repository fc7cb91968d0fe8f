"""State files of batches, the log of processed files, and reports, as JSON in any file system."""

from __future__ import annotations

import json
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "path string, taggers array<string>, processed_at string"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of an address or local path, and the path in it."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def exists(uri: str) -> bool:
    """Whether there is a file."""
    fs, path = file_system(uri)
    return fs.get_file_info(path).type == pafs.FileType.File


def write_atomic(uri: str, content: bytes) -> None:
    """Writes beside the name and renames, so that readers see the old or the new content."""
    fs, path = file_system(uri)
    if folder := path.rpartition("/")[0]:
        fs.create_dir(folder, recursive=True)
    part = f"{path}.{uuid.uuid4().hex[:8]}.part"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(content)
    fs.move(part, path)


def read_state(uri: str) -> dict:
    """A state file; empty if it is missing or no JSON object. One file, made by this program: small."""
    try:
        fs, path = file_system(uri)
        with fs.open_input_stream(path, compression=None) as f:
            value = json.loads(f.read().decode("utf-8"))
    except (OSError, ValueError):
        return {}
    return value if isinstance(value, dict) else {}


def save_state(uri: str, state: dict) -> None:
    """Pretty JSON, atomically."""
    write_atomic(uri, json.dumps(state, ensure_ascii=False, indent=2).encode())


def find_state(uri: str, pattern: str) -> str:
    """The state file to use: ``uri`` if its request map isn't empty, else the newest file beside it with a name of
    ``pattern`` (a prefix and a suffix around ``*``) whose map isn't, as another machine wrote it; else ``uri``."""
    if read_state(uri).get("request_map"):
        return uri
    fs, path = file_system(uri)
    begin, _, end = pattern.partition("*")
    beside = fs.get_file_info(pafs.FileSelector(path.rpartition("/")[0] or ".", allow_not_found=True))
    named = [i for i in beside if i.base_name.startswith(begin) and i.base_name.endswith(end) and i.path != path]
    root = uri[: len(uri) - len(path)] if uri.endswith(path) else ""
    for info in sorted(named, key=lambda i: (i.mtime, i.path), reverse=True):
        if read_state(root + info.path).get("request_map"):
            return root + info.path
    return uri


def newest_states(states: DataFrame, requests: DataFrame, name: str) -> DataFrame:
    """(name, batch_id): of state rows (name, batch_id, created_at) the newest with a request; null where none has one."""
    held = requests.select(F.col("batch_id").alias("of")).distinct().withColumn("held", F.lit(True))
    joined = states.select(name, "batch_id", "created_at").join(held, F.col("batch_id") == F.col("of"), "left")
    return joined.groupBy(name).agg(F.max_by(F.when(F.col("held"), F.col("batch_id")), F.when(F.col("held"), F.struct("created_at", "batch_id"))).alias("batch_id"))


def read_log(spark: SparkSession, uri: str) -> DataFrame:
    """(path, taggers, processed_at) of a log {"processed": {path: {"taggers", "processed_at"}}}; empty if there is none."""
    held = read_state(uri).get("processed")
    rows = [(p, e.get("taggers"), e.get("processed_at")) for p, e in (held or {}).items() if isinstance(e, dict)]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def merge_log(log: DataFrame, runs: DataFrame) -> DataFrame:
    """(path, taggers, processed_at): the log with new ``runs`` of the same columns: the sorted union of taggers, the last time."""
    both = log.unionByName(runs)
    each = both.groupBy("path").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("taggers")))).alias("taggers"), F.max("processed_at").alias("processed_at"))
    return each


def write_report(records: DataFrame, folder: str) -> None:
    """Records as JSON, one object a line, in as many files as there are partitions."""
    records.write.mode("overwrite").option("ignoreNullFields", "false").json(folder)
