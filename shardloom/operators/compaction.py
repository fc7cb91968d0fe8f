"""Far too many small files: which to consolidate, into which larger files, and the consolidation itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shardloom.functions.paths import hidden, plain_path, unfinished
from shardloom.session import cut_lineage

SMALL = 65_536
TARGET = 128 << 20
#: A range of the plan has about so many target files, so that its only part-filled file hardly matters.
FILES_PER_RANGE = 16
#: Nor does a range hold more than about so many records.
RECORDS_PER_RANGE = 1_000_000


def live_files(manifest: DataFrame) -> DataFrame:
    """(path, repo, length): each file once, by its plain path, as its newest listing has it. At a tie of time a
    known length wins over null, then the larger one. A file whose newest length is null is gone; a null time is
    older than any; null paths are no files."""
    newest = F.max(F.struct("modification_time", F.col("length").isNotNull().alias("known"), "length", "repo"))
    files = manifest.select(plain_path(F.col("path")).alias("path"), "repo", "length", "modification_time").where("path is not null")
    return files.groupBy("path").agg(newest.alias("l")).where("l.length is not null").select("path", "l.repo", "l.length")


def small_files(manifest: DataFrame, small: int = SMALL) -> DataFrame:
    """(path, repo, length) of the live files of 1 to ``small`` - 1 bytes that are neither hidden nor unfinished."""
    p = F.col("path")
    return live_files(manifest).where((F.col("length") > 0) & (F.col("length") < small) & ~hidden(p) & ~unfinished(p))


def consolidation_plan(manifest: DataFrame, small: int = SMALL, target: int = TARGET) -> DataFrame:
    """(path, repo, length, range, file, offset) of every live small file, once: the larger file it goes into and
    where it starts there.

    The files are range-partitioned by (repo, path) at boundaries that Spark samples, so that a repository of any
    size is spread by its paths, into ranges of about FILES_PER_RANGE target files. A range of b bytes is cut, in
    key order, into round(b / target) files (one at least) of about equal size. The counts are reconciled with
    those before the partitioning; a difference raises RuntimeError."""
    files = cut_lineage(small_files(manifest, small))
    total = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    ranges = max(1, -(-total["bytes"] // (target * FILES_PER_RANGE)), -(-total["n"] // RECORDS_PER_RANGE))
    spread = files.repartitionByRange(ranges, "repo", "path").withColumn("range", F.spark_partition_id())
    whole = Window.partitionBy("range")
    before = whole.orderBy("repo", "path").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("length").over(before), F.lit(0))
    sized = spread.select("*", at.alias("at"), F.sum("length").over(whole).alias("bytes"))
    count = F.greatest(F.round(F.col("bytes") / target).cast("bigint"), F.lit(1))
    filed = sized.withColumn("file", F.floor(F.col("at") * count / F.col("bytes")).cast("int"))
    inside = Window.partitionBy("range", "file")
    plan = cut_lineage(filed.select("path", "repo", "length", "range", "file", (F.col("at") - F.min("at").over(inside)).alias("offset")))
    planned = plan.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    if tuple(planned) != tuple(total):
        raise RuntimeError(f"{tuple(planned)} planned of {tuple(total)}")
    return plan


def consolidated_files(manifest: DataFrame, small: int = SMALL, target: int = TARGET) -> DataFrame:
    """(range, file, files, bytes, first_path, last_path) of each larger file of the plan."""
    return consolidation_plan(manifest, small, target).groupBy("range", "file").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.min("path").alias("first_path"), F.max("path").alias("last_path"))


def _comparable(column: Column, kind: T.DataType) -> Column:
    """A column that a hash can be made of: a map as the sorted hashes of its entries, wherever it is nested."""
    if isinstance(kind, T.MapType):
        return F.array_sort(F.transform(F.map_entries(column), lambda e: F.xxhash64(_comparable(e["key"], kind.keyType), _comparable(e["value"], kind.valueType))))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _comparable(x, kind.elementType)) if "map<" in kind.simpleString() else column
    if isinstance(kind, T.StructType) and "map<" in kind.simpleString():
        parts = (_comparable(column[f.name], f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields))
        return F.when(column.isNotNull(), F.struct(*parts))
    return column


def _row_hash(df: DataFrame) -> Column:
    """A hash of a row's values and of which of them are null, so that null differs from what has the same hash."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    columns = [_comparable(F.col(f"`{f.name}`"), f.dataType) for f in fields]
    return F.xxhash64(*columns, *(c.isNull() for c in columns)) if columns else F.lit(0).cast("bigint")


def fingerprint(df: DataFrame) -> tuple:
    """Rows, and an order-free sum of their hashes."""
    return tuple(df.agg(F.count("*"), F.coalesce(F.sum(_row_hash(df).cast("decimal(38,0)")), F.lit(0))).first())


class _Folders:
    """A dataset's folder, what stands beside it while it is rewritten, and the journal that says so."""

    def __init__(self, spark: SparkSession, folder: str):
        self.path_of = spark._jvm.org.apache.hadoop.fs.Path
        self.path = self.path_of(folder.rstrip("/"))
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.new, self.old, self.journal = (self.path_of(self.path.getParent(), f".{self.path.getName()}-{x}") for x in ("new", "old", "journal"))

    def size(self) -> int:
        return self.fs.getContentSummary(self.path).getLength()

    def begin(self) -> None:
        self.fs.create(self.journal, True).close()

    def swap(self) -> None:
        if not (self.fs.rename(self.path, self.old) and self.fs.rename(self.new, self.path)):
            raise RuntimeError(f"could not swap {self.path}; recover() finishes it")

    def clear(self) -> None:
        for p in (self.new, self.old, self.journal):
            self.fs.delete(p, True)


def recover(spark: SparkSession, folder: str) -> str:
    """Finishes a rewriting that broke off: ``none`` if there was none; ``undone`` if the swap had not begun (the new files
    go); ``finished`` if the old folder had moved away: the new one, complete by then, takes its name."""
    f = _Folders(spark, folder)
    if not f.fs.exists(f.journal):
        # Without a journal no swap had begun: what stands beside is incomplete.
        begun = f.fs.exists(f.new)
        f.fs.delete(f.new, True)
        return "undone" if begun else "none"
    moved = f.fs.exists(f.old)
    if moved and not f.fs.exists(f.path) and not f.fs.rename(f.new, f.path):
        raise RuntimeError(f"could not move {f.new} to {folder}")
    f.clear()
    return "finished" if moved else "undone"


def partition_columns(df: DataFrame, folder: str) -> list[str]:
    """The columns by which the folder's files are laid out, ``<column>=<value>`` for each."""
    one = next(iter(df.inputFiles()), "")
    name = "/" + folder.rstrip("/").rsplit("/", 1)[-1] + "/"
    inside = one[one.rfind(name) + len(name) :].split("/")[:-1]
    return [p.split("=", 1)[0] for p in inside if "=" in p]


def compact(spark: SparkSession, folder: str, keys: list[str], target: int = TARGET) -> tuple[int, int]:
    """Rewrites the Parquet dataset in ``folder`` into files of about ``target`` bytes, sorted by ``keys``; returns
    the numbers of files before and after. A key of any number of rows is spread over files by a hash of the row; a
    folder laid out by columns keeps its layout. The new files are written beside the folder, their rows and hashes
    are reconciled with the old ones, a journal is written, and only then do the folders swap by two renames; the old
    one is deleted last. What breaks off is finished or undone by ``recover``, which comes first here too. On a
    difference nothing changes and RuntimeError is raised. An empty dataset keeps its schema in one file."""
    recover(spark, folder)
    f = _Folders(spark, folder)
    data = spark.read.parquet(folder)
    before = len(data.inputFiles())
    laid = partition_columns(data, folder)
    files = max(1, -(-f.size() // target))
    spread = data.repartitionByRange(files, *laid, *keys, _row_hash(data)).sortWithinPartitions(*laid, *keys)
    spread.write.partitionBy(*laid).parquet(f.new.toString())
    written = spark.read.schema(data.schema).parquet(f.new.toString())
    if fingerprint(written) != fingerprint(data):
        f.fs.delete(f.new, True)
        raise RuntimeError(f"{folder}: the rows written differ from those read")
    f.begin()
    f.swap()
    f.clear()
    return before, len(spark.read.parquet(folder).inputFiles())


def consolidated(spark: SparkSession, manifest: DataFrame, folder: str, pieces: int = 64) -> DataFrame:
    """(path, repo, length, files_before, files_after): the listing of live small files, written in many pieces to
    ``folder``, then compacted there and read back."""
    small_files(manifest).repartition(pieces, "path").write.parquet(folder)
    before, after = compact(spark, folder, ["repo", "path"])
    return spark.read.parquet(folder).select("*", F.lit(before).alias("files_before"), F.lit(after).alias("files_after"))
