"""Running totals, ranks and joins with counts that no group, however large, puts into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shardloom.session import cut_lineage

#: A table of one row per group is broadcast up to so many groups.
LOCAL_GROUPS = 200_000


def running(df: DataFrame, groups: list[str], order: list[str | Column], value: Column, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over a group's rows up to and including this one, in ``order``, nulls
    first. Rows that are equal in all of it may come in either order. A null value counts as 0; null keys are one group.

    Rows are range-partitioned by group and order at boundaries that Spark samples, each partition sums its own, and
    what a group has in the partitions before is added: a group costs one row for each partition it reaches into."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(g) for g in groups] + [F.col(o) if isinstance(o, str) else o for o in order]
    marked = df.withColumn("__v", F.coalesce(value, F.lit(0)).cast("bigint"))
    spread = cut_lineage(marked.repartitionByRange(parts, *by).withColumn("__part", F.spark_partition_id()))
    inside = Window.partitionBy("__part", *groups).orderBy(*(order)).rowsBetween(Window.unboundedPreceding, 0)
    own = spread.withColumn(name, F.sum("__v").over(inside))
    sums = spread.groupBy("__part", *groups).agg(F.sum("__v").alias("__sum"))
    earlier = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # Only a group that a boundary cuts has a row here, so there are fewer rows than partitions.
    before = sums.withColumn("__before", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).where("__before <> 0")
    before = before.select(F.col("__part").alias("__p"), "__before", *(F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)))
    same = F.col("__part") == F.col("__p")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    out = own.join(F.broadcast(before), same, "left").withColumn(name, F.col(name) + F.coalesce("__before", F.lit(0)))
    return out.select(*df.columns, name)


def rank(df: DataFrame, groups: list[str], order: list[str | Column], name: str = "rank") -> DataFrame:
    """``df`` with each row's place within its group in order, from 1."""
    return running(df, groups, order, F.lit(1), name)


def with_group(rows: DataFrame, groups: DataFrame, key: str, local: int = LOCAL_GROUPS) -> DataFrame:
    """Left join of ``rows`` with one row per value of ``key`` (null is one), which is broadcast up to ``local`` rows."""
    side = groups.withColumnRenamed(key, "__of")
    side = F.broadcast(side) if groups.count() <= local else side
    return rows.join(side, F.col(key).eqNullSafe(F.col("__of")), "left").drop("__of")
