"""A join of many rows with one row per key that no hot key can overload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys in more than one of HOT rows are hot: fewer than HOT of them, so their rows can be broadcast.
HOT = 4096


def join_unique(left: DataFrame, right: DataFrame, key: str, hot: int = HOT) -> DataFrame:
    """Left outer join on ``key``, of which ``right`` has each value once. The rows of hot keys meet a broadcast of
    less than ``hot`` rows, the others a shuffle in which no key makes up more than one of ``hot`` rows. Both sides
    are read more than once: cut their lineage before, if they are dear."""
    counts = left.groupBy(key).agg(F.count("*").alias("n"))
    total = left.count()
    names = [r[0] for r in counts.where(F.col("n") * hot > total).select(key).collect()]
    if not names:
        return left.join(right, key, "left")
    is_hot = F.coalesce(F.col(key).isin(names), F.lit(False))
    return left.where(~is_hot).join(right, key, "left").unionByName(left.where(is_hot).join(F.broadcast(right.where(is_hot)), key, "left"))


#: A table of so many rows at most, of a bounded size each, is broadcast; of a larger one each row is copied SALTS times.
LOCAL, SALTS = 200_000, 16


def join_many(left: DataFrame, right: DataFrame, key: str, spread: str, local: int = LOCAL) -> DataFrame:
    """Inner join on ``key``, of which either side may have values many times, ``left`` hot ones too. ``right`` is
    broadcast up to ``local`` rows, by count; beyond, a value's rows of ``left`` are spread over SALTS tasks by the
    column ``spread``, to each of which its rows of ``right`` go."""
    if right.count() <= local:
        return left.join(F.broadcast(right), key)
    salted = left.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    copies = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [key, "salt"]).drop("salt")
