"""Filling fixed-capacity containers by best-two-fit."""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.functions.paths import plain_path
from shardloom.operators.ordered import with_group
from shardloom.session import cut_lineage

CAPACITY = 268_435_456
#: A repository's entries are spread over blocks of about so many, each packed by one task.
BLOCK = 20_000


class _Rest:
    """Unpacked sizes, ascending, with removal."""

    def __init__(self, sizes: list[int]):
        self.at = list(range(len(sizes)))
        self.sizes = list(sizes)

    def __len__(self) -> int:
        return len(self.sizes)

    def largest_within(self, room: int) -> int:
        return bisect.bisect_right(self.sizes, room) - 1

    def take(self, i: int) -> tuple[int, int]:
        return self.sizes.pop(i), self.at.pop(i)

    def put(self, size: int, at: int) -> None:
        i = bisect.bisect_left(self.sizes, size)
        self.sizes.insert(i, size)
        self.at.insert(i, at)

    def best_two(self, room: int, above: int) -> tuple[int, int] | None:
        """The two whose sum is largest within ``room`` and more than ``above``."""
        low, high, best, found = 0, len(self.sizes) - 1, above, None
        while low < high:
            total = self.sizes[low] + self.sizes[high]
            if total > room:
                high -= 1
                continue
            if total > best:
                best, found = total, (low, high)
                if best == room:
                    break
            low += 1
        return found


def best_two_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes into ``sizes`` (ascending, each above 0 and at most ``capacity``). Each bin is filled
    greedily, the largest that fits first; then its smallest entry gives way to two unpacked ones while they fit
    the gap so expanded more tightly."""
    rest, bins = _Rest(sizes), []
    while len(rest):
        room, members = capacity, []
        while (i := rest.largest_within(room)) >= 0:
            size, at = rest.take(i)
            room -= size
            members.append((size, at))
        while room and len(rest) > 1:
            least = min(members)
            two = rest.best_two(room + least[0], least[0])
            if not two:
                break
            members.remove(least)
            low, high = two
            added = [rest.take(high), rest.take(low)]
            rest.put(*least)
            members += added
            room += least[0] - added[0][0] - added[1][0]
        bins.append([at for _, at in members])
    return bins


def entries(df: DataFrame) -> DataFrame:
    """(repo, rel, size): each entry once, by its plain path within its repository, with the size of its newest
    listing; at a tie of time a known size wins over null, then the larger one."""
    newest = F.max(F.struct("listed_at", F.col("size").isNotNull(), "size"))
    return df.select("repo", plain_path(F.col("rel"), rooted=False).alias("rel"), "size", "listed_at").where("rel is not null").groupBy("repo", "rel").agg(newest["size"].alias("size"))


def pack(df: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """(repo, rel, size, part, parts, part_size, shard) of every entry: one row, or one per part if it is larger
    than a shard. Whole shards of a large entry are shards of their own; its remainder is packed like an entry.
    An entry without bytes goes into its block's first shard; one whose size is null (gone) or negative has no shard.

    Shards are packed per repository, a large repository in blocks drawn by a hash of the path, which cost at
    most one part-filled shard each. Shard names are ``<repo>-<block>-<number>`` and the same at every run."""
    e = cut_lineage(entries(df)).withColumn("hash", F.xxhash64("rel"))
    blocks = e.groupBy("repo").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    spread = with_group(e, blocks, "repo").select("repo", "rel", "size", F.pmod("hash", "blocks").cast("int").alias("block"))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "rel"], kind="stable").reset_index(drop=True)
        known = pdf["size"].notna() & (pdf["size"] >= 0)
        rows: list[tuple] = []
        sizes, origin, number = [], [], 0
        for i in pdf.index[~known]:
            rows.append((i, 0, 1, None, None))
        empty = [i for i in pdf.index[known] if pdf["size"][i] == 0]
        for i in pdf.index[known]:
            size = int(pdf["size"][i])
            parts = max(1, -(-size // capacity))
            if size > capacity:
                for part in range(size // capacity):
                    rows.append((i, part, parts, capacity, number))
                    number += 1
                size -= size // capacity * capacity
            if size:
                sizes.append(size)
                origin.append((i, parts - 1, parts))
        order = sorted(range(len(sizes)), key=lambda k: (sizes[k], origin[k]))
        ascending = [sizes[k] for k in order]
        for members in best_two_fit(ascending, capacity):
            for m in members:
                rows.append((*origin[order[m]], ascending[m], number))
            number += 1
        rows += [(i, 0, 1, 0, 0) for i in empty]
        at = [r[0] for r in rows]
        repo, blk = pdf["repo"].iloc[0], int(pdf["block"].iloc[0])
        name = lambda k: None if k is None else f"{'' if repo is None else repo}-{blk:04d}-{k:06d}"
        return pd.DataFrame(
            {
                "repo": pdf["repo"].to_numpy()[at], "rel": pdf["rel"].to_numpy()[at], "size": pdf["size"].astype("Int64").array[at],
                "part": np.array([r[1] for r in rows], "int32"), "parts": np.array([r[2] for r in rows], "int32"),
                "part_size": pd.array([r[3] for r in rows], "Int64"), "shard": [name(r[4]) for r in rows],
            }
        )

    return spread.groupBy("repo", "block").applyInPandas(fill, "repo string, rel string, size bigint, part int, parts int, part_size bigint, shard string")


def oversized(df: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(repo, rel) of the entries that the packing had to split."""
    return pack(df, capacity).where("parts > 1 and part = 0").select("repo", "rel")


def shard_fill(df: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(repo, shards, bytes, fill) per repository: the share of its shards' room that is used."""
    p = pack(df, capacity).where("shard is not null")
    return p.groupBy("repo").agg(F.count_distinct("shard").alias("shards"), F.sum("part_size").alias("bytes")).withColumn("fill", F.col("bytes") / (F.col("shards") * F.lit(capacity)))
