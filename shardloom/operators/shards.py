"""Size-bounded shards in path order by next-fit, their keys, manifests and archives."""

from __future__ import annotations

import io
import posixpath
import tarfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.operators.ordered import rank, with_group
from shardloom.session import cut_lineage
from shardloom.sources.state import exists, write_atomic

#: A group of more entries is cut into ranges of its order, each of which is one task's work; the shards run on over them.
LARGE = 500_000
#: Before a group's first entry: number of the open shard, its bytes and entries, whether a large entry closed it.
FIRST = (-1, 0, 0, True)


def next_fit(sizes: np.ndarray, capacity: int, most: int = 0, alone: bool = True, overhead: int = 0, comma: int = 0, state: tuple = FIRST) -> np.ndarray:
    """Shard number of each entry in order. An entry that would overflow the open shard, or find ``most`` entries in it,
    opens the next. ``alone``: an entry above capacity closes the open shard and stands by itself; else it may join a
    shard that has no bytes yet. A shard starts with ``overhead`` bytes; an entry beside others needs ``comma`` more.
    ``state``: what the entries before these left."""
    out = np.empty(len(sizes), np.int64)
    shard, used, count, closed = state
    for i, size in enumerate(sizes.tolist()):
        if alone and size > capacity:
            shard += 1 if count or closed else 0
            out[i] = shard
            used, count, closed = 0, 0, True
            continue
        # Where large entries aren't alone, a shard is full only if it has bytes.
        full = (count if alone or overhead else used > 0) and overhead + used + size + (comma if count else 0) > capacity
        if closed or full or (most and count >= most):
            shard += 1
            used, count, closed = 0, 0, False
        out[i] = shard
        used += size
        count += 1
    return out


def following(sizes: np.ndarray, capacity: int, most: int = 0, alone: bool = True, overhead: int = 0, comma: int = 0) -> np.ndarray:
    """Of each entry, if it opens a shard, which one opens the next; their number if none does. Sizes are not negative."""
    n, at = len(sizes), np.arange(len(sizes))
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    after = np.searchsorted(sums, sums[:-1] + (capacity - overhead - comma), "right") - 1
    if not alone and not overhead:
        after = np.maximum(after, np.searchsorted(sums, sums[:-1], "right"))
    if most:
        after = np.minimum(after, at + most)
    if alone:
        large = np.flatnonzero(sizes > capacity)
        after = np.minimum(after, np.append(large, n)[np.searchsorted(large, at, "right")])
        after[large] = 0
    return np.minimum(np.maximum(after, at + 1), n)


def summary(sizes: np.ndarray, capacity: int, **rule) -> dict:
    """What a range of entries makes of any state before it: its entries and bytes, the sizes up to the last entry that
    can be the first to open a shard, and for each of these, if it is, the shards opened and the state at the end."""
    n, alone = len(sizes), rule.get("alone", True)
    after = following(sizes, capacity, **rule)
    # The state with the most room is that after an entry without bytes.
    heads = min(int(following(np.append(0, sizes), capacity, **rule)[0]), n)
    opened, last = np.ones(n, np.int64), np.arange(n)
    for k in range(n - 1, -1, -1):
        if (j := after[k]) < n:
            opened[k], last[k] = opened[j] + 1, last[j]
    last = last[:heads]
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    closed = (sizes[last] > capacity) & alone
    used, count = np.where(closed, 0, sums[n] - sums[last]), np.where(closed, 0, n - last)
    return {"n": n, "total": int(sums[n]), "sizes": sizes[:heads], "opened": opened[:heads], "used": used, "count": count, "closed": closed}


def run_on(state: tuple, s: dict, capacity: int, **rule) -> tuple:
    """The state after a range, from that before it and the range's summary."""
    shard, used, count, _ = state
    opens = np.flatnonzero(next_fit(np.asarray(s["sizes"]), capacity, state=state, **rule) > shard)
    if not len(opens):
        return shard, used + int(s["total"]), count + int(s["n"]), False
    k = opens[0]
    return shard + int(s["opened"][k]), int(s["used"][k]), int(s["count"][k]), bool(s["closed"][k])


def pack(df: DataFrame, group: str, order: str, size: Column, capacity: int, large: int = LARGE, **rule) -> DataFrame:
    """(group, order, bytes, range, shard, seq): each entry's shard within its group and its place there, in code-point
    order, null last; of equal ones the smaller first. Null sizes count as 0, negative ones too. ``rule``: see next_fit.

    A group of more than ``large`` entries is cut into ranges. Each is summed up by what it makes of any state before it,
    the summaries are gone through in order, and each range is packed from the state that the ranges before it left; so
    the shards are those of one pass over the whole group."""
    rows = df.select(F.col(group).alias("g"), F.col(order).alias("o"), F.greatest(size, F.lit(0)).cast("bigint").alias("bytes"))
    marked = with_group(rows, rows.groupBy("g").agg(F.count("*").alias("n")), "g").select("g", "o", "bytes", (F.col("n") > large).alias("big"))
    before = [F.lit(x).cast(kind).alias(c) for x, c, kind in zip(FIRST, ("at", "used", "count", "closed"), ("bigint", "bigint", "bigint", "boolean"))]
    split = marked.where(~F.col("big")).select("g", "o", "bytes", F.lit(0).alias("range"), *before)
    ranges = max(1, -(-(marked.where("big").count()) // large))
    g_type, o_type = (rows.schema[c].dataType.simpleString() for c in ("g", "o"))

    def ordered(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.sort_values("bytes", kind="stable").sort_values("o", key=lambda s: s.str.encode("utf-8") if s.dtype == object else s, kind="stable")

    def sum_up(pdf: pd.DataFrame) -> pd.DataFrame:
        found = summary(ordered(pdf)["bytes"].to_numpy(), capacity, **rule)
        return pd.DataFrame([{"g": pdf["g"].iloc[0], "range": pdf["range"].iloc[0]} | found])

    def go_through(pdf: pd.DataFrame) -> pd.DataFrame:
        state, out = FIRST, []
        for s in pdf.sort_values("range").to_dict("records"):
            out.append((s["g"], s["range"], *state))
            state = run_on(state, s, capacity, **rule)
        return pd.DataFrame(out, columns=["of", "part", "at", "used", "count", "closed"])

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = ordered(pdf)
        state = tuple(pdf[c].iloc[0].item() for c in ("at", "used", "count", "closed"))
        shard = next_fit(pdf["bytes"].to_numpy(), capacity, state=state, **rule)
        seq = pd.Series(shard).groupby(shard).cumcount().to_numpy() + np.where(shard == state[0], state[2], 0)
        return pd.DataFrame({"g": pdf["g"], "o": pdf["o"], "bytes": pdf["bytes"], "range": pdf["range"], "shard": shard.astype("int32"), "seq": seq.astype("int32")})

    # Only groups above LARGE are cut, by boundaries that Spark samples; written once, so that they stay where they are.
    if ranges > 1:
        cut = marked.where("big").repartitionByRange(ranges * 2, F.col("g"), F.col("o").asc_nulls_last()).select("g", "o", "bytes", F.spark_partition_id().alias("range"))
        cut = cut_lineage(cut)
        sums = cut.groupBy("g", "range").applyInPandas(sum_up, f"g {g_type}, range int, n bigint, total bigint, sizes array<bigint>, opened array<bigint>, used array<bigint>, count array<bigint>, closed array<boolean>")
        states = sums.groupBy("g").applyInPandas(go_through, f"of {g_type}, part int, at bigint, used bigint, count bigint, closed boolean")
        begun = cut.join(F.broadcast(states), F.col("g").eqNullSafe(F.col("of")) & (F.col("range") == F.col("part")))
        split = split.unionByName(begun.drop("of", "part"))
    out = split.groupBy("g", "range").applyInPandas(fill, f"g {g_type}, o {o_type}, bytes bigint, range int, shard int, seq int")
    return out.withColumnsRenamed({"g": group, "o": order})


def next_chunk(paths: DataFrame, path: str, prefix: str) -> DataFrame:
    """(next_chunk): one more than the highest number of ``<prefix><number>.zip``; 0 without any. Gaps don't matter."""
    n = F.regexp_extract(path, rf"^{prefix}(\d+)\.zip$", 1).try_cast("int")
    return paths.agg((F.coalesce(F.max(n), F.lit(-1)) + 1).alias("next_chunk"))


def sample_keys(rank: Column) -> Column:
    """Six digits at least, never cut."""
    return F.format_string("%06d", rank)


def sample_numbers(df: DataFrame, order: list[str], name: str = "key") -> DataFrame:
    """``df`` with each row's key: its place in order over the whole table, from 0, with six digits at least."""
    return rank(df, [], order, "__n").withColumn(name, sample_keys(F.col("__n") - 1)).drop("__n")


def chunks(df: DataFrame, groups: list[str], order: list[str], size: int) -> DataFrame:
    """``df`` with ``chunk``: every ``size`` rows of a group in order, from 0."""
    return rank(df, groups, order, "__n").withColumn("chunk", F.floor((F.col("__n") - 1) / size).cast("int")).drop("__n")


def tree(member: str) -> str | None:
    """A member's place within the folder it is extracted to; null if it would leave it, or is none."""
    at = posixpath.normpath(member.replace("\\", "/"))
    return None if at.startswith(("/", "..")) or at == "." or at[1:2] == ":" else at


def write_archives(manifest: DataFrame, folder: str, kind: str = "tar") -> DataFrame:
    """(shard, path, members, bytes): writes a tar or a stored zip of each shard of (shard, seq, name, content) into
    ``folder``, an address in a file system that all executors share. Members are in order of seq; a file is written
    beside its name and renamed, so that a repeated task leaves one. A shard's size is bounded by its packing; it is made
    in the memory of one task."""

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq")
        shard = str(pdf["shard"].iloc[0])
        made = io.BytesIO()
        if kind == "tar":
            with tarfile.open(fileobj=made, mode="w") as out:
                for name, content in zip(pdf["name"], pdf["content"]):
                    info = tarfile.TarInfo(name)
                    info.size = len(content)
                    out.addfile(info, io.BytesIO(content))
        else:
            with zipfile.ZipFile(made, "w", zipfile.ZIP_STORED) as out:
                for name, content in zip(pdf["name"], pdf["content"]):
                    out.writestr(zipfile.ZipInfo(name), content)
        final = f"{folder.rstrip('/')}/{shard}.{kind}"
        write_atomic(final, made.getvalue())
        return pd.DataFrame({"shard": [shard], "path": [final], "members": [len(pdf)], "bytes": [len(made.getvalue())]})

    return manifest.select(F.col("shard").cast("string").alias("shard"), "seq", "name", "content").groupBy("shard").applyInPandas(write, "shard string, path string, members bigint, bytes bigint")


def dataset_info(archives: DataFrame, split: str) -> DataFrame:
    """(info): JSON of a split's shards and samples."""
    return archives.agg(F.to_json(F.struct(F.lit(split).alias("split"), F.count("*").alias("shards"), F.coalesce(F.sum("members"), F.lit(0)).alias("samples"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))).alias("info"))


def _members(content: bytes | None) -> list[zipfile.ZipInfo] | None:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            return z.infolist()
    except (zipfile.BadZipFile, TypeError):
        return None


def unzipped(archives: DataFrame) -> DataFrame:
    """(path, member, size, safe) of the members of zip archives (path, content): unsafe are those that would leave their
    folder. A broken archive has no members."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(path, m.filename, m.file_size, tree(m.filename) is not None) for path, content in zip(pdf["path"], pdf["content"]) for m in _members(content) or ()]
            yield pd.DataFrame(rows, columns=["path", "member", "size", "safe"])

    return archives.select("path", "content").mapInPandas(read, "path string, member string, size bigint, safe boolean")


def extract(archives: DataFrame, folder: str) -> DataFrame:
    """(path, outcome, files): extracts zip archives (path, content) into ``folder``/<name without extension>: ``extracted``;
    ``skipped`` where the marker ``<path>.extracted.ok`` stands already; ``failed`` for a broken archive or one with a
    member that would leave the folder, of which nothing is written. The marker comes last, so that a lost task
    extracts again what it had not finished."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                marker = f"{path}.extracted.ok"
                if exists(marker):
                    rows.append((path, "skipped", 0))
                    continue
                members = _members(content)
                if members is None or any(tree(m.filename) is None for m in members if not m.is_dir()):
                    rows.append((path, "failed", 0))
                    continue
                root = f"{folder.rstrip('/')}/{posixpath.splitext(posixpath.basename(path))[0]}"
                files = [m for m in members if not m.is_dir()]
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for m in files:
                        write_atomic(f"{root}/{tree(m.filename)}", z.read(m))
                write_atomic(marker, b"")
                rows.append((path, "extracted", len(files)))
            yield pd.DataFrame(rows, columns=["path", "outcome", "files"])

    return archives.select("path", "content").mapInPandas(run, "path string, outcome string, files int")
