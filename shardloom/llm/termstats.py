"""Frequency of every distinct tag, by a vertical layout of compressed record bitmaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shardloom.functions.tags import canonical_tag
from shardloom.session import cut_lineage

#: Records of a container, whose places take two bytes each; from DENSE places on a bit for every record takes less.
RECORDS, DENSE = 1 << 16, 1 << 12
#: So many of the most frequent spellings, of at most HOT_LENGTH characters each, are broadcast and shuffled as numbers; the
#: tags of the others travel as they are.
HOT_SPELLINGS, HOT_LENGTH = 65_536, 64


def container(places: np.ndarray) -> bytes:
    """The compressed bitmap of ascending places below RECORDS: the places themselves, or a bit for every record."""
    if len(places) < DENSE:
        return places.astype("<u2").tobytes()
    bits = np.zeros(RECORDS, bool)
    bits[places] = True
    return np.packbits(bits, bitorder="little").tobytes()


def places(held: bytes) -> np.ndarray:
    """The places in a container."""
    if len(held) < RECORDS // 8:
        return np.frombuffer(held, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(held, np.uint8), bitorder="little"))


def _containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of records (ids, others) the containers of every number and other tag, and of their union, for each RECORDS records."""
    names = ["id", "tag", "chunk", "items", "bits"]
    task = TaskContext.get()
    chunk = (task.partitionId() if task else 0) << 32

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        union = np.zeros(RECORDS, bool)
        for kind in ("ids", "others"):
            lists = table.column(kind).combine_chunks()
            values = lists.flatten().dictionary_encode()
            at = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
            code = values.indices.to_numpy()
            union[at] = True
            order = np.argsort(code, kind="stable")
            cuts = np.flatnonzero(np.diff(code[order])) + 1
            parts = np.split(at[order], cuts) if len(order) else []
            own = values.dictionary.take(pa.array(code[order][np.concatenate([[0], cuts])] if len(order) else [], pa.int32()))
            none = pa.nulls(len(own), pa.string() if kind == "ids" else pa.int32())
            yield pa.RecordBatch.from_arrays([*((own, none) if kind == "ids" else (none, own)), pa.array([chunk] * len(own), pa.int64()), pa.array([len(p) for p in parts], pa.int32()), pa.array([container(p) for p in parts], pa.binary())], names)
        whole = np.flatnonzero(union)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int32()), pa.nulls(1, pa.string()), pa.array([chunk], pa.int64()), pa.array([len(whole)], pa.int32()), pa.array([container(whole)], pa.binary())], names)

    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, RECORDS - n)
            batch = batch.slice(part.num_rows)
            held.append(part)
            n += part.num_rows
            if n == RECORDS:
                yield from flush(held)
                held, n, chunk = [], 0, chunk + 1
    if held:
        yield from flush(held)


def spellings(df: DataFrame, tags: str = "tags") -> DataFrame:
    """(raw, tag, n): every spelling that is no blank, its tag, and how often it is used."""
    raws = df.select(F.explode(tags).alias("raw")).groupBy("raw").agg(F.count("*").alias("n"))
    return raws.withColumn("tag", canonical_tag(F.col("raw"))).where("tag is not null")


def bitmaps(df: DataFrame, spelled: DataFrame, hot: int = HOT_SPELLINGS, keys: tuple[str, ...] = ("repo", "item"), tags: str = "tags") -> DataFrame:
    """(tag, chunk, items, bits): for each tag and each chunk of at most RECORDS records in which it occurs the container of
    its records, and their number; the union of all tags' containers under a null tag. A record is a key with a tag;
    chunks have no record in common, so that a tag's bitmap is the union of its containers. An item's rows are
    merged before, in each task first, so that an item of a third of all rows is a set of tags for each task."""
    most = spelled.where(F.length("raw") <= HOT_LENGTH).orderBy(F.desc("n"), "raw").limit(hot)
    # At most HOT_SPELLINGS rows are ranked together.
    known = cut_lineage(most.select("raw", "tag", (F.dense_rank().over(Window.orderBy("tag")) - 1).alias("id")))
    own = known.select(F.col("tag").alias("of"), F.col("id").alias("tag_id")).distinct()
    used = df.select(*keys, F.explode(tags).alias("raw")).where("raw is not null").join(F.broadcast(known.select("raw", "id")), "raw", "left")
    used = used.withColumn("tag", F.when(F.col("id").isNull(), canonical_tag(F.col("raw")))).where("id is not null or tag is not null")
    used = used.join(F.broadcast(own), F.col("tag") == F.col("of"), "left").withColumn("id", F.coalesce("id", "tag_id"))
    other = F.when(F.col("id").isNull(), F.col("tag"))
    records = used.groupBy(*keys).agg(F.collect_set("id").alias("ids"), F.collect_set(other).alias("others")).select("ids", "others")
    made = cut_lineage(records.mapInArrow(_containers, "id int, tag string, chunk bigint, items int, bits binary"))
    named = made.join(F.broadcast(own.select("of", F.col("tag_id").alias("id"))), "id", "left")
    return named.select(F.coalesce("tag", "of").alias("tag"), "chunk", "items", "bits")


def term_counts(df: DataFrame, rare: int = 3, common: tuple[int, int] = (3, 10), hot: int = HOT_SPELLINGS, keys: tuple[str, ...] = ("repo", "item"), tags: str = "tags") -> DataFrame:
    """(tag, uses, items, n, mark) of each tag. ``items`` is the cardinality of the tag's bitmap, ``n`` that of
    the union of all bitmaps (the records with a tag); mark is ``rare`` below ``rare`` items, else ``common`` above
    common[0] / common[1] of n, else null. Null and blank tags don't count; no row for empty input."""
    spelled = cut_lineage(spellings(df, tags))
    maps = bitmaps(df, spelled, hot, keys, tags).groupBy("tag").agg(F.sum("items").alias("items"))
    maps = cut_lineage(maps)
    n = maps.where("tag is null").agg(F.coalesce(F.sum("items"), F.lit(0))).first()[0]
    uses = spelled.groupBy("tag").agg(F.sum("n").alias("uses"))
    few, (over, of) = F.col("items") < rare, common
    mark = F.when(few, "rare").when(F.col("items") * of > over * F.lit(n).cast("bigint"), "common")
    return maps.join(uses, "tag").select("tag", "uses", "items", F.lit(n).cast("bigint").alias("n"), mark.alias("mark"))
