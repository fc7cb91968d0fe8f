"""Evaluation texts leaking into training text: a prefix-filtered set join over word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.hotjoin import LOCAL, join_many
from shardloom.llm.textnorm import canonical_words
from shardloom.session import cut_lineage

SHINGLE = 5
#: Bits of the filter of the items' shingles that goes to every worker, whatever their number; full, it only filters less.
FILTER_BITS = 1 << 26


def shingles(ws: list[str]) -> list[int]:
    """A signed 64-bit hash of each SHINGLE consecutive words."""
    return [xxhash.xxh64_intdigest(" ".join(ws[i : i + SHINGLE])) - (1 << 63) for i in range(len(ws) - SHINGLE + 1)]


def item_windows(items: DataFrame, length: int, item_id: str, text: str) -> DataFrame:
    """(item, at, window, shingles): every ``length`` consecutive words of each item. A shorter item has none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, at, window, grams = [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                ws = canonical_words(t)
                hashes = shingles(ws)
                for k in range(len(ws) - length + 1):
                    item.append(i)
                    at.append(k)
                    window.append(" ".join(ws[k : k + length]))
                    grams.append(hashes[k : k + length - SHINGLE + 1])
            out = [batch.column(0).take(pa.array(item, pa.int32())), pa.array(at, pa.int32()), pa.array(window, pa.string()), pa.array(grams, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(out, ["item", "at", "window", "shingles"])

    kind = items.schema[item_id].dataType.simpleString()
    return items.select(item_id, text).mapInArrow(cut, f"item {kind}, at int, window string, shingles array<bigint>")


def _candidates(docs: DataFrame, windows: DataFrame, need: int) -> DataFrame:
    """(doc, key, words, at, chars, shingles) of the documents in which ``need`` consecutive shingles stand in windows: their
    words with a space between, and the places, in words and in characters, and hashes of such shingles. Windows are
    known by a bit filter of FILTER_BITS, which lets a few others pass."""
    word = F.expr(f"(s >> 1) & {FILTER_BITS - 1}")
    bits = windows.select(F.explode("shingles").alias("s")).groupBy(F.shiftright(word, 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast((s >> 1) & 63 as int))")).alias("b")).toArrow()
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[bits["w"].to_numpy()] = bits["b"].to_numpy()
    known = docs.sparkSession.sparkContext.broadcast(table)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = known.value
        for batch in batches:
            rows, texts, places, chars, hashes = [], [], [], [], []
            for i, t in enumerate(batch.column(2).to_pylist()):
                ws = canonical_words(t)
                if len(ws) < need + SHINGLE - 1:
                    continue
                grams = np.array(shingles(ws), np.int64)
                low = (grams >> 1) & (FILTER_BITS - 1)
                held = np.concatenate([[0], np.cumsum((flags[low >> 6] >> (low & 63)) & 1)])
                begin = np.flatnonzero(held[need:] - held[:-need] == need)
                if len(begin):
                    inside = np.zeros(len(grams) + 1, np.int64)
                    np.add.at(inside, begin, 1)
                    np.add.at(inside, begin + need, -1)
                    at = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
                    rows.append(i)
                    texts.append(" ".join(ws))
                    places.append(at.astype(np.int32))
                    chars.append(np.cumsum([0, *(len(w) + 1 for w in ws)], dtype=np.int32)[at])
                    hashes.append(grams[at])
            at = pa.array(rows, pa.int32())
            lists = [pa.array(x, pa.list_(kind)) for x, kind in ((places, pa.int32()), (chars, pa.int32()), (hashes, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(texts, pa.string()), *lists], ["doc", "key", "words", "at", "chars", "shingles"])

    kind = docs.schema["doc"].dataType.simpleString()
    keyed = docs.select("doc", F.xxhash64("doc", "txt").alias("key"), "txt")
    return keyed.mapInArrow(read, f"doc {kind}, key bigint, words string, at array<int>, chars array<int>, shingles array<bigint>")


def leaks(docs: DataFrame, items: DataFrame, length: int = 12, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", local: int = LOCAL) -> DataFrame:
    """(doc_id, item_id, windows): the documents that hold ``length`` consecutive words of an item or more, and how
    many of the item's windows each holds. Words are canonical_words. Null, empty and shorter texts leak nothing;
    of repeated rows one row comes out.

    Each different window of the items is a set of shingles of which a document must hold all, so its prefix is one
    shingle: the rarest of the window over the documents that hold so many in a row. Places of these shingles in
    documents are joined with prefixes; the window must lie within the document, and all of its words must stand
    there in order (compared by hash in place, then by text). Up to ``local`` windows are broadcast, more are joined by
    a salted shuffle."""
    need = length - SHINGLE + 1
    docs = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("txt"))
    parts = cut_lineage(item_windows(items, length, item_id, text).dropDuplicates(["item", "at", "window"]))
    windows = cut_lineage(parts.groupBy("window").agg(F.first("shingles").alias("shingles")))
    found = cut_lineage(_candidates(docs, windows, need).dropDuplicates(["doc", "key"]))
    counts = found.select(F.explode(F.array_distinct("shingles")).alias("shingle")).groupBy("shingle").agg(F.count("*").alias("docs"))
    places = windows.select("window", F.posexplode("shingles").alias("offset", "shingle"))
    # A window one of whose shingles no document holds can't stand in one: the inner join drops that shingle's rows, the count the window.
    rare = F.min(F.struct("docs", "shingle", "offset"))
    whole = places.join(counts, "shingle").groupBy("window").agg(rare.alias("r"), F.count("*").alias("held")).where(F.col("held") == need)
    known = [F.xxhash64("window").alias("hash"), F.length("window").alias("size")]
    prefixes = cut_lineage(whole.select(*known, F.col("r.offset").alias("offset"), F.col("r.shingle").alias("shingle")))
    held = found.select("doc", "key", "at", F.explode(F.arrays_zip("at", "shingles")).alias("p")).select("doc", "key", F.col("p.at").alias("pos"), F.col("p.shingles").alias("shingle"))
    met = join_many(held, prefixes, "shingle", "key", local)
    placed = met.select(F.col("doc").alias("of"), F.col("key").alias("in"), (F.col("pos") - F.col("offset")).alias("start"), "hash", "size").where("start >= 0")
    # Only places and hashes were shuffled. Where the window would start in the document, its words must stand.
    same = F.col("key").eqNullSafe(F.col("in")) & F.col("doc").eqNullSafe(F.col("of"))
    begin = F.element_at("chars", F.nullif(F.array_position("at", F.col("start")), F.lit(0)).cast("int"))
    words = found.select("doc", "key", "words", "at", "chars").join(placed, same).select("doc", "words", "hash", "size", begin.alias("begin"))
    here = words.select("doc", "hash", F.substring("words", F.col("begin") + 1, F.col("size")).alias("window"), F.substring("words", F.col("begin") + F.col("size") + 1, F.lit(1)).alias("next"))
    matched = here.where((F.xxhash64("window") == F.col("hash")) & F.col("next").isin("", " ")).select("doc", "window")
    pairs = join_many(matched, parts.select("item", "at", "window"), "window", "doc", local)
    return pairs.groupBy("doc", "item").agg(F.count_distinct("at").alias("windows")).select(F.col("doc").alias(doc_id), F.col("item").alias(item_id), "windows")


def leaked_items(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(item_id, documents, windows) of each item that leaks."""
    item_id = options.get("item_id", "item_id")
    return leaks(docs, items, **options).groupBy(item_id).agg(F.count("*").alias("documents"), F.max("windows").alias("windows"))
