"""Encoding of the whole corpus with a public tokenizer through a table of its distinct words."""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.session import cut_lineage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how byte_bpe_50k splits a text into words before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The most frequent words, each of at most HOT_LENGTH characters, are encoded where they stand: at most
#: HOT_WORDS x (4 + 4) x HOT_LENGTH bytes go to each worker. The other words are joined by a shuffle, in which
#: none of them makes up more than a HOT_WORDS-th of all.
HOT_WORDS, HOT_LENGTH = 32_768, 32


def ranks(vocabulary: str = VOCABULARY) -> dict[bytes, int]:
    """Piece to id."""
    with open(vocabulary, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def words(text: str) -> list[str]:
    """The words of a text, which joined are the text."""
    return regex.findall(PATTERN, text)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            if text:
                seen.update(words(text))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])


def distinct_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): each distinct word and how often it stands in the corpus, summed within each batch and task first."""
    return docs.select(text).mapInArrow(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def word_ids(counts: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(word, n, ids): each distinct word encoded once. Every worker reads the vocabulary from its path."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        merges = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks(vocabulary), special_tokens={})
        for batch in batches:
            ids = [merges.encode_ordinary(w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))], ["word", "n", "ids"])

    return counts.mapInArrow(encode, "word string, n bigint, ids array<int>")


def encode_corpus(docs: DataFrame, vocabulary: str = VOCABULARY, doc_id: str = "doc_id", text: str = "text", hot_words: int = HOT_WORDS) -> DataFrame:
    """(doc_id, ids): the ids of each text without special tokens; an empty list for an empty and for a null text.
    The strings of special tokens are ordinary text. One row for each different pair of id and text.

    The texts are split into words, each distinct word is encoded once, and the ids are put back by position:
    those of hot words in the task that splits the text, the others by a join on the word."""
    docs = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("txt"))
    table = cut_lineage(word_ids(distinct_words(docs, "txt"), vocabulary))
    hot = {r["word"]: r["ids"] for r in table.where(F.length("word") <= HOT_LENGTH).orderBy(F.desc("n"), "word").limit(hot_words).collect()}
    known = docs.sparkSession.sparkContext.broadcast(hot)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = known.value
        for batch in batches:
            at: list[int] = []
            pos: list[int] = []
            cold: list[str | None] = []
            ids: list[list[int] | None] = []
            for i, t in enumerate(batch.column(1).to_pylist()):
                run: list[int] = []
                k = 0
                for w in words(t) if t else ():
                    if (x := ready.get(w)) is not None:
                        run += x
                        continue
                    for c, v in ((None, run), (w, None)) if run else ((w, None),):
                        at.append(i)
                        pos.append(k)
                        cold.append(c)
                        ids.append(v)
                        k += 1
                    run = []
                if run or not k:
                    at.append(i)
                    pos.append(k)
                    cold.append(None)
                    ids.append(run)
            rows = pa.array(at, pa.int32())
            out = [batch.column(0).take(rows), batch.column(2).take(rows), pa.array(pos, pa.int32()), pa.array(cold, pa.string()), pa.array(ids, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(out, ["doc", "key", "pos", "word", "ids"])

    kind = docs.schema["doc"].dataType.simpleString()
    keyed = docs.select("doc", "txt", F.xxhash64("txt").alias("key"))
    parts = keyed.mapInArrow(place, f"doc {kind}, key bigint, pos int, word string, ids array<int>")
    # The pieces take two ways, so they are kept rather than made twice.
    parts = cut_lineage(parts)
    rare = parts.where("word is not null").drop("ids").join(table.select("word", "ids"), "word").select("doc", "key", "pos", "ids")
    pieces = parts.where("word is null").select("doc", "key", "pos", "ids").unionByName(rare)
    whole = pieces.groupBy("doc", "key").agg(F.array_sort(F.collect_set(F.struct("pos", "ids"))).alias("p"))
    return whole.select(F.col("doc").alias(doc_id), F.flatten("p.ids").alias("ids"))


def decode_corpus(encoded: DataFrame, vocabulary: str = VOCABULARY, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text) from (doc_id, ids), through a join of each id with its piece. The table of pieces has as many
    rows as the vocabulary, whatever the corpus, and is broadcast. No ids give an empty text."""
    spark = encoded.sparkSession
    pieces = spark.createDataFrame([(i, bytearray(p)) for p, i in ranks(vocabulary).items()], "id int, piece binary")
    at = encoded.select(F.col(doc_id).alias("doc"), F.posexplode_outer("ids").alias("pos", "id"))
    joined = at.join(F.broadcast(pieces), "id", "left").groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("pos", F.hex("piece").alias("h")))).alias("p"))
    return joined.select(F.col("doc").alias(doc_id), F.decode(F.unhex(F.array_join(F.coalesce(F.col("p.h"), F.array()), "")), "utf-8").alias("text"))
