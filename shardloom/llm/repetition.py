"""Repetition inside a single document: a hashed n-gram log-likelihood ratio, and the exact share behind it."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Each kanji or kana is a word by itself, else a run of letters and digits.
_WORD = re.compile("[぀-ヿ㐀-鿿々]|[^\\W_぀-ヿ㐀-鿿々]+")
N = 4
#: Events of an n-gram: 0 if its hash is new in the text, else 1 + the binary logarithm of how far back it stood.
EVENTS = 33
#: The trusted model is smoothed by so many events of the raw corpus.
PRIOR = 1.0


def words(text: str) -> list[str]:
    """The words of a text after lower-casing."""
    return _WORD.findall(text.lower())


def repeated_words(ws: list[str]) -> int:
    """How many words lie in an n-gram that also starts earlier in the text."""
    seen: set[tuple[str, ...]] = set()
    total, upto = 0, 0
    for i in range(len(ws) - N + 1):
        gram = tuple(ws[i : i + N])
        if gram in seen:
            total += i + N - max(i, upto)
            upto = i + N
        seen.add(gram)
    return total


def events(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, event) of every n-gram of many texts. Equal n-grams have equal hashes, so that a repeat is never taken
    for new; one in 2^64 of the others is taken for a repeat."""
    lengths = np.array([len(ws) for ws in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    if len(owner) < N:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    coded = pa.array([w for ws in texts for w in ws], pa.string()).dictionary_encode()
    of = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    h = of[coded.indices.to_numpy()]
    with np.errstate(over="ignore"):
        gram = np.zeros(len(h) - N + 1, np.uint64)
        for k in range(N):
            gram = (gram ^ (gram >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - N + 1 + k]
    inside = np.flatnonzero(owner[: len(gram)] == owner[N - 1 :])
    gram, owner = gram[inside], owner[inside]
    order = np.lexsort((inside, gram, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (gram[order][1:] == gram[order][:-1])
    back = np.zeros(len(order), np.int64)
    back[order[1:]] = np.where(same, np.diff(inside[order]), 0)
    return owner, np.where(back > 0, 1 + np.log2(np.maximum(back, 1)).astype(np.int64), 0)


def event_counts(docs: DataFrame, text: str) -> np.ndarray:
    """How often each event occurs in all texts, summed within each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(EVENTS, np.int64)
        for batch in batches:
            n += np.bincount(events([words(t) for t in batch.column(0).to_pylist() if t])[1], minlength=EVENTS)
        yield pa.RecordBatch.from_arrays([pa.array(range(EVENTS), pa.int32()), pa.array(n)], ["event", "n"])

    out = np.zeros(EVENTS)
    for r in docs.select(text).mapInArrow(count, "event int, n bigint").groupBy("event").agg(F.sum("n").alias("n")).collect():
        out[r["event"]] = r["n"]
    return out


def ratios(raw: np.ndarray, trusted: np.ndarray, least_repeats: float) -> tuple[np.ndarray, float]:
    """log P(event | raw corpus) - log P(event | trusted), and the least mean of it that a text can have of whose n-grams
    ``least_repeats`` repeat: so many of its events are repeats at least, of which none is below the least one that
    occurs, and the others are new. PRIOR events of the raw corpus stand beside the trusted ones, so that an event
    not met there has the same ratio however rare it is."""
    p = raw / max(raw.sum(), 1)
    q = (trusted + PRIOR * p) / (trusted.sum() + PRIOR)
    value = np.log(np.where(raw > 0, p, 1)) - np.log(np.where(raw > 0, q, 1))
    held = value[1:][raw[1:] > 0]
    least = held.min() if len(held) else 0.0
    return value, min(least_repeats * least + (1 - least_repeats) * value[0], least) - 1e-9


def repetition(docs: DataFrame, trusted: DataFrame, doc_id: str = "caption_id", text: str = "caption", trusted_text: str = "text", least_share: float = 0.4, every: bool = True) -> DataFrame:
    """(doc_id, words, repeated, share, ratio, suspect) of every text. ``ratio`` is the mean log-likelihood ratio of the
    events of its hashed n-grams between the raw corpus (all of ``docs``) and ``trusted``, texts that are written well
    and not taken from it; ``suspect`` whether it reaches the threshold. ``repeated`` counts the repeated words exactly,
    if not ``every`` then of suspects only, and is null for the others.

    The threshold is the least ratio that a text with ``least_share`` of repeated words can have: at least a
    share / N of its n-grams are repeats then, so no such text is missed, whatever the trusted texts are (without
    any, all are suspect). Null and empty texts, and those of less than N words, have ratio 0, nothing repeated,
    and are not suspect."""
    value, bound = ratios(event_counts(docs, text), event_counts(trusted, trusted_text), least_share / N)
    known = docs.sparkSession.sparkContext.broadcast(value)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = known.value
        for batch in batches:
            texts = [words(t) if t else [] for t in batch.column(1).to_pylist()]
            owner, event = events(texts)
            grams = np.bincount(owner, minlength=len(texts))
            ratio = np.bincount(owner, value[event], len(texts)) / np.maximum(grams, 1)
            suspect = (grams > 0) & (ratio >= bound)
            repeated = [repeated_words(ws) if s or every else None for ws, s in zip(texts, suspect)]
            out = [batch.column(0), pa.array([len(ws) for ws in texts], pa.int32()), pa.array(repeated, pa.int32()), pa.array(ratio), pa.array(suspect)]
            yield pa.RecordBatch.from_arrays(out, ["id", "words", "repeated", "ratio", "suspect"])

    kind = docs.schema[doc_id].dataType.simpleString()
    scored = docs.select(doc_id, text).mapInArrow(score, f"id {kind}, words int, repeated int, ratio double, suspect boolean")
    share = F.when(F.col("repeated").isNotNull(), F.coalesce(F.try_divide("repeated", "words"), F.lit(0.0)))
    return scored.select(F.col("id").alias(doc_id), "words", "repeated", share.alias("share"), "ratio", "suspect")


def repetitive(docs: DataFrame, trusted: DataFrame, doc_id: str = "caption_id", text: str = "caption", percent: int = 40, least_words: int = 12) -> DataFrame:
    """(doc_id) of the suspects with at least ``least_words`` words, ``percent`` % or more of them repeated. Only suspects
    are counted word by word."""
    r = repetition(docs, trusted, doc_id, text, least_share=percent / 100, every=False)
    return r.where(F.col("suspect") & (F.col("words") >= least_words) & (F.col("repeated") * 100 >= F.col("words") * percent)).select(doc_id)
