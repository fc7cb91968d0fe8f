"""Batch jobs of a captioning service: payloads, submission, watching, and the second pass over what failed.

The service is a client made once per task; ``StubClient`` stands in for one."""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.functions.requests import COMMA, ENVELOPE, FATAL, HALVED
from shardloom.functions.tags import strip
from shardloom.operators import shards

#: Bytes of a payload at most, and the least that a refused one is lowered to.
PAYLOAD, LEAST_PAYLOAD = 4 << 20, 2 << 20


class Client(Protocol):
    """A batch service. ``post`` returns a status code; ``status`` counts (total, pending, succeeded, failed)."""

    def create(self, name: str) -> str: ...

    def post(self, batch: str, payload: str) -> int: ...

    def status(self, batch: str) -> dict[str, int]: ...

    def cancel(self, batch: str) -> None: ...


class StubClient:
    """Takes payloads up to ``most`` bytes, and only at the ``failing`` + 1st try if its checksum is odd; counts as it is told."""

    def __init__(self, most: int = PAYLOAD, failing: int = 0, counts: list[dict[str, int]] | None = None):
        self.most, self.failing, self.counts = most, failing, list(counts or [])
        self.tries: dict[int, int] = {}
        self.taken: list[str] = []
        self.cancelled: list[str] = []

    def create(self, name: str) -> str:
        return f"batch_{zlib.crc32(name.encode()):08x}"

    def post(self, batch: str, payload: str) -> int:
        if len(payload.encode()) > self.most:
            return 413
        key = zlib.crc32(payload.encode())
        self.tries[key] = self.tries.get(key, 0) + 1
        if key & 1 and self.tries[key] <= self.failing:
            return 503
        self.taken.append(payload)
        return 200

    def status(self, batch: str) -> dict[str, int]:
        return self.counts.pop(0) if len(self.counts) > 1 else (self.counts or [{"total": 0, "pending": 0}])[0]

    def cancel(self, batch: str) -> None:
        self.cancelled.append(batch)


def payload(requests: list[str]) -> str:
    """The JSON that posts requests."""
    return '{"batch_requests":[' + ",".join(requests) + "]}"


def posted(client: Client, batch: str, texts: list[str], bare: list[str | None], most: int = PAYLOAD, least: int = LEAST_PAYLOAD, tries: int = 4, sleep: Callable[[float], None] = time.sleep) -> list[tuple[str, int, bool]]:
    """(state, status, stripped) of each request. A payload that the service refuses is halved, and halved before it is
    posted if it is above the size that 413 lowered the limit to, down to single requests; a single one that is too
    large is posted again without its images (``bare``), if it has any. Other failures are tried again after
    waits that double; those of FATAL stop everything that is not yet posted."""
    out: list[tuple[str, int, bool]] = [("failed_submit", 0, False)] * len(texts)
    limit, fatal = most, 0
    stack = [(0, len(texts), False)] if texts else []

    def post(body: str) -> int:
        for k in range(tries):
            code = client.post(batch, body)
            if code < 400 or code in HALVED or code in FATAL:
                return code
            if k + 1 < tries:
                sleep(min(2.0 * 2**k, 30.0))
        return code

    while stack:
        begin, end, stripped = stack.pop()
        body = payload([(bare[i] or texts[i]) if stripped else texts[i] for i in range(begin, end)])
        size = len(body.encode())
        code = fatal or (413 if size > limit and end - begin > 1 else post(body))
        if code in FATAL:
            fatal = code
        if code == 413 and size <= limit:
            limit = max(limit * 3 // 4, least)
        if code in HALVED and end - begin > 1:
            middle = (begin + end) // 2
            stack += [(middle, end, stripped), (begin, middle, stripped)]
        elif code == 413 and not stripped and bare[begin]:
            stack.append((begin, end, True))
        else:
            state = "submitted" if code < 400 else "failed_payload_too_large" if code == 413 else "failed_submit"
            out[begin:end] = [(state, code, stripped)] * (end - begin)
    return out


def submit(requests: DataFrame, make: Callable[[], Client], batch: str, most: int = PAYLOAD, tries: int = 4, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """(request_id, state, status, stripped) of requests (batch_id, request_id, request, bare): packed into payloads by
    their bytes in order of id, each posted by one task, so that a lost task posts its payload again: requests have ids
    by which the service knows them. ``bare`` is the request without images, null if it has none."""
    size = F.octet_length("request")
    packed = shards.pack(requests, "batch_id", "request_id", size, most, alone=False, overhead=ENVELOPE, comma=COMMA).select("batch_id", "request_id", "shard")
    rows = requests.select("batch_id", "request_id", "request", "bare").join(packed, ["batch_id", "request_id"])

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("request_id")
        bare = [x if isinstance(x, str) else None for x in pdf["bare"]]
        got = posted(make(), batch, pdf["request"].tolist(), bare, most, tries=tries, sleep=wait)
        return pd.DataFrame({"request_id": pdf["request_id"], "state": [g[0] for g in got], "status": [g[1] for g in got], "stripped": [g[2] for g in got]})

    return rows.groupBy("batch_id", "shard").applyInPandas(send, "request_id string, state string, status int, stripped boolean")


def watch(client: Client, batch: str, interval: float = 15.0, deadline: float = 21_600.0, tail: float = 120.0, zeros: int = 5, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> str:
    """Polls a batch until it is ``done`` (nothing pending), ``empty`` (no requests at ``zeros`` polls in a row), in its
    ``tail`` (99 % are through and nothing more came for ``tail`` seconds) or past its ``deadline``."""
    began = moved = clock()
    last, empty = -1, 0
    while True:
        counts = client.status(batch)
        total, pending = counts.get("total", 0), counts.get("pending", 0)
        now = clock()
        empty = 0 if total else empty + 1
        if empty >= zeros:
            return "empty"
        if total and not pending:
            return "done"
        if total - pending != last:
            last, moved = total - pending, now
        if total and (total - pending) * 100 >= 99 * total and now - moved >= tail:
            return "tail"
        if now - began >= deadline:
            return "deadline"
        sleep(interval)


def probe(client: Client, request: str, deadline: float = 60.0, interval: float = 5.0, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> str:
    """``batch`` if a batch of one request is through within ``deadline`` seconds, else ``sync``; its batch is cancelled then."""
    batch = client.create("probe")
    if client.post(batch, payload([request])) < 400 and watch(client, batch, interval, deadline, zeros=1 << 30, sleep=sleep, clock=clock) == "done":
        return "batch"
    client.cancel(batch)
    return "sync"


def second_pass(items: DataFrame, results: DataFrame, before: DataFrame, key: str, text: str) -> DataFrame:
    """(key) of the ``items`` that still need an answer: without a result, with a blank one, or with the text that stood
    there ``before``."""
    got = results.select(key, F.col(text).alias("__now")).groupBy(key).agg(F.max("__now").alias("__now"))
    old = before.select(key, F.col(text).alias("__old")).groupBy(key).agg(F.max("__old").alias("__old"))
    joined = items.select(key).distinct().join(got, key, "left").join(old, key, "left")
    blank = F.coalesce(strip(F.col("__now")), F.lit("")) == ""
    return joined.where(blank | F.col("__now").eqNullSafe(F.col("__old"))).select(key)


def poll_outcomes(polls: DataFrame, key: str, order: list[str], total: str, pending: str, zeros: int = 5) -> DataFrame:
    """(key, polls, outcome) of a log of polls: ``done`` if one has nothing pending of something, else ``empty`` if ``zeros``
    in a row had no requests, else ``open``."""
    from shardloom.operators.jobs import zero_streaks

    done = polls.groupBy(key).agg(F.count("*").alias("polls"), F.bool_or((F.col(total) > 0) & (F.col(pending) == 0)).alias("done"))
    runs = zero_streaks(polls, key, order, total)
    outcome = F.when(F.coalesce("done", F.lit(False)), "done").when(F.col("streak") >= zeros, "empty").otherwise("open")
    return done.join(runs, key).select(key, "polls", outcome.alias("outcome"))


def pages(fetch: Callable[[str | None], tuple[list[dict], str | None]]) -> Iterator[dict]:
    """The results of all pages: each call gives some and the token of the next page, null at the end; those without an
    id are left out."""
    token = None
    while True:
        found, token = fetch(token)
        yield from (r for r in found if r.get("id"))
        if not token:
            return
