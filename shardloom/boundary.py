"""Where models, codecs and remote services plug in, with deterministic stand-ins."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: From a list of inputs to one score vector (or None) each. Made once per worker task.
Tagger = Callable[[list[str]], list[np.ndarray | None]]

_TAGGERS: dict[str, Callable[[], Tagger]] = {}


def register_tagger(name: str, make: Callable[[], Tagger]) -> None:
    """Makes ``make()`` available as a tagger; a name can be registered again."""
    _TAGGERS[name] = make


def stub_tagger(size: int = 64) -> Callable[[], Tagger]:
    """Scores drawn from a checksum of the input; an empty input is unreadable."""

    def make() -> Tagger:
        def run(inputs: list[str]) -> list[np.ndarray | None]:
            return [np.random.default_rng(zlib.crc32(x.encode())).random(size, np.float32) if x else None for x in inputs]

        return run

    return make


register_tagger("stub", stub_tagger())


def score(items: DataFrame, key: str, tagger: str = "stub", batch: int = 32) -> DataFrame:
    """(key, scores) of the items that the tagger can read. Items already done are best left out before: no filter
    is pushed below a model."""
    make = _TAGGERS[tagger]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in parts:
            keys = pdf[key].tolist()
            got = [v for i in range(0, len(keys), batch) for v in model(["" if k is None else k for k in keys[i : i + batch]])]
            kept = [(k, v.tolist()) for k, v in zip(keys, got) if v is not None]
            yield pd.DataFrame(kept, columns=[key, "scores"])

    return items.select(key).mapInPandas(run, f"{key} string, scores array<float>")


def answer(requests: DataFrame, client: Callable[[str], str | None]) -> DataFrame:
    """(request_id, raw) of (request_id, prompt): what ``client`` answers; null for a refusal."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame({"request_id": pdf["request_id"], "raw": [client(p) if p is not None else None for p in pdf["prompt"]]})

    return requests.select("request_id", "prompt").mapInPandas(run, "request_id string, raw string")
