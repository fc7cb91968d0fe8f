"""Captions as text, JSON and sidecar files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.functions.tags import strip
from shardloom.sources.state import exists, write_atomic


def caption_line(tags: Column, sep: str = ", ", existing: Column | None = None, prepend: str = "") -> Column:
    """The text of a caption file; null without tags. Existing tags come first and keep their order, then the new ones
    that aren't among them; ``prepend`` and the separator stand before all."""
    if existing is not None:
        old = F.filter(F.transform(F.split(F.coalesce(existing, F.lit("")), sep.strip() or sep), strip), lambda t: t != "")
        tags_out = F.concat(old, F.filter(tags, lambda t: ~F.array_contains(old, t)))
    else:
        tags_out = tags
    text = F.array_join(tags_out, sep)
    return F.when(F.size(tags) > 0, F.concat(F.lit(prepend + sep if prepend else ""), text))


def sidecar_json(fields: Column, raw: Column, caption: Column, video: Column) -> Column:
    """JSON of a caption with the other fields of a map prefixed ``raw_``."""
    others = F.transform_keys(F.map_filter(fields, lambda k, v: ~k.isin("caption", "video")), lambda k, v: F.concat(F.lit("raw_"), k))
    return F.to_json(F.map_concat(F.create_map(F.lit("video"), video, F.lit("caption"), caption, F.lit("raw"), raw), others))


def plain_caption(caption: Column, prepend: str = "") -> Column:
    """The text of a caption file as the video pipeline writes it: what is put before stands right before; null for null."""
    return F.concat(F.lit(prepend), caption)


def similarity_json(combined: Column) -> Column:
    """JSON of a pair's similarity, with two decimals, ties to even."""
    return F.to_json(F.struct(F.bround(combined, 2).alias("combined")))


def write_sidecars(captions: DataFrame, ext: str = ".txt", overwrite: bool = True, end: str = "\n") -> DataFrame:
    """(stem, written): writes text (stem, text) beside its media, in the file system of its address, by a rename; null and
    empty texts are skipped, and files that exist if not ``overwrite``. A repeated task writes the same again."""

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            done = []
            for stem, text in zip(pdf["stem"], pdf["text"]):
                wanted = bool(text) and (overwrite or not exists(stem + ext))
                if wanted:
                    write_atomic(stem + ext, (text + end).encode("utf-8"))
                done.append(wanted)
            yield pd.DataFrame({"stem": pdf["stem"], "written": done})

    return captions.select("stem", "text").mapInPandas(write, "stem string, written boolean")


def write_captions_with_json(captions: DataFrame, overwrite: bool = False) -> DataFrame:
    """(stem, written): writes JSON and then text (stem, json, text) beside the media; where there is JSON already and not
    ``overwrite`` neither is written."""

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            done = []
            for stem, value, text in zip(pdf["stem"], pdf["json"], pdf["text"]):
                wanted = bool(text) and (overwrite or not exists(f"{stem}.json"))
                if wanted:
                    write_atomic(f"{stem}.json", value.encode("utf-8"))
                    write_atomic(f"{stem}.txt", (text + "\n").encode("utf-8"))
                done.append(wanted)
            yield pd.DataFrame({"stem": pdf["stem"], "written": done})

    return captions.select("stem", "json", "text").mapInPandas(write, "stem string, written boolean")


def write_jsonl(captions: DataFrame, folder: str) -> None:
    """Appends one JSON object per row."""
    captions.write.mode("append").option("ignoreNullFields", "false").json(folder)
