"""Where video and image codecs plug in: what they are asked, what is derived from their answers, and stand-ins."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.functions.media import parse_fps

RAW_INFO = "struct<r_frame_rate: string, avg_frame_rate: string, nb_frames: string, duration: string, channels: int>"


class Codec(Protocol):
    """``probe`` gives the strings that a probing tool prints, null for an unreadable file; ``frame`` the encoded picture
    of a number, null if there is none; ``apply`` runs an action, and says whether it went well and what it printed."""

    def probe(self, path: str) -> dict | None: ...

    def frame(self, path: str, number: int) -> bytes | None: ...

    def apply(self, path: str, action: str) -> tuple[bool, str]: ...


class StubCodec:
    """Answers drawn from a checksum of the path: a sixteenth of all files are unreadable, an eighth of all actions fail."""

    def probe(self, path: str) -> dict | None:
        k = zlib.crc32(path.encode())
        if k % 16 == 0:
            return None
        rates = ("24/1", "25/1", "30000/1001", "0/0")
        return {"r_frame_rate": rates[k % 4], "avg_frame_rate": rates[k // 4 % 4], "nb_frames": str(k % 400) if k % 3 else "N/A", "duration": f"{k % 97}.5", "channels": (None, 1, 2)[k % 3]}

    def frame(self, path: str, number: int) -> bytes | None:
        info = self.probe(path)
        return None if info is None or number >= 300 else f"{path}#{number}".encode()

    def apply(self, path: str, action: str) -> tuple[bool, str]:
        failed = zlib.crc32(f"{action} {path}".encode()) % 8 == 0
        return not failed, f"frame=1\n{action}: {'no such stream' if failed else 'done'}\nsize=9"


_CODECS: dict[str, Callable[[], Codec]] = {"stub": StubCodec}


def register_codec(name: str, make: Callable[[], Codec]) -> None:
    """Makes ``make()`` available as a codec; a name can be registered again."""
    _CODECS[name] = make


def probed(files: DataFrame, path: str = "path", codec: str = "stub") -> DataFrame:
    """(path, raw): what the codec says of each file; null for an unreadable one."""
    make = _CODECS[codec]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = make()
        for pdf in parts:
            raws = [tool.probe(p) if p is not None else None for p in pdf[path]]
            names = ("r_frame_rate", "avg_frame_rate", "nb_frames", "duration", "channels")
            table = {n: [r.get(n) if r else None for r in raws] for n in names}
            yield pd.DataFrame({"path": pdf[path], "ok": [r is not None for r in raws]} | table).astype({"channels": "Int32"})

    out = files.select(path).mapInPandas(run, "path string, ok boolean, r_frame_rate string, avg_frame_rate string, nb_frames string, duration string, channels int")
    return out.select("path", F.when(F.col("ok"), F.struct("r_frame_rate", "avg_frame_rate", "nb_frames", "duration", "channels")).alias("raw"))


def video_info(raw: Column) -> Column:
    """struct(fps, frames, channels) of what a probe printed: its own rate, else the average one; its count of frames, else
    duration x rate in whole frames, else 0. Null for an unreadable file."""
    own, average = parse_fps(raw["r_frame_rate"]), parse_fps(raw["avg_frame_rate"])
    fps = F.when(own > 0, own).otherwise(average)
    counted = raw["nb_frames"].try_cast("bigint")
    timed = (raw["duration"].try_cast("double") * fps).cast("bigint")
    frames = F.when(counted > 0, counted).otherwise(F.coalesce(F.when(timed > 0, timed), F.lit(0)))
    return F.when(raw.isNotNull(), F.struct(fps.alias("fps"), frames.alias("frames"), raw["channels"].alias("channels")))


def middle_frame(total: Column) -> Column:
    """The number of the middle frame; 0 if the count isn't known."""
    return F.when(total > 0, F.floor(total / 2)).otherwise(F.lit(0)).cast("bigint")


def extracted(wanted: DataFrame, codec: str = "stub") -> DataFrame:
    """(path, frame, taken, content) of wanted frames (path, frame): the first frame where the codec can't give the wanted
    one; taken and content are null if it gives neither."""
    make = _CODECS[codec]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = make()
        for pdf in parts:
            taken, content = [], []
            for path, number in zip(pdf["path"], pdf["frame"]):
                tried = ((n, tool.frame(path, n)) for n in dict.fromkeys((int(number), 0)))
                n, got = next(((n, x) for n, x in tried if x is not None), (None, None))
                taken.append(n)
                content.append(got)
            yield pd.DataFrame({"path": pdf["path"], "frame": pdf["frame"], "taken": pd.array(taken, "Int64"), "content": content})

    return wanted.select("path", F.col("frame").cast("bigint").alias("frame")).where("path is not null and frame is not null").mapInPandas(run, "path string, frame bigint, taken bigint, content binary")


def applied(planned: DataFrame, stages: list[str], codec: str = "stub") -> DataFrame:
    """(path, stage, ok, detail) of each action that was run, of (path, one boolean per stage whether it is needed): stages
    in their order, a file whose action failed leaves the later ones. Stages that aren't needed have no row."""
    make = _CODECS[codec]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = make()
        for pdf in parts:
            rows = []
            for r in pdf.to_dict("records"):
                for stage in stages:
                    if r[stage]:
                        ok, detail = tool.apply(r["path"], stage)
                        rows.append((r["path"], stage, ok, detail))
                        if not ok:
                            break
            yield pd.DataFrame(rows, columns=["path", "stage", "ok", "detail"])

    return planned.select("path", *stages).mapInPandas(run, "path string, stage string, ok boolean, detail string")


# Pictures are arrays of height x width x channels with values from 0 to 255.


def over_white(picture: np.ndarray) -> np.ndarray:
    """Three channels: transparent parts show white, grey becomes three equal channels."""
    if picture.ndim == 2:
        picture = np.repeat(picture[..., None], 3, 2)
    if picture.shape[2] == 4:
        alpha = picture[..., 3:].astype(np.float32) / 255
        picture = np.rint(picture[..., :3] * alpha + 255 * (1 - alpha)).astype(np.uint8)
    return picture[..., :3]


def resized(picture: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, pixel centres aligned."""
    h, w = picture.shape[:2]

    def axis(n: int, to: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.clip((np.arange(to) + 0.5) * n / to - 0.5, 0, n - 1)
        low = np.floor(at).astype(int)
        return low, np.minimum(low + 1, n - 1), (at - low).astype(np.float32)

    y0, y1, fy = axis(h, height)
    x0, x1, fx = axis(w, width)
    p = picture.astype(np.float32)
    rows = p[y0] * (1 - fy)[:, None, None] + p[y1] * fy[:, None, None]
    return rows[:, x0] * (1 - fx)[None, :, None] + rows[:, x1] * fx[None, :, None]


def padded_square(picture: np.ndarray, size: int = 448) -> np.ndarray:
    """For taggers that read BGR: over white, in the middle of a white square, resized, channels reversed."""
    p = over_white(picture)
    side = max(p.shape[:2])
    square = np.full((side, side, 3), 255, np.uint8)
    y, x = (side - p.shape[0]) // 2, (side - p.shape[1]) // 2
    square[y : y + p.shape[0], x : x + p.shape[1]] = p
    return resized(square, size, size)[..., ::-1].astype(np.float32)


def fitted(picture: np.ndarray, size: int = 512) -> np.ndarray:
    """For taggers trained on ImageNet: fitted into a square of their mean colour, normalised, channels first."""
    # Colour of the border, mean and deviation of each channel.
    border, mean, deviation = (124, 116, 104), (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)
    p = over_white(picture)
    scale = size / max(p.shape[:2])
    h, w = (max(1, round(n * scale)) for n in p.shape[:2])
    square = np.tile(np.array(border, np.float32), (size, size, 1))
    y, x = (size - h) // 2, (size - w) // 2
    square[y : y + h, x : x + w] = resized(p, h, w)
    return ((square / 255 - np.array(mean)) / np.array(deviation)).transpose(2, 0, 1).astype(np.float32)


def centred(picture: np.ndarray, size: int = 448) -> np.ndarray:
    """For taggers that read values from -1 to 1: over white, resized, channels first."""
    return ((resized(over_white(picture), size, size) / 255 - 0.5) / 0.5).transpose(2, 0, 1).astype(np.float32)


def structural_similarity(a: np.ndarray, b: np.ndarray, window: int = 7) -> float:
    """Mean structural similarity of two grey pictures with values from 0 to 1, over square windows."""
    # The constants of the measure for a range of 1.
    c1, c2 = 0.01**2, 0.03**2
    n = window * window

    def mean(x: np.ndarray) -> np.ndarray:
        return np.lib.stride_tricks.sliding_window_view(x, (window, window)).mean((2, 3))

    a, b = a.astype(np.float64), b.astype(np.float64)
    ma, mb = mean(a), mean(b)
    va, vb, vab = ((mean(x * y) - p * q) * n / (n - 1) for x, y, p, q in ((a, a, ma, ma), (b, b, mb, mb), (a, b, ma, mb)))
    return float((((2 * ma * mb + c1) * (2 * vab + c2)) / ((ma**2 + mb**2 + c1) * (va + vb + c2))).mean())




def pair_scores(pairs: DataFrame, make: Callable[[], Callable[[str, str], float]], name: str) -> DataFrame:
    """``pairs`` (key, a, b) with ``name``: the score of a method for each pair; 0 for one that can't be read, which still
    counts. A method that fails as a whole raises, and is left out by the caller."""
    kind = pairs.schema["key"].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        method = make()
        for pdf in parts:
            got = []
            for a, b in zip(pdf["a"], pdf["b"]):
                try:
                    got.append(min(max(float(method(a, b)), 0.0), 1.0))
                except (OSError, ValueError, TypeError):
                    got.append(0.0)
            yield pd.DataFrame({"key": pdf["key"], "a": pdf["a"], "b": pdf["b"], name: got})

    return pairs.select("key", "a", "b").mapInPandas(run, f"key {kind}, a string, b string, {name} double")
