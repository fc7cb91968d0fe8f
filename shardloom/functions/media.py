"""Decisions about media: kinds, frames, rates, trimming, keyframes, batch sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardloom.functions.paths import ext_of

# File kinds by extension.
IMAGE_EXTS = (".jpg", ".jpeg", ".png", ".webp", ".bmp", ".avif", ".jxl")
VIDEO_EXTS = (".mp4", ".mov", ".mkv", ".webm", ".avi", ".m4v", ".flv")


def media_kind(path: Column) -> Column:
    """image, video, text or other."""
    ext = ext_of(path)
    return F.when(ext.isin(*IMAGE_EXTS), "image").when(ext.isin(*VIDEO_EXTS), "video").when(ext == ".txt", "text").otherwise("other")


def snap_frames(n: Column) -> Column:
    """The nearest frame count of the form 8k + 1, the upper one at a tie; 1 for 1 and less."""
    over = (n - 1) % 8
    return F.when(n <= 1, F.lit(1)).otherwise(n - over + F.when(over >= 4, 8).otherwise(0)).cast("bigint")


def parse_fps(rate: Column) -> Column:
    """``num/den`` with exactly one slash as a number; 0 for anything else and for a zero denominator."""
    parts = F.split(rate, "/")
    number = F.try_divide(parts[0].try_cast("double"), F.try_element_at(parts, F.lit(2)).try_cast("double"))
    return F.when(F.size(parts) == 2, F.coalesce(number, F.lit(0.0))).otherwise(F.lit(0.0))


def trim_action(fps: Column, frames: Column, most: int) -> Column:
    """probe_failed without a rate or count, keep up to ``most`` frames, else trim."""
    return F.when(fps.isNull() | frames.isNull() | (fps <= 0) | (frames <= 0), "probe_failed").when(frames <= most, "keep").otherwise("trim")


def cut_seconds(fps: Column, most: int) -> Column:
    """Where to cut, with four decimals; null without a rate."""
    return F.when(fps > 0, F.format_string("%.4f", F.bround(F.lit(float(most)) / fps.cast("double"), 4)))


def keyframes(total: Column) -> Column:
    """Five frame numbers from first to last; 0 to 4 if the count is unknown or not above 0."""
    last = (total - 1).cast("double")
    spread = F.transform(F.array(*(F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0))), lambda p: F.least((p * last).cast("bigint"), last.cast("bigint")))
    return F.when(total > 0, spread).otherwise(F.array(*(F.lit(i).cast("bigint") for i in range(5))))


def clamp_frame(n: Column, total: Column) -> Column:
    """The wanted frame or the last one; an unknown count clamps at 9999."""
    return F.least(n, F.when(total > 0, total).otherwise(F.lit(9999)) - 1).cast("bigint")


def sigmoid(x: Column) -> Column:
    """1 / (1 + e^-x)."""
    return 1.0 / (1.0 + F.exp(-x))


def batch_for_memory(mb: Column) -> Column:
    """Batch size by free memory in MB."""
    # Lower bound and batch size.
    steps = ((80000, 96), (60000, 64), (40000, 48), (30000, 32), (20000, 16), (12000, 8), (8000, 4))
    out = F.lit(2)
    for least, size in reversed(steps):
        out = F.when(mb >= least, size).otherwise(out)
    return out


def stereo_action(channels: Column) -> Column:
    """no_audio, convert below two channels, else already."""
    return F.when(channels.isNull(), "no_audio").when(channels >= 2, "already").otherwise("convert")


def fps_action(fps: Column, target: float) -> Column:
    """unknown without a rate, already if it equals the target exactly, else convert."""
    return F.when(fps.isNull(), "unknown").when(fps == target, "already").otherwise("convert")
