"""Groups of frames and the similarity of frame pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weight of each method.
WEIGHTS = {"clip": 0.4, "sscd": 0.35, "ssim": 0.25}


def frame_suffix(stem: Column) -> Column:
    """struct(base, suffix) of a stem that ends in _A, _B, _C or _image_base, case-sensitively; null parts for others."""
    pattern = r"^(.*)(_A|_B|_C|_image_base)$"
    return F.struct(F.nullif(F.regexp_extract(stem, pattern, 1), F.lit("")).alias("base"), F.nullif(F.regexp_extract(stem, pattern, 2), F.lit("")).alias("suffix"))


def frame_groups(frames: DataFrame, key: str, suffix: str, path: str) -> DataFrame:
    """(key, a, b, c, base, dataset): the greatest path of each suffix, and the dataset: 1 with C, else 2 with base, else
    3. Groups without A and B are left out."""
    named = {"a": "_A", "b": "_B", "c": "_C", "base": "_image_base"}
    g = frames.groupBy(key).agg(*(F.max(F.when(F.col(suffix) == s, F.col(path))).alias(n) for n, s in named.items()))
    kind = F.when(F.col("c").isNotNull(), 1).when(F.col("base").isNotNull(), 2).otherwise(3)
    return g.where("a is not null and b is not null").withColumn("dataset", kind)


def copy_plan(groups: DataFrame, key: str) -> DataFrame:
    """(key, src, dst): where the frames of ``frame_groups`` are copied to: ``dataset_<n>/<name><suffix><extension>``, the name
    being the key with ``__`` for ``/``. The frames of a group are in order A, B, C, base; missing ones have no row."""
    named = F.array(*(F.struct(F.col(c).alias("src"), F.lit(x).alias("suffix")) for c, x in (("a", "_A"), ("b", "_B"), ("c", "_C"), ("base", "_image_base"))))
    rows = groups.select(key, "dataset", F.inline(named)).where("src is not null")
    dst = F.concat(F.lit("dataset_"), F.col("dataset").cast("string"), F.lit("/"), F.replace(F.col(key), F.lit("/"), F.lit("__")), "suffix", F.regexp_extract("src", r"\.[^./]*$", 0))
    return rows.select(key, "src", dst.alias("dst"))


def mean_score(scores: Column) -> Column:
    """The mean of the scores that there are; 0 without any."""
    return F.coalesce(F.avg(scores), F.lit(0.0))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, cut to 0..1; 0 if one has no length. Null for null or different lengths."""
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    product = lambda x, y: F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
    raw = F.coalesce(F.try_divide(total(product(a, b)), F.sqrt(total(product(a, a))) * F.sqrt(total(product(b, b)))), F.lit(0.0))
    return F.when(F.size(a) == F.size(b), F.greatest(F.least(raw, F.lit(1.0)), F.lit(0.0)))


def combined(scores: dict[str, Column], weights: dict[str, float] | None = None) -> Column:
    """Mean of the methods that succeeded, their weights renormalised (equal if they sum to 0), as 0..100 with four
    decimals; 0 without any. A null score of a method that succeeded counts as 0."""
    w = {k: (weights or WEIGHTS).get(k, 0.0) for k in scores}
    total = sum(w.values())
    share = {k: v / total for k, v in w.items()} if total > 0 else {k: 1 / len(w) for k in w}
    mean = sum((F.coalesce(c, F.lit(0.0)) * share[k] for k, c in scores.items()), F.lit(0.0))
    return F.bround(F.greatest(F.lit(0.0), F.least(mean * 100, F.lit(100.0))), 4)
