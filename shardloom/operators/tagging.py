"""Score vectors to ordered tag lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.functions.media import sigmoid


def vocabulary(tags: DataFrame, size: int, order: str = "tag_id") -> DataFrame:
    """(idx, name, category) of the first ``size`` tags by ``order``. The vocabulary is a small fixed table: ``size`` is
    the length of a score vector, so the rows that are ranked together and broadcast are at most that many."""
    first = tags.select("name", "category", order).dropDuplicates([order]).orderBy(order).limit(size)
    return first.agg(F.array_sort(F.collect_list(F.struct(order, "name", "category"))).alias("v")).select(F.posexplode("v").alias("idx", "t")).select("idx", "t.name", "t.category")


def scores(vectors: DataFrame, key: str, vector: str, scale: float = 20.0) -> DataFrame:
    """(key, idx, p): each element's probability; ``scale`` times the element is its logit."""
    return vectors.select(key, F.posexplode(vector).alias("idx", "x")).select(key, "idx", sigmoid(F.col("x").cast("double") * scale).alias("p"))


def _ordered(chosen: DataFrame, key: str, rank: Column) -> DataFrame:
    """(key, tags) by ascending rank."""
    got = F.array_sort(F.collect_list(F.struct(rank.alias("r"), "name")))
    return chosen.groupBy(key).agg(F.transform(got, lambda t: t["name"]).alias("tags"))


def resolved_threshold(tagger_class: Column, tagger: Column, of_class: Column, overall: Column) -> Column:
    """The first that is set of a tagger's threshold for a class, its own, that of the class and that of all; else 0.35.
    0 is set."""
    return F.coalesce(tagger_class, tagger, of_class, overall, F.lit(0.35))


def threshold_tags(p: DataFrame, vocab: DataFrame, key: str, general: float = 0.35, character: float = 0.35, characters_first: bool = True) -> DataFrame:
    """(key, tags): general (0) and character (4) tags at or above their thresholds, in index order; with
    ``characters_first`` characters before, in descending index order, each having been put in front."""
    at = p.join(F.broadcast(vocab), "idx").where(((F.col("category") == "0") & (F.col("p") >= general)) | ((F.col("category") == "4") & (F.col("p") >= character)))
    front = F.when(F.col("category") == "4", -1 - F.col("idx")).otherwise(F.col("idx")) if characters_first else F.col("idx")
    return _ordered(at, key, front)


def rating(vectors: DataFrame, key: str, vector: str, names: list[str]) -> DataFrame:
    """(key, rating): the largest of the first elements, the first of equals."""
    head = F.slice(vector, 1, len(names))
    return vectors.select(key, F.try_element_at(F.array(*(F.lit(n) for n in names)), F.array_position(head, F.array_max(head)).cast("int")).alias("rating"))


def category_tags(p: DataFrame, vocab: DataFrame, key: str, thresholds: dict[str, float], general: float = 0.492, character: float = 0.492, least: float = 0.1) -> DataFrame:
    """(key, tags): tags at or above ``least`` and the threshold of their lower-cased category, else that of
    characters or the general one; rating tags are left out. A tag without category is general."""
    cat = F.lower(F.coalesce("category", F.lit("general")))
    own = F.coalesce(*(F.when(cat == k, F.lit(v)) for k, v in thresholds.items()), F.lit(None).cast("double")) if thresholds else F.lit(None).cast("double")
    limit = F.coalesce(own, F.when(cat == "character", character).otherwise(general))
    at = p.where(F.col("p") >= least).join(F.broadcast(vocab), "idx").where((F.col("p") >= limit) & (cat != "rating"))
    return _ordered(at, key, F.col("idx"))


def split_tags(p: DataFrame, vocab: DataFrame, key: str, general_count: int, series: DataFrame | None = None, general: float = 0.30, character: float = 0.85) -> DataFrame:
    """(key, tags): tags strictly above their thresholds, general ones (indexes below ``general_count``) before
    characters, then the distinct sorted series of the characters from ``series`` (name, series)."""
    at = p.join(F.broadcast(vocab), "idx").where(F.when(F.col("idx") < general_count, F.col("p") > general).otherwise(F.col("p") > character))
    base = _ordered(at, key, F.col("idx"))
    if series is None:
        return base
    found = at.where(F.col("idx") >= general_count).join(F.broadcast(series), "name").groupBy(key).agg(F.array_sort(F.collect_set("series")).alias("extra"))
    return base.join(found, key, "left").select(key, F.concat("tags", F.coalesce("extra", F.array().cast("array<string>"))).alias("tags"))


def top_tags(vectors: DataFrame, vocab: DataFrame, key: str, vector: str, general_count: int, general: int = 25, character: int = 10) -> DataFrame:
    """(key, rank, name): the highest elements of each class, general ones first, each class by descending score, the
    lower index first at a tie. The vector of a row is sorted within the row, so nothing is shuffled."""
    pairs = F.transform(vector, lambda x, i: F.struct((-x.cast("double")).alias("neg"), i.alias("idx")))
    best = lambda part, k: F.slice(F.array_sort(part), 1, k)
    chosen = F.concat(best(F.filter(pairs, lambda s: s["idx"] < general_count), general), best(F.filter(pairs, lambda s: s["idx"] >= general_count), character))
    return vectors.select(key, F.posexplode(chosen).alias("rank", "s")).select(key, "rank", "s.idx").join(F.broadcast(vocab), "idx").select(key, "rank", "name")
