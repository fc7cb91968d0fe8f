"""Items that appear together: support, lift and conviction of tag pairs by basket collapsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shardloom.functions.tags import canonical_tag
from shardloom.session import cut_lineage

#: So many spellings of tags are numbered and broadcast. Their tags are of bounded support, see ``numbered``.
BROADCAST_TAGS = 200_000


def records(df: DataFrame, keys: tuple[str, ...] = ("repo", "item"), tags: str = "tags") -> DataFrame:
    """(keys, basket): each item with at least one tag, and its different tags over all of its rows, ascending.
    Null and blank tags, null and empty arrays count for nothing; a null key is a key of its own."""
    used = df.select(*keys, F.explode(tags).alias("raw")).select(*keys, canonical_tag(F.col("raw")).alias("tag")).where("tag is not null")
    return used.groupBy(*keys).agg(F.array_sort(F.collect_set("tag")).alias("basket"))


def tagged_items(df: DataFrame, keys: tuple[str, ...] = ("repo", "item"), tags: str = "tags") -> int:
    """The number of items with at least one tag."""
    return df.where(F.exists(tags, lambda t: canonical_tag(t).isNotNull())).select(*keys).distinct().count()


def numbered(df: DataFrame, support: int, share: int, n: int, tags: str = "tags") -> DataFrame | None:
    """(raw, id, tag): a number for each tag that is used ``support`` times and by one of ``share`` of the ``n`` items
    (0: no such limit), in order of the tags, by each of its spellings. None if they are more than BROADCAST_TAGS.

    A tag is in no more items than it has uses, and a pair is no more frequent than its rarer tag, so that no pair
    within these limits is lost. With a share, the tags are at most ``share`` x the mean uses of an item, whatever
    the input's size."""
    raws = cut_lineage(df.select(F.explode(tags).alias("raw")).groupBy("raw").agg(F.count("*").alias("n")).withColumn("tag", canonical_tag(F.col("raw"))).where("tag is not null"))
    kept = raws.groupBy("tag").agg(F.sum("n").alias("uses")).where((F.col("uses") >= support) & (F.col("uses") * max(share, 1) >= (n if share else 0)))
    spelled = raws.join(kept, "tag").select("raw", "tag")
    if spelled.count() > BROADCAST_TAGS:
        return None
    # At most BROADCAST_TAGS rows are ranked together.
    return cut_lineage(spelled.select("raw", (F.dense_rank().over(Window.orderBy("tag")) - 1).alias("id"), "tag"))


def _pairs(weights: DataFrame, code: Column) -> DataFrame:
    """(..., weight) of each two elements of each (basket, weight), the earlier as ``a``; one row each, so that no array
    of all pairs of a basket is made."""
    first = weights.select("weight", "basket", F.posexplode("basket").alias("i", "a"))
    return first.select("weight", "a", F.explode(F.slice("basket", F.col("i") + 2, F.size("basket"))).alias("b")).select("weight", code.alias("p"))


def pair_counts(df: DataFrame, support: int = 1, share: int = 0, lift: int = 0, keys: tuple[str, ...] = ("repo", "item"), tags: str = "tags") -> DataFrame:
    """(tag_a, tag_b, n_a, n_b, n_ab, n, lift, conviction) of each two tags that ``support`` items and one of
    ``share`` items hold together, ``lift`` times as often as by chance at least; tag_a < tag_b by code points.

    Items with the same tags collapse into one weighted basket, each basket's pairs are enumerated once, and the
    weights summed, first within each task. Tags that no such pair can have leave before: the too rare, and those
    in more than one of ``lift`` items. Baskets hold numbers for tags, if these are few enough to be broadcast.
    Lift is n_ab n / (n_a n_b); conviction of a -> b is (1 - n_b / n) / (1 - n_ab / n_a), null if each item with a
    has b. No row for empty input."""
    n = tagged_items(df, keys, tags)
    names = numbered(df, support, share, n, tags) if support > 1 or share else None
    if names:
        used = df.select(*keys, F.explode(tags).alias("raw")).join(F.broadcast(names.select("raw", "id")), "raw")
        items = cut_lineage(used.groupBy(*keys).agg(F.array_sort(F.collect_set("id")).alias("basket")))
    else:
        items = cut_lineage(records(df, keys, tags))
    single = cut_lineage(items.select(F.explode("basket").alias("t")).groupBy("t").agg(F.count("*").alias("n")))
    whole = items.select("basket")
    if lift > 1:
        # Fewer than lift x the mean number of tags of an item.
        often = [r["t"] for r in single.where(F.col("n") * lift > n).collect()]
        whole = whole.select(F.array_except("basket", F.array(*map(F.lit, often))).alias("basket")) if often else whole
    weights = whole.where(F.size("basket") > 1).groupBy("basket").agg(F.count("*").alias("weight"))
    code = F.struct("a", "b")
    if names:
        tags_of = names.select(F.col("id").alias("t"), "tag").distinct()
        single = single.join(F.broadcast(tags_of), "t")
        size = (single.agg(F.max("t")).first()[0] or 0) + 1
        code = F.col("a").cast("bigint") * size + F.col("b")
    else:
        single = single.withColumn("tag", F.col("t"))
    both = _pairs(weights, code).groupBy("p").agg(F.sum("weight").alias("n_ab")).where((F.col("n_ab") >= support) & (F.col("n_ab") * max(share, 1) >= (n if share else 0)))
    a, b = (F.expr(f"cast(p div {size} as int)"), F.expr(f"cast(p % {size} as int)")) if names else (F.col("p.a"), F.col("p.b"))
    both = both.select(a.alias("a"), b.alias("b"), "n_ab")
    side = F.broadcast(single) if names else single
    x, y = (side.select(F.col("t").alias(k), F.col("tag").alias(f"tag_{k}"), F.col("n").alias(f"n_{k}")) for k in "ab")
    total = F.lit(n).cast("bigint")
    # Products of two counts may have more digits than a bigint.
    wide = lambda c: c.cast("decimal(19,0)")
    enough = wide(F.col("n_ab")) * wide(total) >= wide(F.col("n_a") * lift) * wide(F.col("n_b"))
    out = both.join(x, "a").join(y, "b").where(enough)
    return out.select(
        "tag_a", "tag_b", "n_a", "n_b", "n_ab", total.alias("n"),
        (F.col("n_ab").cast("double") * total / (F.col("n_a").cast("double") * F.col("n_b"))).alias("lift"),
        F.try_divide(1 - F.col("n_b") / total, 1 - F.col("n_ab") / F.col("n_a")).alias("conviction"),
    )


def companions(df: DataFrame, support: int = 5, share: int = 500, lift: int = 4) -> DataFrame:
    """(tag_a, tag_b) of the pairs that keep the limits, all compared in whole numbers."""
    return pair_counts(df, support, share, lift).select("tag_a", "tag_b")
