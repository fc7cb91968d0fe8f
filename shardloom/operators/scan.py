"""Listings of files: media with their text sidecars, counters, walks, and plans to move files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.functions.media import IMAGE_EXTS, VIDEO_EXTS, media_kind
from shardloom.functions.paths import base_name, ext_of, hidden, parent, stem_of
from shardloom.operators.ordered import rank


def files(manifest: DataFrame) -> DataFrame:
    """(path, kind, stem, ext) of each different path. Null paths are no files."""
    p = F.col("path")
    return manifest.select("path").where(p.isNotNull()).distinct().select("path", media_kind(p).alias("kind"), stem_of(p).alias("stem"), ext_of(p).alias("ext"))


def media_pairs(manifest: DataFrame) -> DataFrame:
    """(stem, media, texts, state) of each stem with media or text: how many of both, and paired, media_only or
    text_only. One grouping by stem serves both sides."""
    by = files(manifest).where("kind <> 'other'").groupBy("stem")
    counts = by.agg(F.count_if(F.col("kind").isin("image", "video")).alias("media"), F.count_if(F.col("kind") == "text").alias("texts"))
    state = F.when(F.col("media") == 0, "text_only").when(F.col("texts") == 0, "media_only").otherwise("paired")
    return counts.withColumn("state", state)


def with_sidecar(manifest: DataFrame, present: bool) -> DataFrame:
    """(path) of the images that have a text sidecar, or that have none."""
    f = files(manifest)
    texts = f.where("kind = 'text'").select("stem").distinct()
    return f.where("kind = 'image'").join(texts, "stem", "left_semi" if present else "left_anti").select("path")


def video_text(manifest: DataFrame) -> DataFrame:
    """(path, text) of each video with its sidecar or null; of several spellings of one extension the least path."""
    f = files(manifest)
    texts = f.where("kind = 'text'").groupBy("stem").agg(F.min("path").alias("text"))
    return f.where("kind = 'video'").join(texts, "stem", "left").select("path", "text")


def kind_counts(manifest: DataFrame) -> DataFrame:
    """(repo, images, videos, texts, others) of listings."""
    kind = media_kind(F.col("path"))
    return manifest.select("repo", kind.alias("k")).groupBy("repo").agg(*(F.count_if(F.col("k") == k).alias(n) for k, n in (("image", "images"), ("video", "videos"), ("text", "texts"), ("other", "others"))))


def upload_counts(manifest: DataFrame) -> DataFrame:
    """(images, texts, zips, others) of different paths: what an upload of media and texts takes and skips."""
    ext = F.col("ext")
    flags = {"images": ext.isin(*IMAGE_EXTS, *VIDEO_EXTS), "texts": ext == ".txt", "zips": ext == ".zip"}
    none = ~(flags["images"] | flags["texts"] | flags["zips"])
    return files(manifest).agg(*(F.count_if(c).alias(n) for n, c in flags.items()), F.count_if(none).alias("others"))


def visible(manifest: DataFrame, excluded: tuple[str, ...] = ("raw",)) -> DataFrame:
    """(path) outside of hidden and excluded folders."""
    names = F.split(parent(F.col("path")), "/")
    return manifest.select("path").distinct().where(~hidden(F.col("path")) & ~F.arrays_overlap(names, F.array(*(F.lit(x) for x in excluded))))


def pending(archives: DataFrame, markers: DataFrame) -> DataFrame:
    """(path) of archives without a marker ``<path>.extracted.ok`` as new as themselves; both (path, modification_time)."""
    m = markers.groupBy(F.col("path").alias("marker")).agg(F.max("modification_time").alias("done"))
    return archives.join(m, F.concat("path", F.lit(".extracted.ok")) == F.col("marker"), "left").where("done is null or done < modification_time").select("path")


def merge_plan(manifest: DataFrame, root: str, target: str) -> DataFrame:
    """(src, dst): media keep their place below ``root`` under ``target``, and their text sidecar follows."""
    f = files(manifest).where(F.startswith(F.col("path"), F.lit(root)))
    media = f.where("kind in ('image', 'video')")
    texts = f.where("ext = '.txt'").join(media.select("stem").distinct(), "stem", "left_semi")
    moved = media.select("path").unionByName(texts.select("path"))
    return moved.select(F.col("path").alias("src"), F.concat(F.lit(target), F.expr(f"substring(path, {len(root) + 1})")).alias("dst"))


def flatten_plan(manifest: DataFrame) -> DataFrame:
    """(src, name): media of all folders in one: the first of a name, by path, keeps it, the others get ``_2``, ``_3``
    and so on before the extension. A name so made that some file has by itself gets its rank after a second ``_``, so
    that no two files share a name, and no group of equal names needs to be numbered one after the other."""
    media = files(manifest).where("kind in ('image', 'video')").withColumn("base", base_name(F.col("path")))
    ranked = rank(media.select("path", "base", "ext"), ["base"], ["path"])
    head, tail = F.expr("left(base, length(base) - length(ext))"), F.right(F.col("base"), F.length("ext"))
    number = F.col("rank").cast("string")
    named = ranked.withColumn("made", F.when(F.col("rank") > 1, F.concat(head, F.lit("_"), number, tail)))
    own = media.select(F.col("base").alias("made")).distinct().withColumn("taken", F.lit(True))
    out = named.join(own, "made", "left")
    return out.select(F.col("path").alias("src"), F.when(F.col("rank") == 1, F.col("base")).when(F.col("taken"), F.concat(head, F.lit("__"), number, tail)).otherwise(F.col("made")).alias("name"))


def media_of(manifest: DataFrame, extensions: tuple[str, ...] = IMAGE_EXTS) -> DataFrame:
    """(path, length) of the files with one of ``extensions``, lower-cased, each once, in order of path."""
    found = manifest.where(F.col("path").isNotNull() & ext_of(F.col("path")).isin(*extensions))
    return found.groupBy("path").agg(F.max("length").alias("length")).orderBy("path")


def at_path(manifest: DataFrame, path: str, extensions: tuple[str, ...], recursive: bool = True, filter_file: bool = True) -> DataFrame:
    """(path) of the files with one of ``extensions`` below a folder, or just in it; if ``path`` is itself a file it is
    the only one, whatever its extension if not ``filter_file``."""
    root = path.rstrip("/")
    p = F.col("path")
    fits = ext_of(p).isin(*extensions)
    below = F.startswith(p, F.lit(root + "/")) & (F.lit(recursive) | (parent(p) == root))
    return manifest.select("path").where((below & fits) | ((p == root) & (fits | F.lit(not filter_file)))).distinct().orderBy("path")


def entries(manifest: DataFrame, root: str, extra: str | None = None, extra_size: int = 0) -> DataFrame:
    """(rel, size) of the files below ``root``, in order of rel, each with its largest known length; an ``extra`` file from
    elsewhere comes in as ``_reports/<name>``, one below the root stays where it is."""
    base = root.rstrip("/") + "/"
    below = manifest.where(F.startswith(F.col("path"), F.lit(base))).select(F.expr(f"substring(path, {len(base) + 1})").alias("rel"), F.coalesce("length", F.lit(0)).alias("size"))
    if extra is not None and not extra.startswith(base):
        name = F.concat(F.lit("_reports/"), F.lit(extra.rsplit("/", 1)[-1]))
        below = below.unionByName(manifest.sparkSession.range(1).select(name.alias("rel"), F.lit(extra_size).cast("bigint").alias("size")))
    return below.groupBy("rel").agg(F.max("size").alias("size")).orderBy("rel")


def folders(manifest: DataFrame, chosen: list[str] | None = None) -> DataFrame:
    """(folder, media) of the folders that hold media, in order, with how many; only those ``chosen`` if given."""
    f = files(manifest).where("kind in ('image', 'video')").select(parent(F.col("path")).alias("folder"))
    f = f.where(F.col("folder").isin(*chosen)) if chosen is not None else f
    return f.groupBy("folder").agg(F.count("*").alias("media")).orderBy("folder")


def delete_plan(bad: DataFrame, manifest: DataFrame) -> DataFrame:
    """(path, why): what to delete: each ``bad`` (path) and the text file of its stem, if there is one. Nothing is deleted here."""
    gone = bad.select("path").where(F.col("path").isNotNull()).distinct()
    texts = files(manifest).where("kind = 'text'").select(F.col("path").alias("text"), "stem")
    sidecars = texts.join(gone.select(stem_of(F.col("path")).alias("stem")).distinct(), "stem", "left_semi")
    return gone.select("path", F.lit("bad").alias("why")).unionByName(sidecars.select(F.col("text").alias("path"), F.lit("sidecar").alias("why")))


def merged_sources(*sources: DataFrame) -> DataFrame:
    """(path, source) of several listings, each path from the first that has it; sources count from 0."""
    all_ = [s.select("path", F.lit(i).alias("source")) for i, s in enumerate(sources)]
    both = all_[0]
    for s in all_[1:]:
        both = both.unionByName(s)
    return both.where("path is not null").groupBy("path").agg(F.min("source").alias("source"))
