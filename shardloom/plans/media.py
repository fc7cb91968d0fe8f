"""Queries of listings, plans for files, videos and frame pairs, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom import codecs
from shardloom.functions import media
from shardloom.operators import scan, shards, similarity, sinks
from shardloom.sources import table

Query = Callable[[SparkSession, str], DataFrame]

ROOT = "/data/atelier"
STILLS = (".jpg", ".jpeg", ".png", ".webp", ".bmp", ".gif")


def _entries(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "packing_input").groupBy("repo", "rel").agg(F.max(F.greatest("size", F.lit(0))).alias("size"))


def media_sorted(s: SparkSession, d: str) -> DataFrame:
    return scan.media_of(table(s, d, "manifest"), STILLS)


def files_at(s: SparkSession, d: str) -> DataFrame:
    """Videos below a folder."""
    return scan.at_path(table(s, d, "manifest"), ROOT, media.VIDEO_EXTS)


def entry_collection(s: SparkSession, d: str) -> DataFrame:
    """Files below a folder with a report from elsewhere."""
    return scan.entries(table(s, d, "manifest"), ROOT, "/tmp/report.json", 7)


def media_folders(s: SparkSession, d: str) -> DataFrame:
    return scan.folders(table(s, d, "manifest"))


def merged_sources(s: SparkSession, d: str) -> DataFrame:
    """Listings of images and of all files as two sources."""
    m = table(s, d, "manifest")
    return scan.merged_sources(m.where(media.media_kind(F.col("path")) == "image"), m)


def delete_plan(s: SparkSession, d: str) -> DataFrame:
    """Images without bytes, and their text files."""
    m = table(s, d, "manifest")
    return scan.delete_plan(m.where((media.media_kind(F.col("path")) == "image") & (F.col("length") == 0)), m)


def contiguous_chunks(s: SparkSession, d: str) -> DataFrame:
    """Every 500 entries of a repository, in order."""
    return shards.chunks(_entries(s, d).select("repo", "rel"), ["repo"], ["rel"], 500)


def entry_keys(s: SparkSession, d: str) -> DataFrame:
    """Each entry's key within the whole listing."""
    return shards.sample_numbers(_entries(s, d).select("repo", "rel"), ["repo", "rel"])


def similarity_rows(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "part").select("p_partkey", sinks.similarity_json(F.col("p_size") / F.lit(8.0)).alias("json"))


def similarity_mean(s: SparkSession, d: str) -> DataFrame:
    """Mean similarity of each brand's parts as pairs, 0 without one above 40."""
    scored = F.when(F.col("p_size") > 40, F.col("p_size").cast("double"))
    return table(s, d, "part").groupBy("p_brand").agg(F.round(similarity.mean_score(scored), 6).alias("mean"))


def sidecar_json(s: SparkSession, d: str) -> DataFrame:
    """The JSON beside each caption that there is."""
    fields = F.create_map(F.lit("caption"), F.lit("x"), F.lit("style"), F.coalesce("style", F.lit("")), F.lit("batch"), F.coalesce("batch_id", F.lit("")))
    rows = table(s, d, "caption").where("caption is not null and prompt is not null")
    return rows.select("caption_id", sinks.sidecar_json(fields, F.col("prompt"), F.col("caption"), F.col("request_id")).alias("json"))


def organize_plan(s: SparkSession, d: str) -> DataFrame:
    """Where the frames of each pair are copied to."""
    names = F.create_map(*(F.lit(x) for kv in ((1, "_A"), (2, "_B"), (3, "_C"), (4, "_image_base")) for x in kv))
    frames = table(s, d, "lineitem").select(F.concat(F.lit("order/"), F.col("l_orderkey").cast("string")).alias("key"), names[F.col("l_linenumber")].alias("suffix"), F.concat(F.col("l_partkey").cast("string"), F.lit("."), F.lower("l_returnflag")).alias("path"))
    return similarity.copy_plan(similarity.frame_groups(frames.where("suffix is not null"), "key", "suffix", "path"), "key")


def tagger_fallback(s: SparkSession, d: str) -> DataFrame:
    """An item's tags by one tagger, else by the other."""
    runs = table(s, d, "item_tags").where("tags is not null").groupBy("repo", "item")
    by = runs.agg(*(F.max(F.when(F.col("tagger") == t, F.array_join("tags", ","))).alias(t) for t in ("pixai", "wd14")))
    return by.select("repo", "item", F.coalesce("pixai", "wd14").alias("tags"))


def video_info(s: SparkSession, d: str) -> DataFrame:
    """Rates and frame counts out of what a probe printed."""
    n = F.col("l_linenumber")
    rate, average = F.when(n % 3 == 0, "0/0").otherwise("24/1"), F.when(n % 2 == 0, "25/1").otherwise("0/0")
    frames = F.when(n == 5, "N/A").otherwise(F.col("l_partkey").cast("string"))
    raw = F.struct(rate.alias("r_frame_rate"), average.alias("avg_frame_rate"), frames.alias("nb_frames"), F.col("l_quantity").cast("string").alias("duration"), n.cast("int").alias("channels"))
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", codecs.video_info(raw).alias("i")).select("l_orderkey", "l_linenumber", "i.*")


def frame_numbers(s: SparkSession, d: str) -> DataFrame:
    """The middle frame, and the twelfth as far as there is one."""
    total = F.col("l_quantity").cast("bigint") - 3
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", codecs.middle_frame(total).alias("middle"), media.clamp_frame(F.lit(12), total).alias("twelfth"))


def trim_counts(s: SparkSession, d: str) -> DataFrame:
    """How many videos are trimmed, kept, and could not be probed."""
    frames, rate = F.col("l_extendedprice").cast("bigint") % 400, F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("l_quantity"))
    return table(s, d, "lineitem").groupBy(media.trim_action(rate, frames, 121).alias("action")).agg(F.count("*").alias("videos"))


def stage_runs(s: SparkSession, d: str) -> DataFrame:
    """Stages run over the videos of the listing by the codec's stand-in."""
    videos = table(s, d, "manifest").where(media.media_kind(F.col("path")) == "video").select("path").distinct()
    info = codecs.probed(videos).select("path", codecs.video_info(F.col("raw")).alias("i"))
    needs = info.where("i is not null").select("path", (~F.endswith("path", F.lit(".mp4"))).alias("convert"), F.coalesce(F.col("i.channels") < 2, F.lit(False)).alias("stereo"), (F.col("i.fps") != 24).alias("rate"))
    return codecs.applied(needs, ["convert", "stereo", "rate"]).groupBy("stage", "ok").agg(F.count("*").alias("videos"))


def queries() -> dict[str, Query]:
    """Name to query."""
    files = (media_sorted, files_at, entry_collection, media_folders, merged_sources, delete_plan, contiguous_chunks, entry_keys)
    pairs = (similarity_rows, similarity_mean, sidecar_json, organize_plan, tagger_fallback, video_info, frame_numbers, trim_counts, stage_runs)
    return {f.__name__: f for f in (*files, *pairs)}


_BASE = "regexp_extract(path, '[^/]*$')"
_EXT = f"lower(regexp_extract({_BASE}, '^\\.*[^.].*?(\\.[^.]*)$', 1))"


def _among(extensions: tuple[str, ...]) -> str:
    return f"{_EXT} IN ({', '.join(repr(e) for e in extensions)})"


def oracle_sql() -> dict[str, str]:
    """The same in SQL."""
    image, video = _among(media.IMAGE_EXTS), _among(media.VIDEO_EXTS)
    stem = f"substr(path, 1, length(path) - length({_EXT}))"
    entries = "e AS (SELECT DISTINCT repo, rel FROM packing_input)"
    fps = "CASE WHEN l_linenumber % 3 <> 0 THEN 24.0 WHEN l_linenumber % 2 = 0 THEN 25.0 ELSE 0 END::DOUBLE"
    total = "(trunc(l_quantity)::BIGINT - 3)"
    return {
        "media_sorted": f"SELECT path, max(length) AS length FROM manifest WHERE path IS NOT NULL AND {_among(STILLS)} GROUP BY path",
        "files_at": f"SELECT DISTINCT path FROM manifest WHERE starts_with(path, '{ROOT}/') AND {video}",
        "entry_collection": f"SELECT substr(path, {len(ROOT) + 2}) AS rel, max(coalesce(length, 0)) AS size FROM manifest WHERE starts_with(path, '{ROOT}/') GROUP BY 1 UNION ALL SELECT '_reports/report.json', 7",
        "media_folders": f"SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, count(*) AS media FROM (SELECT DISTINCT path FROM manifest WHERE path IS NOT NULL) WHERE {image} OR {video} GROUP BY 1",
        "merged_sources": f"SELECT path, (CASE WHEN {image} THEN 0 ELSE 1 END)::INT AS source FROM (SELECT DISTINCT path FROM manifest WHERE path IS NOT NULL)",
        "delete_plan": f"""WITH b AS (SELECT DISTINCT path, {stem} AS stem FROM manifest WHERE {image} AND length = 0), t AS (SELECT DISTINCT path, {stem} AS stem FROM manifest WHERE {_EXT} = '.txt')
            SELECT path, 'bad' AS why FROM b UNION ALL SELECT path, 'sidecar' FROM t WHERE stem IN (SELECT stem FROM b)""",
        "contiguous_chunks": f"WITH {entries} SELECT repo, rel, ((row_number() OVER (PARTITION BY repo ORDER BY rel) - 1) // 500)::INT AS chunk FROM e",
        "entry_keys": f"WITH {entries} SELECT repo, rel, format('{{:06d}}', row_number() OVER (ORDER BY repo NULLS FIRST, rel NULLS FIRST) - 1) AS key FROM e",
        "similarity_rows": "SELECT p_partkey, '{\"combined\":' || round_even(p_size / 8.0::DOUBLE, 2)::VARCHAR || '}' AS json FROM part",
        "similarity_mean": "SELECT p_brand, round(coalesce(avg(p_size::DOUBLE) FILTER (p_size > 40), 0), 6) AS mean FROM part GROUP BY 1",
        "sidecar_json": """SELECT caption_id, json_object('video', request_id, 'caption', caption, 'raw', prompt, 'raw_style', coalesce(style, ''), 'raw_batch', coalesce(batch_id, ''))::VARCHAR AS json
            FROM caption WHERE caption IS NOT NULL AND prompt IS NOT NULL""",
        "organize_plan": """WITH f AS (SELECT 'order/' || l_orderkey AS key, l_linenumber AS n, l_partkey || '.' || lower(l_returnflag) AS path FROM lineitem),
            g AS (SELECT key, max(path) FILTER (n = 1) AS a, max(path) FILTER (n = 2) AS b, max(path) FILTER (n = 3) AS c, max(path) FILTER (n = 4) AS base FROM f GROUP BY 1),
            k AS (SELECT *, CASE WHEN c IS NOT NULL THEN 1 WHEN base IS NOT NULL THEN 2 ELSE 3 END AS ds FROM g WHERE a IS NOT NULL AND b IS NOT NULL),
            u AS (SELECT key, ds, a AS src, '_A' AS suffix FROM k UNION ALL SELECT key, ds, b, '_B' FROM k UNION ALL SELECT key, ds, c, '_C' FROM k UNION ALL SELECT key, ds, base, '_image_base' FROM k)
            SELECT key, src, 'dataset_' || ds || '/' || replace(key, '/', '__') || suffix || regexp_extract(src, '\\.[^.]*$') AS dst FROM u WHERE src IS NOT NULL""",
        "tagger_fallback": "SELECT repo, item, coalesce(max(array_to_string(tags, ',')) FILTER (tagger = 'pixai'), max(array_to_string(tags, ',')) FILTER (tagger = 'wd14')) AS tags FROM item_tags WHERE tags IS NOT NULL GROUP BY 1, 2",
        "video_info": f"""SELECT l_orderkey, l_linenumber, {fps} AS fps, (CASE WHEN l_linenumber <> 5 AND l_partkey > 0 THEN l_partkey ELSE trunc(l_quantity * {fps}) END)::BIGINT AS frames, l_linenumber::INT AS channels FROM lineitem""",
        "frame_numbers": f"""SELECT l_orderkey, l_linenumber, (CASE WHEN {total} > 0 THEN {total} // 2 ELSE 0 END)::BIGINT AS middle, least(12, CASE WHEN {total} > 0 THEN {total} ELSE 9999 END - 1)::BIGINT AS twelfth FROM lineitem""",
        "trim_counts": """SELECT CASE WHEN l_linenumber = 7 OR l_quantity <= 0 OR trunc(l_extendedprice)::BIGINT % 400 <= 0 THEN 'probe_failed' WHEN trunc(l_extendedprice)::BIGINT % 400 <= 121 THEN 'keep' ELSE 'trim' END AS action, count(*) AS videos FROM lineitem GROUP BY 1""",
    }
