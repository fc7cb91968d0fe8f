"""One query for each operator, over whole tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom import boundary
from shardloom.functions import media, results, tags, text
from shardloom.functions.paths import base_name, parent, stem_of
from shardloom.operators import compaction, jobs, scan, shards, similarity, sinks, tagging
from shardloom.plans import media as media_plans
from shardloom.plans import requests as request_plans
from shardloom.session import shared_dir
from shardloom.sources import table
from shardloom.streaming import state

Query = Callable[[SparkSession, str], DataFrame]

DIMS, GENERAL = 64, 40
CATEGORIES = {"0": "general", "3": "copyright", "4": "character", "9": "rating"}
TAG_RULES = dict(replacements="long hair,hair;solo,alone;alone,single", unwanted=["simple background", "no humans"], firsts=["outdoors", "single"])
PROMPT = 'Tags: {tags}. Style: {style}. Reply as {"caption": "..."} and keep {tags}.'
CAPACITY = 268_435_456


def _scores(s: SparkSession, d: str, first: int = 1) -> DataFrame:
    v = table(s, d, "embeddings")
    return tagging.scores(v.select("vec_id", F.slice("embedding", first, DIMS).alias("e")), "vec_id", "e")


def _vocab(s: SparkSession, d: str, size: int = DIMS, ratings: bool = True) -> DataFrame:
    v = table(s, d, "tag_vocab")
    return tagging.vocabulary(v if ratings else v.where("category <> '9'"), size)


def threshold_resolution(s: SparkSession, d: str) -> DataFrame:
    """Thresholds of parts as taggers, each level set for some sizes."""
    given = [F.when(F.col("p_size") % k == 0, F.col("p_size") / 100 - F.lit(x)) for k, x in ((2, 0.02), (3, 0.03), (5, 0.05), (7, 0.07))]
    return table(s, d, "part").select("p_partkey", F.round(tagging.resolved_threshold(*given), 6).alias("threshold"))


def _joined(df: DataFrame) -> DataFrame:
    return df.select("vec_id", F.array_join("tags", ",").alias("tags"))


def _series(vocab: DataFrame) -> DataFrame:
    return vocab.select("name", F.explode(F.array(F.regexp_extract("name", r"\(([^()]*)\)$", 1), F.concat(F.lit("cat_"), "category"))).alias("series")).where("series <> ''")


def camie_tags(s: SparkSession, d: str) -> DataFrame:
    """Category thresholds over sigmoid scores."""
    names = F.create_map(*(F.lit(x) for kv in CATEGORIES.items() for x in kv))
    vocab = _vocab(s, d).withColumn("category", names[F.col("category")])
    return _joined(tagging.category_tags(_scores(s, d), vocab, "vec_id", {"general": 0.9, "copyright": 0.8}, character=0.7))


def wd14_tags(s: SparkSession, d: str) -> DataFrame:
    """Two thresholds, characters first, and the rating of the first four elements at the end."""
    vectors = table(s, d, "embeddings").select("vec_id", "embedding")
    found = tagging.threshold_tags(_scores(s, d, 5), _vocab(s, d, DIMS - 4, False), "vec_id", 0.9, 0.8)
    rated = tagging.rating(vectors, "vec_id", "embedding", ["g", "s", "q", "e"])
    both = rated.join(found, "vec_id", "left")
    return _joined(both.select("vec_id", F.concat(F.coalesce("tags", F.array().cast("array<string>")), F.array("rating")).alias("tags")))


def tag_lists(s: SparkSession, d: str) -> DataFrame:
    """(repo, item, tagged_at, tagger, tags) with array and order kept."""
    return table(s, d, "item_tags").where("tags is not null")


def merged_tags(s: SparkSession, d: str) -> DataFrame:
    """Tags of all runs over an item, in order of time and tagger, each at its first place."""
    runs = table(s, d, "item_tags").groupBy("repo", "item").agg(F.array_sort(F.collect_list(F.struct("tagged_at", "tagger", "tags"))).alias("r"))
    flat = F.array_distinct(F.filter(F.flatten(F.filter(F.col("r.tags"), lambda t: t.isNotNull())), lambda t: t.isNotNull()))
    return runs.select("repo", "item", F.array_join(flat, "|").alias("tags"))


def category_suffix(s: SparkSession, d: str) -> DataFrame:
    """Vocabulary tags with the name of their category."""
    cat = F.element_at(F.create_map(*(F.lit(x) for kv in CATEGORIES.items() for x in kv)), F.col("category"))
    v = table(s, d, "tag_vocab").select("tag_id", "name", F.create_map(F.lower("name"), cat).alias("m"))
    return v.select("tag_id", F.array_join(tags.with_category(F.array(F.col("name"), F.concat("name", F.lit(" (artist)")), F.lit(" ")), F.col("m")), "|").alias("tags"))


def context_join(s: SparkSession, d: str) -> DataFrame:
    """Captions with the tags that two taggers gave the request's item, and the batch's model."""
    req = jobs.latest(table(s, d, "request_map")).select("request_id", "batch_id")
    place = table(s, d, "request_map").groupBy("request_id").agg(F.max("path_rel").alias("item"))
    runs = table(s, d, "item_tags").where("tags is not null").groupBy("repo", "item").agg(*(F.max(F.when(F.col("tagger") == t, F.array_join("tags", ", "))).alias(t) for t in ("wd14", "pixai")))
    model = table(s, d, "batch_state").groupBy(F.col("batch_id").alias("b")).agg(F.max("model").alias("model"))
    base = table(s, d, "caption").select("caption_id", "request_id", "repo", "style")
    j = base.join(place, "request_id", "left").join(req, "request_id", "left").join(runs, ["repo", "item"], "left").join(F.broadcast(model), F.col("batch_id") == F.col("b"), "left")
    return j.select("caption_id", F.coalesce("wd14", F.lit(text.NO_PRIOR_TAGS)).alias("a"), F.coalesce("pixai", F.lit(text.NO_TAGS)).alias("b"), F.coalesce("style", F.lit(text.NONE)).alias("style"), F.coalesce("model", F.lit(text.NOT_AVAILABLE)).alias("model"))


def _entries(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "packing_input").groupBy("repo", "rel").agg(F.max(F.greatest("size", F.lit(0))).alias("size"))


def _pack(**rule) -> Query:
    return lambda s, d: shards.pack(_entries(s, d), "repo", "rel", F.col("size"), CAPACITY, **rule).select("repo", "rel", "shard", "seq")


def pack_payload(s: SparkSession, d: str) -> DataFrame:
    """Requests of a batch by their bytes, with what JSON adds around and between them."""
    rows = table(s, d, "caption").select("batch_id", F.concat("request_id", F.lit("#"), F.col("caption_id").cast("string")).alias("id"), F.octet_length("prompt").alias("bytes"))
    return shards.pack(rows, "batch_id", "id", F.col("bytes"), 4096, overhead=21, comma=1, alone=False).select("batch_id", "id", "shard")


def shard_keys(s: SparkSession, d: str) -> DataFrame:
    """Key of each entry within its repository's shards, and the next free one."""
    p = shards.pack(_entries(s, d), "repo", "rel", F.col("size"), CAPACITY, alone=False)
    by = p.groupBy("repo").agg(F.count("*").alias("samples"), F.max("shard").alias("last"))
    return by.select("repo", shards.sample_keys(F.col("samples")).alias("next_key"), F.format_string("train-%04d.tar", "last").alias("last_shard"))


def _frames(s: SparkSession, d: str) -> DataFrame:
    names = F.create_map(*(F.lit(x) for kv in ((1, "_A"), (2, "_B"), (3, "_C"), (4, "_image_base")) for x in kv))
    return table(s, d, "lineitem").select("l_orderkey", names[F.col("l_linenumber")].alias("suffix"), F.concat_ws("/", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("path")).where("suffix is not null")


def pair_similarity(s: SparkSession, d: str) -> DataFrame:
    """Neighbouring vectors as frame pairs: cosine, and two other methods derived from it."""
    v = table(s, d, "embeddings").select(F.floor(F.col("vec_id") / 2).alias("pair"), (F.col("vec_id") % 2).alias("side"), "embedding")
    both = v.groupBy("pair").agg(*(F.max_by("embedding", F.when(F.col("side") == k, 1)).alias(n) for k, n in ((0, "a"), (1, "b")))).where("a is not null and b is not null")
    c = both.select("pair", similarity.cosine(F.col("a"), F.col("b")).alias("c"))
    return c.select("pair", F.round("c", 6).alias("cosine"), F.floor(similarity.combined({"clip": F.col("c"), "sscd": F.lit(None).cast("double"), "ssim": F.lit(0.5)})).cast("bigint").alias("combined"))


def archive(kind: str) -> Query:
    """Text documents of each repository as archives in the shared folder."""

    def run(s: SparkSession, d: str) -> DataFrame:
        folder = f"{shared_dir(s).rstrip('/')}/{kind}-{uuid.uuid4().hex[:8]}"
        docs = table(s, d, "documents").where("text is not null").select("repo", F.format_string("%012d", "doc_id").alias("name"), "text")
        placed = shards.pack(docs, "repo", "name", F.octet_length("text"), 1 << 20, most=5000)
        # A shard may run over two ranges, so that no range is in its name.
        rows = placed.join(docs, ["repo", "name"]).select(F.concat_ws("-", F.replace("repo", F.lit("/"), F.lit("__")), F.lit("0"), F.format_string("%05d", "shard")).alias("shard"), "seq", F.concat("name", F.lit(".txt")).alias("name"), F.encode("text", "utf-8").alias("content"))
        return shards.write_archives(rows, folder, kind).select("shard", "members")

    return run


def _frame_count() -> Column:
    return F.col("l_extendedprice").cast("bigint") % 400


def _rate() -> Column:
    return F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("l_quantity"))


def snap_trim(s: SparkSession, d: str) -> DataFrame:
    """Line items as videos: the frame count of the form 8k + 1, whether to trim to 121 frames, and where to cut."""
    snapped, action = media.snap_frames(_frame_count()), media.trim_action(_rate(), _frame_count(), 121)
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", snapped.alias("snapped"), action.alias("action"), media.cut_seconds(_rate(), 121).alias("cut"))


def norm_actions(s: SparkSession, d: str) -> DataFrame:
    """How many line items, as videos, need their sound or rate converted."""
    channels = F.when(F.col("l_returnflag") == "N", None).otherwise(F.col("l_linenumber"))
    by = table(s, d, "lineitem").groupBy(media.stereo_action(channels).alias("stereo"), media.fps_action(_rate(), 24.0).alias("rate"))
    return by.agg(F.count("*").alias("n"))


def compacted(s: SparkSession, d: str) -> DataFrame:
    """The listing of small files after it was written in many files and compacted into few."""
    out = compaction.consolidated(s, table(s, d, "manifest"), f"{shared_dir(s).rstrip('/')}/compact-{uuid.uuid4().hex[:8]}")
    return out.select("path", "repo", "length", (F.col("files_after") < F.col("files_before")).alias("fewer"))


def plan_totals(s: SparkSession, d: str) -> DataFrame:
    """What the plan's files hold, by repository."""
    plan = compaction.consolidation_plan(table(s, d, "manifest"))
    whole = F.count_if(F.col("offset") < 0) == 0
    return plan.groupBy("repo").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.count_distinct("path").alias("paths"), whole.alias("placed"))


def stream_states(s: SparkSession, d: str) -> DataFrame:
    """The request log as a stream, to its end."""
    log = s.readStream.schema(table(s, d, "request_map").schema).parquet(f"{d}/request_map*.parquet")
    return state.run_to_end(state.latest_states(log), f"{shared_dir(s).rstrip('/')}/states-{uuid.uuid4().hex[:8]}")


def queries() -> dict[str, Query]:
    """Name to query."""
    m = lambda f: lambda s, d: f(table(s, d, "manifest"))
    log = lambda f: lambda s, d: f(table(s, d, "request_map"))
    return {
        "p3_found": lambda s, d: compaction.consolidation_plan(table(s, d, "manifest")).select("path"),
        "p3_plan": lambda s, d: compaction.consolidation_plan(table(s, d, "manifest")),
        "p3_totals": plan_totals,
        "p3_files": lambda s, d: compaction.consolidated_files(table(s, d, "manifest")),
        "p3_compacted": compacted,
        "pairs_full_outer": m(scan.media_pairs),
        "media_captioned": m(lambda t: scan.with_sidecar(t, True)),
        "media_uncaptioned": m(lambda t: scan.with_sidecar(t, False)),
        "video_text_pairs": m(scan.video_text),
        "kind_counts": m(scan.kind_counts),
        "allowed_entry_stats": m(scan.upload_counts),
        "walk_visible": m(scan.visible),
        "merge_plan": m(lambda t: scan.merge_plan(t, "/data/atelier/", "/merged/")),
        "flatten_plan": m(scan.flatten_plan),
        "camie_tags": camie_tags,
        "wd14_tags": wd14_tags,
        "pixai_tags": lambda s, d: _joined(tagging.split_tags(_scores(s, d), _vocab(s, d), "vec_id", GENERAL, _series(_vocab(s, d)), 0.9, 0.95)),
        "threshold_resolution": threshold_resolution,
        "pixai_topk": lambda s, d: tagging.top_tags(table(s, d, "embeddings"), _vocab(s, d), "vec_id", "embedding", GENERAL, 5, 3),
        "tag_postprocess": lambda s, d: tag_lists(s, d).select("repo", "item", "tagger", "tagged_at", F.array_join(tags.postprocess(F.col("tags"), **TAG_RULES), "|").alias("tags")),
        "tag_dedupe_merge": merged_tags,
        "character_expand": lambda s, d: table(s, d, "tag_vocab").select("tag_id", tags.expand_character(F.col("name")).alias("name")),
        "category_suffix": category_suffix,
        "caption_append_merge": lambda s, d: table(s, d, "caption").where("tags_used is not null").select("caption_id", sinks.caption_line(F.col("tags_used"), ", ", F.array_join("tags_ignored", ", "), "photo").alias("text")),
        "prompt_render": lambda s, d: table(s, d, "caption").select("caption_id", text.render(PROMPT, {"tags": F.coalesce(F.nullif(F.array_join("tags_used", ", "), F.lit("")), F.lit(text.NO_PRIOR_TAGS)), "style": F.coalesce("style", F.lit(text.NONE))}).alias("prompt")),
        "caption_context_join": context_join,
        "json_captions": lambda s, d: table(s, d, "caption").select("caption_id", *(results.caption_of(F.col("caption"), v).alias(f"v{v}") for v in (1, 2, 3, 4))),
        "log_upsert": lambda s, d: jobs.upsert_log(table(s, d, "item_tags"), ["repo", "item"], "tagger", "tagged_at").select("repo", "item", F.array_join("taggers", ",").alias("taggers"), "processed_at"),
        "resume_unprocessed": lambda s, d: jobs.unprocessed(table(s, d, "item_tags").select("repo", "item").distinct(), jobs.upsert_log(table(s, d, "item_tags"), ["repo", "item"], "tagger", "tagged_at"), ["repo", "item"], ["wd14", "pixai"]),
        "request_ids": lambda s, d: table(s, d, "packing_input").select("repo", "rel").distinct().select("repo", "rel", text.request_id(F.col("rel"), F.concat_ws("/", "repo", "rel")).alias("request_id"), text.state_file(F.lit("run"), F.col("rel")).alias("state_file"), text.frame_file(base_name(stem_of(F.col("rel"))), F.col("rel"), F.lit(12)).alias("frame_file")),
        "state_latest": log(lambda t: jobs.latest(t).select("request_id", "state", "attempt", "updated_at")),
        "state_counters": log(jobs.counters),
        "attempt_mint": log(jobs.attempts),
        "failed_items": log(jobs.failed_paths),
        "unsent_requests": lambda s, d: jobs.unsent(table(s, d, "caption").select("request_id").distinct(), table(s, d, "request_map")),
        "rate_window": lambda s, d: jobs.rolling_count(table(s, d, "events"), "ts", 1800, "event_id").select("event_id", "calls"),
        "zero_streak": lambda s, d: jobs.zero_streaks(table(s, d, "events").withColumn("pending", F.when(F.col("value") < 20, 0).otherwise(1)), "user_id", ["ts", "event_id"], "pending"),
        "prompt_drift": lambda s, d: jobs.drifted(table(s, d, "batch_state")),
        "usage_totals": lambda s, d: table(s, d, "events").groupBy("event_type").agg(F.sum(F.coalesce(F.get_json_object("props", "$.usage.k"), F.get_json_object("props", "$.k")).try_cast("bigint")).alias("tokens"), F.count("*").alias("calls")),
        "pack_a": _pack(),
        "pack_b": _pack(most=20),
        "pack_c": _pack(alone=False),
        "pack_json_payload": pack_payload,
        "shard_keys": shard_keys,
        "resume_chunk": lambda s, d: shards.next_chunk(table(s, d, "manifest").select(F.concat(F.lit("zips/chunk_"), F.col("length").cast("string"), F.lit(".zip")).alias("p")), "p", "zips/chunk_"),
        "snap_trim": snap_trim,
        "fps_parse": lambda s, d: table(s, d, "lineitem").select("l_orderkey", "l_linenumber", media.parse_fps(F.concat(F.col("l_quantity").cast("int") * 1000, F.when(F.col("l_linenumber") % 3 == 0, "/").otherwise(""), F.when(F.col("l_linenumber") == 6, "0").otherwise("1001"))).alias("fps")),
        "keyframes": lambda s, d: table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.posexplode(media.keyframes(_frame_count())).alias("k", "frame")),
        "norm_actions": norm_actions,
        "vram_batch": lambda s, d: table(s, d, "orders").select("o_orderkey", media.batch_for_memory(F.col("o_totalprice") / 5).cast("int").alias("batch")),
        "pair_groups": lambda s, d: similarity.frame_groups(_frames(s, d), "l_orderkey", "suffix", "path").select("l_orderkey", "a", "b", F.col("dataset").cast("int").alias("dataset")),
        "pair_similarity": pair_similarity,
        "source_classify": lambda s, d: table(s, d, "manifest").select("repo", "path").distinct().select("path", "repo", text.source_kind(F.concat(F.lit("https://huggingface.co/"), "repo", F.when(F.length("path") % 2 == 0, "/resolve/main/x.zip").otherwise(""))).alias("far"), text.source_kind(F.col("repo")).alias("near"), text.dataset_reference(F.concat(F.lit("https://huggingface.co/datasets/"), "repo", F.lit("/tree/main/raw/"))).getField("subfolder").alias("subfolder")),
        "repo_sanitize": lambda s, d: table(s, d, "manifest").select(parent(F.col("path")).alias("folder")).distinct().select("folder", text.repo_name(F.col("folder")).alias("name")),
        "sample_deterministic": lambda s, d: table(s, d, "documents").select("doc_id", F.md5(F.col("doc_id").cast("string")).alias("h")).orderBy("h", "doc_id").limit(100).select("doc_id"),
        "tag_boundary": lambda s, d: boundary.score(table(s, d, "item_tags").select("item").distinct(), "item").select("item", F.round(F.array_max("scores").cast("double"), 4).alias("best")),
        "tar_write": archive("tar"),
        "zip_write": archive("zip"),
        "stream_state": stream_states,
        **request_plans.queries(),
        **media_plans.queries(),
    }


_BASE = "regexp_extract(path, '[^/]*$')"
_EXT = f"lower(regexp_extract({_BASE}, '^\\.*[^.].*?(\\.[^.]*)$', 1))"
_IMG = ", ".join(f"'{e}'" for e in media.IMAGE_EXTS)
_VID = ", ".join(f"'{e}'" for e in media.VIDEO_EXTS)
_KIND = f"CASE WHEN {_EXT} IN ({_IMG}) THEN 'image' WHEN {_EXT} IN ({_VID}) THEN 'video' WHEN {_EXT} = '.txt' THEN 'text' ELSE 'other' END"
_FILES = f"files AS (SELECT path, {_KIND} AS kind, {_EXT} AS ext, substr(path, 1, length(path) - length({_EXT})) AS stem FROM (SELECT DISTINCT path FROM manifest WHERE path IS NOT NULL))"
_VOCAB = "vocab AS (SELECT row_number() OVER (ORDER BY tag_id) - 1 AS idx, name, category FROM tag_vocab{where} ORDER BY tag_id LIMIT {size})"
_SCORES = "scores AS (SELECT vec_id, i - 1 AS idx, 1 / (1 + exp(-(embedding[i + {skip}]::DOUBLE * 20.0))) AS p FROM embeddings, range(1, {n} + 1) t(i))"
_LATEST = "latest AS (SELECT * FROM request_map QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY updated_at DESC, log_id DESC) = 1)"
_ENTRIES = "e AS (SELECT repo, rel, coalesce(max(greatest(size, 0)), 0) AS size FROM packing_input GROUP BY repo, rel), r AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY rel) AS i FROM e)"


def _fold(rows: str, group: str, key: str, size: str, capacity: int, full: str, alone: bool = True, start: int = 0, comma: int = 0) -> str:
    """A recursive fold for next-fit: open shard, its bytes and entries, and whether a large entry closed it."""
    big = f"n.{size} > {capacity}" if alone else "false"
    turn = f"f.closed OR ({full})"
    return f"""WITH RECURSIVE {rows},
      f AS (
        SELECT {group}, {key}, i, 0 AS shard, CASE WHEN {big.replace("n.", "r.")} THEN 0 ELSE {size} END::BIGINT AS used, CASE WHEN {big.replace("n.", "r.")} THEN 0 ELSE 1 END AS cnt, {big.replace("n.", "r.")} AS closed, 0 AS seq FROM r WHERE i = 1
        UNION ALL
        SELECT n.{group}, n.{key}, n.i,
          CASE WHEN {big} THEN f.shard + CASE WHEN f.cnt > 0 OR f.closed THEN 1 ELSE 0 END WHEN {turn} THEN f.shard + 1 ELSE f.shard END,
          CASE WHEN {big} THEN 0 WHEN {turn} THEN n.{size} ELSE f.used + n.{size} END::BIGINT,
          CASE WHEN {big} THEN 0 WHEN {turn} THEN 1 ELSE f.cnt + 1 END, {big},
          CASE WHEN {big} OR {turn} THEN 0 ELSE f.cnt END
        FROM f JOIN r n ON n.{group} IS NOT DISTINCT FROM f.{group} AND n.i = f.i + 1)"""


def oracle_sql() -> dict[str, str]:
    """The same in SQL where SQL can say it."""
    plain = "'/' || array_to_string(list_filter(string_split(replace(nfc_normalize(path), '\\', '/'), '/'), lambda s: s <> '' AND s <> '.'), '/')"
    for _ in range(8):
        plain = f"regexp_replace({plain}, '/([^/.][^/]*|\\.[^/.][^/]*|\\.\\.[^/]+)/\\.\\.(/|$)', '\\2')"
    small = f"""WITH f AS (SELECT {plain} AS path, repo, length, modification_time FROM manifest WHERE path IS NOT NULL),
            n AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY path ORDER BY modification_time DESC NULLS LAST, length DESC NULLS LAST, repo DESC NULLS LAST) = 1),
            s AS (SELECT path, repo, length FROM n WHERE length > 0 AND length < 65536 AND NOT regexp_matches(path, '(^|/)\\.') AND NOT regexp_matches(path, '(\\.tmp|\\.part|~)$'))"""
    fps = "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END"
    frames = "(trunc(l_extendedprice)::BIGINT % 400)"
    over = f"(({frames} - 1) % 8)"
    spaced = "CASE WHEN length(x) > 3 THEN replace(x, '_', ' ') ELSE x END"
    post = f"list_transform(list_transform(tags, lambda x: {spaced}), lambda x: CASE WHEN x = 'long hair' THEN 'hair' WHEN x IN ('solo', 'alone') THEN 'single' ELSE x END)"
    post = f"list_filter({post}, lambda x: x NOT IN ('simple background', 'no humans') OR x IS NULL)"

    def first(col: str, tag: str) -> str:
        return f"CASE WHEN list_contains({col}, '{tag}') THEN list_concat(['{tag}'], {col}[1:list_position({col}, '{tag}') - 1], {col}[list_position({col}, '{tag}') + 1:]) ELSE {col} END"

    steps = "CASE " + " ".join(f"WHEN o_totalprice / 5 >= {a} THEN {b}" for a, b in ((80000, 96), (60000, 64), (40000, 48), (30000, 32), (20000, 16), (12000, 8), (8000, 4))) + " ELSE 2 END"
    sanitised = "trim(left(trim(regexp_replace(regexp_replace(lower(trim(folder)), '[^a-zA-Z0-9._-]+', '-', 'g'), '-{2,}', '-', 'g'), '-.'), 96), '-.')"
    byte_order = "used + n.size > 268435456"
    return {
        "p3_found": f"{small} SELECT path FROM s",
        "p3_compacted": f"{small} SELECT path, repo, length, true AS fewer FROM s",
        "p3_totals": f"{small} SELECT repo, count(*) AS files, sum(length)::BIGINT AS bytes, count(DISTINCT path) AS paths, true AS placed FROM s GROUP BY repo",
        "pairs_full_outer": f"""WITH {_FILES}, s AS (SELECT stem, count(*) FILTER (kind IN ('image', 'video')) AS media, count(*) FILTER (kind = 'text') AS texts FROM files WHERE kind <> 'other' GROUP BY stem)
            SELECT stem, media, texts, CASE WHEN media = 0 THEN 'text_only' WHEN texts = 0 THEN 'media_only' ELSE 'paired' END AS state FROM s""",
        "media_captioned": f"WITH {_FILES} SELECT path FROM files f WHERE kind = 'image' AND EXISTS (SELECT 1 FROM files t WHERE t.kind = 'text' AND t.stem = f.stem)",
        "media_uncaptioned": f"WITH {_FILES} SELECT path FROM files f WHERE kind = 'image' AND NOT EXISTS (SELECT 1 FROM files t WHERE t.kind = 'text' AND t.stem = f.stem)",
        "video_text_pairs": f"WITH {_FILES}, t AS (SELECT stem, min(path) AS text FROM files WHERE kind = 'text' GROUP BY stem) SELECT path, text FROM files LEFT JOIN t USING (stem) WHERE kind = 'video'",
        "kind_counts": f"SELECT repo, count(*) FILTER (k = 'image') AS images, count(*) FILTER (k = 'video') AS videos, count(*) FILTER (k = 'text') AS texts, count(*) FILTER (k = 'other') AS others FROM (SELECT repo, {_KIND} AS k FROM manifest) GROUP BY repo",
        "allowed_entry_stats": f"WITH {_FILES} SELECT count(*) FILTER (kind IN ('image', 'video')) AS images, count(*) FILTER (kind = 'text') AS texts, count(*) FILTER (ext = '.zip') AS zips, count(*) FILTER (kind = 'other' AND ext <> '.zip') AS others FROM files",
        "walk_visible": "SELECT DISTINCT path FROM manifest WHERE NOT regexp_matches(path, '(^|/)\\.') AND NOT list_contains(string_split(regexp_extract(path, '^(.*)/[^/]*$', 1), '/'), 'raw')",
        "merge_plan": f"""WITH {_FILES}, below AS (SELECT * FROM files WHERE starts_with(path, '/data/atelier/'))
            SELECT path AS src, '/merged/' || substr(path, 15) AS dst FROM below WHERE kind IN ('image', 'video') OR kind = 'text' AND stem IN (SELECT stem FROM below WHERE kind IN ('image', 'video'))""",
        "flatten_plan": f"""WITH {_FILES}, m AS (SELECT path, ext, {_BASE} AS base FROM files WHERE kind IN ('image', 'video')),
            r AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY path) AS rank, left(base, length(base) - length(ext)) AS head, right(base, length(ext)) AS tail FROM m)
            SELECT path AS src, CASE WHEN rank = 1 THEN base WHEN head || '_' || rank || tail IN (SELECT base FROM m) THEN head || '__' || rank || tail ELSE head || '_' || rank || tail END AS name FROM r""",
        "camie_tags": f"""WITH {_VOCAB.format(where="", size=DIMS)}, {_SCORES.format(skip=0, n=DIMS)}
            SELECT vec_id, string_agg(name, ',' ORDER BY idx) AS tags FROM scores JOIN vocab USING (idx)
            WHERE p >= 0.1 AND category <> '9' AND p >= CASE category WHEN '0' THEN 0.9 WHEN '3' THEN 0.8 WHEN '4' THEN 0.7 ELSE 0.492 END GROUP BY vec_id""",
        "wd14_tags": f"""WITH {_VOCAB.format(where=" WHERE category <> '9'", size=DIMS - 4)}, {_SCORES.format(skip=4, n=DIMS - 4)},
            t AS (SELECT vec_id, string_agg(name, ',' ORDER BY CASE WHEN category = '4' THEN -1 - idx ELSE idx END) AS tags FROM scores JOIN vocab USING (idx)
              WHERE category = '0' AND p >= 0.9 OR category = '4' AND p >= 0.8 GROUP BY vec_id)
            SELECT vec_id, coalesce(tags || ',', '') || ['g', 's', 'q', 'e'][list_position(embedding[1:4], list_max(embedding[1:4]))] AS tags FROM embeddings LEFT JOIN t USING (vec_id)""",
        "pixai_tags": f"""WITH {_VOCAB.format(where="", size=DIMS)}, {_SCORES.format(skip=0, n=DIMS)},
            c AS (SELECT * FROM scores JOIN vocab USING (idx) WHERE p > CASE WHEN idx < {GENERAL} THEN 0.9 ELSE 0.95 END),
            s AS (SELECT DISTINCT vec_id, unnest([regexp_extract(name, '\\(([^()]*)\\)$', 1), 'cat_' || category]) AS x FROM c WHERE idx >= {GENERAL}),
            x AS (SELECT vec_id, string_agg(x, ',' ORDER BY x) AS extra FROM s WHERE x <> '' GROUP BY vec_id)
            SELECT vec_id, string_agg(name, ',' ORDER BY idx) || coalesce(',' || any_value(extra), '') AS tags FROM c LEFT JOIN x USING (vec_id) GROUP BY vec_id""",
        "pixai_topk": f"""WITH {_VOCAB.format(where="", size=DIMS)}, {_SCORES.format(skip=0, n=DIMS)},
            x AS (SELECT vec_id, idx, embedding[idx + 1] AS v, idx >= {GENERAL} AS c FROM scores JOIN embeddings USING (vec_id)),
            k AS (SELECT *, row_number() OVER (PARTITION BY vec_id, c ORDER BY v DESC, idx) AS n FROM x)
            SELECT vec_id, (n - 1 + CASE WHEN c THEN 5 ELSE 0 END)::INT AS rank, name FROM k JOIN vocab USING (idx) WHERE n <= CASE WHEN c THEN 3 ELSE 5 END""",
        "threshold_resolution": "SELECT p_partkey, round(coalesce(" + ", ".join(f"CASE WHEN p_size % {k} = 0 THEN p_size::DOUBLE / 100 - {x}::DOUBLE END" for k, x in ((2, 0.02), (3, 0.03), (5, 0.05), (7, 0.07))) + ", 0.35), 6) AS threshold FROM part",
        "tag_postprocess": f"""WITH a AS (SELECT repo, item, tagger, tagged_at, {post} AS t FROM item_tags WHERE tags IS NOT NULL), b AS (SELECT * REPLACE ({first("t", "outdoors")} AS t) FROM a)
            SELECT repo, item, tagger, tagged_at, array_to_string({first("t", "single")}, '|') AS tags FROM b""",
        "tag_dedupe_merge": """WITH r AS (SELECT repo, item, row_number() OVER (PARTITION BY repo, item ORDER BY tagged_at, tagger, tags) AS n, tags FROM item_tags),
            t AS (SELECT repo, item, n, unnest(tags) AS tag, generate_subscripts(tags, 1) AS i FROM r),
            u AS (SELECT repo, item, tag, min(n * 100000 + i) AS place FROM t WHERE tag IS NOT NULL GROUP BY ALL),
            g AS (SELECT repo, item, string_agg(tag, '|' ORDER BY place) AS tags FROM u GROUP BY repo, item)
            SELECT repo, item, coalesce(tags, '') AS tags FROM (SELECT DISTINCT repo, item FROM item_tags) LEFT JOIN g USING (repo, item)""",
        "character_expand": "SELECT tag_id, CASE WHEN regexp_matches(name, '\\([^(]*\\)$') THEN regexp_replace(regexp_extract(name, '^(.*)\\(([^(]*)\\)$', 1), '_+$', '') || ', ' || regexp_extract(name, '^(.*)\\(([^(]*)\\)$', 2) ELSE name END AS name FROM tag_vocab",
        "category_suffix": "SELECT tag_id, name || ' (' || CASE category WHEN '0' THEN 'general' WHEN '3' THEN 'copyright' WHEN '4' THEN 'character' ELSE 'rating' END || ')|' || name || ' (artist)' AS tags FROM tag_vocab",
        "caption_append_merge": """SELECT caption_id, CASE WHEN len(tags_used) > 0 THEN 'photo, ' || array_to_string(list_concat(o, list_filter(tags_used, lambda t: NOT list_contains(o, t))), ', ') END AS text
            FROM (SELECT caption_id, tags_used, list_filter(list_transform(string_split(coalesce(array_to_string(tags_ignored, ', '), ''), ','), lambda t: trim(t)), lambda t: t <> '') AS o FROM caption WHERE tags_used IS NOT NULL)""",
        "prompt_render": """SELECT caption_id, 'Tags: ' || t || '. Style: ' || coalesce(style, '(none)') || '. Reply as {"caption": "..."} and keep ' || t || '.' AS prompt
            FROM (SELECT *, coalesce(nullif(array_to_string(tags_used, ', '), ''), '(no prior tags)') AS t FROM caption)""",
        "caption_context_join": f"""WITH {_LATEST}, p AS (SELECT request_id, max(path_rel) AS item FROM request_map GROUP BY 1),
            t AS (SELECT repo, item, max(array_to_string(tags, ', ')) FILTER (tagger = 'wd14') AS wd14, max(array_to_string(tags, ', ')) FILTER (tagger = 'pixai') AS pixai FROM item_tags WHERE tags IS NOT NULL GROUP BY 1, 2),
            m AS (SELECT batch_id, max(model) AS model FROM batch_state GROUP BY 1)
            SELECT caption_id, coalesce(wd14, '(no prior tags)') AS a, coalesce(pixai, '(no tags)') AS b, coalesce(c.style, '(none)') AS style, coalesce(model, '(not available)') AS model
            FROM caption c LEFT JOIN p USING (request_id) LEFT JOIN latest l USING (request_id) LEFT JOIN t ON t.repo = c.repo AND t.item = p.item LEFT JOIN m ON m.batch_id = l.batch_id""",
        "log_upsert": "SELECT repo, item, string_agg(DISTINCT tagger, ',' ORDER BY tagger) AS taggers, max(tagged_at) AS processed_at FROM item_tags GROUP BY repo, item",
        "resume_unprocessed": "SELECT repo, item FROM item_tags GROUP BY repo, item HAVING count(DISTINCT tagger) FILTER (tagger IN ('wd14', 'pixai')) < 2",
        "request_ids": """SELECT DISTINCT repo, rel, 'req_' || sha1(CASE WHEN starts_with(rel, '..') THEN repo || '/' || rel ELSE rel END) AS request_id, '.batch_state_run_' || substr(md5(rel), 1, 10) || '.json' AS state_file,
            regexp_replace(regexp_extract(rel, '[^/]*$'), '^(\\.*[^.].*?)\\.[^.]*$', '\\1') || '_' || substr(md5(rel), 1, 10) || '_f12.jpg' AS frame_file FROM packing_input""",
        "state_latest": f"WITH {_LATEST} SELECT request_id, state, attempt, updated_at FROM latest",
        "stream_state": f"WITH {_LATEST} SELECT request_id, state, updated_at FROM latest",
        "state_counters": f"""WITH {_LATEST}, c AS (SELECT batch_id, count(*) AS total, count(*) FILTER (state = 'succeeded') AS succeeded, count(*) FILTER (starts_with(state, 'failed')) AS failed FROM latest GROUP BY 1)
            SELECT *, total - succeeded - failed AS pending, (succeeded + failed) * 100 / total AS percent FROM c""",
        "attempt_mint": """WITH a AS (SELECT regexp_replace(request_id, '_a\\d+$', '') AS base_id, max(attempt) AS attempt, bool_or(state IN ('submitted', 'succeeded')) AS sent FROM request_map GROUP BY 1)
            SELECT *, CASE WHEN NOT sent THEN base_id || '_a' || (coalesce(attempt, 0) + 1) END AS next_id FROM a""",
        "failed_items": f"WITH {_LATEST} SELECT DISTINCT batch_id, path_rel FROM latest WHERE starts_with(state, 'failed')",
        "unsent_requests": f"WITH {_LATEST} SELECT DISTINCT request_id FROM caption WHERE request_id NOT IN (SELECT request_id FROM latest WHERE state IN ('submitted', 'succeeded'))",
        "rate_window": "SELECT event_id, count(*) OVER (ORDER BY ts RANGE BETWEEN INTERVAL 30 MINUTES PRECEDING AND CURRENT ROW) AS calls FROM events",
        "zero_streak": """WITH m AS (SELECT user_id, value < 20 AS z, sum(CASE WHEN value < 20 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM events)
            SELECT user_id, max(run) AS streak FROM (SELECT user_id, island, count(*) FILTER (z) AS run FROM m GROUP BY 1, 2) GROUP BY 1""",
        "prompt_drift": "SELECT prompt_profile, count(DISTINCT system_prompt_sha256) AS systems, count(DISTINCT user_prompt_template_sha256) AS users, count(DISTINCT system_prompt_sha256) > 1 OR count(DISTINCT user_prompt_template_sha256) > 1 AS drift FROM batch_state GROUP BY 1",
        "usage_totals": "SELECT event_type, sum(try_cast(coalesce(json_extract_string(props, '$.usage.k'), json_extract_string(props, '$.k')) AS BIGINT))::BIGINT AS tokens, count(*) AS calls FROM events GROUP BY 1",
        "pack_a": _fold(_ENTRIES, "repo", "rel", "size", CAPACITY, f"f.cnt > 0 AND f.{byte_order}") + " SELECT repo, rel, shard::INT AS shard, seq::INT AS seq FROM f",
        "pack_b": _fold(_ENTRIES, "repo", "rel", "size", CAPACITY, f"f.cnt > 0 AND (f.{byte_order} OR f.cnt >= 20)") + " SELECT repo, rel, shard::INT AS shard, seq::INT AS seq FROM f",
        "pack_c": _fold(_ENTRIES, "repo", "rel", "size", CAPACITY, f"f.used > 0 AND f.{byte_order}", alone=False) + " SELECT repo, rel, shard::INT AS shard, seq::INT AS seq FROM f",
        "pack_json_payload": _fold("r AS (SELECT batch_id, request_id || '#' || caption_id AS id, octet_length(encode(prompt)) AS size, row_number() OVER (PARTITION BY batch_id ORDER BY request_id || '#' || caption_id) AS i FROM caption)", "batch_id", "id", "size", 4096, "f.cnt > 0 AND 21 + f.used + n.size + 1 > 4096", alone=False) + " SELECT batch_id, id, shard::INT AS shard FROM f",
        "shard_keys": _fold(_ENTRIES, "repo", "rel", "size", CAPACITY, f"f.used > 0 AND f.{byte_order}", alone=False) + " SELECT repo, format('{:06d}', count(*)) AS next_key, format('train-{:04d}.tar', max(shard)) AS last_shard FROM f GROUP BY repo",
        "resume_chunk": "SELECT (coalesce(max(try_cast(length AS INT)) FILTER (length >= 0), -1) + 1)::INT AS next_chunk FROM manifest",
        "snap_trim": f"""SELECT l_orderkey, l_linenumber, (CASE WHEN {frames} <= 1 THEN 1 ELSE {frames} - {over} + CASE WHEN {over} >= 4 THEN 8 ELSE 0 END END)::BIGINT AS snapped,
            CASE WHEN {fps} IS NULL OR {fps} <= 0 OR {frames} <= 0 THEN 'probe_failed' WHEN {frames} <= 121 THEN 'keep' ELSE 'trim' END AS action, CASE WHEN {fps} > 0 THEN printf('%.4f', 121.0::DOUBLE / ({fps})) END AS cut FROM lineitem""",
        "fps_parse": "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 AND l_linenumber <> 6 THEN (l_quantity::INT * 1000)::DOUBLE / 1001 ELSE 0 END::DOUBLE AS fps FROM lineitem",
        "keyframes": f"""SELECT l_orderkey, l_linenumber, k::INT AS k, (CASE WHEN {frames} > 0 THEN least(trunc([0, 0.25, 0.5, 0.75, 1.0][k + 1]::DOUBLE * ({frames} - 1))::BIGINT, {frames} - 1) ELSE k END)::BIGINT AS frame FROM lineitem, range(0, 5) t(k)""",
        "norm_actions": f"""SELECT CASE WHEN l_returnflag = 'N' THEN 'no_audio' WHEN l_linenumber >= 2 THEN 'already' ELSE 'convert' END AS stereo, CASE WHEN {fps} IS NULL THEN 'unknown' WHEN {fps} = 24 THEN 'already' ELSE 'convert' END AS rate, count(*) AS n FROM lineitem GROUP BY 1, 2""",
        "vram_batch": f"SELECT o_orderkey, ({steps})::INT AS batch FROM orders",
        "pair_groups": """WITH g AS (SELECT l_orderkey, max(p) FILTER (l_linenumber = 1) AS a, max(p) FILTER (l_linenumber = 2) AS b, max(p) FILTER (l_linenumber = 3) AS c, max(p) FILTER (l_linenumber = 4) AS base
              FROM (SELECT l_orderkey, l_linenumber, l_partkey || '/' || l_suppkey AS p FROM lineitem) GROUP BY 1)
            SELECT l_orderkey, a, b, (CASE WHEN c IS NOT NULL THEN 1 WHEN base IS NOT NULL THEN 2 ELSE 3 END)::INT AS dataset FROM g WHERE a IS NOT NULL AND b IS NOT NULL""",
        "pair_similarity": """WITH v AS (SELECT vec_id // 2 AS pair, vec_id % 2 AS side, embedding::DOUBLE[] AS e FROM embeddings), p AS (SELECT a.pair AS pair, a.e AS a, b.e AS b FROM v a JOIN v b ON a.pair = b.pair AND a.side = 0 AND b.side = 1),
            c AS (SELECT pair, greatest(least(list_sum(list_transform(list_zip(a, b), lambda x: x[1] * x[2])) / (sqrt(list_sum(list_transform(a, lambda x: x * x))) * sqrt(list_sum(list_transform(b, lambda x: x * x)))), 1.0), 0.0) AS c FROM p)
            SELECT pair, round(c, 6) AS cosine, floor(round(greatest(0.0, least((c * 0.4 + 0.0 + 0.5 * 0.25) * 100, 100.0)), 4))::BIGINT AS combined FROM c""",
        "source_classify": "SELECT DISTINCT path, repo, CASE WHEN length(path) % 2 = 0 THEN 'hf_file' ELSE 'hf_dataset' END AS far, CASE WHEN regexp_matches(repo, '^[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+$') THEN 'hf_dataset' ELSE 'unknown' END AS near, CASE WHEN regexp_matches(repo, '^[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+$') THEN 'raw' END AS subfolder FROM manifest",
        "repo_sanitize": f"SELECT folder, coalesce(nullif({sanitised}, ''), 'dataset') AS name FROM (SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder FROM manifest)",
        "sample_deterministic": "SELECT doc_id FROM documents ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT 100",
        **request_plans.oracle_sql(),
        **media_plans.oracle_sql(),
    }
