"""Queries of prompts, requests, batch jobs and their joins, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions import requests, text
from shardloom.operators import batches, jobs, joins, ordered
from shardloom.sources import state, table

Query = Callable[[SparkSession, str], DataFrame]

TEMPLATE = "Write {style} for {request}: {prompt}"
CATEGORY = {"0": "general", "3": "copyright", "4": "character", "9": "rating"}


def request_build(s: SparkSession, d: str) -> DataFrame:
    """The chat request of each caption."""
    built = requests.request_json(F.concat("request_id", F.lit("#"), F.col("caption_id").cast("string")), F.col("style"), F.col("prompt"))
    return table(s, d, "caption").select("caption_id", built.alias("request"))


def prompt_hashes(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "caption").select("caption_id", requests.text_hash(F.col("prompt")).alias("hash"))


def vars_hash(s: SparkSession, d: str) -> DataFrame:
    """Hash and description of each batch's prompt variables."""
    v = F.col("prompt_vars")
    return table(s, d, "batch_state").select("batch_id", requests.map_hash(v).alias("hash"), requests.described(v).alias("said"))


def data_uris(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", requests.data_uri(F.encode("text", "utf-8"), "text/plain").alias("uri"))


def text_only(s: SparkSession, d: str) -> DataFrame:
    """Prompts whose images were left out."""
    part = lambda kind, column: F.struct(F.lit(kind).alias("type"), column.alias("text"))
    parts = F.array(part("text", F.col("prompt")), part("image", F.col("request_id")), part("text", F.col("style")))
    return table(s, d, "caption").select("caption_id", requests.text_only(parts).alias("text"))


def naive_render(s: SparkSession, d: str) -> DataFrame:
    values = {"style": F.col("style"), "request": F.col("request_id"), "prompt": F.col("prompt")}
    return table(s, d, "caption").select("caption_id", requests.naive_render(F.lit(TEMPLATE), values).alias("text"))


def position_join(s: SparkSession, d: str) -> DataFrame:
    """Requests of a batch in order of id, with its captions in theirs."""
    asked = ordered.rank(table(s, d, "request_map").select("batch_id", "request_id").distinct(), ["batch_id"], ["request_id"], "place")
    told = ordered.rank(table(s, d, "caption").select("batch_id", "caption_id"), ["batch_id"], ["caption_id"], "place")
    return joins.by_position(asked, told, "batch_id", "place", "caption_id")


def frame_remap(s: SparkSession, d: str) -> DataFrame:
    """An item's runs as frames of a video: the last tags that aren't empty."""
    runs = table(s, d, "item_tags").select(F.concat_ws("/", "repo", "item").alias("video"), "tagged_at", "tagger", F.array_join("tags", ",").alias("tags"))
    return joins.frame_values(runs, "video", "tags", ["tagged_at", "tagger", "tags"])


def custom_id_join(s: SparkSession, d: str) -> DataFrame:
    results = table(s, d, "request_map").select("log_id", F.sha1("path").alias("custom_id"))
    return joins.by_custom_id(results, table(s, d, "manifest")).select("log_id", "path")


def result_files(s: SparkSession, d: str) -> DataFrame:
    return joins.result_files(table(s, d, "caption"), table(s, d, "request_map"), table(s, d, "manifest"))


def frame_context(s: SparkSession, d: str) -> DataFrame:
    """Orders as videos, their lines as frames."""
    lines = table(s, d, "lineitem").select("l_orderkey", F.col("l_linenumber") - 1, F.col("l_partkey").cast("string")).toDF("o_orderkey", "frame", "part")
    base = table(s, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    all_ = joins.left_chain(base, [joins.frame_columns(lines, "o_orderkey", "frame", "part")], ["o_orderkey"], {})
    prompt = requests.frame_context(F.col("o_orderpriority"), [F.col(f"f{i}") for i in range(5)], F.col("o_orderstatus"))
    return all_.select("o_orderkey", prompt.alias("prompt"))


def progress(s: SparkSession, d: str) -> DataFrame:
    """How far each batch is, and how fast, by its requests' latest states."""
    log = table(s, d, "request_map")
    spent = log.groupBy("batch_id").agg((F.max("updated_at") - F.min("updated_at")).alias("seconds"))
    counted = ordered.with_group(jobs.counters(log), spent, "batch_id")
    p = requests.progress(F.col("succeeded") + F.col("failed"), F.col("total"), F.col("seconds"))
    return counted.select("batch_id", p.alias("p")).select("batch_id", *(F.round(f"p.{c}", 6).alias(c) for c in ("percent", "rate", "eta")))


def batch_counts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select("o_orderkey", requests.batch_count(F.col("o_custkey"), F.col("o_orderkey") % 7).alias("batches"))


def backoff(s: SparkSession, d: str) -> DataFrame:
    wait = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderkey") % 90)
    return table(s, d, "orders").select("o_orderkey", requests.backoff_seconds(F.col("o_orderkey") % 9, 2.0, 30.0, wait).alias("seconds"))


def poll_outcomes(s: SparkSession, d: str) -> DataFrame:
    """Events of a user as polls of a job."""
    total, pending = F.when(F.col("value") < 20, 0).otherwise(F.col("value").cast("int")), F.when(F.col("value") > 200, 0).otherwise(1)
    polls = table(s, d, "events").select("user_id", "ts", "event_id", total.alias("total"), pending.alias("pending"))
    return batches.poll_outcomes(polls, "user_id", ["ts", "event_id"], "total", "pending", 2)


def second_pass(s: SparkSession, d: str) -> DataFrame:
    """Requests whose caption is missing, blank or the prompt."""
    c = table(s, d, "caption")
    return batches.second_pass(table(s, d, "request_map"), c.select("request_id", F.col("caption").alias("t")), c.select("request_id", F.col("prompt").alias("t")), "request_id", "t")


def newest_states(s: SparkSession, d: str) -> DataFrame:
    return state.newest_states(table(s, d, "batch_state"), table(s, d, "request_map"), "provider")


def log_merge(s: SparkSession, d: str) -> DataFrame:
    """The log of two taggers' runs with that of the others."""
    runs = table(s, d, "item_tags").select(F.concat_ws("/", "repo", "item").alias("path"), F.array("tagger").alias("taggers"), F.col("tagged_at").cast("string").alias("processed_at"), "tagger")
    old = F.col("tagger").isin("wd14", "pixai")
    merged = state.merge_log(runs.where(old).drop("tagger"), runs.where(~old).drop("tagger"))
    return merged.select("path", F.array_join("taggers", ",").alias("taggers"), "processed_at")


def candidate_texts(s: SparkSession, d: str) -> DataFrame:
    """A caption, else its used tags, of the batches of a known provider."""
    known = table(s, d, "batch_state").select("batch_id", F.lit(True).alias("ok")).distinct()
    c = ordered.with_group(table(s, d, "caption"), known, "batch_id")
    return c.select("caption_id", requests.candidate_text(F.col("caption"), F.col("tags_used"), F.coalesce("ok", F.lit(False))).alias("text"))


def usage_nested(s: SparkSession, d: str) -> DataFrame:
    """Token counts under either of two paths."""
    inner = F.concat(F.lit('{"usage": {"prompt_tokens": '), F.get_json_object("props", "$.k"), F.lit(', "completion_tokens": "x", "total_tokens": 3}}'))
    raw = F.when(F.col("event_id") % 2 == 0, inner).otherwise(F.concat(F.lit('{"response": '), inner, F.lit("}")))
    return table(s, d, "events").select("event_id", requests.usage(raw).alias("u")).select("event_id", "u.*")


def name_checks(s: SparkSession, d: str) -> DataFrame:
    """Which vocabulary names would do as a split, as a trigger and as an uploaded chunk."""
    chunk = F.concat(F.lit("zips/chunk_"), "tag_id", F.lit(".zip"))
    return table(s, d, "tag_vocab").select("tag_id", requests.valid_split(F.col("name")).alias("split"), requests.valid_trigger(F.col("name")).alias("trigger"), requests.known_upload(chunk, "zips").alias("chunk"))


def chunk_window(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "part").where(requests.in_window(F.col("p_size"), 10, 20) | requests.in_window(F.col("p_size"), 40)).select("p_partkey")


def tag_categories(s: SparkSession, d: str) -> DataFrame:
    """How many uses of each category the items' tags have."""
    names = F.create_map(*(F.lit(x) for kv in CATEGORY.items() for x in kv))
    used = table(s, d, "item_tags").select("repo", F.explode("tags").alias("tag")).where("tag is not null")
    return joins.with_categories(used, table(s, d, "tag_vocab"), ["repo"], category=names[F.col("category")]).groupBy("repo", "category").agg(F.count("*").alias("n"))


def references(s: SparkSession, d: str) -> DataFrame:
    """Repositories and files in addresses made of listings."""
    p = table(s, d, "packing_input").select("repo", "rel").distinct()
    address = F.concat(F.lit("https://huggingface.co/datasets/"), "repo", F.lit("/resolve/main/"), "rel")
    f = text.file_reference(address)
    return p.select("repo", "rel", f["repo"].alias("of"), f["filename"].alias("file"), text.lenient_reference(address).alias("lenient"), text.lenient_reference(F.col("rel")).alias("short"))


def auto_repo_ids(s: SparkSession, d: str) -> DataFrame:
    """Names of repositories to upload each folder to."""
    at = table(s, d, "manifest").select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder")).distinct()
    me = F.lit("me")
    return at.select("folder", text.auto_repo_id(me, F.col("folder"), seed=F.lit("Seed")).alias("seeded"), text.auto_repo_id(me, F.col("folder"), "images-txt").alias("images"), text.auto_repo_id(me, F.col("folder"), "report").alias("report"))


def queries() -> dict[str, Query]:
    """Name to query."""
    own = (request_build, prompt_hashes, vars_hash, data_uris, text_only, naive_render, position_join, frame_remap, custom_id_join, result_files, frame_context)
    more = (progress, batch_counts, backoff, poll_outcomes, second_pass, newest_states, log_merge, candidate_texts, usage_nested, name_checks, chunk_window)
    return {f.__name__: f for f in (*own, *more, tag_categories, references, auto_repo_ids)}


def _repo_name(name: str) -> str:
    dashed = f"regexp_replace(regexp_replace(lower(trim({name})), '[^a-zA-Z0-9._-]+', '-', 'g'), '-{{2,}}', '-', 'g')"
    return f"'me/' || coalesce(nullif(trim(left(trim({dashed}, '-.'), 96), '-.'), ''), 'dataset')"


def oracle_sql() -> dict[str, str]:
    """The same in SQL."""
    latest = "latest AS (SELECT * FROM request_map QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY updated_at DESC, log_id DESC) = 1)"
    last = "regexp_extract(rtrim(folder, '/'), '[^/]*$')"
    frames = " || ".join(f"chr(10) || 'Frame {i}: ' || coalesce(f{i}, '(no tags)')" for i in range(5))
    wait = "CASE WHEN o_orderkey % 5 = 0 THEN (o_orderkey % 90)::DOUBLE END"
    return {
        "request_build": """SELECT caption_id, json_object('custom_id', request_id || '#' || caption_id, 'messages', json_array(json_object('role', 'system', 'content', coalesce(style, '')),
            json_object('role', 'user', 'content', coalesce(prompt, ''))), 'response_format', json_object('type', 'json_object'))::VARCHAR AS request FROM caption""",
        "prompt_hashes": "SELECT caption_id, sha256(prompt) AS hash FROM caption",
        "vars_hash": """WITH e AS (SELECT batch_id, list_sort(map_entries(prompt_vars)) AS es FROM batch_state)
            SELECT batch_id, sha256('{' || coalesce(array_to_string(list_transform(es, lambda e: to_json(e.key)::VARCHAR || ':' || to_json(e.value)::VARCHAR), ','), '') || '}') AS hash,
              coalesce(array_to_string(list_transform(es, lambda e: e.key || '=' || e.value), ', '), '') AS said FROM e""",
        "data_uris": "SELECT doc_id, 'data:text/plain;base64,' || to_base64(encode(text)) AS uri FROM documents",
        "text_only": "SELECT caption_id, coalesce(nullif(array_to_string(list_filter([prompt, style], lambda x: x IS NOT NULL), chr(10)), ''), '(no prompt)') AS text FROM caption",
        "naive_render": "SELECT caption_id, replace(replace(replace('Write {style} for {request}: {prompt}', '{style}', coalesce(style, '')), '{request}', coalesce(request_id, '')), '{prompt}', coalesce(prompt, '')) AS text FROM caption",
        "position_join": """WITH a AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY request_id) AS place FROM (SELECT DISTINCT batch_id, request_id FROM request_map)),
            t AS (SELECT batch_id, caption_id, row_number() OVER (PARTITION BY batch_id ORDER BY caption_id) AS place FROM caption)
            SELECT batch_id, place, request_id, caption_id FROM a LEFT JOIN t USING (batch_id, place)""",
        "frame_remap": """WITH r AS (SELECT repo || '/' || item AS video, tagged_at, tagger, coalesce(array_to_string(tags, ','), '') AS tags FROM item_tags),
            l AS (SELECT * FROM r WHERE tags <> '' QUALIFY row_number() OVER (PARTITION BY video ORDER BY tagged_at DESC, tagger DESC, tags DESC) = 1)
            SELECT video, coalesce(l.tags, '') AS tags FROM (SELECT DISTINCT video FROM r) LEFT JOIN l USING (video)""",
        "custom_id_join": "SELECT log_id, m.path AS path FROM request_map r JOIN (SELECT DISTINCT path FROM manifest WHERE path IS NOT NULL) m ON sha1(r.path) = sha1(m.path)",
        "result_files": """WITH a AS (SELECT request_id, path, path_rel FROM request_map QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY path DESC NULLS LAST, path_rel DESC NULLS LAST) = 1),
            m AS (SELECT DISTINCT path FROM manifest WHERE path IS NOT NULL)
            SELECT request_id, coalesce(x.path, y.path) AS file FROM (SELECT DISTINCT request_id FROM caption) JOIN a USING (request_id) LEFT JOIN m x ON x.path = a.path LEFT JOIN m y ON y.path = a.path_rel""",
        "frame_context": f"""WITH f AS (SELECT l_orderkey, {", ".join(f"max(l_partkey::VARCHAR) FILTER (l_linenumber = {i + 1}) AS f{i}" for i in range(5))} FROM lineitem GROUP BY 1)
            SELECT o_orderkey, 'Description: ' || o_orderpriority || {frames} || chr(10) || 'Tags: ' || o_orderstatus AS prompt FROM orders LEFT JOIN f ON o_orderkey = l_orderkey""",
        "progress": f"""WITH {latest}, c AS (SELECT batch_id, count(*) AS total, count(*) FILTER (state = 'succeeded' OR starts_with(state, 'failed')) AS done FROM latest GROUP BY 1),
            t AS (SELECT batch_id, max(updated_at) - min(updated_at) AS seconds FROM request_map GROUP BY 1),
            r AS (SELECT batch_id, total, done, CASE WHEN seconds > 0 THEN done / seconds END AS rate FROM c LEFT JOIN t ON c.batch_id IS NOT DISTINCT FROM t.batch_id)
            SELECT batch_id, round(done * 100.0::DOUBLE / total, 6) AS percent, round(rate, 6) AS rate, round(CASE WHEN rate > 0 THEN (total - done) / rate END, 6) AS eta FROM r""".replace("SELECT batch_id, total, done, CASE", "SELECT c.batch_id, total, done, CASE"),
        "batch_counts": "SELECT o_orderkey, (CASE WHEN o_orderkey % 7 > 0 THEN (o_custkey + o_orderkey % 7 - 1) // (o_orderkey % 7) ELSE 0 END)::BIGINT AS batches FROM orders",
        "backoff": f"SELECT o_orderkey, coalesce({wait}, least(30.0::DOUBLE, 2.0::DOUBLE * pow(2.0::DOUBLE, o_orderkey % 9))) AS seconds FROM orders",
        "poll_outcomes": """WITH p AS (SELECT *, CASE WHEN value < 20 THEN 0 ELSE trunc(value)::INT END AS total, CASE WHEN value > 200 THEN 0 ELSE 1 END AS pending FROM events),
            m AS (SELECT *, sum(CASE WHEN total = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM p),
            s AS (SELECT user_id, max(run) AS streak FROM (SELECT user_id, island, count(*) FILTER (total = 0) AS run FROM m GROUP BY 1, 2) GROUP BY 1),
            d AS (SELECT user_id, count(*) AS polls, bool_or(total > 0 AND pending = 0) AS done FROM p GROUP BY 1)
            SELECT user_id, polls, CASE WHEN done THEN 'done' WHEN streak >= 2 THEN 'empty' ELSE 'open' END AS outcome FROM d JOIN s USING (user_id)""",
        "second_pass": """WITH c AS (SELECT request_id, max(caption) AS now, max(prompt) AS old FROM caption GROUP BY 1)
            SELECT request_id FROM (SELECT DISTINCT request_id FROM request_map) LEFT JOIN c USING (request_id) WHERE regexp_full_match(coalesce(now, ''), '[\\s\\p{Z}]*') OR now IS NOT DISTINCT FROM old""",
        "newest_states": """SELECT provider, (arg_max(batch_id, struct_pack(a := created_at, b := batch_id)) FILTER (batch_id IN (SELECT batch_id FROM request_map))) AS batch_id FROM batch_state GROUP BY 1""",
        "log_merge": "SELECT concat_ws('/', repo, item) AS path, string_agg(DISTINCT tagger, ',' ORDER BY tagger) AS taggers, max(rtrim(rtrim(strftime(tagged_at, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.')) AS processed_at FROM item_tags GROUP BY 1",
        "candidate_texts": """SELECT caption_id, CASE WHEN batch_id IN (SELECT batch_id FROM batch_state) THEN coalesce(nullif(caption, ''), nullif(array_to_string(list_filter(tags_used, lambda t: t IS NOT NULL), ''), '')) END AS text FROM caption""",
        "usage_nested": "SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS BIGINT), 0) AS prompt, 0::BIGINT AS completion, CASE WHEN json_extract_string(props, '$.k') IS NULL THEN 0 ELSE 3 END::BIGINT AS total FROM events",
        "name_checks": "SELECT tag_id, regexp_full_match(name, '[A-Za-z0-9_-]+') AS split, NOT regexp_matches(name, '[=\\s]') AS trigger, regexp_full_match(tag_id, '\\d+') AS chunk FROM tag_vocab",
        "chunk_window": "SELECT p_partkey FROM part WHERE p_size BETWEEN 10 AND 20 OR p_size >= 40",
        "tag_categories": """WITH v AS (SELECT tag_id, name, category, unnest(list_distinct([lower(trim(name)), replace(lower(trim(name)), '_', ' ')])) AS spelling FROM tag_vocab),
            l AS (SELECT spelling, CASE category WHEN '0' THEN 'general' WHEN '3' THEN 'copyright' WHEN '4' THEN 'character' WHEN '9' THEN 'rating' END AS category FROM v QUALIFY row_number() OVER (PARTITION BY spelling ORDER BY tag_id DESC, name DESC) = 1),
            u AS (SELECT repo, unnest(tags) AS tag FROM item_tags)
            SELECT repo, coalesce(category, 'general') AS category, count(*) AS n FROM u LEFT JOIN l ON lower(trim(tag, ' ')) = spelling WHERE tag IS NOT NULL GROUP BY 1, 2""",
        "references": """WITH p AS (SELECT DISTINCT repo, rel, 'https://huggingface.co/datasets/' || repo || '/resolve/main/' || rel AS a FROM packing_input)
            SELECT repo, rel, nullif(regexp_extract(a, '^https?://huggingface\\.co/(?:datasets/)?([a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+)/resolve/[^/]+/([^?#]+)', 1), '') AS of,
              nullif(regexp_extract(a, '^https?://huggingface\\.co/(?:datasets/)?([a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+)/resolve/[^/]+/([^?#]+)', 2), '') AS file,
              nullif(regexp_extract(regexp_replace(trim(a), '^https?://huggingface\\.co/(?:datasets/)?', ''), '^([^/]+/[^/?#]+)', 1), '') AS lenient, nullif(regexp_extract(trim(rel), '^([^/]+/[^/?#]+)', 1), '') AS short FROM p""",
        "auto_repo_ids": f"""WITH f AS (SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder FROM manifest)
            SELECT folder, {_repo_name(f"'Seed-' || {last}")} AS seeded, {_repo_name(f"{last} || '-images-txt'")} AS images, {_repo_name(f"{last} || '-report'")} AS report FROM f""",
    }
