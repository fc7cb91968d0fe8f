"""Requests to a captioning service: their JSON, payloads, hashes, checks, and what comes back."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardloom.functions.tags import strip
from shardloom.functions.text import NO_DESCRIPTION, NO_TAGS

#: Bytes of a payload without requests, and what each request beside another needs.
ENVELOPE, COMMA = len('{"batch_requests":[]}'), 1
# Answers of a service to which a batch is halved, and to which it is given up at once.
HALVED, FATAL = (400, 403, 404, 413, 422), (401, 402)


def message(role: str, content: Column) -> Column:
    """struct(role, content)."""
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def request_json(request_id: Column, system: Column, user: Column, json_answer: bool = True) -> Column:
    """A chat request as compact JSON. A null prompt counts as an empty one."""
    messages = F.array(message("system", F.coalesce(system, F.lit(""))), message("user", F.coalesce(user, F.lit(""))))
    fields = [request_id.alias("custom_id"), messages.alias("messages")]
    if json_answer:
        fields.append(F.struct(F.lit("json_object").alias("type")).alias("response_format"))
    return F.to_json(F.struct(*fields))


def data_uri(content: Column, media_type: str = "image/jpeg") -> Column:
    """Bytes as a data URI."""
    return F.concat(F.lit(f"data:{media_type};base64,"), F.replace(F.base64(content), F.lit("\r\n"), F.lit("")))


def jpeg_quality(asked: Column) -> Column:
    """Between 30 and 95."""
    return F.least(F.greatest(asked, F.lit(30)), F.lit(95)).cast("int")


def text_only(parts: Column) -> Column:
    """What remains of a message's parts (type, text) without images: its texts, a line each, or ``(no prompt)``."""
    texts = F.transform(F.filter(parts, lambda p: (p["type"] == "text") & p["text"].isNotNull()), lambda p: p["text"])
    return F.coalesce(F.nullif(F.array_join(texts, "\n"), F.lit("")), F.lit("(no prompt)"))


def text_hash(text: Column) -> Column:
    """SHA-256 of a text; null for null."""
    return F.sha2(text, 256)


def _quoted(text: Column) -> Column:
    """A text as a JSON string."""
    whole = F.to_json(F.array(text))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def map_hash(values: Column) -> Column:
    """SHA-256 of a map of strings as compact JSON, its keys in code-point order. A null map counts as an empty one."""
    pairs = F.transform(F.array_sort(F.map_entries(values)), lambda e: F.concat(_quoted(e["key"]), F.lit(":"), _quoted(e["value"])))
    return F.sha2(F.concat(F.lit("{"), F.coalesce(F.array_join(pairs, ","), F.lit("")), F.lit("}")), 256)


def value_hash(value) -> str:
    """SHA-256 of any value's canonical JSON: compact, keys sorted at every level."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def described(values: Column) -> Column:
    """``k=v`` of a map, sorted, joined by ``, ``; empty for an empty or null map."""
    return F.coalesce(F.array_join(F.transform(F.array_sort(F.map_entries(values)), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), ", "), F.lit(""))


def naive_render(template: Column, values: dict[str, Column]) -> Column:
    """Plain replacements one after the other: a value's own ``{name}`` is replaced by a later one, unlike in ``render``."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return template


def frame_context(description: Column, frames: list[Column], tags: Column) -> Column:
    """The prompt of a video: its description, a line for each frame's tags, and its own tags, or what stands for those missing."""
    parts = [F.concat(F.lit("Description: "), F.coalesce(F.nullif(strip(description), F.lit("")), F.lit(NO_DESCRIPTION)))]
    parts += [F.concat(F.lit(f"Frame {i}: "), F.coalesce(f, F.lit(NO_TAGS))) for i, f in enumerate(frames)]
    parts.append(F.concat(F.lit("Tags: "), F.coalesce(F.nullif(strip(tags), F.lit("")), F.lit(NO_TAGS))))
    return F.concat_ws("\n", *parts)


def backoff_seconds(attempt: Column, base: float = 1.0, most: float = 30.0, wait: Column | None = None) -> Column:
    """Seconds before an attempt, from 0, is repeated: ``base`` doubled each time, up to ``most``; what the service asks to
    wait comes first."""
    own = F.least(F.lit(float(most)), F.lit(float(base)) * F.pow(F.lit(2.0), attempt.cast("double")))
    return own if wait is None else F.coalesce(wait.cast("double"), own)


def batch_count(n: Column, size: Column) -> Column:
    """How many batches of ``size`` hold ``n``; 0 for a size that isn't above 0."""
    return F.when(size > 0, F.floor((n + size - 1) / size)).otherwise(F.lit(0)).cast("bigint")


def progress(done: Column, total: Column, seconds: Column) -> Column:
    """struct(percent, rate, eta): share done, items a second, and seconds to go, each null where it can't be told."""
    rate = F.try_divide(done.cast("double"), F.when(seconds > 0, seconds.cast("double")))
    return F.struct(F.try_divide(done * 100.0, total).alias("percent"), rate.alias("rate"), F.try_divide((total - done).cast("double"), F.when(rate > 0, rate)).alias("eta"))


def candidate_text(text: Column, parts: Column, succeeded: Column) -> Column:
    """A result's text, else the texts of its parts joined; null if its job didn't succeed or there is none."""
    joined = F.nullif(F.array_join(F.filter(parts, lambda p: p.isNotNull()), ""), F.lit(""))
    return F.when(succeeded, F.coalesce(F.nullif(text, F.lit("")), joined))


def usage(raw: Column) -> Column:
    """struct(prompt, completion, total) tokens of a response's JSON: under ``usage``, else under ``response.usage``;
    0 where there is no whole number."""
    def n(name: str) -> Column:
        found = F.coalesce(*(F.get_json_object(raw, f"$.{at}{name}") for at in ("usage.", "response.usage.")))
        return F.coalesce(found.try_cast("bigint"), F.lit(0))

    return F.struct(n("prompt_tokens").alias("prompt"), n("completion_tokens").alias("completion"), n("total_tokens").alias("total"))


def valid_split(name: Column) -> Column:
    """Whether a split's name holds letters, digits, ``_`` and ``-`` only, and one at least."""
    return F.coalesce(F.rlike(name, F.lit(r"\A[A-Za-z0-9_-]+\z")), F.lit(False))


def valid_trigger(word: Column) -> Column:
    """Whether a trigger word has neither ``=`` nor white space."""
    return F.coalesce(~F.rlike(word, F.lit(r"[=\s]")), F.lit(False))


def known_upload(path: Column, prefix: str, bootstrap: tuple[str, ...] = (".gitattributes", "README.md")) -> Column:
    """Whether a file of a repository is one that an upload may leave there: a bootstrap file or one of its own chunks."""
    return path.isin(*bootstrap) | F.rlike(path, F.lit(rf"\A\Q{prefix}\E/chunk_\d+\.zip\z"))


def in_window(index: Column, start: int, end: int = 0) -> Column:
    """Whether a chunk lies from ``start`` to ``end``, both inclusive; 0 is no end."""
    return (index >= start) & (F.lit(end == 0) | (index <= end))
