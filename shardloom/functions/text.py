"""Names, ids, source strings, prompts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_VAR = re.compile(r"\{([A-Za-z_][A-Za-z0-9_]*)\}")
_PAIR_NAME = r"[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+"

# What stands in a prompt where a value is missing.
NO_PRIOR_TAGS, NO_TAGS, NO_DESCRIPTION, NOT_AVAILABLE, NONE = "(no prior tags)", "(no tags)", "(no description)", "(not available)", "(none)"


def repo_name(name: Column) -> Column:
    """A repository name: lower-case, runs of other characters as one dash, at most 96 long, ``dataset`` if nothing is left."""
    s = F.regexp_replace(F.lower(F.trim(name)), r"[^a-zA-Z0-9._-]+", "-")
    s = F.btrim(F.left(F.btrim(F.regexp_replace(s, "-{2,}", "-"), F.lit("-.")), F.lit(96)), F.lit("-."))
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("dataset"))


def project_name(name: Column) -> Column:
    """Letters and digits of any script, ``-`` and ``_`` stay, others become ``_``."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_")


def source_kind(raw: Column) -> Column:
    """Kind of an input source; first rule that fits. Local folders are for the caller to look up."""
    s = F.trim(raw)
    hub = F.contains(s, F.lit("huggingface.co"))
    return (
        F.when(F.startswith(s, F.lit("https://mega.nz/")), "mega")
        .when(hub & F.contains(s, F.lit("/resolve/")), "hf_file")
        .when(hub | F.rlike(s, F.lit(f"^{_PAIR_NAME}$")), "hf_dataset")
        .otherwise("unknown")
    )


def dataset_reference(raw: Column) -> Column:
    """struct(repo, subfolder) of a dataset address or bare ``user/name``; both null for others."""
    s = F.trim(raw)
    address = rf"^https?://huggingface\.co/datasets/({_PAIR_NAME})(?:/tree/[^/]+/(.+))?"
    found = F.rlike(s, F.lit(address))
    bare = F.when(F.rlike(s, F.lit(f"^{_PAIR_NAME}$")), s)
    folder = F.nullif(F.regexp_replace(F.regexp_extract(s, address, 2), "/+$", ""), F.lit(""))
    return F.struct(F.when(found, F.regexp_extract(s, address, 1)).otherwise(bare).alias("repo"), F.when(found, folder).alias("subfolder"))


def file_reference(raw: Column) -> Column:
    """struct(repo, filename) of the direct address of a dataset's file; both null for others."""
    s = F.trim(raw)
    address = rf"^https?://huggingface\.co/(?:datasets/)?({_PAIR_NAME})/resolve/[^/]+/([^?#]+)"
    found = F.rlike(s, F.lit(address))
    return F.struct(F.when(found, F.regexp_extract(s, address, 1)).alias("repo"), F.when(found, F.regexp_extract(s, address, 2)).alias("filename"))


def lenient_reference(raw: Column) -> Column:
    """The repository of any address or name: its first two segments after the host and ``datasets``; null if there are fewer."""
    s = F.regexp_replace(F.trim(raw), r"^https?://huggingface\.co/(?:datasets/)?", "")
    return F.nullif(F.regexp_extract(s, r"^([^/]+/[^/?#]+)", 1), F.lit(""))


def auto_repo_id(namespace: Column, root: Column, kind: str = "", seed: Column | None = None) -> Column:
    """``namespace/name``: the name of a folder, after that of a seed, or before ``-kind``, as a repository name."""
    name = F.substring_index(F.rtrim(root, F.lit("/")), "/", -1)
    if seed is not None:
        name = F.concat(seed, F.lit("-"), name)
    if kind:
        name = F.concat(name, F.lit(f"-{kind}"))
    return F.concat(namespace, F.lit("/"), repo_name(name))


def request_id(rel: Column, path: Column) -> Column:
    """``req_`` and the SHA-1 of the relative path, or of the absolute one if the relative leaves its folder."""
    return F.concat(F.lit("req_"), F.sha1(F.when(F.startswith(rel, F.lit("..")), path).otherwise(F.coalesce(rel, path))))


def base_request_id(request: Column) -> Column:
    """Without the suffix of an attempt."""
    return F.regexp_replace(request, r"_a\d+$", "")


def state_file(name: Column, path: Column) -> Column:
    """Name of a batch's state file."""
    return F.concat(F.lit(".batch_state_"), name, F.lit("_"), F.substring(F.md5(path), 1, 10), F.lit(".json"))


def frame_file(stem: Column, path: Column, frame: Column) -> Column:
    """Name of an extracted frame."""
    return F.concat(stem, F.lit("_"), F.substring(F.md5(path), 1, 10), F.lit("_f"), frame.cast("string"), F.lit(".jpg"))


def template_vars(template: str) -> list[str]:
    """Names of a template's variables, sorted."""
    return sorted(set(_VAR.findall(template)))


def render(template: str, values: dict[str, Column]) -> Column:
    """The template with its variables replaced in one pass: values aren't expanded again and other braces stay.
    Unknown names raise ValueError; a null value makes the result null."""
    if missing := [v for v in template_vars(template) if v not in values]:
        raise ValueError(f"missing variables: {', '.join(missing)}")
    parts = _VAR.split(template)
    return F.concat(*(values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if i % 2 or p)) if len(parts) > 1 or template else F.lit("")


def with_context(tags: Column, existing: Column) -> Column:
    """Tags, followed by the existing text if there is any."""
    text = F.trim(existing)
    return F.when(F.coalesce(text, F.lit("")) != "", F.concat(tags, F.lit("\n\nExisting text:\n"), text)).otherwise(tags)


def error_line(text: Column, noise: str = r"^\s*(frame=|size=|Press )") -> Column:
    """The last line that isn't noise, at most 200 characters; else the last line, else ``unknown error``."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x) != "")
    told = F.filter(lines, lambda x: ~F.rlike(x, F.lit(noise)))
    return F.left(F.coalesce(F.try_element_at(told, F.lit(-1)), F.try_element_at(lines, F.lit(-1)), F.lit("unknown error")), F.lit(200))


def json_bytes(value: Column) -> Column:
    """UTF-8 bytes of a value's compact JSON."""
    return F.octet_length(F.to_json(value)).cast("bigint")


def parse_vars(pairs: list[str]) -> dict[str, str]:
    """``KEY=VALUE`` pairs, split at the first ``=`` and trimmed; the last of a key wins; a bad name raises ValueError."""
    out = {}
    for p in pairs:
        key, eq, value = p.partition("=")
        if not eq or not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", key.strip()):
            raise ValueError(f"not KEY=VALUE: {p}")
        out[key.strip()] = value.strip()
    return out
