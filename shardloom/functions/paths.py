"""Paths and file names."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.arrow_udf(T.StringType())
def nfc(values: pa.Array) -> pa.Array:
    """Unicode composition (NFC). A batch of ASCII, by far the most frequent, is passed on as it is."""
    if pc.all(pc.string_is_ascii(values)).as_py() is not False:
        return values
    return pa.array([v if v is None or v.isascii() else unicodedata.normalize("NFC", v) for v in values.to_pylist()], pa.string())


def plain_path(path: Column, rooted: bool | None = None) -> Column:
    """The one spelling of a path: NFC, ``/`` between segments, no empty or ``.`` segment, and ``..``
    removing the segment before it (at the start: itself). ``rooted``: whether the result starts with
    ``/``; None keeps what the path has. Null for null; a path without segments is ``/`` or empty."""
    path = F.replace(nfc(path), F.lit("\\"), F.lit("/"))
    parts = F.filter(F.split(path, "/"), lambda s: (s != "") & (s != "."))
    up = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(s))),
    )
    joined = F.array_join(F.when(F.contains(path, F.lit("..")), up).otherwise(parts), "/")
    if rooted is None:
        return F.when(F.startswith(path, F.lit("/")), F.concat(F.lit("/"), joined)).otherwise(joined)
    return F.concat(F.lit("/"), joined) if rooted else joined


def base_name(path: Column) -> Column:
    """What follows the last ``/``."""
    return F.substring_index(path, "/", -1)


def parent(path: Column) -> Column:
    """What precedes the last ``/``; empty without one."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def ext_of(path: Column) -> Column:
    """Lower-cased extension with its dot; empty for none. Leading dots of a name start no extension."""
    return F.lower(F.regexp_extract(base_name(path), r"^\.*[^.].*?(\.[^.]*)$", 1))


def stem_of(path: Column) -> Column:
    """The path without its extension."""
    return F.substring(path, F.lit(1), F.length(path) - F.length(ext_of(path)))


def hidden(path: Column) -> Column:
    """Whether a segment starts with a dot."""
    return F.rlike(path, F.lit(r"(^|/)\."))


def unfinished(path: Column) -> Column:
    """Whether the name is one that a copy in progress or an editor leaves."""
    return F.rlike(path, F.lit(r"(\.tmp|\.part|~)$"))
