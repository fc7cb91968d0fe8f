"""Tags: spelling, order, post-processing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any script; F.trim alone knows only the space.
_WHITE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(text: Column) -> Column:
    """Without white space at its ends."""
    return F.btrim(text, F.lit(_WHITE))


def canonical_tag(tag: Column) -> Column:
    """Trimmed and lower-cased; with more than three characters ``_`` reads as a space and runs of spaces as one. Null if blank."""
    low = F.lower(strip(tag))
    spaced = F.replace(low, F.lit("_"), F.lit(" "))
    single = F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, " +", " ")).otherwise(spaced)
    return F.when(F.length(low) > 3, F.nullif(single, F.lit(" "))).otherwise(F.nullif(low, F.lit("")))


def remove_underscore(tag: Column) -> Column:
    """``_`` to space in tags of more than three characters, so that emoticons keep theirs."""
    return F.when(F.length(tag) > 3, F.replace(tag, F.lit("_"), F.lit(" "))).otherwise(tag)


def parse_replacements(spec: str) -> list[tuple[str, str]]:
    """The pairs of ``src,tgt;src,tgt``, with a backslash before ``,`` or ``;`` for the character itself. A pair is
    split at its first comma; what has none is skipped."""
    fields: list[list[str]] = [[""]]
    chars = iter(spec)
    for c in chars:
        if c == "\\":
            nxt = next(chars, "")
            fields[-1][-1] += nxt if nxt and nxt in ",;" else c + nxt
        elif c == ";":
            fields.append([""])
        elif c == "," and len(fields[-1]) == 1:
            fields[-1].append("")
        else:
            fields[-1][-1] += c
    return [(f[0], f[1]) for f in fields if len(f) == 2]


def replace_tags(tags: Column, pairs: list[tuple[str, str]]) -> Column:
    """Whole tags, one pair after the other, so that later pairs see what earlier ones made."""
    return reduce(lambda col, p: F.transform(col, lambda t: F.when(t == p[0], F.lit(p[1])).otherwise(t)), pairs, tags)


def drop_tags(tags: Column, unwanted: list[str]) -> Column:
    """Without the unwanted; repeated tags stay repeated."""
    return F.filter(tags, lambda t: ~t.isin(*unwanted)) if unwanted else tags


def first_tags(tags: Column, firsts: list[str]) -> Column:
    """Moves the first occurrence of each to the front, one after the other: the last one listed ends up first."""

    def move(col: Column, tag: str) -> Column:
        at = F.array_position(col, tag).cast("int")
        rest = F.concat(F.slice(col, F.lit(1), F.greatest(at - 1, F.lit(0))), F.slice(col, at + 1, F.size(col)))
        return F.when(at > 0, F.concat(F.array(F.lit(tag)), rest)).otherwise(col)

    return reduce(move, firsts, tags)


def postprocess(tags: Column, replacements: str = "", unwanted: list[str] | None = None, firsts: list[str] | None = None, underscores: bool = True) -> Column:
    """Underscores, replacements, unwanted tags, always-first tags, in this order."""
    if underscores:
        tags = F.transform(tags, remove_underscore)
    if replacements:
        tags = replace_tags(tags, parse_replacements(replacements))
    return first_tags(drop_tags(tags, unwanted or []), firsts or [])


def expand_character(tag: Column, sep: str = ", ") -> Column:
    """``name_(series)`` becomes ``name<sep>series``; other tags stay."""
    name = F.regexp_extract(tag, r"^(.*)\(([^(]*)\)$", 1)
    series = F.regexp_extract(tag, r"^(.*)\(([^(]*)\)$", 2)
    return F.when(F.rlike(tag, F.lit(r"\([^(]*\)$")), F.concat(F.regexp_replace(name, "_+$", ""), F.lit(sep), series)).otherwise(tag)


def with_category(tags: Column, lookup: Column) -> Column:
    """Appends `` (category)`` from the map ``lookup`` (keys as canonical_tag); blanks go, tags that name one already stay."""
    kept = F.filter(tags, lambda t: strip(t) != "")

    def mark(t: Column) -> Column:
        cat = F.try_element_at(lookup, F.lower(strip(t)))
        done = F.rlike(F.lower(t), F.lit(r"\((character|artist|copyright)\)\s*$"))
        return F.when(done | cat.isNull(), t).otherwise(F.concat(t, F.lit(" ("), cat, F.lit(")")))

    return F.transform(kept, mark)


def ordered_union(first: Column, second: Column, dedupe: bool = True) -> Column:
    """Both lists in order; each tag at its first place only."""
    empty = F.array().cast("array<string>")
    both = F.concat(F.coalesce(first, empty), F.coalesce(second, empty))
    return F.array_distinct(both) if dedupe else both
