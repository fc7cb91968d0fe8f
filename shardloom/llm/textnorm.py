"""Text normalisation shared by the text operators.

``canonical_words`` reduces a text to words in which case, accents, punctuation, spacing, invisible
characters, markup, quoting, line ends and ways of encoding a character make no difference.
"""

from __future__ import annotations

import html
import re
import unicodedata

_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})|\\x([0-9a-fA-F]{2})|%((?:[cC][2-9a-fA-F]|[dD][0-9a-fA-F]|[eE][0-9a-fA-F])(?:%[89abAB][0-9a-fA-F])+)")
_ESCAPED_BREAK = re.compile(r"\\[nrt]")
_TAG = re.compile(r"</?[A-Za-z][^<>]{0,200}>|<!--.*?-->", re.S)
_QUOTE = re.compile(r"(?m)^[ \t]*(?:[>|][ \t]?)+")
_HYPHEN_BREAK = re.compile(r"(?<=\w)[-‐‑][ \t]*(?:\r\n|\r|\n| | )\s*(?=\w)")
_INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁯︀-️﻿￹-￻]")
_EMPHASIS = re.compile(r"\*+|~~+|`+|(?<![^\W_])_+|_+(?![^\W_])")
# A run that can be UTF-8 read as Windows-1252: a lead byte's character and what follows it.
_MOJIBAKE = re.compile(r"[Â-ô](?:[\u0080-¿ŒœŠšŸŽžƒˆ˜–—‘-‚“-„†-•…‰‹›€™]){1,3}")
_MARKS = re.compile("[\u0300-\u036f\u0483-\u0487\u0591-\u05bd\u0610-\u061a\u064b-\u065f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\u3099\u309a\ufe20-\ufe2f]")
_WORD = re.compile(r"[^\W_]+")
# Cyrillic and Greek letters that look like Latin ones.
_LOOKALIKES = str.maketrans(
    "аеорсухіјѕԁһӏԛԝвкмнтАВЕКМНОРСТУХІЈЅ" + "αοερνικτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijsdhlqwbkmhtABEKMHOPCTYXIJS" + "aoepviktuxABEZHIKMNOPTYX",
)


def _from_bytes(run: str) -> str:
    raw = bytearray()
    for c in run:
        try:
            raw += c.encode("cp1252")
        except UnicodeEncodeError:
            if ord(c) > 0xFF:
                return run
            raw.append(ord(c))
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return run


def _unescape(m: re.Match) -> str:
    if m[1]:
        return chr(int(m[1], 16))
    if m[2]:
        return chr(int(m[2], 16))
    try:
        return bytes.fromhex(m[3].replace("%", "")).decode("utf-8")
    except ValueError:
        return m[0]


def repair(text: str) -> str:
    """Undo ways of encoding a character: HTML references, backslash escapes, wrongly decoded UTF-8."""
    if "&" in text:
        text = html.unescape(text)
    if "\\" in text or "%" in text:
        text = _ESCAPE.sub(_unescape, text)
        if any("\ud800" <= c <= "\udfff" for c in text):
            text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
        text = _ESCAPED_BREAK.sub("\n", text)
    for _ in range(2):
        if not _MOJIBAKE.search(text):
            break
        text = _MOJIBAKE.sub(lambda m: _from_bytes(m[0]), text)
    return text


def canonical_text(text: str) -> str:
    """The lower-case, accent-free, markup-free form, still with its separators."""
    text = repair(text)
    text = _INVISIBLE.sub("", text)
    if "<" in text:
        text = _TAG.sub("", text)
    text = _QUOTE.sub("", text)
    text = _HYPHEN_BREAK.sub("", text)
    text = _EMPHASIS.sub("", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        text = _MARKS.sub("", text)
        if re.search("[Ͱ-ϿЀ-ӿ]", text):
            text = text.translate(_LOOKALIKES)
    return text.casefold()


def canonical_words(text: str | None) -> list[str]:
    """The words of a text; none for null."""
    return _WORD.findall(canonical_text(text)) if text else []
