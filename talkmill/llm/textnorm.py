"""Text normalisation shared by the llm operators (runs inside Arrow batches)."""

from __future__ import annotations

import html
import re
import unicodedata

import regex

#: Markup that may stand in a text without being a template slot.
TAGS = re.compile(r"</?(?:b|i|u|p|br|em|strong|span|div|a|li|ul|ol|h[1-6]|td|tr|table|font|img|hr|code|pre|html|body|head|title)\b[^<>]{0,200}>", re.I)
SPECIAL = re.compile(r"<\|[a-z_]{1,40}\|>|\[/?(?:INST|CLS|SEP|MASK|PAD|UNK)\]|</?s>", re.I)

INVISIBLE = regex.compile(r"[[\p{Cc}\p{Cf}]--[\n\t]]+", regex.V1)
MARKS = regex.compile(r"\p{M}+")


_COMMON_MARKS = re.compile("[\u0300-\u036f]+")


def plain(text: str) -> str:
    """Compatibility form without format and control characters, markup tags, special-token strings and entities; newlines stay.

    Each step is skipped where a cheap test shows that it has nothing to do.
    """
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    if "<" in text:
        text = TAGS.sub("", text)
    if "<" in text or "[" in text:
        text = SPECIAL.sub("", text)
    if text.isprintable() or text.replace("\n", "").replace("\t", "").isprintable():
        return text
    return INVISIBLE.sub("", text)


def folded(text: str) -> str:
    """Lower case without accents."""
    if text.isascii():
        return text.lower()
    text = _COMMON_MARKS.sub("", unicodedata.normalize("NFKD", text))
    return (text if text.isascii() else MARKS.sub("", text)).lower()
