"""Math, code and markup inside text.

One pattern cuts a text into tokens: closed math or code spans, escape pairs,
runs of anything else. It has the same meaning in Java and in Python, so masking
is a Column expression, and the operators that edit by offset reuse it in Arrow
functions. What doesn't close leaves its opener behind as a token of its own,
and the text is then left alone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_BODY = r"(?>(?!{0})(?:\\[\s\S]|[\s\S]))*+{0}"
TOKEN = "|".join(
    (
        r"\$\$" + _BODY.format(r"\$\$"),
        r"\\\(" + _BODY.format(r"\\\)"),
        r"\\\[" + _BODY.format(r"\\\]"),
        r"\$(?!\$)" + _BODY.format(r"\$"),
        r"(`++)" + _BODY.format(r"\1"),
        r"\\[\s\S]",
        r"[^\\$`]++",
        r"[\s\S]",
    )
)
#: Tokens that are an opener without its closer.
OPENERS = ("$", "`", r"\(", r"\[")
TAG = r"<[^>]*>"
SPAN_START = r"^(?:[$`]|\\[(\[])"

# Inline math, and what a price looks like between two dollars.
INLINE_MATH = r"(?<![\\$])\$(?!\$)((?:\\.|[^$\\])*)(?<!\\)\$(?!\$)"
PRICE = r"\d[\d.,]*\s+[A-Za-z\s]+"
# Characters that a Markdown cell escapes, and its entities.
CELL_ESCAPES = "\\|*_`[]$"
CELL_ENTITIES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"))

_TOKEN, _TAG, _INLINE, _PRICE = (re.compile(p) for p in (TOKEN, TAG, INLINE_MATH, PRICE))
_ESCAPE = re.compile("([" + re.escape(CELL_ESCAPES) + "])")
#: White space as Python sees it, for Java patterns with (?U).
WS = r"\s\x1c-\x1f"


# --- Columns ---------------------------------------------------------------


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def mask_math(text: Column) -> Column:
    """text with math and code spans blanked to the same length; null if one doesn't close."""
    parts = tokens(text)
    blanked = F.array_join(F.transform(parts, lambda t: F.when(t.rlike(SPAN_START), F.repeat(F.lit(" "), F.length(t))).otherwise(t)), "")
    return F.when(~F.exists(parts, lambda t: t.isin(*OPENERS)), blanked)


def mask_tags(text: Column) -> Column:
    """text with markup tags blanked to the same length."""
    gaps, tags = F.split(text, TAG, -1), F.regexp_extract_all(text, F.lit(TAG), F.lit(0))
    return F.array_join(F.zip_with(gaps, tags, lambda g, t: F.concat(g, F.coalesce(F.repeat(F.lit(" "), F.length(t)), F.lit("")))), "")


def visible_prose(text: Column) -> Column:
    return mask_math(mask_tags(text))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^[{WS}]+|[{WS}]+\z", "")


def escape_cell(text: Column) -> Column:
    out = F.regexp_replace(text, "([" + re.escape(CELL_ESCAPES) + "])", r"\\$1")
    for char, entity in CELL_ENTITIES:
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


# --- The same on strings, for Arrow functions ------------------------------


def scan(text: str) -> tuple[str | None, set[int]]:
    """(text with spans blanked, or None if one doesn't close; where its top-level tokens start)"""
    out, starts, at = [], set(), 0
    for m in _TOKEN.finditer(text):
        t = m[0]
        if t in OPENERS:
            return None, starts
        starts.add(at)
        at += len(t)
        out.append(" " * len(t) if t[0] in "$`" or t[:2] in (r"\(", r"\[") else t)
    return "".join(out), starts


def blank_tags(text: str) -> str:
    return _TAG.sub(lambda m: " " * len(m[0]), text)


def prose(text: str) -> str | None:
    return scan(blank_tags(text))[0]


def inline_formulas(text: str, prices: bool = False) -> list[re.Match[str]]:
    """Matches of $...$ that start at a top-level dollar; with prices, also those that look like two prices."""
    masked = blank_tags(text)
    visible, starts = scan(masked)
    if visible is None:
        return []
    found = [m for m in _INLINE.finditer(text) if m.start() in starts and masked[m.start()] == "$"]
    return found if prices else [m for m in found if not (text[m.end() : m.end() + 1].isdigit() and _PRICE.fullmatch(m[1]))]


def _touches(char: str) -> bool:
    return char.isalnum() or char == "_"


def tidy_inline(text: str) -> str:
    """Formulas trimmed inside their dollars, and kept off the words beside them."""
    out, at = [], 0
    for m in inline_formulas(text):
        before, after = text[: m.start()][-1:], text[m.end() :][:1]
        out += [text[at : m.start()], " " if before and _touches(before) else "", f"${m[1].strip()}$", " " if after and _touches(after) else ""]
        at = m.end()
    return "".join(out) + text[at:]


def escaped(text: str) -> str:
    text = _ESCAPE.sub(r"\\\1", text)
    for char, entity in CELL_ENTITIES:
        text = text.replace(char, entity)
    return text


def cell_markdown(text: str) -> str | None:
    """A cell's Markdown with its formulas as they are; None if one can't stand in a cell."""
    text = tidy_inline(text)
    out, at = [], 0
    for m in inline_formulas(text):
        if set("|\n") & set(m[1]):
            return None
        out += [escaped(text[at : m.start()]), m[0]]
        at = m.end()
    return "".join(out) + escaped(text[at:])
