"""T-13 in columns: a page as a stream of tags and texts, and a state machine
over it.

One regex cuts the markup into tokens (comments, whole script and style
elements, declarations, tags, texts). A fold (``aggregate``) walks over them
with the stack of open tags and the text since the last tag, and notes each
text node with its parent. Nothing calls back into Python; malformed pages
never fail.

Rules for malformed input: void and self-closed tags are never opened; a
``<p>`` closes an open ``<p>`` and what is open inside it; an end tag closes
up to its matching open tag, or is ignored when none is open; a ``<`` that
starts no complete tag is text; a script, style or comment without an end runs
to the end of the page, a comment's ``<`` then being text.
"""

from __future__ import annotations

import json
from functools import reduce
from html.entities import html5
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import regex as rx

VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]

_RAW = "|".join(rf"<{tag}(?:[\s/][^>]*)?>.*?(?:</{tag}(?:[\s/][^>]*)?>|\z)" for tag in ("script", "style"))


def token_pattern(possessive: bool = True) -> str:
    """The tokens' regex. Java needs the possessive form, which never goes
    back into an attribute; an automaton engine takes the plain one."""
    more = "+" if possessive else ""
    tag = rf"""<[a-zA-Z](?:[^<>"']+{more}|"[^"]*"|'[^']*')*{more}>"""
    return rf"(?is)<!--.*?-->|{_RAW}|<![^>]*>|<\?[^>]*>|</[^>]*>|{tag}|[^<]+|<"


END_NAME = r"^</\s*([a-zA-Z][^\s/>]*)"
START_NAME = r"^<([a-zA-Z][^\s/>]*)"


def _token(t: Column) -> Column:
    """(kind, name, text): open, close, text, cut (ends a text) or none."""
    is_tag = (F.length(t) > 1) & t.startswith("<")
    start, end = F.lower(F.regexp_extract(t, START_NAME, 1)), F.lower(F.regexp_extract(t, END_NAME, 1))
    opens = (start != "") & ~start.isin(VOID_TAGS) & ~t.endswith("/>") & ~start.isin(["script", "style"])
    kind = (F.when(~is_tag, "text").when(end != "", "close").when(t == "</>", "none").when(opens, "open").otherwise("cut"))
    return F.struct(kind.alias("kind"), F.when(kind == "close", end).otherwise(start).alias("name"), t.alias("text"))


def _without(stack: Column, name: Column) -> Column:
    """The stack below its topmost ``name``; itself if there is none."""
    depth = F.array_position(F.reverse(stack), name).cast("int")
    return F.when(depth > 0, F.slice(stack, F.lit(1), F.size(stack) - depth)).otherwise(stack)


def text_nodes(html: Column) -> Column:
    """``array<struct<parent, text>>``: the text nodes of a page in order, as
    they stand in the markup (references not replaced)."""
    node = "struct<parent:string,text:string>"

    def step(state: Column, token: Column) -> Column:
        stack, text, kind, name = state["stack"], state["text"], token["kind"], token["name"]
        ends = kind.isin("open", "close", "cut") & (text != "")
        nodes = F.when(ends & (F.size(stack) > 0), F.concat(state["nodes"], F.array(F.struct(
            F.element_at(stack, -1).alias("parent"), text.alias("text"))))).otherwise(state["nodes"])
        base = F.when((kind == "close") | ((kind == "open") & (name == "p")), _without(stack, name)).otherwise(stack)
        return F.struct(
            F.when(kind == "open", F.concat(base, F.array(name))).otherwise(base).alias("stack"),
            F.when(kind == "text", F.concat(text, token["text"])).when(ends, F.lit("")).otherwise(text).alias("text"),
            nodes.alias("nodes"))

    tokens = F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(token_pattern()), 0), _token)
    last = F.struct(F.lit("cut").alias("kind"), F.lit("").alias("name"), F.lit("").alias("text"))
    start = F.struct(F.array().cast("array<string>").alias("stack"), F.lit("").alias("text"),
                     F.array().cast(f"array<{node}>").alias("nodes"))
    return F.aggregate(F.concat(tokens, F.array(last)), start, step)["nodes"]


# Names come from the standard library's table; those that stand without a
# semicolon may be followed by other letters.
_NAMED = json.dumps(html5)
_OPEN_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
_REFERENCE = r"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[^\t\n\f <&#;]{1,32};?|[^&]+|&"


def _cp1252() -> dict[str, str]:
    """What numbers 128 to 159 mean in pages: Windows characters."""
    found = {}
    for n in range(128, 160):
        try:
            found[str(n)] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            found[str(n)] = chr(n)
    return found


def _numbered(n: Column) -> Column:
    """The character of a number; U+FFFD for zero, surrogates and what is
    beyond the last one, nothing for control characters and non-characters."""
    point = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    windows = F.from_json(F.lit(json.dumps(_cp1252())), "map<string,string>")
    low = F.bitwise_not(F.lit(1).cast("bigint"))
    nothing = (n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF)
               | ((n % 0x10000).bitwiseAND(low) == 0xFFFE))
    return (F.when(n.isNull() | (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "�")
            .when(n.between(128, 159), F.element_at(windows, n.cast("string"))).when(nothing, "").otherwise(point))


def unescaped(text: Column) -> Column:
    """Character references replaced, as pages are read: names with the
    semicolon or, for the old ones, without; decimal and hexadecimal numbers."""
    named = F.from_json(F.lit(_NAMED), "map<string,string>")

    def piece(p: Column) -> Column:
        whole = F.element_at(named, F.substring(p, 2, 40))
        short = F.regexp_extract(p, "^&(" + _OPEN_NAMES + ")", 1)
        digits = F.regexp_extract(p, "^&#([0-9]+)", 1)
        hexes = F.regexp_extract(p, "^&#[xX]([0-9a-fA-F]+)", 1)
        by_name = F.coalesce(whole, F.when(short != "", F.concat(F.element_at(named, short), F.substr(p, F.length(short) + 2))), p)
        number = F.when(digits != "", F.conv(F.substring(F.regexp_replace(digits, "^0+", ""), 1, 10), 10, 10)).otherwise(
            F.conv(F.substring(F.regexp_replace(hexes, "^0+", ""), 1, 10), 16, 10))
        number = F.coalesce(F.when(number != "", number), F.lit("0")).cast("bigint")
        return F.when(~p.startswith("&"), p).when((digits != "") | (hexes != ""), _numbered(number)).otherwise(by_name)

    pieces = F.regexp_extract_all(text, F.lit(_REFERENCE), 0)
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, piece), "")).otherwise(text)


def title_and_body(html: Column, parents: list[str], blocked: list[str]) -> Column:
    """``struct<title, body>``: the texts in ``title`` tags, stripped; and the
    text nodes whose parent is one of ``parents`` and that hold none of the
    ``blocked`` phrases, joined by a space."""
    def walk(nodes: Column) -> Column:
        def text_of(n: Column) -> Column:
            return unescaped(n["text"])
        titles = F.transform(F.filter(nodes, lambda n: n["parent"] == "title"), text_of)
        kept = F.transform(F.filter(nodes, lambda n: n["parent"].isin(parents)), text_of)
        if blocked:
            kept = F.filter(kept, lambda t: ~reduce(or_, [t.contains(phrase) for phrase in blocked]))
        title = F.regexp_replace(F.array_join(titles, ""), "^" + rx.SPACE + "+|" + rx.SPACE + "+$", "")
        return F.struct(title.alias("title"), F.array_join(kept, " ").alias("body"))

    return F.transform(F.array(text_nodes(html)), walk)[0]
