"""Markup as text in Spark's own functions, where it is plain enough; a Python worker renders the rest.

Plain markup is tiled by one regular expression: comments without dashes, a document type, scripts and
styles as a whole, page numbers as a whole, tags with quoted attributes, text and a few entities. It has
only characters that Unicode's normal form leaves alone, and asterisks in page numbers alone. A row whose
tiles don't cover it goes to ``render_markup``, which parses anything; for the others that function gets a null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.arrow import ANCHOR_CHARS, ANCHOR_WORDS, BLOCK_ELEMENTS, MARK, RENDERED, render_markup
from lexmill.functions.text import before_each, bound

# Entities that are decoded here, the ampersand last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
ATTRIBUTES = r"""(?: [a-z][a-z-]*="[^"<>&]*")*"""
RAW = rf"<(?:script|style){ATTRIBUTES}>(?:(?!</(?:script|style))[\s\S])*+</(?:script|style)>"
NUMBER = r"<page-number>[^<&]*</page-number>"
TILE = "|".join((r"<!--[^->]*-->", r"<!DOCTYPE html>", RAW, NUMBER, rf"<(?!script|style|page-number|textarea|xmp|iframe|noembed|noframes|plaintext|noscript|svg|math)[a-z][a-z0-9]*{ATTRIBUTES} ?/?>", r"</(?!script|style|page-number)[a-z][a-z0-9]*>", "[^<&]+", *(e for e, _ in ENTITIES)))
#: What plain markup has none of: characters that may change, page numbers as spans, raw text that another tag ends.
ODD = r"[^\x09\x0A\x20-\x7E¡-˿]|star-pagination|<script(?:(?!</script)[\s\S])*+</style|<style(?:(?!</style)[\s\S])*+</script"


def is_plain(markup: Column) -> Column:
    marks = F.contains(F.regexp_replace(markup, NUMBER, ""), F.lit("*"))  # a mark in brackets may arise where tags go
    return ~markup.rlike(ODD) & ~marks & (F.regexp_replace(markup, TILE, "") == "")


def shown(tile: Column) -> Column:
    """What a tile leaves: text as it reads, a line break, a mark, or nothing."""
    decoded = tile
    for entity, character in ENTITIES:
        decoded = F.replace(decoded, F.lit(entity), F.lit(character))
    return (
        F.when(~tile.startswith("<"), decoded).when(tile.startswith("<!"), "").when(tile.startswith("<page-number>"), MARK)
        .when(tile.rlike("^<(script|style)"), F.regexp_replace(tile, "^<[^>]*>|</[a-z]+>$", ""))
        .when(tile.rlike(rf"^</?({'|'.join(sorted(BLOCK_ELEMENTS))})[ />]"), "\n").otherwise("")
    )


def label_of(tile: Column) -> Column:
    inner = F.regexp_replace(F.regexp_replace(tile, "^<page-number>|</page-number>$", ""), r"^\*+", "")
    return F.nullif(F.regexp_replace(inner, r"^[ \n\t]+|[ \n\t]+$", ""), F.lit(""))


def tidied(text: Column) -> Column:
    for pattern, new in ((r"[ \t]+", " "), (r" *\n *", "\n"), (r"\n{3,}", "\n\n"), (r"^[ \n]+|[ \n]+$", "")):
        text = F.regexp_replace(text, pattern, new)
    return text


def assembled(parts: Column, labels: Column) -> Column:
    """Text and page breaks of the parts between marks."""

    def breaks(text: Column, places: Column) -> Column:
        def one(label: Column, i: Column) -> Column:
            place = F.get(places, i + 1)
            offset = place + F.length(F.regexp_extract(F.substr(text, (place + 1).cast("int")), r"^[ \n\t]*", 0))
            words = F.array_remove(F.split(F.substr(text, (offset + 1).cast("int"), F.lit(ANCHOR_CHARS)), r"[ \n\t]+"), "")
            return F.struct((i + 1).alias("ordinal"), label.alias("page_label"), offset.cast("long").alias("char_offset"), F.array_join(F.slice(words, 1, ANCHOR_WORDS), " ").alias("anchor"))

        return F.struct(text.alias("clean_text"), F.transform(labels, one).alias("page_breaks"))

    text, lengths = F.array_join(parts, ""), F.transform(parts, lambda p: F.length(p).cast("long"))
    return bound(text, lambda t: bound(before_each(lengths), lambda places: breaks(t, places)))


def plain_rendered(markup: Column) -> Column:
    def of(tiles: Column) -> Column:
        labels = F.transform(F.filter(tiles, lambda t: t.startswith("<page-number>")), label_of)
        return bound(F.split(tidied(F.array_join(F.transform(tiles, shown), "")), MARK), lambda parts: assembled(parts, labels))

    return bound(F.regexp_extract_all(markup, F.lit(TILE), F.lit(0)), of)


def rendered(markup: Column) -> Column:
    """``clean_text`` and ``page_breaks``, as ``render_markup`` has them."""
    text = F.coalesce(markup, F.lit(""))
    plain = is_plain(text)
    return F.when(plain, plain_rendered(text).cast(RENDERED)).otherwise(render_markup(F.when(~plain, text)))
