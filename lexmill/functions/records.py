"""Scalars over raw records: citations, ids in URLs, contracts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import column

# Fields that a server sets anew on each read.
VOLATILE_FIELDS = ("date_created", "date_modified", "resource_uri", "absolute_url")
CITATION_VOLATILE = ("date_created", "date_modified")
# Kinds of values: the types that a parser gives them, and what their JSON looks like. Messages.
KINDS = {"integer": (int, r"^(-?[0-9]+|true|false)$"), "array": (list, r"^\s*\["), "object": (dict, r"^\s*\{")}
ABSENT, OTHER_KIND = "'{}' is absent", "'{}' is no {}"


def clean_citations(citations: Column | str) -> Column:
    """Citations without the fields that change from read to read."""
    return F.transform(column(citations), lambda c: F.struct(c["reporter"].alias("reporter"), c["volume"].alias("volume"), c["page"].alias("page"), c["type"].alias("type")))


def first_citation(citations: Column | str, reporter: str = "U.S.") -> Column:
    """Volume, page and text of the first usable citation of ``reporter``; nulls if none is.

    A volume has digits alone and loses leading zeros; a page isn't blank, nor the number zero.
    """
    usable = F.filter(
        column(citations),
        lambda c: (c["reporter"] == reporter) & c["volume"].rlike("^[0-9]+$") & c["page"].isNotNull() & c["page"].rlike(r"(?U)\S"),
    )
    first = F.get(usable, F.lit(0))
    volume = first["volume"].cast("int")
    cite = F.when(first.isNotNull(), F.concat_ws(" ", volume.cast("string"), F.lit(reporter), first["page"]))
    return F.struct(volume.alias("volume"), first["page"].alias("page"), cite.alias("cite"))


def id_in_url(url: Column | str) -> Column:
    """The number that a URL's last path segment is."""
    return F.nullif(F.regexp_extract(F.coalesce(column(url), F.lit("")), "([0-9]+)/*$", 1), F.lit("")).cast("long")


def parent_of(parent_id: Column | str, url: Column | str) -> Column:
    """The parent's id: the field if it is set, else the number in the URL."""
    return F.coalesce(column(parent_id).cast("long"), id_in_url(url))


def declared_children(urls: Column | str) -> Column:
    """Ids in a list of URLs, in order."""
    return F.transform(F.coalesce(column(urls), F.array().cast("array<string>")), id_in_url)


def text_or_none(value: Column | str) -> Column:
    """A value as text; null becomes the word that the published citations have for it."""
    return F.coalesce(column(value).cast("string"), F.lit("None"))


def contract_violations(record: Column | str, required: tuple[str, ...], kinds: dict[str, str]) -> Column:
    """What is wrong with a JSON record: required keys that are absent, values of another kind.

    ``kinds`` maps keys to ``integer``, ``array`` or ``object``; null passes any of them.
    """
    record = column(record)
    keys = F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))
    found = [F.when(~F.array_contains(keys, k), F.lit(ABSENT.format(k))) for k in required]
    for key, kind in kinds.items():
        value = F.get_json_object(record, f"$.{key}")
        found.append(F.when(value.isNotNull() & ~value.rlike(KINDS[kind][1]), F.lit(OTHER_KIND.format(key, kind))))
    return F.array_compact(F.array(*found))


def violations_of(record: dict, required: tuple[str, ...], kinds: dict[str, str]) -> list[str]:
    """The same for a record that is parsed already."""
    wrong = [ABSENT.format(k) for k in required if k not in record]
    return wrong + [OTHER_KIND.format(k, kind) for k, kind in kinds.items() if not isinstance(record.get(k), (KINDS[kind][0], type(None)))]
