"""Text functions as column expressions: captions, shingles, offsets, markers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.folding import without_marks

# Word lists whose members decide results.
STOP_WORDS = ("v", "the", "of", "a", "and", "et", "al", "in", "for")
MATCH_STOP_WORDS = ("v", "the", "of", "a", "and", "et", "al", "in")
DESCRIPTOR_WORDS = (
    "master", "claimant", "claimants", "others", "other", "administrator", "administratrix", "assignee", "executor", "executrix", "lessee",
    "surviving", "error", "use", "president", "directors", "company", "bank", "insurance", "ins", "co", "comp", "compy",
)
ROMAN_NUMERALS = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x")
DIRTY_TOKENS = (
    "juftice", "faid", "fuch", "thofe", "fhall", "prefent", "caufe", "becaufe", "firft", "conftitution", "congrefs", "houfe", "cafe", "fuit",
    "purpofe", "reafon", "perfon", "againft", "fubject", "prefident",
)
SUSPECT_TOKENS = (
    "juftice", "juftices", "firft", "muft", "fhall", "fuch", "thefe", "thofe", "becaufe", "caufe", "conftitution", "prefent", "reafon", "reafons",
    "perfon", "perfons", "fervice", "againft", "moft", "juft", "laft", "poffeffion", "poffeffed", "courfe", "confent", "defendant", "defendants",
    "faid", "fame", "fome", "fubject", "fuit", "ftate", "ftates", "fupreme", "houfe", "ufe", "ufed", "purfuant", "purpofe", "increafe", "expreffed",
    "tbe", "tbat", "tbis", "tbey", "tbem", "wbich", "wben", "wbere", "witb", "bad", "bave", "bim", "bis", "ber", "bere", "tbeir", "tbere", "otber", "wbo",
)
BOX_GLYPH = "■"


def column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often and wherever ``use`` names it.

    Without it the optimizer may copy the value's expression into a lambda and compute it there
    for every element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def caption_words(name: Column | str) -> Column:
    """Words of a caption in their order, with repeats and with those that are no token. A null has none."""
    text = F.replace(F.lower(F.coalesce(column(name), F.lit(""))), F.lit("m'"), F.lit("mc"))
    return F.split(F.regexp_replace(text, r"(?U)'s\b", ""), "[^a-z0-9]+")


def caption_tokens(name: Column | str, dropped: tuple[str, ...] = STOP_WORDS) -> Column:
    """Distinctive tokens of a caption: a sorted array without repeats. A null has none."""
    return F.array_sort(F.array_distinct(F.filter(caption_words(name), lambda w: (F.length(w) > 1) & ~w.isin(*dropped))))


def caption_key(name: Column | str) -> Column:
    """A caption's tokens joined by spaces, for comparing two records."""
    return F.array_join(caption_tokens(name), " ")


def match_tokens(name: Column | str) -> Column:
    """Tokens for comparing with an answer key: descriptors and numerals fall away as well."""
    return caption_tokens(name, (*MATCH_STOP_WORDS, *DESCRIPTOR_WORDS, *ROMAN_NUMERALS))


def match_key(name: Column | str) -> Column:
    return F.array_join(match_tokens(name), "")


def plain_words(text: Column | str) -> Column:
    """Words of a text without tags and punctuation, lower case."""
    bare = F.lower(F.regexp_replace(F.coalesce(column(text), F.lit("")), "<[^>]+>", " "))
    return F.array_remove(F.split(F.regexp_replace(bare, "[^a-z0-9]", " "), " +"), "")


def shingles(words: Column | str, size: int = 5) -> Column:
    """Distinct runs of ``size`` words, joined by spaces; fewer words have none."""

    def runs(w: Column) -> Column:
        last = F.size(w) - (size - 1)
        starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(w, i, size), " ")))

    return bound(column(words), runs)


def leading_int(value: Column | str) -> Column:
    """Digits at the start of a string, as a number; null where there are none."""
    return F.try_to_number(F.nullif(F.regexp_extract(F.coalesce(column(value), F.lit("")), "^([0-9]+)", 1), F.lit("")), F.lit("9" * 18)).cast("long")


def year_of(date: Column | str) -> Column:
    return F.nullif(F.substring(column(date), 1, 4), F.lit(""))


def blank_to_null(value: Column | str) -> Column:
    """The value verbatim, or null where it has no character but Unicode white space."""
    value = column(value)
    return F.when(value.rlike(r"(?U)[^\s\x1c-\x1f]"), value)


def stripped(value: Column | str) -> Column:
    """Unicode white space off both ends; null where nothing is left."""
    space = r"[\s\x1c-\x1f]"
    return F.nullif(F.regexp_replace(column(value), rf"(?U)^{space}+|{space}+$", ""), F.lit(""))


def is_dirty(text: Column | str) -> Column:
    """Whether a text has the box glyph or a word with a misread long s."""
    text = F.coalesce(column(text), F.lit(""))
    return text.contains(BOX_GLYPH) | F.lower(text).rlike(r"(?U)\b(" + "|".join(DIRTY_TOKENS) + r")\b")


def before_each(lengths: Column, chunk: int = 256) -> Column:
    """For each element of an array the sum of those before it; sums of chunks come first, so that
    long arrays don't take quadratic time."""

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0).cast("long"), lambda a, b: a + b)

    def over(parts: Column) -> Column:
        inside = lambda p, first: F.transform(p, lambda x, i: first + total(F.slice(p, F.lit(1), i)))
        return bound(F.transform(parts, total), lambda sums: F.flatten(F.transform(parts, lambda p, c: bound(total(F.slice(sums, F.lit(1), c)), lambda first: inside(p, first)))))

    last = F.floor((F.size(lengths) - 1) / chunk).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda c: F.slice(lengths, c * chunk + 1, F.lit(chunk)))
    return F.when(F.size(lengths) > 0, bound(parts, over)).otherwise(F.array().cast("array<bigint>"))


def suspects(text: Column | str, tokens: tuple[str, ...] = SUSPECT_TOKENS) -> Column:
    """Suspect spots in order: array of ``offset`` (code points from 0) and ``token``.

    A spot is a whole run of ASCII letters that is a token in any case, or a box glyph. Spots and
    the gaps between them tile the text, so running sums of their lengths are offsets.
    """
    pattern = f"(?i)(?<![A-Za-z])(?:{'|'.join(tokens)})(?![A-Za-z])|{BOX_GLYPH}"

    def spots(hits: Column, gaps: Column) -> Column:
        steps = F.transform(hits, lambda h, i: (F.length(h) + F.length(F.get(gaps, i))).cast("long"))
        return bound(before_each(steps), lambda at: F.transform(hits, lambda h, i: F.struct((F.get(at, i) + F.length(F.get(gaps, i))).alias("offset"), h.alias("token"))))

    def found(t: Column) -> Column:
        return bound(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda hits: bound(F.split(t, pattern), lambda gaps: spots(hits, gaps)))

    none = F.array().cast("array<struct<offset:bigint,token:string>>")
    return bound(F.coalesce(column(text), F.lit("")), lambda t: F.when(t.rlike(pattern), found(t)).otherwise(none))


def suspects_json(found: Column | str) -> Column:
    """``{"count", "hits"}`` as JSON; null where there are none."""
    found = column(found)
    return F.when(F.size(found) > 0, F.to_json(F.struct(F.size(found).alias("count"), found.alias("hits"))))


def containment(left: Column | str, right: Column | str) -> tuple[Column, Column]:
    """Shared members over the smaller set's size, and how many are shared; 0 if either is empty."""
    left, right = column(left), column(right)
    shared = F.size(F.array_intersect(left, right))
    smaller = F.least(F.size(left), F.size(right))
    return F.when(smaller > 0, shared / smaller).otherwise(F.lit(0.0)), F.when(smaller > 0, shared).otherwise(0)


INLINE_BREAK = r"\[\*([0-9]+)\]?|\*([0-9]+)\]"


def inline_breaks(text: Column | str) -> Column:
    """Text without bracketed page markers, and the markers: ``label`` and ``offset`` into it."""
    start = F.struct(F.array().cast("array<struct<label:string,offset:bigint>>").alias("found"), F.lit(0).cast("long").alias("at"), F.lit(0).alias("n"))

    def marked(text: Column, pieces: Column) -> Column:
        def step(a: Column, mark: Column) -> Column:
            at = a["at"] + F.length(F.get(pieces, a["n"]))
            hit = F.struct(F.regexp_extract(mark, "([0-9]+)", 1).alias("label"), at.alias("offset"))
            return F.struct(F.array_append(a["found"], hit).alias("found"), at.alias("at"), (a["n"] + 1).alias("n"))

        marks = F.regexp_extract_all(text, F.lit(INLINE_BREAK), F.lit(0))
        return F.struct(F.array_join(pieces, "").alias("text"), F.aggregate(marks, start, step, lambda a: a["found"]).alias("breaks"))

    return bound(F.coalesce(column(text), F.lit("")), lambda t: bound(F.split(t, INLINE_BREAK), lambda p: marked(t, p)))


def fold_tokens(text: Column | str) -> Column:
    """Search tokens: runs of letters, digits and marks, in lower case, without diacritics."""
    folded = bound(F.coalesce(column(text), F.lit("")), lambda t: F.lower(without_marks(t)))
    return F.array_remove(F.split(folded, r"[^\p{L}\p{N}\p{Co}]+"), "")
