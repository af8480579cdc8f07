"""Diacritics off a text by Spark's own functions, with a table made from Unicode's decompositions."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode's arithmetic of Hangul syllables.
SYLLABLES, LEADS, VOWELS, TAILS = 0xAC00, 0x1100, 0x1161, 0x11A7
N_LEADS, N_VOWELS, N_TAILS = 19, 21, 28


@functools.lru_cache(maxsize=1)
def decompositions() -> tuple[dict[str, str], dict[str, str], str]:
    """Characters that become one other, those that become several, and marks, which become none; without Hangul."""
    one, several, marks = {}, {}, []
    for c in map(chr, (i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and not SYLLABLES <= i < SYLLABLES + N_LEADS * N_VOWELS * N_TAILS)):
        if unicodedata.combining(c):
            marks.append(c)
        elif unicodedata.decomposition(c) and not unicodedata.decomposition(c).startswith("<"):
            base = "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x))
            if base != c:
                (one if len(base) == 1 else several)[c] = base
    return one, several, "".join(marks)


def spelled(c: Column) -> Column:
    """A character as the several that it consists of, if it does."""
    at = F.ascii(c) - SYLLABLES
    part = lambda first, n, i: F.substr(F.lit("".join(chr(first + k) for k in range(n))), i + 1, F.lit(1))
    tail = at % N_TAILS
    lead, vowel = F.floor(at / (N_VOWELS * N_TAILS)).cast("int"), F.floor(at % (N_VOWELS * N_TAILS) / N_TAILS).cast("int")
    syllable = F.concat(part(LEADS, N_LEADS, lead), part(VOWELS, N_VOWELS, vowel), F.when(tail > 0, part(TAILS, N_TAILS, tail)).otherwise(""))
    known = F.create_map(*[F.lit(x) for pair in decompositions()[1].items() for x in pair])
    return F.when((at >= 0) & (at < N_LEADS * N_VOWELS * N_TAILS), syllable).otherwise(F.coalesce(F.try_element_at(known, c), c))


def without_marks(text: Column) -> Column:
    """Text decomposed, without combining marks; ASCII stays as it is."""
    one, several, marks = decompositions()
    single = lambda x: F.translate(x, "".join(one) + marks, "".join(one.values()))
    whole = F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), spelled), "")
    rare = f"[{chr(SYLLABLES)}-{chr(SYLLABLES + N_LEADS * N_VOWELS * N_TAILS - 1)}{''.join(several)}]"
    return F.when(~text.rlike(r"[^\x00-\x7F]"), text).when(text.rlike(rare), single(whole)).otherwise(single(text))
