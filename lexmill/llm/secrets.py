"""Secret scans in DataFrame expressions alone: patterns, and entropy of sliding windows.

Patterns give spans by code points: matches and the gaps between them tile the text, so running
sums of their lengths are offsets. Sums run over chunks first and inside chunks next, so that a
text with very many matches doesn't take quadratic time.

Candidate strings, long runs of token characters, get a class by their alphabet. A fold over their
characters keeps the counts of the last ``WINDOW`` ones, one in and one out per step, and with them
the sum of ``c * log2(c)``, in whole millionths: the Shannon entropy of each window, exactly. A
string is a finding if a window's entropy reaches its class's bound. The allow-list knows shapes of
whole strings, which are never findings, and words: a window that overlaps one, as a whole part
between separators, doesn't count, the others of the string do.

Defined results: a null text is empty; without findings ``spans`` is empty and the digest is that of
the empty string; spans that overlap are all kept, ordered by start, then kind; repeated rows repeat;
an empty table gives an empty table; other columns, whatever their names, come back as they were, but
for one named like the result, which gives way to it. Time is linear in a text's length and in a
candidate's.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import rows_and_text

#: Kinds in the order of their listing, with pattern, group to measure and least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = (
    ("assign", ASSIGN, 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]{32,}", 0, 32),
)
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Classes of candidates: what all characters match, the alphabet (folded if one case), and the
#: bits a window must reach. Twenty random characters have 3.4 bits in hexadecimal, 4.1 in Base64.
CLASSES = (
    ("entropy_hex", "^[0-9a-fA-F]+$", "0123456789abcdef", True, 3.0),
    ("entropy_base64", "^[A-Za-z0-9+/_=-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", False, 3.7),
)
#: What is never a finding: plain words or numbers, words joined by hyphens or slashes, samples.
ALLOWED = (
    "^[A-Za-z_=/+-]+$",
    "^[0-9_=/+-]+$",
    "^[A-Z]?[a-z]+([-_/][A-Z]?[a-z0-9]{1,12})+$",
    "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
)
#: Allowed words between separators; a mark, which no candidate holds, takes their place. Two in a
#: row share a separator, so the pattern is applied twice.
ALLOWED_WORD = "(?i)(^|[-+/_=])(?:example|sample|dummy|placeholder|changeme|x{4,})($|[-+/_=])"
MARK = "~"
CHUNK = 256
MILLION = 1_000_000


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def before_each(lengths: str) -> str:
    """For each element of an array of numbers, the sum of those before it."""
    return f"""
    transform(array(transform(sequence(0, (size({lengths}) - 1) div {CHUNK}), c -> slice({lengths}, CAST(c * {CHUNK} + 1 AS INT), {CHUNK}))), parts ->
      transform(array(transform(parts, p -> aggregate(p, 0L, (a, b) -> a + b))), sums ->
        flatten(transform(parts, (p, c) ->
          transform(array(aggregate(slice(sums, 1, c), 0L, (a, b) -> a + b)), first ->
            transform(p, (x, i) -> first + aggregate(slice(p, 1, i), 0L, (a, b) -> a + b)))[0]))
      )[0])[0]"""


def located(text: str, pattern: str, measure: int = 0, least: int = 0) -> Column:
    """Matches of ``pattern``, leftmost and without overlap, as array of start, end and match;
    those whose group ``measure`` is shorter than ``least`` are dropped after matching."""
    p = quoted(pattern)
    return F.expr(f"""
    CASE WHEN {text} RLIKE {p} THEN
      transform(array(struct(regexp_extract_all({text}, {p}, 0) AS m, regexp_extract_all({text}, {p}, {measure}) AS g, split({text}, {p}, -1) AS gap)), f ->
        transform(array(transform(f.m, (x, i) -> CAST(length(x) + length(f.gap[i]) AS BIGINT))), steps ->
          transform(array({before_each("steps")}), starts ->
            filter(
              transform(f.m, (x, i) -> named_struct('start', starts[i] + length(f.gap[i]), 'end', starts[i] + steps[i], 'match', x, 'size', length(f.g[i]))),
              x -> x.size >= {least})
          )[0])[0])[0]
    ELSE array() END""")


def weight(count: int) -> int:
    """``count * log2(count)`` in millionths."""
    return round(count * math.log2(count) * MILLION) if count else 0


def window_reaches(value: str, alphabet: str, folded: bool, bits: float) -> str:
    """Whether some window of ``value`` without an allowed word has an entropy of at least ``bits``.

    The entropy of ``WINDOW`` characters is log2(WINDOW) less the weighted sum of their counts over
    WINDOW; so it is high where that sum is low, and the fold keeps the lowest sum.
    """
    weights = "array(" + ", ".join(f"{weight(c)}L" for c in range(WINDOW + 2)) + ")"
    ceiling = weight(WINDOW) - round(WINDOW * bits * MILLION)
    text = f"lower({value})" if folded else value
    for _ in range(2):
        text = f"regexp_replace({text}, {quoted(ALLOWED_WORD)}, '$1{MARK}$2')"
    return f"""
    transform(array({weights}), w -> exists(filter(split({text}, '{MARK}'), s -> length(s) >= {WINDOW}), s ->
      transform(array(transform(split(s, ''), c -> instr('{alphabet}', c) - 1)), p ->
        aggregate(sequence(0, size(p) - 1), named_struct('counts', array_repeat(0, {len(alphabet)}), 'sum', 0L, 'least', {1 << 60}L),
          (a, i) -> transform(array(named_struct('in', p[i], 'out', CASE WHEN i >= {WINDOW} THEN p[i - {WINDOW}] ELSE -1 END)), k ->
            transform(array(named_struct(
              'counts', CASE WHEN k.in = k.out THEN a.counts ELSE transform(a.counts, (c, j) -> c + CASE WHEN j = k.in THEN 1 WHEN j = k.out THEN -1 ELSE 0 END) END,
              'sum', CASE WHEN k.in = k.out THEN a.sum ELSE a.sum + w[a.counts[k.in] + 1] - w[a.counts[k.in]]
                + CASE WHEN k.out >= 0 THEN w[a.counts[k.out] - 1] - w[a.counts[k.out]] ELSE 0L END END)), n ->
              named_struct('counts', n.counts, 'sum', n.sum, 'least', CASE WHEN i >= {WINDOW - 1} THEN least(a.least, n.sum) ELSE a.least END))[0])[0],
          a -> a.least <= {ceiling}L))[0]))[0]"""


def entropy_kind(value: str) -> str:
    """The class whose entropy bound ``value`` reaches, or null; the allow-list comes first."""
    # a repeated group that gives nothing back is matched in a loop, not by recursion
    allowed = " OR ".join(f"{value} RLIKE {quoted(p.replace(')+$', ')++$'))}" for p in ALLOWED)
    cases = " ".join(f"WHEN {value} RLIKE {quoted(p)} THEN CASE WHEN {window_reaches(value, alphabet, folded, bits)} THEN '{name}' END" for name, p, alphabet, folded, bits in CLASSES)
    return f"CASE WHEN {allowed} THEN NULL {cases} END"


def findings(rows: DataFrame) -> DataFrame:
    """``row, found`` of ``row, text``."""
    for name, pattern, measure, least in KINDS:
        rows = rows.withColumn(f"found_{name}", located("text", pattern, measure, least))
    rows = rows.withColumn("found_entropy", located("text", CANDIDATE))
    parts = [
        F.expr(f"transform(found_{name}, x -> named_struct('start', x.start, 'rank', {rank}, 'kind', '{name}', 'end', x.end))")
        for rank, (name, *_) in enumerate(KINDS)
    ]
    high = F.expr(f"""filter(transform(found_entropy, x -> named_struct('start', x.start, 'rank', {len(KINDS)}, 'kind', {entropy_kind("x.match")}, 'end', x.end)), x -> x.kind IS NOT NULL)""")
    return rows.select("row", F.sort_array(F.concat(*parts, high)).alias("found"))


def scan(docs: DataFrame, *, text_col: str = "text", found_col: str = "found") -> DataFrame:
    """Adds ``found_col``, in place of a column of that name in any case: an array of ``start, rank, kind, end``
    by start and kind; ranks below ``len(KINDS)`` are those of the patterns."""
    return findings(rows_and_text(docs, text_col, without=(found_col.lower(),))).select("row.*", F.col("found").alias(found_col))


def without_secrets(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in which nothing is found."""
    return findings(rows_and_text(docs, text_col)).where(F.size("found") == 0).select("row.*")


def spans_text(found: str, most_rank: int | None = None) -> Column:
    """Spans as ``kind:start:end``, joined by commas; of patterns alone, if a rank is given."""
    kept = F.col(found) if most_rank is None else F.filter(found, lambda x: x["rank"] < most_rank)
    return F.array_join(F.transform(kept, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def count_of(found: str, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")
