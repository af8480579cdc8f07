"""Quality rules as a short-circuit cascade, in DataFrame expressions alone.

Each rule is a column that says whether it rejects a text. Cost and selectivity of each are estimated
on a bounded, stored sample, in one job: a clock read before and after ``REPEATS`` evaluations of a rule on a
text gives its nanoseconds there, of which the median over all texts counts. The cascade then tries
rules by falling rejection per cost, inside one CASE that stops at the first rejection. Rules are
independent, so their order changes the time and never the verdict.

Repeated word windows are found inside the row: windows are compared as a set first, and only a
text in which the set is smaller sorts its windows to find which words repeat.

Defined results: a null or empty text has no words, fails the base and isn't kept; repeated rows
repeat; an empty table gives an empty table and the rules' given order; extra columns come back as they were,
but for those named like an added one in any case, which are replaced.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import WORD_SPACE, rows_and_text, stored

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
SAMPLE_ROWS, REPEATS = 2000, 8

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def removed(text: str, characters: str) -> Column:
    """How many code points of ``text`` are among ``characters``."""
    return F.length(text) - F.length(F.translate(F.col(text), characters, ""))


def standard_rules(text: str = "text") -> list[Rule]:
    """Rules over the text and the columns of ``measures``; all compare whole numbers."""
    words = F.col("n_words")
    upper = removed(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return [
        Rule("symbols", 10 * F.col("n_symbols") > words),
        Rule("word_length", (F.col("word_chars") * 2 < words * 5) | (F.col("word_chars") > words * 12)),
        Rule("repeated_lines", 10 * F.col("n_dup_lines") > 3 * F.size(F.split(text, "\n"))),
        Rule("exclamations", 10 * removed(text, "!") > 3 * words),
        Rule("upper_case", 2 * upper > F.col("word_chars")),
    ]


#: Runs of three words. Words are bound to a name: they must not be split anew for each window.
WINDOWS = "transform(array(words), ws -> transform(slice(ws, 1, greatest(size(ws) - 2, 0)), (w, i) -> concat_ws(' ', w, ws[i + 1], ws[i + 2])))[0]"

#: Words of 3-word windows found twice or more. Sorted windows stand next to their equals; the
#: one-element arrays bind a value to a name, so that nothing is computed for other texts.
REPEATED = """
CASE WHEN size(array_distinct(windows)) = size(windows) THEN 0L ELSE
  transform(array(sort_array(transform(windows, (w, i) -> struct(w, i)))), s ->
    size(array_distinct(flatten(transform(
      filter(s, (x, k) -> (k > 0 AND s[k - 1].w = x.w) OR (k < size(s) - 1 AND s[k + 1].w = x.w)),
      x -> array(x.i, x.i + 1, x.i + 2)))))
  )[0] END
"""


#: What ``judge`` adds; columns of these names, in any case, are replaced.
ADDED = ("text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def measures(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Adds ``text`` (never null), ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and
    ``n_repeat_words``, all over whole texts."""
    spaces = " \t\n\x0b\x0c\r"
    rows = rows_and_text(docs, text_col, without=ADDED)
    rows = rows.withColumn("words", F.array_remove(F.split("text", WORD_SPACE), ""))
    rows = rows.withColumn("windows", F.expr(WINDOWS))
    lines = F.expr(r"filter(split(text, '\n'), x -> x RLIKE '[^\\x20\\x09-\\x0D]')")
    return rows.select(
        "row.*",
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(F.col("text"), spaces, "")).cast("long").alias("word_chars"),
        removed("text", SYMBOLS).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long").alias("n_dup_lines"),
        F.expr(REPEATED).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def timed(rejects: Column, repeats: int = REPEATS) -> Column:
    """``hit, nanos``: whether a row is rejected, and what finding that out ``repeats`` times took.

    Elements of the one-element arrays are computed one inside the other, so the clock is read first,
    then come the evaluations, then it is read again.
    """
    now = F.expr("CAST(reflect('java.lang.System', 'nanoTime') AS BIGINT)")
    hits = F.aggregate(F.sequence(F.lit(1), F.lit(repeats)), F.lit(0), lambda a, _: a + F.coalesce(rejects, F.lit(False)).cast("int"))
    return F.transform(F.array(now), lambda began: F.transform(F.array(hits), lambda n: F.struct((n > 0).alias("hit"), (now - began).alias("nanos")))[0])[0]


def estimates(docs: DataFrame, rules: list[Rule], *, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Each rule's nanoseconds and share of rejections, on about ``sample_rows`` of ``docs``."""
    chosen = docs.sample(fraction=min(1.0, sample_rows / max(1, docs.count())), seed=11).limit(2 * sample_rows)
    # stored, so that no measure is computed again where a rule names it
    found = measures(chosen, text_col=text_col)
    lower = [c.lower() for c in found.columns]
    clear = [F.col(f"`{c.replace('`', '``')}`") for c in found.columns if lower.count(c.lower()) == 1]  # no rule can name the others
    rows = stored(found.select(*clear), "rule-sample").select(*[timed(r.rejects).alias(f"rule{i}") for i, r in enumerate(rules)])
    found = rows.agg(*[f(F.col(f"rule{i}.{k}")).alias(f"{k}{i}") for i in range(len(rules)) for k, f in (("nanos", F.median), ("hit", lambda c: F.avg(c.cast("int"))))]).first()
    return {r.name: ((found[f"nanos{i}"] or 0.0) / REPEATS, found[f"hit{i}"] or 0.0) for i, r in enumerate(rules)}


def ordered_rules(docs: DataFrame, rules: list[Rule], *, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by falling rejection per cost; the log tells why."""
    if not rules:
        return []
    known = estimates(docs, rules, text_col=text_col, sample_rows=sample_rows)
    order = sorted(rules, key=lambda r: -known[r.name][1] / max(known[r.name][0], 1.0))
    for r in order:
        log.info("rule %s: %.0f ns a text, rejects %.4f of them", r.name, *known[r.name])
    return order


def cascade(rules: list[Rule]) -> Column:
    """False at the first rule that rejects, else true."""
    if not rules:
        return F.lit(True)
    verdict = F.when(rules[0].rejects, False)
    for rule in rules[1:]:
        verdict = verdict.when(rule.rejects, False)
    return verdict.otherwise(True)


def judge(docs: DataFrame, *, text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """Adds the measures, ``base_failed`` and ``kept`` to each row."""
    measured = measures(docs, text_col=text_col)
    rules = ordered_rules(docs, standard_rules() if rules is None else rules, text_col=text_col)
    kept = F.when(F.col("base_failed"), False).otherwise(cascade(rules))
    return measured.withColumn("base_failed", base_failed()).withColumn("kept", kept)
