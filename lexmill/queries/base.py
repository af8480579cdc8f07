"""Registering queries with their SQL, and SQL that several of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name, and the SQL that gives the same rows."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers a function as a query under its own name."""

        def register(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return register


def listed(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def tokens_sql(x: str, dropped: tuple[str, ...]) -> str:
    """A caption's distinctive tokens."""
    plain = rf"regexp_replace(regexp_replace(replace(lower({x}), 'm''', 'mc'), '''s\b', '', 'g'), '[^a-z0-9 ]', ' ', 'g')"
    return f"list_sort(list_distinct(list_filter(string_split_regex({plain}, ' +'), lambda w: length(w) > 1 AND NOT list_contains({listed(dropped)}, w))))"


#: Words of a column ``text``, and distinct runs of five ``words``.
WORDS_SQL = "list_filter(string_split_regex(regexp_replace(lower(regexp_replace(text, '<[^>]+>', ' ', 'g')), '[^a-z0-9]', ' ', 'g'), ' +'), lambda w: w <> '')"
RUNS_SQL = "list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))"


def ratio_sql(pairs: str) -> str:
    """Common table ``ratios(a, b, ratio)`` of the distinct pairs ``a, b`` of a table: the longest
    common run, the first of equally long ones, then the same to its left and to its right."""
    runs = "list_transform(list_filter(range(1, length(a) - i + 2), lambda n: contains(b, substr(a, i, n))), lambda n: {'n': n, 'i': -i})"
    return f"""
    asked AS (SELECT DISTINCT a, b FROM {pairs} WHERE a <> '' AND b <> ''),
    cut AS (
      SELECT a AS x, b AS y, a, b, CAST(0 AS BIGINT) AS n FROM asked
      UNION ALL
      SELECT x, y, CASE side WHEN 0 THEN substr(a, 1, i - 1) ELSE substr(a, i + n) END, CASE side WHEN 0 THEN substr(b, 1, j - 1) ELSE substr(b, j + n) END, CASE side WHEN 0 THEN n ELSE 0 END
      FROM (SELECT x, y, a, b, hit.n AS n, -hit.i AS i, instr(b, substr(a, -hit.i, hit.n)) AS j
            FROM (SELECT *, list_sort(flatten(list_transform(range(1, length(a) + 1), lambda i: {runs})), 'DESC')[1] AS hit FROM cut WHERE a <> '' AND b <> '') WHERE hit IS NOT NULL),
           (VALUES (0), (1)) AS sides(side)),
    ratios AS (SELECT x AS a, y AS b, 2.0::DOUBLE * sum(n) / (length(x) + length(y)) AS ratio FROM cut GROUP BY x, y)"""


def reach_sql(nodes: str, edges: str, name: str) -> str:
    """Common table ``name(node, component)``: the smallest node that each of ``nodes(node)`` reaches
    over ``edges(u, v)``."""
    return f"""
    {name}_both AS (SELECT u, v FROM {edges} UNION SELECT v, u FROM {edges}),
    {name}_reach AS (SELECT node AS u, node AS v FROM {nodes} UNION SELECT r.u, e.v FROM {name}_reach r JOIN {name}_both e ON e.u = r.v),
    {name} AS (SELECT u AS node, min(v) AS component FROM {name}_reach GROUP BY u)"""
