"""SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from . import chat, prefix_trie, quality_rules, secrets, vector_codes

SPACE = r"[\x20\x09-\x0D]"


def text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def warc() -> str:
    return """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p),
        w AS (SELECT digest, max(page_id) AS winner FROM d WHERE n >= 1000 GROUP BY digest)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN winner IS NOT NULL AND winner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN winner <> page_id THEN winner END AS refers_to
        FROM d LEFT JOIN w USING (digest)
    """


def rules() -> str:
    gone = lambda chars: f"(length(text) - length(translate(text, {text(chars)}, '')))"
    return rf"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, list_filter(string_split_regex(text, '{SPACE}+'), lambda x: x <> '') AS words,
                list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
        t AS (SELECT k, unnest(range(1, len(words) - 1)) AS i, unnest(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS three FROM w WHERE len(words) >= 3),
        again AS (SELECT k, i FROM (SELECT *, count(*) OVER (PARTITION BY k, three) AS n FROM t) WHERE n > 1),
        r AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY k),
        m AS (SELECT doc_id, text, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{SPACE}+', '', 'g')) AS BIGINT) AS word_chars,
                CAST({gone(quality_rules.SYMBOLS)} AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
              FROM w LEFT JOIN r USING (k)),
        b AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEATED_PERCENT} * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
          NOT base_failed AND NOT (10 * n_symbols > n_words OR 2 * word_chars < 5 * n_words OR word_chars > 12 * n_words OR 10 * n_dup_lines > 3 * len(string_split(text, chr(10)))
            OR 10 * {gone("!")} > 3 * n_words OR 2 * {gone("ABCDEFGHIJKLMNOPQRSTUVWXYZ")} > word_chars) AS kept
        FROM b
    """


def located(name: str, rank: int, pattern: str, measure: int, least: int) -> str:
    """Matches of a pattern with their offsets, by running sums over gaps and matches."""
    return f"""
        {name}_m AS (SELECT k, doc_id, unnest(regexp_extract_all(text, {text(pattern)}, 0)) AS m, unnest(regexp_extract_all(text, {text(pattern)}, {measure})) AS g,
            unnest(string_split_regex(text, {text(pattern)})[:-2]) AS gap, generate_subscripts(regexp_extract_all(text, {text(pattern)}, 0), 1) AS i FROM d WHERE regexp_matches(text, {text(pattern)})),
        {name}_s AS (SELECT k, {rank} AS rank, '{name}' AS kind, m, g, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY k ORDER BY i) AS BIGINT) AS finish FROM {name}_m),
        {name} AS (SELECT k, rank, kind, finish - length(m) AS start, finish, m FROM {name}_s WHERE length(g) >= {least})"""


def secret_spans() -> str:
    parts = [located(n, r, p, g, least) for r, (n, p, g, least) in enumerate(secrets.KINDS)]
    parts.append(located("candidate", len(secrets.KINDS), secrets.CANDIDATE, 0, 0))
    allowed = " OR ".join(f"regexp_matches(m, {text(p)})" for p in secrets.ALLOWED)
    kinds = " ".join(f"WHEN regexp_matches(m, {text(p)}) THEN '{n}'" for n, p, *_ in secrets.CLASSES)
    shown = " ".join(f"WHEN kind = '{n}' THEN {'lower(m)' if folded else 'm'}" for n, _, _, folded, _ in secrets.CLASSES)
    ceiling = " ".join(f"WHEN kind = '{n}' THEN {secrets.weight(secrets.WINDOW) - round(secrets.WINDOW * bits * secrets.MILLION)}" for n, _, _, _, bits in secrets.CLASSES)
    gone = lambda x: f"regexp_replace({x}, {text(secrets.ALLOWED_WORD)}, '\\1{secrets.MARK}\\2', 'g')"
    bases = " UNION ALL ".join(f"SELECT k, rank, kind, start, finish FROM {n}" for n, *_ in secrets.KINDS)
    return f"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents), {", ".join(parts)},
        c AS (SELECT DISTINCT m, CASE {kinds} END AS kind FROM candidate WHERE NOT ({allowed})),
        v AS (SELECT m, kind, unnest(string_split({gone(gone(f"CASE {shown} END"))}, '{secrets.MARK}')) AS s, CASE {ceiling} END AS ceiling FROM c),
        win AS (SELECT m, kind, ceiling, s, unnest(range(1, length(s) - {secrets.WINDOW} + 2)) AS i FROM v),
        ch AS (SELECT m, kind, ceiling, s, i, substr(s, CAST(i + j AS BIGINT), 1) AS x FROM win, range({secrets.WINDOW}) AS r(j)),
        n AS (SELECT m, kind, ceiling, s, i, x, count(*) AS c FROM ch GROUP BY ALL),
        e AS (SELECT m, kind, ceiling, s, i, sum(CAST(round(c * log2(c) * {secrets.MILLION}) AS BIGINT)) AS total FROM n GROUP BY ALL),
        high AS (SELECT DISTINCT m, kind FROM e WHERE total <= ceiling),
        f AS ({bases} UNION ALL SELECT k, rank, high.kind, start, finish FROM candidate JOIN high USING (m)),
        a AS (SELECT k, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
                string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, rank, kind, finish) FILTER (WHERE rank < {len(secrets.KINDS)}) AS base,
                string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, rank, kind, finish) AS spans FROM f GROUP BY k)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN a USING (k)
    """


def chats() -> str:
    def escaped(x: str) -> str:
        x = f"replace({x}, '\\', '\\\\')"
        for control in chat.CONTROLS:
            x = f"replace({x}, '{control}', '{control[0]}\\{control[1:]}')"
        return x

    said = "</s>[INST] ok [/INST]"
    fixed = len(chat.OPEN + chat.ROLE_END + chat.CLOSE)
    return f"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{said}'), (-1, 1, '{chat.LOSS_ROLE}', '{said}')))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
          CAST(coalesce(sum(length(text)) FILTER (WHERE role = '{chat.LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = '{chat.LOSS_ROLE}'), '')) AS loss_sha256,
          CAST(sum({fixed} + length({escaped("role")}) + length({escaped("text")})) AS BIGINT) AS formatted_chars
        FROM c GROUP BY conv_id
    """


def codes() -> str:
    k, parts = vector_codes.ENTRIES, vector_codes.PARTS
    near = lambda book: f"""SELECT r, vec_id, label, p, v, s.e, s.d FROM (SELECT r, vec_id, label, x.p, v, min({{'d': list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': e}}) AS s
        FROM x JOIN {book} AS b ON b.p = x.p GROUP BY ALL)"""  # noqa: E731
    rounds = "".join(f"""
        n{i} AS ({near(f"b{i}")}),
        m{i} AS (SELECT p, e, i, CAST(sum(c) AS BIGINT) AS s, count(*) AS n FROM (SELECT p, e, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM n{i}) GROUP BY ALL),
        f{i} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM m{i} GROUP BY p, e),
        b{i + 1} AS (SELECT b{i}.p, b{i}.e, coalesce(f{i}.c, b{i}.c) AS c FROM b{i} LEFT JOIN f{i} USING (p, e)),""" for i in range(vector_codes.ROUNDS))
    last = vector_codes.ROUNDS
    return f"""
        WITH g AS (SELECT *, row_number() OVER () AS r FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        q AS (SELECT r, vec_id, label, list_transform(embedding, lambda c: CAST(floor({vector_codes.SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS w, len(embedding) // {parts} AS width FROM g),
        x AS (SELECT r, vec_id, label, p, w[p * width + 1 : (p + 1) * width] AS v FROM q, range({parts}) AS t(p)),
        o AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS e FROM g QUALIFY e < {k}),
        b0 AS (SELECT p, e, v AS c FROM x JOIN o USING (r)), {rounds}
        z AS ({near(f"b{last}")}),
        done AS (SELECT r, vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM z GROUP BY r, vec_id, label),
        h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{last})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM done, h
    """


def tries() -> str:
    bit = "list_reduce([CAST(xor(a, b) AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: CAST(xor(x >> 1, (x & 1) * 3988292384) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: {bit}), 4294967295)"
    return f"""
        WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p FROM conversations WHERE conv_id IS NOT NULL),
        n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
        c AS (SELECT conv_id, conv_id - conv_id % {prefix_trie.GROUP} AS base, CAST({crc} AS BIGINT) % {prefix_trie.HEADS} AS h FROM n),
        k AS (SELECT c.*, least(h, coalesce(n.n, 0)) AS taken FROM c LEFT JOIN n ON n.conv_id = base),
        r AS (SELECT k.conv_id, p AS d, role, text FROM k JOIN t ON t.conv_id = base AND p <= taken UNION ALL SELECT k.conv_id, p - h + taken, role, text FROM k JOIN t ON t.conv_id = k.conv_id AND p > h),
        s AS (SELECT k.conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY d) FILTER (WHERE d IS NOT NULL), []) AS said FROM k LEFT JOIN r ON r.conv_id = k.conv_id GROUP BY k.conv_id),
        m AS (SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS depth FROM s),
        g AS (SELECT *, said[:depth] AS top FROM m),
        o AS (SELECT depth, top, min(conv_id) AS node, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(said) = depth), '') AS ends FROM g GROUP BY depth, top),
        x AS (SELECT g.conv_id, g.depth, node FROM g JOIN o ON o.depth = g.depth AND o.top = g.top),
        v AS (SELECT o.node, o.depth, x.node AS above, x.depth AS level, CASE WHEN o.depth > 0 THEN (n_convs - 1) * octet_length(encode(top[-1].text)) ELSE 0 END AS own FROM o JOIN x ON x.conv_id = o.node AND x.depth <= o.depth),
        f AS (SELECT above AS node, level AS depth, count(*) AS n FROM v WHERE depth = level + 1 GROUP BY ALL),
        a AS (SELECT above AS node, level AS depth, count(*) FILTER (WHERE f.n IS NULL) AS n_leaves, CAST(sum(own) AS BIGINT) AS saved FROM v LEFT JOIN f ON f.node = v.node AND f.depth = v.depth GROUP BY ALL)
        SELECT o.node AS conv_id, o.depth, u.above AS parent_conv_id, n_convs, coalesce(f.n, 0) AS n_children, n_leaves, saved AS saved_tokens, sha256(ends) AS ends_sha256
        FROM o JOIN a ON a.node = o.node AND a.depth = o.depth LEFT JOIN f ON f.node = o.node AND f.depth = o.depth LEFT JOIN v AS u ON u.node = o.node AND u.depth = o.depth AND u.level = o.depth - 1
    """


def oracle_sql() -> dict[str, str]:
    return {"op1_secret_scans": secret_spans(), "op2_quality_rules": rules(), "op8_warc": warc(), "op9_chat_formatting": chats(), "op11_vector_code_compression": codes(), "op12_conversation_prefix_trie": tries()}
