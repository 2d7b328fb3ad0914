"""DuckDB SQL that gives the rows of the queries SQL can express."""

from __future__ import annotations

from sparkpipe.llm.risk import RULES

WORDS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_CUTOFFS = ", ".join(
    f"('{rule}', {i}, {cutoff})"
    for rule, (_, _, cutoffs) in RULES.items()
    for i, cutoff in enumerate(cutoffs)
)
_TOP, _BOTTOM = (
    "CASE rule " + " ".join(f"WHEN '{r}' THEN {x[k]}" for r, x in RULES.items()) + " END"
    for k in (0, 1)
)

# CRC-32, bit by bit over the digits of an id.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295,
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def _assigned(books: str) -> str:
    """The nearest entry of each part of each vector, as (distance, entry)."""
    return f"""SELECT rid, part, min(struct_pack(d := list_sum(list_transform(list_zip(x.v, b.v),
                lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := entry)) AS best
            FROM parts x JOIN {books} b USING (part) GROUP BY rid, part"""


def _moved(books: str, assigned: str) -> str:
    """Entries after one round: floored means, or as they were."""
    return f"""SELECT part, entry, coalesce(new.v, b.v) AS v FROM {books} b LEFT JOIN (
                SELECT part, entry, list(mean ORDER BY pos) AS v FROM (
                    SELECT x.part, a.best.e AS entry, pos, CAST(floor(sum(x.v[pos]) / count(*)) AS BIGINT) AS mean
                    FROM {assigned} a JOIN parts x USING (rid, part), unnest(range(1, len(x.v) + 1)) AS u(pos)
                    GROUP BY ALL
                ) GROUP BY part, entry
            ) new USING (part, entry)"""


LLM_ORACLE = {
    "op2_risk_rules": rf"""
        WITH w AS (
            SELECT doc_id, lang, coalesce(text, '') AS t,
                regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws,
                list_filter(string_split(coalesce(text, ''), chr(10)),
                    lambda x: regexp_matches(x, '{WORDS}')) AS lines
            FROM documents
        ), windows AS (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i:i + 2]) AS times
            FROM w, unnest(range(1, greatest(1, len(ws) - 1))) AS u(i)
        ), repeated AS (
            SELECT doc_id, count(DISTINCT i + k) AS n
            FROM windows, range(3) AS r(k) WHERE times > 1 GROUP BY doc_id
        ), c AS (
            SELECT w.doc_id, lang, t, CAST(len(ws) AS BIGINT) AS n_words,
                CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
                CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
                CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                coalesce(r.n, 0) AS n_repeat_words, len(lines) AS n_lines,
                len(regexp_extract_all(t, '[A-Z]')) AS n_upper,
                len(regexp_extract_all(t, '[!?]')) AS n_marks
            FROM w LEFT JOIN repeated r ON r.doc_id = w.doc_id
        ), marks AS (
            SELECT doc_id, bool_and(quality = 1) AS good FROM labels
            WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
        ), once AS (
            SELECT lang, bool_and(good) AS good, min(n_words) AS n_words,
                min(word_chars) AS word_chars, min(n_symbols) AS n_symbols,
                min(n_dup_lines) AS n_dup_lines, min(n_repeat_words) AS n_repeat_words,
                min(n_lines) AS n_lines, min(n_upper) AS n_upper, min(n_marks) AS n_marks
            FROM c JOIN marks USING (doc_id) GROUP BY lang, t
        ), held AS (
            SELECT lang, rule, i, cutoff, count(*) AS n, count(*) FILTER (
                {_BOTTOM} > 0 AND 100 * {_TOP} >= cutoff * {_BOTTOM}) AS k
            FROM once, (VALUES {_CUTOFFS}) AS v(rule, i, cutoff) WHERE good
            GROUP BY lang, rule, i, cutoff
        ), tested AS (
            SELECT *, k < n AND list_sum([exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
                    + j * ln(0.06 / {len(RULES)}) + (n - j) * ln(1 - 0.06 / {len(RULES)}))
                    for j in range(0, k + 1)])
                <= 0.05 / ((SELECT count(DISTINCT coalesce(lang, chr(0))) FROM held) * {len(RULES)})
                AS safe
            FROM held
        ), chosen AS (
            SELECT lang, rule, min(cutoff) AS cutoff FROM (
                SELECT *, bool_and(safe) OVER (PARTITION BY lang, rule ORDER BY i) AS so_far
                FROM tested) WHERE so_far GROUP BY lang, rule
        ), rejected AS (
            SELECT DISTINCT c.doc_id FROM c JOIN chosen h ON c.lang IS NOT DISTINCT FROM h.lang
            WHERE {_BOTTOM} > 0 AND 100 * {_TOP} >= cutoff * {_BOTTOM}
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
                AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
        FROM c
    """,
    "op6_jaccard_join": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') AS ws
            FROM documents
        ), g AS (
            SELECT DISTINCT doc_id, CASE WHEN len(ws) >= 5 THEN ws[i:i + 4] ELSE ws END AS s
            FROM w, unnest(range(1, greatest(2, len(ws) - 3))) AS u(i) WHERE len(ws) > 0
        ), n AS (
            SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
        ), p AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
            FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
        ), l AS (
            SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * k >= 80 * (x.n + y.n - k)
        ), r AS (
            SELECT doc_id, doc_id AS root FROM documents
            UNION SELECT l.a, r.root FROM r JOIN l ON l.b = r.doc_id
        )
        SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(root) AS component_id
        FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
    """,
    "op9_bwt_dedup": """
        WITH d AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h,
                CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n
            FROM documents
        ), c AS (
            SELECT doc_id, n, j, substr(h, 2000 * j + 1, 2098) AS part
            FROM d, unnest(range(0, (n + 999) // 1000)) AS u(j)
        ), x AS (
            SELECT doc_id, 1000 * j + o AS p,
                min(doc_id) OVER (PARTITION BY substr(part, 2 * o + 1, 100)) AS m
            FROM c, unnest(range(0, least(1000, greatest(0, n - 49 - 1000 * j)))) AS v(o)
        ), q AS (
            SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before
            FROM x WHERE m < doc_id
        ), i AS (
            SELECT doc_id, p, sum(CASE WHEN p <= before + 50 THEN 0 ELSE 1 END)
                OVER (PARTITION BY doc_id ORDER BY p) AS span
            FROM q
        ), s AS (
            SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM i GROUP BY doc_id, span
        ), k AS (
            SELECT s.doc_id, a, b, substr(h, 2 * coalesce(lag(b) OVER o, 0) + 1,
                2 * (a - coalesce(lag(b) OVER o, 0))) AS part
            FROM s JOIN d ON d.doc_id = s.doc_id
            WINDOW o AS (PARTITION BY s.doc_id ORDER BY a)
        ), t AS (
            SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
                string_agg(part, '' ORDER BY a) AS parts
            FROM k GROUP BY doc_id
        )
        SELECT d.doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
            CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
            sha256(unhex(coalesce(parts, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN t ON t.doc_id = d.doc_id
    """,
    "op7_mix_sources": rf"""
        WITH d AS (
            SELECT doc_id, source,
                CAST(len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS BIGINT) AS size
            FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                1 + (row_number() OVER (ORDER BY CAST(source AS BLOB) NULLS LAST) - 1) % 3 AS weight
            FROM d GROUP BY source
        ), r AS (
            SELECT *, 3.0 * source_size AS cap,
                sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight,
                coalesce(sum(3.0 * source_size) OVER lower_ones, 0) AS capped,
                coalesce(sum(weight) OVER lower_ones, 0) AS gone
            FROM s
            WINDOW lower_ones AS (ORDER BY 3.0 * source_size / weight, source
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), l AS (
            SELECT arg_min(CAST(total - capped AS DOUBLE) / (all_weight - gone), CAST(cap AS DOUBLE) / weight) AS level FROM r
            WHERE CAST(total - capped AS DOUBLE) / (all_weight - gone) <= CAST(cap AS DOUBLE) / weight
        ), t AS (
            SELECT source, source_size,
                least(CAST(3 * source_size AS DOUBLE), coalesce(weight * level, 3 * source_size)) AS target
            FROM s, l
        ), p AS (
            SELECT *, CASE WHEN source_size > 0
                THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
            FROM t
        ), x AS (
            SELECT d.doc_id, d.size, p.source_size, p.target, p.whole,
                CAST(round(p.target - p.whole * p.source_size) AS BIGINT) AS rest,
                coalesce(sum(d.size) OVER (
                    PARTITION BY d.source ORDER BY md5('17:' || d.doc_id)
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
            FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
        )
        SELECT doc_id, size, source_size, target,
            CAST(size * whole + greatest(0, least(size, rest - used)) AS BIGINT) AS taken
        FROM x
    """,
    "op8_url_lists": r"""
        WITH h AS (
            SELECT page_id, url, epoch_ms((page_id * 7919 % 1461 + 18262) * 86400000) AS fetched,
                nullif(regexp_replace(regexp_replace(lower(regexp_extract(url,
                    '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)),
                    '^www\.', ''), '\.$', ''), '') AS host,
                regexp_replace(regexp_extract(url,
                    '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
                regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) AS section
            FROM pages
        ), e AS (
            SELECT host AS entry FROM h WHERE host IS NOT NULL
            UNION SELECT host || '/' || section FROM h WHERE host IS NOT NULL AND section != ''
        ), m AS (
            SELECT entry, md5(entry) AS d FROM e
        ), n AS (
            SELECT entry,
                CASE WHEN ('0x' || substr(d, 1, 2))::BIGINT < 48 THEN 'allow' ELSE 'block' END AS list,
                ('0x' || substr(d, 3, 2))::BIGINT AS chance,
                ('0x' || substr(d, 5, 3))::BIGINT % 1461 AS first,
                ('0x' || substr(d, 8, 3))::BIGINT % 700 + 1 AS gone,
                ('0x' || substr(d, 11, 3))::BIGINT % 700 + 1 AS again
            FROM m
        ), i AS (
            SELECT list, entry, first AS since,
                CASE WHEN chance % 3 >= 1 THEN first + gone END AS until
            FROM n WHERE chance < 160
            UNION ALL
            SELECT list, entry, first + gone + again, NULL FROM n
            WHERE chance < 160 AND chance % 3 = 2
        ), v AS (
            SELECT list, entry, epoch_ms((since + 18262) * 86400000) AS since,
                epoch_ms((until + 18262) * 86400000) AS until
            FROM i
        ), f AS (
            SELECT h.page_id, v.list, v.entry
            FROM h JOIN v ON h.fetched >= v.since AND (v.until IS NULL OR h.fetched < v.until)
                AND (h.host = v.entry OR suffix(h.host, '.' || v.entry)
                    OR starts_with(h.host || h.path || '/', v.entry || '/') AND contains(v.entry, '/'))
        ), g AS (
            SELECT page_id, count(*) AS n_active,
                first(list ORDER BY length(entry) DESC, list) AS list,
                first(entry ORDER BY length(entry) DESC, list) AS entry
            FROM f GROUP BY page_id
        )
        SELECT h.page_id AS capture_id, h.fetched, h.host, coalesce(g.n_active, 0) AS n_active,
            g.list AS rule, g.entry, coalesce(g.list = 'block', false) AS blocked
        FROM h LEFT JOIN g ON h.page_id = g.page_id
    """,
    "op10_format_chats": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), k AS (
            SELECT conv_id, bool_or(contains(role, ': ') OR contains(role, '###')
                OR contains(role, '</turn>') OR contains(text, '###') OR contains(text, '</turn>')) AS marked
            FROM c GROUP BY conv_id
        ), w AS (
            SELECT c.*, CASE WHEN marked THEN replace(replace(replace(replace(role, '\', '\\'),
                    '#', '\#'), ': ', ':\ '), '</turn>', '<\/turn>') ELSE role END AS shown_role,
                CASE WHEN marked THEN replace(replace(replace(replace(text, '\', '\\'),
                    '#', '\#'), ': ', ':\ '), '</turn>', '<\/turn>') ELSE text END AS shown_text
            FROM c JOIN k USING (conv_id)
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
                AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(16 + sum(4 + length(shown_role) + 2 + length(shown_text) + 8) AS BIGINT)
                AS formatted_chars
        FROM w GROUP BY conv_id
    """,
    "op11_word_runs": rf"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws, {_CRC} AS h
            FROM documents
        ), g AS (
            SELECT doc_id, ws, h % 10 = 0 AND len(ws) > 0 AS due, len(ws) AS n, h // 10 AS g FROM d
        ), a AS (
            SELECT *, g % greatest(n, 1) AS a,
                1 + (n - g % greatest(n, 1)) // (3 + g % 8) AS p FROM g
        ), words AS (
            SELECT doc_id, n, i, CASE WHEN due AND i >= a THEN ws[a + (i - a) % p + 1]
                ELSE ws[i + 1] END AS w
            FROM a, unnest(range(n)) AS u(i)
        ), pairs AS (
            SELECT x.doc_id, x.i, y.i - x.i AS q
            FROM words x JOIN words y ON y.doc_id = x.doc_id AND y.w = x.w
                AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
        ), islands AS (
            SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island
            FROM pairs
        ), periodic AS (
            SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM islands
            GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
        ), runs AS (
            SELECT doc_id, s, l, min(q) AS q FROM periodic GROUP BY doc_id, s, l
        ), r AS (
            SELECT doc_id, count(*) AS n_runs,
                max(struct_pack(l := l, s := -s, q := -q)) AS best,
                sha256(string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256
            FROM runs GROUP BY doc_id
        ), dropped AS (
            SELECT DISTINCT doc_id, i FROM runs, unnest(range(s + q, s + l)) AS u(i)
        ), kept AS (
            SELECT doc_id, sha256(string_agg(w, ' ' ORDER BY i)) AS collapsed_sha256
            FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -best.s AS start, best.l AS length,
            -best.q AS period, 1000 * best.l // -best.q AS exponent_milli,
            coalesce(runs_sha256, sha256('')) AS runs_sha256,
            coalesce(collapsed_sha256, sha256('')) AS collapsed_sha256
        FROM d LEFT JOIN r USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op12_vector_codes": rf"""
        WITH k AS (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
                list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS (
            SELECT rid, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] AS v
            FROM k, unnest(range(16)) AS u(part)
        ), b0 AS (
            SELECT part, rid - 1 AS entry, v FROM parts WHERE rid <= 64
        ), a0 AS ({_assigned("b0")}), b1 AS ({_moved("b0", "a0")}),
        a1 AS ({_assigned("b1")}), b2 AS ({_moved("b1", "a1")}),
        a2 AS ({_assigned("b2")}),
        coded AS (
            SELECT rid, string_agg(lower(printf('%02x', best.e)), '' ORDER BY part) AS code,
                CAST(sum(best.d) AS BIGINT) AS error
            FROM a2 GROUP BY rid
        ), books AS (
            SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry))
                AS codebooks_sha256 FROM b2
        )
        SELECT vec_id, code, error,
            CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM k JOIN coded USING (rid), books
    """,
}
