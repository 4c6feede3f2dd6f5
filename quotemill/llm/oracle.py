"""Reference SQL of the queries of this package, where SQL can express them."""

from __future__ import annotations

from quotemill.llm.licences import SPELLINGS
from quotemill.llm.licence_texts import KNOWN

_FINITE = """SELECT vec_id, {vec} AS vec FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

THRESHOLD_SEARCH = f"""
WITH v AS ({_FINITE.format(vec="list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))")}),
flat AS (SELECT vec_id, unnest(range(len(vec))) AS d, unnest(vec) AS x FROM v),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM flat q JOIN flat c ON q.d = c.d AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0 GROUP BY ALL),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

SOURCE_MIX = r"""
WITH d AS (
    SELECT doc_id, source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) >> 42 AS bucket
    FROM documents),
counts AS (SELECT source, bucket, sum(size) AS words FROM d GROUP BY ALL),
sizes AS (SELECT source, CAST(sum(words) AS BIGINT) AS source_size FROM counts GROUP BY source),
weighed AS (
    SELECT *, 2.0::DOUBLE * source_size AS most,
        CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
    FROM sizes),
levels AS (
    SELECT *, row_number() OVER w AS place,
        (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER before, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM weighed
    WINDOW w AS (ORDER BY most / weight, source NULLS LAST),
        before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first AS (SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= most),
targets AS (
    SELECT source, source_size, coalesce(least(most, first.level * weight), most) AS target,
        CASE WHEN source_size > 0 THEN CAST(floor(coalesce(least(most, first.level * weight), most) / source_size) AS BIGINT)
            ELSE 0 END AS copies
    FROM levels LEFT JOIN first ON true),
sums AS (SELECT source, bucket, sum(words) OVER (PARTITION BY source ORDER BY bucket) AS so_far FROM counts),
cuts AS (
    SELECT t.source, t.source_size, t.target, t.copies, t.target - t.copies * t.source_size AS rest,
        min({'off': abs(s.so_far - (t.target - t.copies * t.source_size)), 'bucket': s.bucket}) AS best
    FROM sums s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source GROUP BY ALL)
SELECT d.doc_id, d.size, c.source_size, c.target,
    d.size * (c.copies + CASE WHEN c.best.off < c.rest AND d.bucket <= c.best.bucket THEN 1 ELSE 0 END) AS taken
FROM d JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
"""

CHAT_FORMAT = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
        4 + length(role) + len(regexp_extract_all(role, '[\\<#\n]')) + 1
        + length(text) + len(regexp_extract_all(text, '[\\<#]')) + 8 AS chars
    FROM t),
made AS (
    SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY n) AS spoken,
        coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '') AS loss
    FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(spoken) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
    sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM made
"""


WARC_FILES = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
        min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
    FROM pages),
groups AS (
    SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(h, 1 + 5 * i, 5) AS BIGINT)) AS g FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST(1 + ((g[1 + i // 4] >> (15 - 5 * (i % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
    CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM groups
"""

INFILL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
    FROM documents),
drawn AS (
    SELECT *, CAST(len(units) AS BIGINT) AS n,
        list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS g
    FROM d),
cut AS (
    SELECT *, least(g[1] % (n + 1), g[2] % (n + 1)) AS a, greatest(g[1] % (n + 1), g[2] % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR g[3] % 100 >= 90 THEN 'plain'
            WHEN g[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
parts AS (
    SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
        array_to_string(units[b + 1:], '') AS suffix
    FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""


PHRASE_MINING = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
words AS (
    SELECT lang, id, unnest(w) AS w, generate_subscripts(w, 1) AS i
    FROM (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces)),
runs AS (
    SELECT lang, w, lead(w, 1) OVER piece AS w2, lead(w, 2) OVER piece AS w3
    FROM words WINDOW piece AS (PARTITION BY id ORDER BY i)),
f1 AS (SELECT lang, w, count(*) AS f FROM runs GROUP BY ALL),
f2 AS (SELECT lang, w, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING f >= 10),
f3 AS (SELECT lang, w, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING f >= 10),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
two AS (
    SELECT c.lang, c.w || ' ' || c.w2 AS phrase, c.f AS a, x.f AS l, y.f AS r,
        1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f) AS score
    FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.w = c.w JOIN f1 y ON y.lang = c.lang AND y.w = c.w2),
cuts AS (
    SELECT c.lang, c.w || ' ' || c.w2 || ' ' || c.w3 AS phrase, c.f AS a, x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2,
        1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * yz.f) AS s1,
        1000000::HUGEINT * c.f * c.f // (xy.f::HUGEINT * z.f) AS s2
    FROM f3 c
    JOIN f1 x ON x.lang = c.lang AND x.w = c.w JOIN f2 yz ON yz.lang = c.lang AND yz.w = c.w2 AND yz.w2 = c.w3
    JOIN f2 xy ON xy.lang = c.lang AND xy.w = c.w AND xy.w2 = c.w2 JOIN f1 z ON z.lang = c.lang AND z.w = c.w3),
longer AS (
    SELECT lang, phrase, max(f) AS most
    FROM (SELECT lang, w || ' ' || w2 AS phrase, f FROM f3 UNION ALL SELECT lang, w2 || ' ' || w3, f FROM f3)
    GROUP BY ALL),
kept AS (
    SELECT two.* FROM two LEFT JOIN longer USING (lang, phrase) WHERE coalesce(100 * most < 50 * a, true)
    UNION ALL
    SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
    FROM cuts),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _lines(text: str) -> str:
    """SQL for the canonical lines of ``text``."""
    rights = r"(?m)^[^\p{L}\p{N}\n]*(?:(?:copyright\b|©|\(c\)).*|all rights reserved[^\p{L}\p{N}\n]*)$"
    form = rf"regexp_replace(lower(coalesce({text}, '')), '\r\n?', chr(10), 'g')"
    form = f"replace(regexp_replace({form}, '{rights}', '', 'g'), 'https://', 'http://')"
    form = rf"regexp_replace({form}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    for american, british in SPELLINGS:
        form = f"replace({form}, '{british}', '{american}')"
    return f"list_filter(list_transform(string_split({form}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"


LICENCE_SCAN = f"""
WITH known AS (
    SELECT array_to_string({_lines("text")}, ' ') AS form, min(licence) AS licence
    FROM (VALUES {", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in KNOWN.items())}) AS k(licence, text)
    GROUP BY form HAVING form <> ''),
docs AS (SELECT row_number() OVER () AS row, doc_id, {_lines("text")} AS lines FROM documents),
notices AS (
    SELECT row, string_agg(DISTINCT licence, ';' ORDER BY licence) AS notices
    FROM (SELECT row, unnest(lines) AS line FROM docs) JOIN known ON line = form GROUP BY row)
SELECT doc_id, sha256(array_to_string(lines, ' ')) AS digest, licence, coalesce(notices, '') AS notices
FROM docs LEFT JOIN known ON form = array_to_string(lines, ' ') LEFT JOIN notices USING (row)
"""

ORACLE_SQL = {
    "op2_threshold_search": THRESHOLD_SEARCH,
    "op3_source_mix": SOURCE_MIX,
    "op8_licence_scan": LICENCE_SCAN,
    "op10_chat_format": CHAT_FORMAT,
    "op11_warc_files": WARC_FILES,
    "op12_infill": INFILL,
    "op13_phrase_mining": PHRASE_MINING,
}
