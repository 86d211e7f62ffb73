"""The queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from loamsift.llm.licenses import TEMPLATES

SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

NOTICES = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))


def bigrams(words: str) -> str:
    return f"list_distinct(list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1]))"


ORACLE = {
    "op1_licenses": rf"""
        WITH templates AS (
            SELECT i, name, {bigrams("w")} AS own
            FROM (SELECT i, name, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM (VALUES {NOTICES}) t(i, name, text))
        ), lines AS (
            SELECT doc_id, regexp_replace(translate(coalesce(text, ''), {LOWER}), '[^a-z0-9\n]+', ' ', 'g') AS text FROM documents
        ), pieces AS (
            SELECT doc_id, 0 AS kind, unnest(string_split(text, chr(10))) AS piece,
                   generate_subscripts(string_split(text, chr(10)), 1) AS number FROM lines
            UNION ALL
            SELECT doc_id, 1, unnest(string_split_regex(text, '\n ?\n')), generate_subscripts(string_split_regex(text, '\n ?\n'), 1) FROM lines
        ), sized AS (
            SELECT doc_id, kind, number, {bigrams("w")} AS own
            FROM (SELECT doc_id, kind, number, regexp_extract_all(piece, '[a-z0-9]+') AS w FROM pieces
                  WHERE kind = 0 OR contains(piece, chr(10)))
        ), compared AS (
            SELECT doc_id, kind, number, name, i, 2.0::DOUBLE * len(list_intersect(s.own, t.own)) / (len(s.own) + len(t.own)) AS dice
            FROM sized s JOIN templates t ON len(s.own) BETWEEN len(t.own) * 0.6 AND len(t.own) * 1.7 AND list_has_any(s.own, t.own)
        ), best AS (
            SELECT * FROM compared WHERE dice >= 0.8
            QUALIFY row_number() OVER (PARTITION BY doc_id, kind, number ORDER BY dice DESC, i) = 1
        ), found AS (
            SELECT doc_id, count(*) AS n_matches, arg_min(name, (-dice, kind, number, i)) AS license, max(dice) AS dice,
                   string_agg(DISTINCT name, ',' ORDER BY name) AS licenses
            FROM best GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n_matches, 0) AS n_matches, license, dice, coalesce(licenses, '') AS licenses
        FROM documents d LEFT JOIN found USING (doc_id)
    """,
    # The level is found at once: with sources by limit over weight, the first ones are full as long
    # as the level of the rest lies above their own limit.
    "op2_mix": rf"""
        WITH docs AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   ('0x' || substr(md5(concat_ws(':', 'mix', doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT / pow(16, 13) AS draw
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   ([3, 1, 2])[(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
            FROM docs GROUP BY source
        ), levels AS (
            SELECT *, source_size * 2.0::DOUBLE AS most,
                   (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER before, 0))
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
            FROM sources
            WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), answer AS (
            SELECT level FROM levels WHERE weight * level <= most ORDER BY source_size / weight, source NULLS LAST LIMIT 1
        ), rates AS (
            SELECT source, source_size, least(most, weight * answer.level) AS target,
                   CASE WHEN source_size > 0 THEN least(most, weight * answer.level) / source_size ELSE 0 END AS rate
            FROM levels, answer
        )
        SELECT doc_id, size, source_size, target,
               ((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
        FROM docs JOIN rates ON docs.source IS NOT DISTINCT FROM rates.source
    """,
    # Every pair that shares a shingle is compared, and labels spread along links until they settle.
    "op3_near_dedup": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s
            FROM words
        ), shingles AS (
            SELECT doc_id, unnest(s) AS shingle FROM sets
        ), pairs AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
            FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM pairs JOIN sets sa ON sa.doc_id = a JOIN sets sb ON sb.doc_id = b
            WHERE 100 * common >= 75 * (len(sa.s) + len(sb.s) - common)
        ), "both" AS (
            SELECT a, b FROM links UNION ALL SELECT b, a FROM links
        ), reached AS (
            SELECT doc_id, doc_id AS label FROM documents
            UNION
            SELECT "both".b, reached.label FROM reached JOIN "both" ON "both".a = reached.doc_id
        )
        SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, min(label) AS component_id, sets.doc_id = min(label) AS kept
        FROM sets JOIN reached USING (doc_id) GROUP BY sets.doc_id, len(s)
    """,
    "op4_exact_dedup": rf"""
        WITH plain AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACE}+', '', 'g')) AS text_sha256,
                   length(coalesce(text, '')) AS points
            FROM documents
        ), ranked AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size,
                   row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) = 1 AS kept
            FROM plain
        )
        SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ranked
    """,
    "op8_line_dedup": rf"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
            FROM documents
        ), keyed AS (
            SELECT *, translate(trim(line, {SPACE_CHARS}), {LOWER}) AS key FROM lines
        ), shared AS (
            SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), marked AS (
            SELECT keyed.*, shared.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone
            FROM keyed LEFT JOIN shared ON keyed.key = shared.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    # All windows of 50 words that two documents hold, merged where they overlap or touch.
    "op10_suffix_array": rf"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), places AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM words
        ), windows AS (
            SELECT doc_id, i, md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS key,
                   count(*) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS n
            FROM places
        ), shared AS (
            SELECT key FROM windows WHERE n = 50 GROUP BY key HAVING count(DISTINCT doc_id) > 1
        ), hits AS (
            SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new
            FROM windows SEMI JOIN shared USING (key) WHERE n = 50
        ), spans AS (
            SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM hits
        )
        SELECT doc_id, min(i)::BIGINT AS start_word, max(i)::BIGINT + 50 AS end_word FROM spans GROUP BY doc_id, span
    """,
    # From the last row to the first, what is left to pay in each of four states (nothing yet, system, user,
    # assistant), with the initials and the text that come of it; then up to three turns put in before the row.
    "op11_dialogues": rf"""
        WITH RECURSIVE steps AS (
            SELECT n, 0 AS k, n::UBIGINT AS c FROM range(256) r(n)
            UNION ALL
            SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM steps WHERE k < 8
        ), checks AS (
            SELECT list(c ORDER BY n) AS t FROM steps WHERE k = 8
        ), named AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS id
            FROM conversations
        ), coded AS (
            SELECT *, xor(list_reduce(
                       list_concat([4294967295::UBIGINT], list_transform(range(1, length(id) + 1), lambda i: ascii(substr(id, i, 1))::UBIGINT)),
                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) % 20 AS fate
            FROM named, checks
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, "copy",
                   CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM coded, (VALUES (0), (1)) c("copy") WHERE fate <> 0 AND ("copy" = 0 OR fate = 3)
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, "copy") AS i,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, "copy") AS nth,
                   lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, "copy") AS earlier,
                   rtrim(text, {SPACE_CHARS}) AS inside
            FROM damaged
        ), judged AS (
            SELECT *, CASE WHEN inside = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                           WHEN right(inside, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
            FROM placed
        ), given AS (
            SELECT conv_id, i, role, text, fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::BIGINT AS late,
                   CASE left(role, 1) WHEN 's' THEN [2, 0, 0, 0] WHEN 'u' THEN [3, 3, 0, 3] WHEN 'a' THEN [0, 0, 4, 0] ELSE [0, 0, 0, 0] END AS goes
            FROM judged
        ), left_over AS (
            SELECT conv_id, max(i) + 1 AS i, [
                {{'c': 0::BIGINT, 'a': '', 'r': ''}},
                {{'c': 4::BIGINT, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}},
                {{'c': 2::BIGINT, 'a': 'I', 'r': chr(10) || 'assistant:'}},
                {{'c': 0::BIGINT, 'a': '', 'r': ''}}] AS v
            FROM given GROUP BY conv_id
            UNION ALL
            SELECT conv_id, i, list_transform([1, 2, 3, 4], lambda s: least(b[s], {{'c': 2 + v2[due[s]].c, 'a': 'I' || v2[due[s]].a, 'r': who[s] || v2[due[s]].r}})) AS v
            FROM (
                SELECT *, list_transform([1, 2, 3, 4], lambda s: least(b[s], {{'c': 2 + v1[due[s]].c, 'a': 'I' || v1[due[s]].a, 'r': who[s] || v1[due[s]].r}})) AS v2
                FROM (
                    SELECT *, list_transform([1, 2, 3, 4], lambda s: least(b[s], {{'c': 2 + b[due[s]].c, 'a': 'I' || b[due[s]].a, 'r': who[s] || b[due[s]].r}})) AS v1
                    FROM (
                        SELECT g.conv_id, g.i, due, who, list_transform([1, 2, 3, 4], lambda s: least(
                                   {{'c': 3 + v[s].c, 'a': 'D' || v[s].a, 'r': v[s].r}},
                                   {{'c': CASE WHEN gone THEN 1000000 ELSE 2 + late + v[due[s]].c END, 'a': 'R' || v[due[s]].a, 'r': who[s] || text || v[due[s]].r}},
                                   CASE WHEN gone OR goes[s] = 0 THEN {{'c': 1000000::BIGINT, 'a': '', 'r': ''}}
                                        ELSE {{'c': late + v[goes[s]].c, 'a': 'K' || v[goes[s]].a, 'r': chr(10) || role || ':' || text || v[goes[s]].r}} END)) AS b
                        FROM left_over l JOIN given g ON g.conv_id IS NOT DISTINCT FROM l.conv_id AND g.i = l.i - 1,
                             (SELECT [3, 3, 4, 3] AS due, [chr(10) || 'user:', chr(10) || 'user:', chr(10) || 'assistant:', chr(10) || 'user:'] AS who)
                    )
                )
            )
        ), counted AS (
            SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
                   count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
                   count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                   count(*) FILTER (WHERE earlier IS NOT NULL AND left(earlier, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv_id
        )
        SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v[1].c, 0) AS cost,
               coalesce(v[1].a, '') AS audit, sha256(substr(coalesce(v[1].r, ''), 2)) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) d
        LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
        LEFT JOIN left_over l ON l.conv_id IS NOT DISTINCT FROM d.conv_id AND l.i = 1
    """,
    # Every document that shares a term with an item is scored. Texts are lower-cased first, so capitals need no class.
    "op13_search": rf"""
        WITH terms AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents
        ), totals AS (
            SELECT count(*) FILTER (WHERE len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM terms
        ), counted AS (
            SELECT doc_id, len(w)::BIGINT AS n, term, count(*) AS tf FROM terms, unnest(w) AS t(term) GROUP BY ALL
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
            FROM counted, totals GROUP BY term, n_docs
        ), items AS (
            SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'))) AS term
            FROM benchmark
        ), scored AS (
            SELECT item_id, doc_id,
                   sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM items JOIN counted USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
    """,
}
