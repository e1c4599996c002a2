"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

#: op4: every URL against every rule directly.  op6: the rows of a conversation in their order;
#: the formatted length is the texts' and roles' length, the marks, and a backslash for every
#: backslash and control string in them.  op12: every term of every item against every document.
#: op13: nodes level by level; each leaf is folded with its siblings one after another.
SQL = {
    "op4_url_filters": r"""
WITH rules(r_host, r_path, action) AS (VALUES
    ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
        THEN split_part(split_part(substr(url, strpos(url, '://') + 3), '?', 1), '#', 1)
        ELSE '' END AS place FROM pages),
parsed AS (SELECT page_id, place,
        translate(split_part(place, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') AS host,
        CASE WHEN strpos(place, '/') > 0 THEN substr(place, strpos(place, '/')) ELSE '' END AS path
    FROM cut),
numbered AS (SELECT row_number() OVER () AS n, * FROM parsed),
fits AS (SELECT n, r_host || r_path AS rule, action, row_number() OVER (
            PARTITION BY n ORDER BY length(r_host || r_path) DESC, length(r_host) DESC,
            action DESC) AS nth
    FROM numbered JOIN rules
      ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM numbered LEFT JOIN (SELECT * FROM fits WHERE nth = 1) USING (n)""",
    "op6_chat_formatting": r"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                     (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (SELECT *,
    replace(replace(replace(replace(replace(text, chr(92), '##'), '<s>', '<#s>'),
        '</s>', '<#/s>'), '[INST]', '[#INST]'), '[/INST]', '[#/INST]') AS body FROM rows)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
        AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    CAST(sum(length(body) + length(role) + 8
             + CASE WHEN role = 'user' THEN 15 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id""",
    "op12_ranked_lexical_search": r"""
WITH doc_terms AS (SELECT d, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS d, doc_id, text FROM documents)),
lengths AS (SELECT d, doc_id, count(*) AS n FROM doc_terms GROUP BY d, doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
measured AS (SELECT d, doc_id, 100 - 50 + (50 * n * docs) // terms AS m FROM lengths, totals),
tfs AS (SELECT d, term, count(*) AS tf FROM doc_terms GROUP BY d, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), totals),
item_terms AS (SELECT DISTINCT i, item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
scored AS (SELECT i, item_id, d, doc_id,
        CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
    FROM item_terms JOIN tfs USING (term) JOIN weights USING (term) JOIN measured USING (d)
    GROUP BY i, item_id, d, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
      FROM scored WHERE score > 0) WHERE rank <= 50""",
    "op13_merkle_manifest": r"""
WITH RECURSIVE leaves AS (SELECT *, sha256(body) AS leaf
    FROM (SELECT doc_id, lang, n_chars,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') AS f1,
        coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
            AS f2,
        coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS f3,
        coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS f3_tampered,
        coalesce(strlen(text) || ':' || text, '-') AS f4, f1 || f2 || f3 || f4 AS body,
        xor(4294967295, list_reduce(
            [4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''),
                                                   lambda c: ascii(c)::BIGINT),
            lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z:
                CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) AS crc
    FROM documents)),
placed AS (SELECT doc_id, lang, leaf,
        CASE WHEN crc % 7 = 0 THEN sha256(f1 || f2 || f3_tampered || f4) ELSE leaf END AS now,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes(lang, level, pos, h, n) AS (
    SELECT lang, 0, pos, leaf, n FROM placed
    UNION ALL
    SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
    FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2, n),
tops AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
                count(*) OVER () AS n FROM nodes WHERE n = 1),
upper_nodes(level, pos, h, n) AS (
    SELECT 1000, pos, subroot, n FROM tops
    UNION ALL
    SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
    FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 2, n),
numbered AS (SELECT p.*, row_number() OVER () AS k, t.subroot, t.pos AS top_pos
    FROM placed p JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang),
steps AS (
    SELECT k, l.level, p.pos >> l.level AS own, s.h AS sibling FROM numbered p
    JOIN (SELECT DISTINCT lang, level FROM nodes WHERE n > 1) l
      ON p.lang IS NOT DISTINCT FROM l.lang
    LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = l.level
      AND s.pos = xor(p.pos >> l.level, 1)
    UNION ALL
    SELECT k, l.level, p.top_pos >> (l.level - 1000), s.h FROM numbered p
    CROSS JOIN (SELECT DISTINCT level FROM upper_nodes WHERE n > 1) l
    LEFT JOIN upper_nodes s ON s.level = l.level AND s.pos = xor(p.top_pos >> (l.level - 1000), 1)),
paths AS (SELECT k, coalesce(string_agg(sibling, '' ORDER BY level), '') AS siblings,
    list(CASE WHEN sibling IS NULL THEN '-' WHEN own % 2 = 1 THEN '<' || sibling
              ELSE '>' || sibling END ORDER BY level) AS sides FROM steps GROUP BY k)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM (SELECT *, (SELECT h FROM upper_nodes WHERE n = 1) AS root,
    list_reduce([now] || coalesce(sides, []), lambda h, s: CASE s[1]
        WHEN '<' THEN sha256(s[2:] || h) WHEN '>' THEN sha256(h || s[2:]) ELSE sha256(h) END)
        AS folded_root
    FROM numbered LEFT JOIN paths USING (k))""",
}
