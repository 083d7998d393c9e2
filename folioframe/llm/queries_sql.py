"""The same results in SQL, where SQL can express them on whole tables."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op2_perspectives"] = r"""
WITH t AS (
    SELECT conv_id, turn, role AS speaker, replace(coalesce(text, ''), '<|', '< |') AS words FROM conversations
), p AS (
    SELECT *, (sum(length(words) + 64) OVER w - length(words) - 64) // 16777216 AS part
    FROM t
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker NULLS FIRST, words ROWS UNBOUNDED PRECEDING)
), s AS (
    SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker IS DISTINCT FROM 'system'
), r AS (
    SELECT p.conv_id, perspective, part, turn, speaker, words, words || '<|im_end|>' AS body,
        speaker IS NOT DISTINCT FROM perspective AS trained,
        '<|im_start|>' || CASE WHEN speaker IS NOT DISTINCT FROM perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system'
            ELSE 'user' || coalesce(' name=' || replace(regexp_replace(speaker, '[\p{Cc}\x{2028}\x{2029}]+', ' ', 'g'), '<|', '< |'), '')
            END || chr(10) AS head
    FROM p JOIN s ON p.conv_id IS NOT DISTINCT FROM s.conv_id
), o AS (
    SELECT *, sum(length(head) + length(body)) OVER w AS last, row_number() OVER w AS place
    FROM r
    WINDOW w AS (PARTITION BY conv_id, part, perspective ORDER BY turn NULLS FIRST, speaker NULLS FIRST, words ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, perspective, CAST(part AS BIGINT) AS part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY place) AS text,
    coalesce(string_agg(CAST(last - length(body) AS BIGINT) || '-' || CAST(last AS BIGINT), ',' ORDER BY place)
        FILTER (WHERE trained), '') AS spans,
    CAST(sum(CASE WHEN trained THEN length(body) ELSE 0 END) AS BIGINT) AS n_trained
FROM o GROUP BY conv_id, part, perspective
"""

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

SQL["op4_repeated_passages"] = rf"""
WITH d AS (
    SELECT doc_id, coalesce({_WORDS.format(text="text")}, CAST([] AS VARCHAR[])) AS w FROM documents
), starts AS (
    SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS k FROM starts
), again AS (
    SELECT k FROM windows GROUP BY k HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows SEMI JOIN again USING (k)
), words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
), marked AS (
    SELECT words.doc_id, word, words.i, gone.i IS NOT NULL AS removed
    FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i
), sums AS (
    SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed,
        string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT removed) AS kept
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN sums ON d.doc_id = sums.doc_id
"""

_LOWER = "translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH_WORDS = rf"regexp_extract_all({_LOWER.format(text='text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op8_winnowing"] = rf"""
WITH items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, {_BENCH_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS k
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0)
), d AS (
    SELECT doc_id, {_BENCH_WORDS} AS w FROM documents
), runs AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
    FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
    )
), hits AS (
    SELECT doc_id, i, runs.n, item FROM runs JOIN windows ON runs.k = windows.k AND runs.n = windows.n
), words AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN found ON d.doc_id = found.doc_id
"""

SQL["op10_minhash"] = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce({_WORDS.format(text=_LOWER.format(text="text"))}, CAST([] AS VARCHAR[])) AS w FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n
    FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT u, v FROM pairs JOIN sizes AS x ON x.doc_id = u JOIN sizes AS y ON y.doc_id = v
    WHERE 100 * pairs.n >= 80 * (x.n + y.n - pairs.n)
), edges AS (
    SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach AS (
    SELECT doc_id AS node, doc_id AS seen FROM d
    UNION
    SELECT reach.node, edges.v FROM reach JOIN edges ON reach.seen = edges.u
), least_seen AS (
    SELECT node, min(seen) AS component_id FROM reach GROUP BY node
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN sizes ON d.doc_id = sizes.doc_id JOIN least_seen ON node = d.doc_id
"""

SQL["op11_phrases"] = rf"""
WITH d AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format(text="text")}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), p AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d
), grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p CROSS JOIN (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)
), f AS (
    SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY lang, k, phrase
), c AS (
    SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10
), cuts AS (
    SELECT c.lang, c.phrase, c.k, c.a, cut, l.a AS l, r.a AS r,
        CAST(1000000::HUGEINT * c.a * c.a // (l.a::HUGEINT * r.a) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) AS c
    JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ')
    JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), around AS (
    SELECT lang, array_to_string(w[s:s + 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT lang, w, a, unnest([1, 2]) AS s FROM c WHERE k = 3) GROUP BY ALL
), kept AS (
    SELECT best.* FROM best LEFT JOIN around ON around.lang = best.lang AND around.phrase = best.phrase AND k = 2
    WHERE longer IS NULL OR 100 * longer < 50 * a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
), n AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
