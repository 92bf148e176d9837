"""DuckDB SQL for the operators' queries: plain definitions, none of the operators' methods."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {}

SQL["op7_benchmark_decontamination"] = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest([array_to_string(w[p : p + least(len(w), 10) - 1], ' ')
        FOR p IN range(1, len(w) - least(len(w), 10) + 2)]) AS win
    FROM i WHERE len(w) > 0
), dw AS (
    SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw))
), hit AS (
    SELECT DISTINCT doc_id, dw.n, p, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win
), words AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(p, p + n)) AS place FROM hit) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

SQL["op2_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""

SQL["op4_substring_dedup"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
    SELECT doc_id, p, array_to_string(w[p : p + 12], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d)
), least AS (
    SELECT s, min(doc_id) AS first_id FROM win GROUP BY s
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS place
    FROM win JOIN least USING (s) WHERE first_id < doc_id
), kept AS (
    SELECT doc_id, count(gone.doc_id) AS n_removed,
        string_agg(w[all_words.place], ' ' ORDER BY all_words.place) FILTER (gone.doc_id IS NULL) AS kept
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS place FROM d) AS all_words
    LEFT JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

# crc32 bit by bit; then the cheapest cost of what is left, from the last row to the first, and a walk that
# takes the first letter that keeps to it. Row by row, without runs or matrices.
SQL["op12_conversation_structure_repair"] = r"""
WITH RECURSIVE given AS (
    SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, conv_id, turn, coalesce(role, ' ') AS role,
        coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations
), drawn AS (
    SELECT k, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(k) + 1),
        lambda i: ascii(substr(k, i, 1))::BIGINT)), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 20 AS draw
    FROM (SELECT DISTINCT k FROM given)
), broken AS (
    SELECT g, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
        CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(0, CASE WHEN draw = 3 THEN 2 ELSE 1 END)) AS copy
    FROM given JOIN drawn USING (k) WHERE draw <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text, copy) AS i,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut FROM broken
), faulty AS (
    SELECT *, CASE WHEN cut = '' THEN 'b' WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'd'
        WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault, left(role, 1) AS c,
        lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) AS c0 FROM placed
), counted AS (
    SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
        count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
        count(*) FILTER (i > 1 AND c0 || c NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
    FROM faulty GROUP BY g
), paid AS (
    SELECT g, i, c, role, text, fault IN ('b', 'd') AS must, CASE WHEN fault = 't' THEN 1 ELSE 0 END AS p FROM faulty
), ahead AS (
    SELECT g, n AS i, 0::BIGINT AS v0, 4::BIGINT AS v1, 2::BIGINT AS v2, 0::BIGINT AS v3 FROM counted
    UNION ALL
    SELECT g, i, least(e0, e2 + 2, e3 + 4), least(e1, e2 + 2, e3 + 4), least(e2, e3 + 2), least(e3, e2 + 2)
    FROM (
        SELECT g, ahead.i - 1 AS i,
            least(v0 + 3, CASE WHEN must THEN NULL ELSE least(p + 2 + v2, CASE c WHEN 's' THEN p + v1 WHEN 'u' THEN p + v2 END) END) AS e0,
            least(v1 + 3, CASE WHEN must THEN NULL ELSE least(p + 2 + v2, CASE WHEN c = 'u' THEN p + v2 END) END) AS e1,
            least(v2 + 3, CASE WHEN must THEN NULL ELSE least(p + 2 + v3, CASE WHEN c = 'a' THEN p + v3 END) END) AS e2,
            least(v3 + 3, CASE WHEN must THEN NULL ELSE least(p + 2 + v2, CASE WHEN c = 'u' THEN p + v2 END) END) AS e3
        FROM ahead JOIN paid USING (g, i)
    )
), walk AS (
    SELECT g, 0::BIGINT AS i, 0 AS s, '' AS audit, []::VARCHAR[] AS turns FROM counted
    UNION ALL
    SELECT g, i + (op <> 'I')::INT, CASE op WHEN 'D' THEN s WHEN 'K' THEN CASE WHEN c = 's' THEN 1 WHEN c = 'u' THEN 2 ELSE 3 END
        ELSE nx END, audit || op, CASE op WHEN 'D' THEN turns WHEN 'K' THEN list_append(turns, role || ':' || text)
        WHEN 'R' THEN list_append(turns, nxr || ':' || text) ELSE list_append(turns, nxr || ':') END
    FROM (
        SELECT walk.*, c, role, text, nx, nxr, CASE
            WHEN c IS NOT NULL AND 3 + here[s + 1] = now[s + 1] THEN 'D'
            WHEN 2 + now[nx + 1] = now[s + 1] THEN 'I'
            WHEN NOT must AND (c = 's' AND s = 0 AND p + here[2] = now[1] OR c = 'u' AND s <> 2 AND p + here[3] = now[s + 1]
                OR c = 'a' AND s = 2 AND p + here[4] = now[3]) THEN 'K'
            WHEN NOT must AND p + 2 + here[nx + 1] = now[s + 1] THEN 'R' END AS op
        FROM (SELECT *, CASE WHEN s = 2 THEN 3 ELSE 2 END AS nx, CASE WHEN s = 2 THEN 'assistant' ELSE 'user' END AS nxr FROM walk) AS walk
        JOIN (SELECT g, i, [v0, v1, v2, v3] AS now FROM ahead) AS a USING (g, i)
        LEFT JOIN (SELECT g, i - 1 AS i, [v0, v1, v2, v3] AS here FROM ahead) AS b USING (g, i)
        LEFT JOIN (SELECT g, i - 1 AS i, c, role, text, must, p FROM paid) AS r USING (g, i)
    ) WHERE op IS NOT NULL
), ended AS (
    SELECT g, arg_max(audit, length(audit)) AS audit, arg_max(turns, length(audit)) AS turns FROM walk GROUP BY g
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v0, 0) AS cost, coalesce(audit, '') AS audit,
    sha256(coalesce(array_to_string(turns, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT g, conv_id FROM given) LEFT JOIN counted USING (g) LEFT JOIN ended USING (g)
    LEFT JOIN (SELECT g, v0 FROM ahead WHERE i = 0) USING (g)
"""

SQL["op11_source_divergence_audit"] = r"""
WITH d AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, row_number() OVER () AS d FROM documents
), w AS (
    SELECT lang, source, d, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
    SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT d) >= 3
), langs AS (
    SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), groups AS (
    SELECT DISTINCT lang, source FROM d
), counts AS (
    SELECT g.lang, g.source, k.term, k.total, coalesce(c, 0) AS c FROM groups g JOIN kept k USING (lang)
    LEFT JOIN (SELECT lang, source, term, count(*) AS c FROM w GROUP BY ALL) USING (lang, source, term)
), shares AS (
    SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER (PARTITION BY lang, source) + v) AS p,
        1 + (1000000000::HUGEINT * (total + 1)) // (n + v) AS q
    FROM counts JOIN langs USING (lang)
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= 200
"""
