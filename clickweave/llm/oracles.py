"""DuckDB SQL of the operators that SQL can express."""

OP9 = """
SELECT doc_id, keep_id, count(*) OVER (PARTITION BY body) AS group_size, doc_id = keep_id AS kept,
       sha256(body) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS body,
             max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id FROM documents)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, w, least(10, len(w)) AS n FROM (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
    WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS passage
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
windows AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS passage FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, windows.n, item_id FROM windows JOIN p ON windows.n = p.n AND windows.passage = p.passage),
covered AS (SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP5 = rf"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i : array_to_string(w[i : i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.shingle = b.shingle
    WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM pairs JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id
    WHERE 100 * o >= 80 * (nx.n + ny.n - o)),
reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
near AS (SELECT x AS doc_id, min(y) AS smallest FROM reach GROUP BY x),
counted AS (SELECT x AS doc_id, count(*) AS links FROM links GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(smallest, doc_id)) AS component_id,
       coalesce(links, 0) AS n_links
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN near USING (doc_id) LEFT JOIN counted USING (doc_id)
"""

OP10 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS passage FROM (
    SELECT *, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) AS nth FROM windows),
gone AS (SELECT doc_id, list(DISTINCT pos) AS pos FROM (
    SELECT doc_id, unnest(range(i, i + 20)) AS pos FROM ranked WHERE nth > 1) GROUP BY doc_id),
removed AS (SELECT DISTINCT doc_id, unnest(pos) AS pos FROM gone),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text
    FROM words ANTI JOIN removed USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(pos), 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# the pages of these tables mark their article and close it; inside are headings, paragraphs, breaks and inline tags
OP1 = r"""
SELECT page_id, url, text, length(text) AS n_chars FROM (
    SELECT page_id, url, trim(regexp_replace(replace(replace(replace(replace(replace(
        regexp_replace(regexp_replace(
            regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'),
            '</?(h1|p|br)>', ' ', 'g'), '<[^>]*>', '', 'g'),
        '&quot;', '"'), '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS text
    FROM pages)
"""

# crc32 byte by byte; words near by a replacement share what is left without one place, by an insertion a whole word
OP13 = r"""
WITH RECURSIVE
steps AS (SELECT list_transform(range(256), lambda i : list_reduce(list_concat([i], range(8)),
    lambda c, k : xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(
    unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{7,}')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
own AS (SELECT id, run, count(*) AS n FROM runs GROUP BY id, run),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
    string_split(id || ':' || run, ''),
    lambda c : CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
    lambda c, b : xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) AS h FROM own, steps),
spoiled AS (SELECT n, CASE WHEN h % 31 = 0
    THEN run[1 : (h % length(run))::INT] || run[(h % length(run))::INT + 2 :] ELSE run END AS word FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM spoiled
    WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
holes AS MATERIALIZED (SELECT word, n, i, word[1 : i] || word[i + 2 :] AS rest FROM (
    SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b
        ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT holes.word, words.word, words.n FROM holes JOIN words ON rest = words.word
    UNION SELECT words.word, holes.word, holes.n FROM holes JOIN words ON rest = words.word),
best AS (SELECT word, count(*) AS n_near, min({'less': -n, 'other': other}) AS top FROM near GROUP BY word),
judged AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -top.less >= 10 * n THEN top.other END AS form, CASE WHEN -top.less >= 10 * n THEN -top.less END AS form_n
    FROM words LEFT JOIN best USING (word)),
follow AS (SELECT word, form AS root FROM judged WHERE form IS NOT NULL
    UNION SELECT follow.word, form FROM follow JOIN judged ON root = judged.word WHERE form IS NOT NULL),
roots AS (SELECT word, arg_max(root, n) AS root FROM (
    SELECT follow.word, root, words.n FROM follow JOIN words ON root = words.word) GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM judged LEFT JOIN roots USING (word)
"""

ORACLES = {
    "op13_spelling_variants": OP13,
    "op1_html_extraction": OP1,
    "op10_substring_dedup": OP10,
    "op5_ngram_jaccard_join": OP5,
    "op4_benchmark_decontamination": OP4,
    "op9_exact_dedup": OP9,
}
