"""DuckDB SQL for the corpus queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op9_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
     g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""

ORACLES["op7_warc_round_trip"] = """
WITH p AS (SELECT page_id, regexp_replace(url, '[\\x00-\\x20\\x7F]', '%20', 'g') AS url, coalesce(html, '') AS body FROM pages),
     d AS (SELECT page_id, url, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
     w AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM d)
SELECT page_id, url, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM w
"""

# Words in order: SQL has no other way to number matches than to unnest the list of them.
_WORDS = r"""
words AS (
    SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all({text}, '[^\x20\x09-\x0D]+') AS ws FROM documents)
)
"""

ORACLES["op8_substring_dedup"] = f"""
WITH {_WORDS.format(text="coalesce(text, '')")},
windows AS (
    SELECT doc_id, i, word, md5(string_agg(word, ' ') OVER following) AS content, count(*) OVER following AS n
    FROM words WINDOW following AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
),
repeated AS (
    SELECT doc_id, i, word, n = 20 AND row_number() OVER (PARTITION BY content, n ORDER BY doc_id, i) > 1 AS again FROM windows
),
covered AS (
    SELECT doc_id, i, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
    FROM repeated
),
kept AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text
    FROM covered GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

ORACLES["op10_ngram_jaccard_join"] = f"""
WITH RECURSIVE {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")},
windows AS (
    SELECT doc_id, i, string_agg(word, ' ') OVER following AS shingle, count(*) OVER following AS n
    FROM words WINDOW following AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)
),
shingles AS (SELECT DISTINCT doc_id, shingle FROM windows WHERE n = 5 OR i = 1),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y USING (shingle)
    WHERE x.doc_id <> y.doc_id GROUP BY a, b
),
links AS (
    SELECT a, b FROM shared o JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * o.n >= 75 * (x.n + y.n - o.n)
),
reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
),
smallest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d JOIN smallest USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

_TERMS = r"""
regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')
"""

ORACLES["op13_ranked_search"] = f"""
WITH terms AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
totals AS (SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sizes),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
held AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, totals GROUP BY term, all_docs
),
scores AS (
    SELECT item_id, doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * all_docs) // all_terms)))) AS BIGINT) AS score
    FROM wanted JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
    GROUP BY item_id, doc_id
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
