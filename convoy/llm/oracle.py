"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

from convoy.llm.licenses import templates_and_texts


DECONTAMINATION = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS gram,
         unnest(range(1, len(w) - n + 2)) AS i
  FROM doc, lengths WHERE len(w) >= n
), hit AS (SELECT DISTINCT doc_id, item_id, i, n FROM grams JOIN win USING (gram, n)), words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


SUBSTRING_DEDUP = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS gram,
         unnest(range(1, len(w) - 11)) AS i
  FROM doc WHERE len(w) >= 13
),
first AS (SELECT gram, min(doc_id) AS owner FROM win GROUP BY gram HAVING min(doc_id) <> max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN first USING (gram) WHERE doc_id > owner),
cut AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM doc LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


LINE_DEDUP = r"""
WITH doc AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
win AS (
  SELECT doc_id, unnest(list_transform(range(1, len(l) - 1), lambda i: array_to_string(l[i:i + 2], chr(10)))) AS w,
         unnest(range(1, len(l) - 1)) AS i
  FROM doc WHERE len(l) >= 3
),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM win WHERE regexp_matches(w, '\S')),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 3)) AS p FROM ranked WHERE n > 1),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
line AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM doc),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS kept FROM line ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CASE WHEN text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM doc LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

WARC = r"""
WITH page AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
newest AS (SELECT h, max(page_id) AS newest FROM page GROUP BY h),
bits AS (
  SELECT h, newest, array_to_string(list_transform(string_split(sha1(h), ''), lambda x: CASE x
    WHEN '0' THEN '0000' WHEN '1' THEN '0001' WHEN '2' THEN '0010' WHEN '3' THEN '0011' WHEN '4' THEN '0100' WHEN '5' THEN '0101'
    WHEN '6' THEN '0110' WHEN '7' THEN '0111' WHEN '8' THEN '1000' WHEN '9' THEN '1001' WHEN 'a' THEN '1010' WHEN 'b' THEN '1011'
    WHEN 'c' THEN '1100' WHEN 'd' THEN '1101' WHEN 'e' THEN '1110' ELSE '1111' END), '') AS b
  FROM newest
),
named AS (
  SELECT h, newest, array_to_string(list_transform(range(1, 161, 5), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * CAST(substr(b, i, 1) AS INT) + 8 * CAST(substr(b, i + 1, 1) AS INT) + 4 * CAST(substr(b, i + 2, 1) AS INT)
      + 2 * CAST(substr(b, i + 3, 1) AS INT) + CAST(substr(b, i + 4, 1) AS INT), 1)), '') AS mark
  FROM bits
)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, mark AS payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM page JOIN named USING (h)
"""

LICENSES = r"""
WITH template(name, t) AS (VALUES @TEMPLATES@),
part AS (
  SELECT doc_id, 0 AS u, text AS t FROM documents
  UNION ALL SELECT doc_id, unnest(range(1, len(l) + 1)), unnest(l) FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
),
part_word AS (SELECT doc_id, u, list_transform(regexp_extract_all(t, '[A-Za-z0-9]+'), lambda x: lower(x)) AS w FROM part),
template_word AS (SELECT name, list_transform(regexp_extract_all(t, '[A-Za-z0-9]+'), lambda x: lower(x)) AS w FROM template),
part_gram AS (
  SELECT doc_id, u, size, g, count(*) AS n
  FROM (SELECT doc_id, u, len(w) - 1 AS size, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
        FROM part_word WHERE len(w) > 1) GROUP BY ALL
),
template_gram AS (
  SELECT name, size, g, count(*) AS n
  FROM (SELECT name, len(w) - 1 AS size, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
        FROM template_word WHERE len(w) > 1) GROUP BY ALL
),
dice AS (
  SELECT doc_id, u, name, q.size AS size, CAST(2 * sum(least(p.n, q.n)) AS DOUBLE) / (p.size + q.size) AS d
  FROM part_gram p JOIN template_gram q USING (g) GROUP BY doc_id, u, name, p.size, q.size
),
-- the best template of every line, and of the whole text where that beats all its lines
place AS (
  SELECT * FROM dice WHERE d >= 0.8 QUALIFY row_number() OVER (PARTITION BY doc_id, u ORDER BY d DESC, size DESC, name) = 1
),
top AS (SELECT doc_id, u FROM place QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d DESC, size DESC, name, u DESC) = 1),
found AS (
  SELECT p.doc_id, name, max(d) AS d FROM place p JOIN top t USING (doc_id) WHERE (t.u = 0) = (p.u = 0) GROUP BY p.doc_id, name
),
best AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM found QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d DESC, name) = 1)
SELECT doc_id, name AS license, d AS dice, CAST(coalesce(n, 0) AS BIGINT) AS n_licenses FROM documents LEFT JOIN best USING (doc_id)
"""

RANKED_SEARCH = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark
), total AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM doc),
held AS (
  SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS t FROM doc)
  WHERE t IN (SELECT t FROM item) GROUP BY ALL
),
weight AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM held GROUP BY t), total
),
impact AS (SELECT doc_id, t, (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)) AS i FROM held, total),
score AS (
  SELECT item_id, doc_id, CAST(sum(w * i) AS BIGINT) AS score
  FROM item JOIN weight USING (t) JOIN impact USING (t) GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    templates = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in templates_and_texts().items())
    return {
        "op2_licenses": LICENSES.replace("@TEMPLATES@", templates),
        "op3_warc": WARC,
        "op6_line_dedup": LINE_DEDUP,
        "op8_decontamination": DECONTAMINATION,
        "op10_substring_dedup": SUBSTRING_DEDUP,
        "op12_ranked_search": RANKED_SEARCH,
    }
