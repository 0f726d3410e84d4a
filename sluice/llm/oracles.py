"""DuckDB SQL for operators whose results are determined by their contracts, the long way: all windows, all sets."""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def near_duplicates(k: int = 5, percent: int = 75) -> str:
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW}, {_WORDS}) AS w FROM documents),
e AS (SELECT doc_id, w, least({k}, len(w)) AS k FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM e)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= {percent} * (na.n + nb.n - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id, min(r.b) = d.doc_id AS kept
FROM d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id"""


def passages(k: int = 20) -> str:
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
v AS (SELECT doc_id, i, array_to_string(w[i:i + {k - 1}], ' ') AS words FROM (SELECT doc_id, w, unnest(range(1, len(w) - {k - 2})) AS i FROM d WHERE len(w) >= {k})),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY words ORDER BY doc_id, i) AS r FROM v),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + {k})) AS p FROM f WHERE r > 1),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
y AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM x ANTI JOIN g USING (doc_id, p) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN y USING (doc_id)"""


def leaks(k: int = 5, percent: int = 75) -> str:
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, {_WORDS}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOW}, {_WORDS}) AS w FROM benchmark WHERE item_id IS NOT NULL),
i AS (SELECT item_id, w, len(w) AS n, least({k}, len(w)) AS k FROM b WHERE len(w) > 0),
bs AS (SELECT item_id, n, k, array_to_string(w[j:j + k - 1], ' ') AS s, count(*) AS c FROM (SELECT *, unnest(range(1, n - k + 2)) AS j FROM i) GROUP BY ALL),
ds AS (SELECT doc_id, len(w) AS m, k, j - 1 AS p, array_to_string(w[j:j + k - 1], ' ') AS s
  FROM (SELECT d.*, k, unnest(range(1, len(w) - k + 2)) AS j FROM d, (SELECT DISTINCT k FROM i) WHERE len(w) >= k)),
h AS (SELECT doc_id, m, item_id, n, k, p, s, c FROM ds JOIN bs USING (k, s)),
a AS (SELECT *, unnest(CASE WHEN m < n THEN [0] ELSE range(greatest(0, p - (n - k)), least(p, m - n) + 1) END) AS start FROM h),
t AS (SELECT doc_id, item_id, m, n, k, start, s, least(count(*), any_value(c)) AS c FROM a GROUP BY doc_id, item_id, m, n, k, start, s),
u AS (SELECT doc_id, item_id, start, least(m, n) AS n_words, sum(c) AS same, least(m, n) + n - 2 * k + 2 - sum(c) AS every FROM t GROUP BY doc_id, item_id, m, n, k, start)
SELECT doc_id, item_id, start::BIGINT AS start, n_words::BIGINT AS n_words, same::DOUBLE / every::DOUBLE AS similarity FROM u WHERE 100 * same >= {percent} * every
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY same::DOUBLE / every::DOUBLE DESC, start) = 1"""
