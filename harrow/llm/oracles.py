"""DuckDB SQL of the numbered queries that SQL can express, each a second definition of the result.

Where the operator goes by an index or a sketch, the SQL compares everything, so it is for small tables.
"""

from __future__ import annotations

import string

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase

JACCARD_JOIN = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
walk AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT walk.x, e.b FROM walk JOIN e ON walk.y = e.a),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM walk GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)"""


def url_filter(rules: list[tuple[str, str, str]], kinds: tuple[str, ...], level: float = 0.05) -> str:
    """``rules``: verdict, host, path.  P(rate <= 0.5) is summed as a series of the incomplete beta function."""
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    last = lambda k: f"array_to_string(labels[greatest(len(labels) - {k - 1}, 1):], '.')"
    below = "exp(-(a + b) * ln(2.0) - ln(a) + lgamma(a + b) - lgamma(a) - lgamma(b)) * list_sum(list_transform(range(0, (4 * (a + b))::BIGINT + 400), lambda k: exp(lgamma(a + b + k) - lgamma(a + b) - lgamma(a + 1 + k) + lgamma(a + 1) - k * ln(2.0))))"
    return f"""WITH p AS (SELECT row_number() OVER () AS rid, page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) END AS rest FROM pages),
h AS (SELECT rid, page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}'), '') AS host, coalesce(regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1), '^[^?#]*', 0), '') AS path FROM p),
rules(verdict, host, path) AS (VALUES {values}),
m AS (SELECT rid, r.verdict, r.host || r.path AS rule, row_number() OVER (PARTITION BY rid ORDER BY length(r.host || r.path) DESC) AS k FROM h JOIN rules r ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path)),
j AS (SELECT h.*, m.rule, m.verdict FROM h LEFT JOIN m ON h.rid = m.rid AND k = 1),
hosts AS (SELECT host, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS labels, count(verdict) AS n, count(*) FILTER (verdict = 'block') AS bad FROM j GROUP BY host),
s AS (SELECT *, coalesce(len(labels) > 1 AND length({last(1)}) = 2 AND labels[len(labels) - 1] IN {kinds}, false) AS long FROM hosts),
d AS (SELECT *, CASE WHEN long THEN {last(2)} ELSE {last(1)} END AS suffix, CASE WHEN long THEN {last(3)} ELSE {last(2)} END AS domain FROM s),
t AS (SELECT sum(n)::DOUBLE AS n, sum(bad) / nullif(sum(n), 0)::DOUBLE AS mean FROM d),
q AS (SELECT any_value(mean) AS mean, count(*) AS k, sum(d.n)::DOUBLE AS n, sum(d.n * d.n)::DOUBLE AS nn, sum(d.n * pow(bad / d.n::DOUBLE - mean, 2)) AS s FROM d, t WHERE d.n > 0),
g AS (SELECT mean, CASE WHEN n - nn / n > k - 1 THEN (s / (mean * (1 - mean)) - (k - 1)) / (n - nn / n - (k - 1)) ELSE 1.0 END AS rho, k >= 2 AND mean > 0 AND mean < 1 AND n - nn / n > 0 AS fit FROM q),
z AS (SELECT mean, CASE WHEN fit THEN CASE WHEN rho > 0 THEN least(1000.0, greatest(1.0, (1 - rho) / rho)) ELSE 1000.0 END ELSE 10.0 END AS kappa FROM g),
sr AS (SELECT suffix, (sum(bad) + any_value(kappa * mean)) / (sum(n) + any_value(kappa)) AS rate FROM d, z GROUP BY suffix),
dr AS (SELECT domain, (sum(bad) + any_value(kappa * rate)) / (sum(n) + any_value(kappa)) AS rate FROM d JOIN sr USING (suffix), z GROUP BY suffix, domain),
post AS (SELECT host, bad + kappa * rate AS a, n - bad + kappa * (1 - rate) AS b FROM d JOIN dr USING (domain), z),
judged AS (SELECT host, CASE WHEN a <= 0 THEN false WHEN b <= 0 THEN true ELSE {below} < {level} END AS blocked FROM post)
SELECT page_id, j.host, path, rule, coalesce(verdict, CASE WHEN coalesce(blocked, false) THEN 'block' ELSE 'allow' END) AS verdict FROM j LEFT JOIN judged ON j.host = judged.host"""


EXACT_TOPK = """WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, u.v) DESC, u.vec_id)::INT AS rank, u.vec_id, list_inner_product(q.v, u.v)::BIGINT AS score
FROM u q JOIN u ON u.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0 QUALIFY rank <= 20"""

MIXING = f"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size, ('0x' || left(md5('11/' || coalesce(doc_id::VARCHAR, '') || '/' || md5(coalesce(text, ''))), 15))::BIGINT AS place FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS ordinal FROM d GROUP BY source),
c AS (SELECT *, [3.0, 1.0, 2.0][ordinal % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
lv AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0.0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0.0)) AS level FROM c WINDOW before AS (ORDER BY cap / weight, ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT first(level ORDER BY cap / weight, ordinal) AS level FROM lv WHERE level * weight <= cap),
t AS (SELECT lv.* EXCLUDE (level), CASE WHEN l.level IS NULL THEN cap ELSE least(cap, l.level * weight) END AS target FROM lv, l),
g AS (SELECT *, round(target)::BIGINT AS goal, greatest(1, (n_docs + 1023) // 1024) AS buckets FROM t),
b AS (SELECT *, greatest(1, (sum(goal) OVER () + 999999) // 1000000, least(65536, (sum(goal) OVER () + 4095) // 4096))::BIGINT AS bw FROM g),
n AS (SELECT *, greatest(1, (source_size + bw - 1) // bw) AS nb, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS turns FROM b),
r AS (SELECT *, CASE WHEN nb % 1000003 <> 0 THEN 1000003 ELSE 999983 END AS step, goal - turns * source_size AS rest, nb * bw - source_size AS lacks FROM n),
k AS (SELECT *, ((nb - 1) * step + (ordinal * 7919 + turns * 104729 + 11) % nb) % nb AS short_at, (rest + bw - 1) // bw AS least FROM r),
q AS (SELECT *, CASE WHEN least * bw - CASE WHEN short_at < least THEN lacks ELSE 0 END < rest THEN least + 1 ELSE least END AS more FROM k),
f AS (SELECT *, turns * nb + more AS draws, CASE WHEN rest > 0 THEN rest - ((more - 1) * bw - CASE WHEN short_at < more - 1 THEN lacks ELSE 0 END) END AS last_words FROM q),
o AS (SELECT row_number() OVER () AS rid, doc_id, d.source, size, source_size, target, ordinal, bw, nb, step, draws, last_words,
  coalesce(sum(size) OVER (PARTITION BY ordinal ORDER BY (place >> 20) % buckets, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
x AS (SELECT *, unnest(range(start // bw, (start + size - 1) // bw + 1)) AS block FROM o WHERE size > 0),
y AS (SELECT *, unnest(range(0, (draws + nb - 1) // nb)) AS turn FROM x),
z AS (SELECT *, turn * nb + (block * step + (ordinal * 7919 + turn * 104729 + 11) % nb) % nb AS draw FROM y),
p AS (SELECT rid, sum(greatest(0, least(start + size, block * bw + CASE WHEN draw = draws - 1 THEN coalesce(last_words, bw) ELSE bw END) - greatest(start, block * bw))) AS taken FROM z WHERE draw < draws GROUP BY rid)
SELECT doc_id, source, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM o LEFT JOIN p USING (rid)"""

SUBSTRING_DEDUP = f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS g FROM pos),
hit AS (SELECT doc_id, i FROM g WHERE g IN (SELECT g FROM g GROUP BY g HAVING count(*) > 1)),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS k FROM hit),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM w),
kept AS (SELECT words.doc_id, count(cov.k) AS n_removed, string_agg(word, ' ' ORDER BY words.k) FILTER (cov.k IS NULL) AS kept FROM words LEFT JOIN cov ON words.doc_id = cov.doc_id AND words.k = cov.k GROUP BY words.doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""
