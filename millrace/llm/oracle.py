"""The same as plain SQL, where SQL can say it."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), counted AS (
    SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, (VALUES (1), (2), (3)) AS s(k))
    GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k >= 2 AND f >= 10
), longer AS (
    SELECT lang, array_to_string(list_slice(w, i, i + 1), ' ') AS phrase, max(a) AS around
    FROM candidates, (VALUES (1), (2)) AS s(i) WHERE k = 3 GROUP BY ALL
), left_over AS (
    SELECT c.* FROM candidates c LEFT JOIN longer USING (lang, phrase) WHERE around IS NULL OR 100 * around < 50 * a
), cuts AS (
    SELECT lang, phrase, a, cut, array_to_string(list_slice(w, 1, cut), ' ') AS part,
           array_to_string(list_slice(w, cut + 1, k), ' ') AS rest
    FROM left_over, (VALUES (1), (2)) AS s(cut) WHERE cut < k
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
           (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
    FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.part
    JOIN counted y ON y.lang = c.lang AND y.phrase = c.rest
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM placed JOIN totals USING (lang) WHERE rank <= 2000
"""

MIXTURE = r"""
WITH sized AS (
    SELECT doc_id, source, text,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source
), filling AS (  -- the sources that are full come first in the order of size by weight
    SELECT *, sum(3 * source_size) OVER before AS taken, sum(weight) OVER before AS heavy,
           sum(source_size) OVER () AS whole, sum(weight) OVER () AS weights
    FROM sources
    WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
    SELECT *, whole - coalesce(taken, 0) AS rest, weights - coalesce(heavy, 0) AS open_weight,
           (whole - coalesce(taken, 0))::DOUBLE * weight / (weights - coalesce(heavy, 0))::DOUBLE > 3 * source_size AS is_full
    FROM filling
), one AS (
    SELECT whole - coalesce(sum(3 * source_size) FILTER (is_full), 0) AS rest,
           weights - coalesce(sum(weight) FILTER (is_full), 0) AS open_weight
    FROM levels GROUP BY whole, weights
), targets AS (
    SELECT l.source, l.source_size,
           least(o.rest::DOUBLE * l.weight / o.open_weight::DOUBLE, (3 * l.source_size)::DOUBLE) AS target
    FROM levels l, one o
), parted AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * 4294967296) AS HUGEINT) ELSE 0 END AS parts,
           CAST('0x' || substr(md5('0|' || coalesce(source, '')), 1, 8) AS BIGINT) AS start
    FROM targets
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS LAST) AS place FROM sized
), copied AS (
    SELECT p.doc_id, p.source, p.size, t.source_size, t.target,
           CAST((p.place * t.parts + t.start) // 4294967296 - ((p.place - 1) * t.parts + t.start) // 4294967296 AS BIGINT) AS copies
    FROM placed p JOIN parted t ON p.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM copied
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED_SEARCH = rf"""
WITH worded AS (
    SELECT doc_id, row_number() OVER () AS row_nr, {_TERMS} AS w FROM documents
), held AS (
    SELECT row_nr, doc_id, len(w) AS n, unnest(w) AS term FROM worded
), whole AS (
    SELECT count(DISTINCT row_nr) AS documents, count(*) AS words FROM held
), counts AS (
    SELECT row_nr, doc_id, n, term, count(*) AS tf FROM held GROUP BY ALL
), wanted AS (
    SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, whole GROUP BY term, documents
), scored AS (
    SELECT item_id, row_nr, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // words)))) AS score
    FROM wanted JOIN counts USING (term) JOIN weights USING (term), whole
    GROUP BY item_id, row_nr, doc_id
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM placed WHERE rank <= 10
"""


def llm_oracles() -> dict[str, str]:
    return {"op11_collocations": COLLOCATIONS, "op12_mixture": MIXTURE, "op13_ranked_search": RANKED_SEARCH}
