"""SQL twins of the text queries, for engines that run them over the same tables."""

from __future__ import annotations

from tierkit.llm import curriculum, quality

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_AZ = r"A-Za-z\x{80}-\x{10FFFF}"
_CLASSES = {
    "lower": r"[a-z\x{80}-\x{10FFFF}]",
    "upper": "[A-Z]",
    "digit": "[0-9]",
    "stop": r"[.,;:!?''\"()-]",
    "mark": "[#*$%&|<>]",
    "other": rf"[^\x20\x09-\x0D{_AZ}0-9.,;:!?''\"()#*$%&|<>-]",
}


def _entropy(p: str, q: str) -> str:
    """SQL of the terms p log2(p / m) + q log2(q / m) for m between both."""
    half = f"(({p} + {q}) / 2)"
    one = "CASE WHEN {x} > 0 THEN {x} * log2({x} / {m}) ELSE 0 END"
    return f"({one.format(x=p, m=half)} + {one.format(x=q, m=half)})"


QUALITY = rf"""
WITH texts AS (
    SELECT doc_id, lang, coalesce(text, '') AS t, {WORDS.format("coalesce(text, '')")} AS w FROM documents
), placed AS (
    SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS x FROM placed WHERE i + 7 <= len(w)
), covered AS (
    SELECT doc_id, count(DISTINCT j) AS n FROM (
        SELECT doc_id, unnest(range(i, i + 8)) AS j FROM (
            SELECT *, count(*) OVER (PARTITION BY doc_id, x) AS c FROM windows) WHERE c > 1) GROUP BY 1
), lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (
        SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM texts)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1
), base AS (
    SELECT doc_id, lang, t, w, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '{_CLASSES['mark']}')) AS BIGINT) AS n_symbols,
        CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
        len(w) < {quality.LEAST_WORDS} OR 100 * coalesce(covered.n, 0) > {quality.MOST_REPEATED_PERCENT} * len(w)
            AS base_failed
    FROM texts LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), classes AS (
    {" UNION ALL ".join(f"SELECT doc_id, lang, base_failed, '{k}' AS class, len(regexp_extract_all(t, '{p}')) AS n FROM base" for k, p in _CLASSES.items())}
), bins AS (
    SELECT doc_id, lang, base_failed, CASE WHEN regexp_matches(x, '^[{_AZ}]') THEN x ELSE '' END AS bin, count(*) AS n
    FROM (SELECT doc_id, lang, base_failed, unnest(w) AS x FROM base) GROUP BY ALL
), counted AS (
    SELECT lang, bin, sum(n) AS n FROM bins WHERE NOT base_failed AND lang IS NOT NULL GROUP BY 1, 2
), totals AS (
    SELECT lang, sum(n) AS total FROM counted GROUP BY 1
), langs AS (
    SELECT * FROM totals WHERE total > 0 AND total >= CAST({quality.LEAST_SHARE} AS DOUBLE) * (SELECT sum(total) FROM totals)
), common AS (
    SELECT lang, bin, n / total AS q FROM counted JOIN langs USING (lang)
    WHERE n >= CAST({quality.COMMON_SHARE} AS DOUBLE) * total OR bin = ''
), class_refs AS (
    SELECT lang, class, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q FROM classes JOIN langs USING (lang)
    WHERE NOT base_failed GROUP BY 1, 2
), class_far AS (
    SELECT c.doc_id, r.lang, sqrt(greatest(sum({_entropy('p', 'q')}) / 2, 0)) AS far
    FROM (SELECT doc_id, class, n / greatest(sum(n) OVER (PARTITION BY doc_id), 1) AS p FROM classes) c
    JOIN class_refs r USING (class) GROUP BY 1, 2
), word_grid AS (
    SELECT b.doc_id, k.lang, coalesce(d.n, 0) / greatest(b.n_words, 1) AS p, q
    FROM base b CROSS JOIN common k LEFT JOIN bins d ON d.doc_id = b.doc_id AND d.bin = k.bin
), word_far AS (
    SELECT doc_id, lang, sqrt(greatest((terms + {_entropy('rest_p', 'rest_q')}) / 2, 0)) AS far FROM (
        SELECT doc_id, lang, sum({_entropy('p', 'q')}) AS terms, 1 - sum(p) AS rest_p, 1 - sum(q) AS rest_q
        FROM word_grid GROUP BY 1, 2)
), near AS (
    SELECT b.doc_id, bool_or((c.far <= {quality.CLASS_LIMIT} OR b.word_chars < {quality.LEAST_CLASS_CHARS})
        AND (w.far <= {quality.WORD_LIMIT} OR b.n_words < {quality.LEAST_COMMON_WORDS})) AS near
    FROM base b JOIN class_far c ON c.doc_id = b.doc_id JOIN word_far w ON w.doc_id = c.doc_id AND w.lang = c.lang
    GROUP BY 1
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND coalesce(near, true) AS kept
FROM base LEFT JOIN near USING (doc_id)
"""

SPANS = rf"""
WITH words AS (
    SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents
), placed AS (
    SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS x FROM placed WHERE i + 12 <= len(w)
), firsts AS (
    SELECT x, min(doc_id) AS first_doc FROM windows GROUP BY x
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN firsts USING (x) WHERE doc_id > first_doc
), kept AS (
    SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS t FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
), counted AS (
    SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)
"""

_W1, _W2, _W3 = curriculum.WEIGHTS
CURRICULUM = rf"""
WITH sized AS (
    SELECT doc_id, source, CAST(len({WORDS.format("coalesce(text, '')")}) AS BIGINT) AS size,
        substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS rank FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM sized GROUP BY 1
), weighed AS (
    SELECT *, 2 * source_size AS cap, CASE place % 3 WHEN 0 THEN {_W1} WHEN 1 THEN {_W2} ELSE {_W3} END AS weight FROM sources
), levels AS (
    SELECT *, (CAST(sum(source_size) OVER () * {curriculum.SHARE_PERCENT} AS DOUBLE) / 100
        - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
), goals AS (
    SELECT source, source_size, least((SELECT level FROM levels WHERE level * weight <= cap ORDER BY cap / weight, place LIMIT 1)
        * weight, CAST(cap AS DOUBLE)) AS target
    FROM levels
), queued AS (
    SELECT doc_id, size, source_size, target,
        sum(size) OVER (PARTITION BY sized.source ORDER BY rank, doc_id ROWS UNBOUNDED PRECEDING) - size AS start
    FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source
)
SELECT doc_id, size, source_size, target, CAST(size * (CASE WHEN start + size / 2 < target THEN 1 ELSE 0 END
    + CASE WHEN start + size / 2 + source_size < target THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM queued
"""

NEAR = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, {WORDS.format(f"coalesce({_LOWER}, '')")} AS w FROM documents
), sets AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM sets GROUP BY 1
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), both_ways AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
    SELECT doc_id, doc_id AS r FROM documents UNION SELECT doc_id, b FROM reach JOIN both_ways ON r = a
), least_reached AS (
    SELECT doc_id, min(r) AS component_id FROM reach GROUP BY 1
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least_reached USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
