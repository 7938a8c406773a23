"""SQL of the queries that SQL can express, written from their definitions."""

from __future__ import annotations

from tidemark.llm.licenses import COPYRIGHT, MARKS, NOTICES, SPELLINGS

SUBSTRING_DEDUP = r"""
WITH pieces AS (
    SELECT doc_id, unnest(range(len(p))) AS piece, unnest(p) AS text
    FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D.!?][^.!?\n]*[\x20\x09-\x0D.!?]*') AS p
          FROM documents WHERE text IS NOT NULL)
), words AS (
    SELECT doc_id, piece, unnest(range(len(w))) AS k, len(w) AS n, unnest(w) AS word
    FROM (SELECT doc_id, piece, regexp_extract_all(text, '[^\x20\x09-\x0D.!?]+[\x20\x09-\x0D.!?]*') AS w FROM pieces)
), folded AS (
    SELECT *, lower(regexp_extract(word, '[^\x20\x09-\x0D.!?]+')) AS low FROM words
), parted AS (
    SELECT *, coalesce(sum(CASE WHEN n > 20 AND strlen(low) % 6 = 0 THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id, piece ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part
    FROM folded
), sentences AS (
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY piece, part) - 1 AS i, count(*) AS n,
        string_agg(low, ' ' ORDER BY k) AS folded, string_agg(word, '' ORDER BY k) AS text
    FROM parted GROUP BY doc_id, piece, part
), counted AS (
    SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM sentences
), stops AS (
    SELECT a.doc_id, a.i AS start, min(b.i) AS last
    FROM counted a JOIN counted b
        ON a.doc_id = b.doc_id AND b.i BETWEEN a.i + 2 AND a.i + 19 AND b.upto - a.upto + a.n >= 20
    GROUP BY a.doc_id, a.i
), runs AS (
    SELECT s.doc_id, s.start, s.last, string_agg(c.folded, ' ' ORDER BY c.i) AS run
    FROM stops s JOIN counted c ON c.doc_id = s.doc_id AND c.i BETWEEN s.start AND s.last
    GROUP BY s.doc_id, s.start, s.last
), ranked AS (
    SELECT *, min(doc_id) OVER (PARTITION BY run) AS first FROM runs
), gone AS (
    SELECT DISTINCT c.doc_id, c.i FROM ranked r
    JOIN counted c ON c.doc_id = r.doc_id AND c.i BETWEEN r.start AND r.last WHERE r.doc_id > r.first
), totals AS (
    SELECT c.doc_id, count(*) AS n_sentences, sum(c.n) AS n_words, count(g.i) AS n_removed,
        sum(CASE WHEN g.i IS NOT NULL THEN c.n ELSE 0 END) AS removed_words,
        coalesce(string_agg(c.text, '' ORDER BY c.i) FILTER (WHERE g.i IS NULL), '') AS kept
    FROM counted c LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.i = c.i GROUP BY c.doc_id
)
SELECT t.doc_id, n_sentences::BIGINT AS n_sentences, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
    removed_words::BIGINT AS removed_words, 0::BIGINT AS n_own,
    regexp_extract(d.text, '^[\x20\x09-\x0D.!?]*') || kept AS text
FROM totals t JOIN documents d ON d.doc_id = t.doc_id WHERE n_removed > 0
"""

SOURCE_MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS key
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM sized GROUP BY source
), filled AS (
    SELECT *, 2 * source_size AS cap, sum(source_size) OVER () AS total,
        coalesce(sum(2 * source_size) OVER (ORDER BY (2 * source_size)::DOUBLE / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
        sum(weight) OVER (ORDER BY (2 * source_size)::DOUBLE / weight, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
    FROM sources
), levels AS (
    SELECT *, (total * 1.5::DOUBLE - full_before) / rest AS level FROM filled
), final AS (
    SELECT level FROM levels WHERE cap >= level * weight ORDER BY cap::DOUBLE / weight, source NULLS LAST LIMIT 1
), targets AS (
    SELECT source, source_size, least(cap::DOUBLE, coalesce((SELECT level FROM final), 0) * weight) AS target FROM levels
), placed AS (
    SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS whole,
        coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    (CASE WHEN source_size = 0 THEN 0 ELSE whole // source_size * size
        + greatest(0, least(size, whole % source_size - before)) END)::BIGINT AS taken
FROM placed
"""

QUALITY_RULES = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
    SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM docs)
), doubled AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1
), repeats AS (
    SELECT r, count(DISTINCT i + d) AS n FROM doubled, (VALUES (0), (1), (2)) AS v(d) GROUP BY r
), lines AS (
    SELECT r, doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM docs
), counted AS (
    SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
        lower(trim(regexp_replace(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]', '0', 'g'))) AS norm
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup AS (
    SELECT r, count(*) - count(DISTINCT line) AS n FROM counted GROUP BY r
), often AS (
    SELECT source, norm FROM counted GROUP BY source, norm
    HAVING count(DISTINCT (coalesce(doc_id::VARCHAR, '-'), text)) > 10
), gone AS (
    SELECT c.r, sum(c.words) AS n FROM counted c
    JOIN often o ON o.source IS NOT DISTINCT FROM c.source AND o.norm = c.norm GROUP BY c.r
), base AS (
    SELECT d.doc_id, len(d.w)::BIGINT AS n_words, length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        len(regexp_extract_all(d.text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
        coalesce(repeats.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS removed_words
    FROM docs d LEFT JOIN dup USING (r) LEFT JOIN repeats USING (r) LEFT JOIN gone USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * (n_words - removed_words) >= n_words AS kept
FROM base
"""


def _canonical(text: str) -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    out = f"regexp_replace(lower({text}), {quoted(COPYRIGHT)}, '', 'g')"
    for spelling, other in SPELLINGS:
        out = f"replace({out}, {quoted(spelling)}, {quoted(other)})"
    out = f"translate({out}, {quoted(MARKS)}, {quoted(' ' * len(MARKS))})"
    out = f"regexp_replace({out}, '[\\x20\\t\\x0B-\\x0D]+', ' ', 'g')"
    return f"regexp_replace({out}, '\\x20?\\n\\x20?', chr(10), 'g')"


_LINE = r"trim(regexp_replace({}, '\n+', ' ', 'g'))"

LICENSE_SCANS = f"""
WITH known(license_id, text) AS (VALUES {", ".join("('%s', '%s')" % (n, t.replace("'", "''")) for n, t in NOTICES)}
), digests AS (
    SELECT sha256({_LINE.format(_canonical("text"))}) AS digest, min(license_id) AS license_id FROM known GROUP BY 1
), docs AS (
    SELECT doc_id, text, {_canonical("text")} AS canon FROM documents WHERE text IS NOT NULL
), units AS (
    SELECT doc_id, text, 0 AS kind, {_LINE.format("canon")} AS unit FROM docs
    UNION SELECT doc_id, text, 1, {_LINE.format("p")}
        FROM (SELECT doc_id, text, unnest(regexp_split_to_array(canon, '\\n\\n+')) AS p FROM docs)
    UNION SELECT doc_id, text, 2, trim(unnest(regexp_split_to_array(canon, '\\n+'))) FROM docs
), found AS (
    SELECT doc_id, text, license_id, digest, min(kind) AS kind
    FROM units JOIN digests ON sha256(unit) = digest WHERE unit <> '' GROUP BY ALL
)
SELECT doc_id, license_id, CASE min(kind) WHEN 0 THEN 'text' WHEN 1 THEN 'paragraph' ELSE 'line' END AS unit,
    count(*) AS n_units
FROM found GROUP BY doc_id, text, license_id
"""

HARD_NEGATIVES = r"""
WITH scaled AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) for x in embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM scaled a, scaled b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
    (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT alike
WHERE 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
