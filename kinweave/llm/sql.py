"""Expected results of the registered queries in SQL, where SQL can express them."""

SPACE = r"[\x20\x09-\x0D]+"
RULES = ("too_short", "repetitive", "duplicate_lines", "symbols", "word_length")

QUALITY = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), windows AS (
    SELECT row_id, i, words[i:i + 4] AS five
    FROM (SELECT row_id, words, unnest(range(1, len(words) - 3)) AS i FROM split WHERE len(words) >= 5)
), twice AS (
    SELECT row_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY row_id, five) > 1
), repeated AS (
    SELECT row_id, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) GROUP BY row_id
), measured AS (
    SELECT split.row_id, doc_id, source, len(words) AS n_words, len(lines) AS n_lines,
        length(regexp_replace(text, '{SPACE}', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
    FROM split LEFT JOIN repeated ON split.row_id = repeated.row_id
), judged AS (
    SELECT *, n_words < 10 AS too_short, 100 * n_repeat_words > 20 * n_words AS repetitive,
        100 * n_dup_lines > 30 * n_lines AS duplicate_lines, 10 * n_symbols > n_words AS symbols,
        word_chars < 2 * n_words OR word_chars > 20 * n_words AS word_length
    FROM measured
), hosts AS (
    SELECT source, count(*) AS n, {", ".join(f"sum({r}::INT) AS {r}" for r in RULES)}
    FROM judged WHERE source IS NOT NULL GROUP BY source
), moments AS (
    SELECT {", ".join(f"sum({r}) / sum(n) AS m_{r}, avg(({r} / n) * ({r} / n)) - avg({r} / n) * avg({r} / n) AS v_{r}" for r in RULES)}
    FROM hosts
), priors AS (
    SELECT {", ".join(f'''m_{r}, CASE WHEN m_{r} <= 0 OR m_{r} >= 1 THEN 1e6 ELSE
        least(greatest(m_{r} * (1 - m_{r}) / greatest(v_{r}, 1e-12) - 1, 1.0), 1e6) END AS s_{r}''' for r in RULES)}
    FROM moments
), failing AS (
    SELECT source FROM hosts, priors WHERE {" OR ".join(f"({r} + m_{r} * s_{r}) / (n + s_{r}) > 0.5" for r in RULES)}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, too_short OR repetitive AS base_failed,
    NOT (too_short OR repetitive) AND coalesce(source NOT IN (SELECT source FROM failing), TRUE) AS kept
FROM judged
"""


TOP_K = """
WITH usable AS (
    SELECT row_number() OVER () AS row_id, vec_id, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), parts AS (
    SELECT row_id, vec_id, len(embedding) AS width, generate_subscripts(embedding, 1) AS i,
        CAST(floor(1024 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x
    FROM usable
), scores AS (
    SELECT q.vec_id AS query_id, c.row_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM parts q JOIN parts c ON c.i = q.i AND c.width = q.width AND c.vec_id <> q.vec_id
    WHERE q.vec_id % 100 = 0 GROUP BY q.vec_id, q.row_id, c.row_id, c.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 4
        THEN list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
    FROM split
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT shared.a, shared.b FROM shared JOIN sizes x ON x.doc_id = shared.a JOIN sizes y ON y.doc_id = shared.b
    WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other
), components AS (
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN components c ON c.doc_id = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""


SPELLING_VARIANTS = r"""
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) ORDER BY n) AS t
    FROM range(256) AS r(n)
), runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
    FROM documents
), counted AS (
    SELECT doc, run, count(*) AS n, hex(encode(doc || ':' || run)) AS bytes FROM runs WHERE length(run) >= 7 GROUP BY doc, run
), digests AS (
    SELECT run, n, xor(list_reduce(list_transform(range(1, length(bytes), 2),
            lambda i: CAST(instr('0123456789ABCDEF', bytes[i]) * 16 + instr('0123456789ABCDEF', bytes[i + 1]) - 17 AS BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
    FROM counted, crc_table
), results AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
    FROM digests
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM results WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), less AS (
    SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        AND length(a.word) = length(b.word)
    UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON b.word = a.rest
    UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON b.word = a.rest
), ranked AS (
    SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
        row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS place
    FROM near
), formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form,
        CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1
), chains AS (
    SELECT word, word AS root FROM words
    UNION ALL SELECT c.word, f.form FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
), lasts AS (
    SELECT c.word, c.root FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NULL
)
SELECT f.word, f.form, l.root, f.n, f.n_near, f.form_n FROM formed f JOIN lasts l ON l.word = f.word
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_top_k": TOP_K, "op5_near_duplicates": NEAR_DUPLICATES, "op6_host_quality": QUALITY,
            "op12_spelling_variants": SPELLING_VARIANTS}
