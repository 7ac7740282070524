"""SQL for DuckDB that gives the rows of the registered queries by plainer means."""

from __future__ import annotations

from yieldlens.llm.quality import COMMON_WORDS, Rules

OP1 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
    SELECT *, length('<|im_start|><|im_sep|><|im_end|>') + 1 + length(
        regexp_replace(replace(role || chr(1) || text, '\', '\\'), '<(\||/?s>)|\[/?INST\]', '.\0', 'g')) - 1 AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_WORDS = ", ".join(f"('{lang}', {k}, '{w}', '{w.title()}')" for lang, ws in COMMON_WORDS.items() for k, w in enumerate(ws))
_R = Rules()


def _jensen_shannon(left: str, right: str) -> str:
    term = "CASE WHEN {0} > 0 THEN {0} * log2({0} / ((z[1] + z[2]) / 2)) ELSE 0 END"
    return f"sqrt(greatest(0, list_sum([{term.format('z[1]')} + {term.format('z[2]')} FOR z IN list_zip({left}, {right})]) / 2))"


def quality(table: str) -> str:
    """Common table expressions that end in ``verdicts``: the rows of the quality rules over a table, with all its columns."""
    return rf"""
numbered AS (SELECT *, row_number() OVER () AS r, coalesce(text, '') AS body FROM {table}),
split AS (
    SELECT *, list_filter(string_split_regex(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM numbered
),
single AS (SELECT r, lang, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split),
grams AS (
    SELECT r, i, w || ' ' || lead(w) OVER place || ' ' || lead(w, 2) OVER place AS g
    FROM single WINDOW place AS (PARTITION BY r ORDER BY i)
),
counted AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams WHERE g IS NOT NULL),
repeated AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE n > 1) GROUP BY r
),
listed(lang, k, small, large) AS (VALUES {_WORDS}),
hits AS (SELECT r, k, count(*) AS n FROM single JOIN listed USING (lang) WHERE w IN (small, large) GROUP BY r, k),
common AS (
    SELECT r, list(coalesce(n, 0) ORDER BY k) AS common
    FROM split JOIN listed USING (lang) LEFT JOIN hits USING (r, k) GROUP BY r
),
chars AS (
    SELECT r, length(j) AS word_chars,
        [length(j) - length(regexp_replace(j, p, '', 'g')) FOR p IN
            ['[a-z]', '[A-Z]', '[0-9]', '[#*$%&|<>]', '[!-/:-@\[-`{{-~]', '[^!-~]']] AS found
    FROM (SELECT r, array_to_string(words, '') AS j FROM split)
),
counts AS (
    SELECT split.*, len(words) AS n_words, word_chars, found[4] AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
        [found[1], found[2], found[3], found[4], found[5] - found[4], found[6]] AS classes, common,
        len(words) < {_R.least_words} OR 100 * coalesce(repeated.n, 0) > {_R.most_repeated} * len(words) AS base_failed
    FROM split JOIN chars USING (r) LEFT JOIN repeated USING (r) LEFT JOIN common USING (r)
),
bins AS (
    SELECT *, [c / word_chars FOR c IN classes] AS class_shares,
        [c / n_words FOR c IN list_append(common, n_words - list_sum(common))] AS common_shares
    FROM counts
),
pooled AS (
    SELECT lang, count(*) AS documents, sum(word_chars) AS chars, sum(n_words) AS words,
        [{", ".join(f"sum(classes[{i}])" for i in range(1, 7))}] AS classes,
        [{", ".join(f"sum(common[{i}])" for i in range(1, 13))}] AS common
    FROM bins WHERE NOT base_failed AND lang IS NOT NULL GROUP BY lang
),
refs AS (
    SELECT lang, documents >= {_R.least_documents} AS enough, [c / chars FOR c IN classes] AS ref_classes,
        CASE WHEN common[1] IS NOT NULL THEN [c / words FOR c IN list_append(common, words - list_sum(common))] END AS ref_common
    FROM pooled
),
every AS (
    SELECT [sum(classes[1] + classes[2] + classes[6]) / sum(chars), sum(classes[3]) / sum(chars),
        sum(classes[4]) / sum(chars), sum(classes[5]) / sum(chars)] AS ref_every
    FROM pooled
),
scripts AS (
    SELECT *, [class_shares[1] + class_shares[2] + class_shares[6], class_shares[3], class_shares[4], class_shares[5]] AS script_shares
    FROM bins
),
verdicts AS (
    SELECT scripts.*, NOT base_failed
        AND coalesce(word_chars < {_R.least_chars_for_classes} OR CASE
                WHEN enough THEN {_jensen_shannon("class_shares", "ref_classes")}
                WHEN NOT enough THEN {_jensen_shannon("script_shares", "ref_every")} END
            <= {_R.class_limit[0]} + {_R.class_limit[1]} / sqrt(n_words), true)
        AND coalesce(NOT enough OR n_words < {_R.least_words_for_common} OR {_jensen_shannon("common_shares", "ref_common")}
            <= {_R.common_limit[0]} + {_R.common_limit[1]} / sqrt(n_words), true) AS kept
    FROM scripts LEFT JOIN refs USING (lang) CROSS JOIN every
)"""


OP2 = f"""
WITH {quality("documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM verdicts
"""


def components(table: str, width: int, per_cent: int) -> str:
    """Common table expressions that end in ``alike``: doc_id, n_shingles and component_id for a table's documents."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return rf"""
worded AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{letters.upper()}', '{letters}'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM {table}
),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + {width - 1}], ' ') FOR i IN range(1, len(w) - {width - 2})] END) AS g
    FROM worded
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
    WHERE 100 * c >= {per_cent} * (s.n + t.n - c)
),
either AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(a, b) AS (
    SELECT doc_id, doc_id FROM {table} UNION SELECT a, y FROM reached JOIN either ON x = b
),
alike AS (
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM {table} LEFT JOIN sizes USING (doc_id)
    JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) USING (doc_id)
)"""


OP8 = f"""
WITH RECURSIVE {components("documents", 3, 90)}
SELECT doc_id, n_shingles, component_id FROM alike
"""

OP12 = f"""
WITH RECURSIVE {components("documents", 2, 80)}
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM alike
"""

OP13 = """
WITH usable AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.id <> b.id WHERE a.id % 50 = 0
),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER best <= 3
"""

ORACLE_SQL = {"op12_minhash_duplicates": OP12, "op13_hard_negatives": OP13, "op1_chat_formatting": OP1, "op2_quality_rules": OP2, "op8_jaccard_join": OP8}
