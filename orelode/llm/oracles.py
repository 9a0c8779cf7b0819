"""SQL over the given tables for the queries that SQL can express."""

from __future__ import annotations

from orelode.llm.credentials import COMPLEMENT, KINDS, ROLE, SCOPE, WEAK
from orelode.llm.debruijn import WINDOW

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORDS = r"'[^\x20\x09-\x0D]+'"

NGRAM_JOIN = f"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), {WORDS}) AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' ')))
        END AS shingles
    FROM split),
members AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS s FROM sets),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, a.n + b.n AS total, COUNT(*) AS common
    FROM members a JOIN members b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs WHERE 100 * common >= 90 * (total - common)),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT doc_id, y FROM reach JOIN links ON x = other)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, MIN(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

SUBSTRING_DEDUP = f"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i+{WINDOW - 1}], ' ') AS words
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM split)),
firsts AS (SELECT words, MIN(doc_id) AS first FROM windows GROUP BY words),
gone AS (
    SELECT DISTINCT doc_id, i + unnest(range(0, {WINDOW})) AS place
    FROM windows JOIN firsts USING (words) WHERE first < doc_id),
places AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM split),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS words, COUNT(*) AS n
    FROM places ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""


EMBEDDING_NEAR_DEDUP = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
    SELECT vec_id, vec_id AS other FROM embeddings
    UNION
    SELECT vec_id, y FROM reach JOIN links ON x = other),
components AS (SELECT vec_id, MIN(other) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, (SELECT COUNT(*) FROM links WHERE x = vec_id) AS n_links, component_id,
       vec_id = component_id AS kept
FROM components
"""

CHAT_FORMAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized AS (
    SELECT *, length(regexp_replace(role || text, '<(\\*)\|', '<\\\1|', 'g'))
              + length('<|im_start|><|im_sep|><|im_end|>') + 1 AS chars FROM turns)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(SUM(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), ''))
           AS loss_sha256,
       CAST(SUM(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

#: CRC-32 of the decimal digits, bit by bit.
CRC32 = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
        lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

PREFIX_TRIE = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
lists AS (
    SELECT conv_id, list(sha256(strlen(role) || ':' || role || text) ORDER BY i) AS codes,
           list(strlen(text) ORDER BY i) AS sizes, {CRC32} % 9 AS h
    FROM turns GROUP BY conv_id),
rebuilt AS (
    SELECT c.conv_id AS c, list_concat(coalesce(b.codes[1:c.h], []), c.codes[c.h+1:]) AS codes,
           list_concat(coalesce(b.sizes[1:c.h], []), c.sizes[c.h+1:]) AS sizes
    FROM lists c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 5),
members AS (
    SELECT c, d, codes[1:d] AS path, codes[1:d-1] AS above, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size,
           d = len(codes) AS is_end
    FROM (SELECT *, unnest(range(0, len(codes) + 1)) AS d FROM rebuilt)),
placed AS (SELECT *, MIN(c) OVER (PARTITION BY d, path) AS conv FROM members),
grouped AS (
    SELECT conv, d, MIN(above) AS above, COUNT(*) AS n, MIN(size) AS size, any_value(path) AS path,
           string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (is_end) AS ends
    FROM placed GROUP BY conv, d),
nodes AS (
    SELECT g.*, p.conv AS parent, (SELECT COUNT(*) FROM grouped k WHERE k.d = g.d + 1 AND k.above = g.path) AS children
    FROM grouped g LEFT JOIN grouped p ON p.d = g.d - 1 AND p.path = g.above),
sums AS (
    SELECT a.conv, a.d, SUM((v.n - 1) * v.size) AS saved, COUNT(*) FILTER (v.children = 0) AS leaves
    FROM nodes v JOIN placed a ON a.c = v.conv AND a.d <= v.d GROUP BY a.conv, a.d)
SELECT conv AS conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, children AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM nodes JOIN sums USING (conv, d)
"""


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def matches(kind: int, pattern: str) -> str:
    """Matches of one kind with their places: the pieces between them add up."""
    return f"""
    SELECT doc_id, {kind} AS kind, value, start, start + length(value) AS stop FROM (
        SELECT doc_id, found[i] AS value,
               coalesce(list_sum(list_transform(pieces[1:i], lambda p: length(p))), 0)
               + coalesce(list_sum(list_transform(found[1:i-1], lambda p: length(p))), 0) AS start
        FROM (SELECT doc_id, found, string_split_regex(text, {quoted(pattern)}) AS pieces,
                     unnest(range(1, len(found) + 1)) AS i
              FROM (SELECT doc_id, text, regexp_extract_all(text, {quoted(pattern)}, 0) AS found
                    FROM documents WHERE regexp_matches(text, {quoted(pattern)}))))"""


#: The base patterns as the rules state them, apart from those of the operator. A run of hex signs
#: is as long as it can be, so its least length stands in the pattern.
BASE = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
}


def credential_linking() -> str:
    base = " UNION ALL ".join(matches(i, p) for i, p in enumerate(BASE.values()))
    weak = " UNION ALL ".join(matches(len(BASE) + i, p) for i, p in enumerate(WEAK.values()))
    names = "[" + ", ".join(map(quoted, KINDS)) + "]"
    near = " OR ".join(
        f"(w.kind = {KINDS.index(kind)} AND p.kind IN "
        f"({', '.join(str(i) for i, k in enumerate(KINDS) if ROLE[k] in roles)}))"
        for kind, roles in COMPLEMENT.items()
    )
    listed = "string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop)"
    return f"""
WITH found AS ({base}),
base AS (
    SELECT * FROM found
    WHERE CASE kind WHEN 0 THEN length(regexp_extract(value, {quoted(BASE["assign"])}, 2)) >= 6
                    WHEN 1 THEN length(value) >= 20 ELSE true END),
weak AS (
    SELECT * FROM ({weak}) w WHERE NOT EXISTS (
        FROM base b WHERE b.doc_id = w.doc_id AND b.start < w.stop AND w.start < b.stop)),
parts AS (FROM base UNION ALL FROM weak),
linked AS (
    SELECT * FROM weak w WHERE EXISTS (
        FROM parts p WHERE p.doc_id = w.doc_id AND p.start < w.stop + {SCOPE}
          AND p.stop > w.start - {SCOPE} AND ({near}))),
spans AS (
    SELECT *, {names}[kind + 1] AS name, true AS is_base FROM base
    UNION ALL SELECT *, {names}[kind + 1], false FROM linked),
lists AS (
    SELECT doc_id, {listed} AS spans, {listed} FILTER (is_base) AS base_spans,
           COUNT(*) FILTER (kind = 0) AS n_assign, COUNT(*) FILTER (kind = 1) AS n_access,
           COUNT(*) FILTER (kind = 2) AS n_hex
    FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base_spans, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM documents LEFT JOIN lists USING (doc_id)
"""


ORACLES = {
    "op1_ngram_join": NGRAM_JOIN,
    "op3_substring_dedup": SUBSTRING_DEDUP,
    "op4_embedding_near_dedup": EMBEDDING_NEAR_DEDUP,
    "op6_credential_linking": credential_linking(),
    "op11_chat_format": CHAT_FORMAT,
    "op12_prefix_trie": PREFIX_TRIE,
}
