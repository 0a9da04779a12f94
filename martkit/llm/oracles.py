"""SQL for DuckDB of the queries that SQL can express.

There is none for op13 (byte-pair encoding), op3 (its patterns look behind, which DuckDB's regular expressions can't), op5 (no XXH64), op8 and op10
(trained models) and op9 (which documents are taken is free); tests hold these against brute force.
"""
from __future__ import annotations

from .licences import BLOCK, LEAST, STEP, TEMPLATES

_WORDS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

OP1 = rf"""
WITH items AS (
    SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), {_WORDS}) AS w FROM benchmark),
sized AS (SELECT item_id, w, least(5, len(w)) AS m FROM items WHERE len(w) > 0),
wanted AS (
    SELECT DISTINCT item_id, m, unnest(list_transform(range(1, len(w) - m + 2), lambda k: array_to_string(w[k:k + m - 1], ' '))) AS s FROM sized),
docs AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), {_WORDS}) AS w FROM documents),
pieces AS (
    SELECT DISTINCT doc_id, m, unnest(list_transform(range(1, len(w) - m + 2), lambda k: array_to_string(w[k:k + m - 1], ' '))) AS s
    FROM docs, (SELECT DISTINCT m FROM sized) WHERE len(w) >= m),
sizes AS (SELECT item_id, count(*) AS n FROM wanted GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS k FROM pieces JOIN wanted USING (m, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n AS item_shingles, k AS shared_shingles, k::DOUBLE / n AS containment
FROM shared JOIN sizes USING (item_id) WHERE k >= 0.8 * n - 1e-9
"""

OP2 = """
WITH t AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS body, length(coalesce(text, '')) AS n FROM conversations),
calls AS (
    SELECT conv_id, 'call_' || turn AS call_id, turn, CASE WHEN n % 2 = 0 THEN 'look_up' ELSE 'rewrite' END AS name, n,
           contains(body, chr(10)) AS lines, body FROM t WHERE role = 'assistant'),
results AS (SELECT conv_id, 'call_' || (turn - 1) AS call_id, turn, body FROM t WHERE role = 'user'),
used AS (
    SELECT c.*, turn >= 3 AS refers, turn >= 3 AND EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2) AS known FROM calls c),
runs AS (SELECT *, turn % 2 AS odd, sum(CASE WHEN known THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run FROM used),
leveled AS (SELECT *, row_number() OVER (PARTITION BY conv_id, odd, run ORDER BY turn) - 1 AS level FROM runs),
texts AS (
    SELECT *, '{' || array_to_string(list_filter([
        CASE WHEN refers THEN '"after":"${call_' || (turn - 2) || '}"' END,
        '"limit":' || CASE WHEN n % 7 = 0 THEN '"' || n || '"' ELSE n::VARCHAR END,
        CASE WHEN lines THEN '"lines":true' END,
        CASE WHEN name = 'look_up' THEN '"query":' || to_json(body) END,
        CASE WHEN name = 'rewrite' THEN '"text":' || to_json(body) END], lambda x: x IS NOT NULL), ',') || '}' AS arguments,
        array_to_string(list_filter([
            CASE WHEN n % 7 = 0 THEN 'limit is no integer' END, CASE WHEN lines THEN 'unexpected lines' END,
            CASE WHEN refers AND NOT known THEN 'unknown reference call_' || (turn - 2) END], lambda x: x IS NOT NULL), '; ') AS errors FROM leveled)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, c.name, c.level::BIGINT AS level,
       coalesce(c.turn, r.turn) AS position, CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'open' ELSE 'linked' END AS status,
       1::BIGINT AS copies, c.errors,
       '{' || array_to_string(list_filter([
           '"arguments":' || c.arguments, '"call_id":' || to_json(coalesce(c.call_id, r.call_id)), '"name":' || to_json(c.name),
           '"result":' || to_json(r.body)], lambda x: x IS NOT NULL), ',') || '}' AS canonical
FROM texts c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
"""

OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex FROM p),
d AS (
    SELECT page_id, payload_bytes, hex, array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform(range(0, 4), lambda i:
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((('0x' || substr(hex, 1 + 5 * g::INT, 5))::BIGINT >> (15 - 5 * i)) & 31)::INT]), '')), '') AS payload_digest FROM h),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, true AS intact
FROM f
"""

_BY_LABEL = ", ".join(f"('{k}', {sorted(set(t.split()))!r})" for k, t in TEMPLATES.items())
OP6 = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS row FROM documents),
places AS (
    SELECT row, list_filter(range(1, len(w) + 1), lambda i: w[i] = 'mit' AND w[i + 1] = 'license') AS mit,
           list_filter(range(1, len(w) + 1), lambda i: w[i] = 'apache' AND w[i + 1] = 'license') AS apache,
           list_filter(range(1, len(w) + 1), lambda i: w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license') AS gpl FROM d),
base AS (
    SELECT *, list_concat(list_concat(mit, apache), gpl) AS every,
           list_filter([CASE WHEN len(apache) > 0 THEN 'apache' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END, CASE WHEN len(mit) > 0 THEN 'mit' END],
                       lambda x: x IS NOT NULL) AS labels FROM places),
blocks AS (
    SELECT row, list_distinct(w[k * {STEP} + 1:k * {STEP} + {BLOCK}]) AS b
    FROM (SELECT row, w, unnest(range(0, greatest(0, ceil((len(w) - {BLOCK}) / {STEP}::DOUBLE))::INT + 1)) AS k FROM d)),
templates(label, tokens) AS (VALUES {_BY_LABEL}),
met AS (
    SELECT row, label, max(len(list_intersect(b, tokens))::DOUBLE / len(tokens)) AS share FROM blocks, templates
    WHERE len(list_intersect(b, tokens)) >= {LEAST} * len(tokens) - 1e-9 GROUP BY row, label),
found AS (SELECT row, list(label) AS met, max(share) AS best FROM met GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, len(every)::BIGINT AS n_base, list_min(every) - 1 AS first_word, list_max(every) - 1 AS last_word,
       array_to_string(labels, ',') AS base_labels, array_to_string(list_sort(list_concat(labels, coalesce(met, []))), ',') AS labels,
       CASE WHEN len(every) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0) END AS score
FROM d JOIN base USING (row) LEFT JOIN found USING (row)
"""

OP7 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT doc_id, max(doc_id) OVER p AS keep_id, count(*) OVER p AS group_size, row_number() OVER (PARTITION BY body ORDER BY doc_id DESC) AS place,
             sha256(body) AS text_sha256 FROM d WINDOW p AS (PARTITION BY body))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
"""

def _crc32(number: str) -> str:
    """CRC-32 of a number's decimal digits, bit by bit."""
    byte = "list_reduce(range(8), lambda t, i: CASE WHEN t & 1 = 1 THEN xor(t >> 1, 3988292384) ELSE t >> 1 END, xor(crc, b))"
    digits = f"list_transform(string_split(({number})::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce({digits}, lambda crc, b: {byte}, 4294967295::BIGINT), 4294967295)"


def _levels(name: str, tree: str, levels: int) -> str:
    """Hash the nodes in ``{name}0`` (tree, place, digest) level by level; ``{name}_seg{k}`` holds what lies around each node."""
    ctes = []
    for k in range(levels):
        ctes.append(f"""{name}_run{k} AS (
    SELECT {tree}, place // 16 AS up, list(digest ORDER BY place) AS run, sum(count(*)) OVER (PARTITION BY {tree}) AS size FROM {name}{k} GROUP BY {tree}, place // 16),
{name}_seg{k} AS (
    SELECT n.{tree}, n.place, r.size > 1 AS hashed, array_to_string(r.run[1:(n.place % 16)::INT], '') AS l, array_to_string(r.run[(n.place % 16 + 2)::INT:], '') AS r
    FROM {name}{k} n JOIN {name}_run{k} r ON n.{tree} IS NOT DISTINCT FROM r.{tree} AND n.place // 16 = r.up),
{name}{k + 1} AS (SELECT {tree}, up AS place, CASE WHEN size > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS digest FROM {name}_run{k})""")
    return ",\n".join(ctes)


def _paths(levels: int, name: str, tree: str, start: str, node: str) -> str:
    """The joins from a row to what lies around its ancestors."""
    return " ".join(f"JOIN {name}_seg{k} {name}s{k} ON {name}s{k}.{tree} IS NOT DISTINCT FROM {start} AND {name}s{k}.place = {node} // {16 ** k}" for k in range(levels))


#: Levels of the trees that the statement hashes: enough for 16 ** 4 rows a source and 16 ** 2 sources.
_INNER, _OUTER = 4, 2
_SEGMENTS = [f"ns{k}" for k in range(_INNER)] + [f"ts{k}" for k in range(_OUTER)]
_MARKED = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_MARKED.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP11 = f"""
WITH leaves AS (
    SELECT doc_id, source, {_leaf("text")} AS leaf, CASE WHEN {_crc32("doc_id")} % 5 = 0 THEN {_leaf(_LOWERED)} END AS altered FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
n0 AS (SELECT source, place, leaf AS digest FROM placed),
{_levels("n", "source", _INNER)},
t0 AS (SELECT 0 AS top, source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, digest FROM n{_INNER}),
{_levels("t", "top", _OUTER)},
proofs AS (
    SELECT doc_id, leaf, t0.digest AS subroot, t{_OUTER}.digest AS root, {" || ".join(f"CASE WHEN {x}.hashed THEN {x}.l || {x}.r ELSE '' END" for x in _SEGMENTS)} AS proof,
           coalesce(altered, leaf) AS node, {", ".join(f"{x}.l AS l_{x}, {x}.r AS r_{x}, {x}.hashed AS h_{x}" for x in _SEGMENTS)}
    FROM placed p JOIN t0 ON p.source IS NOT DISTINCT FROM t0.source CROSS JOIN t{_OUTER}
    {_paths(_INNER, "n", "source", "p.source", "p.place")} {_paths(_OUTER, "t", "top", "0", "t0.place")}),
"""
for _i, _x in enumerate(_SEGMENTS):
    OP11 += (f"f{_i} AS (SELECT * REPLACE (CASE WHEN h_{_x} THEN sha256(l_{_x} || node || r_{_x}) ELSE node END AS node) "
             f"FROM {'proofs' if _i == 0 else f'f{_i - 1}'}){',' if _i + 1 < len(_SEGMENTS) else ''}\n")
OP11 += f"""SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified FROM f{len(_SEGMENTS) - 1}"""

OP12 = f"""
WITH t AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS place
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % 100 AS base, count(*) AS size, {_crc32("c")} % 6 AS h FROM t GROUP BY c),
lead AS (SELECT a.c, a.base, a.h, least(a.h, coalesce(b.size, 0)) AS taken FROM convs a LEFT JOIN convs b ON b.c = a.base),
turns AS (
    SELECT l.c, t.place AS d, role, text FROM lead l JOIN t ON t.c = l.base AND t.place <= l.h
    UNION ALL SELECT l.c, t.place - l.h + l.taken, role, text FROM lead l JOIN t ON t.c = l.c AND t.place > l.h),
prefixes AS (
    SELECT c, d, length(text) AS n, sha256(string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d)) AS k FROM turns
    UNION ALL SELECT c, 0, 0, '' FROM convs),
nodes AS (SELECT d, k, any_value(n) AS n, min(c) AS conv_id, count(*) AS n_convs FROM prefixes GROUP BY d, k),
links AS (SELECT DISTINCT a.d, a.k, b.k AS parent FROM prefixes a JOIN prefixes b ON a.c = b.c AND b.d = a.d - 1),
kids AS (SELECT d - 1 AS d, parent AS k, count(*) AS n FROM links GROUP BY d, parent),
sizes AS (SELECT c, max(d) AS d FROM prefixes GROUP BY c),
ends AS (SELECT d, k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM prefixes JOIN sizes USING (c, d) GROUP BY d, k),
below AS (
    SELECT u.d, u.k, count(*) FILTER (kids.n IS NULL) AS n_leaves, sum((w.n_convs - 1) * w.n) AS saved
    FROM nodes w LEFT JOIN kids USING (d, k) JOIN prefixes u ON u.c = w.conv_id AND u.d <= w.d GROUP BY u.d, u.k)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n_convs, coalesce(kids.n, 0) AS n_children, b.n_leaves, b.saved::BIGINT AS saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes w JOIN below b USING (d, k) LEFT JOIN kids USING (d, k) LEFT JOIN ends e USING (d, k) LEFT JOIN links l USING (d, k)
LEFT JOIN nodes p ON p.d = w.d - 1 AND p.k = l.parent
"""

ORACLES = {"op1_decontamination": OP1, "op2_tool_calls": OP2, "op4_arc_to_warc": OP4, "op6_licences": OP6, "op7_exact_dedup": OP7,
           "op11_merkle_manifest": OP11, "op12_prefix_trie": OP12}
