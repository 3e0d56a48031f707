"""DuckDB SQL for the queries that SQL can express on whole tables: op4, op7, op9, op11 and op12."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP4 = """
WITH good AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
    FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

_OP7 = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words
), shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS held FROM shingles a JOIN shingles b USING (shingle)
    WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
    WHERE 100 * held >= 75 * (len(x.s) + len(y.s) - held)
), reach AS (
    SELECT doc_id AS id, doc_id AS other FROM sets
    UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
), named AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN named ON id = doc_id
"""

_OP9 = """
WITH RECURSIVE good AS (
    SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE len(embedding) > 0 AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([1 FOR x IN embedding IF x <> 0]) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
    SELECT vec_id AS id, vec_id AS other FROM embeddings
    UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
), named AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN named ON id = vec_id LEFT JOIN counted ON a = vec_id
"""



def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text; needs the CTEs of _CRC and the column ``crc``."""
    return (
        f"xor(list_reduce(list_concat([4294967295::BIGINT], [CAST(ascii(c) AS BIGINT) FOR c IN string_split({text}, '')]), "
        f"lambda a, b: xor(crc[(xor(a, b) & 255) + 1], a >> 8)), 4294967295::BIGINT)"
    )


_CRC = """
bits AS (
    SELECT n, n AS c, 0 AS k FROM range(256) r(n)
    UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crcs AS (SELECT list(c ORDER BY n) AS crc FROM bits WHERE k = 8)
"""


def _part(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    values = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return f"sha256({' || '.join(map(_part, values))})"


_UP = "[sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], '')) FOR i IN range(0, (len(nodes) + 2) // 3)]"
_SIDES = """array_to_string(nodes[p - p % 3 + 1 : p], '') AS l, array_to_string(nodes[p + 2 : p - p % 3 + 3], '') AS r"""

_OP11 = f"""
WITH RECURSIVE {_CRC}, hashed AS (
    SELECT doc_id, source, {_leaf('text')} AS leaf,
        CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS given
    FROM documents, crcs
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, row_number() OVER () AS id FROM hashed
), trees AS (
    SELECT source, 0 AS level, list(leaf ORDER BY place) AS nodes FROM leaves GROUP BY source
    UNION ALL SELECT source, level + 1, {_UP} FROM trees WHERE len(nodes) > 1
), subroots AS (
    SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM trees WHERE len(nodes) = 1
), tops AS (
    SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
    UNION ALL SELECT level + 1, {_UP} FROM tops WHERE len(nodes) > 1
), sides AS (
    SELECT id, level, {_SIDES} FROM (
        SELECT id, t.level, t.nodes, l.place // CAST(pow(3, t.level) AS BIGINT) AS p
        FROM leaves l JOIN trees t ON t.source IS NOT DISTINCT FROM l.source WHERE len(t.nodes) > 1)
    UNION ALL SELECT id, 1000 + level, {_SIDES} FROM (
        SELECT id, t.level, t.nodes, s.place // CAST(pow(3, t.level) AS BIGINT) AS p
        FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source, tops t WHERE len(t.nodes) > 1)
), paths AS (
    SELECT id, list(l ORDER BY level) AS ls, list(r ORDER BY level) AS rs, string_agg(l || r, '' ORDER BY level) AS siblings FROM sides GROUP BY id
), folds AS (
    SELECT id, 1 AS k, given AS digest FROM leaves
    UNION ALL SELECT f.id, k + 1, sha256(ls[k] || digest || rs[k]) FROM folds f JOIN paths p ON p.id = f.id WHERE k <= len(ls)
), ends AS (SELECT id, max_by(digest, k) AS folded_root FROM folds GROUP BY id),
root AS (SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots s ON s.source IS NOT DISTINCT FROM leaves.source JOIN ends ON ends.id = leaves.id
LEFT JOIN paths ON paths.id = leaves.id, root
"""


def _way(state: str, cost: str, letter: str, line: str = "''", when: str = "true") -> str:
    """The least way to a state with one more edit: cost and audit as one text ``k``, repaired lines ``t``."""
    longer = f"lpad(CAST(CAST({state}.k[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {state}.k[10:] || '{letter}'"
    return f"CASE WHEN {state}.k IS NOT NULL AND ({when}) THEN {{'k': {longer}, 't': {state}.t || {line}}} END"


def _least(*ways: str) -> str:
    return f"list_min(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))"


def _states() -> str:
    """The four states after one row, from those before it with the inserts that may precede it (i0 to i3)."""
    stays, line = "fault NOT IN ('blank', 'duplicate')", "chr(10) || role || ':' || text"
    extra = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    keep = lambda state, first: _way(state, extra, "K", line, f"{stays} AND role[1:1] = '{first}'")
    role = lambda state, name: _way(state, f"3 + {extra}", "R", f"chr(10) || '{name}:' || text", stays)
    gone = lambda state: _way(state, "4", "D")
    to_user = [w for state in ("i0", "i1", "i3") for w in (keep(state, "u"), role(state, "user"))]
    return ", ".join(f"{ways} AS s{k}" for k, ways in enumerate([
        gone("i0"), _least(gone("i1"), keep("i0", "s")), _least(gone("i2"), *to_user),
        _least(gone("i3"), keep("i2", "a"), role("i2", "assistant")),
    ]))


def _inserted(states: str) -> str:
    user = _least("s2", *(_way(s, "3", "I", "chr(10) || 'user:'") for s in ("s0", "s1", "s3")))
    return f"(SELECT *, s0 AS i0, s1 AS i1, {_least('s3', _way('i2', '3', 'I', "chr(10) || 'assistant:'"))} AS i3 FROM (SELECT *, {user} AS i2 FROM {states}))"


_WAY = "STRUCT(k VARCHAR, t VARCHAR)"
_OP12 = f"""
WITH RECURSIVE {_CRC}, kinds AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
    FROM conversations, crcs
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) FROM kinds WHERE kind <> 0)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS place,
        rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown
    FROM damaged
), rows_ AS (
    SELECT *, lead(role[1:1]) OVER (PARTITION BY conv_id ORDER BY place) AS next_role, CASE WHEN shown = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
        WHEN shown[-1:] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM placed
), counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (next_role IS NOT NULL AND role[1:1] || next_role NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rows_ GROUP BY conv_id
), steps AS (
    SELECT conv_id, 1 AS nth, {{'k': '000000000', 't': ''}}::{_WAY} AS s0, NULL::{_WAY} AS s1, NULL::{_WAY} AS s2, NULL::{_WAY} AS s3 FROM counts
    UNION ALL SELECT conv_id, nth + 1, {_states()} FROM (
        SELECT i.*, role, text, fault FROM {_inserted('steps')} i JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM i.conv_id AND r.place = i.nth)
), done AS (
    SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, {_least('i0', 'i3')} AS best
    FROM {_inserted('steps')} i JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id AND i.nth = c.n + 1
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
    CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
    CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(CAST(best.k[1:9] AS BIGINT), 0) AS BIGINT) AS cost,
    coalesce(best.k[10:], '') AS audit, sha256(coalesce(best.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_topk_search": _OP4, "op7_minhash_dedup": _OP7, "op9_embedding_dedup": _OP9,
        "op11_merkle_manifest": _OP11, "op12_conversation_repair": _OP12,
    }
