"""The queries that SQL can express, for DuckDB, written without the operators' code."""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def _escaped(text: str) -> str:
    sql = f"replace(coalesce({text}, ''), '&', '&amp;')"
    for c, to in (
        ("<|", "&lt;|"), ("<s>", "&lt;s>"), ("</s>", "&lt;/s>"), ("[INST]", "&lsqb;INST]"),
        ("[/INST]", "&lsqb;/INST]"), ("<<SYS>>", "&lt;<SYS>>"), ("<</SYS>>", "&lt;</SYS>>"),
    ):
        sql = f"replace({sql}, '{c}', '{to}')"
    return sql


ORACLES["op10_chat"] = f"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
  SELECT *, CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 2 ELSE 1 END AS place,
    '<|turn|>' || {_escaped("role")} || '<|body|>' || {_escaped("text")} || '<|end|>' AS said
  FROM told
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, place, role, said) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, place, role, said) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length(said)) AS formatted
  FROM placed GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted AS BIGINT) AS formatted_chars
FROM whole
"""


CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _small(text: str) -> str:
    return f"translate({text}, '{CAPITALS}', '{CAPITALS.lower()}')"


_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES["op12_lexical"] = f"""
WITH read AS (
  SELECT row_number() OVER () AS d, doc_id, {_TERMS.format(_small("text"))} AS terms FROM documents WHERE text IS NOT NULL
), sized AS (SELECT d, doc_id, len(terms) AS n FROM read WHERE len(terms) > 0
), whole AS (SELECT count(*) AS docs, sum(n) AS words FROM sized
), wanted AS (
  SELECT row_number() OVER () AS i, item_id, {_TERMS.format(_small("text"))} AS terms FROM benchmark WHERE text IS NOT NULL
), asked AS (
  SELECT i, item_id, term, count(*) AS times
  FROM (SELECT i, item_id, unnest(terms) AS term FROM wanted) GROUP BY ALL
), tf AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM read)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, whole GROUP BY term
), part AS (
  SELECT tf.d, doc_id, tf.term,
    w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + CAST((25 * n * docs) // words AS BIGINT)))) AS part
  FROM tf JOIN sized USING (d) JOIN weight USING (term), whole
), scored AS (
  SELECT i, item_id, d, doc_id, CAST(sum(part * times) AS BIGINT) AS score
  FROM part JOIN asked USING (term) GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

#: More levels than any table here needs: 8 ** 10 documents of a language, 8 ** 5 languages.
LEVELS, LEVELS_ABOVE = 10, 5


def _climb(name: str, levels: int) -> str:
    """Tables name0 (tree, pos, h) to the roots name<levels>; name<k>r has the runs of siblings."""
    out = []
    for k in range(levels):
        out.append(
            f"{name}{k}r AS (SELECT tree, pos // 8 AS run, list(h ORDER BY pos) AS hs, any_value(total) AS total "
            f"FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS total FROM {name}{k}) GROUP BY tree, pos // 8)"
        )
        out.append(
            f"{name}{k + 1} AS (SELECT tree, run AS pos, "
            f"CASE WHEN total = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {name}{k}r)"
        )
    return ",\n".join(out)


def _fold(rows: str, name: str, levels: int, tree: str, pos: str, into: str) -> str:
    """From rows (..., sib, h): siblings appended to sib, and h replaced by the root it leads to."""
    out, of = [], rows
    for k in range(levels):
        place = f"{pos} // {8**k} % 8"
        out.append(
            f"{into}{k} AS (SELECT x.* EXCLUDE (sib, h), "
            f"CASE WHEN total = 1 THEN sib ELSE sib || array_to_string(hs[1:{place}] || hs[{place} + 2:], '') END AS sib, "
            f"CASE WHEN total = 1 THEN h ELSE sha256(array_to_string(hs[1:{place}] || [h] || hs[{place} + 2:], '')) END AS h "
            f"FROM {of} x JOIN {name}{k}r r ON r.tree = x.{tree} AND r.run = x.{pos} // {8 ** (k + 1)})"
        )
        of = f"{into}{k}"
    return ",\n".join(out)


def _leaf(text: str) -> str:
    parts = []
    for c in ("doc_id", "source", "lang", "n_chars", text):
        said = f"CAST({c} AS VARCHAR)"
        parts.append(f"coalesce(strlen({said}) || ':' || {said}, '-')")
    return f"sha256({' || '.join(parts)})"


#: crc32, bit by bit: each byte is mixed in, then eight shifts follow.
_CRC = """xor(4294967295, list_reduce([4294967295::BIGINT] || flatten(list_transform(
  string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""

ORACLES["op13_merkle"] = f"""
WITH placed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS of, {_leaf("text")} AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN {_leaf(_small("text"))} END AS changed FROM documents
), docs AS (
  SELECT *, row_number() OVER (PARTITION BY of ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM placed
), n0 AS (SELECT of AS tree, pos, leaf AS h FROM docs),
{_climb("n", LEVELS)},
a0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, h, tree AS of FROM n{LEVELS}),
{_climb("a", LEVELS_ABOVE)},
begun AS (
  SELECT docs.doc_id, docs.leaf, docs.of, docs.pos, a0.pos AS above, '' AS top, a0.h AS subroot, '' AS sib, coalesce(changed, leaf) AS h
  FROM docs JOIN a0 ON a0.of = docs.of
),
{_fold("begun", "n", LEVELS, "of", "pos", "f")},
{_fold(f"f{LEVELS - 1}", "a", LEVELS_ABOVE, "top", "above", "g")}
SELECT doc_id, leaf, subroot, a{LEVELS_ABOVE}.h AS root, sha256(sib) AS proof_sha256, g.h AS folded_root,
  g.h = a{LEVELS_ABOVE}.h AS verified
FROM g{LEVELS_ABOVE - 1} g, a{LEVELS_ABOVE}
"""
