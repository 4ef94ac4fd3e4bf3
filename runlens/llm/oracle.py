"""DuckDB restatements of the operators that SQL can express, over the driver's tables."""

from __future__ import annotations

NEAR_COPIES = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
       AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.rid, a.vec_id AS one, b.vec_id AS other FROM ok a JOIN ok b ON a.label = b.label AND a.rid <> b.rid
          AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e)
              / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
reach(vec_id, low) AS (SELECT vec_id, vec_id FROM ok UNION
                       SELECT p.one, r.low FROM pairs p JOIN reach r ON r.vec_id = p.other),
lowest AS (SELECT vec_id, min(low) AS low FROM reach GROUP BY vec_id),
n AS (SELECT rid, count(*) AS n FROM pairs GROUP BY rid)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(l.low, v.vec_id) AS component_id,
       coalesce(v.vec_id = coalesce(l.low, v.vec_id), true) AS kept
FROM v LEFT JOIN n USING (rid) LEFT JOIN lowest l ON l.vec_id = v.vec_id
"""

QUOTED_MESSAGES = r"""
SELECT m.conv_id, m.turn, m.role,
       CASE WHEN m.turn % 3 = 2 AND c.text IS NOT NULL
            THEN '> > ' || replace(c.text, chr(10), chr(10) || '> > ') || chr(10) ELSE '' END
       || CASE WHEN b.text IS NOT NULL THEN '> ' || replace(b.text, chr(10), chr(10) || '> ') || chr(10) ELSE '' END
       || m.text AS text
FROM conversations m LEFT JOIN conversations b ON b.conv_id = m.conv_id AND b.turn = m.turn - 1
LEFT JOIN conversations c ON c.conv_id = m.conv_id AND c.turn = m.turn - 2
"""


def conversations(messages: str) -> str:
    """Reply-ordered conversations of the rows (conv_id, turn, role, text) of the query ``messages``."""
    return rf"""
WITH RECURSIVE m AS (SELECT row_number() OVER () AS rid, * FROM ({messages})),
split AS (SELECT rid, string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)) AS l FROM m),
raw AS (SELECT rid, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM split),
marked AS (SELECT rid, i, x, regexp_extract(x, '^((?:[ \t]*>)*)', 1) AS marks FROM raw),
line AS (SELECT rid, i, length(regexp_replace(marks, '[ \t]', '', 'g')) AS level,
                CASE WHEN marks = '' THEN x ELSE regexp_replace(substr(x, length(marks) + 1), '^ ', '') END AS content
         FROM marked),
turned AS (SELECT *, CASE WHEN level IS DISTINCT FROM lag(level) OVER (PARTITION BY rid ORDER BY i) THEN 1 ELSE 0 END
           AS begins FROM line),
placed AS (SELECT *, sum(begins) OVER (PARTITION BY rid ORDER BY i) AS place FROM turned),
passage AS (SELECT rid, place, level, list(content ORDER BY i) AS lines,
                   trim(regexp_replace(lower(string_agg(content, chr(10) ORDER BY i)), '\s+', ' ', 'g')) AS whole
            FROM placed GROUP BY rid, place, level),
own AS (SELECT rid, regexp_replace(string_agg(content, chr(10) ORDER BY i), '^\s+|\s+$', '', 'g') AS text
        FROM line WHERE level = 0 GROUP BY rid),
said AS (SELECT m.rid, m.conv_id, m.turn, m.role, coalesce(own.text, '') AS text FROM m LEFT JOIN own USING (rid)),
quote AS (SELECT said.conv_id, said.turn, p.* FROM passage p JOIN said USING (rid)
          WHERE p.level > 0 AND p.whole <> '' AND said.conv_id IS NOT NULL AND said.turn IS NOT NULL),
piece AS (SELECT rid, whole AS piece FROM passage WHERE level = 0
          UNION SELECT rid, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) FROM said
          UNION SELECT rid, trim(regexp_replace(lower(unnest(string_split(text, chr(10)))), '\s+', ' ', 'g')) FROM said),
original AS (SELECT conv_id, piece, min(turn) AS original FROM piece JOIN said USING (rid)
             WHERE piece <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, piece),
key AS (SELECT conv_id, turn, rid, place, level, 0 AS rank, whole AS piece FROM quote
        UNION ALL SELECT conv_id, turn, rid, place, level, 1,
                         trim(regexp_replace(lower(unnest(lines)), '\s+', ' ', 'g')) FROM quote),
hit AS (SELECT k.conv_id, k.turn, k.place, k.level, k.rank, CASE WHEN o.original < k.turn THEN o.original END AS original
        FROM key k LEFT JOIN original o USING (conv_id, piece) WHERE k.piece <> ''),
found AS (SELECT conv_id, turn, place, level, coalesce(max(original) FILTER (rank = 0),
                                                       max(original) FILTER (rank = 1)) AS original
          FROM hit GROUP BY conv_id, turn, place, level),
link AS (SELECT conv_id, turn, arg_min(original, (level, -original)) FILTER (original IS NOT NULL) AS parent_turn,
                count(*) AS n_quotes, count(original) AS n_linked FROM found GROUP BY conv_id, turn),
climb(conv_id, turn, top, depth) AS (
    SELECT conv_id, turn, parent_turn, 1 FROM link WHERE parent_turn IS NOT NULL
    UNION ALL SELECT c.conv_id, c.turn, l.parent_turn, c.depth + 1 FROM climb c
    JOIN link l ON l.conv_id = c.conv_id AND l.turn = c.top AND l.parent_turn IS NOT NULL),
thread AS (SELECT conv_id, turn, arg_max(top, depth) AS thread_turn, max(depth) AS depth FROM climb GROUP BY conv_id, turn)
SELECT s.conv_id, coalesce(t.thread_turn, s.turn) AS thread_turn, s.turn, s.role, s.text, l.parent_turn,
       coalesce(t.depth, 0)::BIGINT AS depth, coalesce(l.n_quotes, 0)::BIGINT AS n_quotes,
       coalesce(l.n_linked, 0)::BIGINT AS n_linked
FROM said s LEFT JOIN link l USING (conv_id, turn) LEFT JOIN thread t USING (conv_id, turn)
"""


def mixing(weights: tuple[float, ...], budget: float, most: float, fills: int) -> str:
    """What a mix of all documents takes: thresholds as running sums in hash order."""
    weight = " ".join(f"WHEN {i} THEN {w}::DOUBLE" for i, w in enumerate(weights))
    sql = rf"""
WITH d AS (SELECT doc_id, coalesce('s' || source, 'n') AS key, source,
                  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash FROM documents),
src AS (SELECT key, source, sum(size)::BIGINT AS source_size FROM d GROUP BY key, source),
weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % {len(weights)} {weight} END
            AS weight, source_size * {most}::DOUBLE AS bound FROM src),
leveled AS (SELECT *, (sum(source_size) OVER () * {budget}::DOUBLE
                       - coalesce(sum(bound) OVER (ORDER BY bound / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(weight) OVER (ORDER BY bound / weight, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                      AS level FROM weighed),
goal AS (SELECT key, source_size, coalesce(least(max(level) FILTER (level < bound / weight) OVER () * weight, bound), bound)
                AS target FROM leveled),
plan0 AS (SELECT *, floor(target / greatest(source_size, 1))::BIGINT AS copies,
                 target - floor(target / greatest(source_size, 1))::BIGINT * source_size AS room, 0::BIGINT AS start FROM goal)
"""
    taken = []
    for i in range(1 + fills):
        fits = "d.size <= p.room" if i else "true"
        sql += f""",
fit{i} AS (SELECT d.key, d.hash, d.size, p.room, sum(d.size) OVER (PARTITION BY d.key ORDER BY d.hash) AS upto
           FROM d JOIN plan{i} p USING (key) WHERE d.size > 0 AND d.hash >= p.start AND {fits}),
edge{i} AS (SELECT key, coalesce(min(hash) FILTER (upto > room), 1::BIGINT << 60) AS below FROM fit{i} GROUP BY key),
in{i} AS (SELECT f.key, f.hash, f.size FROM fit{i} f JOIN edge{i} e USING (key) WHERE f.hash < e.below),
plan{i + 1} AS (SELECT p.key, p.source_size, p.target, p.copies,
                       p.room - coalesce((SELECT sum(size) FROM in{i} WHERE in{i}.key = p.key), 0) AS room,
                       coalesce(e.below, p.start) AS start FROM plan{i} p LEFT JOIN edge{i} e USING (key))"""
        taken.append(f"SELECT DISTINCT key, hash, size FROM in{i}")
    return sql + f"""
SELECT d.doc_id, d.size, p.source_size, p.target,
       (d.size * (p.copies + CASE WHEN x.key IS NULL THEN 0 ELSE 1 END))::BIGINT AS taken
FROM d JOIN plan0 p USING (key) LEFT JOIN ({" UNION ".join(taken)}) x USING (key, hash, size)
"""


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars"]
    parts = [f"coalesce(strlen({f}::VARCHAR)::VARCHAR || ':' || {f}::VARCHAR, '-')" for f in [*fields, text]]
    return f"sha256({' || '.join(parts)})"


#: The lowest bit of the CRC-32 of a number's decimal digits: eight shifts of the register (marked -1) after every byte.
EVEN_CRC = """((list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda crc, step:
    CASE WHEN step >= 0 THEN xor(crc, step) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END) & 1) = 1)"""


def _reduced(name: str, levels: int) -> str:
    """CTEs ``name``0 (tree, pos, hash) reduced level by level; ``name``_at0.. also have each node's siblings."""
    sql = ""
    for i in range(levels):
        at, up = f"{name}{i}", f"{name}{i + 1}"
        sql += f""",
{name}_at{i} AS (SELECT tree, pos, hash, count(*) OVER (PARTITION BY tree) AS n,
    coalesce(string_agg(hash, '') OVER (PARTITION BY tree, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(hash, '') OVER (PARTITION BY tree, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {at}),
{up} AS (SELECT tree, pos // 3 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(hash) ELSE sha256(string_agg(hash, '' ORDER BY pos)) END AS hash
  FROM {name}_at{i} GROUP BY tree, pos // 3)"""
    return sql


def manifest(levels: int = 15, top_levels: int = 6) -> str:
    """The Merkle manifest for up to 3^levels documents of a source and 3^top_levels sources."""
    sql = rf"""
WITH docs AS (SELECT *, {_leaf("text")} AS leaf,
    CASE WHEN {EVEN_CRC} THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS found FROM documents),
numbered AS (SELECT *, coalesce('s' || source, 'n') AS tree, row_number() OVER (PARTITION BY source
    ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs),
a0 AS (SELECT tree, pos, leaf AS hash FROM numbered){_reduced("a", levels)},
ranked AS (SELECT tree AS source, hash, row_number() OVER (ORDER BY tree COLLATE "C") - 1 AS pos FROM a{levels}),
b0 AS (SELECT '' AS tree, pos, hash FROM ranked){_reduced("b", top_levels)},
f0 AS (SELECT doc_id, leaf, tree, pos, found AS folded, '' AS proof FROM numbered)"""
    for i in range(levels):
        sql += f""",
f{i + 1} AS (SELECT f.doc_id, f.leaf, f.tree, f.pos // 3 AS pos, f.proof || a.before || a.after AS proof,
    CASE WHEN a.n = 1 THEN f.folded ELSE sha256(a.before || f.folded || a.after) END AS folded
  FROM f{i} f JOIN a_at{i} a USING (tree, pos))"""
    sql += f""",
g0 AS (SELECT f.doc_id, f.leaf, r.hash AS subroot, r.pos, f.folded, f.proof FROM f{levels} f JOIN ranked r ON r.source = f.tree)"""
    for i in range(top_levels):
        sql += f""",
g{i + 1} AS (SELECT g.doc_id, g.leaf, g.subroot, g.pos // 3 AS pos, g.proof || b.before || b.after AS proof,
    CASE WHEN b.n = 1 THEN g.folded ELSE sha256(b.before || g.folded || b.after) END AS folded
  FROM g{i} g JOIN b_at{i} b USING (pos))"""
    return sql + f"""
SELECT g.doc_id, g.leaf, g.subroot, b.hash AS root, sha256(g.proof) AS proof_sha256, g.folded AS folded_root,
       g.folded = b.hash AS verified
FROM g{top_levels} g, b{top_levels} b
"""


def lines_dropped(min_docs: int, min_chars: int) -> str:
    """Every document without the lines whose key ``min_docs`` documents have."""
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT rid, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM docs),
keyed AS (SELECT *, translate(trim(line, {white}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
common AS (SELECT key FROM keyed WHERE length(key) >= {min_chars} GROUP BY key HAVING count(DISTINCT rid) >= {min_docs}),
kept AS (SELECT rid, string_agg(line, chr(10) ORDER BY place) AS text, count(*) AS n FROM keyed
         WHERE key NOT IN (SELECT key FROM common) GROUP BY rid)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""
