"""Queries over the corpus as a whole (mixing, manifest, vocabulary) and their SQL."""

from __future__ import annotations

from silverlode.llm import manifest, mixing, variants
from silverlode.llm.shared import table

QUERIES, SQL = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op11_mix(spark, sf):
    return mixing.measure(table(spark, sf, "documents"))


def _u32(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


SQL["op11_mix"] = rf"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS h, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS size, count(*) FILTER (size > 0) AS worded, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
  FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][sid % 3 + 1] AS weight, (sum(size) OVER ())::BIGINT AS total FROM s
), k AS (
  SELECT *, coalesce(sum(size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS full_size,
         (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS open_weight
  FROM w WINDOW o AS (ORDER BY size::DOUBLE / weight, sid)
), l AS (
  SELECT (1.5::DOUBLE * total - 2 * full_size) / open_weight AS level FROM k
  WHERE weight * ((1.5::DOUBLE * total - 2 * full_size) / open_weight) <= 2 * size ORDER BY size::DOUBLE / weight, sid LIMIT 1
), t AS (
  SELECT w.*, CASE WHEN weight * level > 2 * size THEN 2.0::DOUBLE * size ELSE weight * level END AS target FROM w, l
), p AS (
  SELECT *, CASE WHEN size > 0 THEN floor(target)::BIGINT // size ELSE 0 END AS epochs,
         CASE WHEN size > 0 THEN floor(target)::BIGINT % size ELSE 0 END AS rest,
         greatest(1, least(worded, ceil(size / {mixing.BLOCK_WORDS}::DOUBLE)::BIGINT)) AS blocks FROM t
), r AS (
  SELECT sid, doc_id, h, copy, d.size, p.size AS source_size, target, epochs, rest, blocks,
         {_u32("concat_ws(':', 'mix', coalesce(doc_id::VARCHAR, '-'), h, copy)")} AS u
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, source, h) AS copy FROM d) d JOIN p ON d.source IS NOT DISTINCT FROM p.source
), x AS (
  SELECT *, (u * blocks) >> 32 AS block FROM r
), b AS (
  SELECT sid, block, any_value(rest) AS rest, sum(size)::BIGINT AS words,
         ({list(mixing.PRIMES)}[{_u32("concat_ws(':', 'mix', 'times', sid, any_value(epochs))")} % 8 + 1] * block
          + {_u32("concat_ws(':', 'mix', 'plus', sid, any_value(epochs))")} % any_value(blocks)) % any_value(blocks) AS place
  FROM x WHERE size > 0 GROUP BY sid, block
), q AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY sid ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM b
), y AS (
  SELECT x.*, coalesce(sum(x.size) OVER (PARTITION BY x.sid, x.block ORDER BY u, h, doc_id, copy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS inside,
         q.words, q.before FROM x LEFT JOIN q ON x.sid = q.sid AND x.block = q.block
)
SELECT doc_id, size, source_size, target,
       epochs * size + CASE WHEN rest > coalesce(before, rest) THEN greatest(0, least(size, rest - before - inside)) ELSE 0 END AS taken
FROM y
"""


@query
def op12_manifest(spark, sf):
    return manifest.audit(table(spark, sf, "documents"))


#: crc32 by its table of 256 entries, which SQL makes from the polynomial; over a list of bytes.
_CRC_TABLE = """crc AS (
  SELECT list(t ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t
    FROM (SELECT unnest(range(256)) AS i))
)"""


def _crc(data: str) -> str:
    return f"xor(list_reduce([4294967295::BIGINT] || {data}, lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295::BIGINT)"


def _tree_sql(nodes: str, rows: str, name: str, levels: int) -> str:
    """CTEs that climb ``levels`` levels from ``nodes`` (k, pos, n, d) and take ``rows`` (row, k, pos, n, proof, f) along."""
    out = []
    for i in range(levels):
        below, at = (f"{name}{i - 1}", f"{name}row{i - 1}") if i else (nodes, rows)
        out.append(f"""{name}fam{i} AS (
  SELECT k, pos // 3 AS pos, any_value(n) AS n, {", ".join(f"coalesce(max(d) FILTER (pos % 3 = {c}), '') AS c{c}" for c in range(3))} FROM {below} GROUP BY k, pos // 3
), {name}{i} AS (
  SELECT k, pos, CASE WHEN n > 1 THEN (n + 2) // 3 ELSE n END AS n, CASE WHEN n > 1 THEN sha256(c0 || c1 || c2) ELSE c0 END AS d FROM {name}fam{i}
), {name}row{i} AS (
  SELECT r.row, r.k, r.pos // 3 AS pos, CASE WHEN r.n > 1 THEN (r.n + 2) // 3 ELSE r.n END AS n,
         CASE WHEN r.n > 1 THEN r.proof || CASE r.pos % 3 WHEN 0 THEN c1 || c2 WHEN 1 THEN c0 || c2 ELSE c0 || c1 END ELSE r.proof END AS proof,
         CASE WHEN r.n > 1 THEN sha256(CASE r.pos % 3 WHEN 0 THEN f || c1 || c2 WHEN 1 THEN c0 || f || c2 ELSE c0 || c1 || f END) ELSE f END AS f
  FROM {at} r JOIN {name}fam{i} g ON r.k = g.k AND r.pos // 3 = g.pos
)""")
    return ", ".join(out)


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c} END"
                                   for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


SQL["op12_manifest"] = f"""
WITH {_CRC_TABLE}, d AS (
  SELECT *, {_leaf_sql("text")} AS leaf, {_leaf_sql("replace(text, chr(10), '')")} AS struck,
         coalesce({_crc("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} % 2 = 0, false) AS tampered
  FROM documents, crc
), s AS (
  SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS k FROM d GROUP BY source
), l AS (
  SELECT row_number() OVER () AS row, doc_id, k, n, leaf, CASE WHEN tampered THEN struck ELSE leaf END AS seen,
         row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source
), n0 AS (
  SELECT k, pos, n, leaf AS d FROM l
), r0 AS (
  SELECT row, k, pos, n, '' AS proof, seen AS f FROM l
), {_tree_sql("n0", "r0", "a", 14)}, n1 AS (
  SELECT 0 AS k, k AS pos, (count(*) OVER ()) AS n, d FROM a13
), r1 AS (
  SELECT row, 0 AS k, k AS pos, (SELECT count(*) FROM s) AS n, proof, f FROM arow13
), {_tree_sql("n1", "r1", "b", 6)}
SELECT doc_id, leaf, a13.d AS subroot, b5.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = b5.d AS verified
FROM l JOIN brow5 USING (row) JOIN a13 ON l.k = a13.k, b5
"""


@query
def op13_spelling_variants(spark, sf):
    return variants.variants(table(spark, sf, "documents"))


# DuckDB measures edits in bytes: each letter beyond ASCII becomes one free ASCII character first.
_WIDE = "".join(map(chr, range(0xC0, 0x100)))
_NARROW = "".join(c for c in map(chr, range(33, 127)) if not c.islower() and c != "'")[:len(_WIDE)]
_BYTES = ("flatten(list_transform(string_split({0}, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [195::BIGINT, ord(x)::BIGINT - 64] END))")

SQL["op13_spelling_variants"] = rf"""
WITH RECURSIVE {_CRC_TABLE}, runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), named AS (
  SELECT run, c, {_crc(_BYTES.format("id || ':' || run"))} AS h
  FROM (SELECT id, run, count(*) AS c FROM runs WHERE length(run) >= 6 GROUP BY id, run), crc
), words AS (
  SELECT word, sum(c)::BIGINT AS n, translate(word, '{_WIDE}', '{_NARROW}') AS w FROM (
    SELECT c, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM named)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM words a JOIN words b
  ON length(b.w) BETWEEN length(a.w) - 1 AND length(a.w) + 1 AND a.word <> b.word WHERE levenshtein(a.w, b.w) = 1
), best AS (
  SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS o, max(other_n) AS o_n FROM near GROUP BY word, n
), forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN o_n >= 5 * words.n THEN o END AS form,
         CASE WHEN o_n >= 5 * words.n THEN o_n END AS form_n FROM words LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS at FROM forms UNION ALL SELECT walk.word, f.form FROM walk JOIN forms f ON walk.at = f.word WHERE f.form IS NOT NULL
), ends AS (
  SELECT walk.word, walk.at AS root FROM walk JOIN forms f ON walk.at = f.word WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""
