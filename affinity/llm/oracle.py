"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from . import licenses, merkle

OP9 = """
WITH v AS (
  SELECT vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM q JOIN v c ON q.vec_id <> c.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM s)
SELECT query_id, CAST(rk AS INTEGER) AS rank, vec_id, score FROM r WHERE rk <= 10
"""

OP8 = """
WITH m AS (
  SELECT conv_id, turn, coalesce(nullif(trim(role), ''), 'unknown') AS speaker,
         coalesce(text, '') AS content
  FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM m WHERE speaker <> 'system'),
r AS (
  SELECT m.conv_id, perspective, turn, speaker, content,
         CASE WHEN speaker = 'system' THEN 'system'
              WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role
  FROM m JOIN people p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (
  SELECT *, CASE WHEN role = 'user' THEN speaker END AS name,
         CASE WHEN role = 'user' THEN '<|user name=' || speaker || '|>' ELSE '<|' || role || '|>' END
         || chr(10) AS header
  FROM r),
o AS (
  SELECT *, header || content || '<|end|>' || chr(10) AS rendered,
         sum(strlen(header || content || '<|end|>' || chr(10))) OVER (
           PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, content
           ROWS UNBOUNDED PRECEDING) AS end_byte
  FROM h)
SELECT conv_id, perspective, turn, speaker, role, name, content, rendered,
       CAST(end_byte - strlen(rendered) AS BIGINT) AS start_byte, CAST(end_byte AS BIGINT) AS end_byte,
       CASE WHEN role = 'assistant' THEN CAST(end_byte - strlen(rendered) + strlen(header) AS BIGINT) END AS train_start,
       CASE WHEN role = 'assistant'
            THEN CAST(end_byte - strlen(rendered) + strlen(header) + strlen(content) AS BIGINT) END AS train_end,
       role = 'assistant' AS train
FROM o
"""


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _lower(text: str) -> str:
    return f"translate({text}, '{merkle.UPPER}', '{merkle.LOWER}')"


def op11(templates=licenses.TEMPLATES, slack: int = licenses.ScanParams.slack) -> str:
    """Trigrams as text, merged diagonals by a self-join on their distance."""
    rows = ",\n  ".join(f"({i}, '{t.label}', {t.cover}, {t.exact}, {_literal(t.text)})" for i, t in enumerate(templates))
    words = f"regexp_extract_all({_lower('txt')}, '{licenses.WORD}')"
    return f"""
WITH t(tid, label, cover, ex, txt) AS (VALUES
  {rows}),
tw AS (SELECT tid, label, cover, ex, {words} AS ws FROM t),
tg AS (
  SELECT tid, label, cover, ex, len(ws) AS m, i AS tpos, ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] AS gram
  FROM (SELECT *, unnest(range(len(ws) - 2)) AS i FROM tw)),
d AS (
  SELECT r, doc_id, {words} AS ws
  FROM (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS txt FROM documents)),
g AS (
  SELECT r, i AS pos, ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] AS gram
  FROM (SELECT r, ws, unnest(range(greatest(len(ws) - 2, 0))) AS i FROM d)),
hit AS (SELECT DISTINCT r, tid, label, cover, ex, m, pos - tpos AS diagonal, tpos FROM g JOIN tg USING (gram)),
base AS (
  SELECT r, label, diagonal FROM hit WHERE ex
  GROUP BY r, tid, label, m, diagonal HAVING count(*) = m - 2),
place AS (SELECT DISTINCT r, tid, label, cover, m, diagonal FROM hit WHERE NOT ex),
word AS (SELECT DISTINCT r, tid, diagonal, tpos + unnest([0, 1, 2]) AS w FROM hit WHERE NOT ex),
span AS (
  SELECT p.r, p.label, p.cover, count(DISTINCT w) / p.m AS found
  FROM place p JOIN word x ON p.r = x.r AND p.tid = x.tid AND abs(p.diagonal - x.diagonal) <= {slack}
  GROUP BY p.r, p.tid, p.label, p.cover, p.m, p.diagonal
  UNION ALL SELECT r, label, 1.0, 1.0 FROM base),
b AS (
  SELECT r, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM base GROUP BY r),
s AS (
  SELECT r, max(found) AS score, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (found >= cover) AS labels
  FROM span GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN s USING (r)
"""


OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS tx,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
lab AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
  FROM labels GROUP BY doc_id),
f AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(tx, '[^A-Z]', '', 'g')) > 2 * length(tx) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(tx, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY tx) THEN 'E' ELSE '' END AS fails
  FROM d),
m AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN lab ON f.doc_id = lab.doc_id GROUP BY part, fails),
l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
gone AS (
  SELECT part, o, fails, n, good, toxic,
         coalesce(list_min(list_filter([1, 2, 3, 4, 5], lambda k: contains(fails, o[k]))), 6) AS fell
  FROM m, orders),
steps AS (
  SELECT part, o AS filter_order, k AS step, o[k] AS x,
         sum(CASE WHEN fell > k THEN n ELSE 0 END) AS kept, sum(CASE WHEN fell = k THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fell < k AND contains(fails, o[k]) THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = o[k] THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fell = k THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN fell = k THEN toxic ELSE 0 END) AS toxic_lost
  FROM gone, (SELECT unnest([1, 2, 3, 4, 5]) AS k) GROUP BY part, o, k)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM steps
"""


def op13(levels: int = 5, tops: int = 4, fanout: int = merkle.FANOUT) -> str:
    """Levels written out: enough for fanout ** levels rows a source and fanout ** tops sources."""
    def field(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    head = " || ".join(field(c) for c in merkle.FIELDS[:-1])
    parts = []

    def climb(name: str, n: int) -> None:
        """Tables name0.. of nodes (g, i, n, dg) with their run's digests left and right."""
        run = f"PARTITION BY g, i // {fanout} ORDER BY i ROWS BETWEEN"
        for k in range(n + 1):
            if k:
                parts.append(f"""{name}{k}x AS (
  SELECT g, i // {fanout} AS i, CASE WHEN min(n) > 1 THEN sha256(string_agg(dg, '' ORDER BY i)) ELSE min(dg) END AS dg,
         CAST(ceil(min(n) / {fanout}) AS BIGINT) AS n FROM {name}{k - 1} GROUP BY g, i // {fanout})""")
            parts.append(f"""{name}{k} AS (
  SELECT g, i, n, dg, n > 1 AS more,
         coalesce(string_agg(dg, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(dg, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k}x)""")

    parts.append(f"""crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
              ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i))""")
    parts.append(f"""leaves AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('s' || source, '') AS g, sha256({head} || {field('text')}) AS leaf,
         CASE WHEN xor(list_reduce(
                list_transform(range(strlen(CAST(doc_id AS VARCHAR))), lambda j: CAST(ord(CAST(doc_id AS VARCHAR)[j + 1]) AS BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 5 = 0
              THEN sha256({head} || {field(_lower('text'))}) END AS other
  FROM documents, crc)""")
    parts.append("""placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY g) AS n
  FROM leaves)""")
    parts.append("s0x AS (SELECT g, i, n, leaf AS dg FROM placed)")
    climb("s", levels)
    parts.append(f"""u0x AS (
  SELECT 0 AS g, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n, dg, g AS source FROM s{levels})""")
    climb("u", tops)
    parts.append(f"""a0 AS (
  SELECT p.id, p.doc_id, p.leaf, p.g, p.i, o.i AS o, o.dg AS subroot, (SELECT dg FROM u{tops}) AS root,
         coalesce(p.other, p.leaf) AS f, '' AS proof
  FROM placed p JOIN u0x o ON p.g = o.source)""")
    steps = [(f"s{k}", f"a.g = x.g AND a.i // {fanout ** k} = x.i") for k in range(levels)]
    steps += [(f"u{k}", f"a.o // {fanout ** k} = x.i") for k in range(tops)]
    for k, (table, on) in enumerate(steps):
        parts.append(f"""a{k + 1} AS (
  SELECT a.* REPLACE (CASE WHEN more THEN sha256(l || f || r) ELSE f END AS f, proof || l || r AS proof)
  FROM a{k} a JOIN {table} x ON {on})""")
    body = ",\n".join(parts)
    return f"""
WITH {body}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM a{len(steps)}
"""


ORACLE = {"op8_chat_perspectives": OP8, "op9_exact_topk": OP9, "op11_license_scan": op11(),
          "op12_filter_audit": OP12, "op13_merkle_manifest": op13()}
