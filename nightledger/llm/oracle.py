"""DuckDB SQL for the queries whose whole result SQL can express.

The others run trained models, a tokenizer, a search index or seeded draws;
tests hold them against plain versions, the library or brute force.
"""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

#: Every pair that shares a shingle, counted; links; the least document that links reach.
OP9 = rf"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w ELSE w[i:i + 1] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM cut WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM both_ JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * m >= 80 * (p.n + q.n - m)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
home AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN size ON size.doc_id = d.doc_id JOIN home ON home.x = d.doc_id
"""

OP10 = rf"""
WITH cut AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
five AS (SELECT r, i, w[i:i + 4] AS f FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM cut WHERE len(w) > 4)),
twice AS (SELECT r, i FROM five QUALIFY count(*) OVER (PARTITION BY r, f) > 1),
covered AS (SELECT r, count(DISTINCT i + j) AS n FROM twice, range(5) AS o(j) GROUP BY r),
counted AS (
  SELECT doc_id, len(w) AS n_words, len(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    len(t) - len(translate(t, '#*$%&|<>', '')) AS n_symbols, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l,
    coalesce(n, 0) AS n_repeat_words, len(t) - len(regexp_replace(t, '\p{{Lu}}+', '', 'g')) AS capitals
  FROM cut LEFT JOIN covered USING (r)),
stats AS (SELECT *, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 5 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 2 * capitals > word_chars
       OR word_chars NOT BETWEEN 2 * n_words AND 15 * n_words) AS kept
FROM stats
"""


def _merkle(levels: int = 14) -> str:
    """Every level of every tree, at most FAN ** levels rows a source; a tree of one node stays as it is."""
    def field(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS varchar))) || ':' || CAST({c} AS varchar) END"

    def hashed(text):
        return f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    shown = "replace(text, chr(10), '')"

    def climb(base: str, to: str) -> list[str]:
        # base0 (tree, pos, h): nodes; walk0 (r, tree, pos, proof, f): rows on their way up
        out = []
        for k in range(levels):
            out += [f"{base}n{k} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY tree) AS cnt FROM {base}{k})",
                    f"{base}{k + 1} AS MATERIALIZED (SELECT tree, pos // 3 AS pos, CASE WHEN any_value(cnt) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) "
                    f"ELSE any_value(h) END AS h FROM {base}n{k} GROUP BY tree, pos // 3)",
                    f"{to}{k + 1} AS MATERIALIZED (SELECT w.r, w.tree, w.pos // 3 AS pos, "
                    f"any_value(w.proof) || coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos <> w.pos), '') AS proof, "
                    f"CASE WHEN any_value(cnt) > 1 THEN sha256(string_agg(CASE WHEN n.pos = w.pos THEN w.f ELSE n.h END, '' ORDER BY n.pos)) ELSE any_value(w.f) END AS f "
                    f"FROM {to}{k} w JOIN {base}n{k} n ON n.tree IS NOT DISTINCT FROM w.tree AND n.pos // 3 = w.pos // 3 GROUP BY w.r, w.tree, w.pos)"]
        return out

    bytes_of = "list_transform(range(1, length(CAST(doc_id AS varchar)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS varchar), i, 1)) AS bigint))"
    # the checksum's polynomial 0xEDB88320, reflected; the last xor with all ones turns the lowest bit round
    crc = (f"list_reduce(list_prepend(4294967295, {bytes_of}), lambda c, b: "
           "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))")
    ctes = [f"d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, source, {hashed('text')} AS leaf, "
            f"CASE WHEN ({crc} & 1) = 1 THEN {hashed(shown)} ELSE {hashed('text')} END AS claim FROM documents)",
            "p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d)",
            "l0 AS (SELECT source AS tree, pos, leaf AS h FROM p)", "w0 AS (SELECT r, source AS tree, pos, '' AS proof, claim AS f FROM p)",
            *climb("l", "w"),
            f"s AS MATERIALIZED (SELECT tree, h, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS pos FROM l{levels})",
            "t0 AS (SELECT 1 AS tree, pos, h FROM s)",
            f"v0 AS (SELECT w.r, 1 AS tree, s.pos, w.proof, w.f FROM w{levels} w JOIN s ON s.tree IS NOT DISTINCT FROM w.tree)",
            *climb("t", "v")]
    return (f"WITH {', '.join(ctes)} SELECT p.doc_id, p.leaf, s.h AS subroot, t{levels}.h AS root, sha256(v.proof) AS proof_sha256, v.f AS folded_root, "
            f"v.f = t{levels}.h AS verified FROM v{levels} v JOIN p USING (r) JOIN s ON s.tree IS NOT DISTINCT FROM p.source CROSS JOIN t{levels}")


OP11 = _merkle()


def _codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Codebooks as lists of integers, every part against every entry, round by round."""
    def nearest(k):
        return (f"a{k} AS MATERIALIZED (SELECT p, part, any_value(n) AS n, min(struct_pack(d := list_sum(list_transform(list_zip(part, c), "
                f"lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := e)) AS best FROM u JOIN b{k} USING (p) GROUP BY p, part)")

    ctes = ["v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS double)) AS bigint)) AS x "
            "FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
            f"c AS MATERIALIZED (SELECT r, vec_id, p, x[p * len(x) // {parts} + 1:(p + 1) * len(x) // {parts}] AS part FROM v, range({parts}) AS o(p))",
            "u AS MATERIALIZED (SELECT p, part, count(*) AS n FROM c GROUP BY ALL)",
            f"b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id, part) - 1 AS e, part AS c FROM c WHERE vec_id IS NOT NULL "
            f"QUALIFY e < {entries})"]
    for k in range(rounds):
        ctes += [nearest(k),
                 f"m{k} AS MATERIALIZED (SELECT p, e, list(CAST(floor(s) AS bigint) ORDER BY i) AS c FROM (SELECT p, best.e AS e, i, sum(part[i + 1] * n) // sum(n) "
                 f"- CASE WHEN sum(part[i + 1] * n) < 0 AND sum(part[i + 1] * n) % sum(n) <> 0 THEN 1 ELSE 0 END AS s "
                 f"FROM a{k}, range(len(part)) AS o(i) GROUP BY p, best.e, i) GROUP BY p, e)",
                 f"b{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN m{k} USING (p, e))"]
    ctes += [nearest(rounds),
             f"f AS MATERIALIZED (SELECT r, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code, sum(best.d) AS error FROM c JOIN a{rounds} USING (p, part) GROUP BY r)",
             f"h AS (SELECT sha256(string_agg(CAST(c[i + 1] AS varchar), ',' ORDER BY p, e, i)) AS s FROM b{rounds}, range(len(c)) AS o(i))"]
    return (f"WITH {', '.join(ctes)} SELECT vec_id, code, CAST(error AS bigint) AS error, CAST(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error, "
            "h.s AS codebooks_sha256 FROM v JOIN f USING (r) CROSS JOIN h")


OP13 = _codes()
