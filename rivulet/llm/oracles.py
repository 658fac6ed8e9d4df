"""DuckDB SQL of the queries that SQL can express, by plain windows over words or bytes."""

from __future__ import annotations

_SPACES = r"[\x20\x09-\x0D]+"

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  list_filter(string_split_regex(coalesce(text, ''), '{_SPACES}'), lambda x: x <> '') AS w FROM documents),
     h AS (SELECT r, unnest(list_transform(range(1, len(w) - 33),
                                           lambda i: struct_pack(i := i, k := md5(array_to_string(w[i:i + 34], ' '))))) AS x
           FROM d WHERE len(w) >= 35),
     twice AS (SELECT x.k AS k FROM h GROUP BY 1 HAVING count(*) > 1),
     hit AS (SELECT h.r, h.x.i AS i FROM h JOIN twice ON h.x.k = twice.k),
     words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
     marked AS (SELECT words.r, p, word, coalesce(max(hit.i) OVER (PARTITION BY words.r ORDER BY p
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) >= p - 34, false) AS gone
                FROM words LEFT JOIN hit ON hit.r = words.r AND hit.i = words.p),
     kept AS (SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS t
              FROM marked GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.r = d.r
"""

SUFFIX_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
     b AS (SELECT r, doc_id, x, CAST(length(x) // 2 AS BIGINT) AS n FROM d),
     h AS (SELECT r, doc_id, unnest(list_transform(range(0, n - 99),
                  lambda p: struct_pack(p := p, k := md5(x[2 * p + 1:2 * p + 200])))) AS y FROM b WHERE n >= 100),
     hit AS (SELECT r, y.p AS p FROM (SELECT r, y, row_number() OVER (PARTITION BY y.k ORDER BY doc_id NULLS FIRST, r, y.p) AS nth
                                      FROM h) WHERE nth > 1),
     cut AS (SELECT r, regexp_extract_all(x, '..') AS c FROM b),
     bytes AS (SELECT r, unnest(c) AS c, generate_subscripts(c, 1) - 1 AS p FROM cut),
     marked AS (SELECT bytes.r, bytes.p, c, coalesce(max(hit.p) OVER (PARTITION BY bytes.r ORDER BY bytes.p
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) >= bytes.p - 99, false) AS gone
                FROM bytes LEFT JOIN hit ON hit.r = bytes.r AND hit.p = bytes.p),
     runs AS (SELECT r, p, c, gone, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY r ORDER BY p) AS opens FROM marked),
     kept AS (SELECT r, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
                     string_agg(c, '' ORDER BY p) FILTER (NOT gone) AS t
              FROM runs GROUP BY r)
SELECT b.doc_id, b.n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(t, ''))) AS kept_sha256
FROM b LEFT JOIN kept ON kept.r = b.r
"""


def _whole(scale: int) -> str:
    """Vectors of whole doubles; rows with a null vector or an odd component are left out."""
    return f"""SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v FROM embeddings
          WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


TOP_PRODUCTS = f"""
WITH e AS ({_whole(64)}),
     s AS (SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.v, p.v) AS BIGINT) AS score
           FROM e q JOIN e p ON q.vec_id <> p.vec_id WHERE q.vec_id % 20 = 0),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
"""

HARD_NEGATIVES = f"""
WITH w AS ({_whole(256)}),
     e AS (SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS y FROM w WHERE label IS NOT NULL),
     s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.y = r.y AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
           FROM e a JOIN e r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
     p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
     n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                  row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS k
           FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
                        AND 100 * s.score BETWEEN 50 * p.score AND 95 * p.score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 3
"""


def _merkle(levels: int = 7, top_levels: int = 4) -> str:
    """Every tree level by level (documents of a language up to 8 ** levels), then each leaf folded through its runs."""
    def field(name: str, value: str | None = None) -> str:
        value = value or f"CAST({name} AS VARCHAR)"
        return f"CASE WHEN {name} IS NULL THEN '-' ELSE CAST(strlen({value}) AS VARCHAR) || ':' || {value} END"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rest = " || ".join(field(f) for f in ("doc_id", "source", "lang", "n_chars"))
    ids = "CAST(doc_id AS VARCHAR)"
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))"
    crc = (f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, length({ids}) + 1), "
           f"lambda i: CAST(ascii(substr({ids}, i, 1)) AS BIGINT))), lambda c, b: {bits}), 4294967295)")
    ctes = [f"""d AS (SELECT row_number() OVER () AS r, doc_id, lang AS g, sha256({rest} || {field('text')}) AS leaf,
                  CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN sha256({rest} || {field('text', lower)}) END AS changed FROM documents)""",
            """l0 AS (SELECT r, doc_id, g, leaf AS x, coalesce(changed, leaf) AS start,
                  row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS total FROM d)"""]

    def tree(name: str, height: int) -> str:
        tops = [f"SELECT g, x, total FROM {name}0 WHERE total = 1"]
        for j in range(height):
            ctes.append(f"{name}r{j} AS (SELECT g, pos // 8 AS run, any_value(total) AS total, list(x ORDER BY pos) AS ch FROM {name}{j} "
                        f"WHERE total > {8 ** j} GROUP BY g, pos // 8)")
            ctes.append(f"{name}{j + 1} AS (SELECT g, run AS pos, total, sha256(array_to_string(ch, '')) AS x FROM {name}r{j})")
            tops.append(f"SELECT g, x, total FROM {name}{j + 1} WHERE total > {8 ** j} AND total <= {8 ** (j + 1)}")
        return " UNION ALL ".join(tops)

    def fold(start: str, name: str, runs: str, height: int) -> str:
        """Folds ``start`` (r, g, pos, total, cur, proof) through the runs of every level."""
        before = start
        for j in range(height):
            digit = f"((f.pos // {8 ** j}) % 8)"
            left, right = f"array_to_string(u.ch[1:{digit}], '')", f"array_to_string(u.ch[{digit} + 2:], '')"
            ctes.append(f"""{name}{j} AS (SELECT f.r, f.g, f.pos, f.total, CASE WHEN u.ch IS NULL THEN f.cur ELSE sha256({left} || f.cur || {right}) END AS cur,
                  CASE WHEN u.ch IS NULL THEN f.proof ELSE f.proof || {left} || {right} END AS proof
                  FROM {before} f LEFT JOIN {runs}{j} u ON u.g IS NOT DISTINCT FROM f.g AND u.run = f.pos // {8 ** (j + 1)})""")
            before = f"{name}{j}"
        return before

    ctes.append(f"sub AS ({tree('l', levels)})")
    ctes.append("t0 AS (SELECT 0 AS g, g AS lang, x, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos, count(*) OVER () AS total FROM sub)")
    ctes.append(f"top AS ({tree('t', top_levels)})")
    ctes.append("f AS (SELECT r, g, pos, total, start AS cur, '' AS proof FROM l0)")
    within = fold("f", "fl", "lr", levels)
    ctes.append(f"""h AS (SELECT f.r, 0 AS g, t0.pos, t0.total, f.cur, f.proof FROM {within} f JOIN t0 ON t0.lang IS NOT DISTINCT FROM f.g)""")
    done = fold("h", "ft", "tr", top_levels)
    return f"""WITH {', '.join(ctes)}
SELECT l0.doc_id, l0.x AS leaf, sub.x AS subroot, top.x AS root, sha256(z.proof) AS proof_sha256, z.cur AS folded_root, z.cur = top.x AS verified
FROM l0 JOIN {done} z ON z.r = l0.r JOIN sub ON sub.g IS NOT DISTINCT FROM l0.g, top"""


MERKLE = _merkle()
