"""DuckDB SQL of the queries that SQL can express."""

NEAR_DUPS = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
    END AS items
  FROM words),
sizes AS (SELECT doc_id, len(items) AS n FROM sets),
items AS (SELECT doc_id, unnest(items) AS item FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT s.a, s.b FROM shared s
  JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
  WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)),
reach AS (
  SELECT doc_id, doc_id AS other FROM sizes
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT r.doc_id, any_value(s.n)::BIGINT AS n_shingles, min(r.other) AS component_id,
       r.doc_id = min(r.other) AS kept
FROM reach r JOIN sizes s ON s.doc_id = r.doc_id
GROUP BY r.doc_id
"""


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text; the table follows from the reflected polynomial."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    values = ", ".join(map(str, table))
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    step = f"xor(c >> 8, ([{values}]::BIGINT[])[1 + (xor(c, x) & 255)])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, x: {step}), 4294967295)"


def merkle_sql(source_levels: int = 6, root_levels: int = 5) -> str:
    """Hash trees with runs of 16, for up to 16 ** ``source_levels`` rows a source and so many sources.

    Every level is a table of runs; a node that is alone in its row stays as it is.
    """
    names = ("doc_id", "source", "lang", "n_chars")

    def field(x: str) -> str:
        return f"coalesce(octet_length(encode({x}::VARCHAR)) || ':' || {x}::VARCHAR, '-')"

    head = " || ".join(field(c) for c in names)
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [
        f"hashed AS (SELECT doc_id, source, sha256({head} || {field('text')}) AS leaf, "
        f"CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 5 = 0 "
        f"THEN sha256({head} || {field(lower)}) END AS tampered FROM documents)",
        "p0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 "
        "AS place, count(*) OVER (PARTITION BY source) AS n, "
        "dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree, '' AS proof, "
        "leaf AS node, coalesce(tampered, leaf) AS other FROM hashed)",
    ]

    def level(k: int, tree: str, last: str) -> None:
        """Runs of a row, and every leaf one step further."""
        ctes.append(
            f"r{k} AS (SELECT {tree} AS tree, place // 16 AS run, string_agg(node, '' ORDER BY place) AS h "
            f"FROM (SELECT DISTINCT {tree}, place, node FROM {last} WHERE n > 1) GROUP BY 1, 2)"
        )
        left = "substr(h, 1, 64 * (place % 16))"
        right = "substr(h, 64 * (place % 16) + 65)"
        ctes.append(
            f"p{k} AS (SELECT l.* REPLACE (CASE WHEN h IS NULL THEN place ELSE place // 16 END AS place, "
            f"CASE WHEN h IS NULL THEN n ELSE (n + 15) // 16 END AS n, "
            f"CASE WHEN h IS NULL THEN proof ELSE proof || {left} || {right} END AS proof, "
            f"CASE WHEN h IS NULL THEN node ELSE sha256(h) END AS node, "
            f"CASE WHEN h IS NULL THEN other ELSE sha256({left} || other || {right}) END AS other) "
            f"FROM {last} l LEFT JOIN r{k} r ON l.n > 1 AND r.tree = l.{tree} AND r.run = l.place // 16)"
        )

    for k in range(1, source_levels + 1):
        level(k, "tree", f"p{k - 1}")
    ctes.append(
        f"tops AS (SELECT * REPLACE (tree AS place, (SELECT max(tree) + 1 FROM p0) AS n), "
        f"node AS subroot, 0 AS top FROM p{source_levels})"
    )
    last = "tops"
    for k in range(source_levels + 1, source_levels + root_levels + 1):
        level(k, "top", last)
        last = f"p{k}"
    return (
        f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, "
        f"other AS folded_root, other = node AS verified FROM {last}"
    )


def clusters_sql(clusters: int = 40, rounds: int = 5, seed: int = 2, dimensions: int = 64) -> str:
    """Rounds of assignment and floored means over integer vectors, one table each."""
    ctes = [
        "kept AS MATERIALIZED (SELECT row_number() OVER () AS k, vec_id, "
        "list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings "
        f"WHERE len(embedding) = {dimensions} "
        f"AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 "
        f"AS j, v FROM kept QUALIFY j < {clusters})",
    ]
    square = "list_sum(list_transform(list_zip(a.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for r in range(rounds + 1):
        ctes.append(
            f"a{r} AS MATERIALIZED (SELECT k, min(struct_pack(d := d, j := j)) AS best FROM "
            f"(SELECT a.k, c.j, {square} AS d FROM kept a CROSS JOIN c{r} c) GROUP BY k)"
        )
        if r < rounds:
            ctes.append(
                f"s{r} AS (SELECT best.j AS j, i, sum(x)::BIGINT AS s, count(*) AS n FROM "
                f"(SELECT best, unnest(v) AS x, unnest(range({dimensions})) AS i FROM kept JOIN a{r} USING (k)) "
                f"GROUP BY 1, 2)"
            )
            ctes.append(
                f"c{r + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN "
                f"(SELECT j, list((s - (s % n + n) % n) // n ORDER BY i) AS v FROM s{r} GROUP BY j) m USING (j))"
            )
    return (
        f"WITH {', '.join(ctes)} SELECT vec_id, best.j::INTEGER AS cluster, best.d AS distance, "
        f"(sum(best.d) OVER (PARTITION BY best.j))::BIGINT AS cluster_inertia, "
        f"(sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256 "
        f"FROM kept JOIN a{rounds} USING (k) JOIN c{rounds} c ON c.j = best.j"
    )
