"""SQL that DuckDB runs over the same tables to check registered queries."""

#: Word counts, targets by water-filling and, as a source's blocks are taken in the order of its stream, the closed form of
#: what a document gives: the part of it before the target in the first round, and in the second.
MIX = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), t AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM d GROUP BY source
), w AS (SELECT *, CAST(CASE sid % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS weight FROM t
), o AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, sid) AS place,
         coalesce(sum(2 * source_size) OVER (ORDER BY source_size / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(weight) OVER (ORDER BY source_size / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavy,
         sum(source_size) OVER () AS everything
  FROM w
), f AS (
  SELECT *, CAST(everything AS DOUBLE) * 3 / 2 - CAST(before AS DOUBLE) AS remaining FROM o
), p AS (
  SELECT place AS first_place, remaining AS first_remaining, heavy AS first_heavy FROM f
  WHERE remaining * weight / heavy <= 2 * source_size ORDER BY place LIMIT 1
), s AS (
  SELECT source, source_size, CASE WHEN place < first_place THEN CAST(2 * source_size AS DOUBLE)
         ELSE first_remaining * weight / first_heavy END AS target FROM f, p
), x AS (
  SELECT d.doc_id, d.size, s.source_size, s.target, CAST(floor(s.target) AS BIGINT) AS goal,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY substr(digest, 1, 15), d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS begins
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, size, source_size, target,
       CAST(least(greatest(goal - begins, 0), size) + least(greatest(goal - source_size - begins, 0), size) AS BIGINT) AS taken FROM x
"""

#: Integer inner products of all queries with all other rows.
TOP_K = """
WITH u AS (
  SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE vec_id IS NOT NULL
), bad AS (SELECT DISTINCT vec_id FROM u WHERE x IS NULL OR NOT isfinite(x)
), v AS (
  SELECT vec_id, i, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM u WHERE vec_id NOT IN (SELECT vec_id FROM bad)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY q.vec_id, c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def shards(limit: int) -> str:
    """The shortest prefix of each document's hash bits whose documents fit the limit, level by level."""
    return f"""
WITH d AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents
), l AS (SELECT d.*, depth, h >> (60 - depth) AS prefix FROM d, range(0, 41) AS r(depth)
), n AS (
  SELECT depth, prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs FROM l GROUP BY depth, prefix
), f AS (
  SELECT l.doc_id, l.n_bytes, l.prefix, l.depth, n.shard_bytes, n.shard_docs, row_number() OVER (PARTITION BY l.doc_id ORDER BY l.depth) AS place
  FROM l JOIN n ON l.depth = n.depth AND l.prefix = n.prefix WHERE n.shard_bytes <= {limit} OR n.shard_docs = 1
)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), CAST(depth AS INTEGER), '0') END AS shard,
       CAST(depth AS INTEGER) AS depth, shard_bytes, shard_docs FROM f WHERE place = 1
"""


def _field(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


#: The checksum of a text of ASCII characters, bit by bit.
CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _tree(of: str, first: str, heights: int, name: str) -> str:
    """Nodes by height, as ``name``0 (g, idx, n, digest) and up, with the siblings of each node; complete runs of one are carried."""
    parts = [f"{name}0 AS (SELECT {of}, CAST(row_number() OVER w - 1 AS BIGINT) AS idx, count(*) OVER (PARTITION BY g) AS n FROM {first} WINDOW w AS (PARTITION BY g ORDER BY o NULLS FIRST, digest))"]
    for h in range(heights):
        side = f"string_agg(digest, '') OVER (PARTITION BY g, idx // 8 ORDER BY idx ROWS BETWEEN {{}})"
        parts.append(
            f"{name}{h}s AS (SELECT g, idx, n, coalesce({side.format('UNBOUNDED PRECEDING AND 1 PRECEDING')}, '') AS before, "
            f"coalesce({side.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')}, '') AS after FROM {name}{h})"
        )
        parts.append(
            f"{name}{h + 1} AS (SELECT g, idx // 8 AS idx, (any_value(n) + 7) // 8 AS n, CASE WHEN any_value(n) > 1 "
            f"THEN sha256(string_agg(digest, '' ORDER BY idx)) ELSE any_value(digest) END AS digest FROM {name}{h} GROUP BY g, idx // 8)"
        )
    return ",\n".join(parts)


def merkle(heights: int = 7, top: int = 3) -> str:
    """Trees, siblings and folded roots, height by height; enough for 8 ** heights documents of a language, 8 ** top languages."""
    walk: list[str] = []
    for name, levels in (("a", heights), ("b", top)):
        for h in range(levels):
            last, s = f"w{len(walk)}", f"{name}{h}s"
            at = f"(rank >> {3 * h})" if name == "a" else f"(place >> {3 * h})"
            key = "w.g" if name == "a" else "0"
            walk.append(
                f"w{len(walk) + 1} AS (SELECT w.* REPLACE (CASE WHEN s.n > 1 THEN sha256(s.before || w.fold || s.after) ELSE w.fold END AS fold, "
                f"CASE WHEN s.n > 1 THEN w.proof || s.before || s.after ELSE w.proof END AS proof) FROM {last} w JOIN {s} s ON s.g = {key} AND s.idx = {at})"
            )
    crc = CRC32.format("CAST(doc_id AS VARCHAR)")
    return f"""
WITH d AS (
  SELECT coalesce('=' || lang, '') AS g, doc_id AS o, doc_id, {_leaf("text")} AS digest,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents
), {_tree("g, doc_id, tampered, digest", "d", heights, "a")},
r AS (SELECT 0 AS g, g AS o, digest FROM a{heights}),
{_tree("g, o, digest", "r", top, "b")},
w0 AS (SELECT a0.g, a0.doc_id, a0.digest AS leaf, a0.idx AS rank, b0.idx AS place, b0.digest AS subroot, coalesce(a0.tampered, a0.digest) AS fold, '' AS proof
  FROM a0 JOIN b0 ON a0.g = b0.o),
{", ".join(walk)}
SELECT doc_id, leaf, subroot, root.digest AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root.digest AS verified
FROM w{len(walk)}, b{top} AS root
"""


#: All scores of anchors with all other rows, positives by rank, then negatives inside each positive's window.
NEGATIVES = """
WITH u AS (
  SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL
), bad AS (SELECT DISTINCT vec_id FROM u WHERE x IS NULL OR NOT isfinite(x)
), v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x
  FROM u WHERE vec_id NOT IN (SELECT vec_id FROM bad)
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, any_value(a.label = c.label) AS same, CAST(sum(a.x * c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.i = c.i AND a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0 GROUP BY a.vec_id, c.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 10
"""
