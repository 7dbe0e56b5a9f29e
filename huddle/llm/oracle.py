"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_H60 = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"


def _tree_level(k: int) -> str:
    """A level of the splitting tree: a node's draws in seeded order, the first ones go to the left half of its shards."""
    h = _H60.format(f"concat_ws('|', '23', 'tree', '{k}', src, CAST(i AS VARCHAR))")
    return f"""
r{k} AS (SELECT *, (lo + hi) // 2 AS mid, row_number() OVER (PARTITION BY lo ORDER BY {h}, src, i) - 1 AS rk FROM n{k}),
n{k + 1} AS (SELECT src, i, total, CASE WHEN rk < mid * total // 16 - lo * total // 16 THEN lo ELSE mid END AS lo,
         CASE WHEN rk < mid * total // 16 - lo * total // 16 THEN mid ELSE hi END AS hi FROM r{k}),"""


MIX = rf"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '~null') AS src,
         {_H60.format("concat_ws('|', '23', coalesce(CAST(doc_id AS VARCHAR), '~null' || md5(coalesce(text, ''))))")} % 4096 AS block,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s0 AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY src),
s1 AS (SELECT *, [5, 2, 1][1 + CAST((row_number() OVER (ORDER BY src = '~null', src) - 1) % 3 AS INT)] AS w FROM s0),
s2 AS (SELECT *, source_size * 3 AS cap, sum(source_size) OVER () AS t, sum(w) OVER () AS tw,
         coalesce(sum(source_size * 3) OVER o, 0) AS c0, coalesce(sum(w) OVER o, 0) AS w0
       FROM s1 WINDOW o AS (ORDER BY source_size / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, CAST(cap AS DOUBLE) * CAST(tw - w0 AS DOUBLE) <= CAST(t - c0 AS DOUBLE) * w AS capped FROM s2),
s AS (SELECT src, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE)
        ELSE CAST(t - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS DOUBLE) * w
             / CAST(sum(CASE WHEN capped THEN 0 ELSE w END) OVER () AS DOUBLE) END AS target FROM s3),
b0 AS (SELECT src, block, sum(size) AS words FROM d GROUP BY src, block),
b1 AS (SELECT b0.*, s.source_size, s.target,
         row_number() OVER (PARTITION BY src ORDER BY {_H60.format("concat_ws('|', '23', 'block', src, CAST(block AS VARCHAR))")}, block) - 1 AS perm,
         sum(words) OVER (PARTITION BY src ORDER BY {_H60.format("concat_ws('|', '23', 'block', src, CAST(block AS VARCHAR))")}, block
                          ROWS UNBOUNDED PRECEDING) AS upto
       FROM b0 JOIN s USING (src)),
b2 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM b1),
b3 AS (SELECT *, target - passes * source_size AS rest, upto <= target - passes * source_size AND target > passes * source_size AS fits FROM b2),
b4 AS (SELECT *, rest - coalesce(max(CASE WHEN fits THEN upto END) OVER (PARTITION BY src), 0) AS remaining FROM b3),
b5 AS (SELECT *, row_number() OVER (PARTITION BY src, fits ORDER BY abs(remaining - words), upto,
         {_H60.format("concat_ws('|', '23', 'block', src, CAST(block AS VARCHAR))")}, block) AS nearest FROM b4),
b AS (SELECT *, CASE WHEN fits OR (nearest = 1 AND abs(remaining - words) < remaining) THEN 1 ELSE 0 END AS again FROM b5),
draws AS (SELECT src, block, perm, unnest(range(1, CAST(passes + again AS BIGINT) + 1)) AS pass FROM b),
nth AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY pass, perm) - 1 AS i FROM draws),
n0 AS (SELECT src, i, count(*) OVER () AS total, CAST(0 AS BIGINT) AS lo, CAST(16 AS BIGINT) AS hi FROM nth),{"".join(map(_tree_level, range(4)))}
runs AS (SELECT src, lo AS shard, count(*) AS n, sum(count(*)) OVER (PARTITION BY src ORDER BY lo) AS upto FROM n4 GROUP BY src, lo),
shards AS (SELECT nth.src, block, string_agg(CAST(shard AS VARCHAR), ',' ORDER BY pass) AS shards
           FROM nth JOIN runs ON runs.src = nth.src AND i < upto AND i >= upto - n GROUP BY nth.src, block)
SELECT d.doc_id, d.size, b.source_size, b.target, CAST(d.size * (b.passes + b.again) AS BIGINT) AS taken, coalesce(shards.shards, '') AS shards
FROM d JOIN b USING (src, block) LEFT JOIN shards USING (src, block)
"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DEDUP = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
        ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g
      FROM d),
n AS (SELECT r, doc_id, len(g) AS n FROM s),
e AS (SELECT r, unnest(g) AS g FROM s),
common AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
link AS (SELECT x, y FROM common JOIN n nx ON nx.r = x JOIN n ny ON ny.r = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
reach AS (SELECT r AS x, r AS y FROM n UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, c.component_id, n.doc_id IS NOT DISTINCT FROM c.component_id AS kept
FROM n JOIN (SELECT reach.x, min(n.doc_id) AS component_id FROM reach JOIN n ON n.r = reach.y GROUP BY reach.x) c ON c.x = n.r
"""

DECONTAMINATE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
iw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, k, array_to_string(w[p:p + k - 1], ' ') AS win FROM (
         SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p
         FROM i WHERE len(w) > 0)),
dw AS (SELECT r, k, p, array_to_string(w[p:p + k - 1], ' ') AS win FROM (
         SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d JOIN (SELECT DISTINCT k FROM iw) ON len(w) >= k)),
hit AS (SELECT r, p, dw.k, item FROM dw JOIN iw ON dw.win = iw.win AND dw.k = iw.k),
words AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + k)) AS q FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS t FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.t, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.r = d.r LEFT JOIN items ON items.r = d.r
"""

# CRC-32 by its rule: a table of 256 remainders, then one step per byte
_CRC_TABLE = ("list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), "
              "lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))")

SHARD = rf"""
WITH t AS (SELECT {_CRC_TABLE} AS crc),
d AS (
  SELECT doc_id, coalesce('=' || source, '~null') AS src, strlen(coalesce(text, '')) + 16 AS size, hex(coalesce(text, '')) AS x,
         {_H60.format("concat_ws('|', '17', coalesce(CAST(doc_id AS VARCHAR), '~null' || md5(coalesce(text, ''))))")} AS h FROM documents),
c AS (SELECT doc_id, src, size, h, xor(list_reduce(list_concat([4294967295], list_transform(range(0, CAST(len(x) / 2 AS BIGINT)),
           lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
           lambda a, b: xor(a >> 8, t.crc[xor(a, b) % 256 + 1])), 4294967295) AS text_crc32 FROM d, t),
f AS (SELECT *, (row_number() OVER (PARTITION BY src ORDER BY h, doc_id NULLS FIRST, text_crc32, size) - 1 + 0.5::DOUBLE)
         / count(*) OVER (PARTITION BY src) AS f FROM c),
p AS (SELECT *, row_number() OVER (ORDER BY f, src, h, doc_id NULLS FIRST, text_crc32, size) - 1 AS pos, count(*) OVER () AS n FROM f),
s AS (SELECT *, pos * 40 // n AS shard FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(pos - (shard * n + 39) // 40 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s
"""

def _field(c: str) -> str:
    return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"


_LEAF = "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "{text}"))) + ")"
_CRC_OF = ("xor(list_reduce(list_concat([4294967295], list_transform(range(0, CAST(strlen({x}) / 2 AS BIGINT)), "
           "lambda i: CAST('0x' || substr({x}, 2 * i + 1, 2) AS BIGINT))), "
           "lambda a, b: xor(a >> 8, t.crc[xor(a, b) % 256 + 1])), 4294967295)")
_RUN = "array_to_string({nodes}[{at} // 3 * 3 + 1:{at} // 3 * 3 + {upto}], '')"

# a level is one list; the siblings of a leaf are read off the lists of all levels of its tree
MERKLE = rf"""
WITH RECURSIVE t AS (SELECT {_CRC_TABLE} AS crc),
d AS (SELECT row_number() OVER () AS r, doc_id, source, {_LEAF.format(text="text")} AS leaf,
             CASE WHEN {_CRC_OF.format(x="hex(CAST(doc_id AS VARCHAR))")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS bent_text,
             lang, n_chars FROM documents, t),
b AS (SELECT *, {_LEAF.format(text="bent_text")} AS bent, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nth FROM d),
lists AS (SELECT source, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                 list(leaf ORDER BY doc_id NULLS FIRST, leaf) AS nodes FROM b GROUP BY source),
low(tree, level, nodes) AS (
  SELECT tree, 0, nodes FROM lists UNION ALL
  SELECT tree, level + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], '')))
  FROM low WHERE len(nodes) > 1),
subroots AS (SELECT tree, nodes[1] AS subroot FROM low WHERE len(nodes) = 1),
high(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY tree) FROM subroots UNION ALL
  SELECT level + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], '')))
  FROM high WHERE len(nodes) > 1),
steps AS (
  SELECT r, level, nth // CAST(pow(3, level) AS BIGINT) AS nth, low.nodes FROM b JOIN lists ON b.source IS NOT DISTINCT FROM lists.source
    JOIN low USING (tree) WHERE len(low.nodes) > 1 UNION ALL
  SELECT r, 100 + level, tree // CAST(pow(3, level) AS BIGINT), high.nodes FROM b JOIN lists ON b.source IS NOT DISTINCT FROM lists.source, high
    WHERE len(high.nodes) > 1),
sides AS (SELECT r, level, {_RUN.format(nodes="nodes", at="nth", upto="nth % 3")} AS before,
                 array_to_string(nodes[nth + 2:nth // 3 * 3 + 3], '') AS after FROM steps),
paths AS (SELECT r, string_agg(before || after, '' ORDER BY level) AS proof, list(before || '|' || after ORDER BY level) AS path
          FROM sides GROUP BY r),
out AS (
  SELECT doc_id, b.source, leaf, subroot, (SELECT nodes[1] FROM high WHERE len(nodes) = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce(list_concat([bent], coalesce(path, [])),
                     lambda acc, s: sha256(split_part(s, '|', 1) || acc || split_part(s, '|', 2))) AS folded_root, nth AS position
  FROM b JOIN lists ON b.source IS NOT DISTINCT FROM lists.source JOIN subroots USING (tree) LEFT JOIN paths USING (r))
SELECT *, folded_root = root AS verified FROM out
"""

# near words by their spellings with one letter left out: alike at one place, or one the other's
VARIANTS = rf"""
WITH RECURSIVE t AS (SELECT {_CRC_TABLE} AS crc),
occ AS (SELECT doc_id, run, count(*) AS n FROM (
          SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[a-zÀ-ÿ]+')) AS run FROM documents) GROUP BY doc_id, run),
h AS (SELECT run, n, {_CRC_OF.format(x="hex(CAST(doc_id AS VARCHAR) || ':' || run)")} AS h FROM occ, t WHERE length(run) >= 5),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h)
      WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM (
          SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM w)),
near AS (SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
         UNION SELECT c.word, w.word, w.n FROM cut c JOIN w ON c.rest = w.word
         UNION SELECT w.word, c.word, c.n FROM cut c JOIN w ON c.rest = w.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
             CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n FROM w LEFT JOIN best USING (word)),
chain(word, last) AS (SELECT word, word FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.last WHERE f.form IS NOT NULL)
SELECT f.word, f.form, chain.last AS root, f.n, f.n_near, f.form_n
FROM f JOIN chain USING (word) JOIN f e ON e.word = chain.last AND e.form IS NULL
"""

ORACLES = {"op2_min_max_dedup": DEDUP, "op5_mix_sources": MIX, "op6_winnowing": DECONTAMINATE, "op7_stratified_shards": SHARD,
           "op12_spelling_variants": VARIANTS, "op13_merkle_manifest": MERKLE}
