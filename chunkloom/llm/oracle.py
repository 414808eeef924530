"""SQL restatements of the registered queries that SQL can express on whole tables.

None for token counts (a library defines them), the url and toxicity models, the mix (one of many that
meet the targets), the suffix array and periodic runs (too slow in SQL byte by byte or period by period) and
fingerprints (not standard hashes): tests hold those against plain loops.
"""


def _components(pairs: str, nodes: str) -> str:
    """CTEs: ``both`` directions of pairs (a, b), ``reach`` (node, least node reachable)."""
    return f"""
both_ways AS (SELECT a, b FROM {pairs} UNION SELECT b, a FROM {pairs}),
reach(node, seen) AS (
  SELECT node, node FROM {nodes}
  UNION
  SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.seen
),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)"""


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(
    f"substr('{_ALPHABET}', 1 + ((('0x' || substr(sha, {5 * i + 1}, 5))::BIGINT >> {s}) & 31)::INT, 1)"
    for i in range(8)
    for s in (15, 10, 5, 0)
)


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_CRC32 = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda s, b: xor(s >> 8, list_reduce(
    list_prepend(xor(s, b) & 255, [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
    lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))))"""


def _levels(name: str, leaves: str) -> str:
    """A recursive CTE: nodes of all levels of trees whose leaves are rows (tree, place, d)."""
    return f"""
{name}(tree, lvl, place, d, n) AS (
  SELECT tree, 0, place, d, count(*) OVER (PARTITION BY tree) FROM {leaves}
  UNION ALL
  SELECT tree, lvl + 1, place // 2, sha256(string_agg(d, '' ORDER BY place)), (n + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY tree, lvl, place // 2, n
)"""


ORACLE: dict[str, str] = {
    "op1_warc": f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS sha,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p""",
    "op2_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
windows AS (
  SELECT doc_id, p, md5(array_to_string(w[p : p + 49], ' ')) AS hash
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)
),
repeated AS (
  SELECT doc_id, p FROM (SELECT *, min(doc_id) OVER (PARTITION BY hash) AS first_id FROM windows)
  WHERE doc_id > first_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM repeated),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
marked AS (
  SELECT word.doc_id, x, word.p, gone.p IS NOT NULL AS removed
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p
),
counted AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (removed) AS n_removed,
         string_agg(x, ' ' ORDER BY p) FILTER (NOT removed) AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN counted USING (doc_id)""",
    "op3_minhash": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM d WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
pairs AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)
),
nodes AS (SELECT doc_id AS node FROM documents),""" + _components("pairs", "nodes") + """
SELECT node AS doc_id, coalesce(n, 0) AS n_shingles, component_id, node = component_id AS kept
FROM least LEFT JOIN sizes ON node = doc_id""",
    "op4_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
good AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(e, e) > 0
),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9
),
nodes AS (SELECT vec_id AS node FROM embeddings),""" + _components("pairs", "nodes") + """,
links AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT node AS vec_id, coalesce(n, 0) AS n_links, component_id, node = component_id AS kept
FROM least LEFT JOIN links ON node = a""",
    "op5_decontamination": r"""
WITH d AS (
  SELECT doc_id AS id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
i AS (
  SELECT item_id AS id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
items AS (
  SELECT DISTINCT id, least(len(w), 13) AS n, array_to_string(w[p : p + 12], ' ') AS s
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM i WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM items),
found AS (
  SELECT x.id, x.p, items.n, items.id AS item
  FROM (
    SELECT d.id, n, unnest(range(1, len(w) - n + 2)) AS p, w FROM d JOIN lengths ON len(w) >= n
  ) x JOIN items ON items.n = x.n AND items.s = array_to_string(x.w[x.p : x.p + x.n - 1], ' ')
),
hit AS (SELECT id, count(DISTINCT q) AS n_hit FROM (SELECT id, unnest(range(p, p + n)) AS q FROM found) GROUP BY id),
by_item AS (SELECT DISTINCT id, item::VARCHAR AS item FROM found),
listed AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM by_item GROUP BY id)
SELECT d.id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (id) LEFT JOIN listed USING (id)""",
    "op13_merkle": f"""
WITH RECURSIVE base AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS d,
         CASE WHEN {_CRC32} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS claimed
  FROM documents
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS place FROM base
),{_levels("nodes", "leaves")},
heights AS (
  SELECT tree, lvl AS height, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM nodes WHERE n = 1
),
subroots AS (SELECT '' AS tree, place, subroot AS d FROM heights),{_levels("tops", "subroots")},
top AS (SELECT lvl AS height, d AS root FROM tops WHERE n = 1),
every AS (
  SELECT nodes.tree, lvl, place, d FROM nodes WHERE n > 1
  UNION ALL
  SELECT heights.tree, heights.height + lvl, tops.place, d FROM heights, tops
),
walk AS (
  SELECT doc_id, leaves.tree, d AS leaf, leaves.place AS leaf_place, subroot, height, heights.place AS top_place, 0 AS lvl,
         CASE WHEN height = 0 THEN heights.place ELSE leaves.place END AS place, claimed AS node, '' AS proof
  FROM leaves JOIN heights ON leaves.tree = heights.tree
  UNION ALL
  SELECT doc_id, walk.tree, leaf, leaf_place, subroot, walk.height, top_place, walk.lvl + 1,
         CASE WHEN walk.lvl + 1 = walk.height THEN top_place ELSE walk.place // 2 END,
         CASE WHEN walk.place % 2 = 0 THEN sha256(node || coalesce(d, '')) ELSE sha256(d || node) END,
         proof || coalesce(d, '')
  FROM walk JOIN top ON walk.lvl < walk.height + top.height
  LEFT JOIN every ON every.tree = walk.tree AND every.lvl = walk.lvl AND every.place = xor(walk.place, 1)
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM walk JOIN top ON walk.lvl = walk.height + top.height""",
}
