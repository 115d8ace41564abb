"""The same results in DuckDB SQL, for the operators that it can express."""

WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Smallest key reachable over undirected links ``links(a, b)`` between the keys of ``nodes(k)``.
COMPONENTS = """reach AS (SELECT k, k AS other FROM nodes UNION SELECT r.k, l.b FROM reach r JOIN both_ways l ON l.a = r.other),
 component AS (SELECT k, min(other) AS component_id FROM reach GROUP BY k)"""

SUBSTRING_DEDUP = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS.format('text')} AS ws FROM documents),
 w AS (SELECT r, i, array_to_string(ws[i : i + 34], ' ') AS s FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35)),
 again AS (SELECT s FROM w GROUP BY s HAVING count(*) > 1),
 gone AS (SELECT DISTINCT r, i + k AS i FROM (SELECT r, i, unnest(range(0, 35)) AS k FROM w JOIN again USING (s))),
 words AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
 kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (r, i) GROUP BY r),
 n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
 SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
 FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)"""

VECTORS = f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
 usable AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len([x for x in e if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in e if x <> 0]) > 0),
 both_ways AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
 nodes AS (SELECT vec_id AS k FROM v), {COMPONENTS}, n AS (SELECT a AS k, count(*) AS n FROM both_ways GROUP BY a)
 SELECT k AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, k = component_id AS kept FROM component LEFT JOIN n USING (k)"""

NEAR_DEDUP = f"""WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWER)} AS ws FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 3], ' ') AS x FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM d WHERE len(ws) > 0)),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
 both_ways AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
 nodes AS (SELECT doc_id AS k FROM d), {COMPONENTS}
 SELECT k AS doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, k = component_id AS kept FROM component LEFT JOIN n ON n.doc_id = k"""

#: crc32 (unsigned) of an ASCII string, bit by bit.
CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({}, ''), lambda x: [ord(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
 lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"""


def _factors(levels: int) -> str:
    """Names of the factors of 1, 2, 4, ... words that come again in their text, and the stretches of progressions among them."""
    out = ["f0 AS MATERIALIZED (SELECT r, i, dense_rank() OVER (ORDER BY r, w) AS x FROM words QUALIFY count(*) OVER (PARTITION BY r, w) > 1)"]
    for k in range(1, levels):
        pair = f"SELECT a.r, a.i, a.x AS y, b.x AS z FROM f{k - 1} a JOIN f{k - 1} b ON a.r = b.r AND b.i = a.i + {1 << (k - 1)}"
        out.append(f"f{k} AS MATERIALIZED (SELECT r, i, dense_rank() OVER (ORDER BY r, y, z) AS x FROM ({pair}) QUALIFY count(*) OVER (PARTITION BY r, y, z) > 1)")
    steps = [f"SELECT r, i, {1 << k} AS l, lead(i) OVER o - i AS d, lead(i, 2) OVER o - lead(i) OVER o AS e FROM f{k} WINDOW o AS (PARTITION BY r, x ORDER BY i)" for k in range(levels)]
    out.append("steps AS (" + " UNION ALL ".join(steps) + ")")
    island = "SELECT r, l, d, i, i - row_number() OVER (PARTITION BY r, l, d ORDER BY i) AS g FROM steps WHERE d = e AND d <= l"
    out.append(f"proposed AS (SELECT DISTINCT r, min(i) AS start, max(i) + 2 * d + l AS stop, d FROM ({island}) GROUP BY r, l, d, g)")
    return ",\n ".join(out)


#: For texts of fewer than 131,072 words.
PERIODIC_RUNS = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS.format('text')} AS ws, {CRC32.format('CAST(doc_id AS VARCHAR)')} AS h FROM documents),
 n AS (SELECT r, doc_id, ws, h, len(ws) AS n, h // 10 AS g FROM d),
 s AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM n),
 p AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - a) // (3 + g % 8) ELSE 1 END AS p FROM s),
 words AS MATERIALIZED (SELECT r, i, CASE WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % p + 1] END AS w FROM (SELECT *, unnest(range(0, n)) AS i FROM p)),
 {_factors(16)},
 runs AS (SELECT r, start, stop - start AS length, d AS period FROM proposed WHERE stop - start >= greatest(6, 4 * d)),
 best AS (SELECT r, start, length, period FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length DESC, start, period) = 1),
 listed AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t FROM runs GROUP BY r),
 gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
 kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
 SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period,
  CAST(1000 * length // period AS BIGINT) AS exponent_milli, sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
 FROM d LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)"""

TEST_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
CONTAMINATION = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TEST_WORDS.format(LOWER)} AS ws FROM documents),
 t AS (SELECT item_id, {TEST_WORDS.format(LOWER)} AS ws FROM benchmark),
 m AS (SELECT item_id, ws, least(10, len(ws)) AS m FROM t WHERE len(ws) > 0),
 windows AS (SELECT DISTINCT item_id, m, array_to_string(ws[i : i + m - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(ws) - m + 2)) AS i FROM m)),
 places AS (SELECT r, m, i, array_to_string(ws[i : i + m - 1], ' ') AS s FROM (SELECT r, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM m))),
 found AS (SELECT r, p.m, i, item_id FROM places p JOIN windows USING (m, s)),
 hit AS (SELECT r, count(DISTINCT i) AS n FROM (SELECT r, unnest(range(i, i + m)) AS i FROM (SELECT DISTINCT r, m, i FROM found)) GROUP BY r),
 items AS (SELECT r, count(*) AS n, string_agg(k, ',' ORDER BY k) AS t FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS k FROM found WHERE item_id IS NOT NULL) GROUP BY r)
 SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(t, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)"""


def _leaf(text: str) -> str:
    fields = [*[f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")], text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def _tree(name: str, leaves: str) -> str:
    """Nodes of the trees of ``leaves(tree, place, digest, n)`` level by level, and their groups of siblings."""
    up = "SELECT tree, level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (n + 7) // 8 FROM {0} WHERE n > 1 GROUP BY tree, level, place // 8, n"
    return f"""{name} AS (SELECT tree, 0 AS level, place, digest, n FROM {leaves} UNION ALL {up.format(name)}),
 {name}_groups AS MATERIALIZED (SELECT tree, level, place // 8 AS up, array_agg(digest ORDER BY place) AS nodes FROM {name} WHERE n > 1 GROUP BY ALL)"""


_FOLD = """{name} AS (SELECT r, tree, 0 AS level, place, digest, CAST([] AS VARCHAR[]) AS proof FROM {start}
 UNION ALL SELECT r, tree, f.level + 1, place // 8, sha256(array_to_string(list_concat(nodes[1 : place % 8], [digest], nodes[place % 8 + 2 :]), '')),
  list_concat(proof, nodes[1 : place % 8], nodes[place % 8 + 2 :]) FROM {name} f JOIN {groups} g USING (tree, level) WHERE g.up = f.place // 8),
 {name}_end AS (SELECT r, digest, proof FROM {name} QUALIFY row_number() OVER (PARTITION BY r ORDER BY level DESC) = 1)"""

MANIFEST = f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, lang, {_leaf('text')} AS leaf,
  CASE WHEN {CRC32.format('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {_leaf(LOWER)} END AS altered FROM documents),
 leaves AS MATERIALIZED (SELECT r, doc_id, coalesce(':' || lang, '-') AS tree, leaf AS digest, coalesce(altered, leaf) AS shown, count(*) OVER (PARTITION BY lang) AS n,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM d),
 {_tree('trees', 'leaves')},
 subroots AS (SELECT '*' AS tree, tree AS of_tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM trees WHERE n = 1),
 {_tree('top', 'subroots')},
 {_FOLD.format(name='near', start='(SELECT r, tree, place, shown AS digest FROM leaves)', groups='trees_groups')},
 above AS (SELECT near_end.r, '*' AS tree, s.place, near_end.digest, s.digest AS subroot, near_end.proof AS first FROM near_end JOIN leaves USING (r) JOIN subroots s ON s.of_tree = leaves.tree),
 {_FOLD.format(name='far', start='above', groups='top_groups')}
 SELECT doc_id, leaves.digest AS leaf, subroot, root, sha256(array_to_string(list_concat(first, far_end.proof), '')) AS proof_sha256,
  far_end.digest AS folded_root, far_end.digest = root AS verified
 FROM leaves JOIN above USING (r) JOIN far_end USING (r), (SELECT digest AS root FROM top WHERE n = 1)"""
