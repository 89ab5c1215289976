"""DuckDB SQL of the operators that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD_GROUPS = rf"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
size AS (SELECT doc_id, len(s) AS n, md5(array_to_string(list_sort(s), chr(10))) AS h FROM sets),
rep AS (SELECT n, h, min(doc_id) AS rid FROM size WHERE n > 0 GROUP BY n, h),
sh AS (SELECT r.rid, r.n, unnest(s.s) AS g FROM rep r JOIN sets s ON s.doc_id = r.rid),
pairs AS (SELECT a.rid AS a, b.rid AS b FROM sh a JOIN sh b ON a.g = b.g AND a.rid < b.rid AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
sym AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs), reach(node, other) AS (SELECT a, b FROM sym UNION SELECT r.node, e.b FROM reach r JOIN sym e ON e.a = r.other),
low AS (SELECT node, min(other) AS low FROM reach GROUP BY node)
SELECT z.doc_id, z.n AS n_shingles, CASE WHEN z.n = 0 THEN z.doc_id ELSE least(r.rid, coalesce(l.low, r.rid)) END AS component_id FROM size z LEFT JOIN rep r ON r.n = z.n AND r.h = z.h LEFT JOIN low l ON l.node = r.rid
"""

def groups(k: int, percent: int) -> str:
    """Links of shingle sets of k words by all shared shingles, and their components."""
    return rf"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i : i + {k - 1}], ' '))) END AS s FROM words),
size AS (SELECT doc_id, len(s) AS n, md5(array_to_string(list_sort(s), chr(10))) AS h FROM sets),
rep AS (SELECT n, h, min(doc_id) AS rid FROM size WHERE n > 0 GROUP BY n, h),
sh AS (SELECT r.rid, r.n, unnest(s.s) AS g FROM rep r JOIN sets s ON s.doc_id = r.rid),
pairs AS (SELECT a.rid AS a, b.rid AS b FROM sh a JOIN sh b ON a.g = b.g AND a.rid < b.rid AND 100 * a.n >= {percent} * b.n AND 100 * b.n >= {percent} * a.n GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
sym AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs), reach(node, other) AS (SELECT a, b FROM sym UNION SELECT r.node, e.b FROM reach r JOIN sym e ON e.a = r.other),
low AS (SELECT node, min(other) AS low FROM reach GROUP BY node)
SELECT z.doc_id, z.n AS n_shingles, CASE WHEN z.n = 0 THEN z.doc_id ELSE least(r.rid, coalesce(l.low, r.rid)) END AS component_id FROM size z LEFT JOIN rep r ON r.n = z.n AND r.h = z.h LEFT JOIN low l ON l.node = r.rid
"""


SUFFIX_DEDUP = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
part AS (SELECT doc_id, c * 128 AS base, substr(x, 256 * c + 1, 354) AS y FROM (SELECT doc_id, x, unnest(range((length(x) // 2 - 50) // 128 + 1)) AS c FROM t WHERE length(x) >= 100)),
w AS (SELECT doc_id, base, unnest(range(least(128, length(y) // 2 - 49))) AS i, y FROM part),
win AS (SELECT doc_id, base + i AS p, md5_number(substr(y, 2 * i + 1, 100)) AS h FROM w),
least AS (SELECT h, min(doc_id) AS d FROM win GROUP BY h),
gone AS (SELECT win.doc_id, win.p FROM win JOIN least ON least.h = win.h AND least.d < win.doc_id),
step AS (SELECT doc_id, p, CASE WHEN p - 50 <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) THEN 0 ELSE 1 END AS new FROM gone),
span AS (SELECT doc_id, min(p) AS s, max(p) + 50 AS e FROM (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM step) GROUP BY doc_id, k),
keep AS (SELECT t.doc_id, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS kept FROM (
  SELECT doc_id, e AS a, coalesce(lead(s) OVER (PARTITION BY doc_id ORDER BY s), 1000000000) AS b FROM span UNION ALL SELECT doc_id, 0, min(s) FROM span GROUP BY doc_id) g JOIN t ON t.doc_id = g.doc_id GROUP BY t.doc_id),
n AS (SELECT doc_id, sum(e - s) AS removed, count(*) AS spans FROM span GROUP BY doc_id)
SELECT t.doc_id, length(x) // 2 AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(CASE WHEN n.doc_id IS NULL THEN x ELSE coalesce(kept, '') END)) AS kept_sha256
FROM t LEFT JOIN n ON n.doc_id = t.doc_id LEFT JOIN keep k ON k.doc_id = t.doc_id
"""


def crc32(decimal: str) -> str:
    """SQL of the unsigned CRC-32 of a text of ASCII characters: a bit at a time over its characters, each followed by seven marks."""
    bits = f"list_concat([4294967295::UBIGINT], flatten(list_transform(string_split({decimal}, ''), lambda ch: list_concat([ascii(ch)::UBIGINT], repeat([256::UBIGINT], 7)))))"
    step = "lambda c, v: xor(xor(c, v % 256) >> 1, (xor(c, v % 256) & 1) * 3988292384::UBIGINT)"
    return f"xor(list_reduce({bits}, {step}), 4294967295::UBIGINT)"


def _merkle() -> str:
    """The trees, level by level: as many levels as ten documents to the power of eight need, a tree of one node stays as it is."""
    height = 9
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    row = lambda text: "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"
    out = [f"""leaves AS MATERIALIZED (SELECT doc_id, lang, {row('text')} AS leaf, CASE WHEN {crc32('doc_id::VARCHAR')} % 3 = 0 THEN {row(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {row('text')} END AS told FROM documents),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM (SELECT DISTINCT lang FROM leaves)),
placed AS MATERIALIZED (SELECT doc_id, t, leaf, told, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaves l JOIN langs g ON l.lang IS NOT DISTINCT FROM g.lang)"""]

    def climb(name: str, first: str) -> None:
        out.append(f"{name}0 AS MATERIALIZED ({first})")
        for i in range(height):
            out.append(f"{name}{i + 1} AS MATERIALIZED (SELECT t, p // 8 AS p, CASE WHEN any_value(n) = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY p)) END AS node, (any_value(n) + 7) // 8 AS n FROM {name}{i} GROUP BY t, p // 8)")

    climb("a", "SELECT t, p, leaf AS node, count(*) OVER (PARTITION BY t) AS n FROM placed")
    climb("b", f"SELECT 0 AS t, t AS p, node, (SELECT count(*) FROM langs) AS n FROM a{height}")
    last = "SELECT doc_id, t, p, t AS t2, leaf, told AS now, '' AS proof FROM placed"
    k = 0
    for name, tree, place in (("a", "f.t", "f.p"), ("b", "0", "f.t2")):
        for i in range(height):
            at = f"({place} // {8**i})"
            side = lambda test: f"coalesce((SELECT string_agg(x.node, '' ORDER BY x.p) FROM {name}{i} x WHERE x.t = {tree} AND x.p // 8 = {at} // 8 AND x.p {test} {at}), '')"  # noqa: E731,B023
            out.append(f"s{k} AS MATERIALIZED (SELECT f.*, {side('<')} AS l, {side('>')} AS r, (SELECT any_value(x.n) FROM {name}{i} x WHERE x.t = {tree}) AS n FROM ({last}) f)")
            last = f"SELECT doc_id, t, p, t2, leaf, CASE WHEN n = 1 THEN now ELSE sha256(l || now || r) END AS now, proof || l || r AS proof FROM s{k}"
            k += 1
    return "WITH " + ",\n".join(out) + f"\nSELECT doc_id, leaf, a.node AS subroot, b.node AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = b.node AS verified FROM ({last}) f JOIN a{height} a ON a.t = f.t CROSS JOIN b{height} b"


MERKLE_MANIFEST = _merkle()

PREFIX_TRIE = f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'k': strlen(r) || ':' || r || strlen(t) || ':' || t, 'c': length(t)}} ORDER BY turn NULLS FIRST, r, t) AS xs FROM turns GROUP BY conv_id),
head AS (SELECT conv_id, CAST({crc32('conv_id::VARCHAR')} % 6 AS INTEGER) AS h, conv_id - conv_id % 100 AS b, xs FROM own),
built AS (SELECT h.conv_id, list_concat(coalesce(o.xs, [])[1:h.h], h.xs[h.h + 1:]) AS xs FROM head h LEFT JOIN own o ON o.conv_id = h.b),
begin AS (SELECT conv_id, xs, len(xs) AS n, unnest(range(len(xs) + 1)) AS d FROM built),
held AS MATERIALIZED (SELECT conv_id, n, d, CASE WHEN d > 0 THEN xs[d].c ELSE 0 END AS c, sha256(array_to_string(list_transform(xs[1:d], lambda x: x.k), '')) AS k, sha256(array_to_string(list_transform(xs[1:d - 1], lambda x: x.k), '')) AS up FROM begin),
node AS MATERIALIZED (SELECT d, k, any_value(up) AS up, any_value(c) AS c, min(conv_id) AS conv_id, count(*) AS m, sha256(coalesce(string_agg(CASE WHEN n = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends FROM held GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY d, up),
full_ AS MATERIALIZED (SELECT n.*, coalesce(s.n, 0) AS kids FROM node n LEFT JOIN kids s ON s.d = n.d AND s.k = n.k),
below AS (SELECT h.d, h.k, sum((f.m - 1) * f.c) AS saved, sum((f.kids = 0)::INT) AS leaves FROM full_ f JOIN held h ON h.conv_id = f.conv_id AND h.d <= f.d GROUP BY h.d, h.k)
SELECT f.d::INT AS depth, f.conv_id, p.conv_id AS parent_conv_id, f.m AS n_convs, f.kids AS n_children, b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
FROM full_ f JOIN below b ON b.d = f.d AND b.k = f.k LEFT JOIN node p ON f.d > 0 AND p.d = f.d - 1 AND p.k = f.up
"""
