"""DuckDB SQL for the registered text queries that SQL can express, over the whole tables."""

from __future__ import annotations

from quayside.llm.licenses import RULES, SENTENCES

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

URL_FILTER = f"""WITH parts AS (SELECT page_id, coalesce({_FOLD.format("regexp_extract(url, '(?s)://([^/?#]*)', 1)")}, '') AS host,
  coalesce(regexp_extract(url, '(?s)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM parts JOIN rules
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN host LIKE '%free-bets%' OR host LIKE '%casino%' OR path LIKE '%/login%' OR path LIKE '%.exe%'
  THEN 'block' ELSE 'allow' END) AS verdict FROM parts LEFT JOIN best USING (page_id)"""

NGRAM_JOIN = f"""WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_FOLD.format("coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS sh FROM d, unnest(range(1, greatest(len(w) - 3, 2))) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM pair JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.y FROM reach r JOIN both_ways l ON r.b = l.x),
least_one AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM d LEFT JOIN n USING (doc_id) JOIN least_one ON a = d.doc_id"""

DECONTAMINATION = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_ALNUM.format(_FOLD.format("coalesce(text, '')"))} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM.format(_FOLD.format("text"))} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM d, sizes, unnest(range(1, len(w) - n + 2)) t(i)),
hit AS (SELECT rid, i, n, item_id FROM dw JOIN bw USING (n, s)),
pos AS (SELECT rid, count(DISTINCT p) AS c FROM hit, unnest(range(i, i + n)) t(p) GROUP BY rid),
names AS (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit),
its AS (SELECT rid, count(*) AS k, sha256(string_agg(item, ',' ORDER BY item)) AS h FROM names GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(c, 0) AS n_hit, coalesce(k, 0) AS n_items, coalesce(h, sha256('')) AS items_sha256,
  coalesce(c, 0) > 0 AS contaminated FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)"""

SUBSTRING_DEDUP = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT rid, doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM d, unnest(range(1, len(w) - 48)) t(i)),
earliest AS (SELECT s, min(doc_id) AS f FROM win GROUP BY s),
hit AS (SELECT DISTINCT rid, p FROM win JOIN earliest USING (s), unnest(range(i, i + 50)) t(p) WHERE f < doc_id),
gone AS (SELECT rid, count(*) AS c FROM hit GROUP BY rid),
each_word AS (SELECT rid, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) t(p)),
kept AS (SELECT rid, string_agg(x, ' ' ORDER BY p) AS t FROM each_word ANTI JOIN hit USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(c, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (rid) LEFT JOIN kept USING (rid)"""

SOURCE_MIXING = f"""WITH sized AS (SELECT doc_id, source, CAST(len({_WORDS.format("coalesce(text, '')")}) AS BIGINT) AS size FROM documents),
rated AS (SELECT doc_id AS rated_id, 0.25 + avg(CAST(quality AS DOUBLE)) * (1.0 - 0.25) AS weight FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
keyed AS (SELECT doc_id, source, size, -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE))
  / CAST(4503599627370496 AS DOUBLE)) / coalesce(weight, 0.5) AS k FROM sized LEFT JOIN rated ON doc_id = rated_id),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM keyed GROUP BY source),
weighed AS (SELECT source, s, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w FROM sizes),
levels AS (SELECT *, 3 * s / w AS r, ((SELECT sum(s) FROM sizes) - coalesce(sum(3 * s) OVER (ORDER BY 3 * s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(w) OVER (ORDER BY 3 * s / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
held AS (SELECT source, s, least(CAST(3 * s AS DOUBLE), coalesce((SELECT min_by(level, r) FROM levels WHERE r > level), 0) * w) AS target FROM levels),
plan AS (SELECT *, CASE WHEN s > 0 THEN least(floor(target / s), 3) ELSE 0 END AS epochs FROM held),
line AS (SELECT doc_id, size, s, target, epochs, round(target - epochs * s) AS rest,
  coalesce(sum(size) OVER (PARTITION BY keyed.source ORDER BY k, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed JOIN plan ON keyed.source IS NOT DISTINCT FROM plan.source)
SELECT doc_id, size, s AS source_size, target, CAST(epochs * size + least(greatest(rest - before, 0), size) AS BIGINT) AS taken FROM line"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
_LEAF = "sha256({})".format(" || ".join("{" + c + "}" for c in ("doc_id", "source", "lang", "n_chars", "text")))


def _leaf(**other: str) -> str:
    return _LEAF.format(**{c: _FIELD.format(other.get(c, c)) for c in ("doc_id", "source", "lang", "n_chars", "text")})


def _tree(name: str, leaves: str, start: str) -> str:
    """Recursive parts: all nodes over ``leaves`` (tree, idx, h), and a walk of ``start`` (rid, tree, idx, sib, fold) to the top."""
    return f"""{name}_nodes(tree, lvl, idx, n, h) AS (SELECT tree, 0, idx, count(*) OVER (PARTITION BY tree), h FROM {leaves}
  UNION ALL SELECT tree, lvl + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM {name}_nodes WHERE n > 1 GROUP BY tree, lvl, idx // 2),
{name}_walk(rid, tree, lvl, idx, sib, fold) AS (SELECT rid, tree, 0, idx, sib, fold FROM {start}
  UNION ALL SELECT w.rid, w.tree, w.lvl + 1, w.idx // 2, w.sib || coalesce(o.h, ''),
  sha256(CASE WHEN w.idx % 2 = 1 THEN o.h || w.fold ELSE w.fold || coalesce(o.h, '') END)
  FROM {name}_walk w JOIN {name}_nodes p ON p.tree = w.tree AND p.lvl = w.lvl + 1 AND p.idx = w.idx // 2
  LEFT JOIN {name}_nodes o ON o.tree = w.tree AND o.lvl = w.lvl AND o.idx = xor(w.idx, 1)),
{name}_top AS (SELECT rid, n.tree, sib, fold, n.h AS top FROM {name}_walk w JOIN {name}_nodes n ON n.tree = w.tree AND n.lvl = w.lvl AND n.n = 1)"""


# The polynomial is that of crc32.
MERKLE_MANIFEST = f"""WITH RECURSIVE crc_table AS (SELECT list(list_reduce(list_prepend(i, range(8)),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
d AS (SELECT row_number() OVER () AS rid, *, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS tree, xor(list_reduce(list_prepend(4294967295,
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) % 7 = 0 AS tampered
  FROM documents, crc_table),
hashed AS (SELECT rid, doc_id, tree, {_leaf()} AS h, CASE WHEN tampered THEN {_leaf(n_chars="(n_chars + 1)")} ELSE {_leaf()} END AS fold FROM d),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, '' AS sib FROM hashed),
{_tree("low", "leaves", "leaves")},
crown AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx, tree AS name, h FROM low_nodes WHERE n = 1),
entered AS (SELECT rid, '' AS tree, idx, sib, fold FROM low_top JOIN crown ON name = low_top.tree),
{_tree("high", "crown", "entered")}
SELECT doc_id, l.h AS leaf, low_top.top AS subroot, high_top.top AS root, sha256(high_top.sib) AS proof_sha256, high_top.fold AS folded_root,
  high_top.fold = high_top.top AS verified FROM leaves l JOIN low_top USING (rid) JOIN high_top USING (rid)"""


def _license_scan() -> str:
    known = ", ".join(f"('{text}', '{name}')" for text, name in SENTENCES.items())
    cases = " ".join("WHEN {} THEN {}".format("line LIKE '%" + "%".join(f",{w}," for w in wanted) + "%'", i) for i, (_, wanted) in enumerate(RULES))
    names = ", ".join(f"({i}, '{name}')" for i, (name, _) in enumerate(RULES))
    normal = _FOLD.format("part")
    return rf"""WITH known(s, id) AS (VALUES {known}), rules(rule_no, license) AS (VALUES {names}),
d AS (SELECT row_number() OVER () AS rid, doc_id, string_split_regex(coalesce(text, ''), '[.!?;][ \t\r\n]+|[\r\n]+') AS parts FROM documents),
each_part AS (SELECT rid, i, parts[i] AS part FROM d, unnest(range(1, len(parts) + 1)) t(i)),
found AS (SELECT rid, i, id FROM each_part JOIN known ON trim(regexp_replace({normal}, '[^a-z0-9]+', ' ', 'g')) = s),
listed AS (SELECT rid, count(*) AS n, string_agg(id, ',' ORDER BY i) AS ids, concat(',', string_agg(id, ',,' ORDER BY i), ',') AS line FROM found GROUP BY rid),
judged AS (SELECT *, CAST(CASE {cases} END AS INTEGER) AS rule_no FROM listed)
SELECT doc_id, coalesce(n, 0) AS n_sentences, coalesce(ids, '') AS sentence_ids, rule_no, license
FROM d LEFT JOIN judged USING (rid) LEFT JOIN rules USING (rule_no)"""


LICENSE_SCAN = _license_scan()
