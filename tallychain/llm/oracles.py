"""DuckDB SQL of the queries that SQL can express; the others are tested against brute force in ``tests/llm``."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x20\x09-\x0D]+"

MIXING = rf"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
         coalesce(CASE WHEN length(text) > 0 THEN greatest(0.05::DOUBLE,
           length(translate(text, '0123456789!"#$%&''()*+,-./:;<=>?@[\]^_`{{|}}~', ''))::DOUBLE / length(text)) END, 1.0::DOUBLE) AS quality
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
         -ln((CAST('0x' || substr(md5(concat_ws('|', '7', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(source, ''), CAST(size AS VARCHAR))), 1, 12)
              AS UBIGINT)::DOUBLE + 0.5) / 281474976710656.0::DOUBLE) / quality AS key
  FROM docs),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1)::DOUBLE AS weight
  FROM docs GROUP BY source),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY 3 * source_size / weight, source) AS k, 3 * source_size / weight AS ratio FROM sources),
levels AS (
  SELECT k, ratio, ((SELECT sum(source_size) FROM sources) - coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT
         / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ordered),
chosen AS (SELECT level FROM levels WHERE level < ratio ORDER BY k LIMIT 1),
targets AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * coalesce((SELECT level FROM chosen), 1e300)) AS target FROM sources),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM targets)
SELECT d.doc_id, d.size, p.source_size, p.target,
       d.size * (p.epochs + CASE WHEN p.epochs < 3 AND sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size
         ROWS UNBOUNDED PRECEDING) - d.size / 2.0::DOUBLE < p.target - p.epochs * p.source_size THEN 1 ELSE 0 END)::BIGINT AS taken
FROM keyed d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source
"""

DECONTAMINATION = rf"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row, regexp_extract_all({_LOWER}, '{_BENCH_WORD}') AS words FROM documents),
items AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_BENCH_WORD}') AS words FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n, array_to_string(words[s:s + least(10, len(words)) - 1], ' ') AS w
  FROM (SELECT item_id, words, unnest(generate_series(1, greatest(1, len(words) - 9))) AS s FROM items WHERE len(words) > 0)),
places AS (
  SELECT row, s, n, array_to_string(words[s:s + n - 1], ' ') AS w
  FROM (SELECT row, words, n, unnest(generate_series(1, len(words) - n + 1)) AS s
        FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(words) >= n)),
found AS (SELECT row, s, n, item_id FROM places JOIN item_windows USING (n, w)),
hit AS (SELECT row, count(DISTINCT i)::BIGINT AS n_hit FROM (SELECT row, unnest(generate_series(s, s + n - 1)) AS i FROM found) GROUP BY row),
named AS (
  SELECT row, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""

SUBSTRINGS = rf"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
windows AS (
  SELECT row, doc_id, s, array_to_string(words[s:s + 12], ' ') AS w
  FROM (SELECT row, doc_id, words, unnest(generate_series(1, len(words) - 12)) AS s FROM docs WHERE len(words) >= 13)),
repeats AS (SELECT row, s FROM (SELECT *, min(doc_id) OVER (PARTITION BY w) AS first FROM windows) WHERE first < doc_id OR doc_id IS NULL AND first IS NOT NULL),
gone AS (SELECT DISTINCT row, unnest(generate_series(s, s + 12)) AS i FROM repeats),
lost AS (SELECT row, list(i) AS lost FROM gone GROUP BY row),
kept AS (SELECT row, string_agg(w, ' ' ORDER BY i) AS kept
         FROM (SELECT row, unnest(words) AS w, unnest(generate_series(1, len(words))) AS i FROM docs) t ANTI JOIN gone USING (row, i) GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(lost), 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN lost USING (row) LEFT JOIN kept USING (row)
"""

NEIGHBOURS = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS rank
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
WHERE rank <= 20
"""

# CRC-32 of a text's UTF-8 bytes, by its table of 256 remainders (one row, column t).
_CRC_TABLE = """
crc AS (SELECT list(r ORDER BY b) AS t FROM (
  SELECT b, list_reduce(range(8), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, b) AS r
  FROM (SELECT unnest(range(256))::BIGINT AS b)))"""


def _crc32(text):
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce({octets}, lambda c, o: xor(c >> 8, t[(xor(c, o) & 255) + 1]), 4294967295::BIGINT), 4294967295)"


def _field(value):
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars):
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


MANIFEST = f"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (
  SELECT doc_id, lang, leaf, CASE WHEN doc_id IS NOT NULL AND {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN changed ELSE leaf END AS tampered
  FROM (SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, {_leaf("n_chars + 1")} AS changed FROM documents), crc),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM docs GROUP BY lang),
leaves AS (
  SELECT d.*, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM docs d JOIN langs l ON d.lang IS NOT DISTINCT FROM l.lang),
low AS (
  SELECT tree, 0 AS level, pos, leaf AS node, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM low WHERE n > 1 GROUP BY tree, pos // 2),
subroots AS (SELECT tree AS pos, node FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, pos, node, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM high WHERE n > 1 GROUP BY pos // 2),
steps AS (
  SELECT p.tree, p.pos, 0 AS half, l.level, coalesce(s.node, '') AS node, (p.pos >> l.level) & 1 = 1 AS before
  FROM leaves p JOIN (SELECT DISTINCT tree, level FROM low WHERE n > 1) l ON p.tree = l.tree
  LEFT JOIN low s ON s.tree = p.tree AND s.level = l.level AND s.pos = xor(p.pos >> l.level, 1)
  UNION ALL
  SELECT p.tree, p.pos, 1, l.level, coalesce(s.node, ''), (p.tree >> l.level) & 1 = 1
  FROM leaves p CROSS JOIN (SELECT DISTINCT level FROM high WHERE n > 1) l
  LEFT JOIN high s ON s.level = l.level AND s.pos = xor(p.tree >> l.level, 1)),
paths AS (SELECT tree, pos, list({{'node': node, 'before': before}} ORDER BY half, level) AS path FROM steps GROUP BY tree, pos),
folded AS (
  SELECT p.tree, p.pos, list_reduce(list_prepend({{'node': tampered, 'before': false}}, coalesce(path, [])),
    lambda a, s: {{'node': sha256(CASE WHEN s.before THEN s.node || a.node ELSE a.node || s.node END), 'before': false}}).node AS folded_root
  FROM leaves p LEFT JOIN paths USING (tree, pos))
SELECT doc_id, leaf, r.node AS subroot, h.node AS root, sha256(coalesce(array_to_string(list_transform(path, lambda s: s.node), ''), '')) AS proof_sha256,
       folded_root, folded_root = h.node AS verified
FROM leaves JOIN subroots r ON r.pos = leaves.tree JOIN high h ON h.n = 1 JOIN folded f ON f.tree = leaves.tree AND f.pos = leaves.pos
LEFT JOIN paths p ON p.tree = leaves.tree AND p.pos = leaves.pos
"""

SPELLING = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL HAVING length(run) >= 7),
checked AS (SELECT run, n, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs, crc),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM checked)
  GROUP BY word HAVING length(word) >= 7 AND sum(n) >= 2),
skips AS (SELECT word, n, i, word[:i] AS a, word[i + 2:] AS b FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT s.word, t.word AS other, t.n AS m FROM skips s JOIN skips t ON s.a = t.a AND s.b = t.b AND s.word <> t.word
  UNION SELECT s.word, w.word, w.n FROM skips s JOIN words w ON w.word = s.a || s.b
  UNION SELECT w.word, s.word, s.n FROM skips s JOIN words w ON w.word = s.a || s.b),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS form, max(m) AS m FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 10 * w.n THEN form END AS form, CASE WHEN m >= 10 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
chain AS (
  SELECT word, form AS root, 1 AS step FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN ends USING (word)
"""

ORACLES = {
    "op3_mixing": MIXING,
    "op4_decontamination": DECONTAMINATION,
    "op8_substrings": SUBSTRINGS,
    "op9_neighbours": NEIGHBOURS,
    "op11_manifest": MANIFEST,
    "op12_spelling": SPELLING,
}
