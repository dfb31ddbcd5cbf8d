"""DuckDB SQL of the dealt operators that SQL can express."""

from __future__ import annotations

from . import quality, sharding, url_filter

SPACE = r"[\x20\x09-\x0D]+"
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words_sql(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{SPACE}'), lambda w: w <> '')"


def near_dedup_sql() -> str:
    return f"""
WITH RECURSIVE numbered AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
words AS (
  SELECT r, {words_sql(LOWER.format("coalesce(text, '')"))} AS w FROM numbered),
shingles AS (
  SELECT DISTINCT r, s FROM (
    SELECT r, unnest(CASE WHEN len(w) >= 5 THEN
             list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (
  SELECT x.r AS a, y.r AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.r < y.r GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b
  WHERE 100 * c >= {85} * (p.n + q.n - c)),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(r, other) AS (
  SELECT r, r FROM numbered
  UNION SELECT x.r, s.b FROM reach x JOIN steps s ON s.a = x.other),
component AS (SELECT x.r, min(o.doc_id) AS component_id FROM reach x JOIN numbered o ON o.r = x.other GROUP BY x.r)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id IS NOT DISTINCT FROM component_id AS kept
FROM numbered d JOIN component USING (r) LEFT JOIN sizes USING (r)
"""


def quality_sql() -> str:
    rate = {
        "symbol_rate": "coalesce(1000 * n_symbols // nullif(word_chars, 0), 0)",
        "upper_rate": "coalesce(1000 * n_upper // nullif(n_letters, 0), 0)",
        "mark_rate": "coalesce(1000 * n_marks // nullif(n_words, 0), 0)",
        "dup_line_rate": "coalesce(1000 * n_dup_lines // nullif(n_words, 0), 0)",
        "repeat_rate": "coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0)",
        "word_length": "coalesce(100 * word_chars // nullif(n_words, 0), 0)",
        "single_rate": "coalesce(1000 * n_single // nullif(n_words, 0), 0)"}
    count = lambda chars: f"length(text) - length(regexp_replace(text, '{chars}', '', 'g'))"
    quart = lambda keys: f"""
  SELECT {keys} feature, min(CASE WHEN upto * 4 >= total THEN bin END) AS q25, min(CASE WHEN upto * 4 >= total * 2 THEN bin END) AS q50,
         min(CASE WHEN upto * 4 >= total * 3 THEN bin END) AS q75, max(total) AS docs
  FROM (SELECT *, sum(n) OVER (PARTITION BY {keys} feature ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {keys} feature) AS total
        FROM (SELECT {keys} feature, bin, sum(n) AS n FROM counts GROUP BY {keys} feature, bin))
  GROUP BY {keys} feature"""  # noqa: E731
    pick = lambda q: f"coalesce(CASE WHEN o.docs >= {quality.MIN_DOCS} THEN o.{q} END, CASE WHEN l.docs >= {quality.MIN_DOCS} THEN l.{q} END, e.{q})"
    slack = " ".join(f"WHEN '{n}' THEN {v}" for n, v in quality.SLACK.items())
    base = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"
    return f"""
WITH texts AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
split AS (SELECT doc_id, lang, source, text, {words_sql('text')} AS w,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM texts),
windows AS (
  SELECT doc_id, pos, array_to_string(w[pos:pos + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS pos FROM split WHERE len(w) >= 5)),
twice AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(pos, pos + 5)) AS p FROM twice) GROUP BY doc_id),
features AS (
  SELECT s.doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         ({count('[#*$%&|<>]')})::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, {count('[A-Z]')} AS n_upper, {count('[A-Za-z]')} AS n_letters,
         {count('[!?]')} AS n_marks, len(list_filter(w, lambda x: strlen(x) = 1)) AS n_single
  FROM split s LEFT JOIN covered c USING (doc_id)),
rated AS (SELECT *, {base} AS base_failed, {', '.join(f'{e} AS {n}' for n, e in rate.items())} FROM features),
pairs AS (SELECT lang, source, unnest([{', '.join(f"struct_pack(feature := '{n}', v := ({n})::BIGINT)" for n in rate)}], recursive := true) FROM rated WHERE NOT base_failed),
counts AS (SELECT lang, source, feature, v - v % (1::BIGINT << greatest(length(bin(v)) - 6, 0)) AS bin, count(*) AS n FROM pairs GROUP BY ALL),
own AS ({quart('lang, source,')}),
per_lang AS ({quart('lang,')}),
everything AS ({quart('')}),
fences AS (
  SELECT lang, source, feature, q50 + {quality.REACH} * greatest(q75 - q25, CASE feature {slack} END) AS fence
  FROM (SELECT o.lang, o.source, o.feature, {pick('q25')} AS q25, {pick('q50')} AS q50, {pick('q75')} AS q75
        FROM own o JOIN per_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.feature = l.feature JOIN everything e ON o.feature = e.feature)),
wide AS (SELECT lang, source, {', '.join(f"max(CASE WHEN feature = '{n}' THEN fence END) AS f_{n}" for n in rate)} FROM fences GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(f'coalesce({n} <= f_{n}, true)' for n in rate)} AS kept
FROM rated r LEFT JOIN wide f ON r.lang IS NOT DISTINCT FROM f.lang AND r.source IS NOT DISTINCT FROM f.source
"""


def url_sql() -> str:
    lower = LOWER.format("url")
    edge = "[^a-z0-9]"
    hit = lambda t: f"regexp_matches({lower}, '(^|{edge}){t}({edge}|$)')"
    add = lambda terms: " + ".join(f"CASE WHEN {hit(t)} THEN {w} ELSE 0 END" for t, w in terms.items())
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    when = lambda what: " ".join(f"WHEN {fits(h, p)} THEN '{what(k, h, p)}'" for k, h, p in rules)
    return f"""
WITH cut AS (SELECT page_id, coalesce(url, '') AS url, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
parts AS (SELECT page_id, url, {LOWER.format("raw")} AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
rated AS (SELECT *, ({add({t: 1 for t in url_filter.STRICT})})::BIGINT AS n_strict,
                 ({add({t: 1 for t in url_filter.SOFT})})::BIGINT AS n_soft, ({add(url_filter.SOFT)})::BIGINT AS soft_weight FROM parts)
SELECT page_id, host, path, CASE {when(lambda k, h, p: h + p)} END AS rule,
       CASE {when(lambda k, h, p: k)} WHEN n_strict > 0 OR n_soft >= 2 AND soft_weight >= 2 THEN 'block' ELSE 'allow' END AS verdict,
       n_strict, n_soft, soft_weight
FROM rated
"""


#: CRC-32 of the bytes of a text, as a CTE with the step table and an expression.
CRC_STEPS = """crc_steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps)"""


def crc_sql(text: str) -> str:
    """CRC-32 of a text expression; ``steps`` must be in scope."""
    octets = f"list_transform(range(1, strlen({text}) + 1), lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c // 256, steps[1 + (xor(c, b) & 255)])), 4294967295)"


def spelling_sql() -> str:
    return f"""
WITH RECURSIVE {CRC_STEPS},
runs AS (
  SELECT doc_id, run, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, c, {crc_sql("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM runs, crc_steps),
spelt AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, c FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cut AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT x.word, y.word AS other FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON w.word = c.rest),
ranked AS (
  SELECT a.word, a.n, o.word AS other, o.n AS m, count(*) OVER (PARTITION BY a.word) AS n_near,
         row_number() OVER (PARTITION BY a.word ORDER BY o.n DESC, encode(o.word)) AS r
  FROM near JOIN words a ON a.word = near.word JOIN words o ON o.word = near.other),
formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0)::BIGINT AS n_near, CASE WHEN r.m >= 5 * w.n THEN r.other END AS form, CASE WHEN r.m >= 5 * w.n THEN r.m END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.r = 1),
follow(word, stop) AS (SELECT word, word FROM formed UNION ALL SELECT f.word, g.form FROM follow f JOIN formed g ON g.word = f.stop WHERE g.form IS NOT NULL)
SELECT f.word, f.form, ends.stop AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT w.word, w.stop FROM follow w JOIN formed g ON g.word = w.stop WHERE g.form IS NULL) ends ON ends.word = f.word
"""


def merkle_sql(levels: int = 40) -> str:
    """``levels`` bounds the height of the trees, not the rows."""
    part = lambda c: f"coalesce(strlen({c}) || ':' || {c}, '-')"
    leaf = lambda n: f"sha256({' || '.join(part(c) for c in ('doc_id::VARCHAR', 'source', 'lang', n, 'text'))})"
    # a tree climbs by joining even nodes with their right neighbours; the last node stays alone
    climb = lambda name, leaves: f"""{name}(g, h, k, d, m) AS (
  {leaves}
  UNION ALL
  SELECT g, h + 1, k // 2, sha256(string_agg(d, '' ORDER BY k)), max((m + 1) // 2) FROM {name} WHERE m > 1 AND h < {levels} GROUP BY g, h, k // 2)"""  # noqa: E731
    return f"""
WITH RECURSIVE {CRC_STEPS},
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS k, count(*) OVER (PARTITION BY g) AS m
  FROM (SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf('n_chars::VARCHAR')} AS d,
               CASE WHEN {crc_sql('doc_id::VARCHAR')} % 7 = 0 THEN {leaf('(n_chars::HUGEINT + 1)::VARCHAR')} ELSE {leaf('n_chars::VARCHAR')} END AS changed
        FROM documents, crc_steps)),
{climb('nodes', 'SELECT g, 0, k, d, m FROM leaves')},
groups AS (SELECT g, d, row_number() OVER (ORDER BY encode(g)) - 1 AS k, count(*) OVER () AS m FROM nodes WHERE m = 1),
{climb('tops', "SELECT 'top', 0, k, d, m FROM groups")},
steps_up AS (
  SELECT l.doc_id, l.k AS leaf_k, l.g, n.h, l.k // (1::BIGINT << n.h) % 2 = 1 AS is_right, s.d AS sibling
  FROM leaves l JOIN (SELECT DISTINCT g, h FROM nodes WHERE m > 1) n ON n.g = l.g
  LEFT JOIN nodes s ON s.g = l.g AND s.h = n.h AND s.k = xor(l.k // (1::BIGINT << n.h), 1)
  UNION ALL
  SELECT l.doc_id, l.k, l.g, 1000 + t.h, p.k // (1::BIGINT << t.h) % 2 = 1, s.d
  FROM leaves l JOIN groups p ON p.g = l.g JOIN (SELECT DISTINCT h FROM tops WHERE m > 1) t ON true
  LEFT JOIN tops s ON s.h = t.h AND s.k = xor(p.k // (1::BIGINT << t.h), 1)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY g, leaf_k ORDER BY h) AS r FROM steps_up),
proofs AS (SELECT g, leaf_k, sha256(coalesce(string_agg(sibling, '' ORDER BY r), '')) AS proof FROM numbered GROUP BY g, leaf_k),
folds(g, k, r, d) AS (
  SELECT g, k, 0::BIGINT, changed FROM leaves
  UNION ALL
  SELECT f.g, f.k, n.r, sha256(CASE WHEN n.is_right THEN n.sibling || f.d ELSE f.d || coalesce(n.sibling, '') END)
  FROM folds f JOIN numbered n ON n.g = f.g AND n.leaf_k = f.k AND n.r = f.r + 1),
ends AS (SELECT g, k, arg_max(d, r) AS d FROM folds GROUP BY g, k)
SELECT l.doc_id, l.d AS leaf, p.d AS subroot, t.d AS root, coalesce(pr.proof, sha256('')) AS proof_sha256, e.d AS folded_root, e.d = t.d AS verified
FROM leaves l JOIN groups p ON p.g = l.g JOIN (SELECT d FROM tops WHERE m = 1) t ON true
LEFT JOIN proofs pr ON pr.g = l.g AND pr.leaf_k = l.k JOIN ends e ON e.g = l.g AND e.k = l.k
"""


def sharding_sql(part: int = sharding.PART) -> str:
    n, tol = sharding.SHARDS, sharding.TOLERANCE
    spread = crc_sql("(key::VARCHAR || ':' || coalesce(doc_id::VARCHAR, ''))")
    return f"""
WITH {CRC_STEPS},
keyed AS (
  SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size, ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS key
  FROM documents),
placed AS (
  SELECT *, sum(size) OVER () AS total, sum(size) OVER (PARTITION BY key) AS grp,
         sum(size) OVER (ORDER BY key) - sum(size) OVER (PARTITION BY key) AS grp_start,
         sum(size) OVER (ORDER BY key, doc_id NULLS FIRST) - sum(size) OVER (PARTITION BY key, doc_id) AS doc_start FROM keyed),
dealt AS (
  SELECT doc_id, size, key, {crc_sql("text")} AS text_crc32, {spread} % greatest(1, (total + {n * part - 1}) // {n * part}) AS part,
         ({n} * (CASE WHEN grp * {n} * {tol} <= total THEN grp_start ELSE doc_start END) // total)::INTEGER AS shard
  FROM placed, crc_steps)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY part, key, doc_id NULLS FIRST) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM dealt
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_sharding": sharding_sql(), "op3_near_dedup": near_dedup_sql(), "op6_url_filter": url_sql(), "op7_quality_rules": quality_sql(),
            "op11_spelling_variants": spelling_sql(), "op12_merkle_manifest": merkle_sql()}
