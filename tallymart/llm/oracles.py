"""The operators that SQL can express, as DuckDB SQL."""

from __future__ import annotations

from tallymart.llm import mixing, quality_rules, url_blocks

W = r"[\x20\x09-\x0D]"


def _rules() -> str:
    parts = []
    for r in quality_rules.RULES:
        low = [] if r.low is None else [f"{r.measure} >= {r.low}"]
        high = [] if r.high is None else [f"{r.measure} <= {r.high}"]
        parts.append(f"(n_words < {r.min_words} OR ({' AND '.join(low + high)}))")
    return " AND ".join(parts)


STOPS = ", ".join(f"'{v}'" for w in quality_rules.STOP_WORDS for v in (w, w.capitalize(), w.upper()))

OP8 = rf"""
WITH d AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, string_split(text, chr(10)) AS all_lines FROM d),
f AS (SELECT *, list_filter(all_lines, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM w),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS t
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
twice AS (SELECT doc_id, i FROM windows QUALIFY COUNT(*) OVER (PARTITION BY doc_id, t) > 1),
covered AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n FROM twice, range(0, 5) AS r(k) GROUP BY doc_id),
m AS (SELECT f.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, COALESCE(c.n, 0) AS n_repeat_words,
             GREATEST(len(all_lines), 1) AS n_lines,
             len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\t]*[-*•]'))) AS n_bullet_lines,
             len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\t\r]*$'))) AS n_ellipsis_lines,
             len(list_filter(words, lambda l: regexp_matches(l, '\p{{L}}'))) AS n_letter_words,
             len(list_filter(list_distinct(words), lambda l: l IN ({STOPS}))) AS n_stop_words
      FROM f LEFT JOIN covered AS c ON c.doc_id = f.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND {_rules()} AS kept
FROM m"""

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP10 = f"""
WITH l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i
           FROM (SELECT doc_id, string_split(COALESCE(text, ''), chr(10)) AS lines FROM documents)),
k AS (SELECT *, translate(trim(line, {BLANKS}), '{UPPER}', '{LOWER}') AS key FROM l),
shared AS (SELECT key, MAX(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING COUNT(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id < s.last AS gone FROM k LEFT JOIN shared AS s ON s.key = k.key)
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (gone) AS n_dropped,
       sha256(COALESCE(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""

OP5 = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
near AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98e0),
reach AS (SELECT DISTINCT a AS node, a AS seen FROM near UNION SELECT r.node, n.b FROM reach AS r JOIN near AS n ON n.a = r.seen),
named AS (SELECT node, MIN(seen) AS component FROM reach GROUP BY node),
counted AS (SELECT a, COUNT(*) AS n FROM near GROUP BY a)
SELECT e.vec_id, COALESCE(c.n, 0) AS n_links, COALESCE(n.component, e.vec_id) AS component_id,
       e.vec_id = COALESCE(n.component, e.vec_id) AS kept
FROM embeddings AS e LEFT JOIN counted AS c ON c.a = e.vec_id LEFT JOIN named AS n ON n.node = e.vec_id"""


def _host(url: str) -> str:
    return f"translate(regexp_extract(COALESCE({url}, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}')"


def _path(url: str) -> str:
    return f"regexp_extract(COALESCE({url}, ''), '://[^/?#]*([^?#]*)', 1)"


def _ruled(what: str) -> str:
    """rule (0) or verdict (1) of the longest rule that fits."""
    whens = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p if what == 'rule' else v}'"
             for v, h, p in sorted(url_blocks.RULES, key=lambda r: (-len(r[1]) - len(r[2]), r[0] != "allow"))]
    return f"CASE {' '.join(whens)} END"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


OP7 = f"""
WITH RECURSIVE p AS (SELECT page_id, {_host('url')} AS host, {_path('url')} AS path FROM pages),
raw AS (SELECT url, unnest([{', '.join(f"regexp_extract(COALESCE(html, ''), {_quoted(x)}, 1)" for x in (*url_blocks.CANONICAL, url_blocks.REFRESH))}]) AS t
        FROM pages WHERE url IS NOT NULL),
links AS (SELECT url, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN 'x:' || t
          WHEN starts_with(t, '/') THEN 'x://' || {_host('url')} || t
          ELSE 'x://' || {_host('url')} || regexp_replace({_path('url')}, '[^/]*$', '') || CASE WHEN {_path('url')} = '' THEN '/' ELSE '' END || t END AS target
          FROM raw WHERE t <> ''),
edges AS (SELECT {_host('url')} || ' ' || {_path('url')} AS a, {_host('target')} || ' ' || {_path('target')} AS b FROM links WHERE {_host('url')} <> '' AND {_host('target')} <> ''),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT a AS node, a AS seen FROM both_ways UNION SELECT r.node, e.b FROM reach AS r JOIN both_ways AS e ON e.a = r.seen),
seen_rules AS (SELECT node, {_ruled('verdict')} AS v FROM
               (SELECT node, split_part(seen, ' ', 1) AS host, substr(seen, strpos(seen, ' ') + 1) AS path FROM reach)),
aliases AS (SELECT node FROM seen_rules GROUP BY node HAVING bool_or(v = 'block') AND NOT COALESCE(bool_or(v = 'allow'), FALSE)),
r AS (SELECT *, {_ruled('rule')} AS rule, {_ruled('verdict')} AS v FROM p)
SELECT page_id, host, path, rule, COALESCE(v, CASE WHEN a.node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM r LEFT JOIN aliases AS a ON a.node = host || ' ' || path"""


# Sweeps that the statement makes; the operator stops by its own rule.
RAKES = 30


def _op2(temperature: float = 0.8) -> str:
    times = lambda s: f"((strlen(text) - strlen(replace(text, '{s}', ''))) / {len(s)})"
    marks = " + ".join(times(s) for s in ("***", "$$$", "%%%", "&&&", "###"))
    steps = [f"""d AS (SELECT doc_id, COALESCE(source, '') AS source, COALESCE(lang, '') AS lang, COALESCE(text, '') AS text,
        CASE WHEN COALESCE(text, '') = '' THEN 0 ELSE strlen(text) - strlen(replace(replace(text, ' ', ''), chr(10), '')) + 1 END AS tokens FROM documents),
    c AS MATERIALIZED (SELECT doc_id, source, lang, CAST(tokens AS BIGINT) AS tokens,
        CASE WHEN tokens < {times('|')} * 10 THEN 'table' WHEN tokens < {times('!!')} * 10 THEN 'shouting' WHEN tokens < ({marks}) * 10 THEN 'symbols'
             WHEN tokens < 200 THEN 'short prose' ELSE 'long prose' END AS topic FROM d),
    cells AS (SELECT source, lang, topic, SUM(tokens) AS tokens FROM c GROUP BY ALL HAVING SUM(tokens) > 0)"""]
    for m in mixing.MARGINS:
        steps.append(f"""share_{m} AS (SELECT {m}, p / SUM(p) OVER () AS s FROM
            (SELECT {m}, pow(SUM(tokens), {temperature}) AS p FROM cells GROUP BY {m}))""")
    steps.append(f"""x0 AS MATERIALIZED (SELECT cells.*, CAST(tokens AS DOUBLE) AS weight, {', '.join(f'share_{m}.s AS {m}_share' for m in mixing.MARGINS)}
        FROM cells {' '.join(f'JOIN share_{m} USING ({m})' for m in mixing.MARGINS)})""")
    n = 0
    for _ in range(RAKES):
        for m in mixing.MARGINS:
            steps.append(f"""x{n + 1} AS MATERIALIZED (SELECT * REPLACE (weight * {m}_share / (SUM(weight) OVER (PARTITION BY {m}) / SUM(weight) OVER ()) AS weight) FROM x{n})""")
            n += 1
    steps.append(f"""p AS (SELECT source, lang, topic, round(weight / tokens / MAX(weight / tokens) OVER (), 9) AS probability FROM x{n})""")
    return f"""WITH {', '.join(steps)}
SELECT doc_id, source, lang, topic, tokens, round(COALESCE(probability, 1), 6) AS probability,
       CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296e0 < COALESCE(probability, 1) AS kept
FROM c LEFT JOIN p USING (source, lang, topic)"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8, bit by bit (0xEDB88320 is the polynomial that the checksum fixes)."""
    bytes_ = f"list_transform(range(CAST(octet_length(encode({text})) AS BIGINT)), lambda i: CAST('0x' || substr(hex({text}), 2 * i + 1, 2) AS BIGINT))"
    byte = "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], {bytes_}), {byte}))"


OP11 = rf"""
WITH RECURSIVE runs AS (SELECT COALESCE(CAST(doc_id AS VARCHAR), '') AS id,
        unnest(regexp_extract_all(translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]{{7,}}')) AS run FROM documents),
hashed AS (SELECT run, {_crc32("(id || ':' || run)")} AS h FROM runs),
spelt AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS MATERIALIZED (SELECT word, COUNT(*) AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING COUNT(*) >= 2),
less AS MATERIALIZED (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS MATERIALIZED (SELECT a.word AS a, b.word AS b FROM less AS a JOIN less AS b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT less.word, w.word FROM less JOIN words AS w ON w.word = less.rest UNION SELECT w.word, less.word FROM less JOIN words AS w ON w.word = less.rest),
best AS (SELECT near.a AS word, COUNT(*) AS n_near, arg_min(near.b, (-w.n, near.b)) AS b, MAX(w.n) AS b_n FROM near JOIN words AS w ON w.word = near.b GROUP BY near.a),
named AS MATERIALIZED (SELECT w.word, w.n, COALESCE(x.n_near, 0) AS n_near, CASE WHEN x.b_n >= 10 * w.n THEN x.b END AS form, CASE WHEN x.b_n >= 10 * w.n THEN x.b_n END AS form_n
    FROM words AS w LEFT JOIN best AS x ON x.word = w.word),
chain AS (SELECT word, word AS seen, 0 AS step FROM named UNION ALL SELECT c.word, f.form, step + 1 FROM chain AS c JOIN named AS f ON f.word = c.seen WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(seen, step) AS root FROM chain GROUP BY word)
SELECT named.word, form, root, n, n_near, form_n FROM named JOIN ends ON ends.word = named.word"""

OP13 = f"""
WITH t AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS turns FROM t GROUP BY conv_id),
h AS (SELECT *, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM own),
built AS (SELECT h.conv_id, list_concat(COALESCE(b.turns[1:h], []), h.turns[h + 1:]) AS turns FROM h LEFT JOIN own AS b ON b.conv_id = h.conv_id - h.conv_id % 100),
paths AS (SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM built),
members AS (SELECT conv_id, n, depth, turns[1:depth] AS path FROM paths),
nodes AS MATERIALIZED (SELECT path, depth, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs,
        sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256 FROM members GROUP BY path, depth),
childless AS (SELECT n.*, COUNT(c.depth) AS n_children FROM nodes AS n LEFT JOIN nodes AS c ON c.depth = n.depth + 1 AND c.path[1:n.depth] = n.path GROUP BY ALL),
up AS (SELECT path[1:d] AS path, n_children, n_convs, COALESCE(length(path[-1].text), 0) AS chars
       FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM childless)),
sums AS (SELECT path, COUNT(*) FILTER (n_children = 0) AS n_leaves, CAST(SUM((n_convs - 1) * chars) AS BIGINT) AS saved_tokens FROM up GROUP BY path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM childless AS n JOIN sums AS s ON s.path = n.path LEFT JOIN nodes AS p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]"""

SQL = {"op2_mixing": _op2(), "op5_lattice": OP5, "op7_url_blocks": OP7, "op8_quality_rules": OP8, "op10_line_dedup": OP10, "op11_spelling": OP11,
       "op13_conversation_trie": OP13}
