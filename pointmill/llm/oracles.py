"""The registered queries as SQL, where SQL can express them.

Packing, bit packing, the classifier and word pieces cannot be: they rest on a tokenizer, a
trained model or an automaton. Tests hold them against brute force instead.
"""

from pointmill.llm import fingerprints
from pointmill.llm.license_join import PHRASES, TEMPLATES, Settings
from pointmill.llm.secret_ledger import BASE, RULES

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_COMPONENTS = """reached(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), roots AS (SELECT a, least(a, min(b)) AS component_id FROM reached GROUP BY a),
degrees AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    kinds = []
    for number, rule in enumerate(RULES):
        pattern = _quoted(rule.pattern)
        kinds.append(f"""SELECT doc_id, {number} AS k, {_quoted(rule.kind)} AS kind, pos,
  length(gaps[pos]) AS gap, length(found[pos]) AS size, length(least_of[pos]) >= {rule.least}{f" AND regexp_matches(found[pos], {_quoted(rule.shape)})" if rule.shape else ""} AS counts
FROM (SELECT doc_id, gaps, found, least_of, unnest(range(1, len(found) + 1)) AS pos FROM (SELECT doc_id,
  string_split_regex(coalesce(text, ''), {pattern}) AS gaps,
  regexp_extract_all(coalesce(text, ''), {pattern}) AS found,
  regexp_extract_all(coalesce(text, ''), {pattern}, {rule.group}) AS least_of FROM documents))""")
    base = ", ".join(_quoted(r.kind) for r in BASE)
    written = "string_agg(kind || ':' || (stop - size) || ':' || stop, ',' ORDER BY stop - size, k)"
    counts = ", ".join(f"count(*) FILTER (kind = {_quoted(r.kind)}) AS n_{r.kind}" for r in BASE)
    return f"""WITH matches AS ({" UNION ALL ".join(kinds)}),
spans AS (SELECT * FROM (SELECT *, sum(gap + size) OVER (PARTITION BY doc_id, kind ORDER BY pos) AS stop FROM matches) WHERE counts),
per AS (SELECT doc_id, {counts}, {written} FILTER (kind IN ({base})) AS base_spans, {written} AS spans, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_spans, 0) AS n_spans
FROM documents d LEFT JOIN per USING (doc_id)"""


def _licenses() -> str:
    phrases = " UNION ALL ".join(
        f"SELECT doc_id, pos - 1 AS pos, {_quoted(label)} AS label FROM places WHERE list_aggregate(list_slice(w, pos, pos + {len(p.split()) - 1}), 'string_agg', ' ') = {_quoted(p)}"
        for p, label in PHRASES.items()
    )
    settings = Settings()
    templates = ", ".join(
        f"({k}, {_quoted(label)}, {sorted(set(t.split()))!r}::VARCHAR[], {settings.need(len(set(t.split())))}, {settings.spread * len(t.split())})" for k, (t, label) in enumerate(TEMPLATES.items())
    )
    return rf"""WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM words),
base AS ({phrases}),
based AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word FROM base GROUP BY doc_id),
templates(k, label, t, need, reach) AS (VALUES {templates}),
blocks AS (SELECT doc_id, k, label, t, need, list_intersect(list_distinct(list_slice(w, greatest(1, pos + 1 - reach), pos)), t) AS b
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos, k, label, t, need, reach FROM words, templates WHERE len(list_intersect(list_distinct(w), t)) >= need) WHERE list_contains(t, w[pos])),
found AS (SELECT doc_id, k, label, max(len(b) / len(t)) AS score FROM blocks WHERE len(b) >= need GROUP BY doc_id, k, label),
labels AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (of_base) AS base_labels
  FROM (SELECT doc_id, label, TRUE AS of_base FROM base UNION ALL SELECT doc_id, label, FALSE FROM found) GROUP BY doc_id),
best AS (SELECT doc_id, max(score) AS best, count(*) AS n_blocks FROM found GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CAST(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(best, 0) END AS DOUBLE) AS score, coalesce(n_blocks, 0) AS n_blocks
FROM words LEFT JOIN based USING (doc_id) LEFT JOIN labels USING (doc_id) LEFT JOIN best USING (doc_id)"""


_VECTORS = f"""WITH RECURSIVE raw AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM raw WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.9),
{_COMPONENTS}
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept
FROM raw LEFT JOIN roots ON roots.a = vec_id LEFT JOIN degrees ON degrees.a = vec_id"""

_ARCHIVE = """WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, upper(sha1(coalesce(html, ''))) AS h FROM pages),
digests AS (SELECT page_id, html, list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform([15, 10, 5, 0],
  lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, i * 5 + 1, 5) AS BIGINT) >> s) & 31 AS BIGINT) + 1, 1)), 'string_agg', '')), 'string_agg', '') AS d FROM hashed),
first AS (SELECT html, min(page_id) AS first_id FROM digests GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, d AS payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM digests JOIN first USING (html)"""

_BENCHMARK = rf"""WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (SELECT DISTINCT item, size, list_slice(w, pos, pos + size - 1) AS win
  FROM (SELECT item, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS pos FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, size, pos, list_slice(w, pos, pos + size - 1) AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM words, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, pos, p.size AS size, item FROM places p JOIN windows v ON p.size = v.size AND p.win = v.win),
hit_words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)"""

_JACCARD = rf"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, list_slice(w, pos, pos + 2) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS pos FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)),
{_COMPONENTS}
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(n_links, 0) AS n_links
FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN roots ON roots.a = doc_id LEFT JOIN degrees ON degrees.a = doc_id"""

_DIFFERENCE = f"list_sum(list_transform(list_zip({{0}}.codes, {{1}}.codes), lambda z: abs(z[1] - z[2]))) + {fingerprints.LENGTH_WEIGHT} * abs({{0}}.size - {{1}}.size)"
_FIRST, _SECOND, _THIRD = fingerprints.MULTIPLIERS
_QUARTER = fingerprints.BUCKETS // 4
_FINGERPRINTS = rf"""WITH plain AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
following AS (SELECT *, coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC), max(doc_id) OVER ()) AS next_id,
  coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_text, length(text) // 3 AS third FROM plain),
edits AS (SELECT doc_id, text, next_id, left(text, length(text) - third) || left(next_text, third) AS edited FROM following),
versions AS (SELECT doc_id, 0 AS v, text AS t FROM edits UNION ALL SELECT doc_id, 1, edited FROM edits),
bytes AS (SELECT doc_id, v, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST('0x' || x AS BIGINT) + 1) AS b FROM versions),
hashes AS (SELECT doc_id, v, unnest(list_transform(range(1, len(b) - 1), lambda i: ((b[i] * {_FIRST} + b[i + 1] * {_SECOND} + b[i + 2] * {_THIRD}) % 4294967296) >> {fingerprints.SHIFT})) AS bucket FROM bytes),
counts AS (SELECT doc_id, v, bucket, count(*) AS n FROM hashes GROUP BY ALL),
filled AS (SELECT doc_id, v, list(coalesce(n, 0) ORDER BY bucket) AS c FROM (SELECT doc_id, v, unnest(range({fingerprints.BUCKETS})) AS bucket FROM versions) LEFT JOIN counts USING (doc_id, v, bucket) GROUP BY doc_id, v),
sorted AS (SELECT doc_id, v, c, list_sort(c) AS s FROM filled),
coded AS (SELECT doc_id, v, list_transform(c, lambda x: CAST(x > s[{_QUARTER}] AS INT) + CAST(x > s[{2 * _QUARTER}] AS INT) + CAST(x > s[{3 * _QUARTER}] AS INT)) AS codes FROM sorted),
prints AS (SELECT doc_id, v, codes, least(255, CAST(floor({fingerprints.LENGTH_STEPS} * log2(strlen(t) + 1)) AS INT)) AS size FROM coded JOIN versions USING (doc_id, v)),
written AS (SELECT *, format('{{:02x}}', size) || list_aggregate(list_transform(range(0, {fingerprints.BUCKETS // 2}), lambda i: substr('0123456789abcdef', codes[2 * i + 1] * 4 + codes[2 * i + 2] + 1, 1)), 'string_agg', '') AS print FROM prints)
SELECT e.doc_id, length(e.text) AS n_chars, sha256(edited) AS edited_sha256, a.print AS fingerprint, b.print AS edited_fingerprint,
  CAST({fingerprints.BOUND} - least({fingerprints.BOUND}, {_DIFFERENCE.format("a", "b")}) AS DOUBLE) / {fingerprints.BOUND} AS near_edited,
  CAST({fingerprints.BOUND} - least({fingerprints.BOUND}, {_DIFFERENCE.format("a", "c")}) AS DOUBLE) / {fingerprints.BOUND} AS near_next
FROM edits e JOIN written a ON a.doc_id = e.doc_id AND a.v = 0 JOIN written b ON b.doc_id = e.doc_id AND b.v = 1 JOIN written c ON c.doc_id = next_id AND c.v = 0"""

_SPELLING = rf"""WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
each AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, run, n FROM (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run)),
messages AS MATERIALIZED (SELECT k, regexp_extract_all(hex(encode(doc_id || ':' || run)), '..') AS bytes FROM each),
longest AS MATERIALIZED (SELECT max(len(bytes)) AS most FROM messages),
crcs AS MATERIALIZED (SELECT byte, list_reduce(list_prepend(byte, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc FROM range(256) r(byte)),
shifted(zeros, byte, value) AS (SELECT 0, byte, crc FROM crcs
  UNION ALL SELECT zeros + 1, shifted.byte, xor(crc, value >> 8) FROM shifted JOIN crcs ON crcs.byte = value & 255 WHERE zeros < (SELECT most FROM longest)),
places AS (SELECT k, len(bytes) - i AS zeros, CASE WHEN i <= 4 THEN 255 - byte ELSE byte END AS byte
  FROM (SELECT k, bytes, unnest(range(1, len(bytes) + 1)) AS i, CAST('0x' || unnest(bytes) AS BIGINT) AS byte FROM messages)),
crc AS (SELECT k, xor(bit_xor(value), 4294967295) AS h FROM places JOIN shifted USING (zeros, byte) GROUP BY k),
hashed AS (SELECT run, n, h FROM each JOIN crc USING (k)),
changed AS (SELECT n, CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
holes AS (SELECT word, unnest(list_transform(range(1, length(word) + 1), lambda i: left(word, i - 1) || '_' || substr(word, i + 1))) AS hole FROM words),
cuts AS (SELECT DISTINCT word, unnest(list_transform(range(1, length(word) + 1), lambda i: left(word, i - 1) || substr(word, i + 1))) AS cut FROM words),
near AS (SELECT a.word, b.word AS other FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT word, cut FROM cuts WHERE cut IN (SELECT word FROM words) UNION SELECT cut, word FROM cuts WHERE cut IN (SELECT word FROM words)),
best AS (SELECT near.word, count(*) AS n_near, first(other ORDER BY words.n DESC, other) AS top, max(words.n) AS top_n FROM near JOIN words ON words.word = other GROUP BY near.word),
formed AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 5 * n THEN top END AS form, CASE WHEN top_n >= 5 * n THEN top_n END AS form_n FROM words LEFT JOIN best USING (word)),
chain(word, place, depth) AS (SELECT word, word, 0 FROM formed UNION ALL SELECT chain.word, form, depth + 1 FROM chain JOIN formed ON formed.word = place WHERE form IS NOT NULL),
roots AS (SELECT word, arg_max(place, depth) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)"""

_TERMS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_SEARCH = f"""WITH words AS (SELECT doc_id, {_TERMS} AS w FROM documents),
item_terms AS (SELECT item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark),
totals AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM words),
tf AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM words) WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM df, totals),
shares AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS score FROM tf JOIN weights USING (term), totals),
scores AS (SELECT item_id, doc_id, CAST(sum(score) AS BIGINT) AS score FROM item_terms JOIN shares USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM scores WHERE score > 0 QUALIFY rank <= 10"""

ORACLES: dict[str, str] = {
    "op1_secret_ledger": _secrets(),
    "op3_metric_range_join": _VECTORS,
    "op4_license_join": _licenses(),
    "op5_arc_to_warc": _ARCHIVE,
    "op9_decontamination": _BENCHMARK,
    "op10_ngram_jaccard": _JACCARD,
    "op11_fingerprints": _FINGERPRINTS,
    "op12_spelling_variants": _SPELLING,
    "op13_ranked_search": _SEARCH,
}
