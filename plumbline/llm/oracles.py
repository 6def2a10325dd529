"""SQL (DuckDB) for the queries that SQL can express on whole tables. The rest is tested against brute force.

Not here: token counts, ids and groups and page texts (no such functions), shards (no CRC-32 function).
"""

from __future__ import annotations

from plumbline.llm.quality_rules import CUTOFFS, RULES, RiskPlan
from plumbline.llm.source_mix import BUCKETS

_PLAN = RiskPlan()
_RULE_ROWS = "\nUNION ALL\n".join(
    f"SELECT doc_id, lang, {k} AS k, {part} / greatest({whole}, 1) AS share FROM m" for k, (part, whole) in enumerate(RULES.values(), 1))
_CUT_ROWS = ", ".join(f"({k}, {i}, CAST({c} AS DOUBLE))" for k, cuts in enumerate(CUTOFFS.values(), 1) for i, c in enumerate(cuts, 1))
_PASSED = ", ".join(f"len(list_filter([{', '.join(map(str, CUTOFFS[rule]))}], lambda c: {part} / greatest({whole}, 1) > c))" for rule, (part, whole) in RULES.items())
_SIZES = f"[{', '.join(str(len(c)) for c in CUTOFFS.values())}]"
_PLACES = list(range(1, len(RULES) + 1))


def _rejects(levels: str) -> str:
    """Whether rules at these levels reject a kind of document."""
    return f"len(list_filter({_PLACES}, lambda i: {levels}[i] > 0 AND kinds.passed[i] > {_SIZES}[i] - {levels}[i])) > 0"


# Levels of the rules, by stratum. An iteration takes one rule through the cutoffs that each reject more bad documents. In phase 1 that is the
# rule whose last cutoff rejects most; it is set aside at a failure. In phase 2 the rules set aside follow in their order, up to a failure.
_LEVELS = f"""
kinds AS (SELECT coalesce(lang, chr(0) || 'null') AS s, [{_PASSED}] AS passed, count(*) FILTER (WHERE q >= 1) AS good, count(*) FILTER (WHERE q < 1) AS bad
          FROM b JOIN known USING (doc_id) WHERE NOT base_failed GROUP BY ALL),
useful AS (SELECT s, count(*) AS useful FROM (SELECT s, k, sum(bad) FILTER (WHERE passed[k] > 0) AS n FROM kinds, (SELECT unnest({_PLACES}) AS k) GROUP BY s, k) WHERE n > 0 GROUP BY s),
strata AS (SELECT s, sum(good) AS n_good, any_value(coalesce(useful, 0)) AS useful, {_PLAN.error!r} / (SELECT count(DISTINCT s) FROM kinds) AS error
           FROM kinds LEFT JOIN useful USING (s) GROUP BY s),
run AS (
  SELECT s, n_good, useful, error, 0 AS iteration, {[0] * len(RULES)} AS levels, CAST([] AS INTEGER[]) AS aside, {[0] * len(RULES)} AS best, 0 AS most, 1 AS phase, 0 AS place FROM strata
  UNION ALL
  SELECT s, n_good, useful, error, iteration + 1, CASE WHEN k IS NOT NULL AND failed IS NULL THEN last_try ELSE levels END,
         CASE WHEN phase = 1 AND failed IS NOT NULL THEN list_append(aside, k) ELSE aside END,
         CASE WHEN good_most > most THEN good_try ELSE best END, greatest(most, coalesce(good_most, 0)),
         CASE WHEN k IS NULL AND phase = 1 THEN 2 WHEN phase = 2 AND failed IS NOT NULL THEN 3 ELSE phase END,
         CASE WHEN phase = 2 OR k IS NULL THEN place + 1 ELSE place END
  FROM run LEFT JOIN (
    SELECT s AS of, k, max_by(t, l) AS last_try, min(l) FILTER (WHERE NOT ok) AS failed,
           max_by(t, l) FILTER (WHERE all_ok) AS good_try, max(bad) FILTER (WHERE all_ok) AS good_most
    FROM (SELECT *, bool_and(ok) OVER (PARTITION BY s, k ORDER BY l) AS all_ok,
                 first_value(k) OVER (PARTITION BY s ORDER BY total DESC, k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_k
          FROM (SELECT *, max(bad) OVER (PARTITION BY s, k) AS total, n_good > 0 AND
                       (CASE WHEN good >= n_good THEN 1.0 ELSE list_sum(list_transform(range(0, CAST(good AS BIGINT) + 1), lambda x: exp(
                          lgamma(n_good + 1) - lgamma(x + 1) - lgamma(n_good - x + 1) + x * ln({_PLAN.risk!r}) + (n_good - x) * ln(1 - {_PLAN.risk!r})))) END)
                       <= CASE WHEN useful = 1 THEN error ELSE error / 2 ** (len(aside) + 1) / (factorial(CAST(useful AS INTEGER)) / factorial(CAST(useful - len(aside) AS INTEGER))) END AS ok
                FROM (SELECT *, max(bad) OVER (PARTITION BY s, k ORDER BY l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
                      FROM (SELECT tried.s, k, l, any_value(t) AS t, any_value(tried.n_good) AS n_good, any_value(useful) AS useful, any_value(error) AS error, any_value(aside) AS aside,
                                   coalesce(sum(kinds.bad) FILTER (WHERE {_rejects("t")}), 0) AS bad, coalesce(sum(kinds.good) FILTER (WHERE {_rejects("t")}), 0) AS good,
                                   coalesce(sum(kinds.bad) FILTER (WHERE {_rejects("levels")}), 0) AS now
                            FROM (SELECT run.*, k, l, list_concat(list_concat(levels[:k - 1], [l]), levels[k + 1:]) AS t
                                  FROM run, (SELECT k, CAST(unnest(range(1, {_SIZES}[k] + 1)) AS INTEGER) AS l FROM (SELECT unnest({_PLACES}) AS k))
                                  WHERE l > levels[k] AND ((phase = 1 AND NOT list_contains(aside, k)) OR (phase = 2 AND aside[place] = k))) AS tried
                            JOIN kinds ON kinds.s = tried.s GROUP BY tried.s, k, l))
                WHERE bad > greatest(now, coalesce(before, 0))))
    WHERE k = first_k GROUP BY s, k) AS sequence ON run.s = sequence.of
  WHERE phase = 1 OR (phase = 2 AND place <= len(aside))),
levels AS (SELECT s, max_by(best, iteration) AS best FROM run GROUP BY s),
"""

QUALITY = rf"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM {{documents}}),
w AS (SELECT r, doc_id, lang, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM docs),
win AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + d) AS n FROM twice, (VALUES (0), (1), (2)) AS t(d) GROUP BY r),
m AS (SELECT w.r, doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
      CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
      CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
      CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper, CAST(length(regexp_replace(text, '[^!?]', '', 'g')) AS BIGINT) AS n_marks
      FROM w LEFT JOIN rep ON rep.r = w.r),
b AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
known AS (SELECT doc_id, min(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = max(quality)),
shares AS ({_RULE_ROWS.replace("FROM m", "FROM b WHERE NOT base_failed")}),
cuts(k, i, cut) AS (VALUES {_CUT_ROWS}),
{_LEVELS}
rejected AS (SELECT DISTINCT doc_id FROM shares JOIN levels ON coalesce(lang, chr(0) || 'null') = s JOIN cuts ON cuts.k = shares.k AND cuts.i = best[shares.k] WHERE share > cut)
SELECT {{result}}
"""
QUALITY_ROWS = """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_marks, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept FROM b"""

# Levels of clamping: with the sources in the order in which they reach their clamp, the first that is not clamped gives the level.
MIX = rf"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
      CAST(floor(CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) * {BUCKETS} / 4294967296.0) AS INTEGER) AS bucket
      FROM {{documents}}),
s AS (SELECT source, sum(size)::BIGINT AS source_size, CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS DOUBLE) AS weight FROM d GROUP BY source),
f AS (SELECT *, 3.0 * source_size / weight AS full_at FROM s),
o AS (SELECT *, sum(source_size) OVER () AS total, coalesce(sum(3.0 * source_size) OVER b, 0.0) AS full_before, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS weight_left
      FROM f WINDOW b AS (ORDER BY full_at, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT (total - full_before) / weight_left AS level FROM o WHERE (total - full_before) / weight_left < full_at ORDER BY full_at, source LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN source_size > 0 THEN least(3.0 * source_size, coalesce((SELECT level FROM level), 1e300) * weight) ELSE 0.0 END AS target FROM f),
e AS (SELECT *, CAST(floor(target / greatest(source_size, 1)) AS BIGINT) AS repeats FROM t),
c AS (SELECT d.source, bucket, sum(size) AS words FROM d GROUP BY d.source, bucket),
r AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY bucket) AS upto FROM c),
p AS (SELECT r.source, bucket, CASE WHEN words = 0 THEN 0.0 ELSE least(greatest((target - repeats * source_size - upto + words) / words, 0.0), 1.0) END AS part
      FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source)
SELECT {{result}}
"""
MIX_ROWS = """doc_id, size, source_size, target, repeats * size + CAST(floor(part * size + 0.5) AS BIGINT) AS taken
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.bucket = p.bucket"""

DECONTAMINATION = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM {documents}),
dw AS (SELECT r, doc_id, regexp_extract_all(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[\x00-\x2F\x3A-\x60\x7B-\x7F]', ' ', 'g'), '[^ ]+') AS w FROM docs),
bw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[\x00-\x2F\x3A-\x60\x7B-\x7F]', ' ', 'g'), '[^ ]+') AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), 10) AS n FROM bw WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
dwin AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hit AS (SELECT r, i, d.n, item FROM dwin d JOIN windows b ON d.n = b.n AND d.g = b.g),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT {result}
"""
DECONTAMINATION_ROWS = """doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, d.payload_digest, CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest AND payload_bytes >= 100
"""

LINES = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
g AS (SELECT doc_id, i, line, f.key IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM g GROUP BY doc_id
"""

NGRAMS = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM {documents}),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
r(node, seen) AS (SELECT a, a FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen),
c AS (SELECT node, min(seen) AS component FROM r GROUP BY node)
SELECT {result}
"""
NGRAMS_ROWS = """w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = w.doc_id"""

URLS = r"""
WITH h AS (SELECT page_id, url, nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '\.$', ''), '') AS host,
      to_timestamp(1672531200 + ((page_id % 63072000 + 63072000) % 63072000 * 7919 * 3607) % 63072000) AS fetched,
      list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '') AS steps FROM pages),
labels_of AS (SELECT *, string_split(host, '.') AS ls FROM h WHERE host IS NOT NULL),
keys AS (SELECT page_id, fetched, array_to_string(ls[i:], '.') AS key FROM (SELECT page_id, fetched, ls, unnest(range(1, len(ls) + 1)) AS i FROM labels_of)
         UNION SELECT page_id, fetched, host || '/' || array_to_string(steps[1:i], '/') FROM (SELECT page_id, fetched, host, steps, unnest(range(1, len(steps) + 1)) AS i FROM labels_of)),
hosts AS (SELECT DISTINCT host, md5(host) AS m FROM labels_of),
n AS (SELECT host, ('0x' || substr(m, 1, 3))::BIGINT % 300 AS a, 1 + ('0x' || substr(m, 4, 3))::BIGINT % 200 AS b, 1 + ('0x' || substr(m, 7, 3))::BIGINT % 200 AS c,
      ('0x' || substr(m, 10, 3))::BIGINT % 400 AS d FROM hosts WHERE ('0x' || substr(m, 13, 3))::BIGINT % 2 = 0),
ch AS (SELECT 'hosts' AS list, host AS key, a AS day, false AS gone, 'block' AS verdict FROM n
       UNION ALL SELECT 'hosts', host, a + b, true, 'block' FROM n UNION ALL SELECT 'hosts', host, a + b + c, false, 'block' FROM n
       UNION ALL SELECT 'domains', array_to_string(string_split(host, '.')[-3:], '.'), d, false, 'watch' FROM n
       UNION ALL SELECT 'paths', host || '/en', b + c, false, 'allow' FROM n),
last AS (SELECT list, key, day, bool_or(gone) AS gone, max(verdict) AS verdict FROM ch GROUP BY ALL),
iv AS (SELECT * FROM (SELECT *, to_timestamp(1672531200 + day * 86400) AS since, to_timestamp(1672531200 + lead(day) OVER (PARTITION BY list, key ORDER BY day) * 86400) AS until FROM last) WHERE NOT gone),
act AS (SELECT page_id, keys.key, verdict FROM keys JOIN iv ON keys.key = iv.key AND fetched >= since AND (until IS NULL OR fetched < until)),
best AS (SELECT page_id, count(*) AS n_active, arg_max(key, (length(key), key, verdict)) AS entry, arg_max(verdict, (length(key), key, verdict)) AS verdict FROM act GROUP BY page_id)
SELECT pages.page_id, coalesce(n_active, 0) AS n_active, entry, verdict, coalesce(verdict = 'block', false) AS blocked FROM pages LEFT JOIN best USING (page_id)
"""

FILTER_AUDIT = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS copy FROM d),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN copy THEN 'E' ELSE '' END AS mask,
             coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM w LEFT JOIN l USING (doc_id)),
m AS (SELECT part, mask, count(*) AS docs, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY part, mask),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM o),
g AS (SELECT m.*, filter_order, step, contains(mask, substr(filter_order, step, 1)) AS fails,
             length(translate(mask, substr(filter_order, 1, step - 1), '')) < length(mask) AS gone,
             mask = substr(filter_order, step, 1) AS alone FROM m, s),
r AS (SELECT part, filter_order, step, CAST(coalesce(sum(docs) FILTER (WHERE NOT gone AND NOT fails), 0) AS BIGINT) AS kept,
             CAST(coalesce(sum(docs) FILTER (WHERE NOT gone AND fails), 0) AS BIGINT) AS removed, CAST(coalesce(sum(docs) FILTER (WHERE gone AND fails), 0) AS BIGINT) AS redundant,
             CAST(coalesce(sum(docs) FILTER (WHERE alone), 0) AS BIGINT) AS unique_fails, CAST(coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0) AS BIGINT) AS good_lost,
             CAST(coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails), 0) AS BIGINT) AS toxic_lost FROM g GROUP BY part, filter_order, step)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)) AS BIGINT) AS shapley FROM r
"""

SQL = {
    "op1_quality_rules": QUALITY.format(documents="documents", result=QUALITY_ROWS),
    "op3_source_mix": MIX.format(documents="documents", result=MIX_ROWS),
    "op4_decontamination": DECONTAMINATION.format(documents="documents", result=DECONTAMINATION_ROWS),
    "op5_warc": WARC,
    "op6_line_dedup": LINES,
    "op7_ngram_join": NGRAMS.format(documents="documents", result=NGRAMS_ROWS),
    "op9_url_filters": URLS,
    "op13_filter_audit": FILTER_AUDIT,
}

# The pipeline: each stage's SQL over what the one before it kept.

_MIX_COPIES = rf"""d.doc_id, repeats + CASE WHEN part >= 1 OR (part > 0 AND
       floor(CAST('0x' || substr(md5('18|' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) * {BUCKETS} / 4294967296.0) / {BUCKETS}.0 < part)
       THEN 1 ELSE 0 END AS copies
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.bucket = p.bucket"""


def _jump(shards: int) -> str:
    return f"""
SELECT doc_id, shard FROM (
WITH RECURSIVE j(doc_id, state, shard, step) AS (
  SELECT DISTINCT doc_id, CAST(coalesce(doc_id, 0) AS HUGEINT), CAST(-1 AS BIGINT), CAST(0 AS BIGINT) FROM mixed
  UNION ALL
  SELECT doc_id, s, step, CAST(floor((step + 1) * (2147483648.0 / (s // 8589934592 + 1)::DOUBLE)) AS BIGINT)
  FROM (SELECT doc_id, step, (state * 2862933555777941757 + 1) % 18446744073709551616 AS s FROM j WHERE step < {shards}))
SELECT doc_id, shard FROM j WHERE step >= {shards})"""


PIPELINE = f"""
WITH good AS MATERIALIZED (SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM ({QUALITY.format(documents="documents", result=QUALITY_ROWS)}) WHERE kept)),
single AS MATERIALIZED (SELECT * FROM good WHERE doc_id IN (SELECT doc_id FROM ({NGRAMS.format(documents="good", result=NGRAMS_ROWS)}) WHERE component_id = doc_id)),
clean AS MATERIALIZED (SELECT * FROM single WHERE doc_id IN (SELECT doc_id FROM ({DECONTAMINATION.format(documents="single", result=DECONTAMINATION_ROWS)}) WHERE NOT contaminated)),
mixed AS MATERIALIZED (SELECT doc_id, unnest(range(copies)) AS copy FROM ({MIX.format(documents="clean", result=_MIX_COPIES)})),
now AS MATERIALIZED ({_jump(16)}),
grown AS MATERIALIZED ({_jump(17)})
SELECT mixed.doc_id, CAST(strlen(text) + 1 AS BIGINT) AS size, 'key' AS law, CAST(now.shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY now.shard ORDER BY mixed.doc_id, copy) - 1 AS slot, CAST(grown.shard AS INTEGER) AS grown_shard
FROM mixed JOIN clean ON clean.doc_id = mixed.doc_id JOIN now ON now.doc_id = mixed.doc_id JOIN grown ON grown.doc_id = mixed.doc_id
"""
