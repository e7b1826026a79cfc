"""DuckDB SQL for the registered queries that SQL can express."""

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"coalesce(regexp_extract_all(" + LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g
       FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS p
             FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dg AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lens WHERE len(w) >= n)),
h AS MATERIALIZED (SELECT DISTINCT doc_id, n, p, item_id FROM dg JOIN bw USING (n, g)),
hw AS (SELECT doc_id, count(DISTINCT x) AS n_hit
       FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM (SELECT DISTINCT doc_id, n, p FROM h)) GROUP BY 1),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM h) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS f FROM p WHERE n >= 100 GROUP BY 1)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN f IS NOT NULL AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f IS NOT NULL AND page_id <> f THEN f END AS refers_to
FROM p LEFT JOIN f USING (d)
"""

EMBEDDINGS = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
                   WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""

_COUNT = "len(regexp_extract_all(coalesce({0}, ''), '{1}'))"


def _mixing(rounds: int = 12, budget: float = 0.5, power: float = 0.7) -> str:
    """The rounds of raking as a chain of tables, then the capped rate from running sums."""
    steps = [f"""
d AS MATERIALIZED (
  SELECT doc_id, source, lang, {_COUNT.format("text", "[^ \t-\r]+")} AS n,
         CASE WHEN regexp_matches(text, '(?i)licen[cs]e|copyright') THEN 'legal' WHEN regexp_matches(text, '@') THEN 'contact'
              WHEN regexp_matches(text, 'https?://') THEN 'web' WHEN regexp_matches(text, '\\| .*\\| ') THEN 'table'
              ELSE 'prose' END AS topic,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents),
w0 AS MATERIALIZED (SELECT source, lang, topic, sum(n)::BIGINT AS tokens, 1.0::DOUBLE AS w FROM d GROUP BY ALL),
tot AS MATERIALIZED (SELECT sum(tokens)::DOUBLE AS t FROM w0)"""]
    for dim in ("source", "lang", "topic"):
        steps.append(f"""
t_{dim} AS MATERIALIZED (SELECT {dim}, pow(sum(tokens)::DOUBLE, {power}) / sum(pow(sum(tokens)::DOUBLE, {power})) OVER () AS share
  FROM w0 GROUP BY 1)""")
    k = 0
    for _ in range(rounds):
        for dim in ("source", "lang", "topic"):
            steps.append(f"""
w{k + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens,
  w * coalesce(share * t / nullif(sum(w * tokens) OVER (PARTITION BY w{k}.{dim}), 0), 1) AS w
  FROM w{k} JOIN t_{dim} ON w{k}.{dim} IS NOT DISTINCT FROM t_{dim}.{dim}, tot)""".replace("SELECT source, lang, topic", "SELECT " + ", ".join(f"w{k}.{c}" for c in ("source", "lang", "topic"))))
            k += 1
    steps.append(f"""
o AS (SELECT *, row_number() OVER (ORDER BY w DESC, source, lang, topic) AS i FROM w{k}),
r AS (SELECT i, w, ({budget} * t - coalesce(sum(tokens) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w * tokens) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM o, tot),
rate AS (SELECT rate FROM r WHERE rate * w <= 1 ORDER BY i LIMIT 1)""")
    return "WITH " + ",".join(steps) + f"""
SELECT doc_id, d.source, d.lang, d.topic, n::BIGINT AS n_tokens, round(w, 6) AS weight, round(least(1.0, w * rate), 6) AS probability,
       u < least(1.0, w * rate) AS sampled
FROM d JOIN w{k} AS c ON d.source IS NOT DISTINCT FROM c.source AND d.lang IS NOT DISTINCT FROM c.lang AND d.topic = c.topic, rate
"""


MIXING = _mixing()

_PIECES = "[A-Za-z]+|[0-9]|[^ \\t-\\rA-Za-z0-9]"
_CLEAN = "regexp_replace(text, '[!-/:-@\\[-`{-~]+', '', 'g')"
TOKEN_COUNTS = f"""
WITH l AS (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY 1),
d AS (SELECT source, lang, CASE WHEN quality = 0 THEN {_CLEAN} ELSE text END AS text
      FROM documents LEFT JOIN l USING (doc_id) WHERE coalesce(toxic, 0) <> 1),
c AS (SELECT source, lang, unnest([{{'t': 'words-1', 'n': {_COUNT.format("text", "[^ \\t-\\r]+")}}},
                                   {{'t': 'pieces-1', 'n': {_COUNT.format("text", _PIECES)}}}]) AS c FROM d)
SELECT source, lang, c.t AS tokenizer, count(*)::BIGINT AS n_docs, sum(c.n)::BIGINT AS n_tokens FROM c GROUP BY ALL
"""

URL_FILTERS = r"""
WITH c AS MATERIALIZED (
  SELECT page_id, url, (to_timestamp(page_id * 3600) AT TIME ZONE 'UTC')::DATE AS day,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda s: s <> '') AS seg,
         regexp_extract(url, '://[^/?#]*/([^/?#]+)', 1) AS top FROM pages),
f AS (SELECT host, min(day) AS day FROM c WHERE contains(host, 'farm') OR starts_with(host, 'blog.') GROUP BY 1),
e AS (SELECT 'tracking' AS list, host || '/' || top AS pattern, CASE WHEN max(contains(url, 'utm_')) THEN 'block' ELSE 'allow' END AS action, day
      FROM c WHERE host <> '' AND top <> '' GROUP BY host, top, day
      UNION ALL SELECT 'farms', '.' || host, 'block', day FROM f
      UNION ALL SELECT 'farms', host || '/en', 'allow', (day + 10)::DATE FROM f),
dl AS (SELECT list, pattern, day, max(action) AS action FROM e GROUP BY ALL),
v AS (SELECT *, lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS until FROM dl),
p AS (SELECT page_id, day, host AS pattern, 1 AS rank FROM c WHERE host <> ''
      UNION ALL SELECT page_id, day, '.' || array_to_string(string_split(host, '.')[i:], '.'), 0
                FROM (SELECT *, unnest(range(1, len(string_split(host, '.')))) AS i FROM c WHERE host <> '')
      UNION ALL SELECT page_id, day, host || '/' || array_to_string(seg[1:i], '/'), 2
                FROM (SELECT *, unnest(range(1, len(seg) + 1)) AS i FROM c WHERE host <> '')),
m AS (SELECT page_id, list, action, row_number() OVER (PARTITION BY page_id, list ORDER BY rank DESC, length(p.pattern) DESC, p.pattern DESC) AS k
      FROM p JOIN v ON p.pattern = v.pattern AND p.day >= v.day AND (until IS NULL OR p.day < until)),
g AS (SELECT page_id, count(*) AS n, string_agg(list, ',' ORDER BY list) FILTER (WHERE k = 1 AND action = 'block') AS blocked_by,
             max(action) FILTER (WHERE k = 1) AS decision FROM m GROUP BY 1)
SELECT page_id, coalesce(n, 0)::BIGINT AS n_active, coalesce(blocked_by, '') AS blocked_by, coalesce(decision, 'none') AS decision
FROM c LEFT JOIN g USING (page_id)
"""

_BLANK_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
# CRC-32 bit by bit over a number's decimal digits.
_CRC_DIGITS = """xor(list_reduce([(ascii(substr({0}, (j // 8 + 1)::INT, 1)) >> (j % 8)::INT) & 1 for j in range(0, 8 * length({0}))],
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::BIGINT), 4294967295::BIGINT)"""


def _periodic_runs(levels: int = 17) -> str:
    """Grams of 16, 32, ... words by doubling; neighbouring equal grams give the lags whose diagonals are searched."""
    steps = [f"""
t AS MATERIALIZED (SELECT doc_id, {_BLANK_WORDS} AS w, {_CRC_DIGITS.format("doc_id::VARCHAR")} AS h FROM documents),
g AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) ELSE 0 END AS a FROM t),
x0 AS MATERIALIZED (SELECT doc_id, unnest(w) AS w, unnest(range(0, n)) AS i FROM g),
p AS (SELECT doc_id, n, a, 1 + (n - a) // (3 + g % 8) AS p, h % 10 = 0 AS again, unnest(range(0, n)) AS i FROM g),
x AS MATERIALIZED (SELECT p.doc_id, p.n, p.i, x0.w FROM p JOIN x0 ON x0.doc_id = p.doc_id
                   AND x0.i = CASE WHEN again AND p.i >= a THEN a + (p.i - a) % p ELSE p.i END),
h0 AS (SELECT doc_id, n, i, hash(w) AS h FROM x)"""]
    found, last = [], "h0"
    for level in range(1, levels + 1):
        half, k = 1 << (level - 1), 1 << level
        low = 1 if k == 16 else half + 1  # lags of the class that grams of k words serve
        steps.append(f"""
h{level} AS MATERIALIZED (SELECT doc_id, n, i, hash(h, lead(h, {half}) OVER (PARTITION BY doc_id ORDER BY i)) AS h FROM {last}
       WHERE n >= {max(24, 3 * low) if k >= 16 else 24})""")
        last = f"h{level}"
        if k >= 16:
            found.append(f"""SELECT doc_id, lead(i) OVER (PARTITION BY doc_id, h ORDER BY i) - i AS q, {low} AS low, {k} AS high
       FROM {last} WHERE i + {k} <= n""")
    return "WITH " + ",".join(steps) + f""",
c AS MATERIALIZED (SELECT DISTINCT doc_id, q FROM ({" UNION ALL ".join(found)}) WHERE q BETWEEN low AND high),
m AS (SELECT c.doc_id, c.q, x.i FROM c JOIN x ON x.doc_id = c.doc_id JOIN x AS y ON y.doc_id = c.doc_id AND y.i = x.i + c.q WHERE x.w = y.w),
s AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l
      FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m) GROUP BY doc_id, q, island),
r AS MATERIALIZED (SELECT doc_id, s, l, min(q) AS q FROM s WHERE l >= greatest(24, 3 * q) GROUP BY doc_id, s, l),
best AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY l::DOUBLE / q DESC, s, q) = 1),
every AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS runs FROM r GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM r),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS k FROM (SELECT x.* FROM x ANTI JOIN gone USING (doc_id, i)) GROUP BY 1)
SELECT t.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length, best.q::BIGINT AS period,
       ((1000 * best.l) // best.q)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(k, '')) AS collapsed_sha256
FROM t LEFT JOIN best USING (doc_id) LEFT JOIN every USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


PERIODIC_RUNS = _periodic_runs()

# CRC-32 of whole texts, half a byte at a time; the sixteen steps of half a byte are worked out here.
_CRC_HALVES = [0] * 16
for _i in range(16):
    _c = _i
    for _ in range(4):
        _c = (_c >> 1) ^ (0xEDB88320 if _c & 1 else 0)
    _CRC_HALVES[_i] = _c
_HALF = "xor(({0}) >> 4, " + str(_CRC_HALVES) + "[(({0}) & 15) + 1])"
_CRC_TEXT = ("xor(list_reduce([('0x' || b)::BIGINT for b in regexp_extract_all(hex(encode(coalesce(text, ''))), '..')], lambda c, b: "
             + _HALF.format(_HALF.format("xor(c, b)")) + ", 4294967295::BIGINT), 4294967295::BIGINT)")

SHARDING = f"""
WITH RECURSIVE m AS MATERIALIZED (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS key,
         {_CRC_TEXT} AS crc FROM documents),
g AS MATERIALIZED (SELECT key, sum(size)::BIGINT AS b FROM m GROUP BY 1),
o AS (SELECT key, b, row_number() OVER (ORDER BY b DESC, key) - 1 AS r, sum(b) OVER () - sum(b) OVER (ORDER BY b DESC, key ROWS UNBOUNDED PRECEDING) + b AS remaining FROM g),
alone AS MATERIALIZED (SELECT key, r FROM o WHERE r < coalesce((SELECT min(r) FROM o WHERE r >= 40 OR b * (40 - r) < remaining), 1 << 30)),
rest AS MATERIALIZED (SELECT key, sum(b) OVER (ORDER BY key)::BIGINT AS p FROM g ANTI JOIN alone USING (key)),
f AS MATERIALIZED (SELECT 40 - (SELECT count(*) FROM alone) AS k, max(p) AS t FROM rest),
-- One step of filling, or one verdict on a capacity, a row.
s(lo, hi, pos, used) AS (
  SELECT ((t + k - 1) // k)::BIGINT, t, 0::BIGINT, 0::BIGINT FROM f WHERE t IS NOT NULL
  UNION ALL
  SELECT CASE WHEN pos < t AND used = k THEN (lo + hi) // 2 + 1 ELSE lo END, CASE WHEN pos = t THEN (lo + hi) // 2 ELSE hi END,
         CASE WHEN pos = t OR used = k THEN 0 ELSE coalesce(max(p), 0) END, CASE WHEN pos = t OR used = k THEN 0 ELSE used + 1 END
  FROM s JOIN f ON s.lo < s.hi LEFT JOIN rest ON p <= pos + (lo + hi) // 2 GROUP BY lo, hi, pos, used, t, k),
capacity AS MATERIALIZED (SELECT lo AS c FROM s WHERE lo = hi),
cut(shard, pos) AS (
  SELECT -1::BIGINT, 0::BIGINT FROM capacity
  UNION ALL SELECT shard + 1, max(p) FROM cut JOIN capacity ON true JOIN rest ON p <= pos + c JOIN f ON pos < t GROUP BY shard),
d AS (SELECT key, r AS shard FROM alone
      UNION ALL SELECT key, (SELECT count(*) FROM alone) + min(shard) FROM rest JOIN cut ON p <= pos GROUP BY key)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY doc_id, key) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM m JOIN d USING (key)
"""

FILTER_AUDIT = f"""
WITH l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_BLANK_WORDS} AS w FROM documents),
d AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
             + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
      FROM w LEFT JOIN l USING (doc_id)),
c AS MATERIALIZED (SELECT part, mask, good, toxic, count(*) AS n FROM d GROUP BY ALL),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, 1 << (ascii(substr(filter_order, step, 1)) - 65) AS own,
             list_sum([1 << (ascii(substr(filter_order, i::INT, 1)) - 65) for i in range(1, step + 1)])::INT AS upto
      FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o)),
r AS (SELECT part, filter_order, step, own,
             sum(n) FILTER (mask & upto = 0) AS kept, sum(n) FILTER (mask & upto = own) AS removed,
             sum(n) FILTER (mask & own = own AND mask & upto <> own) AS redundant, sum(n) FILTER (mask = own) AS unique_fails,
             sum(n) FILTER (mask & upto = own AND good) AS good_lost, sum(n) FILTER (mask & upto = own AND toxic) AS toxic_lost
      FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM r
"""
