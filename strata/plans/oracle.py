"""Expected results of ``strata.plans.queries`` as DuckDB SQL over the flat tables.

Column names and types match the Spark queries (ints stay ints, counts are BIGINT, dates
are DATE). The SQL computes each result directly, without the JSON round trip.
"""

from __future__ import annotations

_DATE_ID = "CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"


def _date_id(c: str) -> str:
    return _DATE_ID.format(c=c)


_SEGMENT = """CASE WHEN c_custkey % 7 = 0 THEN '   '
                  WHEN c_custkey % 11 = 0 THEN NULL
                  WHEN c_custkey % 13 = 0 THEN ' ' || c_mktsegment
                  ELSE c_mktsegment END"""

_EXISTING_KEYS = "SELECT c_custkey, CAST(c_custkey // 2 + 1 AS BIGINT) AS cust_key FROM customer WHERE c_custkey % 2 = 0"

_FACT_SOURCE = f"""
WITH li AS (
  SELECT l_orderkey, l_linenumber, {_date_id('l_shipdate')} AS date_id, CAST(l_shipdate AS DATE) AS full_date,
         l_extendedprice, l_discount, l_tax,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber, CAST(l_shipdate AS DATE)
                            ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS rn
  FROM lineitem),
batch AS MATERIALIZED (SELECT * FROM li WHERE rn = 1),
dim AS (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS order_key FROM orders),
cust AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS cust_key FROM customer),
src AS MATERIALIZED (
  SELECT d.order_key, c.cust_key, b.date_id, b.full_date, b.l_linenumber AS line_number, b.l_orderkey,
         b.l_extendedprice AS market_price, b.l_extendedprice * (1.0 + b.l_tax) AS highest_price,
         b.l_extendedprice * (1.0 - b.l_discount) AS lowest_price
  FROM batch b JOIN dim d ON b.l_orderkey = d.o_orderkey LEFT JOIN cust c ON d.o_custkey = c.c_custkey),
history AS MATERIALIZED (SELECT date_id, order_key, line_number FROM src WHERE l_orderkey % 2 = 0)
"""

_CARD_KEYS = """
ck AS (SELECT 'c' || CAST(p_partkey AS VARCHAR) AS card_id, row_number() OVER (ORDER BY 'c' || CAST(p_partkey AS VARCHAR))
              AS card_key, p_brand, p_partkey, p_type, p_size, p_name FROM part),
sk AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS set_key FROM (SELECT DISTINCT p_brand FROM part))"""

ORACLE_SQL: dict[str, str] = {
    "json_typed_fields": """
SELECT event_type, count(*) AS n_events, count(k) AS n_k, CAST(sum(k) AS BIGINT) AS sum_k, max(k) AS max_k,
       round(sum(CAST(round(value * 100) AS BIGINT)) / count(*) / 100.0, 6) AS avg_value
FROM (SELECT event_type, value, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
GROUP BY event_type""",

    "explode_objects": """
SELECT l_orderkey, l_linenumber, 'quantity' AS facet_type, l_quantity AS facet_value FROM lineitem WHERE l_quantity > 0
UNION ALL
SELECT l_orderkey, l_linenumber, 'discount', l_discount FROM lineitem WHERE l_discount > 0
UNION ALL
SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem WHERE l_tax > 0""",

    "explode_scalars": """
SELECT p_partkey, CAST(u.pos - 1 AS INTEGER) AS word_pos, lower(u.w) AS word
FROM part, unnest(string_split(upper(p_name), ' ')) WITH ORDINALITY AS u(w, pos)""",

    "value_lookup": """
SELECT DISTINCT p_partkey FROM part, unnest(string_split(lower(p_name), ' ')) AS u(w) WHERE w = 'widget'""",

    "explode_entries": f"""
WITH b AS (SELECT l_orderkey, l_linenumber, {_date_id('l_shipdate')} AS date_id, l_extendedprice, l_discount, l_tax,
                  l_extendedprice * (1.0 - l_discount) AS net FROM lineitem),
e AS (
  SELECT l_orderkey, l_linenumber, 'gross' AS price_kind, date_id, net AS low, l_extendedprice AS high,
         CASE WHEN l_tax > 0 THEN l_extendedprice * (1.0 + l_tax) END AS market FROM b
  UNION ALL
  SELECT l_orderkey, l_linenumber, 'net', date_id, net * (1.0 - l_tax), net,
         CASE WHEN l_discount > 0 THEN net END FROM b)
SELECT l_orderkey, l_linenumber, price_kind, date_id, coalesce(market, (high + low) / 2.0) AS market_price,
       high AS highest_price, low AS lowest_price FROM e""",

    "nested_two_level": """
WITH base AS (SELECT p_partkey, p_type, p_brand, p_size, string_split(upper(p_name), ' ') AS w FROM part),
attacks AS (
  SELECT p_partkey AS card_id, p_type AS aname, list_concat(w, w[1:1]) AS cost, p_size AS cec,
         CASE WHEN p_size % 5 = 0 THEN '  ' ELSE CAST(p_size AS VARCHAR) END AS damage, p_brand AS txt FROM base
  UNION ALL
  SELECT p_partkey, p_brand, w[1:(p_size % 3)], p_size * 2, NULL, NULL FROM base),
rows AS (SELECT card_id, aname, unnest(cost) AS energy, cec, damage, txt FROM attacks)
SELECT card_id, lower(aname) AS attack_name, lower(energy) AS energy_needed,
       count(energy) OVER (PARTITION BY card_id, aname, energy) AS energy_amount_needed,
       cec AS total_energy_cost, coalesce(nullif(trim(damage), ''), 'n/a') AS damage,
       coalesce(nullif(trim(txt), ''), 'n/a') AS description
FROM rows""",

    "flatten_wide": """
SELECT l_orderkey, l_linenumber, l_quantity AS quantity_total, l_extendedprice AS extended_price,
       l_discount AS discount_rate, l_tax AS tax_rate, l_extendedprice * (1.0 - l_discount) AS net_price,
       l_extendedprice * (1.0 - l_discount) * (1.0 + l_tax) AS gross_price
FROM lineitem""",

    "blank_to_default": f"""
SELECT c_custkey, coalesce(nullif(trim({_SEGMENT}), ''), 'n/a') AS segment FROM customer""",

    "null_default": f"""
SELECT c_custkey, lower(coalesce({_SEGMENT}, 'special')) AS segment FROM customer""",

    "digits_from_code": """
WITH c AS (
  SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN p_type
                         WHEN p_partkey % 17 = 0 THEN '1' || lower(substr(p_type, 1, 1)) || '2'
                         WHEN p_partkey % 19 = 0 THEN p_brand || '!'
                         WHEN p_partkey % 23 = 0 THEN NULL
                         ELSE p_brand END AS code
  FROM part),
s AS (SELECT p_partkey, code, trim(translate(lower(code), 'abcdefghijklmnopqrstuvwxyz!?#', '                             ')) AS t FROM c)
SELECT p_partkey, code, CASE WHEN code IS NULL THEN NULL WHEN t = '' THEN 0 ELSE TRY_CAST(t AS INTEGER) END
       AS set_card_number FROM s""",

    "repair_timestamp": """
WITH t AS (
  SELECT o_orderkey, strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y/%m/%d %H:%M:%S') AS txt,
         strftime(o_orderdate, '%Y/%m/%d') AS rel FROM orders),
b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN substr(txt, 2) ELSE txt END AS update_text, rel FROM t)
SELECT o_orderkey, update_text,
       strptime(CASE WHEN length(rtrim(update_text)) <> 19 THEN '2' || update_text ELSE update_text END,
                '%Y/%m/%d %H:%M:%S') AS set_update_date,
       CAST(strptime(rel, '%Y/%m/%d') AS DATE) AS set_release_date
FROM b""",

    "presence_label": """
SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'Standard+'
                      WHEN l.toxic = 0 THEN 'Expanded+'
                      WHEN l.quality IS NOT NULL THEN 'Unlimited Only'
                      ELSE 'n/a' END AS legality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",

    "fresh_rows": """
SELECT event_id, event_type, CAST(ts AS DATE) AS event_day FROM events
WHERE CAST(CAST(ts AS DATE) AS TIMESTAMP) > TIMESTAMP '2024-02-05 12:00:00' - INTERVAL 20 DAY""",

    "local_day": f"""
SELECT event_id, CAST(ts - INTERVAL 5 HOUR AS DATE) AS local_day,
       {_date_id('CAST(ts - INTERVAL 5 HOUR AS DATE)')} AS local_date_id FROM events""",

    "case_insensitive_match": """
SELECT upper(c_mktsegment) AS segment, count(*) AS n_customers FROM customer GROUP BY upper(c_mktsegment)""",

    "date_dimension": f"""
WITH span AS (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem),
days AS (SELECT CAST(d AS DATE) AS full_date
         FROM span, generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY) AS t(d))
SELECT {_date_id('full_date')} AS date_id, full_date, CAST(day(full_date) AS INTEGER) AS day_number,
       CAST(month(full_date) AS INTEGER) AS month_number, monthname(full_date) AS month_name,
       CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(year(full_date) AS INTEGER) AS year_number,
       dayname(full_date) AS day_of_week_name, dayofweek(full_date) IN (0, 6) AS is_weekend,
       last_day(full_date) = full_date AS is_month_end
FROM days""",

    "hierarchy_tier": """
WITH RECURSIVE nodes AS (
  SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS card_name,
         CASE WHEN p_partkey = 0 THEN NULL
              WHEN p_size = 50 THEN 'x' || CAST(p_partkey AS VARCHAR)
              ELSE CAST(p_partkey // 10 AS VARCHAR) END AS evolves_from
  FROM part),
ev(card_name, tier) AS (
  SELECT card_name, 1 FROM nodes WHERE evolves_from IS NULL
  UNION ALL
  SELECT c.card_name, e.tier + 1 FROM nodes c JOIN ev e ON c.evolves_from = e.card_name),
best AS (SELECT card_name, CAST(min(tier) AS INTEGER) AS tier FROM ev GROUP BY card_name)
SELECT p.p_partkey, CAST(p.p_partkey AS VARCHAR) AS card_name, b.tier AS evolution_tier
FROM part p LEFT JOIN best b ON CAST(p.p_partkey AS VARCHAR) = b.card_name""",

    "hierarchy_delta": """
WITH RECURSIVE nodes AS (
  SELECT CAST(p_partkey AS VARCHAR) AS card_name,
         CASE WHEN p_partkey % 13 = 5 THEN NULL
              WHEN p_partkey % 17 = 4 THEN 'x' || CAST(p_partkey AS VARCHAR)
              WHEN p_partkey % 11 = 3 THEN CAST(p_partkey // 100 AS VARCHAR)
              WHEN p_partkey = 0 THEN NULL
              WHEN p_size = 50 THEN 'x' || CAST(p_partkey AS VARCHAR)
              ELSE CAST(p_partkey // 10 AS VARCHAR) END AS evolves_from
  FROM part
  UNION SELECT CAST(p_partkey AS VARCHAR), CAST(p_partkey // 3 AS VARCHAR) FROM part WHERE p_partkey % 19 = 6),
ev(card_name, tier) AS (
  SELECT card_name, 1 FROM nodes WHERE evolves_from IS NULL
  UNION
  SELECT c.card_name, e.tier + 1 FROM nodes c JOIN ev e ON c.evolves_from = e.card_name AND c.evolves_from <> c.card_name)
SELECT card_name, CAST(min(tier) AS INTEGER) AS evolution_tier FROM ev GROUP BY card_name""",

    "lowest_rank": """
SELECT p_brand, p_partkey, p_retailprice FROM (
  SELECT p_brand, p_partkey, p_retailprice, rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice) AS r FROM part)
WHERE r = 1""",

    "row_number_latest": """
SELECT o_custkey, o_orderkey, o_orderdate,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_seq
FROM orders""",

    "keep_latest": """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""",

    "list_per_key": """
SELECT l_orderkey, string_agg(l_returnflag, ', ' ORDER BY l_linenumber, l_returnflag) AS flag_list FROM lineitem GROUP BY l_orderkey""",

    "flat_lists": """
WITH r AS (SELECT l_suppkey AS k, l_returnflag, l_linestatus, p_type, year(l_shipdate) AS y,
                  CASE WHEN l_suppkey % 3 <> 0 THEN o_orderstatus END AS os
           FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN orders ON l_orderkey = o_orderkey),
g AS (SELECT k, list_sort(list(DISTINCT l_returnflag)) AS f, list_sort(list(DISTINCT l_linestatus)) AS s,
             list_sort(list(DISTINCT p_type) FILTER (WHERE p_type IS NOT NULL)) AS t, list_sort(list(DISTINCT y)) AS y,
             list_sort(list(DISTINCT os) FILTER (WHERE os IS NOT NULL)) AS o FROM r GROUP BY k)
SELECT s_suppkey, s_name, coalesce(array_to_string(f, ', '), 'n/a') AS returnflag_list,
       coalesce(array_to_string(s, ', '), 'n/a') AS status_list, coalesce(array_to_string(t, ', '), 'n/a') AS type_list,
       coalesce(array_to_string(y, ', '), 'n/a') AS year_list, coalesce(array_to_string(o, ', '), 'n/a') AS order_status_list
FROM supplier LEFT JOIN g ON k = s_suppkey""",

    "child_counts": """
SELECT o.o_orderkey, coalesce(c.np, 0) AS number_of_parts, coalesce(c.nl, 0) AS number_of_lines
FROM orders o LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_partkey) AS np, count(*) AS nl
                         FROM lineitem GROUP BY l_orderkey) c ON o.o_orderkey = c.l_orderkey""",

    "surrogate_keys": f"""
WITH old AS ({_EXISTING_KEYS}),
mx AS (SELECT max(cust_key) AS m FROM old)
SELECT c_custkey, cust_key FROM old
UNION ALL
SELECT c.c_custkey, mx.m + row_number() OVER (ORDER BY c.c_custkey) AS cust_key
FROM customer c, mx WHERE c.c_custkey NOT IN (SELECT c_custkey FROM old)""",

    "scd1_merge": f"""
WITH keys AS ({_EXISTING_KEYS}),
tgt AS (SELECT k.cust_key, c.c_custkey, c.c_name, c.c_acctbal - 100.0 AS c_acctbal, c.c_mktsegment
        FROM keys k JOIN customer c ON k.c_custkey = c.c_custkey),
src AS (SELECT c_custkey, c_name, c_acctbal,
               CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
        FROM customer WHERE c_nationkey <> 0),
mx AS (SELECT max(cust_key) AS m FROM tgt)
SELECT t.cust_key, s.c_custkey, s.c_name, s.c_acctbal, s.c_mktsegment FROM tgt t JOIN src s ON t.c_custkey = s.c_custkey
UNION ALL
SELECT t.cust_key, t.c_custkey, t.c_name, t.c_acctbal, t.c_mktsegment FROM tgt t
WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.c_custkey = t.c_custkey)
UNION ALL
SELECT mx.m + row_number() OVER (ORDER BY s.c_custkey), s.c_custkey, s.c_name, s.c_acctbal, s.c_mktsegment
FROM src s, mx WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.c_custkey = s.c_custkey)""",

    # A row keeps the time at which its values last changed.
    "scd1_bucketed": """
WITH a AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal - 100.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment,
                  row_number() OVER (ORDER BY c_custkey) AS cust_key FROM customer WHERE c_custkey % 2 = 0),
b AS (SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
      FROM customer WHERE c_nationkey <> 0),
n AS (SELECT b.*, (SELECT max(cust_key) FROM a) + row_number() OVER (ORDER BY c_custkey) AS cust_key
      FROM b WHERE c_custkey NOT IN (SELECT c_custkey FROM a))
SELECT a.cust_key, a.c_custkey, CASE WHEN b.c_custkey IS NULL THEN a.c_name ELSE b.c_name END AS c_name,
       CASE WHEN b.c_custkey IS NULL THEN a.c_acctbal ELSE b.c_acctbal END AS c_acctbal,
       CASE WHEN b.c_custkey IS NULL THEN a.c_mktsegment ELSE b.c_mktsegment END AS c_mktsegment,
       CASE WHEN b.c_custkey IS NOT NULL AND (a.c_acctbal <> b.c_acctbal OR a.c_mktsegment IS DISTINCT FROM b.c_mktsegment)
            THEN TIMESTAMP '2024-02-06 12:00:00' ELSE TIMESTAMP '2024-02-05 12:00:00' END AS load_time_stamp
FROM a LEFT JOIN b USING (c_custkey)
UNION ALL SELECT cust_key, c_custkey, c_name, c_acctbal, c_mktsegment, TIMESTAMP '2024-02-06 12:00:00' FROM n""",

    "incremental_fact": _FACT_SOURCE + """
SELECT order_key, cust_key, date_id, full_date, line_number, market_price, highest_price, lowest_price
FROM src ANTI JOIN history USING (date_id, order_key, line_number)""",

    "fact_point_lookup": f"""
SELECT l_partkey AS card_key, {_date_id('l_shipdate')} AS date_id, l_orderkey AS offer, l_linenumber AS line, l_extendedprice AS market_price
FROM lineitem WHERE l_partkey = 7 OR (l_partkey IN (11, 12) AND {_date_id('l_shipdate')} <= 20231231)""",

    "unique_violations": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",

    "null_violations": """
WITH t AS (SELECT l_orderkey, l_linenumber,
                  CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
                  CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE l_quantity END AS l_quantity FROM lineitem)
SELECT l_orderkey, l_linenumber,
       concat_ws(',', CASE WHEN l_returnflag IS NULL THEN 'l_returnflag' END,
                      CASE WHEN l_quantity IS NULL THEN 'l_quantity' END) AS null_columns
FROM t WHERE l_returnflag IS NULL OR l_quantity IS NULL""",

    "length_violations": """
SELECT p_partkey, p_name, p_type,
       concat_ws(',', CASE WHEN length(p_name) > 10 THEN 'p_name' END,
                      CASE WHEN length(p_type) > 6 THEN 'p_type' END) AS too_long
FROM part WHERE length(p_name) > 10 OR length(p_type) > 6""",

    "cast_rejects": """
WITH c AS (
  SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN p_type
                         WHEN p_partkey % 17 = 0 THEN '1' || lower(substr(p_type, 1, 1)) || '2'
                         WHEN p_partkey % 19 = 0 THEN p_brand || '!'
                         WHEN p_partkey % 23 = 0 THEN NULL
                         ELSE p_brand END AS code
  FROM part),
s AS (SELECT p_partkey, code, trim(translate(lower(code), 'abcdefghijklmnopqrstuvwxyz!?#', '                             ')) AS t FROM c)
SELECT p_partkey, code FROM s WHERE code IS NOT NULL AND t <> '' AND TRY_CAST(t AS INTEGER) IS NULL""",

    "profile": f"""
WITH t AS (SELECT c_name, {_SEGMENT} AS c_mktsegment FROM customer)
SELECT 'c_name' AS column_name, count(*) AS n_rows, CAST(count_if(c_name IS NULL) AS BIGINT) AS n_null,
       CAST(count_if(trim(c_name) <> c_name) AS BIGINT) AS n_untrimmed,
       CAST(count_if(trim(c_name) = '') AS BIGINT) AS n_blank FROM t
UNION ALL
SELECT 'c_mktsegment', count(*), CAST(count_if(c_mktsegment IS NULL) AS BIGINT),
       CAST(count_if(trim(c_mktsegment) <> c_mktsegment) AS BIGINT), CAST(count_if(trim(c_mktsegment) = '') AS BIGINT)
FROM t""",

    "snapshot_restore": """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",

    "ordered_listing": """
SELECT n.n_name, s.s_suppkey, s.s_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
ORDER BY n.n_name, s.s_suppkey""",

    "distinct_pairs": """
SELECT DISTINCT n.n_name, n.n_regionkey FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",

    "landing_dedupe": """
SELECT event_id, ts, user_id, event_type, value, props FROM events""",

    "card_load_fact": f"""
WITH agg AS (SELECT l_partkey, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n,
                    max(l_discount) AS md, min(l_tax) AS tlo, max(l_tax) AS thi, min(l_quantity) AS qmin
             FROM lineitem GROUP BY l_partkey),
{_CARD_KEYS},
tcg AS (SELECT p.p_partkey, CAST(DATE '2026-01-20' - CAST(p.p_partkey % 30 AS INTEGER) AS DATE) AS upd, a.*
        FROM part p JOIN agg a ON a.l_partkey = p.p_partkey WHERE p.p_partkey % 30 < 20),
r AS (SELECT p_partkey, upd, 'normal' AS finish, CASE WHEN n % 2 = 0 THEN md * 100.0 END AS market, hi AS high,
             lo AS low FROM tcg
      UNION ALL
      SELECT p_partkey, upd, 'holofoil', qmin, thi, tlo FROM tcg)
SELECT ck.card_key, sk.set_key, {_date_id('r.upd')} AS date_id, r.upd AS full_date, r.finish AS printing_finish_rarity,
       coalesce(r.market, (r.high + r.low) / 2.0) AS market_price, r.high AS highest_price, r.low AS lowest_price,
       TIMESTAMP '2026-01-20 12:00:00' AS log_created
FROM r JOIN ck ON ck.p_partkey = r.p_partkey JOIN sk ON sk.p_brand = ck.p_brand""",

    "card_load_dims": f"""
WITH RECURSIVE nodes AS (
  SELECT DISTINCT 'n' || CAST(p_partkey AS VARCHAR) AS name,
         CASE WHEN p_partkey = 0 THEN NULL
              WHEN p_size = 50 THEN 'x' || CAST(p_partkey AS VARCHAR)
              ELSE 'n' || CAST(p_partkey // 10 AS VARCHAR) END AS parent
  FROM part),
ev(name, tier) AS (
  SELECT name, 1 FROM nodes WHERE parent IS NULL
  UNION ALL
  SELECT c.name, e.tier + 1 FROM nodes c JOIN ev e ON c.parent = e.name),
best AS (SELECT name, CAST(min(tier) AS INTEGER) AS tier FROM ev GROUP BY name),
{_CARD_KEYS}
SELECT ck.card_key, sk.set_key, ck.card_id, 'n' || CAST(ck.p_partkey AS VARCHAR) AS card_name,
       lower(ck.p_type) AS supertype, b.tier AS evolution_tier,
       'artist ' || CAST(ck.p_partkey % 5 AS VARCHAR) AS artist,
       CASE WHEN ck.p_partkey % 9 = 0 THEN 'special' ELSE lower(ck.p_type) END AS set_card_rarity,
       CAST(ck.p_size AS INTEGER) AS set_card_number,
       CASE WHEN ck.p_size > 40 THEN 'Standard+' WHEN ck.p_size > 20 THEN 'Expanded+' ELSE 'Unlimited Only' END
         AS legality,
       CAST(1 AS INTEGER) AS number_of_attacks,
       CAST(CASE WHEN ck.p_size % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS number_of_abilities,
       CAST(ck.p_size * 10 AS INTEGER) AS hp
FROM ck JOIN sk ON sk.p_brand = ck.p_brand LEFT JOIN best b ON b.name = 'n' || CAST(ck.p_partkey AS VARCHAR)""",

    "card_load_extras": f"""
WITH {_CARD_KEYS.strip()}
SELECT ck.card_key, lower(ck.p_type) AS subtype_list,
       lower(split_part(ck.p_name, ' ', 1)) || ', ' || lower(split_part(ck.p_name, ' ', 2)) AS type_list,
       CASE WHEN ck.p_size % 2 = 1 THEN lower(ck.p_brand) ELSE 'n/a' END AS resistances_list,
       lower(split_part(ck.p_name, ' ', 1)) AS weaknesses_list,
       CAST(ck.p_partkey % 1000 AS VARCHAR) AS pokedex_list,
       'https://img.example/c' || CAST(ck.p_partkey AS VARCHAR) || '.png' AS small_image_url,
       'https://img.example/c' || CAST(ck.p_partkey AS VARCHAR) || '_hires.png' AS large_image_url
FROM ck""",

    "silver_delta": """
WITH d AS (SELECT p_partkey, p_type, p_name, p_size, p_brand FROM part WHERE p_partkey % 17 <> 3
           UNION ALL SELECT p_partkey + 1000000000, p_type, p_name, p_size, p_brand FROM part WHERE p_partkey % 19 = 5)
SELECT 'c' || CAST(p_partkey AS VARCHAR) AS card_id, lower(p_type) AS subtype_list,
       lower(split_part(p_name, ' ', 1)) || ', ' || lower(split_part(p_name, ' ', 2)) AS type_list,
       lower(split_part(p_name, ' ', 1)) AS weaknesses_list,
       CASE WHEN p_size % 2 = 1 THEN lower(p_brand) ELSE 'n/a' END AS resistances_list,
       CAST(p_partkey % 1000 AS VARCHAR) AS pokedex_list FROM d""",

    "card_day2_dims": f"""
WITH {_CARD_KEYS.strip()},
n AS (SELECT 'c' || CAST(p_partkey + 1000000000 AS VARCHAR) AS card_id, p_brand, p_size FROM part WHERE p_partkey % 19 = 5),
d AS (SELECT card_key, card_id, p_brand, p_size, CASE WHEN p_partkey % 17 = 3 THEN TIMESTAMP '2026-01-20 12:00:00'
             ELSE TIMESTAMP '2026-01-21 12:00:00' END AS load_time_stamp FROM ck
      UNION ALL
      SELECT (SELECT max(card_key) FROM ck) + row_number() OVER (ORDER BY card_id), card_id, p_brand, p_size,
             TIMESTAMP '2026-01-21 12:00:00' FROM n)
SELECT card_key, set_key, card_id, CAST(p_size AS INTEGER) AS set_card_number,
       CAST(CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS number_of_abilities, load_time_stamp
FROM d JOIN sk USING (p_brand)""",

    "card_day2_sets": f"""
WITH {_CARD_KEYS.strip()},
d AS (SELECT p_brand, p_partkey % 60 AS m FROM part WHERE p_partkey % 17 <> 3
      UNION ALL SELECT p_brand, (p_partkey + 1000000000) % 60 FROM part WHERE p_partkey % 19 = 5),
u AS (SELECT p_brand, min(m) AS m, CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS b FROM d GROUP BY p_brand)
SELECT set_key, p_brand AS set_id, lower(p_brand) || ' set' AS set_name, 'series ' || CAST(b % 3 AS VARCHAR) AS set_series,
       b AS set_total_printed, CAST(b + 1 AS INTEGER) AS set_total_cards, make_date(2000 + b % 25, 1, 1) AS set_release_date,
       TIMESTAMP '2001-02-03 04:00:00' + to_minutes(m) AS set_update_date, TIMESTAMP '2026-01-21 12:00:00' AS load_time_stamp
FROM sk JOIN u USING (p_brand)""",

    "card_day2_fact": f"""
WITH {_CARD_KEYS.strip()},
agg AS (SELECT l_partkey, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n, max(l_discount) AS md,
               min(l_quantity) AS qmin FROM lineitem GROUP BY l_partkey),
t AS (SELECT p_partkey AS k, DATE '2026-01-20' AS day, TIMESTAMP '2026-01-20 12:00:00' AS log_created FROM part
      UNION ALL
      SELECT p_partkey, DATE '2026-01-21', TIMESTAMP '2026-01-21 12:00:00' FROM part WHERE p_partkey % 17 <> 3 AND p_partkey % 4 <> 0),
r AS (SELECT k, CAST(day - CAST(k % 30 AS INTEGER) AS DATE) AS upd, log_created, a.* FROM t JOIN agg a ON a.l_partkey = k
      WHERE k % 30 < 20)
SELECT card_key, {_date_id('upd')} AS date_id, 'normal' AS printing_finish_rarity,
       CASE WHEN n % 2 = 0 THEN md * 100.0 ELSE (hi + lo) / 2.0 END AS market_price, log_created
FROM r JOIN ck ON ck.p_partkey = k
UNION ALL
SELECT card_key, {_date_id('upd')}, 'holofoil', qmin, log_created FROM r JOIN ck ON ck.p_partkey = k""",

    "rerun_idempotent": """
WITH k AS (SELECT DISTINCT l_partkey AS k FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_partkey % 30 < 20)
SELECT 'fact' AS what, f AS value, count(*) AS n FROM k, (VALUES ('normal'), ('holofoil')) AS t(f) GROUP BY f
UNION ALL
SELECT 'cast_rejects', 'seventy', count(*) FROM part WHERE p_size = 7 HAVING count(*) > 0""",

    "card_retreat_cost": """
SELECT 'c' || CAST(p_partkey AS VARCHAR) AS card_id, lower(split_part(p_name, ' ', 2)) AS energy_type_to_retreat,
       CAST(i AS INTEGER) AS position
FROM (SELECT *, unnest(range(0, p_size % 4)) AS i FROM part)""",

    "mkt_cardmarket": """
SELECT 'c' || CAST(p_partkey AS VARCHAR) AS card_id, CAST(DATE '2026-01-20' - CAST(p_partkey % 30 AS INTEGER) AS DATE) AS cardmarket_updated_at,
       p_retailprice AS average_sell_price, p_retailprice / 2.0 AS low_price, CAST(NULL AS DOUBLE) AS trend_price,
       CAST(NULL AS DOUBLE) AS avg_30, 'https://market.example/c' || CAST(p_partkey AS VARCHAR) AS card_url
FROM part""",

    "variant_prices": f"""
WITH agg AS (SELECT l_partkey, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n, max(l_discount) AS md,
                    min(l_tax) AS tlo, max(l_tax) AS thi, min(l_quantity) AS qmin FROM lineitem GROUP BY l_partkey),
r AS (SELECT p_partkey, CAST(DATE '2026-01-20' - CAST(p_partkey % 30 AS INTEGER) AS DATE) AS upd, a.* FROM part JOIN agg a ON l_partkey = p_partkey)
SELECT 'c' || CAST(p_partkey AS VARCHAR) AS card_id, 'normal' AS printing_finish_rarity, {_date_id('upd')} AS date_id,
       CASE WHEN n % 2 = 0 THEN md * 100.0 ELSE (hi + lo) / 2.0 END AS market_price, hi AS highest_price, lo AS lowest_price FROM r
UNION ALL SELECT 'c' || CAST(p_partkey AS VARCHAR), 'holofoil', {_date_id('upd')}, qmin, thi, tlo FROM r""",

    "profile_sketch": f"""
WITH t AS (SELECT c_name, {_SEGMENT} AS c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 3 < 2)
SELECT column_name, count(*) AS n_rows, CAST(count_if(v IS NULL) AS BIGINT) AS n_null, CAST(count_if(trim(v) <> v) AS BIGINT) AS n_untrimmed,
       CAST(count_if(trim(v) = '') AS BIGINT) AS n_blank, max(length(v)) AS longest
FROM (SELECT 'c_name' AS column_name, c_name AS v FROM t UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM t
      UNION ALL SELECT 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM t) GROUP BY column_name""",

    "json_malformed": """
WITH t AS (SELECT event_id, event_type, '{"event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type || '"}' AS s FROM events)
SELECT CASE WHEN event_id % 50 <> 7 THEN event_id END AS event_id, CASE WHEN event_id % 50 <> 7 THEN event_type END AS event_type,
       CASE WHEN event_id % 50 = 7 THEN substr(s, 1, length(s) - 3) END AS damaged FROM t""",

    "dated_documents": """
SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name || ' × é ✓' AS r_name, CAST(DATE '2026-01-20' + CAST(r_regionkey AS INTEGER) AS DATE) AS day FROM region""",

    "run_audit": """
SELECT step, 'succeeded' AS status, true AS timed, true AS in_order FROM (SELECT unnest([
  'bronze', 'silver', 'gold', 'quality', 'quality.casts', 'quality.cast_rejects', 'quality.length_violations',
  'silver.card_attacks', 'silver.card_weaknesses', 'silver.card_abilities', 'silver.card_resistances', 'silver.card_retreat_cost',
  'silver.card_subtypes', 'silver.card_types', 'silver.card_set', 'silver.card_national_pokedex_numbers', 'silver.card_legalities',
  'silver.card_images', 'silver.mkt_tcgplayer', 'silver.mkt_cardmarket', 'silver.card_main_info', 'silver.card_extras_flattened',
  'gold.dim_card_sets', 'gold.dim_dates', 'gold.dim_cards', 'gold.dim_cards_extra_info', 'gold.fact_rejects',
  'gold.fact_hst_tcg_data']) AS step)""",

    "elapsed_seconds": "SELECT event_id, date_diff('second', date_trunc('day', ts), date_trunc('second', ts)) AS seconds FROM events",

    "hierarchy_deep": """
SELECT 'n' || CAST(p_partkey AS VARCHAR) AS name, CAST(p_partkey + 1 AS INTEGER) AS tier FROM part""",

    "json_split_array": "SELECT doc_id, text, lang, source, n_chars FROM documents",

    # An item that two pages hold is taken from the later one, where it comes first.
    "paged_source": """
SELECT event_id, ts, user_id, event_type, value, props,
       CAST(CASE WHEN event_id % 250 >= 240 THEN event_id // 250 + 1 ELSE event_id // 250 END AS BIGINT) AS page,
       CAST(CASE WHEN event_id % 250 >= 240 THEN event_id % 250 - 240
                 WHEN event_id >= 250 THEN event_id % 250 + 10 ELSE event_id END AS INTEGER) AS position
FROM events""",

    "stream_latest_price": """
SELECT user_id, event_type, day, value FROM (
  SELECT user_id, event_type, CAST(ts AS DATE) AS day, value,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE) DESC, value DESC) AS r FROM events)
WHERE r = 1 AND day > (SELECT max(CAST(ts AS DATE)) FROM events) - 5""",

    "stream_daily": f"""
SELECT event_id, {_date_id('ts')} AS date_id, event_type, value FROM events""",
}
