"""DuckDB SQL equal in result to each driver query (same column names/types).

Notes on dialect: DuckDB's integer ``sum`` is HUGEINT and ``year``/ranking
functions are BIGINT, so they are cast to Spark's ``bigint``/``int``. Its
default NULL order is NULLS LAST, which matches Spark for DESC sorts.
"""

_LAYOFFS_RAW = """
j AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
raw0 AS (
  SELECT
    CASE WHEN o_orderpriority = '1-URGENT' THEN ' ' || c_name ELSE c_name END AS company,
    'city' || CAST(c_nationkey AS VARCHAR) AS location,
    CASE WHEN o_orderstatus = 'P' THEN ''
         WHEN c_mktsegment = 'MACHINERY' THEN 'Crypto' || o_orderstatus
         ELSE c_mktsegment END AS industry,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL
         ELSE CAST(floor(o_totalprice / 1000) AS INTEGER) END AS total_laid_off,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN NULL
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '1'
         WHEN o_orderpriority = '3-MEDIUM' THEN '1.0'
         ELSE '0.5' END AS percentage_laid_off,
    strftime(o_orderdate, '%-m/%-d/%Y') AS date,
    o_orderpriority AS stage,
    CASE WHEN c_nationkey < 3 THEN 'United States.'
         WHEN c_nationkey < 6 THEN 'United States'
         ELSE 'Nation' || CAST(c_nationkey AS VARCHAR) || '.' END AS country,
    CAST(floor(c_acctbal) AS INTEGER) AS funds_raised_millions
  FROM j),
raw AS (SELECT * FROM raw0
        UNION ALL
        SELECT * FROM raw0 WHERE stage = '2-HIGH' AND industry = 'BUILDING')"""

_LAYOFFS_CLEAN = _LAYOFFS_RAW + """,
dedup AS (SELECT DISTINCT * FROM raw),
std AS (
  SELECT trim(company) AS company, location,
         CASE WHEN industry LIKE 'Crypto%' THEN 'Crypto' ELSE industry END AS industry,
         total_laid_off, percentage_laid_off,
         CAST(try_strptime(date, '%m/%d/%Y') AS DATE) AS date, stage,
         CASE WHEN country LIKE 'United States%' THEN rtrim(country, '.') ELSE country END
           AS country,
         funds_raised_millions
  FROM dedup),
nb AS (
  SELECT company, location, nullif(industry, '') AS industry, total_laid_off,
         percentage_laid_off, date, stage, country, funds_raised_millions
  FROM std),
donors AS (
  SELECT company AS donor_company, min(industry) AS donor_industry
  FROM nb WHERE company IS NOT NULL AND industry IS NOT NULL GROUP BY company),
filled AS (
  SELECT nb.company, nb.location, coalesce(nb.industry, donors.donor_industry) AS industry,
         nb.total_laid_off, nb.percentage_laid_off, nb.date, nb.stage, nb.country,
         nb.funds_raised_millions
  FROM nb LEFT JOIN donors ON nb.company = donors.donor_company),
clean AS (
  SELECT * FROM filled WHERE NOT (total_laid_off IS NULL AND percentage_laid_off IS NULL))"""

_MONTHS = """
SELECT strftime(l_shipdate, '%Y-%m') AS month,
       CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS {out}
FROM lineitem WHERE l_shipdate IS NOT NULL
GROUP BY 1"""

_SUPPLIER_YEAR = """
SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_quantity
FROM lineitem GROUP BY l_suppkey, year(l_shipdate)"""

_EVENT_FLAT = """
SELECT event_id AS id, ts AS event_time, user_id AS user_key, event_type AS kind,
       value AS amount, props
FROM events"""

ORACLE_SQL: dict[str, str] = {
    "stage_copy": "SELECT * FROM part",
    "stage_numbered": """
SELECT doc_id, text, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) t
WHERE rn = 1""",
    "dedup_documents": """
SELECT text, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text, lang, source ORDER BY doc_id) AS rn
  FROM documents) t
WHERE rn = 1""",
    "dedup_text_lang": "SELECT DISTINCT text, lang FROM documents",
    "dedup_orders": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority
                               ORDER BY o_orderkey) AS rn
  FROM orders) t
WHERE rn = 1""",
    "number_duplicates": """
SELECT *, CAST(row_number() OVER (PARTITION BY text ORDER BY doc_id) AS INTEGER) AS row_num
FROM documents""",
    "delete_where": "SELECT * FROM lineitem WHERE NOT coalesce(l_returnflag = 'R', false)",
    "drop_all_null": """
SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE NOT (l.quality IS NULL AND l.toxic IS NULL)""",
    "trim_names": """
SELECT c_custkey, trim('  ' || c_name || ' ') AS c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer""",
    "canonical_brand": """
SELECT p_partkey, p_name,
       CASE WHEN p_brand LIKE 'Brand#2%' THEN 'Brand#2' ELSE p_brand END AS p_brand,
       p_type, p_size, p_retailprice
FROM part""",
    "strip_dots": """
SELECT doc_id, CASE WHEN text LIKE 'T%' THEN rtrim(text, '.') ELSE text END AS text
FROM documents""",
    "blank_to_null": """
SELECT o_orderkey, o_custkey,
       nullif(CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END, '') AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority
FROM orders""",
    "fill_from_peers": """
WITH b AS (
  SELECT d.doc_id, d.source, l.quality
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
donors AS (
  SELECT source AS donor_source, min(quality) AS donor_quality
  FROM b WHERE quality IS NOT NULL AND source IS NOT NULL GROUP BY source)
SELECT b.doc_id, b.source, coalesce(b.quality, donors.donor_quality) AS quality
FROM b LEFT JOIN donors ON b.source = donors.donor_source""",
    "parse_date": """
SELECT o_orderkey,
       CAST(strptime(strftime(o_orderdate, '%-m/%-d/%Y'), '%m/%d/%Y') AS DATE) AS o_orderdate
FROM orders""",
    "text_equals_one": """
SELECT doc_id, quality_text, toxic FROM (
  SELECT doc_id,
         CASE WHEN toxic = 1 THEN CAST(quality AS VARCHAR) || '.0'
              ELSE CAST(quality AS VARCHAR) END AS quality_text,
         toxic
  FROM labels) t
WHERE try_cast(quality_text AS DOUBLE) = 1
ORDER BY doc_id DESC""",
    "total_by_flag": """
SELECT l_returnflag, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_quantity
FROM lineitem GROUP BY l_returnflag ORDER BY total_quantity DESC""",
    "total_by_year": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_quantity
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY year(o_orderdate) ORDER BY total_quantity DESC""",
    "total_by_month": _MONTHS.format(out="total_quantity") + " ORDER BY month",
    "running_total": "WITH m AS (" + _MONTHS.format(out="total_off") + """)
SELECT month, total_off, CAST(sum(total_off) OVER (ORDER BY month) AS BIGINT) AS rolling_total
FROM m ORDER BY month""",
    "total_by_supplier_year": _SUPPLIER_YEAR + " ORDER BY total_quantity DESC",
    "order_date_span": """
SELECT min(CAST(o_orderdate AS DATE)) AS earliest_date,
       max(CAST(o_orderdate AS DATE)) AS latest_date
FROM orders""",
    "top5_supplier_year": "WITH cy AS (" + _SUPPLIER_YEAR + """),
r AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY year ORDER BY total_quantity DESC NULLS LAST)
                 AS INTEGER) AS ranking
  FROM cy WHERE year IS NOT NULL)
SELECT * FROM r WHERE ranking <= 5""",
    "decode_props": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "json_roundtrip": "SELECT * FROM events",
    "flatten_nested": _EVENT_FLAT,
    "quarantine_split": """
SELECT CASE WHEN event_type IN ('error', 'signup', 'purchase') THEN 'quarantine'
            ELSE 'valid' END AS route,
       count(*) AS n
FROM events GROUP BY 1""",
    "landing_ingest": _EVENT_FLAT,
    "stream_ingest": "SELECT * FROM events",
    "stream_dedupe": "SELECT * FROM events",
    "latest_by_key": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) t
WHERE rn = 1""",
    "clean_layoffs": "WITH " + _LAYOFFS_CLEAN + "\nSELECT * FROM clean",
    "explore_top_companies": "WITH " + _LAYOFFS_CLEAN + """,
cy AS (
  SELECT company, CAST(year(date) AS INTEGER) AS year,
         CAST(sum(total_laid_off) AS BIGINT) AS total_laid_off
  FROM clean GROUP BY company, year(date)),
r AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY year ORDER BY total_laid_off DESC NULLS LAST)
                 AS INTEGER) AS ranking
  FROM cy WHERE year IS NOT NULL)
SELECT * FROM r WHERE ranking <= 5""",
    "explore_rolling_total": "WITH " + _LAYOFFS_CLEAN + """,
m AS (
  SELECT strftime(date, '%Y-%m') AS month, CAST(sum(total_laid_off) AS BIGINT) AS total_off
  FROM clean WHERE date IS NOT NULL GROUP BY 1)
SELECT month, total_off, CAST(sum(total_off) OVER (ORDER BY month) AS BIGINT) AS rolling_total
FROM m ORDER BY month""",
    "explore_full_layoffs": "WITH " + _LAYOFFS_CLEAN + """
SELECT * FROM clean WHERE try_cast(percentage_laid_off AS DOUBLE) = 1
ORDER BY funds_raised_millions DESC NULLS LAST""",
    "explore_total_by_company": "WITH " + _LAYOFFS_CLEAN + """
SELECT company, CAST(sum(total_laid_off) AS BIGINT) AS total_laid_off
FROM clean GROUP BY company ORDER BY total_laid_off DESC NULLS LAST""",
    "explore_total_by_industry": "WITH " + _LAYOFFS_CLEAN + """
SELECT industry, CAST(sum(total_laid_off) AS BIGINT) AS total_laid_off
FROM clean GROUP BY industry ORDER BY total_laid_off DESC NULLS LAST""",
    "explore_total_by_stage": "WITH " + _LAYOFFS_CLEAN + """
SELECT stage, CAST(sum(total_laid_off) AS BIGINT) AS total_laid_off
FROM clean GROUP BY stage ORDER BY total_laid_off DESC NULLS LAST""",
    "explore_date_span": "WITH " + _LAYOFFS_CLEAN + """
SELECT min(date) AS earliest_date, max(date) AS latest_date FROM clean""",
    "explore_total_by_year": "WITH " + _LAYOFFS_CLEAN + """
SELECT CAST(year(date) AS INTEGER) AS year, CAST(sum(total_laid_off) AS BIGINT) AS total_laid_off
FROM clean GROUP BY year(date) ORDER BY total_laid_off DESC NULLS LAST""",
    "explore_total_by_month": "WITH " + _LAYOFFS_CLEAN + """
SELECT strftime(date, '%Y-%m') AS month, CAST(sum(total_laid_off) AS BIGINT) AS total_laid_off
FROM clean WHERE date IS NOT NULL GROUP BY 1 ORDER BY 1""",
    "explore_total_by_company_year": "WITH " + _LAYOFFS_CLEAN + """
SELECT company, CAST(year(date) AS INTEGER) AS year,
       CAST(sum(total_laid_off) AS BIGINT) AS total_laid_off
FROM clean GROUP BY company, year(date) ORDER BY total_laid_off DESC NULLS LAST""",
}

ORACLE_SQL["explore_all_rows"] = ORACLE_SQL["clean_layoffs"]
ORACLE_SQL["running_total_rows"] = """
    SELECT l_orderkey, l_linenumber, l_shipdate, CAST(l_quantity AS INTEGER) AS qty,
           CAST(sum(CAST(l_quantity AS INTEGER)) OVER (ORDER BY l_shipdate) AS BIGINT) AS shipped
    FROM lineitem"""

ORACLE_SQL["stream_dedupe_lossless"] = "SELECT * FROM events"
ORACLE_SQL["keyed_upsert"] = ORACLE_SQL["stream_upsert"] = """
    SELECT user_id, ts, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events)
    WHERE rn = 1"""
ORACLE_SQL["produce_observations"] = """
WITH f AS (
  SELECT *, 'city' || user_id AS city, 'region' || (event_id % 7) AS region,
         strftime(ts, '%Y-%m-%d %-H:%M') AS minute
  FROM events),
h AS (
  SELECT *, sha256(concat_ws(chr(1), city, region, event_type, minute, minute)) AS x FROM f)
SELECT substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-' || substr(x, 13, 4) || '-'
         || substr(x, 17, 4) || '-' || substr(x, 21, 12) AS id,
       city AS location_city, region AS location_region, event_type AS location_country,
       date_trunc('minute', ts) AS localtime, date_trunc('minute', ts) AS last_updated,
       event_type AS description, count(*) AS n, min('//icons/' || (event_id % 9) || '.png') AS icon,
       CAST(min(event_id % 360) AS INTEGER) AS wind_degree,
       CAST(max(event_id % 100) AS INTEGER) AS humidity,
       CAST(max(CAST(CAST(value AS FLOAT) AS DECIMAL(12, 2))) AS DECIMAL(12, 2)) AS temp_c
FROM h GROUP BY ALL"""
ORACLE_SQL["landing_quarantine"] = """
WITH f AS (
  SELECT CASE WHEN event_type IN ('error', 'signup', 'purchase') THEN 'quarantine'
              ELSE 'valid' END AS route,
         CASE WHEN event_type = 'error' THEN 'garbage-' || event_id
              WHEN event_type = 'purchase' THEN '[1]' END AS raw,
         'city' || user_id AS city
  FROM events)
SELECT route, count(*) AS n, count(*) FILTER (route = 'valid') AS n_ids, count(raw) AS n_raw,
       min(raw) AS first_raw, max(CASE WHEN route = 'valid' THEN city END) AS last_city
FROM f GROUP BY route"""
ORACLE_SQL["log_from_offsets"] = "SELECT * FROM events WHERE event_id % 2 = 1"
ORACLE_SQL["log_latest_and_restart"] = "SELECT * FROM events WHERE event_id % 3 > 0"
ORACLE_SQL["log_offsets"] = """
    SELECT CAST(count(*) AS BIGINT) AS n_records, CAST(count(DISTINCT user_id) AS BIGINT) AS n_keys,
           true AS gapless
    FROM events"""
ORACLE_SQL["batch_ledger"] = """
    SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS several_batches, CAST(0 AS BIGINT) AS mismatches
    FROM events"""
_SPELT = """
o AS (
  SELECT o_orderkey, o_custkey,
         CASE o_orderkey % 3 WHEN 0 THEN lower(o_orderpriority)
              WHEN 1 THEN translate(o_orderpriority, 'EIO', '\u00c9\u00ce\u00d6')
              ELSE o_orderpriority END AS o_orderpriority
  FROM orders)"""
ORACLE_SQL["collated_totals"] = "WITH" + _SPELT + """
SELECT min(o_orderpriority) AS o_orderpriority, CAST(sum(o_custkey) AS BIGINT) AS total
FROM o GROUP BY strip_accents(lower(o_orderpriority))"""
ORACLE_SQL["collated_dedupe"] = "WITH" + _SPELT + """
SELECT o_orderkey, o_custkey, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, strip_accents(lower(o_orderpriority))
                               ORDER BY o_orderkey DESC) AS rn FROM o)
WHERE rn = 1"""
ORACLE_SQL["schema_evolution"] = """
    SELECT o_orderkey AS key, o_custkey AS customer,
           CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus ELSE '?' END AS status,
           CASE WHEN o_orderkey % 3 <> 1 THEN o_totalprice END AS price,
           CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority ELSE 'none' END AS priority
    FROM orders"""
