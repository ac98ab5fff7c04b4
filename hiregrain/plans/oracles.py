"""DuckDB SQL with the expected result of each registered query.

Stand-in frames are defined here a second time, in SQL. Site pages have no SQL form:
their expected fields are written down per shape instead.
"""

from __future__ import annotations

TIME = "'%Y-%m-%d %H:%M:%S.%f'"
ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"

STAGING = f"""
WITH stg AS (
  SELECT posting_id, source, original_url, company_name, title, location, employment_type,
         experience_level, description_text, '[]' AS skills, collected_at,
         sha256(coalesce(description_text, '')) AS content_hash,
         'raw/job_postings/source=' || source || '/dt=' || day || '/' || posting_id || '.html'
           AS raw_s3_key,
         'processed/job_postings/source=' || source || '/dt=' || day || '/' || posting_id || '.json'
           AS processed_s3_key,
         'curated/job_postings/dt=' || day || '/' || posting_id || '.json' AS curated_s3_key,
         loaded_at
  FROM (
    SELECT 'p' || event_id AS posting_id, e.event_type AS source,
           'https://site' || (user_id % 6) || '.example/' || user_id AS original_url,
           CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 17 = 0 THEN ''
                ELSE 'Company ' || user_id END AS company_name,
           CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN ''
                ELSE 'Title ' || event_id END AS title,
           d.lang AS location, d.source AS employment_type,
           CAST(NULL AS VARCHAR) AS experience_level,
           CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN ''
                ELSE d.text END AS description_text,
           ts AS collected_at, date_trunc('hour', ts) + INTERVAL 1 HOUR AS loaded_at,
           strftime(ts, '%Y-%m-%d') AS day
    FROM events e
    JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
  )
)
"""

CLEAN = (
    STAGING
    + """,
clean AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY source, original_url
      ORDER BY collected_at DESC, loaded_at DESC, posting_id DESC, content_hash DESC) AS rn
    FROM stg)
  WHERE rn = 1
)
"""
)

_CLEAN_ROWS = f"""
SELECT * REPLACE (strftime(collected_at, {TIME}) AS collected_at,
                  strftime(loaded_at, {TIME}) AS loaded_at)
FROM clean
"""

QUALITY = (
    CLEAN
    + """,
quality AS (
  SELECT source, count(*) AS total_postings,
         count(*) FILTER (description_text IS NOT NULL AND description_text <> '')
           AS description_filled_count,
         count(*) FILTER (content_hash IS NOT NULL AND content_hash <> '')
           AS content_hash_filled_count,
         count(*) FILTER (title IS NULL OR title = '') AS missing_title_count,
         count(*) FILTER (company_name IS NULL OR company_name = '') AS missing_company_count
  FROM clean GROUP BY source
)
"""
)

_REQUIRED_NULL = "title IS NULL OR original_url IS NULL OR source IS NULL OR collected_at IS NULL"

_VERDICTS = f"""
SELECT * FROM (
  SELECT 'stg_not_empty' AS check_name, 'staging' AS subject, count(*)::DOUBLE AS observed,
         1.0::DOUBLE AS threshold, 'error' AS severity, count(*) > 0 AS passed FROM stg
  UNION ALL
  SELECT 'int_not_empty', 'intermediate', count(*)::DOUBLE, 1.0, 'error', count(*) > 0 FROM clean
  UNION ALL
  SELECT 'int_required_fields', 'intermediate', count(*)::DOUBLE, 0.0, 'error', count(*) = 0
  FROM clean WHERE {_REQUIRED_NULL}
  UNION ALL
  SELECT 'int_no_duplicate_content_hash', 'intermediate', count(*)::DOUBLE, 0.0, 'error',
         count(*) = 0
  FROM (SELECT content_hash FROM clean GROUP BY content_hash HAVING count(*) > 1)
  UNION ALL
  SELECT 'description_quality', source, description_filled_count / total_postings, 0.3, 'error',
         NOT (total_postings >= 5 AND description_filled_count / total_postings < 0.3)
  FROM quality
)
"""

KEYS = """
WITH listed AS (
  SELECT 'curated/job_postings/dt=' || strftime(ts, '%Y-%m-%d') || '/p' || event_id || '.json'
           AS s3_key, ts, event_type
  FROM events
),
loaded AS (
  SELECT s3_key FROM listed WHERE ts < TIMESTAMP '2024-01-16 00:00:00' OR event_type = 'click'
)
"""

JOBS = f"""
WITH jobs AS (
  SELECT *, 'https://' || host || '/p/' || page_number AS url,
         CASE WHEN collected_at <> '어제' THEN left(collected_at, 10) END AS dt
  FROM (
    SELECT event_id, 'j' || user_id AS job_id, event_type AS source, ts,
           page_number, page_number % 6 AS turn,
           CASE page_number % 6 WHEN 0 THEN 'www.wanted.co.kr' WHEN 1 THEN 'SARAMIN.co.kr:443'
                WHEN 2 THEN 'groupby.kr' WHEN 3 THEN 'me@www.jobkorea.co.kr'
                WHEN 4 THEN 'www.catch.co.kr' ELSE 'jobs.example' END AS host,
           CASE WHEN event_id % 31 = 5 THEN '어제' ELSE strftime(ts, {ISO}) END AS collected_at,
           CAST(json_extract(props, '$.k') AS INT) % 5 AS retry_count,
           CASE WHEN event_id % 10 = 7 THEN (event_id // 10) % 9 END AS planted
    FROM (SELECT *, event_id % ((SELECT count(*) FROM pages) * 11 // 10 + 1) AS page_number
          FROM events)
  )
)
"""

GATED = (
    JOBS
    + """,
gated AS (
  SELECT *, CASE planted
      WHEN 0 THEN 'not valid json' WHEN 1 THEN 'not valid utf-8'
      WHEN 2 THEN 'job must be a JSON object, got list'
      WHEN 3 THEN 'job must be a JSON object, got str'
      WHEN 4 THEN 'missing required fields: source, url, collected_at'
      WHEN 5 THEN 'not valid json' WHEN 6 THEN 'missing required fields: url'
      WHEN 7 THEN 'not valid json' WHEN 8 THEN 'missing required fields: collected_at'
    END AS malformed_reason
  FROM jobs
),
fetched AS (
  SELECT page_id, html, CASE page_id % 12
      WHEN 1 THEN 'connect_timeout' WHEN 2 THEN 'read_timeout' WHEN 3 THEN 'ssl_error'
      WHEN 4 THEN 'http_4xx_' || (400 + page_id % 100) WHEN 5 THEN 'http_5xx_503'
      WHEN 6 THEN 'http_error' WHEN 7 THEN 'dns_error' WHEN 8 THEN 'connection_error'
      WHEN 9 THEN 'TooManyRedirects' END AS fetch_error
  FROM pages
)
"""
)

ROUTED = (
    GATED
    + """,
done AS (
  SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS dt, 'j' || user_id AS job_id
  FROM events WHERE event_type = 'signup' AND value < 10
),
tried AS (
  SELECT g.*, CASE WHEN malformed_reason IS NOT NULL THEN 'malformed'
      WHEN retry_count >= 3 THEN 'retry_exceeded' WHEN g.dt IS NULL THEN 'parse_failed'
      WHEN d.job_id IS NOT NULL THEN 'duplicate'
      WHEN f.page_id IS NULL OR f.fetch_error IS NOT NULL THEN 'fetch_failed'
      WHEN f.page_id % 12 = 10 THEN 'curated_failed'
      ELSE 'success' END AS first_outcome,
    CASE WHEN f.page_id IS NULL THEN 'not_fetched' ELSE f.fetch_error END AS fetch_error, f.html
  FROM gated g LEFT JOIN done d ON d.dt = g.dt AND d.job_id = g.job_id
  LEFT JOIN fetched f ON f.page_id = g.page_number
),
routed AS (
  SELECT *, CASE WHEN first_outcome IN ('success', 'fetch_failed', 'curated_failed') AND event_id > first_ok
                 THEN 'duplicate' ELSE first_outcome END AS outcome
  FROM (SELECT *, min(event_id) FILTER (first_outcome = 'success')
                    OVER (PARTITION BY dt, job_id) AS first_ok FROM tried)
)
"""
)


def decoded(text: str) -> str:
    """The four references that occur in the pages, with or without the semicolon of one."""
    for name, plain in (("middot", "·"), ("copy", "©"), ("quot", '"')):
        text = f"replace({text}, '&{name};', '{plain}')"
    return f"regexp_replace({text}, '&amp;?', '&', 'g')"


def stripped(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def squeezed(text: str) -> str:
    return rf"nullif(trim(regexp_replace({text}, '\s+', ' ', 'g')), '')"


def dropped_tags(markup: str) -> str:
    markup = rf"regexp_replace({markup}, '(?i)<br\s*/?>', chr(10), 'g')"
    markup = f"regexp_replace({markup}, '(?i)</p>|</div>|</li>|</h[1-4]>', chr(10), 'g')"
    return f"regexp_replace({markup}, '<[^>]+>', ' ', 'g')"


def tidied(text: str) -> str:
    text = rf"regexp_replace({text}, '\n\s*\n+', chr(10) || chr(10), 'g')"
    return stripped(f"regexp_replace({text}, '[ \\t]+', ' ', 'g')")


def page_text(markup: str) -> str:
    return tidied(decoded(dropped_tags(markup)))


TITLE = stripped(decoded("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))
_DESCRIPTION = f"coalesce({squeezed(decoded(page_text("html")))}, '')"

DOCUMENTS = (
    ROUTED
    + f""",
curated AS (
  SELECT *, {squeezed(decoded(TITLE))} AS title, {_DESCRIPTION} AS description_text,
    'raw/job_postings/source=' || source || '/dt=' || dt || '/' || job_id || '.html' AS raw_s3_key,
    'processed/job_postings/source=' || source || '/dt=' || dt || '/' || job_id || '.json'
      AS processed_s3_key,
    'curated/job_postings/dt=' || dt || '/' || job_id || '.json' AS curated_s3_key
  FROM routed WHERE outcome = 'success'
)
"""
)

_CURATED_ROWS = """
SELECT job_id AS posting_id, source, url AS original_url, CAST(NULL AS VARCHAR) AS company_name,
       title, CAST(NULL AS VARCHAR) AS location, CAST(NULL AS VARCHAR) AS employment_type,
       CAST(NULL AS VARCHAR) AS experience_level, description_text, '[]' AS skills, collected_at,
       sha256(description_text) AS content_hash, raw_s3_key, processed_s3_key, curated_s3_key
FROM curated
"""

FAILURES = f"""
WITH f AS (
  SELECT *, CASE WHEN event_id % 29 IN (0, 1) THEN NULL WHEN event_id % 29 = 2 THEN 'empty'
                 WHEN event_id % 29 = 3 THEN 'partial' ELSE 'full' END AS job_kind,
    event_id % 37 <> 0 AS readable, CAST(json_extract(props, '$.k') AS INT) % 5 AS attempts,
    CASE event_id % 6 WHEN 2 THEN 'parse' WHEN 3 THEN 'raw_upload' WHEN 4 THEN 'processed'
         WHEN 5 THEN 'curated' ELSE 'fetch' END AS failed_stage,
    CASE event_id % 4 WHEN 0 THEN 'connect_timeout' WHEN 1 THEN 'dns_error'
         WHEN 2 THEN 'http_5xx_503' ELSE 'TypeError' END AS error_type
  FROM events
),
rows_ AS (
  SELECT event_id, ts, readable, job_kind, attempts,
    CASE WHEN event_id % 41 <> 0 THEN strftime(ts, {ISO}) ELSE '2024-02-01T00:00:00.000000Z' END
      AS failed_at,
    failed_stage, error_type, 'event ' || event_id AS error_message,
    CASE WHEN job_kind IN ('full', 'partial') THEN attempts ELSE 0 END AS retry_count,
    CASE job_kind WHEN 'full' THEN event_type WHEN 'partial' THEN 's' END AS source,
    CASE WHEN job_kind = 'full' THEN 'https://x/' || user_id END AS url,
    '{{"job":' || CASE WHEN event_id % 29 = 0 THEN 'null' WHEN event_id % 29 = 1 THEN '"text"'
        WHEN job_kind = 'empty' THEN '{{}}'
        WHEN job_kind = 'partial' THEN '{{"source":"s","retry_count":' || attempts || '}}'
        ELSE '{{"job_id":"j' || event_id || '","source":"' || event_type
          || '","url":"https://x/' || user_id || '","retry_count":' || attempts || '}}' END
      || ',"failed_stage":"' || failed_stage || '","error_type":"' || error_type
      || '","error_message":"event ' || event_id || '"'
      || CASE WHEN event_id % 41 <> 0 THEN ',"failed_at":"' || strftime(ts, {ISO}) || '"' ELSE '' END
      || '}}' AS payload
  FROM f
),
events_ AS (SELECT * FROM rows_ WHERE readable),
decisions AS (
  SELECT *, CASE WHEN NOT readable THEN 'unreadable'
      WHEN coalesce(job_kind, 'empty') = 'empty' THEN 'no_job'
      WHEN retry_count >= 3 THEN 'retry_limit' WHEN failed_stage <> 'fetch' THEN 'unsupported_stage'
      WHEN job_kind = 'partial' THEN 'no_job_id' END AS skip_reason
  FROM rows_
)
"""

_EVENT_ROWS = """
SELECT failed_at, failed_stage, error_type, error_message, retry_count::INT AS retry_count,
       source, url, payload FROM events_
"""

_REPLAYED = """
SELECT 'j' || event_id AS key, source, url, retry_count::INT AS retry_count
FROM decisions WHERE skip_reason IS NULL
"""

_LINKS = """
WITH links AS (
  SELECT DISTINCT 'wanted' AS source,
         'https://www.wanted.co.kr/wd/' || unnest([event_id, user_id]) AS url FROM events
  UNION ALL
  SELECT DISTINCT 'jobkorea',
         'https://www.jobkorea.co.kr/Recruit/GI_Read/' || unnest([event_id, user_id]) FROM events
)
"""

_JOB_COLUMNS = "'2024-02-01T00:00:00.000000Z' AS collected_at, 0 AS retry_count"

# Expected fields of the rendered site pages; shape = doc_id % 3.
_SHAPED = """
WITH d AS (
  SELECT *, doc_id % 3 AS shape, 'Role ' || doc_id AS role, 'Org ' || (doc_id % 50) AS org,
    CASE WHEN doc_id % 2 = 0 THEN '서울 강남구' ELSE '서울' END AS place,
    CASE WHEN doc_id % 2 = 0 THEN '강남구' ELSE '서울' END AS locality
  FROM documents
)
"""
_MARKUP = "'<p>' || text || '</p><br/><li>R&amp;D</li>'"
_NOTHING = "CAST(NULL AS VARCHAR)"


def _shape(*values: str) -> str:
    first, second, third = values
    return f"CASE shape WHEN 0 THEN {first} WHEN 1 THEN {second} ELSE {third} END"


def _site(company, title, location, employment, experience, description) -> str:
    return (
        _SHAPED
        + f"""
SELECT doc_id AS page_id, {company} AS company_name, {title} AS title, {location} AS location,
       {employment} AS employment_type, {experience} AS experience_level,
       {description} AS description_text
FROM d
"""
    )


_FULL_TIME = "'FULL_TIME, ' || source"
_CATCH_SUMMARY = "'신입| |정규직 | 대졸 |' || doc_id || '| 부산 |끝'"

SITE_FIELDS = {
    "wanted": _site(
        "org",
        _shape("role || ' & lead'", "role", "role"),
        _shape("place", "NULL", "place"),
        _shape(_FULL_TIME, "NULL", "source"),
        _shape("CAST(n_chars AS VARCHAR)", "NULL", "NULL"),
        _shape(page_text(_MARKUP), squeezed("text"), squeezed("text")),
    ),
    "groupby": _site(
        _shape("org", "NULL", "NULL"),
        _shape("role", "role", "role || ' 팀 (경력무관)'"),
        _shape("locality", "NULL", "NULL"),
        _shape("'CONTRACT'", "NULL", "''"),
        _shape("'3년 이하'", "'무관'", "'경력무관'"),
        _shape(page_text(_MARKUP), squeezed("text"), squeezed("text")),
    ),
    "saramin": _site(
        "org",
        _shape("role", "'ignored ' || doc_id", "'[' || org || ']'"),
        _NOTHING,
        _NOTHING,
        _shape("NULL", "doc_id || '년'", "NULL"),
        _shape(
            squeezed("text"), "org || ', ' || role || ', 경력: ' || doc_id || '년 , 서울'", "NULL"
        ),
    ),
    "catch": _site(
        "org",
        _shape("role", "role", "role || ' 채용'"),
        _shape("place", "'부산'", "'부산'"),
        _shape(_FULL_TIME, "'정규직'", "'정규직'"),
        _shape("'신입, 경력'", "'신입'", "'신입'"),
        _shape(squeezed("'<p>' || text || '</p>'"), _CATCH_SUMMARY, _CATCH_SUMMARY),
    ),
    "jobkorea": _site(
        "org",
        _shape("role", "'[' || role || '] now'", "role"),
        _shape("place", "NULL", "NULL"),
        _NOTHING,
        _shape("'1, 2'", "doc_id || '년 & up'", "NULL"),
        _shape(
            squeezed("'<p>' || text || '</p>'"),
            "'모집 경력 : ' || doc_id || '년 & up, etc'",
            "'경력 무관'",
        ),
    ),
}


def _count(rows: str, name: str, by: str, alias: str | None = None) -> str:
    shown = f"{by} AS {alias}" if alias else by
    return f"SELECT {shown}, count(*) AS {name} FROM {rows} GROUP BY ALL"


ORACLES: dict[str, str] = {
    "int_postings_clean": CLEAN + _CLEAN_ROWS,
    "latest_by_merge": CLEAN + _CLEAN_ROWS,
    "mart_postings_daily": CLEAN
    + """SELECT CAST(CAST(collected_at AS DATE) AS VARCHAR) AS collected_date, source,
         count(*) AS posting_count FROM clean GROUP BY ALL""",
    "mart_source_quality": QUALITY + "SELECT * FROM quality",
    "published_daily": CLEAN
    + """SELECT CAST(CAST(collected_at AS DATE) AS VARCHAR) AS collected_date, source,
         count(*) AS posting_count FROM clean GROUP BY ALL""",
    "published_source_quality": QUALITY + "SELECT * FROM quality",
    "dq_first_failure": QUALITY
    + f"""SELECT check_name, subject FROM ({_VERDICTS}) WHERE NOT passed
          ORDER BY list_position(['stg_not_empty', 'int_not_empty', 'int_required_fields',
            'int_no_duplicate_content_hash', 'description_quality'], check_name), subject LIMIT 1""",
    "dq_verdicts": QUALITY + _VERDICTS,
    "dq_required_fields": CLEAN
    + f"SELECT count(*) AS invalid_count FROM clean WHERE {_REQUIRED_NULL}",
    "dq_duplicate_hash_groups": CLEAN
    + """SELECT content_hash, count(*) AS posting_count FROM clean GROUP BY content_hash
         HAVING count(*) > 1""",
    "dq_fill_rate": QUALITY
    + """SELECT source, total_postings, description_filled_count / total_postings AS fill_rate,
         total_postings >= 5 AND description_filled_count / total_postings < 0.3 AS too_low
         FROM quality""",
    "stg_projection": STAGING
    + f"""SELECT * REPLACE (strftime(collected_at, {TIME}) AS collected_at,
                            '2024-02-01 00:00:00.000000' AS loaded_at) FROM stg""",
    "staging_load": STAGING
    + f"""SELECT * REPLACE (strftime(collected_at, {TIME}) AS collected_at,
                            '2024-02-01 00:00:00.000000' AS loaded_at) FROM stg
          WHERE NOT (collected_at < TIMESTAMP '2024-01-16 00:00:00' OR source = 'click')""",
    "staging_load_objects": CLEAN
    + f"""SELECT * REPLACE (strftime(collected_at, {TIME}) AS collected_at,
                            '2024-02-01 00:00:00.000000' AS loaded_at) FROM clean""",
    "load_new_keys": KEYS
    + "SELECT s3_key FROM listed l WHERE NOT EXISTS (SELECT 1 FROM loaded WHERE s3_key = l.s3_key)",
    "load_required_violations": STAGING
    + """SELECT posting_id, CASE WHEN title = '' AND company_name = '' THEN 'source, original_url'
              WHEN title = '' THEN 'source' ELSE 'original_url' END AS violations
         FROM stg WHERE title = '' OR company_name = ''""",
    "job_keys": JOBS
    + """SELECT event_id, dt,
         'raw/job_postings/source=' || source || '/dt=' || dt || '/' || job_id || '.html'
           AS raw_s3_key,
         'processed/job_postings/source=' || source || '/dt=' || dt || '/' || job_id || '.json'
           AS processed_s3_key,
         'curated/job_postings/dt=' || dt || '/' || job_id || '.json' AS curated_s3_key
         FROM jobs""",
    "gate_outcomes": GATED + 'SELECT event_id AS "offset", malformed_reason FROM gated',
    "retry_limit": JOBS + "SELECT event_id, retry_count >= 3 AS exceeded FROM jobs",
    "route_outcomes": ROUTED + 'SELECT event_id AS "offset", outcome FROM routed',
    "worker_stream_outcomes": ROUTED
    + "SELECT outcome, count(*) AS message_count FROM routed GROUP BY ALL",
    "dlq_envelopes": ROUTED
    + """SELECT event_id AS "offset", CASE WHEN outcome <> 'malformed' THEN job_id END AS key,
         CASE outcome WHEN 'malformed' THEN 'malformed_message' WHEN 'parse_failed'
              THEN 'ValueError' WHEN 'curated_failed' THEN 'TypeError' ELSE fetch_error END AS error_type,
         CASE outcome WHEN 'malformed' THEN malformed_reason
              WHEN 'parse_failed' THEN 'collected_at is not an ISO-8601 time: ' || collected_at
              WHEN 'curated_failed' THEN 'a linked-data or description field has an unusable type'
              ELSE CASE WHEN fetch_error = 'not_fetched' THEN 'no page was fetched for this url'
                WHEN page_number % 12 = 7 THEN 'FAILED to Resolve ' || chr(39) || 'host' || chr(39)
                WHEN page_number % 12 = 8 THEN 'reset by peer' ELSE '' END END AS error_message,
         CASE planted WHEN 0 THEN '{not valid json' WHEN 1 THEN '\ufffd\ufffd'
              WHEN 2 THEN '[1, 2, 3]' WHEN 3 THEN '"text"' WHEN 5 THEN '' END AS raw_message,
         CASE outcome WHEN 'fetch_failed' THEN 'fetch' WHEN 'curated_failed' THEN 'curated'
              ELSE 'parse' END AS failed_stage,
         CASE WHEN outcome = 'malformed' THEN malformed_reason END AS malformed_reason,
         CASE WHEN outcome <> 'malformed' THEN retry_count + 1 END AS retry_count,
         CASE WHEN outcome <> 'malformed' THEN url END AS url
         FROM routed
         WHERE outcome IN ('malformed', 'parse_failed', 'fetch_failed', 'curated_failed')""",
    "fetch_messages": JOBS
    + """SELECT job_id AS key, '{"job_id":"' || job_id || '","source":"' || source || '","url":"'
         || url || '","collected_at":"' || collected_at || '","retry_count":' || retry_count || '}'
           AS value FROM jobs""",
    "skewed_join": """
WITH keyed AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE 'u' || user_id END AS key
               FROM events),
totals AS (SELECT key, count(*) AS n FROM keyed WHERE key <> 'u7' GROUP BY key)
SELECT event_id, key, n FROM keyed LEFT JOIN totals USING (key)""",
    "domain_route": JOBS
    + """SELECT event_id, CASE turn WHEN 0 THEN 'wanted' WHEN 1 THEN 'saramin' WHEN 2 THEN 'groupby'
              WHEN 3 THEN 'jobkorea' WHEN 4 THEN 'catch' END AS site,
         turn = 1 AS disable_ssl_verify, turn = 1 AS refetch_canonical FROM jobs""",
    "fetch_errors": GATED
    + """SELECT event_id, CASE WHEN f.page_id IS NULL THEN 'not_fetched' ELSE f.fetch_error END
              AS fetch_error
         FROM gated g LEFT JOIN fetched f ON f.page_id = g.page_number""",
    "canonical_refetch": """
SELECT 'https://www.saramin.co.kr/jobs/' || doc_id AS url,
  CASE WHEN doc_id % 4 = 0 AND lang <> 'es' THEN 'https://www.saramin.co.kr/view/' || lang
       ELSE 'https://www.saramin.co.kr/jobs/' || doc_id END AS page_url,
  CASE WHEN doc_id % 4 = 0 AND lang <> 'es' THEN '[View] ' || lang ELSE '[Own] ' || doc_id END
    AS title_tag
FROM documents""",
    "page_titles": f"SELECT page_id, {TITLE} AS title_tag FROM pages",
    "page_text": f"SELECT page_id, {page_text('html')} AS page_text FROM pages",
    "page_hash": f"SELECT page_id, sha256({_DESCRIPTION}) AS content_hash FROM pages",
    **{f"site_{name}": sql for name, sql in SITE_FIELDS.items()},
    "ld_fields": _SHAPED
    + """SELECT doc_id AS page_id, CASE WHEN shape = 0 THEN org END AS company_name,
         CASE WHEN shape = 0 THEN role || ' & lead' END AS title, place AS location,
         CASE WHEN shape = 0 THEN 'FULL_TIME, ' || source ELSE source END AS employment_type,
         CASE WHEN shape = 0 THEN CAST(n_chars AS VARCHAR) END AS experience_level
         FROM d WHERE shape <> 1""",
    "ld_objects": """
SELECT doc_id AS page_id, unnest(CASE WHEN doc_id % 3 = 1 THEN CAST([] AS VARCHAR[])
         ELSE ['BreadcrumbList', 'JobPosting'] END) AS object_type FROM documents""",
    "curated_docs": DOCUMENTS + _CURATED_ROWS,
    "worker_stream_documents": DOCUMENTS + _CURATED_ROWS,
    "two_workers_documents": DOCUMENTS + _CURATED_ROWS,
    "overlapping_workers_documents": DOCUMENTS + _CURATED_ROWS,
    "backfill_documents": DOCUMENTS + _CURATED_ROWS,
    "compacted_documents": DOCUMENTS + _CURATED_ROWS,
    "loaded_from_commits": DOCUMENTS
    + f"""SELECT * REPLACE (strftime(CAST(collected_at AS TIMESTAMP), {TIME}) AS collected_at),
                 '2024-02-01 00:00:00.000000' AS loaded_at FROM ({_CURATED_ROWS})""",
    "processed_docs": DOCUMENTS
    + """SELECT job_id, source, url, collected_at, raw_s3_key,
         '2024-02-01 00:00:00.000000' AS processed_at, length(html)::INT AS html_length,
         left(html, 500) AS text_preview FROM curated""",
    "raw_docs": DOCUMENTS
    + "SELECT job_id, source, dt, raw_s3_key, md5(html) AS html_md5 FROM curated",
    "reprocess_from_raw": DOCUMENTS + _CURATED_ROWS,
    "dlq_event_rows": FAILURES + _EVENT_ROWS,
    "archive_stream": FAILURES + _EVENT_ROWS,
    "replay_eligible": FAILURES + _REPLAYED,
    "replay_stream": FAILURES + _REPLAYED,
    "replay_skips": FAILURES
    + _count("decisions", "message_count", "coalesce(skip_reason, 'replayed')", "decision"),
    "mon_volume": CLEAN
    + _count("clean", "posting_count", "CAST(CAST(collected_at AS DATE) AS VARCHAR)", "collected_date"),
    "mon_source_volume": CLEAN + _count("clean", "posting_count", "source"),
    "mon_dlq_hourly": FAILURES
    + f"""SELECT strftime(date_trunc('hour', strptime(failed_at, {ISO})), {TIME}) AS failed_hour,
          count(*) AS event_count FROM events_ GROUP BY ALL""",
    "mon_retry": FAILURES + _count("events_", "event_count", "retry_count::INT", "retry_count"),
    "mon_error_type": FAILURES + _count("events_", "event_count", "error_type"),
    "mon_stage": FAILURES + _count("events_", "event_count", "failed_stage"),
    "mon_quality_trend": CLEAN
    + """SELECT CAST(CAST(collected_at AS DATE) AS VARCHAR) AS collected_date, source,
         count(*) AS total_postings,
         count(*) FILTER (description_text <> '') AS description_filled_count,
         count(*) FILTER (description_text <> '') / count(*) AS fill_rate
         FROM clean GROUP BY ALL""",
    "mon_load_trend": STAGING
    + f"""SELECT strftime(loaded_at, {TIME}) AS loaded_hour, count(*) AS row_count
          FROM stg GROUP BY ALL""",
    "mon_freshness": STAGING
    + f"""SELECT source, strftime(max(loaded_at), {TIME}) AS last_loaded_at,
          strftime(max(collected_at), {TIME}) AS last_collected_at FROM stg GROUP BY ALL""",
    "failure_trend_stream": FAILURES
    + f"""SELECT strftime(date_trunc('hour', strptime(failed_at, {ISO})), {TIME}) AS failed_hour,
          error_type, count(*) AS event_count FROM events_ GROUP BY ALL""",
    "collect_links": _LINKS + "SELECT source, url FROM links",
    "collect_jobs": _LINKS
    + f"""SELECT sha256(source || '|' || url || '|run-1') AS job_id, source, url, {_JOB_COLUMNS}
          FROM links""",
    "collect_first_jobs": _LINKS
    + f"""SELECT sha256(source || '|' || url || '|run-1') AS job_id, source, url, {_JOB_COLUMNS}
          FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY url) AS rn FROM links)
          WHERE rn <= 20""",
    "seed_jobs": f"""
SELECT sha256('seed|' || url || '|run-1') AS job_id, 'seed' AS source, url, {_JOB_COLUMNS}
FROM pages""",
    "synthetic_jobs": f"""
WITH urls AS (
  SELECT event_id AS ordinal, CASE WHEN event_type = 'error' THEN CASE event_id % 2
      WHEN 0 THEN 'https://invalid-url-test-1234.com' ELSE 'https://10.255.255.1' END
    ELSE CASE event_id % 3 WHEN 0 THEN 'https://www.wanted.co.kr/wd/242151'
      WHEN 1 THEN 'https://groupby.kr/positions/9644'
      ELSE 'https://www.catch.co.kr/NCS/RecruitInfoDetails/543587' END END AS url FROM events
)
SELECT sha256('load_test|' || url || '|' || ordinal || '|run-1') AS job_id,
       'load_test' AS source, url, {_JOB_COLUMNS} FROM urls""",
}

# What is carried on from load to load is what whole tables give.
ORACLES |= {
    "carried_clean": ORACLES["int_postings_clean"],
    "carried_daily": ORACLES["mart_postings_daily"],
    "carried_source_quality": ORACLES["mart_source_quality"],
    "carried_verdicts": ORACLES["dq_verdicts"],
    "domain_table_route": f"SELECT event_id, site FROM ({ORACLES['domain_route']})",
}
