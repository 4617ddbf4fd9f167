"""SQL for DuckDB that gives each registered query's result on the same tables.

Written from the rules, not from the Spark plans: windows instead of aggregates, a CASE
per rule, joins in place of unions.
"""

from __future__ import annotations

from workload.inputs import COMMITMENTS, LINE_ORDER, LOCATIONS, RUN_1, RUN_2, TITLES
from workload.queries import CUTOFF

WS = ("chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '"
      "||chr(133)||chr(160)||chr(5760)||"
      + "||".join(f"chr({c})" for c in [*range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))


# Fixed values of the rules, written out here so that a slip in the library's tables shows.
# The first keyword found in a title decides.
LEVELS = (
    ("intern", "internship"),
    ("internship", "internship"),
    ("entry", "entry"),
    ("entry level", "entry"),
    ("entry-level", "entry"),
    ("new grad", "entry"),
    ("new college grad", "entry"),
    ("junior", "junior"),
    ("jr.", "junior"),
    ("jr ", "junior"),
    ("mid", "mid"),
    ("mid level", "mid"),
    ("mid-level", "mid"),
    ("senior", "senior"),
    ("sr.", "senior"),
    ("sr ", "senior"),
    ("staff", "senior"),
    ("principal", "senior"),
    ("lead", "senior"),
    ("director", "executive"),
    ("vp ", "executive"),
    ("vice president", "executive"),
    ("head of", "executive"),
)
# Keys as written, then in lower case.
COMMITMENT_TYPES = {
    "full time": "full-time",
    "full-time": "full-time",
    "fulltime": "full-time",
    "part time": "part-time",
    "part-time": "part-time",
    "contract": "contract",
    "contractor": "contract",
    "intern": "internship",
    "internship": "internship",
    "co-op": "internship",
    "FullTime": "full-time",
    "PartTime": "part-time",
    "Intern": "internship",
    "Contract": "contract",
    "Temporary": "contract",
    "permanent": "full-time",
}
STATES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA",
    "colorado": "CO", "connecticut": "CT", "delaware": "DE", "florida": "FL", "georgia": "GA",
    "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA",
    "kansas": "KS", "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD",
    "massachusetts": "MA", "michigan": "MI", "minnesota": "MN", "mississippi": "MS",
    "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV", "new hampshire": "NH",
    "new jersey": "NJ", "new mexico": "NM", "new york": "NY", "north carolina": "NC",
    "north dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA",
    "rhode island": "RI", "south carolina": "SC", "south dakota": "SD", "tennessee": "TN",
    "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA",
    "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY", "district of columbia": "DC",
}
PROVINCES = ("AB", "BC", "MB", "NB", "NL", "NS", "NT", "NU", "ON", "PE", "QC", "SK", "YT")


# --- pieces -----------------------------------------------------------------------------


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def filled(templates, index: str, word: str) -> str:
    return f"replace(([{quoted(templates)}])[{index} % {len(templates)} + 1], '{{}}', {word})"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def hashed(title: str, company: str, loc: str, desc: str = "NULL") -> str:
    parts = " || '|' || ".join(strip(f"lower({x})") for x in (title, company, loc))
    return (f"substr(sha256({parts} || CASE WHEN coalesce({desc}, '') <> '' "
            f"THEN '|' || substr({desc}, 1, 500) ELSE '' END), 1, 16)")


def valid(x: str) -> str:
    return (f"(length({x}) > 1 AND NOT regexp_matches({x}, '[?&=# ]') "
            f"AND NOT regexp_full_match({x}, '[0-9]+') "
            f"AND lower({x}) NOT IN ('robots.txt', 'sitemap.xml', 'embed', 'widget') "
            f"AND NOT regexp_matches({x}, '^(api|static|assets|favicon)'))")


def level(title: str) -> str:
    whens = " ".join(f"WHEN contains(lower({title}), '{k}') THEN '{v}'"
                     for k, v in LEVELS)
    return f"CASE {whens} ELSE 'unknown' END"


def employment(raw: str) -> str:
    def case(x):
        return f"CASE {x} " + " ".join(
            f"WHEN '{k}' THEN '{v}'" for k, v in COMMITMENT_TYPES.items()) + " END"
    return f"coalesce({case(raw)}, {case(f'lower({raw})')}, 'full-time')"


def located(rows: str) -> str:
    """CTEs over `rows` (with loc) up to `place`: all its columns, city, state, country, remote."""
    states, provinces = quoted(STATES.values()), quoted(PROVINCES)
    names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATES.items())
    return f"""
      tok AS (SELECT *, list_filter(list_transform(string_split(
                regexp_replace(loc, '\\([^\\n]*?\\)', '', 'g'), ','), lambda x: {strip('x')}),
                lambda x: x <> '' AND lower(x) NOT IN ('remote', 'hybrid', 'on-site', 'onsite')) AS t
              FROM {rows}),
      tail AS (SELECT *, len(t) AS n, upper(t[len(t)]) AS last FROM tok),
      head AS (SELECT *,
                n > 0 AND (last IN ({states}) OR (last IN ({provinces}) AND n >= 2)) AS settled,
                CASE WHEN n = 0 THEN NULL
                     WHEN last IN ('US', 'USA', 'UNITED STATES', 'UNITED STATES OF AMERICA') THEN 'US'
                     WHEN last = 'CANADA' THEN 'CA'
                     WHEN last IN ('UK', 'UNITED KINGDOM', 'ENGLAND', 'SCOTLAND', 'WALES') THEN 'UK'
                     WHEN last IN ({states}) THEN 'US'
                     WHEN last IN ({provinces}) AND n >= 2 THEN 'CA'
                     WHEN regexp_full_match(last, '\\pL\\pL') THEN last END AS nation
               FROM tail),
      cut AS (SELECT *, CASE WHEN nation IS NULL THEN n ELSE n - 1 END AS m FROM head),
      st AS (SELECT *, CASE WHEN m = 0 THEN NULL
                            WHEN upper(t[m]) IN ({states}) OR upper(t[m]) IN ({provinces}) THEN upper(t[m])
                            ELSE CASE lower(t[m]) {names} END END AS region FROM cut),
      place AS (SELECT * EXCLUDE (t, n, last, settled, nation, m, region),
                 CASE WHEN settled THEN CASE WHEN n >= 2 THEN t[n - 1] END
                      WHEN m - (CASE WHEN region IS NULL THEN 0 ELSE 1 END) > 0 THEN t[1] END AS city,
                 CASE WHEN settled THEN last ELSE region END AS state,
                 CASE WHEN nation IS NOT NULL THEN nation
                      WHEN region IS NULL THEN NULL
                      WHEN upper(t[m]) IN ({provinces}) THEN 'CA' ELSE 'US' END AS country,
                 CASE WHEN contains(lower(loc), 'remote') THEN 1 ELSE 0 END AS remote
                FROM st)"""


def html_text(x: str) -> str:
    s = f"regexp_replace({x}, '(?s)<!--.*?-->', chr(1), 'g')"
    for tag in ("script", "style", "template"):
        s = f"regexp_replace({s}, '(?is)<{tag}[\\s>].*?</{tag}\\s*>', chr(1), 'g')"
    s = f"string_split_regex({s}, '(?s)<[/!?]?[a-zA-Z][^>]*>|\\x01')"
    # At the end of its text node a reference may lack the semicolon.
    decoded = "regexp_replace(x, '&(copy|middot|quot|lt|gt|nbsp|amp)$', '&\\1;')"
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"),
                       ("nbsp", "\u00a0"), ("#39", "''"), ("#x27", "''"), ("amp", "&")):
        decoded = f"replace({decoded}, '&{name};', '{char}')"
    s = f"list_transform({s}, lambda x: {strip(decoded)})"
    return f"array_to_string(list_filter({s}, lambda x: x <> ''), chr(10))"


BOARDS = r"""
  parts AS (SELECT page_id, url,
      regexp_extract(url, '^(https?)://(.+?)\.example\.(com|net|org)/(.*)$', 1) AS scheme,
      regexp_extract(url, '^(https?)://(.+?)\.example\.(com|net|org)/(.*)$', 2) AS label,
      regexp_extract(url, '^(https?)://(.+?)\.example\.(com|net|org)/(.*)$', 3) AS family,
      regexp_extract(url, '^(https?)://(.+?)\.example\.(com|net|org)/(.*)$', 4) AS rest
    FROM pages),
  boards AS (SELECT page_id, url, scheme, label, rest,
      CASE family WHEN 'com' THEN 'lever' WHEN 'net' THEN 'greenhouse' ELSE 'ashby' END AS ats,
      scheme || '://' || CASE family WHEN 'com' THEN 'jobs.lever.co'
        WHEN 'net' THEN 'job-boards.greenhouse.io' ELSE 'jobs.ashbyhq.com' END || '/' ||
        CASE WHEN contains(rest, '?') THEN upper(label) ELSE label END || '/' || rest AS board_url
    FROM parts)"""

SETS = BOARDS + """,
  a AS (SELECT DISTINCT ats, label AS slug FROM boards WHERE scheme = 'http'),
  b AS (SELECT DISTINCT ats, label AS slug FROM boards WHERE scheme = 'https')"""

SYSTEMS = "(VALUES ('lever'), ('greenhouse'), ('ashby')) AS s(ats)"

COVERAGE = SETS + f""",
  report AS (SELECT ats,
      (SELECT count(*) FROM a WHERE a.ats = s.ats) AS cc,
      (SELECT count(*) FROM b WHERE b.ats = s.ats) AS simplify,
      (SELECT count(*) FROM a WHERE a.ats = s.ats AND slug NOT IN (SELECT slug FROM b WHERE b.ats = s.ats)) AS cc_only,
      (SELECT count(*) FROM b WHERE b.ats = s.ats AND slug NOT IN (SELECT slug FROM a WHERE a.ats = s.ats)) AS simplify_only,
      (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b) i WHERE i.ats = s.ats) AS "both",
      (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b) u WHERE u.ats = s.ats) AS "union"
    FROM {SYSTEMS})"""

MERGED_SLUGS = SETS + f""",
  merged AS (SELECT ats, slug, 0 AS is_new FROM a UNION ALL
             SELECT ats, slug, 1 FROM (SELECT * FROM b WHERE {valid('slug')} EXCEPT SELECT * FROM a))"""

ATTEMPTS = """
  raw AS (SELECT event_id, ['lever', 'greenhouse', 'ashby'][user_id % 3 + 1] AS ats,
      user_id || '-' || (CAST(props->>'$.k' AS INT) // 4) AS slug,
      CAST(props->>'$.k' AS INT) % 4 AS attempt, event_type AS kind, value FROM events),
  probe AS (SELECT *, CASE
      WHEN kind = 'signup' THEN 'dead'
      WHEN kind = 'error' OR value < 1 THEN 'error'
      WHEN kind = 'view' AND value < 4 THEN CASE ats WHEN 'greenhouse' THEN 'alive' ELSE 'dead' END
      WHEN kind = 'click' AND ats = 'ashby' THEN 'dead'
      ELSE 'alive' END AS outcome FROM raw)"""

COLLAPSED = ATTEMPTS + """,
  final AS (SELECT ats, slug, coalesce(
      arg_min(outcome, (attempt, outcome)) FILTER (outcome <> 'error'), 'error') AS outcome
    FROM probe WHERE attempt < 3 GROUP BY ats, slug)"""


# --- state ------------------------------------------------------------------------------

EPOCH = "CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT)"
STATE = f"""
  state AS (SELECT 'lever:' || o_orderkey AS job_id, o_orderstatus AS title,
      'C' || o_custkey AS company_name,
      CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS description_text,
      o_totalprice AS min_salary, {EPOCH} AS seen,
      {hashed('o_orderstatus', "'orders'", "''", "CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END")} AS content_hash
    FROM orders WHERE o_orderstatus IN ('O', 'F'))"""
BATCH = f"""
  batch AS (SELECT 'lever:' || l_orderkey AS job_id, l_linestatus AS title,
      CASE WHEN l_returnflag <> 'N' THEN l_returnflag || ' ' || l_partkey END AS description_text,
      CAST(l_suppkey AS VARCHAR) AS department, l_quantity AS min_salary,
      l_extendedprice AS max_salary, l_linenumber AS pos, l_extendedprice, l_partkey, l_suppkey,
      {hashed('l_linestatus', "'orders'", "''")} AS lookup_hash
    FROM lineitem)"""
ACTIONS = STATE + "," + BATCH + f""",
  acted AS (SELECT batch.*, CASE WHEN state.job_id IS NULL THEN 'new'
      WHEN state.content_hash = lookup_hash THEN 'touch' ELSE 'update' END AS action
    FROM batch LEFT JOIN state USING (job_id))"""
_ORDER = ", ".join(LINE_ORDER)
LINES = ACTIONS + f""",
  written AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY {', '.join(f'{c} DESC' for c in LINE_ORDER)}) AS back
    FROM acted WHERE action <> 'touch'),
  texts AS (SELECT job_id, description_text FROM (SELECT job_id, description_text,
      row_number() OVER (PARTITION BY job_id ORDER BY {', '.join(f'{c} DESC' for c in LINE_ORDER)}) AS back
      FROM acted WHERE action <> 'touch' AND description_text IS NOT NULL) WHERE back = 1),
  ids AS (SELECT DISTINCT job_id FROM batch)"""

CUSTOMERS = f"""
  state AS (SELECT CAST(c_custkey AS VARCHAR) AS slug,
      CASE WHEN c_nationkey <> 3 THEN c_name END AS name, {RUN_1} AS last_probed_at,
      CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS is_dead
    FROM customer WHERE c_acctbal > 0),
  run AS (SELECT CAST(c_custkey AS VARCHAR) AS slug,
      CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN lower(c_name) END AS name,
      c_mktsegment <> 'FURNITURE' AS alive FROM customer)"""


def companies_after(mark_dead: bool) -> str:
    dead = "WHEN run.slug IS NOT NULL AND NOT run.alive THEN 1" if mark_dead else ""
    return f"""WITH {CUSTOMERS}
    SELECT 'lever:' || coalesce(state.slug, run.slug) AS company_id,
      coalesce(state.slug, run.slug) AS slug, 'lever' AS ats,
      CASE WHEN run.alive THEN coalesce(run.name, state.name) ELSE state.name END AS name,
      CAST(CASE WHEN run.alive THEN {RUN_2} ELSE state.last_probed_at END AS BIGINT) AS last_probed_at,
      CAST(CASE WHEN run.alive THEN 0 {dead} ELSE state.is_dead END AS INT) AS is_dead
    FROM state FULL JOIN run ON state.slug = run.slug
    WHERE state.slug IS NOT NULL OR run.alive"""


NAMED = """
  named AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
      THEN 'C' || o_custkey END AS company_name FROM orders),
  ours AS (SELECT company_name, count(*) AS job_count FROM named
    WHERE company_name IS NOT NULL GROUP BY company_name)"""
COMPARED = NAMED + """,
  theirs AS (SELECT company_name, count(*) AS n FROM named
    WHERE company_name IS NOT NULL AND o_orderstatus = 'O' GROUP BY company_name),
  failed AS (SELECT 'C' || c_custkey AS company_name FROM customer WHERE c_mktsegment = 'FURNITURE')"""


def compared(ours: str) -> str:
    return f"""SELECT company_name AS company, job_count AS ours,
      CASE WHEN f THEN -1 ELSE n END AS simplify,
      CASE WHEN NOT f THEN job_count - n END AS diff,
      CASE WHEN NOT f AND abs(job_count - n) > 5 AND abs(job_count - n) > 0.3 * job_count
        THEN 1 ELSE 0 END AS is_outlier
    FROM (SELECT ours.company_name, job_count, coalesce(n, 0) AS n,
            ours.company_name IN (SELECT company_name FROM failed) AS f
          FROM {ours} ours LEFT JOIN theirs USING (company_name))"""


# The test tables hold more than 50 companies, so the sample is two halves.
SAMPLE = """
  head AS (SELECT * FROM ours ORDER BY job_count DESC, company_name LIMIT 25),
  sample AS (SELECT * FROM head UNION ALL (SELECT * FROM ours
    WHERE company_name NOT IN (SELECT company_name FROM head)
    ORDER BY sha256('7|' || company_name), company_name LIMIT 25))"""

# --- payloads ---------------------------------------------------------------------------


def payload(rows: str, ats: str, city: str = "city", state: str = "state",
            country: str = "country") -> str:
    """Job rows from CTE `rows` (id, slug, loc, title, ...) after `place`."""
    return f"""WITH {rows},{located('rows')}
    SELECT '{ats}:' || id AS job_id, '{ats}' AS ats, '{ats}:' || slug AS company_id,
      id AS ats_job_id, title, company_name, description_text, loc AS location_raw,
      {city} AS city, {state} AS state, {country} AS country,
      CAST(CASE WHEN flag THEN 1 ELSE remote END AS INT) AS is_remote, department,
      employment_type, {level('title')} AS experience_level,
      CAST(min_salary AS DOUBLE) AS min_salary, CAST(max_salary AS DOUBLE) AS max_salary,
      apply_url, CAST({RUN_1} AS BIGINT) AS "now",
      {hashed('title', 'slug', 'loc', 'description_text')} AS content_hash FROM place"""


LEVER = payload(f"""
  rows AS (SELECT CAST(doc_id AS VARCHAR) AS id, source AS slug,
      {filled(LOCATIONS, 'doc_id', 'source')} AS loc, {filled(TITLES, 'doc_id', 'source')} AS title,
      CAST(NULL AS VARCHAR) AS company_name,
      CASE WHEN {strip('text')} = '' THEN '' ELSE text || chr(10) || chr(10) END
        || source || chr(10) || chr(10) || lang || chr(10) || 'a & b' AS description_text,
      CASE WHEN lang = 'fr' THEN 'FR' END AS override, lang = 'de' AS flag,
      CASE WHEN lang = 'en' THEN source ELSE lang END AS department,
      {employment(filled(COMMITMENTS, 'doc_id', "''"))} AS employment_type,
      n_chars AS min_salary, n_chars * 1.5 AS max_salary,
      CASE WHEN lang = 'en' THEN 'https://jobs.lever.co/' || source || '/' || doc_id || '/apply'
           ELSE 'https://apply/' || doc_id END AS apply_url
    FROM documents)""", "lever",
    country="coalesce(override, country)")

GREENHOUSE = payload(f"""
  rows AS (SELECT CAST(page_id + 8000000000 AS VARCHAR) AS id, 'p' || page_id AS slug,
      {filled(LOCATIONS, 'page_id', "'Lund'")} AS loc, {filled(TITLES, 'page_id', "'Data'")} AS title,
      CASE WHEN page_id % 2 = 0 THEN 'Co ' || page_id END AS company_name,
      {html_text('html')} AS description_text, page_id % 5 = 0 AS flag,
      CASE WHEN page_id % 4 <> 0 THEN 'Eng' END AS department, 'full-time' AS employment_type,
      NULL AS min_salary, NULL AS max_salary,
      CASE WHEN page_id % 3 = 0 THEN url ELSE 'https://job-boards.greenhouse.io/p' || page_id
        || '/jobs/' || (page_id + 8000000000) END AS apply_url
    FROM pages)""", "greenhouse")

ASHBY = payload(f"""
  rows AS (SELECT CASE WHEN bare THEN 'n' ELSE '' END || doc_id AS id, source AS slug, source, lang,
      {filled(LOCATIONS, 'doc_id', 'source')} AS loc,
      {strip(filled(TITLES, 'doc_id', 'source'))} AS title,
      CAST(NULL AS VARCHAR) AS company_name,
      CASE WHEN NOT bare AND text <> '' THEN text
           ELSE lang || chr(10) || '© ' || source END AS description_text,
      lang IN ('de', 'fr') AS flag,
      CASE WHEN lang = 'en' THEN source ELSE lang END AS department,
      {employment(filled(COMMITMENTS, 'doc_id', "''"))} AS employment_type,
      n_chars AS min_salary, NULL AS max_salary,
      'https://jobs.ashbyhq.com/' || source || '/' || CASE WHEN bare THEN 'n' ELSE '' END || doc_id
        || '/application' AS apply_url
    FROM documents, (VALUES (false), (true)) v(bare)
    WHERE lang <> 'es' AND (NOT bare OR doc_id % 7 = 3))""", "ashby",
    city="coalesce(city, 'Town ' || source)", state="coalesce(state, 'Region')",
    country="coalesce(country, CASE lang WHEN 'en' THEN 'US' WHEN 'fr' THEN 'CA' WHEN 'de' THEN 'DE' END)")

# --- two runs ---------------------------------------------------------------------------

RUNS = f"""
  docs AS (SELECT *, source || '-' || doc_id AS slug,
      CASE lang WHEN 'en' THEN 'lever' WHEN 'fr' THEN 'greenhouse' ELSE 'ashby' END AS ats,
      lang <> 'es' AS in_1, coalesce(quality, 1) <> 0 AS in_2, doc_id % 3 = 0 AS twice,
      CASE lang WHEN 'en' THEN 'Austin, Texas' WHEN 'fr' THEN 'Paris, FR'
        WHEN 'de' THEN 'Berlin, Germany (Remote)' ELSE 'Madrid, ES' END AS loc,
      CASE lang WHEN 'fr' THEN {strip('text')} ELSE text END AS body
    FROM documents LEFT JOIN labels USING (doc_id)),
  seen AS (SELECT *, CASE WHEN twice AND NOT (in_1 AND in_2) THEN 'Lead ' ELSE 'Engineer ' END
      || source AS title, twice AND NOT (in_1 AND in_2) AS bare
    FROM docs WHERE in_1 OR in_2)"""

FULL_RUN = f"""WITH {RUNS}
  SELECT ats || ':' || doc_id AS job_id, ats, ats || ':' || slug AS company_id,
    CAST(doc_id AS VARCHAR) AS ats_job_id, title,
    CASE ats WHEN 'greenhouse' THEN 'Company ' || source ELSE slug END AS company_name,
    body AS description_text, loc AS location_raw,
    CASE lang WHEN 'en' THEN 'Austin' WHEN 'fr' THEN 'Paris' WHEN 'de' THEN 'Berlin' ELSE 'Madrid' END AS city,
    CASE lang WHEN 'en' THEN 'TX' END AS state,
    CASE lang WHEN 'en' THEN 'US' WHEN 'fr' THEN 'FR' WHEN 'es' THEN 'ES' END AS country,
    CASE WHEN lang = 'de' THEN 1 ELSE 0 END AS is_remote, CAST(NULL AS VARCHAR) AS department,
    'full-time' AS employment_type, {level('title')} AS experience_level,
    CAST(NULL AS DOUBLE) AS min_salary, CAST(NULL AS DOUBLE) AS max_salary,
    CASE ats WHEN 'lever' THEN 'https://jobs.lever.co/' || slug || '/' || doc_id || '/apply'
      WHEN 'greenhouse' THEN 'https://job-boards.greenhouse.io/' || slug || '/jobs/' || doc_id
      ELSE 'https://jobs.ashbyhq.com/' || slug || '/' || doc_id || '/application' END AS apply_url,
    CAST(CASE WHEN in_1 THEN {RUN_1} ELSE {RUN_2} END AS BIGINT) AS first_seen_at,
    CAST(CASE WHEN in_2 THEN {RUN_2} ELSE {RUN_1} END AS BIGINT) AS last_seen_at,
    {hashed('title', 'slug', 'loc', 'CASE WHEN NOT bare THEN body END')} AS content_hash
  FROM seen WHERE in_2"""

FULL_RUN_STATS = f"""WITH {RUNS}
  SELECT ats, count(*) FILTER (in_2) AS companies, count(*) FILTER (NOT in_2) AS dead,
    0::BIGINT AS errors,
    CAST(coalesce(sum(CASE WHEN twice THEN 2 ELSE 1 END) FILTER (in_2 AND NOT in_1), 0) AS BIGINT) AS jobs_new,
    count(*) FILTER (in_1 AND in_2 AND coalesce(body, '') <> '') AS jobs_updated
  FROM docs GROUP BY ats"""

FULL_RUN_TOTALS = f"""WITH {RUNS}
  SELECT count(*) FILTER (in_2) AS companies,
    CAST(coalesce(sum(CASE WHEN twice THEN 2 ELSE 1 END) FILTER (in_2 AND NOT in_1), 0) AS BIGINT) AS jobs_new,
    count(*) FILTER (in_1 AND in_2 AND coalesce(body, '') <> '') AS jobs_updated,
    count(*) FILTER (in_1 AND NOT in_2) AS purged
  FROM docs"""

FEED = f"""WITH {RUNS}
  SELECT ats || ':' || slug AS company_id, slug, ats,
    CASE ats WHEN 'greenhouse' THEN 'Company ' || source ELSE slug END AS name,
    CAST(CASE WHEN in_2 THEN {RUN_2} ELSE {RUN_1} END AS BIGINT) AS last_probed_at,
    CASE WHEN in_2 THEN 0 ELSE 1 END AS is_dead
  FROM seen"""


INDEX_LINES = r"""
  k AS (SELECT page_id, url, array_to_string(list_reverse(string_split(
            regexp_extract(url, '^https?://([^/]+)', 1), '.')), ',') || ')'
            || regexp_extract(url, '^https?://[^/]+(.*)$', 1) || ' 20260101000000' AS key,
            'cdx-' || lpad(CAST(page_id // 64 AS VARCHAR), 5, '0') || '.gz' AS shard,
            page_id // 2 * 1000 AS off FROM pages),
          x AS (SELECT *, key || chr(9) || shard || chr(9) || off || CASE WHEN contains(url, '#') THEN ''
            ELSE chr(9) || (page_id + 100) || chr(9) || page_id END AS line FROM k)"""

ORACLES = {
    "slug_by_family": f"""WITH {BOARDS} SELECT ats, count(DISTINCT label) AS slugs, count(*) AS pages
        FROM boards WHERE {valid('label')} GROUP BY ats""",
    "host_match": r"""WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
          regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path FROM pages)
        SELECT page_id, host, path,
          CASE WHEN contains(host, 'example.co') THEN 'co' WHEN contains(host, 'example.net') THEN 'net'
               WHEN contains(host, 'blog') THEN 'blog' END AS family,
          CASE WHEN host LIKE '%.example.net' THEN 'net' END AS domain FROM p""",
    "slug_valid": f"""WITH {BOARDS}, c AS (SELECT page_id, list_concat(string_split(url, '/'),
          [label, 'api-' || label, 'static' || label, 'Assets' || label, 'EMBED', 'robots.txt',
           CAST(page_id AS VARCHAR), label || ' x', label || '#top', label[1]]) AS l FROM boards),
        e AS (SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS pos, unnest(l) AS slug FROM c)
        SELECT page_id, pos, slug, CASE WHEN {valid('slug')} THEN 1 ELSE 0 END AS is_valid FROM e""",
    "slug_decode": f"""WITH {BOARDS} SELECT page_id, lower(url_decode(replace(label, '.', '%2E')
          || '%20+' || upper(label) || '%zz%C3%A9%')) AS mixed, lower(board_url) AS plain FROM boards""",
    "url_index_scan": f"""WITH {BOARDS} SELECT DISTINCT ats, label AS slug FROM boards WHERE {valid('label')}""",
    "block_lookup": f"""WITH {INDEX_LINES},
          l AS (SELECT *, lag(line) OVER (ORDER BY line) AS prev FROM x),
          h AS (SELECT prefix, shard, off, page_id + 100 AS length, line,
              row_number() OVER (PARTITION BY prefix, shard, off ORDER BY line) AS rn
            FROM l, (VALUES ('com,example,'), ('net,example,th'), ('org,example,thther,'),
              ('net,example,zzz'), ('dd'), ('a'), ('zz'), ('com,example,tionsh,blog)')) AS p(prefix)
            WHERE (starts_with(line, prefix) OR (prev < prefix AND prefix <= line))
              AND NOT contains(url, '#'))
        SELECT prefix, shard, off AS "offset", length, line AS first_line FROM h WHERE rn = 1""",
    "redirect_resolve": f"""WITH {BOARDS} SELECT DISTINCT ats, label AS slug FROM boards WHERE {valid('label')}""",
    "first_hit_per_group": """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (
          PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
    "location_parse": f"""WITH rows AS (SELECT c_custkey,
          {filled(LOCATIONS, 'c_custkey', 'c_mktsegment')} AS loc FROM customer),{located('rows')}
        SELECT c_custkey, loc AS raw, city, state, country, remote AS is_remote FROM place""",
    "experience_level": f"""WITH t AS (SELECT o_orderkey,
          {filled(TITLES, 'o_orderkey', 'o_orderpriority')} AS title FROM orders)
        SELECT o_orderkey, title, {level('title')} AS level FROM t""",
    "employment_type": f"""WITH t AS (SELECT o_orderkey,
          {filled(COMMITMENTS, 'o_orderkey', "''")} AS raw FROM orders)
        SELECT o_orderkey, raw, {employment('raw')} AS employment_type FROM t""",
    "label_rules_text": f"""WITH t AS (
          SELECT 'p_type' AS source, p_partkey AS id, p_type AS raw FROM part
          UNION ALL SELECT 'p_name', p_partkey, p_name FROM part
          UNION ALL SELECT 'text', doc_id, split_part(text, chr(10), 1) FROM documents
          UNION ALL SELECT 'literal', i, ([{quoted(COMMITMENTS)}])[i + 1]
            FROM range({len(COMMITMENTS)}) AS r(i))
        SELECT source, id, raw, {employment('raw')} AS employment_type, {level('raw')} AS level FROM t""",
    "content_hash": f"""SELECT doc_id,
          {hashed('split_part(text, chr(10), 1)', 'source', 'lang', 'text')} AS content_hash
        FROM documents""",
    "html_text": f"SELECT page_id, {html_text('html')} AS body FROM pages",
    "slug_merge": f"""WITH {MERGED_SLUGS} SELECT ats, CAST(sum(is_new) AS BIGINT) AS new_count,
          count(*) AS total FROM merged GROUP BY ats""",
    "slug_membership": f"""WITH {SETS} SELECT coalesce(a.ats, b.ats) AS ats, coalesce(a.slug, b.slug) AS slug,
          CASE WHEN a.slug IS NULL THEN 0 ELSE 1 END AS in_a, CASE WHEN b.slug IS NULL THEN 0 ELSE 1 END AS in_b
        FROM a FULL JOIN b ON a.ats = b.ats AND a.slug = b.slug""",
    "slug_cleaning": f"""WITH {BOARDS}, p AS (SELECT DISTINCT ats, unnest(string_split_regex(rest, '[/.]')) AS slug
          FROM boards)
        SELECT s.ats, count(*) FILTER (NOT {valid('slug')}) AS removed,
          count(*) FILTER ({valid('slug')}) AS remaining FROM {SYSTEMS} LEFT JOIN p USING (ats) GROUP BY s.ats""",
    "coverage_report": f"WITH {COVERAGE} SELECT * FROM report",
    "coverage_totals": f"""WITH {COVERAGE} SELECT CAST(sum(cc_only) AS BIGINT) AS cc_only,
          CAST(sum(simplify_only) AS BIGINT) AS simplify_only, CAST(sum("both") AS BIGINT) AS "both" FROM report""",
    "slugs_per_source": f"""WITH {BOARDS} SELECT scheme AS source, ats, count(DISTINCT label) AS slugs
        FROM boards GROUP BY ALL""",
    "slug_files": f"WITH {BOARDS} SELECT DISTINCT ats, label AS slug FROM boards",
    "raw_set_roundtrip": f"""WITH {SETS} SELECT 'cc' AS source, ats, slug FROM a
        UNION ALL SELECT 'simplify', ats, slug FROM b""",
    "probe_outcome": f"""WITH {ATTEMPTS} SELECT event_id, ats, outcome, CASE WHEN outcome = 'alive' THEN
          CASE WHEN kind = 'click' OR value < 4 AND kind = 'view' OR kind = 'view' AND ats = 'ashby'
            THEN 0 ELSE 1 END END AS n_postings FROM probe""",
    "retry_collapse": f"WITH {COLLAPSED} SELECT * FROM final",
    "run_stats": f"""WITH {COLLAPSED} SELECT ats, count(*) FILTER (outcome = 'alive') AS companies,
          count(*) FILTER (outcome = 'dead') AS dead, count(*) FILTER (outcome = 'error') AS errors
        FROM final GROUP BY ats""",
    "payload_lever": LEVER,
    "payload_greenhouse": GREENHOUSE,
    "payload_ashby": ASHBY,
    "board_union": f"""SELECT ats, experience_level, is_remote, count(*) AS jobs, count(country) AS with_country
        FROM (({LEVER}) UNION ALL BY NAME ({GREENHOUSE}) UNION ALL BY NAME ({ASHBY})) GROUP BY ALL""",
    "batch_first_name": """WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey,
          'P' || l_partkey AS name FROM lineitem WHERE l_returnflag = 'R'),
        f AS (SELECT l_orderkey, arg_min(name, (l_linenumber, l_partkey)) AS name FROM n GROUP BY 1)
        SELECT o.l_orderkey AS company_id, f.name AS company_name
        FROM (SELECT DISTINCT l_orderkey FROM lineitem) o LEFT JOIN f USING (l_orderkey)""",
    "existence_lookup": f"""WITH {STATE} SELECT job_id, content_hash,
          CASE WHEN description_text IS NULL THEN 0 ELSE 1 END AS has_desc FROM state
        WHERE job_id IN (SELECT 'lever:' || l_orderkey FROM lineitem)""",
    "change_classify": f"WITH {ACTIONS} SELECT job_id, action, count(*) AS n FROM acted GROUP BY ALL",
    "name_fallback": f"""WITH {CUSTOMERS} SELECT 'lever' AS ats, run.slug,
          CASE WHEN run.name IS NOT NULL THEN run.name WHEN state.slug IS NOT NULL THEN state.name
            ELSE run.slug END AS company_name FROM run LEFT JOIN state ON run.slug = state.slug""",
    "company_upsert": companies_after(True),
    "state_snapshot": companies_after(False),
    "job_upsert": f"""WITH {LINES} SELECT coalesce(s.job_id, i.job_id) AS job_id,
          coalesce(w.title, s.title) AS title,
          CASE WHEN w.job_id IS NOT NULL THEN 'Lines' ELSE s.company_name END AS company_name,
          coalesce(t.description_text, s.description_text) AS description_text,
          CASE WHEN w.job_id IS NOT NULL THEN w.department ELSE 'stored' END AS department,
          CASE WHEN w.job_id IS NOT NULL THEN w.min_salary ELSE s.min_salary END AS min_salary,
          w.max_salary, coalesce(s.seen, {RUN_1}) AS first_seen_at,
          CASE WHEN i.job_id IS NOT NULL THEN {RUN_1} ELSE s.seen END AS last_seen_at,
          CASE WHEN w.job_id IS NOT NULL THEN {hashed('w.title', "'orders'", "''", 'w.description_text')}
            ELSE s.content_hash END AS content_hash
        FROM state s FULL JOIN ids i ON s.job_id = i.job_id
        LEFT JOIN (SELECT * FROM written WHERE back = 1) w ON w.job_id = coalesce(s.job_id, i.job_id)
        LEFT JOIN texts t ON t.job_id = coalesce(s.job_id, i.job_id)""",
    "job_upsert_counts": f"""WITH {ACTIONS} SELECT count(*) FILTER (action = 'new') AS rows_new,
          count(*) FILTER (action = 'update') AS rows_updated,
          count(*) FILTER (action = 'touch') AS rows_touched FROM acted""",
    "purge_stale": f"""SELECT 'lever:' || o_orderkey AS job_id, {EPOCH} AS last_seen_at FROM orders
        WHERE {EPOCH} >= {CUTOFF}""",
    "purge_count": f"""SELECT 'lever' AS ats, count(*) AS purged FROM orders
        WHERE {EPOCH} < {CUTOFF}""",
    "meta_put_get": f"""WITH e AS (SELECT CAST(o_custkey AS VARCHAR) AS key, CAST(max({EPOCH}) AS VARCHAR) AS value
          FROM orders GROUP BY 1),
        m AS (SELECT CAST(c_custkey AS VARCHAR) AS key, c_mktsegment AS value FROM customer)
        SELECT coalesce(e.key, m.key) AS key, CASE WHEN e.key IS NULL THEN m.value ELSE e.value END AS value
        FROM m FULL JOIN e ON m.key = e.key""",
    "constraint_check": """WITH c AS (SELECT CAST(l_orderkey AS VARCHAR) AS company_id,
          CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS slug, l_linestatus AS ats FROM lineitem)
        SELECT 'companies' AS "table", 'primary key' AS rule, 'company_id' AS columns,
          count(*) - count(DISTINCT company_id) AS violations FROM c
        UNION ALL SELECT 'companies', 'unique', 'ats,slug', count(*) - count(DISTINCT (ats, slug))
          FROM c WHERE slug IS NOT NULL
        UNION ALL SELECT 'companies', 'not null', 'company_id', count(*) FILTER (company_id IS NULL) FROM c
        UNION ALL SELECT 'companies', 'not null', 'slug', count(*) FILTER (slug IS NULL) FROM c
        UNION ALL SELECT 'companies', 'not null', 'ats', count(*) FILTER (ats IS NULL) FROM c""",
    "count_by_company": f"WITH {NAMED} SELECT * FROM ours",
    "external_count": f"""WITH {BOARDS},
          p AS (SELECT upper(substr(label, 1, 1)) || lower(substr(label, 2)) AS company_name, page_id FROM boards),
          w AS (SELECT company_name FROM p WHERE company_name IS NOT NULL UNION SELECT c_name FROM customer)
        SELECT w.company_name, count(p.page_id) AS job_count FROM w LEFT JOIN p USING (company_name)
        WHERE w.company_name IS NOT NULL GROUP BY 1""",
    "external_count_all": f"""WITH {BOARDS},
          p AS (SELECT upper(substr(label, 1, 1)) || lower(substr(label, 2)) AS company_name, page_id FROM boards),
          w AS (SELECT company_name FROM p UNION SELECT 'No Such')
        SELECT w.company_name, count(p.page_id) AS job_count FROM w LEFT JOIN p USING (company_name)
        WHERE w.company_name IS NOT NULL GROUP BY 1""",
    "count_compare": f"WITH {COMPARED} {compared('ours')}",
    "compare_summary": f"""WITH {COMPARED}, c AS ({compared('ours')})
        SELECT count(*) AS sampled, count(diff) AS valid, round(avg(diff), 6) AS avg_diff,
          count(*) FILTER (diff > 0) AS more, count(*) FILTER (diff < 0) AS less,
          count(*) FILTER (diff = 0) AS equal FROM c""",
    "head_tail_sample": f"WITH {NAMED},{SAMPLE} SELECT * FROM sample",
    "paged_search": """SELECT p_partkey, p_name, p_size FROM part WHERE p_size >= 10
        ORDER BY p_name, p_partkey LIMIT 250 OFFSET 500""",
    "full_run": FULL_RUN,
    "full_run_stats": FULL_RUN_STATS,
    "full_run_totals": FULL_RUN_TOTALS,
    "incremental_feed": FEED,
    "incremental_feed_jobs": FULL_RUN,
    "registry_extra_board": """SELECT DISTINCT 'pages' AS ats, slug FROM (
        SELECT regexp_extract(url, 'https?://[a-z.]+\\.example\\.(?:com|net|org)/([a-z]+)/[0-9]+', 1) AS slug
        FROM pages) WHERE slug <> ''""",
    "discovery_run_index": f"WITH {MERGED_SLUGS.replace('FROM b WHERE', 'FROM (SELECT DISTINCT ats, label AS slug FROM boards) WHERE')} SELECT * FROM merged",
    "discovery_run_aggregator": f"""WITH {BOARDS}, one AS (SELECT *, row_number() OVER (PARTITION BY label
          ORDER BY length(url), CAST(page_id AS VARCHAR)) AS rn FROM boards),
        a AS (SELECT DISTINCT ats, label AS slug FROM boards WHERE scheme = 'http'),
        b AS (SELECT DISTINCT ats, label AS slug FROM one WHERE rn = 1 AND {valid('label')}),
        m AS (SELECT *, 0 AS is_new FROM a UNION ALL SELECT *, 1 FROM (SELECT * FROM b EXCEPT SELECT * FROM a))
        SELECT ats, CAST(sum(is_new) AS BIGINT) AS new_count, count(*) AS total FROM m GROUP BY ats""",
    "validation_run": f"WITH {COVERAGE} SELECT * FROM report",
    "validation_run_counts": f"WITH {COMPARED},{SAMPLE} {compared('sample')}",
    "previous_key": f"""WITH {INDEX_LINES} SELECT line, lag(line) OVER (ORDER BY line) AS previous FROM x""",
    "page_directory": """WITH r AS (SELECT o_orderpriority, o_orderkey, o_custkey,
          row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders),
        p AS (SELECT *, CAST(pos // 250 + 1 AS INT) AS page, (n + 249) // 250 AS last FROM r)
        SELECT o_orderpriority, o_orderkey, o_custkey, page FROM p WHERE page IN (1, last // 2, last)
        UNION ALL SELECT * FROM (SELECT o_orderpriority, o_orderkey, o_custkey, 0 FROM r
          WHERE o_orderpriority > '3-MEDIUM' OR o_orderpriority = '3-MEDIUM' AND o_orderkey > 100
          ORDER BY o_orderpriority, o_orderkey LIMIT 250)""",
    "host_pattern_table": """WITH h AS (SELECT page_id, lower(regexp_extract(url, '^https?://([^/]+)', 1)) AS host,
          substr(regexp_extract(url, '^(https?)://(.+?)\\.example\\.(com|net|org)/(.*)$', 2), 2, 5) AS pattern FROM pages),
        q AS (SELECT pattern, min(page_id) AS rank FROM h WHERE pattern <> '' GROUP BY pattern),
        f AS (SELECT h.host, min(rank) AS rank, arg_min(q.pattern, q.rank) AS pattern
          FROM (SELECT DISTINCT host FROM h) h JOIN q ON contains(h.host, q.pattern) GROUP BY h.host)
        SELECT h.page_id, h.host, f.rank, f.pattern FROM h LEFT JOIN f USING (host)""",
    "coverage_rollup": f"""WITH {SETS}, m AS (SELECT ats, slug, max(x) AS x, max(y) AS y FROM (
            SELECT ats, slug, 1 AS x, 0 AS y FROM a UNION ALL SELECT ats, slug, 0, 1 FROM b) GROUP BY ats, slug)
        SELECT ats, CAST(grouping(ats) AS INT) AS level, count(*) FILTER (x = 1) AS cc,
          count(*) FILTER (y = 1) AS simplify, count(*) FILTER (x = 1 AND y = 0) AS cc_only,
          count(*) FILTER (y = 1 AND x = 0) AS simplify_only, count(*) FILTER (x = 1 AND y = 1) AS "both",
          count(*) AS "union" FROM m GROUP BY ROLLUP (ats)""",
    "slugs_per_source_rollup": f"""WITH {BOARDS}, d AS (SELECT DISTINCT scheme AS source, ats, label FROM boards)
        SELECT source, ats, CAST(grouping(source, ats) AS INT) AS level, count(*) AS slugs
        FROM d GROUP BY ROLLUP (source, ats)""",
    "run_stats_rollup": f"""WITH {COLLAPSED} SELECT ats, CAST(grouping(ats) AS INT) AS level,
          count(*) FILTER (outcome = 'alive') AS companies, count(*) FILTER (outcome = 'dead') AS dead,
          count(*) FILTER (outcome = 'error') AS errors FROM final GROUP BY ROLLUP (ats)""",
    "job_lookup": """SELECT 'lever:' || o_orderkey AS job_id,
          substr(sha256(lower(o_orderstatus) || '|orders|' || CASE WHEN o_orderstatus = 'O' THEN '|' || o_orderpriority
            ELSE '' END), 1, 16) AS content_hash, CAST(o_orderstatus = 'O' AS INT) AS has_desc
        FROM orders WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders)""",
    "landed_postings": f"""WITH {BOARDS} SELECT label AS company_id,
          upper(label[1]) || lower(label[2:]) AS company_name,
          CAST(page_id AS VARCHAR) AS posting_id, CAST(length(url) AS INT) AS hit_rank FROM boards""",
    "redirect_failures": f"""WITH {BOARDS}, h AS (SELECT page_id, ats, label, CASE
            WHEN ats = 'greenhouse' THEN replace(board_url, 'greenhouse.io', 'example.com')
            WHEN length(board_url) % 5 = 0 THEN regexp_replace(board_url, '(lever[.]co/).*', '\\1embed')
            ELSE board_url END AS hop FROM boards)
        SELECT CASE WHEN contains(hop, '?') THEN 'no_redirect' WHEN ats = 'greenhouse' THEN 'no_board'
            WHEN hop LIKE '%lever.co/embed' OR NOT {valid('label')} THEN 'bad_slug' ELSE 'resolved' END AS reason,
          count(*) AS postings FROM h GROUP BY reason""",
    "discovery_run_blocks": f"""WITH {INDEX_LINES}, l AS (SELECT *, lag(line) OVER (ORDER BY line) AS prev FROM x),
        hits AS (SELECT DISTINCT shard, off FROM l, (VALUES ('com,example,t'), ('com,example,e'), ('org,example,th'))
            AS p(prefix) WHERE (starts_with(line, prefix) OR (prev < prefix AND prefix <= line))
          AND NOT contains(url, '#')),
        {BOARDS},
        near AS (SELECT DISTINCT ats, label AS slug FROM boards JOIN k USING (page_id) JOIN hits USING (shard, off)
          WHERE ats IN ('lever', 'ashby') AND {valid('label')}),
        a AS (SELECT DISTINCT ats, label AS slug FROM boards WHERE scheme = 'http')
        SELECT ats, slug, 0 AS is_new FROM a UNION ALL SELECT ats, slug, 1 FROM (SELECT * FROM near EXCEPT SELECT * FROM a)""",
    "incremental_feed_replayed": FEED,
}
ORACLES["existence_lookup_bucketed"] = ORACLES["existence_lookup"]
