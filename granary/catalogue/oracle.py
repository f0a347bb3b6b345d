"""SQL twins of the queries, written from the meaning of each job for another engine.

They share no code with the implementation; only the fixed dates, addresses
and vocabulary constants are repeated here as text.
"""

from __future__ import annotations

import json

DOWNLOADS = """
downloads AS (
  SELECT l.l_suppkey AS project_id, l.l_partkey AS file_handle_id, o.o_custkey AS user_id,
         CAST(l.l_shipdate AS DATE) AS record_date,
         CASE WHEN l.l_linestatus = 'F' THEN 'prod' ELSE 'dev' END AS stack
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
files AS (
  SELECT p_partkey AS id, CAST(round(p_retailprice * 100) AS BIGINT) AS content_size FROM part
),
public_projects AS (
  SELECT s_suppkey AS project_id, s_name AS name FROM supplier WHERE s_acctbal > 0 AND s_suppkey != 1
)"""


def _public(condition: str) -> str:
    return f"""
public_stat AS (
  SELECT p.name, d.project_id, count(d.record_date) AS downloads, count(DISTINCT d.user_id) AS users,
         sum(f.content_size) AS bytes
  FROM downloads d JOIN public_projects p ON d.project_id = p.project_id
  JOIN files f ON d.file_handle_id = f.id
  WHERE {condition}
  GROUP BY d.project_id, p.name
),
public_board AS (
  SELECT 'syn' || CAST(project_id AS VARCHAR) AS project, name,
         CAST(downloads AS BIGINT) AS downloads_per_project,
         CAST(coalesce(bytes, 0) AS BIGINT) AS data_download_size,
         CAST(users AS BIGINT) AS number_of_unique_users_downloaded
  FROM public_stat
)"""


def _group(condition: str) -> str:
    return f"""
mappings AS (
  SELECT * FROM (VALUES (-100, 0, 'Group A'), (-98, 2, 'Group B'), (-97, 3, 'Group C')) v(file_view_id, region, group_name)
),
members AS (
  SELECT m.group_name, m.file_view_id, s.s_suppkey AS project_id
  FROM mappings m JOIN nation n ON n.n_regionkey = m.region JOIN supplier s ON s.s_nationkey = n.n_nationkey
),
member_count AS (
  SELECT group_name, file_view_id, count(DISTINCT project_id) AS total_projects FROM members GROUP BY ALL
),
group_stat AS (
  SELECT m.group_name AS name, m.file_view_id, count(DISTINCT d.project_id) AS active,
         count(d.record_date) AS downloads, count(DISTINCT d.user_id) AS users, sum(f.content_size) AS bytes
  FROM downloads d JOIN members m ON d.project_id = m.project_id JOIN files f ON f.id = d.file_handle_id
  WHERE {condition}
  GROUP BY ALL
),
group_board AS (
  SELECT 'syn' || CAST(g.file_view_id AS VARCHAR) AS project, g.name,
         CAST(g.active AS BIGINT) AS projects_with_downloads, CAST(c.total_projects AS BIGINT) AS total_projects,
         CAST(g.downloads AS BIGINT) AS downloads_per_project,
         CAST(coalesce(g.bytes, 0) AS BIGINT) AS data_download_size,
         CAST(g.users AS BIGINT) AS number_of_unique_users_downloaded
  FROM group_stat g LEFT JOIN member_count c ON g.file_view_id = c.file_view_id AND g.name = c.group_name
)"""


YESTERDAY = "d.record_date = DATE '1998-06-29'"
COMBINED = (
    f"WITH {DOWNLOADS}, {_public(YESTERDAY)}, {_group(YESTERDAY)}, "
    """combined AS (
  SELECT project, name, 0 AS projects_with_downloads, 0 AS total_projects, downloads_per_project,
         data_download_size, number_of_unique_users_downloaded FROM public_board
  UNION ALL
  SELECT project, name, projects_with_downloads, total_projects, downloads_per_project,
         data_download_size, number_of_unique_users_downloaded FROM group_board
)"""
)

COHORTS = """
cohorts AS (
  SELECT 'S' || l.l_orderkey AS sample_id, 'P' || o.o_custkey AS patient_id, l.l_returnflag AS cohort,
         year(l.l_shipdate) AS major, month(l.l_shipdate) AS minor,
         year(l.l_shipdate) || '_' || month(l.l_shipdate) || '_PUBLIC' AS release
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
)"""

PAIRS = f"""
main AS (
  SELECT 'S' || o_orderkey AS sample_id, 'P' || o_custkey AS patient_id, year(o_orderdate) AS major,
         quarter(o_orderdate) AS minor,
         year(o_orderdate) || '_' || quarter(o_orderdate) || '_CONSORTIUM' AS release
  FROM orders
), {COHORTS},
latest_cohort AS (
  SELECT cohort, major, minor FROM cohorts
  QUALIFY row_number() OVER (PARTITION BY cohort ORDER BY major DESC, minor DESC) = 1
),
latest_main AS (
  SELECT major, minor FROM main QUALIFY row_number() OVER (ORDER BY major DESC, minor DESC) = 1
),
main_pairs AS (
  SELECT DISTINCT m.sample_id, m.patient_id, m.release AS name, 'MAIN' AS kind
  FROM main m JOIN latest_main v ON m.major = v.major AND m.minor = v.minor
),
base AS (
  SELECT * FROM main_pairs
  UNION ALL
  SELECT DISTINCT c.sample_id, c.patient_id, c.release, 'COHORT_' || c.cohort
  FROM cohorts c JOIN latest_cohort v ON c.cohort = v.cohort AND c.major = v.major AND c.minor = v.minor
  UNION ALL
  SELECT DISTINCT 'S' || o_orderkey, 'P' || o_custkey, 'URGENT', 'SP_URGENT'
  FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus != 'P'
  UNION ALL
  SELECT DISTINCT 'S' || o_orderkey, 'P' || o_custkey, 'LOW', 'SP_LOW'
  FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus != 'P'
)"""

RECENT = """
recent AS (
  SELECT 'Entity ' || o.o_orderkey AS name, o.o_orderkey AS id, o.o_custkey AS project_id,
         CASE o.o_orderstatus WHEN 'O' THEN 'project' WHEN 'F' THEN 'file' ELSE 'folder' END AS node_type,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'dataset' WHEN '2-HIGH' THEN 'dataset, table' END AS content_type,
         CAST(o.o_orderdate AS DATE) AS created_on, o.o_custkey AS created_by,
         CASE WHEN c.c_acctbal < 0 OR c.c_acctbal IS NULL OR c.c_nationkey IS NULL THEN c.c_name
              ELSE concat(c.c_mktsegment, ' ', 'N' || c.c_nationkey) END AS user_name_full_name,
         o.o_totalprice > 200000 AS is_public
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
recent_kept AS (
  SELECT * FROM recent
  WHERE (node_type IN ('dataset', 'project') OR content_type = 'dataset')
    AND CAST(created_on AS TIMESTAMP) >= TIMESTAMP '2001-07-30 12:00:00' - INTERVAL 7 DAY
)"""

RUNS = """
runs AS (
  SELECT o.o_orderkey AS id, c.c_nationkey AS workspace_id, o.o_orderpriority AS project_name,
         o.o_orderstatus AS status, c.c_name AS user_name, o.o_orderdate AS date_created,
         CASE WHEN o.o_orderstatus != 'P' THEN o.o_orderdate END AS complete
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""
YEAR = "date_created BETWEEN TIMESTAMP '2000-08-01' AND TIMESTAMP '2001-08-01'"
PAST_MONTH = "date_created BETWEEN TIMESTAMP '2001-07-01' AND TIMESTAMP '2001-08-01'"
PAST_WEEK = "date_created >= TIMESTAMP '2001-07-25'"

USAGE = """
usage AS (
  SELECT p.p_partkey AS idx,
         p.p_name || CASE WHEN p.p_size > 25 THEN ' Resource pack' WHEN p.p_size > 15 THEN ' COMPONENT' ELSE ' report' END AS title,
         CAST(coalesce(u.views, 0) AS BIGINT) AS views, CAST(coalesce(u.unique_views, 0) AS BIGINT) AS unique_views,
         CAST(coalesce(u.downloads, 0) AS BIGINT) AS downloads, CAST(coalesce(u.unique_downloads, 0) AS BIGINT) AS unique_downloads,
         'https://example.org/records/' || p.p_partkey AS link,
         CASE WHEN p.p_size > 15 OR p.p_name ILIKE '%component%' OR p.p_name ILIKE '%resource%' THEN 'component' ELSE 'report' END AS category
  FROM part p LEFT JOIN (
    SELECT l_partkey, count(*) AS views, count(DISTINCT l_orderkey) AS unique_views,
           sum(CAST(l_quantity AS BIGINT)) AS downloads, count(DISTINCT l_suppkey) AS unique_downloads
    FROM lineitem GROUP BY l_partkey
  ) u ON u.l_partkey = p.p_partkey
)"""

ITEMS = """
mapped AS (
  SELECT p_partkey AS idx, 'id-' || p_partkey AS same_as, p_name || ' ' || p_brand || ' ' || p_size AS title,
         replace(p_name, ' ', ', ') AS keywords, p_type, p_size, p_retailprice
  FROM part
),
valid AS (SELECT * FROM mapped WHERE p_size BETWEEN 1 AND 45 AND p_retailprice > 901),
existing AS (SELECT DISTINCT 'id-' || l_partkey AS same_as FROM lineitem WHERE l_returnflag = 'R'),
fresh AS (SELECT * FROM valid WHERE same_as NOT IN (SELECT same_as FROM existing)),
dups AS (SELECT same_as FROM fresh QUALIFY count(*) OVER (PARTITION BY title) > 1),
judged AS (
  SELECT v.*, CASE WHEN v.same_as IN (SELECT same_as FROM dups) THEN 'duplicate'
                   WHEN v.p_size = 7 THEN 'ignored'
                   WHEN v.same_as IN (SELECT same_as FROM existing) THEN 'existing' ELSE 'new' END AS status
  FROM valid v
)"""

LINKS = """
links AS (
  SELECT 'syn' || p_partkey AS dataset, p_size % 3 AS dataset_version,
         'syn' || replace(p_brand, 'Brand#', '') AS dataset_collection,
         'https://objects.example.org/' || p_name AS object_url
  FROM part
),
desired AS (
  SELECT 'syn' || p_partkey AS dataset, CASE WHEN p_size > 40 THEN 9 ELSE p_size % 3 END AS dataset_version,
         'syn' || replace(p_brand, 'Brand#', '') AS dataset_collection,
         'https://objects.example.org/' || CASE WHEN p_type = 'ECONOMY' THEN 'new/' ELSE '' END || p_name AS object_url
  FROM part WHERE p_retailprice > 905
)"""

DOCS = """
docs AS (
  SELECT doc_id, text, lang, source, n_chars, replace(source, 'src', '') AS num,
         'syn' || replace(source, 'src', '') AS dataset_id, 'syn' || doc_id AS file_id,
         CASE WHEN lang = 'en' THEN 2 ELSE 1 END AS file_version,
         n_chars >= 100 AS present, n_chars >= 200 AS is_public
  FROM documents
),
attached AS (
  SELECT dataset_id, source, file_id, file_version, 'doc_' || doc_id AS name,
         CASE WHEN lang = 'fr' THEN 'Texte' ELSE 'Data file associated with doc_' || doc_id END AS description,
         CASE WHEN lang = 'en' AND is_public THEN 'text/plain'
              WHEN lang = 'de' THEN 'text/plain'
              WHEN lang = 'es' THEN 'application/octet-stream' ELSE 'text/csv' END AS encoding,
         CASE WHEN is_public THEN md5(file_version || ':' || text) ELSE 'unknown_md5' END AS md5
  FROM docs WHERE present
),
keyed AS (
  SELECT DISTINCT dataset_id, source,
         source || '_' || dataset_id || '.1_datasetCollection_syn900_croissant.jsonld' AS object_key
  FROM attached
),
fields AS (
  SELECT DISTINCT dataset_id, k AS key
  FROM (SELECT dataset_id, unnest(['lang', 'K_' || lang]) AS k FROM docs WHERE present)
)"""

# the vocabulary block of a document, as it has to appear in the text
CONTEXT_TEXT = json.dumps(
    {
        "@language": "en", "@vocab": "https://schema.org/", "citeAs": "cr:citeAs", "column": "cr:column",
        "conformsTo": "dct:conformsTo", "cr": "http://mlcommons.org/croissant/",
        "rai": "http://mlcommons.org/croissant/RAI/", "data": {"@id": "cr:data", "@type": "@json"},
        "dataType": {"@id": "cr:dataType", "@type": "@vocab"}, "dct": "http://purl.org/dc/terms/",
        "examples": {"@id": "cr:examples", "@type": "@json"}, "extract": "cr:extract", "field": "cr:field",
        "fileProperty": "cr:fileProperty", "fileObject": "cr:fileObject", "fileSet": "cr:fileSet",
        "format": "cr:format", "includes": "cr:includes", "isLiveDataset": "cr:isLiveDataset",
        "jsonPath": "cr:jsonPath", "key": "cr:key", "md5": "cr:md5", "parentField": "cr:parentField",
        "path": "cr:path", "recordSet": "cr:recordSet", "references": "cr:references", "regex": "cr:regex",
        "repeated": "cr:repeated", "replace": "cr:replace", "sc": "https://schema.org/",
        "separator": "cr:separator", "source": "cr:source", "subField": "cr:subField",
        "transform": "cr:transform",
    },
    separators=(",", ":"),
)

DOCUMENT_LINES = f"""
lines AS (
  SELECT object_key, 0 AS section,
    '{{"@context":{CONTEXT_TEXT},"@type":"Dataset","@id":"' || dataset_id || '.1","name":"' || source ||
    '","description":"' || CASE WHEN CAST(replace(source, 'src', '') AS INT) < 10 THEN 'All of ' || source ELSE 'Dataset for ' || source END ||
    '","url":"https://example.org/entity/' || dataset_id || '.1","datePublished":"2024-01-30T00:00:00.000Z","license":"' ||
    CASE WHEN CAST(replace(source, 'src', '') AS INT) < 10 THEN 'CC-0' ELSE 'unknown_license' END ||
    '","version":1,"dct:conformsTo":"http://mlcommons.org/croissant/1.0"' ||
    CASE WHEN CAST(replace(source, 'src', '') AS INT) < 10 THEN ',"keywords":["text","web"]' ELSE ',"title":"' || source || '"' END ||
    ',"distribution":[' AS line, '' AS place
  FROM keyed
  UNION ALL
  SELECT object_key, 1,
    '{{"@type":"FileObject","@id":"metadata","contentUrl":"https://example.org/entity/' || dataset_id ||
    '.1","name":"metadata","description":"Metadata associated with ' || source ||
    '","encodingFormat":"application/csv","md5":"unknown","sha256":"unknown"}}', ''
  FROM keyed
  UNION ALL
  SELECT k.object_key, 2,
    ',{{"@type":"FileObject","@id":"' || a.file_id || '.' || a.file_version || '","name":"' || a.name ||
    '","description":"' || a.description || '","contentUrl":"https://example.org/entity/' || a.file_id || '.' || a.file_version ||
    '","encodingFormat":"' || a.encoding || '","md5":"' || a.md5 || '","sha256":"unknown"}}', a.file_id || '.' || lpad(a.file_version::VARCHAR, 10, '0')
  FROM attached a JOIN keyed k ON a.dataset_id = k.dataset_id AND a.source = k.source
  UNION ALL
  SELECT object_key, 3,
    '],"recordSet":{{"@type":"RecordSet","@id":"default","name":"default","description":"Metadata for the dataset","field":[', ''
  FROM keyed
  UNION ALL
  SELECT k.object_key, 4,
    CASE WHEN row_number() OVER (PARTITION BY f.dataset_id ORDER BY lower(f.key), f.key) = 1 THEN '' ELSE ',' END ||
    '{{"@type":"Field","@id":"metadata/' || f.key || '","name":"' || f.key ||
    '","description":"","dataType":"sc:Text","source":{{"fileObject":{{"@id":"metadata"}},"extract":{{"column":"' || f.key || '"}}}}}}', lower(f.key) || chr(1) || f.key
  FROM fields f JOIN keyed k ON f.dataset_id = k.dataset_id
  UNION ALL
  SELECT object_key, 5, ']}}}}', '' FROM keyed
)"""

MINIMAL = """SELECT p_name || '_syn' || p_partkey || '.minimal_croissant.jsonld' AS object_key,
        '{"@context":"https://schema.org/","@type":"Dataset","name":"' || p_name || '","description":"' ||
        CASE WHEN p_size > 10 THEN 'About ' || p_name ELSE '' END || '","url":"https://example.org/entity/syn' || p_partkey ||
        '","identifier":"syn' || p_partkey || '","creator":{"@type":"Organization","name":"' ||
        CASE WHEN p_size > 20 THEN p_brand ELSE 'Example Institute' END || '"},"license":"' ||
        CASE WHEN p_size > 30 THEN 'CC-0' ELSE '' END || '"}' AS document
        FROM part WHERE p_size != 13"""

MATRIX = """
cells AS (
  SELECT p.p_brand AS "Hugo", 'N' || s.s_nationkey AS specimen, max(l.l_extendedprice) AS tpm
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
  WHERE p.p_size != 3
  GROUP BY ALL
)"""

DAILY = """
daily AS (
  SELECT CAST(ts AS DATE) AS d, user_id, count(*) AS n FROM events GROUP BY ALL
)"""

ORACLE: dict[str, str] = {
    "leaderboard_trailing30": f"""WITH {DOWNLOADS}, {_public("d.record_date > DATE '1998-05-31' AND d.record_date <= DATE '1998-06-30'")}
        SELECT * FROM public_board""",
    "leaderboard_all_time": f"WITH {DOWNLOADS}, {_public('TRUE')} SELECT * FROM public_board",
    "leaderboard_day": f"WITH {DOWNLOADS}, {_public(YESTERDAY)} SELECT * FROM public_board",
    "leaderboard_part_day": f"""WITH {DOWNLOADS}, {_public("d.record_date = TIMESTAMP '1998-06-30' - INTERVAL 30 HOUR")}
        SELECT * FROM public_board""",
    "group_leaderboard": f"""WITH {DOWNLOADS}, {_group("d.record_date > DATE '1997-06-30' AND d.record_date <= DATE '1998-06-30'")}
        SELECT * FROM group_board""",
    "combined_leaderboard": f"""{COMBINED}
        SELECT project, name, CAST(projects_with_downloads AS BIGINT) AS projects_with_downloads,
               CAST(total_projects AS BIGINT) AS total_projects, downloads_per_project, data_download_size,
               number_of_unique_users_downloaded FROM combined""",
    "top_message": f"""{COMBINED},
        best AS (
          SELECT *, row_number() OVER (ORDER BY number_of_unique_users_downloaded DESC, project, name) AS rank FROM combined
          QUALIFY rank <= 10
        ),
        lines AS (
          SELECT rank, rank || '. <https://example.org/entity/' || project || '|' || name || '> - ' ||
            downloads_per_project || ' downloads, ' || number_of_unique_users_downloaded || ' unique users, ' ||
            CASE WHEN data_download_size = 0 THEN '< 0.0005 GiB'
                 ELSE printf('%.3f GiB', data_download_size / 1073741824.0) END || ' egressed' ||
            CASE WHEN total_projects > 0 THEN ' (' || projects_with_downloads || '/' || total_projects || ' projects with downloads)' ELSE '' END ||
            chr(10) || chr(10) AS line
          FROM best
        )
        SELECT 'Top Downloaded Public Projects Yesterday!' || chr(10) || chr(10) ||
               coalesce(string_agg(line, '' ORDER BY rank), '') ||
               'One download is a user downloading an entity (File, Table, Views, etc) once' || chr(10) AS message
        FROM lines""",
    "public_snapshot": f"""{COMBINED}
        SELECT project, downloads_per_project, DATE '1998-06-29' AS record_date,
               number_of_unique_users_downloaded, data_download_size
        FROM combined WHERE project NOT IN ('syn-100', 'syn-98', 'syn-97')""",
    "summary_all_time": f"WITH {DOWNLOADS}, {_public('TRUE')} SELECT * FROM public_board",
    "summary_trailing30": f"""WITH {DOWNLOADS}, {_public("d.record_date BETWEEN DATE '1998-05-21' AND DATE '1998-06-19' AND NOT (d.record_date BETWEEN DATE '1998-05-25' AND DATE '1998-05-27' AND (d.project_id % 2 = 1 OR d.record_date = DATE '1998-05-26'))")}
        SELECT * FROM public_board""",
    "summary_groups": f"""WITH {DOWNLOADS}, {_group("d.record_date BETWEEN DATE '1998-03-11' AND DATE '1998-06-14'")}
        SELECT * FROM group_board""",
    "summary_estimate": f"""WITH {DOWNLOADS}
        SELECT project_id, CAST(count(DISTINCT user_id) AS BIGINT) AS users, TRUE AS close FROM downloads JOIN files ON file_handle_id = id
        WHERE record_date BETWEEN DATE '1998-01-01' AND DATE '1998-06-30' GROUP BY project_id""",
    "trending_month_top10": f"""WITH {DOWNLOADS},
        recent AS (
          SELECT project_id, record_date, user_id FROM downloads
          WHERE date_trunc('month', record_date) = DATE '1998-05-01' AND stack = 'prod'
            AND project_id IN (SELECT project_id FROM public_projects)
        ),
        top AS (
          SELECT project_id, count(DISTINCT user_id) AS n_unique_users FROM recent GROUP BY project_id
          ORDER BY n_unique_users DESC, project_id LIMIT 10
        ),
        sizes AS (
          SELECT l.l_suppkey AS project_id, sum(f.content_size) / power(1024, 3) AS size
          FROM lineitem l JOIN files f ON f.id = l.l_partkey
          WHERE date_trunc('month', l.l_shipdate) <= DATE '1998-05-01' AND l.l_suppkey IN (SELECT project_id FROM top)
          GROUP BY l.l_suppkey
        )
        SELECT t.project_id, CAST(t.n_unique_users AS BIGINT) AS n_unique_users,
               coalesce(strftime(max(r.record_date), '%Y-%m-%d'), 'N/A') AS last_download_date,
               round(s.size, 3) AS estimated_project_size_in_gib
        FROM top t LEFT JOIN recent r ON t.project_id = r.project_id JOIN sizes s ON s.project_id = t.project_id
        GROUP BY t.project_id, t.n_unique_users, s.size""",
    "platform_numbers": f"""WITH {DOWNLOADS},
        sizes AS (
          SELECT DISTINCT f.id, f.content_size FROM lineitem l JOIN files f ON f.id = l.l_partkey
          UNION
          SELECT DISTINCT f.id, f.content_size FROM lineitem l JOIN files f ON f.id = l.l_partkey WHERE l.l_returnflag = 'R'
        )
        SELECT CAST((SELECT sum(content_size) FROM sizes) AS DOUBLE) / power(2, 50) AS size_in_petabytes,
               CAST((SELECT count(DISTINCT user_id) FROM events WHERE date_trunc('month', ts) = DATE '2024-01-01') AS BIGINT) AS distinct_user_count,
               CAST((SELECT count(*) FROM downloads WHERE date_trunc('month', record_date) = DATE '1998-05-01') AS BIGINT) AS downloads_last_month""",
    "active_users_by_month": """SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS distinct_user_count
        FROM events WHERE date_trunc('month', ts) = DATE '2024-01-01'""",
    "latest_per_cohort": f"""WITH {COHORTS}
        SELECT cohort AS "COHORT", CAST(major AS INTEGER) AS "MAJOR_VERSION", CAST(minor AS INTEGER) AS "MINOR_VERSION"
        FROM cohorts QUALIFY row_number() OVER (PARTITION BY cohort ORDER BY major DESC, minor DESC) = 1""",
    "global_latest": f"""WITH {PAIRS}
        SELECT sample_id AS "SAMPLE_ID", patient_id AS "PATIENT_ID", name AS "RELEASE" FROM main_pairs""",
    "membership_pairs": f"""WITH {PAIRS}
        SELECT b.sample_id AS "SAMPLE_ID", b.patient_id AS "PATIENT_ID", b.name AS "RELEASE_NAME",
               b.kind AS "RELEASE_PROJECT_TYPE",
               CASE WHEN EXISTS (SELECT 1 FROM main_pairs k WHERE k.sample_id = b.sample_id AND k.patient_id = b.patient_id)
                    THEN 'Yes' ELSE 'No' END AS "IN_LATEST_RELEASE"
        FROM base b""",
    "membership_wide": f"""WITH {PAIRS}
        SELECT sample_id AS "SAMPLE_ID", patient_id AS "PATIENT_ID",
               max(kind = 'MAIN') AS "IN_LATEST_MAIN",
               max(kind = 'SP_URGENT') AS "IN_URGENT_PROJECT", max(kind = 'SP_LOW') AS "IN_LOW_PROJECT",
               max(kind = 'COHORT_A') AS "IN_COHORT_A_RELEASE", max(kind = 'COHORT_N') AS "IN_COHORT_N_RELEASE",
               max(kind = 'COHORT_R') AS "IN_COHORT_R_RELEASE",
               max(CASE WHEN kind = 'MAIN' THEN name END) AS "MAIN_RELEASE",
               max(CASE WHEN kind = 'COHORT_A' THEN name END) AS "COHORT_A_RELEASE",
               max(CASE WHEN kind = 'COHORT_N' THEN name END) AS "COHORT_N_RELEASE"
        FROM base GROUP BY sample_id, patient_id""",
    "membership_checks": f"""WITH {COHORTS}
        SELECT 'null' AS "check", 'IN_PATIENT_RELEASE' AS "column", CAST(count(*) AS BIGINT) AS n
        FROM cohorts WHERE cohort = 'R' HAVING count(*) > 0
        UNION ALL SELECT 'missing_column', 'NOT_THERE', 1
        UNION ALL
        SELECT 'duplicate', 'PANEL_SAMPLE_ID,RECORD_ID', CAST(sum(n) AS BIGINT)
        FROM (SELECT count(*) AS n FROM cohorts GROUP BY sample_id, patient_id HAVING count(*) > 1)""",
    "recent_entities": f"WITH {RECENT} SELECT * FROM recent_kept",
    "recent_lines": f"""WITH {RECENT},
        ranked AS (SELECT *, row_number() OVER (ORDER BY is_public DESC, created_on, id) AS rank FROM recent_kept),
        lines AS (
          SELECT CASE WHEN is_public THEN 'Public datasets' ELSE 'Private datasets' END AS section, CAST(rank AS BIGINT) AS rank,
            rank || '. <https://example.org/entity/syn' || id || '|*' || name || '*> (Type: ' || coalesce(nullif(content_type, ''), node_type) ||
            ', Created on: ' || strftime(created_on, '%Y-%m-%d') || ', Created by: <https://example.org/profile/' || created_by ||
            '/profile|' || user_name_full_name || '>, Public: ' || CASE WHEN is_public THEN 'True' ELSE 'False' END || ')' AS line
          FROM ranked
        )
        SELECT * FROM lines
        UNION ALL
        SELECT s.section, 0, 'Nothing to be found.' FROM (VALUES ('Public datasets'), ('Private datasets')) s(section)
        WHERE s.section NOT IN (SELECT section FROM lines)""",
    "public_recent": f"WITH {RECENT} SELECT id, node_type, created_on, created_by FROM recent_kept WHERE is_public",
    "variant_paths": """SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum,
        max(CAST(json_extract(props, '$.k') AS BIGINT)) AS k_max FROM events GROUP BY event_type""",
    "runs_per_workspace": f"""WITH {RUNS}
        SELECT n.n_name AS workspace, CAST(count(*) AS BIGINT) AS total_runs FROM runs r
        JOIN nation n ON r.workspace_id = n.n_nationkey WHERE {PAST_WEEK} GROUP BY n.n_name""",
    "workflow_share": f"""WITH {RUNS},
        totals AS (SELECT workspace_id, count(*) AS total FROM runs WHERE {PAST_WEEK} GROUP BY workspace_id)
        SELECT n.n_name AS workspace, r.project_name AS workflow, CAST(count(*) AS BIGINT) AS runs,
               count(*) / t.total * 100 AS percentage
        FROM runs r JOIN nation n ON r.workspace_id = n.n_nationkey JOIN totals t ON t.workspace_id = r.workspace_id
        WHERE {PAST_WEEK} GROUP BY n.n_name, r.project_name, t.total""",
    "runs_per_month_avg": f"""WITH {RUNS}
        SELECT round(avg(n), 2) AS month_avg_past_year
        FROM (SELECT count(*) AS n FROM runs WHERE {YEAR} GROUP BY strftime(date_created, '%B %Y'))""",
    "runs_per_week_avg": f"""WITH {RUNS}
        SELECT round(avg(n), 2) AS week_avg_past_year
        FROM (SELECT count(*) AS n FROM runs WHERE {YEAR} GROUP BY strftime(date_created, '%Y/%U'))""",
    "status_breakdown": f"""WITH {RUNS}, closed AS (SELECT * FROM runs WHERE {YEAR} AND complete IS NOT NULL)
        SELECT status, CAST(count(*) AS BIGINT) AS status_count,
               round(count(*) / (SELECT count(*) FROM closed) * 100, 2) AS percentage FROM closed GROUP BY status""",
    "project_breakdown": f"""WITH {RUNS}, closed AS (SELECT * FROM runs WHERE {PAST_MONTH} AND complete IS NOT NULL)
        SELECT project_name, CAST(count(*) AS BIGINT) AS runs,
               round(count(*) / (SELECT count(*) FROM closed) * 100, 2) AS percentage FROM closed GROUP BY project_name""",
    "users_total": "SELECT CAST(count(*) AS BIGINT) AS total_users FROM customer",
    "users_active": f"""WITH {RUNS}
        SELECT CAST(count(DISTINCT user_name) AS BIGINT) AS users_past_month FROM runs WHERE {PAST_MONTH}""",
    "run_bundle": f"""WITH {RUNS},
        week AS (SELECT workspace_id, project_name, count(*) AS n FROM runs WHERE {PAST_WEEK} GROUP BY ALL),
        totals AS (SELECT workspace_id, sum(n) AS total FROM week GROUP BY workspace_id),
        closed_year AS (SELECT status, count(*) AS n FROM runs WHERE {YEAR} AND complete IS NOT NULL GROUP BY status),
        closed_month AS (SELECT project_name, count(*) AS n FROM runs WHERE {PAST_MONTH} AND complete IS NOT NULL GROUP BY project_name),
        lines AS (
          SELECT 'total_workflows_per_workspace_past_week' AS report, n_name AS name, NULL AS workflow, total AS n, NULL::DOUBLE AS value, 2 AS n_fields
          FROM totals JOIN nation ON workspace_id = n_nationkey
          UNION ALL SELECT 'workflow_distribution_past_week', n_name, project_name, n, round(n / total * 100, 6), 4
          FROM week JOIN totals USING (workspace_id) JOIN nation ON workspace_id = n_nationkey
          UNION ALL SELECT 'avg_workflows_run_per_month', NULL, NULL, NULL, round(avg(n), 2), 1
          FROM (SELECT count(*) AS n FROM runs WHERE {YEAR} GROUP BY strftime(date_created, '%B %Y')) HAVING count(*) > 0
          UNION ALL SELECT 'avg_workflows_run_per_week', NULL, NULL, NULL, round(avg(n), 2), 1
          FROM (SELECT count(*) AS n FROM runs WHERE {YEAR} GROUP BY strftime(date_created, '%Y/%U')) HAVING count(*) > 0
          UNION ALL SELECT 'run_status_breakdown_past_year', status, NULL, n, round(n / (SELECT sum(n) FROM closed_year) * 100, 2), 3 FROM closed_year
          UNION ALL SELECT 'workflow_breakdown_past_month', project_name, NULL, n, round(n / (SELECT sum(n) FROM closed_month) * 100, 2), 3 FROM closed_month
          UNION ALL SELECT 'total_users', NULL, NULL, count(*), NULL, 1 FROM customer
          UNION ALL SELECT 'active_users_past_month', NULL, NULL, count(DISTINCT user_name), NULL, 1 FROM runs WHERE {PAST_MONTH}
        )
        SELECT report, name, workflow, CAST(n AS BIGINT) AS n, value, n_fields FROM lines""",
    "run_summaries": """WITH done AS (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY l_orderkey),
        r AS (
          SELECT o.*, d.shipped + to_seconds(o.o_orderkey % 86400) - o.o_orderdate AS span,
                 date_diff('second', o.o_orderdate, d.shipped) + o.o_orderkey % 86400 AS secs
          FROM orders o LEFT JOIN done d ON o.o_orderkey = d.l_orderkey
        ),
        parts AS (
          SELECT *, CAST(floor(secs / 86400) AS BIGINT) AS days, secs - CAST(floor(secs / 86400) AS BIGINT) * 86400 AS rest FROM r
        )
        SELECT o_orderkey AS id,
          CASE WHEN o_orderstatus = 'F' THEN chr(127881) ELSE chr(10060) END || ' Workflow run (Name: run_' || o_orderkey || ', Id: ' || o_orderkey ||
          ') has completed with state: ' || o_orderstatus || chr(10) || 'Dataset: ' ||
          CASE WHEN o_orderpriority = '5-LOW' THEN 'all datasets' ELSE o_orderpriority END || chr(10) ||
          'Duration (submission to completion): ' ||
          CASE WHEN secs IS NULL THEN 'unknown' ELSE
            CASE WHEN days = 0 THEN '' WHEN abs(days) = 1 THEN days || ' day, ' ELSE days || ' days, ' END ||
            (rest // 3600) || ':' || lpad(CAST(rest // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(rest % 60 AS VARCHAR), 2, '0') END ||
          chr(10) || chr(10) || 'View run: https://runs.example.org/watch/' || o_orderkey AS message
        FROM parts""",
    "failure_reasons": """SELECT d.doc_id AS task_id, d.source AS tag,
          coalesce(nullif(concat_ws(', ', CASE WHEN contains(d.text, 'Copyright') THEN 'Copyright' END,
                   CASE WHEN contains(d.text, '@') THEN '@' END, CASE WHEN contains(d.text, 'tion') THEN 'tion' END,
                   CASE WHEN contains(d.text, 'no such marker') THEN 'no such marker' END), ''),
                   'Failure Reason Undetermined') AS failure_reasons
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 0""",
    "category_report_totals": f"""WITH {USAGE}
        SELECT category, 0 AS is_total, idx AS index, title, '2024-01-30' AS date, views, unique_views, downloads, unique_downloads, link FROM usage
        UNION ALL
        SELECT category, 1, NULL, 'TOTALS', '', CAST(sum(views) AS BIGINT), CAST(sum(unique_views) AS BIGINT),
               CAST(sum(downloads) AS BIGINT), CAST(sum(unique_downloads) AS BIGINT), '' FROM usage GROUP BY category""",
    "usage_report_pages": f"""WITH {USAGE}
        SELECT idx AS index, title, views, unique_downloads, link, category FROM usage""",
    "category_counts": f"WITH {USAGE} SELECT category, CAST(count(*) AS BIGINT) AS n_records FROM usage GROUP BY category",
    "report_file_totals": f"""WITH {USAGE}
        SELECT category, title, '2024-01-30' AS date, views::VARCHAR AS views, unique_views::VARCHAR AS unique_views,
               downloads::VARCHAR AS downloads, unique_downloads::VARCHAR AS unique_downloads, link FROM usage
        UNION ALL
        SELECT category, 'TOTALS', '', sum(views)::VARCHAR, sum(unique_views)::VARCHAR, sum(downloads)::VARCHAR, sum(unique_downloads)::VARCHAR, ''
        FROM usage GROUP BY category
        UNION ALL
        SELECT DISTINCT category, 'Title', 'Publication Date', 'Total Views', 'Unique Views', 'Total Downloads', 'Unique Downloads', 'Link' FROM usage""",
    "record_errors": """SELECT o_orderkey AS index, 'record ' || o_orderkey || ' missing fields: link' AS error FROM orders WHERE o_orderstatus != 'O'
        UNION ALL SELECT o_orderkey, 'record ' || o_orderkey || ' has empty ''link''' FROM orders WHERE o_orderstatus != 'O'
        UNION ALL SELECT o_orderkey, 'record ' || o_orderkey || ' has empty ''title''' FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderkey, 'record ' || o_orderkey || ' field ''views'' is not a non-negative integer'
          FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
        UNION ALL SELECT o_orderkey, 'record ' || o_orderkey || ' field ''downloads'' is not a non-negative integer'
          FROM orders WHERE o_orderstatus = 'P'""",
    "page_flatten": """WITH p AS (
          SELECT conv_id, turn, role, CAST(turn // 2 + 1 AS BIGINT) AS page,
                 row_number() OVER (PARTITION BY conv_id, turn // 2 ORDER BY turn, role) - 1 AS position,
                 count(*) OVER (PARTITION BY conv_id, turn // 2) AS size
          FROM conversations
        ),
        last AS (SELECT conv_id, min(page) AS last FROM p WHERE size < 2 GROUP BY conv_id)
        SELECT p.conv_id, p.page, CAST(p.position AS INTEGER) AS position, p.turn, p.role
        FROM p LEFT JOIN last l ON p.conv_id = l.conv_id WHERE l.last IS NULL OR p.page <= l.last""",
    "doi_extract": """SELECT lang, CAST(count(*) AS BIGINT) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars,
          CAST((SELECT count(*) FROM documents) AS BIGINT) AS written FROM documents GROUP BY lang""",
    "duplicate_titles": """WITH fresh AS (SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
        dups AS (SELECT doc_id FROM fresh QUALIFY count(*) OVER (PARTITION BY text) > 1)
        SELECT doc_id AS "sameAs", CASE WHEN doc_id IN (SELECT doc_id FROM dups) THEN 'duplicate'
               WHEN source = 'src3' THEN 'ignored' WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'existing' ELSE 'new' END AS status
        FROM documents""",
    "duplicate_rows": """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
        QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
    "catalogue_intake": f"""WITH {ITEMS}
        SELECT same_as AS "sameAs", title, status, CAST(least(length(title) * 60, 1000) AS INTEGER) AS n_description
        FROM judged WHERE status IN ('new', 'existing')""",
    "intake_errors": f"""WITH {ITEMS}
        SELECT idx AS item_index, concat_ws('; ', CASE WHEN NOT p_size BETWEEN 1 AND 45 THEN 'size in range' END,
               CASE WHEN NOT p_retailprice > 901 THEN 'price present' END) AS error, same_as AS "sameAs"
        FROM mapped WHERE NOT (p_size BETWEEN 1 AND 45 AND p_retailprice > 901)""",
    "annotation_rows": f"""WITH {ITEMS}
        SELECT 'syn' || idx AS id, title, 'Maker' AS creator, keywords, p_type AS subject, 'parts' AS collection,
               'Example Institute' AS publisher, CAST(NULL AS VARCHAR) AS species, same_as AS "sameAs",
               'Example Institute' AS source, 'https://example.org/records/' || same_as AS url
        FROM judged WHERE status IN ('new', 'existing')""",
    "unmatched_keys": """SELECT coalesce(s.k, u.k) AS key, CASE WHEN u.k IS NULL THEN 'stored' ELSE 'update' END AS side
        FROM (SELECT DISTINCT p_partkey AS k FROM part) s FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders) u ON s.k = u.k
        WHERE s.k IS NULL OR u.k IS NULL""",
    "link_actions": f"""WITH {LINKS}
        SELECT d.dataset, d.dataset_version, d.dataset_collection, d.object_url,
               CASE WHEN l.dataset IS NULL THEN 'insert' WHEN l.object_url = d.object_url THEN 'unchanged' ELSE 'update' END AS action
        FROM desired d LEFT JOIN links l ON l.dataset = d.dataset AND l.dataset_version = d.dataset_version
             AND l.dataset_collection = d.dataset_collection""",
    "stale_links": f"""WITH {LINKS}
        SELECT l.* FROM links l WHERE l.dataset_collection IN ('syn1', 'syn2', 'syn3', 'syn4', 'syn5')
          AND NOT EXISTS (SELECT 1 FROM desired d WHERE l.dataset = d.dataset AND l.dataset_version = d.dataset_version
                          AND l.dataset_collection = d.dataset_collection)""",
    "stale_objects": """SELECT p_name || '_syn' || p_partkey || '.' || (p_size % 3) || '_datasetCollection_syn' || replace(p_brand, 'Brand#', '') || '_croissant.jsonld' AS key
        FROM part WHERE p_type != 'PROMO' AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5')
          AND (p_retailprice <= 905 OR p_size > 40)""",
    "stale_minimal_objects": """SELECT replace(p_name, ' ', '_') || '_syn' || p_partkey || '.minimal_croissant.jsonld' AS key
        FROM part WHERE p_type != 'PROMO' AND p_retailprice <= 905""",
    "dataset_documents": f"WITH {DOCS}, {DOCUMENT_LINES} SELECT object_key, section, line FROM lines",
    "document_files": f"""WITH {DOCS}, {DOCUMENT_LINES}
        SELECT 'https://objects.example.org/' || object_key AS object_url, row_number() OVER (PARTITION BY object_key ORDER BY section, place) - 1 AS place,
               line FROM lines""",
    "document_links": """SELECT DISTINCT 'syn' || replace(source, 'src', '') AS dataset_id, 1 AS dataset_version, 'syn900' AS dataset_collection,
        'https://objects.example.org/' || source || '_syn' || replace(source, 'src', '') || '.1_datasetCollection_syn900_croissant.jsonld' AS object_url
        FROM documents""",
    "attachments": f"""WITH {DOCS}
        SELECT dataset_id, file_id, file_version, name, description, encoding, md5 FROM attached""",
    "minimal_documents": MINIMAL,
    "minimal_files": f"SELECT object_key, 0::BIGINT AS place, document AS line, FALSE AS damaged FROM ({MINIMAL})",
    "gene_matrix": f"""WITH {MATRIX}
        SELECT "Hugo", """
    + ", ".join(f"max(CASE WHEN specimen = 'N{n}' THEN tpm END) AS \"N{n}\"" for n in range(25))
    + ' FROM cells GROUP BY "Hugo"',
    "gene_matrix_pivot": f"""WITH {MATRIX}
        SELECT "Hugo", """
    + ", ".join(f"max(CASE WHEN specimen = 'N{n}' THEN tpm END) AS \"N{n}\"" for n in range(25))
    + ' FROM cells GROUP BY "Hugo"',
    "gene_matrix_lines": f"""WITH {MATRIX},
        grid AS (SELECT g."Hugo", s.specimen, c.tpm FROM (SELECT DISTINCT "Hugo" FROM cells) g
                 JOIN (SELECT DISTINCT specimen FROM cells) s ON TRUE LEFT JOIN cells c ON c."Hugo" = g."Hugo" AND c.specimen = s.specimen)
        SELECT "Hugo" || chr(9) || string_agg(coalesce(tpm::VARCHAR, ''), chr(9) ORDER BY specimen) AS line FROM grid GROUP BY "Hugo"
        UNION ALL SELECT 'Hugo' || chr(9) || string_agg(specimen, chr(9) ORDER BY specimen) FROM (SELECT DISTINCT specimen FROM cells)""",
    "gene_cells": f"WITH {MATRIX} SELECT * FROM cells",
    "arg_max": """SELECT l_partkey, l_extendedprice, l_orderkey, l_linenumber FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC) = 1""",
    "numbered": """SELECT o_orderkey, o_totalprice, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS rank FROM orders""",
    "release_parse": """WITH n AS (
          SELECT o_orderkey, CASE o_orderpriority
            WHEN '1-URGENT' THEN strftime(o_orderdate, '%m') || '.' || day(o_orderdate) || '-consortium'
            WHEN '2-HIGH' THEN strftime(o_orderdate, '%y') || '.0-Public'
            WHEN '3-MEDIUM' THEN 'v' || month(o_orderdate) || '.1-public'
            WHEN '5-LOW' THEN month(o_orderdate) || '_2-'
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS name FROM orders
        ),
        s AS (
          SELECT *, len(string_split(name, '-')) AS parts, replace(string_split(name, '-')[1], '.', '_') AS version,
                 upper(string_split(name, '-')[2]) AS kind FROM n
        ),
        v AS (
          SELECT *, parts = 2 AND regexp_full_match(version, '\\d+_\\d+') AS ok,
                 TRY_CAST(string_split(version, '_')[1] AS INTEGER) AS major, TRY_CAST(string_split(version, '_')[2] AS INTEGER) AS minor FROM s
        )
        SELECT o_orderkey, name, CASE WHEN ok THEN major || '_' || minor || '_' || kind END AS release,
               CASE WHEN ok THEN kind END AS release_type, CASE WHEN ok THEN major END AS major_version,
               CASE WHEN ok THEN minor END AS minor_version,
               CASE WHEN ok THEN NULL WHEN parts = 2 THEN 'Unexpected version format: ' || name
                    ELSE 'Unexpected folder name format: ' || name END AS error
        FROM v""",
    "cohort_version_parse": """WITH n AS (
          SELECT o_orderkey, o_orderstatus, o_orderdate,
                 CASE o_orderstatus WHEN 'F' THEN 'Public_' WHEN 'O' THEN 'consortium_' ELSE 'public_preview_' END ||
                 strftime(o_orderdate, '%m') || '_' || day(o_orderdate) AS version,
                 CASE o_orderstatus WHEN 'F' THEN 'PUBLIC' WHEN 'O' THEN 'CONSORTIUM' END AS kind FROM orders
        )
        SELECT o_orderkey, version, CASE WHEN kind IS NOT NULL THEN month(o_orderdate) || '_' || day(o_orderdate) || '_' || kind END AS release,
               kind AS release_type, CASE WHEN kind IS NOT NULL THEN CAST(month(o_orderdate) AS INTEGER) END AS major_version,
               CASE WHEN kind IS NOT NULL THEN CAST(day(o_orderdate) AS INTEGER) END AS minor_version,
               CASE WHEN kind IS NULL THEN 'Unexpected version format: ' || version END AS error
        FROM n""",
    "release_paths": """SELECT p_partkey, 'Releases/Release ' || lpad(CAST(p_size - 1 AS VARCHAR), 2, '0') || CASE WHEN p_type = 'PROMO' THEN '/extra' ELSE '' END AS path,
        p_type != 'PROMO' AND p_size - 1 > 16 AS valid FROM part""",
    "release_store": """SELECT year(o_orderdate) || '_' || quarter(o_orderdate) || '_CONSORTIUM' AS "RELEASE", CAST(count(*) AS BIGINT) AS n,
        CAST(CASE WHEN year(o_orderdate) = 1996 THEN 1 ELSE count(DISTINCT o_custkey) END AS BIGINT) AS n_patients
        FROM orders GROUP BY year(o_orderdate), quarter(o_orderdate)""",
    "release_files_ingest": """SELECT c_custkey AS record_id,
          CASE WHEN c_mktsegment NOT IN ('HOUSEHOLD', 'AUTOMOBILE') THEN c_name END AS c_name,
          CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_acctbal END AS c_acctbal,
          v.cohort AS "COHORT", v.major || '_' || v.minor || '_' || v.kind AS "RELEASE", v.kind AS "RELEASE_TYPE",
          v.major AS "MAJOR_VERSION", v.minor AS "MINOR_VERSION"
        FROM customer JOIN (VALUES ('BUILDING', 'BRCA', 1, 2, 'PUBLIC'), ('MACHINERY', 'BRCA', 1, 2, 'PUBLIC'), ('HOUSEHOLD', 'NSCLC', 2, 1, 'CONSORTIUM'),
             ('FURNITURE', 'NSCLC', 2, 2, 'PUBLIC'), ('AUTOMOBILE', 'CRC', 1, 1, 'CONSORTIUM')) v(segment, cohort, major, minor, kind) ON c_mktsegment = segment""",
    "main_release_ingest": """WITH q AS (SELECT *, quarter(o_orderdate) AS q, CASE WHEN quarter(o_orderdate) % 2 = 1 THEN 'PUBLIC' ELSE 'CONSORTIUM' END AS kind FROM orders)
        SELECT 'S' || o_orderkey AS "SAMPLE_ID", 'a "name", ' || o_orderpriority AS "NOTE",
               CASE WHEN o_orderstatus != 'P' THEN CAST(year(o_orderdate) AS INTEGER) END AS "YEAR", '17_' || q || '_' || kind AS "RELEASE",
               kind AS "RELEASE_TYPE", 17 AS "MAJOR_VERSION", CAST(q AS INTEGER) AS "MINOR_VERSION" FROM q""",
    "project_ingest": """SELECT c_custkey, c_name, 'line one' || chr(10) || '"line two", ' || c_mktsegment AS note, c_mktsegment AS project FROM customer""",
    "release_file_choice": """SELECT p_partkey AS id, CASE p_type WHEN 'PROMO' THEN 'data_clinical_sample.txt' ELSE 'cancer_panel_test_level_dataset.csv' END AS name,
        CASE p_type WHEN 'PROMO' THEN 'CLINICAL_SAMPLE' ELSE 'CANCER_PANEL_TEST_LEVEL' END AS table_name
        FROM part WHERE p_type IN ('PROMO', 'LARGE')""",
    "recent_files": """SELECT 'f' || o_orderkey || '_manifest.csv' AS name, strftime(o_orderdate, '%Y-%m-%d') AS modified
        FROM orders WHERE o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '2001-08-01' - INTERVAL 48 HOUR""",
    "merge_upsert": """WITH t AS (SELECT * FROM part WHERE p_size <= 40),
        s AS (SELECT l_partkey AS k, max(l_extendedprice) AS price FROM lineitem WHERE l_quantity >= 45 GROUP BY l_partkey)
        SELECT coalesce(t.p_partkey, s.k) AS p_partkey, t.p_name, CASE WHEN s.k IS NULL THEN t.p_brand END AS p_brand,
               CASE WHEN s.k IS NULL THEN t.p_retailprice ELSE s.price END AS p_retailprice
        FROM t FULL JOIN s ON t.p_partkey = s.k""",
    "merge_partitions": """SELECT o_orderkey, year(o_orderdate)::INTEGER AS year,
          CASE WHEN (year(o_orderdate) IN (1996, 1997) AND o_orderkey % 2 = 0) OR year(o_orderdate) = 1999
               THEN CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice + 1 END ELSE o_totalprice END AS o_totalprice,
          CASE WHEN year(o_orderdate) != 1999 THEN o_orderpriority END AS o_orderpriority,
          CASE WHEN year(o_orderdate) IN (1996, 1997, 1999) THEN 'No' ELSE 'Yes' END AS kept FROM orders""",
    "snapshot_append": """SELECT s_nationkey, CAST(count(*) AS BIGINT) AS n, d AS export_date
        FROM supplier, (VALUES ('2024-01-01'), ('2024-01-02')) v(d) GROUP BY s_nationkey, d""",
    "table_save_rules": """SELECT n_nationkey, CAST(CASE WHEN n_nationkey < 5 THEN 2 ELSE 1 END AS BIGINT) AS n, n_name FROM nation""",
    "refreshed_export": "SELECT CAST(count(*) AS BIGINT) AS n_rows, TRUE AS within_limit FROM orders",
    "standard_columns": 'SELECT s_suppkey AS "ID", s_name AS "GRANTS", s_nationkey AS "GROUPS" FROM supplier',
    "new_submissions": """WITH last AS (
          SELECT DISTINCT o_orderdate FROM orders WHERE day(o_orderdate) % 2 = 1 ORDER BY o_orderdate DESC LIMIT 6
        )
        SELECT o_orderkey AS submission_id, 'EVALUATION_IN_PROGRESS' AS status FROM orders
        WHERE o_orderstatus = 'O' AND o_orderdate NOT IN (SELECT o_orderdate FROM last)""",
    "submission_manifest": """SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS id_sum FROM orders WHERE o_orderstatus = 'O'""",
    "samplesheet_rename": """SELECT replace(replace(url || '/reads_1.fastq.gz', '_1.', '_R1.'), '_2.', '_R2.') AS bam,
        'a_R2.b_R1.' || page_id AS bai FROM pages""",
    "object_renames": """WITH k AS (
          SELECT 'staging/x/syn' || p_partkey || '/SRR' || p_size AS stem, CASE WHEN p_size % 2 = 0 THEN '1' ELSE '2' END AS read
          FROM part WHERE p_type != 'PROMO' AND (p_size % 2 = 0 OR p_size % 3 = 0)
        )
        SELECT stem || '_' || read || '.fastq.gz' AS key, stem || '_R' || read || '.fastq.gz' AS new_key FROM k""",
    "headerless_sheet": """SELECT CAST(s_suppkey AS VARCHAR) AS patient, 'XX' AS sex, CAST(s_nationkey AS VARCHAR) AS status,
        s_name AS sample, s_name || '.bam' AS bam, s_name || '.bai' AS bai FROM supplier""",
    "empty_deliveries": """SELECT p_partkey AS source FROM part WHERE p_partkey NOT IN (
        SELECT l_partkey FROM lineitem WHERE date_trunc('month', l_shipdate) = DATE '1998-05-01')""",
    "size_texts": """WITH s AS (SELECT p_partkey, CASE WHEN p_size = 5 THEN 0 ELSE CAST(round(p_retailprice * 1e7) AS BIGINT) END AS size FROM part)
        SELECT p_partkey, CASE WHEN size = 0 THEN '< 0.0005 GiB' ELSE printf('%.3f GiB', size / 1073741824.0) END AS size FROM s""",
    "quoted_keys": """SELECT p_partkey, replace(p_name, ' ', '+') || '+~%2A%2F%C3%A9%2B%26' || replace(p_brand, '#', '%23') AS quoted FROM part""",
    "week_labels": """SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS day,
        year(o_orderdate) || '/' || CAST(strftime(o_orderdate, '%U') AS INTEGER) AS week, strftime(o_orderdate, '%B %Y') AS month FROM orders""",
    "stream_usage_daily": f"""WITH {DAILY}
        SELECT strftime(d, '%Y-%m-%d') AS day, CAST(sum(n) AS BIGINT) AS events, CAST(count(DISTINCT user_id) AS BIGINT) AS unique_users
        FROM daily GROUP BY d""",
    "stream_usage_sliding": """WITH days AS (SELECT DISTINCT CAST(CAST(ts AS DATE) + CAST(i AS INTEGER) AS DATE) AS d FROM events, range(7) r(i))
        SELECT strftime(x.d, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS events, CAST(count(DISTINCT e.user_id) AS BIGINT) AS unique_users
        FROM days x JOIN events e ON CAST(e.ts AS DATE) <= x.d AND CAST(e.ts AS DATE) > x.d - 7 GROUP BY x.d""",
    "stream_usage_late": """WITH e AS (SELECT *, event_id % 4 AS b, CAST(ts AS DATE) AS d FROM events),
        m AS (SELECT k, max(ts) - INTERVAL 10 DAY AS mark FROM e JOIN range(1, 4) r(k) ON b < k GROUP BY k),
        t AS (SELECT e.*, coalesce(ts < mark, FALSE) AS late FROM e LEFT JOIN m ON b = k)
        SELECT strftime(d, '%Y-%m-%d') AS day, CAST(count(*) FILTER (NOT late) AS BIGINT) AS events,
               CAST(count(DISTINCT user_id) FILTER (NOT late) AS BIGINT) AS unique_users, CAST(count(*) FILTER (late) AS BIGINT) AS late
        FROM t GROUP BY d""",
    "stream_intake_runs": """WITH e AS (SELECT DISTINCT user_id AS submission_id, event_id % 9 AS run FROM events WHERE event_type = 'signup'),
        one AS (SELECT submission_id, min(run) AS first FROM e GROUP BY submission_id)
        SELECT submission_id, CAST(first AS BIGINT) AS run FROM one
        UNION ALL SELECT submission_id, CAST(min(run) AS BIGINT) FROM e JOIN one USING (submission_id) WHERE run >= first + 7 GROUP BY submission_id""",
    "stream_dedup": "SELECT DISTINCT user_id AS submission_id FROM events WHERE event_type = 'signup'",
    "stream_messages": """SELECT CAST(event_id AS VARCHAR) AS id, 'Entity syn' || event_id || ' has been created and can be viewed at https://example.org/entity/syn' || event_id AS body
        FROM events""",
    "stream_status": """SELECT user_id AS submission_id,
        arg_max(CASE WHEN event_type = 'signup' THEN 'EVALUATION_IN_PROGRESS' ELSE 'CLOSED' END, ts) AS status FROM events GROUP BY user_id""",
}


def all_oracles() -> dict[str, str]:
    return dict(ORACLE)
