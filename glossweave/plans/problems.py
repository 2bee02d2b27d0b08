"""Queries p3, p4 and p5 and the SQL they are checked against."""

from __future__ import annotations

from uuid import uuid4

from glossweave.operators.nested import child_objects, flat, table_sizes, tagged_rows
from glossweave.operators.packed import citations, split_packed
from glossweave.operators.snapshots import termbase_changes
from glossweave.session import shared_dir, table
from pyspark.sql import functions as F


def p3_found(spark, d):
    return child_objects(table(spark, d, "concept_yaml"))


def p3_terms(spark, d):
    """The flat term table with links to its localization."""
    rows = flat(tagged_rows(table(spark, d, "concept_yaml"), tags=("term",)), "term")
    return rows.select("pk", "parent_pk", "record_id", "record_lang", "pos", "type", "designation", "normative_status", "usage_info")


def p3_table_sizes(spark, d):
    """All tables, written partitioned by tag into the shared folder and read again."""
    return table_sizes(table(spark, d, "concept_yaml"), f"{shared_dir(spark)}/nested-{uuid4()}")


def p4_found(spark, d):
    return termbase_changes(table(spark, d, "termbase")).drop("changed_fields")


def p4_changed_fields(spark, d):
    changes = termbase_changes(table(spark, d, "termbase"))
    return changes.groupBy("snapshot_no", "change_kind", F.array_join("changed_fields", ",").alias("changed_fields")).agg(F.count(F.lit(1)).alias("n_records"))


def p5_found(spark, d):
    return citations(table(spark, d, "iev_export"))


def p5_errors(spark, d):
    rows = split_packed(table(spark, d, "iev_export"), "source", ["export_id"])
    return rows.groupBy(F.coalesce("error", F.lit("none")).alias("error"), "quoted").agg(F.count(F.lit(1)).alias("n_values"))


QUERIES = {f.__name__: f for f in (p3_found, p3_terms, p3_table_sizes, p4_found, p4_changed_fields, p5_found, p5_errors)}

_INVISIBLE = "[\\x{00AD}\\x{034F}\\x{061C}\\x{115F}\\x{1160}\\x{17B4}\\x{17B5}\\x{180B}-\\x{180E}\\x{200B}-\\x{200F}\\x{202A}-\\x{202E}\\x{2060}-\\x{206F}\\x{FE00}-\\x{FE0F}\\x{FEFF}]"
_WHITE = "[\\s\\x{000B}\\x{0085}\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"

_P4_BASE = f"""
WITH latest AS (
  SELECT snapshot_no, code, language_code,
    nullif(lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(definition, '{_INVISIBLE}', '', 'g'), '</?[A-Za-z][^<>]*>', '', 'g'), '{_WHITE}', ' ', 'g'), '(«\\s*|\\s*»|[“”„‟″‶〝〞＂])', '"', 'g'), '[‘’‚‛′‵‹›`´＇]', '''', 'g'))), '') AS d,
    nullif(lower(trim(regexp_replace(entry_status, '{_WHITE}', ' ', 'g'))), '') AS s,
    CASE WHEN trim(date_amended) = '' THEN NULL
         WHEN regexp_matches(trim(date_amended), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN epoch_us(CAST(trim(date_amended) || ' 00:00:00+00' AS TIMESTAMPTZ))::VARCHAR
         ELSE coalesce(epoch_us(TRY_CAST(trim(date_amended) AS TIMESTAMPTZ))::VARCHAR, trim(date_amended)) END AS a
  FROM termbase WHERE snapshot_no IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY snapshot_no, code, language_code ORDER BY loaded_at DESC NULLS LAST) = 1
), deliveries AS (
  SELECT snapshot_no, lead(snapshot_no) OVER (ORDER BY snapshot_no) AS following FROM (SELECT DISTINCT snapshot_no FROM latest)
), moves AS (
  SELECT following AS snapshot_no, code, language_code, d, s, a, 'old' AS side FROM latest JOIN deliveries USING (snapshot_no) WHERE following IS NOT NULL
  UNION ALL
  SELECT snapshot_no, code, language_code, d, s, a, 'new' FROM latest WHERE snapshot_no > (SELECT min(snapshot_no) FROM deliveries)
), paired AS (
  SELECT snapshot_no, code, language_code, count(*) FILTER (side = 'old') AS o, count(*) FILTER (side = 'new') AS n,
    max(d) FILTER (side = 'old') IS DISTINCT FROM max(d) FILTER (side = 'new') AS dd,
    max(s) FILTER (side = 'old') IS DISTINCT FROM max(s) FILTER (side = 'new') AS ss,
    max(a) FILTER (side = 'old') IS DISTINCT FROM max(a) FILTER (side = 'new') AS aa
  FROM moves GROUP BY 1, 2, 3
), changes AS (
  SELECT snapshot_no, code, language_code, CASE WHEN o = 0 THEN 'added' WHEN n = 0 THEN 'removed' ELSE 'changed' END AS change_kind,
    CASE WHEN o = 0 OR n = 0 THEN '' ELSE array_to_string(list_filter([CASE WHEN dd THEN 'definition' END, CASE WHEN ss THEN 'entry_status' END, CASE WHEN aa THEN 'date_amended' END], lambda x: x IS NOT NULL), ',') END AS changed_fields
  FROM paired WHERE o = 0 OR n = 0 OR dd OR ss OR aa
)
"""

_LIST = "CASE json_type({0}, '$.{1}') WHEN 'ARRAY' THEN list_filter(CAST(json_extract({0}, '$.{1}') AS JSON[]), lambda x: json_type(x) = 'OBJECT') WHEN 'OBJECT' THEN [json_extract({0}, '$.{1}')] ELSE [] END"
_TEXTS = "CASE coalesce(json_type({0}, '$.{1}'), 'NULL') WHEN 'ARRAY' THEN json_array_length({0}, '$.{1}') WHEN 'NULL' THEN 0 ELSE 1 END"
_P3_BASE = f"""
WITH whole AS (
  SELECT record_id, CAST(body AS JSON) AS j FROM concept_yaml WHERE json_valid(body)
), halves AS (
  SELECT record_id, 0 AS half, j AS h FROM whole UNION ALL SELECT record_id, 1, json_extract(j, '$.data') FROM whole WHERE json_type(j, '$.data') = 'OBJECT'
), domains AS (
  SELECT record_id, list_filter(flatten(list({_LIST.format("h", "domains")} ORDER BY half)), lambda x: true) AS a FROM halves GROUP BY 1
), listed AS (
  SELECT record_id, flatten(list(CASE json_type(h, '$.localized_concepts')
     WHEN 'ARRAY' THEN CAST(json_extract(h, '$.localized_concepts') AS JSON[])
     WHEN 'OBJECT' THEN json_extract(h, '$.localized_concepts.*') ELSE [] END ORDER BY half)) AS many FROM halves GROUP BY 1
), named AS (
  SELECT record_id, n, many[n] AS l, json_extract_string(many[n], '$.language_code') AS lang, {_LIST.format("many[n]", "terms")} AS t FROM (SELECT *, unnest(range(1, len(many) + 1)) AS n FROM listed)
)
"""

ORACLE = {
    "p3_found": _P3_BASE
    + """
SELECT record_id, 'domain' AS kind, '' AS lang, CAST(i AS INTEGER) AS pos, coalesce(json_extract_string(a[i], '$.concept_id'), '') AS item FROM (SELECT record_id, a, unnest(range(1, len(a) + 1)) AS i FROM domains)
UNION ALL SELECT record_id, 'localized', lang, 0, lang FROM named
UNION ALL SELECT record_id, 'term', lang, CAST(i AS INTEGER), coalesce(json_extract_string(t[i], '$.designation'), '') FROM (SELECT record_id, lang, t, unnest(range(1, len(t) + 1)) AS i FROM named)
""",
    "p3_terms": _P3_BASE
    + """
SELECT record_id || '/l' || n || '/t' || i AS pk, record_id || '/l' || n AS parent_pk, record_id, lang AS record_lang, CAST(i AS INTEGER) AS pos, json_extract_string(t[i], '$.type') AS type,
  json_extract_string(t[i], '$.designation') AS designation, json_extract_string(t[i], '$.normative_status') AS normative_status, json_extract_string(t[i], '$.usage_info') AS usage_info
FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM named)
""",
    "p3_table_sizes": _P3_BASE
    + f"""
, sizes AS (
  SELECT record_id, 'record' AS tag, 1 AS n FROM whole UNION ALL SELECT record_id, 'domain', len(a) FROM domains
  UNION ALL SELECT record_id, 'related', len({_LIST.format("h", "related")}) FROM halves
  UNION ALL SELECT record_id, 'localized', 1 FROM named UNION ALL SELECT record_id, 'term', len(t) FROM named
  UNION ALL SELECT record_id, 'note', {_TEXTS.format("l", "notes")} FROM named UNION ALL SELECT record_id, 'example', {_TEXTS.format("l", "examples")} FROM named
  UNION ALL SELECT record_id, 'source', len({_LIST.format("l", "sources")}) FROM named
) SELECT tag, CAST(sum(n) AS BIGINT) AS n_rows, count(DISTINCT record_id) AS n_records, CAST(0 AS BIGINT) AS n_orphans FROM sizes WHERE n > 0 GROUP BY 1
""",
    "p4_found": _P4_BASE + "SELECT snapshot_no, code, language_code, change_kind FROM changes",
    "p4_changed_fields": _P4_BASE + "SELECT snapshot_no, change_kind, changed_fields, count(*) AS n_records FROM changes GROUP BY 1, 2, 3",
}
