"""Queries of the terminology operators over the delivered tables, with the SQL each is checked against.

``iev_export`` is the sheet, ``sections`` the hierarchy, the latest ``termbase`` snapshot the
old side of a reconciliation and ``localized_concepts`` the new one.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from glossweave.functions import citation_rules as cite
from glossweave.functions import codes, labels, text
from glossweave.functions.register import register
from glossweave.markup import adoc, pages
from glossweave.operators import bibliography as bib
from glossweave.operators import export as ex
from glossweave.operators import figures as fig
from glossweave.operators import hierarchy as hier
from glossweave.operators import lookup
from glossweave.operators import reconcile as rec
from glossweave.operators.sheet import COLUMNS, as_sheet, filtered, first_of, first_wins, primary_rows
from glossweave.parsers.attributes import attributes
from glossweave.parsers.definition import definition_parts
from glossweave.parsers.markers import markers
from glossweave.parsers.supersession import superseded
from glossweave.session import table
from glossweave.sources import snapshots

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
DETECTED = "2026-07-10"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def sheet(spark, d):
    return as_sheet(table(spark, d, "iev_export").withColumnRenamed("language_code", "LANGUAGE"), "export_id")


SHEET = "SELECT export_id AS _ord, ievref AS code, language_code AS lang, * FROM iev_export"
#: One row per (code, language): the first.
PRIMARY = f"SELECT * FROM ({SHEET}) QUALIFY row_number() OVER (PARTITION BY code, lang ORDER BY _ord) = 1"
AREA = "split_part(code, '-', 1)"
SECTION = "split_part(code, '-', 1) || '-' || split_part(code, '-', 2)"
STRIP = r"regexp_replace(regexp_replace(%s, '^[\s\x00]+', ''), '[\s\x00]+$', '')"
DIM_AREA = "SELECT area_code, arg_min(area_title, section_code) FILTER (area_title IS NOT NULL) AS area_title FROM sections WHERE area_code IS NOT NULL GROUP BY 1"


# ---- scans, filters, first-wins ---------------------------------------------------------


@query("SELECT export_id AS _ord, " + ", ".join(f"{'language_code' if c == 'LANGUAGE' else c.lower()} AS {c}" for c in COLUMNS) + " FROM iev_export")
def scan_header_projection(spark, d):
    return sheet(spark, d)


@query(f"SELECT _ord, code, term FROM ({SHEET}) WHERE code ILIKE '9_5-0%'")
def filter_like_code(spark, d):
    return filtered(sheet(spark, d), only_concepts="9_5-0%").select("_ord", F.col("IEVREF").alias("code"), F.col("TERM").alias("term"))


@query(f"SELECT _ord, code, lang, term FROM ({SHEET}) WHERE lang IN ('eng', 'fr', 'ja')")
def filter_in_language(spark, d):
    rows = filtered(sheet(spark, d), only_languages="eng,fr,ja")
    return rows.select("_ord", F.col("IEVREF").alias("code"), F.col("LANGUAGE").alias("lang"), F.col("TERM").alias("term"))


@query("SELECT l10n_id, code, definition FROM localized_concepts WHERE definition IS NOT NULL AND term IS NOT NULL")
def filter_not_null(spark, d):
    return table(spark, d, "localized_concepts").where("definition is not null and term is not null").select("l10n_id", "code", "definition")


@query(f"SELECT _ord, code, lang, term, definition FROM ({PRIMARY})")
def first_wins_pk(spark, d):
    rows = primary_rows(sheet(spark, d))
    return rows.select("_ord", F.col("IEVREF").alias("code"), F.col("LANGUAGE").alias("lang"), F.col("TERM").alias("term"), F.col("DEFINITION").alias("definition"))


# ---- codes, text, dates, maps -----------------------------------------------------------

@query(f"""SELECT DISTINCT code, {AREA} AS area, {SECTION} AS section, split_part(code, '-', 3) AS number, 'area-' || {AREA} AS area_uri, 'section-' || {SECTION} AS section_uri,
  regexp_replace(code, '-[^-]*$', '') AS section_of, array_to_string([CAST(CAST(x AS INTEGER) AS VARCHAR) FOR x IN string_split(code, '-')], '.') AS numeric_order FROM ({SHEET})""")
def code_decompose(spark, d):
    c = F.col("code")
    rows = sheet(spark, d).select(F.col("IEVREF").alias("code")).distinct()
    return rows.select(
        "code", codes.area_code(c).alias("area"), codes.section_code(c).alias("section"), codes.concept_number(c).alias("number"),
        codes.area_uri(codes.area_code(c)).alias("area_uri"), codes.section_uri(codes.section_code(c)).alias("section_uri"), codes.section_of(c).alias("section_of"),
        F.array_join(F.transform(codes.numeric_order(c), lambda x: x.cast("string")), ".").alias("numeric_order"),
    )


@query("SELECT l10n_id, " + STRIP % "translate(nfc_normalize(term), chr(8209) || chr(160) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(65279), '-' || '        ')" + " AS term FROM localized_concepts")
def sanitize_text(spark, d):
    return table(spark, d, "localized_concepts").select("l10n_id", text.sanitize(F.col("term")).alias("term"))


_BASIC = "replace(replace(replace(replace(replace(source, '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '&quot;', '\"'), '&#39;', '''')"


@query(f"SELECT export_id, {_BASIC} AS source FROM iev_export")
def basic_entity_decode(spark, d):
    return table(spark, d, "iev_export").select("export_id", text.basic_entities(F.col("source")).alias("source"))


@query()
def html_entity_decode(spark, d):
    return table(spark, d, "iev_export").select("export_id", text.decode_entities(F.concat(F.lit("&Omega;&#8211;&lt;"), F.col("source"))).alias("source"))


_COMPARABLE = "lower(" + STRIP % r"regexp_replace(translate(regexp_replace(regexp_replace(nfc_normalize(coalesce(definition, '')), '<[^>]+>', '', 'g'), '[\x{00A0}\x{200B}\x{FEFF}\x{00AD}]', '', 'g'), '″‴„‟‚‛', repeat(chr(34), 6)), '[\s\x{000B}]+', ' ', 'g')" + ")"


@query(f"SELECT snapshot_no, code, language_code, {_COMPARABLE} AS form, count(*) AS n_rows FROM termbase GROUP BY ALL")
def normalize_compare(spark, d):
    rows = table(spark, d, "termbase").select("snapshot_no", "code", "language_code", text.comparable(F.col("definition")).alias("form"))
    return rows.groupBy("snapshot_no", "code", "language_code", "form").agg(F.count(F.lit(1)).alias("n_rows"))


_PARAGRAPHS = STRIP % r"regexp_replace(regexp_replace(regexp_replace(replace(source, '\n', chr(10) || chr(10)), '<[pbr]+>', chr(10) || chr(10), 'g'), '<br\s*/?>', chr(10) || chr(10), 'g'), '\s*\n[\n\s]+', chr(10) || chr(10), 'g')"


@query(f"SELECT export_id, {_PARAGRAPHS} AS source FROM iev_export")
def newline_normalize(spark, d):
    return table(spark, d, "iev_export").select("export_id", text.paragraph_breaks(F.col("source")).alias("source"))


@query(r"SELECT export_id, regexp_replace(regexp_replace(publicationdate || ' : ' || definition, '^\s*[0-9]+[\s:\x{2003}]*\s*', ''), '^\s*:\s*', '') AS note FROM iev_export")
def leading_number_cleanup(spark, d):
    listed = F.concat(F.col("publicationdate"), F.lit(" : "), F.col("definition"))
    return table(spark, d, "iev_export").select("export_id", text.without_leading_number(listed).alias("note"))


@query("SELECT l10n_id, 'stem:[alpha] ' || term || ' stem:[varphi]' AS with_stem, 'alpha ' || term AS bare FROM localized_concepts")
def greek_entities(spark, d):
    typed = F.concat(F.lit("&alpha; "), F.col("term"), F.lit(" &varphi;"))
    bare = F.concat(F.lit("&alpha; "), F.col("term"))
    return table(spark, d, "localized_concepts").select("l10n_id", text.greek_names(typed).alias("with_stem"), text.greek_names(bare, as_stem=False).alias("bare"))


@query()
def definition_split(spark, d):
    """Definitions with notes and an example put behind them, taken apart again."""
    rows = sheet(spark, d).withColumn("_d", F.concat("DEFINITION", F.lit("<p>Note 1 to entry: 1: "), "TERM", F.lit("<p>EXAMPLE "), F.coalesce("SYNONYM1", "TERM"), F.lit(" NOTE 2 - "), "TERM"))
    parts = rows.select("_ord", definition_parts(F.col("_d")).alias("p"))
    return parts.select("_ord", "p.definition", F.array_join("p.examples", "|").alias("examples"), F.array_join("p.notes", "|").alias("notes"))


@query("""WITH t AS (SELECT export_id, string_split(definition || chr(10) || 'Note 1 to entry: ' || coalesce(term, 'x') || chr(10) || '  EXAMPLE: ' || coalesce(synonym1, 'y') || chr(10) || 'end', chr(10)) AS lines FROM iev_export)
SELECT export_id, trim(array_to_string(list_filter(lines, lambda x: NOT regexp_matches(trim(x), '(?i)^(Note\\s+[0-9]+\\s+to\\s+entry:|Example\\s*:)')), chr(10)), ' ' || chr(9) || chr(10)) AS definition,
 coalesce(array_to_string([regexp_replace(trim(x), '(?i)^Note\\s+[0-9]+\\s+to\\s+entry:\\s*', '') FOR x IN lines IF regexp_matches(trim(x), '(?i)^Note\\s+[0-9]+\\s+to\\s+entry:')], '|'), '') AS notes,
 coalesce(array_to_string([regexp_replace(trim(x), '(?i)^Example\\s*:\\s*', '') FOR x IN lines IF regexp_matches(trim(x), '(?i)^Example\\s*:')], '|'), '') AS examples FROM t""")
def note_example_lines(spark, d):
    nl = F.lit("\n")
    typed = F.concat("definition", nl, F.lit("Note 1 to entry: "), F.coalesce("term", F.lit("x")), nl, F.lit("  EXAMPLE: "), F.coalesce("synonym1", F.lit("y")), nl, F.lit("end"))
    rows = table(spark, d, "iev_export").select("export_id", text.note_and_example_lines(typed).alias("p"))
    return rows.select("export_id", "p.definition", F.array_join("p.notes", "|").alias("notes"), F.array_join("p.examples", "|").alias("examples"))


_TYPE = "CASE WHEN regexp_matches(coalesce({0}, ''), '^(IEV|VIM|JCGM)') THEN 'vocabulary' WHEN regexp_matches(coalesce({0}, ''), '^ITU') THEN 'recommendation' WHEN regexp_matches(coalesce({0}, ''), '^(BIPM|BBIPM)') THEN 'brochure' ELSE 'standard' END"
_ANCHOR = "lower(regexp_replace(regexp_replace({0}, '[ /:]', '_', 'g'), '__+', '_', 'g'))"


@query(f"SELECT ref_id, trim(concat_ws(' ', publisher, doc_number)) AS label, {_ANCHOR.format('canonical')} AS anchor, {_TYPE.format('canonical')} AS type FROM publications")
def bibliography_type_anchor(spark, d):
    p = table(spark, d, "publications")
    return p.select("ref_id", labels.reference_label(F.col("publisher"), F.col("doc_number")).alias("label"), labels.anchor(F.col("canonical")).alias("anchor"), labels.reference_type(F.col("canonical")).alias("type"))


def _case(words: dict[str, str], col: str, otherwise: str) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in words.items()) + f" ELSE {otherwise} END"


@query("""SELECT export_id, CASE WHEN lower(status) = 'standard' THEN 'valid' END AS sheet_status,
 CASE status WHEN 'Draft' THEN 'draft' WHEN 'Not Valid' THEN 'notValid' WHEN 'Superseded' THEN 'superseded' WHEN 'Retired' THEN 'retired' ELSE 'valid' END AS termbase_status,
 CASE WHEN synonym1status IN ('认可的', 'допустимый', 'admitido') THEN 'admitted' WHEN synonym1status IN ('首选的', 'suositettava', 'suositeltava', 'рекомендуемый', 'preferente') THEN 'preferred' ELSE lower(nullif(synonym1status, '')) END AS classification,
 CASE WHEN lower(synonym1status) IN ('obsoleto', 'напуштен') THEN 'deprecated' ELSE lower(synonym1status) END AS designation_status FROM iev_export""")
def status_maps(spark, d):
    s1 = F.col("synonym1status")
    return table(spark, d, "iev_export").select(
        "export_id", labels.sheet_status(F.col("status")).alias("sheet_status"), labels.termbase_status(F.col("status")).alias("termbase_status"),
        labels.classification(s1).alias("classification"), labels.designation_status(F.lower(s1)).alias("designation_status"),
    )


_LANGS = _case({k: v for k, v in labels.PAGE_LANGUAGES.items() if k != "no"} | {"no": "nor"}, "k", "NULL")


@query(f"""SELECT export_id, language_code, CASE WHEN length(language_code) = 3 THEN language_code ELSE coalesce({_LANGS}, language_code) END AS language, {_LANGS} AS page_language
 FROM (SELECT *, CASE WHEN length(language_code) > 2 THEN split_part(language_code, ' ', 1) ELSE language_code END AS k FROM iev_export)""")
def language_dim_join(spark, d):
    rows = labels.three_letter(table(spark, d, "iev_export"), "language_code", labels.language_dimension(spark))
    return rows.select("export_id", "language_code", "language", labels.page_language(F.col("language_code")).alias("page_language"))


@query("SELECT export_id, CASE WHEN publicationdate = '' THEN '' ELSE publicationdate || CASE length(publicationdate) WHEN 4 THEN '-01-01' WHEN 7 THEN '-01' ELSE '' END || 'T00:00:00+00:00' END AS published FROM iev_export")
def partial_date(spark, d):
    return table(spark, d, "iev_export").select("export_id", codes.complete_date(F.col("publicationdate")).alias("published"))


@query("SELECT export_id, CASE WHEN p IS NULL THEN NULL ELSE 'accepted=' || p || ',amended=' || p END AS dates FROM (SELECT export_id, publicationdate || CASE length(publicationdate) WHEN 4 THEN '-01-01' WHEN 7 THEN '-01' ELSE '' END || 'T00:00:00+00:00' AS p FROM iev_export)")
def date_pair_projection(spark, d):
    p = codes.complete_date(F.col("publicationdate"))
    pair = F.array(F.struct(F.lit("accepted").alias("type"), p.alias("date")), F.struct(F.lit("amended").alias("type"), p.alias("date")))
    rows = table(spark, d, "iev_export").select("export_id", F.when(p.isNotNull(), pair).alias("_d"))
    return rows.select("export_id", F.array_join(F.transform("_d", lambda x: F.concat_ws("=", x["type"], x["date"])), ",").alias("dates"))


@query("SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE coalesce(text, '') END AS text FROM documents")
def truncate_200(spark, d):
    return table(spark, d, "documents").select("doc_id", text.shorten(F.col("text")).alias("text"))


@query("SELECT code, k, CASE WHEN code ILIKE '925%' THEN 'x' END AS marked FROM (SELECT DISTINCT code, length(code) AS k FROM localized_concepts)")
def map_lookup(spark, d):
    rows = table(spark, d, "localized_concepts").select("code", F.length("code").alias("k")).distinct()
    return rows.withColumn("marked", labels.lookup({"925": "x"}, F.substring("code", 1, 3)))


@query("""WITH a AS (SELECT code, list_sort(list(DISTINCT language_code)) AS old FROM termbase GROUP BY 1), b AS (SELECT code, list_sort(list(DISTINCT language_code)) AS new FROM localized_concepts GROUP BY 1)
SELECT code, array_to_string(list_sort(list_filter(new, lambda x: list_contains(old, x))), ',') AS common, array_to_string(list_sort(list_filter(new, lambda x: NOT list_contains(old, x))), ',') AS added,
 array_to_string(list_sort(list_distinct(list_concat(old, new))), ',') AS every FROM a JOIN b USING (code)""")
def array_set_ops(spark, d):
    a = table(spark, d, "termbase").groupBy("code").agg(F.collect_set("language_code").alias("old"))
    b = table(spark, d, "localized_concepts").groupBy("code").agg(F.collect_set("language_code").alias("new"))
    shown = lambda x: F.array_join(F.sort_array(x), ",")
    return a.join(b, "code").select("code", shown(F.array_intersect("old", "new")).alias("common"), shown(F.array_except("new", "old")).alias("added"), shown(F.array_union("old", "new")).alias("every"))


# ---- dimensions and lookups -------------------------------------------------------------

_TITLES = f"({SHEET}) s LEFT JOIN (SELECT section_code AS sc, section_title FROM sections) x ON x.sc = {SECTION} LEFT JOIN ({DIM_AREA}) a ON a.area_code = {AREA}"


@query(f"SELECT _ord, code, section_title, area_title, coalesce(section_title, area_title) AS domain FROM {_TITLES}")
def area_section_lookup(spark, d):
    rows = sheet(spark, d).select("_ord", F.col("IEVREF").alias("code"))
    return hier.domain_title(hier.with_titles(rows, "code", table(spark, d, "sections"))).select("_ord", "code", "section_title", "area_title", "domain")


@query("SELECT area_code, section_code, section_title, area_title FROM sections JOIN (SELECT area_code AS c FROM (" + DIM_AREA + ") WHERE area_code = '925') ON c = area_code")
def point_lookup(spark, d):
    s = table(spark, d, "sections")
    inside = hier.sections_for(s, 925).select("section_code", "section_title", "area_code")
    return inside.join(hier.find_area(s, "925"), "area_code").select("area_code", "section_code", "section_title", "area_title")


@query(f"""SELECT DISTINCT code, 'area-' || {AREA} || ':domain,section-' || {SECTION} || ':section' AS domains, concat_ws(',', area_title, section_title) AS tags FROM {_TITLES}""")
def domain_refs_tags(spark, d):
    rows = hier.with_titles(sheet(spark, d).select(F.col("IEVREF").alias("code")).distinct(), "code", table(spark, d, "sections"))
    refs = F.transform(codes.domain_references(F.col("code")), lambda r: F.concat_ws(":", r["concept_id"], r["ref_type"]))
    return rows.select("code", F.array_join(refs, ",").alias("domains"), F.concat_ws(",", "area_title", "section_title").alias("tags"))


@query("""SELECT l10n_id, arg_min_null(designation, {'a': coalesce(normative_status <> 'preferred', true), 'b': term_no}) AS designation FROM terms GROUP BY 1""")
def preferred_else_first(spark, d):
    return lookup.designations(table(spark, d, "terms"), ["l10n_id"])


_SECTIONS_OF = "SELECT DISTINCT section_code, area_code, section_title FROM sections"


@query(f"""SELECT 'area-' || area_code AS concept_id, 'area' AS kind, area_title AS term, NULL AS domain, concat_ws(',', area_title) AS tags, (SELECT string_agg('narrower:section-' || section_code, ',' ORDER BY section_code) FROM sections s WHERE s.area_code = a.area_code) AS related FROM ({DIM_AREA}) a
UNION ALL SELECT 'section-' || section_code, 'section', section_title, area_title, concat_ws(',', area_title, section_title), 'broader:area-' || area_code FROM ({_SECTIONS_OF}) JOIN ({DIM_AREA}) USING (area_code)
UNION ALL SELECT code, 'concept', term, NULL, '', NULL FROM ({PRIMARY}) WHERE lang = 'eng'""")
def hierarchy_union(spark, d):
    tree = hier.hierarchy_concepts(table(spark, d, "sections"))
    related = F.transform("related", lambda r: F.concat_ws(":", r["type"], r["ref"]["id"]))
    shown = tree.select("concept_id", "kind", "term", "domain", F.array_join("tags", ",").alias("tags"), F.array_join(related, ",").alias("related"))
    rows = primary_rows(sheet(spark, d)).where("LANGUAGE = 'eng'")
    none = F.lit(None).cast("string")
    return shown.unionByName(rows.select(F.col("IEVREF").alias("concept_id"), F.lit("concept").alias("kind"), F.col("TERM").alias("term"), none.alias("domain"), F.lit("").alias("tags"), none.alias("related")))


@query(f"""SELECT area_code, area_title, (SELECT string_agg(section_code || '=' || coalesce(section_title, ''), ';' ORDER BY CAST(split_part(section_code, '-', 2) AS INTEGER)) FROM sections s WHERE s.area_code = a.area_code) AS children FROM ({DIM_AREA}) a""")
def section_tree(spark, d):
    shown = F.transform("children", lambda c: F.concat(c["code"], F.lit("="), F.coalesce(c["title"], F.lit(""))))
    return hier.section_tree(table(spark, d, "sections")).select("area_code", "area_title", F.array_join(shown, ";").alias("children"))


# ---- nesting ----------------------------------------------------------------------------

@query(f"""SELECT code, string_agg(lang, ',' ORDER BY _ord) AS languages, count(*) AS n_languages, arg_min(CASE lower(status) WHEN 'standard' THEN 'valid' END, _ord) FILTER (lower(status) = 'standard') AS status, min(_ord) AS first_row FROM ({PRIMARY}) GROUP BY 1""")
def concept_nest(spark, d):
    rows = primary_rows(sheet(spark, d)).select("_ord", F.col("IEVREF").alias("code"), F.col("LANGUAGE").alias("language"), labels.sheet_status(F.col("STATUS")).alias("entry_status"), F.lit(None).cast("array<struct<type:string,source:string,id:string>>").alias("related"))
    nested = ex.concepts(rows.withColumn("_first", F.col("_ord")))
    return nested.select("code", F.array_join("languages", ",").alias("languages"), F.size("languages").cast("long").alias("n_languages"), "status", F.col("_ord").alias("first_row"))


_SUPERSEDED = r"^(IEV\s+)?([0-9]{3}-[0-9]{2}-[0-9]{2})\s*:\s*[-0-9]+$"


@query(f"""SELECT export_id, 'supersedes' AS type, regexp_extract(trim(replaces), '{_SUPERSEDED}', 2) AS ref FROM iev_export WHERE regexp_matches(trim(replaces), '{_SUPERSEDED}')""")
def supersession_parse(spark, d):
    rows = table(spark, d, "iev_export").select("export_id", F.explode(superseded(F.col("replaces"))).alias("_r"))
    return rows.select("export_id", "_r.type", F.col("_r.id").alias("ref"))


@query(f"""WITH r AS (SELECT code, regexp_extract(trim(replaces), '{_SUPERSEDED}', 2) AS ref, min(_ord) AS o FROM ({PRIMARY}) WHERE regexp_matches(trim(replaces), '{_SUPERSEDED}') GROUP BY 1, 2)
SELECT code, concat_ws(',', string_agg('supersedes:' || ref, ',' ORDER BY o), 'broader:section-' || {SECTION}) AS related FROM (SELECT DISTINCT code FROM ({PRIMARY})) LEFT JOIN r USING (code) GROUP BY code""")
def relations_dedupe(spark, d):
    rows = primary_rows(sheet(spark, d)).select("_ord", F.col("IEVREF").alias("code"), F.col("LANGUAGE").alias("language"), F.lit("valid").alias("entry_status"), superseded(F.col("REPLACES")).alias("related"))
    nested = ex.concepts(rows.withColumn("_first", F.col("_ord")))
    return nested.select("code", F.array_join(F.transform("related", lambda r: F.concat_ws(":", r["type"], r["id"])), ",").alias("related"))


@query(f"SELECT DISTINCT {SECTION} AS section_code, code FROM ({SHEET})")
def section_children(spark, d):
    return ex.section_children(sheet(spark, d).select(F.col("IEVREF").alias("code")))


@query(f"SELECT count(DISTINCT code) AS n_concepts, count(*) AS n_localized, (SELECT count(*) FROM iev_export) AS n_rows FROM ({PRIMARY})")
def row_and_localized_counts(spark, d):
    rows = sheet(spark, d)
    per_key = rows.groupBy("IEVREF", "LANGUAGE").agg(F.count(F.lit(1)).alias("_n"))
    per_code = per_key.groupBy("IEVREF").agg(F.count(F.lit(1)).alias("_l"), F.sum("_n").alias("_n"))
    return per_code.agg(F.count(F.lit(1)).alias("n_concepts"), F.sum("_l").alias("n_localized"), F.sum("_n").alias("n_rows"))


@query("""SELECT export_id, array_to_string(list_concat([CASE WHEN term = '.....' THEN 'NA' ELSE term END], list_concat(s1, s2)), '|') AS designations, 'preferred' AS first_status, coalesce(lower(synonym1status), '') AS second_status FROM (
  SELECT *, CASE WHEN coalesce(synonym1, '') = '' THEN [] ELSE regexp_split_to_array(synonym1 || '<br>b', '<[pbr]+>') END AS s1, CASE WHEN coalesce(synonym2, '') = '' THEN [] ELSE [synonym2] END AS s2 FROM iev_export)""")
def synonym_split(spark, d):
    t = F.when(F.col("term") == ".....", F.lit("NA")).otherwise(F.col("term"))
    # a second designation and the empty ones that don't count are put behind the first synonym
    first = F.when(F.coalesce("synonym1", F.lit("")) != "", F.concat("synonym1", F.lit("<br>b<p><br>")))
    every = F.concat(F.array(t), text.split_synonyms(first), text.split_synonyms(F.col("synonym2")))
    rows = table(spark, d, "iev_export")
    return rows.select("export_id", F.array_join(every, "|").alias("designations"), F.lit("preferred").alias("first_status"), F.coalesce(labels.designation_status(F.lower("synonym1status")), F.lit("")).alias("second_status"))


@query("""SELECT export_id, CASE WHEN regexp_matches(termattribute, '\\b[mfn]\\b') THEN regexp_extract(termattribute, '\\b([mfn])\\b', 1) END AS gender,
 CASE WHEN regexp_matches(termattribute, '\\bpl\\b') THEN 'plural' WHEN regexp_matches(termattribute, '\\b[mfn]\\b') THEN 'singular' END AS number,
 CASE WHEN regexp_matches(termattribute, '\\badj\\b') THEN 'adj' END AS part_of_speech, nullif(regexp_extract(termattribute, '<(.*?)>', 1), '') AS usage_info,
 nullif(regexp_extract(termattribute, '\\b([A-Z]{2})$', 1), '') AS geographical_area, CAST(NULL AS VARCHAR) AS prefix FROM iev_export""")
def term_attrs(spark, d):
    return table(spark, d, "iev_export").select("export_id", attributes(F.col("termattribute")).alias("a")).select("export_id", "a.gender", "a.number", "a.part_of_speech", "a.usage_info", "a.geographical_area", "a.prefix")


@query("""SELECT export_id, 'expression' AS type, CASE WHEN term = '.....' THEN 'NA' ELSE term END AS designation, 'preferred' AS normative_status, CASE WHEN coalesce(g, n, p) IS NOT NULL THEN concat_ws('/', coalesce(g, '-'), coalesce(n, '-'), coalesce(p, '-')) END AS grammar, symbole AS symbol, symbole IS NOT NULL AS international FROM (
  SELECT *, CASE WHEN regexp_matches(termattribute, '\\b[mfn]\\b') THEN regexp_extract(termattribute, '\\b([mfn])\\b', 1) END AS g, CASE WHEN regexp_matches(termattribute, '\\bpl\\b') THEN 'plural' WHEN regexp_matches(termattribute, '\\b[mfn]\\b') THEN 'singular' END AS n, CASE WHEN regexp_matches(termattribute, '\\badj\\b') THEN 'adj' END AS p FROM iev_export)""")
def designation_build(spark, d):
    rows = table(spark, d, "iev_export").withColumn("_a", attributes(F.col("termattribute")))
    t = F.when(F.col("term") == ".....", F.lit("NA")).otherwise(F.col("term"))
    built = rows.select("export_id", ex.expression_designation(t, F.col("_a"), F.lit("preferred")).alias("e"), ex.symbol_designation(F.col("symbole")).alias("s"))
    one = F.col("e.grammar_info")[0]
    part = lambda c: F.coalesce(c, F.lit("-"))
    grammar = F.when(F.col("e.grammar_info").isNotNull(), F.concat_ws("/", part(one["gender"][0]), part(one["number"][0]), part(one["part_of_speech"])))
    return built.select("export_id", "e.type", "e.designation", "e.normative_status", grammar.alias("grammar"), F.col("s.designation").alias("symbol"), (F.col("s.international") & F.col("s.designation").isNotNull()).alias("international"))


@query()
def term_markers(spark, d):
    """Terms with the markers that their stored attributes stand for, taken apart again."""
    t = table(spark, d, "terms")
    typed = F.concat(F.coalesce("designation", F.lit("NA")), F.coalesce(F.concat(F.lit(" "), "usage_info"), F.lit("")), F.coalesce(F.concat(F.lit(", "), "gender"), F.lit("")))
    rows = t.select("term_id", markers(typed).alias("m"))
    return rows.select("term_id", "m.designation", F.array_join("m.genders", ",").alias("genders"), F.array_join("m.numbers", ",").alias("numbers"), "m.domain", "m.usage_info", "m.part_of_speech", "m.is_prefix")


# ---- citations --------------------------------------------------------------------------

def _sql_rewrite(col: str, rules, first: bool = False) -> str:
    for pattern, to in rules:
        p, t = pattern.replace("'", "''"), re.sub(r"\$(\d)", r"\\\1", to).replace("'", "''")
        col = f"regexp_replace({col}, '{p}', '{t}'" + (")" if first else ", 'g')")
    return col


def _sql_reference(col: str) -> str:
    whens = []
    for pattern, template, cut in cite.REFERENCES:
        flags, bare = ("i", pattern[4:]) if pattern.startswith("(?i)") else ("", pattern)
        to = re.sub(r"\{(\d)\}", r"\\\1", template)
        made = f"regexp_replace({col}, '(?s{flags})\\A.*?(?:{bare}).*\\z', '{to}')".replace("l'IEV", "l''IEV")
        made = f"regexp_replace({made}, ':$', '')" if cut else made
        whens.append(f"WHEN regexp_matches({col}, '{pattern.replace(chr(39), chr(39) * 2)}') THEN {made}")
    return "trim(regexp_replace(CASE " + " ".join(whens) + f" ELSE {col} END, ', modifi(ed|é)$', ''))"


_SPLIT = "[" + STRIP % "x" + " FOR x IN string_split(regexp_replace(" + _sql_rewrite("source", cite.CUTS) + ", '(;;)+$', ''), ';;')]"
_PARTS = f"SELECT export_id, unnest(range(0, len(p))) AS pos, unnest(p) AS original FROM (SELECT export_id, CASE WHEN source = '' THEN [] ELSE {_SPLIT} END AS p FROM iev_export WHERE source IS NOT NULL)"
_SPELLED = f"SELECT *, {_sql_rewrite(_sql_rewrite('original', cite.SPELLINGS), cite.FIRST_FORMS, first=True)} AS spelled FROM ({_PARTS})"
_REFERENCED = f"SELECT *, {_sql_reference('spelled')} AS reference FROM ({_SPELLED})"
_PUBLISHER = f"'\\A({'|'.join(cite.PUBLISHERS)})\\s+(.+)'"
_PUBLISHED = f"""SELECT *, CASE WHEN regexp_matches(reference, {_PUBLISHER}) THEN regexp_extract(reference, {_PUBLISHER}, 1) WHEN regexp_matches(reference, '\\AJCGM\\s+VIM\\z') THEN 'JCGM' WHEN regexp_matches(reference, '\\ABBIPM') THEN 'BIPM' ELSE reference END AS source,
 CASE WHEN regexp_matches(reference, {_PUBLISHER}) THEN regexp_extract(reference, {_PUBLISHER}, 2) WHEN regexp_matches(reference, '\\AJCGM\\s+VIM\\z') THEN 'VIM' WHEN regexp_matches(reference, '\\ABBIPM') THEN 'SI Brochure' END AS id FROM ({_REFERENCED})"""


def _parts(spark, d):
    rows = table(spark, d, "iev_export").where("source is not null").select("export_id", cite.split_field(F.col("source")).alias("_p"))
    return rows.select("export_id", F.posexplode("_p").alias("pos", "original"))


def _spelled(spark, d):
    return _parts(spark, d).withColumn("spelled", cite.one_spelling(F.col("original")))


@query(f"SELECT export_id, CAST(pos AS INTEGER) AS pos, original FROM ({_PARTS})")
def source_split(spark, d):
    return _parts(spark, d)


@query(f"SELECT export_id, CAST(pos AS INTEGER) AS pos, spelled FROM ({_SPELLED})")
def source_ref_normalize(spark, d):
    return _spelled(spark, d).select("export_id", "pos", "spelled")


@query(f"SELECT export_id, CAST(pos AS INTEGER) AS pos, reference FROM ({_REFERENCED})")
def source_ref_match(spark, d):
    return cite.with_reference(_spelled(spark, d), "spelled").select("export_id", "pos", "reference")


@query(f"SELECT export_id, CAST(pos AS INTEGER) AS pos, source, id FROM ({_PUBLISHED})")
def source_split_ref(spark, d):
    rows = cite.with_reference(_spelled(spark, d), "spelled").withColumn("_p", cite.publisher_of(F.col("reference")))
    return rows.select("export_id", "pos", "_p.source", "_p.id")


_TAIL = r"(?:modified|modifié|modifiée|modifiés|MOD)\s*[–-]?\s+(.+)\z"


@query(f"""SELECT export_id, CAST(pos AS INTEGER) AS pos, CASE {' '.join(f"WHEN regexp_matches(original, '{p}') THEN '{w}'" for p, w in cite.RELATIONSHIPS)} ELSE 'identical' END AS status,
 CASE WHEN NOT regexp_matches(original, '(?m)^MOD [0-9\\-]') AND regexp_matches(original, '{_TAIL}') THEN {STRIP % f"regexp_extract(original, '{_TAIL}', 1)"} END AS modification FROM ({_PARTS})""")
def source_relationship(spark, d):
    rows = _parts(spark, d).withColumn("_r", cite.relationship_of(F.col("original")))
    return rows.select("export_id", "pos", "_r.status", "_r.modification")


@query()
def source_clause(spark, d):
    return ex.citation_rows(sheet(spark, d), ["_ord"]).select("_ord", "pos", "clause")


@query(f"""SELECT {_ANCHOR.format('reference')} AS id, reference, link, {_TYPE.format('src')} AS type FROM (
  SELECT trim(concat_ws(' ', source, id)) AS reference, NULL AS link, arg_min(source, {{'a': export_id, 'b': pos}}) AS src FROM ({_PUBLISHED}) WHERE trim(source) <> '' GROUP BY 1)""")
def bibliography_distinct(spark, d):
    rows = cite.with_reference(_spelled(spark, d), "spelled").withColumn("_p", cite.publisher_of(F.col("reference")))
    return bib.bibliography(rows.select(F.col("export_id").alias("_ord"), "pos", "_p.source", "_p.id"))


# ---- figures, references, markup --------------------------------------------------------

def _drawn(spark, d):
    """Sheet rows whose definitions show a figure of their section, captioned in their language."""
    rows = primary_rows(sheet(spark, d)).where("DEFINITION is not null")
    section = codes.section_code(F.col("IEVREF"))
    caption = F.when(F.length("TERM") % 3 == 0, "").when(F.length("TERM") % 3 == 1, F.concat(F.lit("Figure  2  – "), F.col("TERM"))).otherwise(F.lit("Figure 2"))
    macro = F.concat(F.lit("image::/assets/images/parts/"), codes.area_code(F.col("IEVREF")), F.lit("/"), section, F.lit("fig.GIF["), caption, F.lit("]"))
    return rows.where("TERM is not null").select("_ord", F.col("IEVREF").alias("code"), F.col("LANGUAGE").alias("language"), F.concat("DEFINITION", F.lit(" See "), macro, F.lit(".")).alias("definition"))


_DRAWN = f"""SELECT _ord, code, lang AS language, term, 'fig-' || {SECTION} || 'fig' AS figure_id, '/assets/images/parts/' || {AREA} || '/' || {SECTION} || 'fig.GIF' AS src, definition,
 CASE WHEN length(term) % 3 = 0 THEN NULL ELSE 'Figure 2' END AS identifier, CASE WHEN length(term) % 3 = 1 THEN trim(term) END AS caption FROM ({PRIMARY}) WHERE definition IS NOT NULL AND term IS NOT NULL"""


def _hits(spark, d):
    return fig.figure_hits(_drawn(spark, d), fields=("definition",))


@query(f"SELECT _ord, figure_id, identifier, caption, src, 'gif' AS format FROM ({_DRAWN}) WHERE length(language) = 3")
def figures_extract(spark, d):
    return _hits(spark, d).select("_ord", "figure_id", "identifier", "caption", "src", "format")


@query(f"SELECT _ord, definition || ' See {{{{fig:' || figure_id || CASE WHEN identifier IS NULL THEN '' ELSE ', ' || concat_ws(' - ', identifier, caption) END || '}}}}.' AS definition FROM ({_DRAWN})")
def figure_mentions(spark, d):
    return _drawn(spark, d).select("_ord", fig.with_mentions(F.col("definition")).alias("definition"))


@query(f"""WITH h AS (SELECT * FROM ({_DRAWN}) WHERE length(language) = 3), c AS (SELECT figure_id, string_agg(language || '=' || caption, ';' ORDER BY language) AS captions FROM (SELECT figure_id, language, arg_min(caption, _ord) AS caption FROM h WHERE caption IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
SELECT figure_id, arg_min_null(identifier, _ord) AS identifier, any_value(captions) AS captions, any_value(src) AS images FROM h LEFT JOIN c USING (figure_id) GROUP BY 1""")
def figures_merge(spark, d):
    shown = F.array_join(F.transform(F.map_entries("caption"), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return fig.figure_entities(_hits(spark, d)).select("figure_id", "identifier", shown.alias("captions"), F.array_join("images.src", ";").alias("images"))


@query(f"SELECT code, figure_id, arg_min_null(identifier, _ord) AS display FROM ({_DRAWN}) WHERE length(language) = 3 GROUP BY 1, 2")
def figure_refs(spark, d):
    return fig.figure_references(_hits(spark, d))


_LINKED = f"""SELECT _ord, code, lang, coalesce(term, 'NA') AS term, 'IEV ' || {SECTION} || '-01' AS target FROM ({PRIMARY})"""


def _linked(spark, d):
    """Sheet rows whose definitions link the first concept of their section by its bare code, and another by name."""
    rows = primary_rows(sheet(spark, d)).select("_ord", F.col("IEVREF").alias("code"), F.col("LANGUAGE").alias("language"), F.coalesce("TERM", F.lit("NA")).alias("term"))
    target = F.concat(codes.section_code(F.col("code")), F.lit("-01"))
    html = F.concat(F.lit("See <a href=IEV "), target, F.lit(">IEV "), target, F.lit("</a> and <a href=\"IEV101-01-01\"> named </a>"))
    return rows.withColumn("definition", adoc.markup_of(html, codes.area_code(F.col("code"))))


@query(f"SELECT _ord, 'See {{{{urn:iec:std:iec:60050-' || substr(target, 5) || ', ' || target || '}}}} and {{{{urn:iec:std:iec:60050-101-01-01, named}}}}' AS definition FROM ({_LINKED})")
def link_convert(spark, d):
    return _linked(spark, d).select("_ord", "definition")


@query(f"""SELECT code, lang AS language, substr(target, 5) AS ref_code, target AS shown FROM ({_LINKED}) UNION ALL SELECT code, lang, '101-01-01', 'named' FROM ({_LINKED})""")
def reference_enrich(spark, d):
    return ex.references(_linked(spark, d), "definition")


@query(f"""WITH e AS (SELECT code AS c, coalesce(term, 'NA') AS t FROM ({PRIMARY}) WHERE lang = 'eng') SELECT code, lang AS language, substr(target, 5) AS ref_code, coalesce(t, target) AS shown FROM ({_LINKED}) LEFT JOIN e ON c = substr(target, 5) UNION ALL SELECT code, lang, '101-01-01', 'named' FROM ({_LINKED})""")
def xref_lookup(spark, d):
    rows = _linked(spark, d)
    english = rows.where("language = 'eng'").select("code", F.col("term").alias("designation"))
    return lookup.name_bare_references(ex.references(rows, "definition"), english)


def _marked_up(rows, definition):
    html = F.concat(F.lit("<b>"), F.col("ievref"), F.lit("</b> <i>x</i><sub>1</sub><sup>2</sup><br><span><p>"), definition, F.lit("</span>"))
    return rows.select("export_id", adoc.markup_of(html, F.substring("ievref", 1, 3)).alias("markup"))


@query(r"""SELECT export_id, '*' || ievref || '* stem:[x]~1~^2^' || chr(10) || replace(definition, chr(0), '') || chr(10) AS markup FROM iev_export""")
def markup_convert(spark, d):
    """All definitions as escaped text within markup: their characters come back as they were."""
    escaped = F.replace(F.replace(F.replace("definition", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return _marked_up(table(spark, d, "iev_export"), escaped)


@query()
def markup_convert_all(spark, d):
    """All definitions with markup of their own, which SQL can't convert."""
    return _marked_up(table(spark, d, "iev_export").where("definition is not null"), F.col("definition"))


@query()
def content_convert(spark, d):
    """The whole chain over definitions as they are."""
    rows = table(spark, d, "iev_export").select("export_id", adoc.content_of(F.col("definition"), F.substring("ievref", 1, 3)).alias("content"))
    return rows


def _pages(spark, d):
    """A page per code with a row for each term of a language that pages know, followed by one for its definition if it has any."""
    three = {v: k for k, v in labels.PAGE_LANGUAGES.items()}
    two = F.coalesce(labels.lookup(three, F.col("LANGUAGE")), F.col("LANGUAGE"))
    rows = primary_rows(sheet(spark, d)).withColumn("_two", two).where(F.col("_two").isin(*labels.PAGE_LANGUAGES)).where("TERM is not null")
    two = F.col("_two")
    td = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    mark = td(F.concat(F.lit("<div align='center'><font color='#800080'>"), two, F.lit("</font></div>")))
    term = F.concat(F.lit("<tr>"), mark, F.lit("<td></td>"), td(F.concat(F.lit("<b>"), esc(F.col("TERM")), F.lit("</b>, f"))), F.lit("</tr>"))
    text_row = F.concat(F.lit("<tr><td></td><td></td>"), td(esc(F.col("DEFINITION"))), F.lit("</tr>"))
    line = F.struct(F.col("LANGUAGE").alias("l"), F.concat(term, F.coalesce(text_row, F.lit(""))).alias("h"))
    body = rows.groupBy(F.col("IEVREF").alias("code")).agg(F.array_join(F.array_sort(F.collect_list(line))["h"], "").alias("_b"))
    return body.select("code", F.concat(F.lit("<html><table><tr><td><b>"), "code", F.lit("</b></td></tr>"), "_b", F.lit("</table>")).alias("html"))


@query()
def page_rows(spark, d):
    each = _pages(spark, d).select("code", F.explode(pages.page_entries(F.col("html"), F.col("code"))).alias("e"))
    return each.select("code", "e.language", F.array_join("e.terms", "|").alias("terms"), "e.definition")


def _listing(spark, d):
    """One page that links every area and lists every section, as the hierarchy is published."""
    cell = F.concat(F.lit("<tr><td>Section "), "section_code", F.lit(": "), F.col("section_title"), F.lit("</td><td><a href='x?part="), "area_code", F.lit("'>"), F.col("area_title"), F.lit("</a></td></tr>"))
    rows = table(spark, d, "sections").where("section_title is not null and area_title is not null")
    register(spark)
    listing = rows.agg(F.array_join(F.array_sort(F.collect_list(cell)), "").alias("html"))
    listing.createOrReplaceTempView("gw_listing")


@query("SELECT area_code AS code, arg_min(area_title, section_code) AS title FROM sections WHERE section_title IS NOT NULL AND area_title IS NOT NULL GROUP BY 1")
def link_extract(spark, d):
    _listing(spark, d)
    return spark.sql("SELECT code, title FROM gw_listing, LATERAL gw_area_links(html)")


@query("SELECT section_code AS code, section_title AS title FROM sections WHERE section_title IS NOT NULL AND area_title IS NOT NULL")
def section_extract(spark, d):
    _listing(spark, d)
    return spark.sql("SELECT code, title FROM gw_listing, LATERAL gw_section_cells(html)")


# ---- reconciliation ---------------------------------------------------------------------

def sides(spark, d):
    tb = table(spark, d, "termbase")
    last = tb.agg(F.max("snapshot_no")).first()[0]
    rows = tb.where(F.col("snapshot_no") == F.lit(last)).withColumn("_loaded", F.unix_micros("loaded_at"))
    # the row that was loaded last is the record; equal times are decided by content
    slim = rows.select("code", "language_code", "_loaded", "term", "definition", "entry_status")
    latest = first_of(slim, ["code", "language_code"], [F.col(c).desc_nulls_last() for c in ("_loaded", "term", "definition", "entry_status")])
    old = rec.side(latest, order="_loaded")
    new = rec.side(table(spark, d, "localized_concepts"), order="l10n_id", notes="notes", examples="examples")
    return old, new


def reconciled(spark, d):
    return rec.reconcile(*sides(spark, d), DETECTED)


def _form(col: str) -> str:
    return _COMPARABLE.replace("coalesce(definition, '')", f"coalesce({col}, '')")


_STATUS = _case(labels.TERMBASE_STATUS, "trim(entry_status)", "'valid'")
_SIDES = f"""old AS (SELECT code, language_code AS language, epoch_us(loaded_at) AS o, {_STATUS} AS status, term AS designation, nullif(definition, '') AS definition, '' AS notes, '' AS examples FROM termbase
   WHERE snapshot_no = (SELECT max(snapshot_no) FROM termbase) AND code IS NOT NULL AND language_code IS NOT NULL QUALIFY row_number() OVER (PARTITION BY code, language_code ORDER BY loaded_at DESC NULLS LAST, term DESC NULLS LAST, definition DESC NULLS LAST, entry_status DESC NULLS LAST) = 1),
 new AS (SELECT code, language_code AS language, l10n_id AS o, {_STATUS} AS status, term AS designation, nullif(definition, '') AS definition, array_to_string(coalesce(notes, []), ' | ') AS notes, array_to_string(coalesce(examples, []), ' | ') AS examples FROM localized_concepts
   WHERE code IS NOT NULL AND language_code IS NOT NULL QUALIFY row_number() OVER (PARTITION BY code, language_code ORDER BY l10n_id) = 1),
 oc AS (SELECT code, arg_min(status, {{'a': o, 'b': language}}) AS status FROM old GROUP BY 1), nc AS (SELECT code, arg_min(status, {{'a': o, 'b': language}}) AS status FROM new GROUP BY 1),
 origins AS (SELECT code, CASE WHEN oc.code IS NULL THEN 'live_only' WHEN nc.code IS NULL THEN 'termbase_only' ELSE 'both' END AS origin, oc.status AS old_status, nc.status AS new_status FROM oc FULL JOIN nc USING (code)),
 pairs AS (SELECT code, language, a.designation AS d0, b.designation AS d1, a.definition AS f0, b.definition AS f1, a.notes AS n0, b.notes AS n1, a.examples AS e0, b.examples AS e1 FROM old a JOIN new b USING (code, language)),
 changes AS (
   SELECT code, 'status' AS field, NULL AS language, old_status AS old_value, new_status AS new_value FROM origins WHERE origin = 'both' AND old_status IS DISTINCT FROM new_status
   UNION ALL SELECT code, 'status', NULL, 'retired', 'retired' FROM origins WHERE origin = 'termbase_only'
   UNION ALL SELECT code, 'language_added', language, NULL, 'present' FROM new JOIN origins USING (code) WHERE origin = 'both' AND NOT EXISTS (FROM old WHERE old.code = new.code AND old.language = new.language)
   UNION ALL SELECT code, 'designation', language, d0, d1 FROM pairs WHERE {_form('d0')} <> {_form('d1')}
   UNION ALL SELECT code, 'definition', language, f0, f1 FROM pairs WHERE {_form('f0')} <> {_form('f1')}
   UNION ALL SELECT code, 'notes', language, n0, n1 FROM pairs WHERE n0 <> n1
   UNION ALL SELECT code, 'examples', language, e0, e1 FROM pairs WHERE e0 <> e1),
 listed AS (SELECT code, regexp_extract(code, '(?s)^(.*)-[^-]*$', 1) AS section, field, language, '{DETECTED}' AS detected_at, old_value, new_value FROM changes)"""


def _with_sides(body: str) -> str:
    return f"WITH {_SIDES} {body}"


def changes(spark, d):
    return rec.change_rows(reconciled(spark, d), DETECTED)


@query(_with_sides("SELECT code, origin FROM origins"))
def reconcile_full_outer(spark, d):
    return reconciled(spark, d).select("code", "origin")


@query(_with_sides("SELECT code, language FROM changes WHERE field = 'language_added'"))
def language_added(spark, d):
    return rec.by_field(changes(spark, d), "language_added").select("code", "language")


@query(_with_sides("SELECT code, language FROM pairs"))
def language_common(spark, d):
    old, new = sides(spark, d)
    return new.select("code", "language").join(old.select("code", "language"), ["code", "language"], "left_semi")


@query(_with_sides("SELECT code, field, language, old_value, new_value FROM changes"))
def diff_fields(spark, d):
    return changes(spark, d).select("code", "field", "language", "old_value", "new_value")


@query(_with_sides("""SELECT coalesce(a.code, b.code) AS code, coalesce(a.language, b.language) AS language, CASE WHEN b.designation IS NOT NULL THEN b.designation ELSE a.designation END AS designation, coalesce(b.definition, a.definition) AS definition,
 CASE WHEN coalesce(b.notes, '') <> '' THEN b.notes ELSE coalesce(a.notes, '') END AS notes FROM old a FULL JOIN new b ON a.code = b.code AND a.language = b.language"""))
def merge_overwrite_nonempty(spark, d):
    each = reconciled(spark, d).select("code", F.explode("localized").alias("l"))
    return each.select("code", "l.language", F.get("l.designations", F.lit(0)).alias("designation"), "l.definition", F.array_join("l.notes", " | ").alias("notes"))


@query(_with_sides(f"""SELECT code, CASE origin WHEN 'termbase_only' THEN 'retired' WHEN 'both' THEN old_status ELSE new_status END AS status,
  CASE WHEN origin = 'termbase_only' THEN 'retired={DETECTED}' WHEN origin = 'both' AND EXISTS (FROM changes c WHERE c.code = origins.code) THEN 'amended={DETECTED}' ELSE '' END AS dates FROM origins"""))
def retire_unmatched(spark, d):
    shown = F.array_join(F.transform("dates", lambda x: F.concat_ws("=", x["type"], x["date"])), ",")
    return reconciled(spark, d).select("code", "status", shown.alias("dates"))


@query(_with_sides("""SELECT code, language FROM (SELECT code, language FROM old UNION SELECT code, language FROM new) WHERE language NOT IN ('eng', 'fra')
  AND code IN (SELECT code FROM changes WHERE language IN ('eng', 'fra') AND field IN ('definition', 'notes'))"""))
def stale_translations(spark, d):
    each = reconciled(spark, d).select("code", F.explode("localized").alias("l"))
    return each.where(F.exists("l.examples", lambda x: x.startswith("[Reconciler]"))).select("code", "l.language")


@query(_with_sides("""SELECT count(*) AS total, count(*) FILTER (origin = 'both') AS in_both, count(*) FILTER (origin = 'termbase_only') AS termbase_only, count(*) FILTER (origin = 'live_only') AS live_only,
  (SELECT count(DISTINCT code) FROM changes) AS changed FROM origins"""))
def reconcile_stats(spark, d):
    return rec.stats(reconciled(spark, d))


@query(_with_sides("SELECT field, count(*) AS n_changes FROM listed GROUP BY 1"))
def tally_field(spark, d):
    return rec.tally(changes(spark, d), "field")


@query(_with_sides("SELECT language, count(*) AS n_changes FROM listed GROUP BY 1"))
def tally_language(spark, d):
    return rec.tally(changes(spark, d), "language")


@query(_with_sides("SELECT section, count(*) AS n_changes FROM listed GROUP BY 1"))
def tally_section(spark, d):
    return rec.tally(changes(spark, d), "section")


@query(_with_sides("""SELECT CASE g WHEN 3 THEN 'field' WHEN 5 THEN 'language' WHEN 6 THEN 'section' ELSE 'total' END AS tally, CASE g WHEN 3 THEN field WHEN 5 THEN language WHEN 6 THEN section END AS value, n AS n_changes
 FROM (SELECT grouping(field, language, section) AS g, field, language, section, count(*) AS n FROM listed GROUP BY GROUPING SETS ((), (field), (language), (section)))"""))
def summary_grouping_sets(spark, d):
    return rec.summary(changes(spark, d))


@query(_with_sides("""SELECT code, section, field, language, detected_at, CASE WHEN length(old_value) > 200 THEN substr(old_value, 1, 200) || '...' ELSE coalesce(old_value, '') END AS old_value,
  CASE WHEN length(new_value) > 200 THEN substr(new_value, 1, 200) || '...' ELSE coalesce(new_value, '') END AS new_value FROM listed"""))
def change_csv_projection(spark, d):
    return rec.change_csv(changes(spark, d))


@query(_with_sides("SELECT code FROM origins WHERE origin = 'live_only'"))
def new_concepts(spark, d):
    return rec.codes_of_origin(reconciled(spark, d), "live_only")


# ---- errors and the whole export --------------------------------------------------------

# every seventh concept's language is misspelled: three letters that are none, two that are none, and none at all
_MISSPELLED = "CASE length(code) + CAST(right(code, 1) AS INTEGER) WHEN 10 THEN 'qqq' WHEN 13 THEN 'xy' WHEN 16 THEN 'whatever' ELSE lang END"
_ERROR = f"CASE WHEN {_MISSPELLED} <> lang THEN 'unknown language' WHEN status IS NULL THEN 'no status' END"
_SPELLED_ROWS = f"(SELECT * FROM ({SHEET}) QUALIFY row_number() OVER (PARTITION BY code, {_MISSPELLED} ORDER BY _ord) = 1)"


def _misspelled_export(spark, d):
    rows = sheet(spark, d)
    lang = F.expr(_MISSPELLED.replace("code", "IEVREF").replace("ELSE lang", "ELSE LANGUAGE"))
    return ex.export(rows.withColumn("LANGUAGE", lang), table(spark, d, "sections"), labels.language_dimension(spark))


@query(f"SELECT _ord, code, {_ERROR} AS error FROM {_SPELLED_ROWS} WHERE {_ERROR} IS NOT NULL")
def quarantine_split(spark, d):
    return _misspelled_export(spark, d).quarantine.select("_ord", "code", "error")


@query(f"SELECT code, error FROM (SELECT code, min({_ERROR}) AS error FROM {_SPELLED_ROWS} WHERE {_ERROR} IS NOT NULL GROUP BY 1) ORDER BY code LIMIT 10")
def top_errors(spark, d):
    out = _misspelled_export(spark, d)
    return out.quarantine.groupBy("code").agg(F.min("error").alias("error")).orderBy("code").limit(10)


@query()
def export_localized(spark, d):
    out = ex.export(sheet(spark, d), table(spark, d, "sections"), labels.language_dimension(spark))
    shown = F.array_join(F.transform("terms", lambda t: F.concat_ws("/", t["type"], t["designation"], t["normative_status"])), "|")
    return out.localized.select("_ord", "code", "language", "entry_status", "classification", "domain", shown.alias("terms"), "definition", "review_date", "sources")


_NAMED = f"""SELECT p.*, CASE WHEN length(lang) = 3 THEN lang ELSE coalesce({_LANGS}, lang) END AS language FROM (SELECT *, CASE WHEN length(lang) > 2 THEN split_part(lang, ' ', 1) ELSE lang END AS k FROM ({PRIMARY}) WHERE status IS NOT NULL) p"""


@query(f"""WITH n AS (SELECT * FROM ({_NAMED}) QUALIFY row_number() OVER (PARTITION BY code, language ORDER BY _ord) = 1)
SELECT code, arg_min(CASE lower(status) WHEN 'standard' THEN 'valid' END, _ord) FILTER (lower(status) = 'standard') AS status, string_agg(language, ',' ORDER BY _ord) AS languages, 2 AS n_domains,
 CAST(1 + count(DISTINCT CASE WHEN regexp_matches(trim(replaces), '{_SUPERSEDED}') THEN regexp_extract(trim(replaces), '{_SUPERSEDED}', 2) END) AS INTEGER) AS n_related FROM n GROUP BY 1""")
def export_concepts(spark, d):
    out = ex.export(sheet(spark, d), table(spark, d, "sections"), labels.language_dimension(spark))
    return out.concepts.select("code", "status", F.array_join("languages", ",").alias("languages"), F.size("domains").alias("n_domains"), F.size("related").alias("n_related"))


def _export(spark, d):
    return ex.export(sheet(spark, d), table(spark, d, "sections"), labels.language_dimension(spark))


@query(f"""SELECT code, any_value(concat_ws('|', area_title, section_title)) AS tags FROM (SELECT * FROM ({PRIMARY}) WHERE status IS NOT NULL) s
 LEFT JOIN (SELECT section_code AS sc, section_title FROM sections) x ON x.sc = {SECTION} LEFT JOIN ({DIM_AREA}) a ON a.area_code = {AREA} GROUP BY 1""")
def export_tags(spark, d):
    return _export(spark, d).concepts.select("code", F.array_join("tags", "|").alias("tags"))


@query(f"""WITH g AS (SELECT DISTINCT code FROM ({PRIMARY}) WHERE status IS NOT NULL),
 c AS (SELECT 'section-' || {SECTION} AS id, string_agg('narrower:' || code, ',' ORDER BY code) AS below FROM g GROUP BY 1)
SELECT 'section-' || section_code AS concept_id, concat_ws(',', 'broader:area-' || area_code, below) AS related FROM ({_SECTIONS_OF}) JOIN ({DIM_AREA}) USING (area_code) LEFT JOIN c ON id = 'section-' || section_code""")
def export_section_narrower(spark, d):
    rows = _export(spark, d).hierarchy.where("kind = 'section'")
    return rows.select("concept_id", F.array_join(F.transform("related", lambda r: F.concat_ws(":", r["type"], r["ref"]["id"])), ",").alias("related"))


@query(f"""SELECT (SELECT count(*) FROM ({DIM_AREA})) + (SELECT count(*) FROM ({_SECTIONS_OF}) JOIN ({DIM_AREA}) USING (area_code)) + (SELECT count(DISTINCT code) FROM ({PRIMARY}) WHERE status IS NOT NULL) AS concept_count,
 (SELECT count(*) FROM ({DIM_AREA})) + (SELECT count(*) FROM ({_SECTIONS_OF}) JOIN ({DIM_AREA}) USING (area_code)) + (SELECT count(DISTINCT (code, language)) FROM ({_NAMED})) AS localized_count, CAST(0 AS BIGINT) AS figure_count""")
def export_stats(spark, d):
    return _export(spark, d).stats


# the same rules on cells whose entities and blanks are cleaned first
_CLEAN_SOURCE = STRIP % "translate(nfc_normalize(replace(source, '&amp;', '&')), chr(8209) || chr(160) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(65279), '-' || '        ')"


@query(f"""WITH n AS (SELECT * FROM ({_NAMED})) SELECT export_id AS _ord, code, language, CAST(pos AS INTEGER) AS pos, source, id FROM ({_PUBLISHED.replace("FROM iev_export", f"FROM (SELECT export_id, {_CLEAN_SOURCE} AS source FROM iev_export)")}) JOIN (SELECT export_id, code, language FROM n) USING (export_id)""")
def export_sources(spark, d):
    out = _export(spark, d)
    return ex.source_rows(out.localized).join(out.localized.select("_ord", "code", "language"), "_ord").select("_ord", "code", "language", "pos", "source", "id")


# ---- the termbase's side ----------------------------------------------------------------

def _termbase_rows(spark, d):
    """Localized concepts with their terms as a stored termbase has them; every second designation has a marker."""
    marked = F.when(F.col("term_no") % 2 == 0, F.concat("designation", F.lit(", f"))).otherwise(F.col("designation"))
    term = F.struct(F.col("term_no"), F.struct(F.col("term_type").alias("type"), marked.alias("designation"), "normative_status", "gender", "plurality", "usage_info").alias("t"))
    terms = table(spark, d, "terms").groupBy("l10n_id").agg(F.array_sort(F.collect_list(term))["t"].alias("terms"))
    rows = table(spark, d, "localized_concepts").join(terms, "l10n_id", "left")
    return rows.withColumns({"_ord": F.col("l10n_id"), "language": F.col("language_code"), "lang_no": F.col("l10n_id")})


@query("""SELECT code, language_code AS language, l10n_id AS _ord, CAST(row_number() OVER (PARTITION BY l10n_id ORDER BY term_no) - 1 AS INTEGER) AS term_no, replace(trim(regexp_replace(designation, '\\s+', ' ', 'g')), chr(12288), ' ') AS designation,
 concat_ws(',', gender, CASE WHEN term_no % 2 = 0 AND designation IS NOT NULL AND gender IS DISTINCT FROM 'feminine' THEN 'feminine' END) AS gender, coalesce(plurality, '') AS number
 FROM terms JOIN (SELECT l10n_id FROM localized_concepts) USING (l10n_id)""")
def termbase_terms(spark, d):
    rows = snapshots.merged_terms(_termbase_rows(spark, d))
    return rows.select("code", "language", "_ord", "term_no", "designation", F.array_join("gender", ",").alias("gender"), F.array_join("number", ",").alias("number"))


@query(f"""SELECT code, {_case(labels.TERMBASE_STATUS, "f.s", "'valid'")} AS status, concat_ws(',', 'accepted=' || f.a, CASE WHEN f.m IS DISTINCT FROM f.a THEN 'amended=' || f.m END) AS dates
 FROM (SELECT code, arg_min({{'s': entry_status, 'a': date_accepted, 'm': date_amended}}, l10n_id) AS f FROM localized_concepts GROUP BY 1)""")
def termbase_dates(spark, d):
    shown = F.array_join(F.transform("dates", lambda x: F.concat_ws("=", x["type"], x["date"])), ",")
    return snapshots.concept_dates(_termbase_rows(spark, d)).select("code", "status", shown.alias("dates"))


@query("SELECT l10n_id, CASE WHEN l10n_id % 5 = 0 THEN 'no code' ELSE 'no language' END AS error FROM localized_concepts WHERE l10n_id % 5 = 0 OR l10n_id % 7 = 0")
def reconcile_errors(spark, d):
    """Rows that lost their code or language are set aside, each with what it lacks."""
    holed = {"code": F.when(F.col("l10n_id") % 5 != 0, F.col("code")), "language_code": F.when(F.col("l10n_id") % 7 != 0, F.col("language_code"))}
    return rec.rejected(table(spark, d, "localized_concepts").withColumns(holed)).select("l10n_id", "error")


_FLAG_TITLES = f"({PRIMARY}) s LEFT JOIN (SELECT section_code AS sc, section_title FROM sections) x ON x.sc = {SECTION} LEFT JOIN ({DIM_AREA}) a ON a.area_code = {AREA}"


@query(f"""SELECT code, any_value(area_title) AS area_title, any_value(section_title) AS section_title, count(*) AS n_languages, string_agg(lang, ',' ORDER BY lang) AS languages, arg_min(length(coalesce(term, '')), _ord) AS first_term_length
 FROM {_FLAG_TITLES} WHERE code ILIKE '9%' AND lang IN ('eng', 'fra', 'deu', 'spa') GROUP BY 1""")
def flagship(spark, d):
    """Source to concepts in one go: filter, first row wins, dimension joins, nest."""
    rows = primary_rows(filtered(sheet(spark, d), "9%", "eng,fra,deu,spa")).select("_ord", F.col("IEVREF").alias("code"), F.col("LANGUAGE").alias("lang"), F.col("TERM").alias("term"))
    nested = rows.groupBy("code").agg(
        F.count(F.lit(1)).alias("n_languages"), F.array_join(F.sort_array(F.collect_list("lang")), ",").alias("languages"), F.min_by(F.length(F.coalesce("term", F.lit(""))), "_ord").cast("long").alias("first_term_length")
    )
    titled = hier.with_titles(nested, "code", table(spark, d, "sections"))
    return titled.select("code", "area_title", "section_title", "n_languages", "languages", "first_term_length").orderBy("code")


__all__ = ["ORACLE", "QUERIES", "first_wins", "flagship"]
