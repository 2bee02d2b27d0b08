"""Sheet rows to nested concepts.

Rows become localized concepts by one projection (native expressions, plus one Arrow call
per consuming parser), localized concepts become concepts by one aggregation on the code.
The nested map is bounded by the number of languages because rows are unique per (code,
language) before they are collected.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.functions import citation_rules as cite
from glossweave.functions.codes import area_code, complete_date, domain_references, section_code, section_uri
from glossweave.functions.labels import classification, designation_status, sheet_status, three_letter
from glossweave.functions.text import decode_entities, sanitize, split_synonyms, without_leading_number
from glossweave.markup.adoc import content_of, contents_of, formulas_of, markup_of, mentions, with_names
from glossweave.operators.bibliography import bibliography
from glossweave.operators.figures import figure_entities, figure_hits, figure_references, first_of, row_figures, with_mentions
from glossweave.operators.hierarchy import domain_title, hierarchy_concepts, section_tree, with_titles
from glossweave.operators.sheet import COLUMNS, filtered, first_wins
from glossweave.parsers.attributes import attributes, grammar
from glossweave.parsers.clauses import clause_of
from glossweave.parsers.definition import definition_parts
from glossweave.parsers.supersession import superseded

MISSING = "....."


def clean(sheet: DataFrame, *kept: str) -> DataFrame:
    """Every cell sanitized; the missing-term mark as NA; columns ``kept`` as they are."""
    cells = {c: sanitize(F.col(c)) for c in COLUMNS}
    cells["TERM"] = F.when(cells["TERM"] == MISSING, F.lit("NA")).otherwise(cells["TERM"])
    return sheet.select("_ord", *kept, *[v.alias(c) for c, v in cells.items()])


def citation_rows(sheet: DataFrame, keys: list[str]) -> DataFrame:
    """One row per citation of SOURCE: ``keys, pos, original, status, modification, source, id, clause``."""
    rows = sheet.where("SOURCE is not null").withColumn("_parts", cite.split_field(sanitize(decode_entities(F.col("SOURCE")))))
    each = rows.select(*keys, F.posexplode("_parts").alias("pos", "original"))
    # each step is a column of its own: the next step's rules read it dozens of times
    named = cite.with_reference(each.withColumn("_spelled", cite.one_spelling(F.col("original"))), "_spelled", "_ref")
    known = named.withColumns({"_publisher": cite.publisher_of(F.col("_ref")), "_relation": cite.relationship_of(F.col("original"))})
    return known.select(
        *keys, "pos", "original", F.col("_relation.status").alias("status"), F.col("_relation.modification").alias("modification"),
        F.col("_publisher.source").alias("source"), F.col("_publisher.id").alias("id"), clause_of(F.col("_spelled")).alias("clause"),
    )


def cell_sources(rows: DataFrame) -> DataFrame:
    """``_area, _cell, sources``: the citations of each distinct cell in order, as authoritative sources.

    A cell that many rows repeat is parsed once.  A cell without citations has no row.
    """
    cells = rows.where("_cell is not null").select("_area", "_cell").distinct()
    each = citation_rows(cells.withColumn("SOURCE", F.col("_cell")), ["_area", "_cell"]).withColumn("original", formulas_of(markup_of(F.col("original"), F.col("_area"))))
    locality = F.when(F.col("clause").isNotNull(), F.struct(F.lit("clause").alias("type"), F.col("clause").alias("reference_from")))
    origin = F.struct(F.struct("source", "id").alias("ref"), locality.alias("locality"), "original")
    source = F.struct(F.lit("authoritative").alias("type"), "status", origin.alias("origin"), "modification")
    listed = F.array_sort(F.collect_list(F.struct("pos", source.alias("source"))))
    return each.groupBy("_area", "_cell").agg(F.transform(listed, lambda x: x["source"]).alias("sources"))


def expression_designation(text: Column, attrs: Column, status: Column) -> Column:
    """A designation in words, with what its attribute cell says."""
    return F.struct(
        F.lit("expression").alias("type"),
        text.alias("designation"),
        designation_status(status).alias("normative_status"),
        attrs["geographical_area"].alias("geographical_area"),
        attrs["prefix"].alias("prefix"),
        attrs["usage_info"].alias("usage_info"),
        F.lit(None).cast("boolean").alias("international"),
        grammar(attrs).alias("grammar_info"),
    )


def symbol_designation(text: Column) -> Column:
    """An international symbol."""
    none = F.lit(None).cast("string")
    no_grammar = F.lit(None).cast("array<struct<gender:array<string>,number:array<string>,part_of_speech:string>>")
    return F.struct(
        F.lit("symbol").alias("type"), text.alias("designation"), none.alias("normative_status"), none.alias("geographical_area"), none.alias("prefix"),
        none.alias("usage_info"), F.lit(True).alias("international"), no_grammar.alias("grammar_info"),
    )


#: The cells whose markup can link a concept.
LINKING = ["TERM", "SYNONYM1", "SYNONYM2", "SYNONYM3", "SYMBOLE", "DEFINITION", "SOURCE"]


def link_names(sheet: DataFrame, every: DataFrame, languages: DataFrame) -> DataFrame:
    """``IEVREF, LANGUAGE, _names``: of rows that link concepts, the English terms of those in ``every`` by code."""
    text = F.concat_ws(" ", *LINKING)
    codes = F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit("[0-9]{2,3}-[0-9]{2,3}-[0-9]{2,3}"), F.lit(0))))
    links = sheet.where(F.lower(text).contains("href")).select("IEVREF", "LANGUAGE", codes.alias("_code")).distinct()
    terms = three_letter(clean(every), "LANGUAGE", languages, "_language").where("_language = 'eng' and TERM is not null")
    english = first_wins(terms.select("_ord", F.col("IEVREF").alias("_code"), "TERM"), ["_code"])
    found = links.join(english, "_code").withColumn("_name", content_of(F.col("TERM"), F.substring("_code", 1, 3)))
    return found.groupBy("IEVREF", "LANGUAGE").agg(F.map_from_entries(F.collect_list(F.struct("_code", "_name"))).alias("_names"))


def localized(sheet: DataFrame, sections: DataFrame, languages: DataFrame, names: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """One localized concept per sheet row; links without a name of their own get theirs from ``names`` (of ``link_names``).

    ``error`` names what a strict export would stop at (unknown language, missing status, an
    impossible date) and is null otherwise; such rows are kept for the caller to quarantine.
    Their language is the cell as it is if it is unknown.  ``strict`` takes two-letter languages only.
    """
    none = F.lit(None).cast("map<string,string>")
    # on the sheet's own cells: it is already spread by them
    known_names = sheet.withColumn("_names", none) if names is None else sheet.join(names, ["IEVREF", "LANGUAGE"], "left")
    rows = three_letter(clean(known_names, "_names"), "LANGUAGE", languages, "_known", strict, keep=False).withColumn("language", F.coalesce("_known", "LANGUAGE"))
    rows = domain_title(with_titles(rows, "IEVREF", sections)).withColumn("_area", F.coalesce(F.substring("IEVREF", 1, 3), F.lit(""))).withColumn("_cell", F.col("SOURCE"))
    rows = rows.join(cell_sources(rows), ["_area", "_cell"], "left")
    rows = rows.withColumns(
        {
            "_parts": definition_parts(F.col("DEFINITION")),
            "_attrs": attributes(F.col("TERMATTRIBUTE")),
            **{f"_attrs{i}": attributes(F.col(f"SYNONYM{i}ATTRIBUTE")) for i in (1, 2, 3)},
            "_date": complete_date(F.col("PUBLICATIONDATE")),
        }
    )
    cleaned = lambda xs: F.transform(xs, without_leading_number)
    rows = rows.withColumns(
        {
            "_term": content_of(F.col("TERM"), F.col("_area")),
            **{f"_syn{i}": contents_of(split_synonyms(F.col(f"SYNONYM{i}")), F.col("_area")) for i in (1, 2, 3)},
            "_symbol": content_of(F.col("SYMBOLE"), F.col("_area")),
            "_definition": content_of(F.col("_parts.definition"), F.col("_area")),
            "_examples": contents_of(cleaned(F.col("_parts.examples")), F.col("_area")),
            "_notes": contents_of(cleaned(F.col("_parts.notes")), F.col("_area")),
        }
    )

    named = lambda text: with_names(text, F.col("_names"))
    sources = F.transform("sources", lambda x: x.withField("origin", x["origin"].withField("original", named(x["origin"]["original"]))))
    rows = rows.withColumns(
        {
            **{c: named(F.col(c)) for c in ("_term", "_symbol", "_definition")},
            **{c: F.transform(c, named) for c in ("_syn1", "_syn2", "_syn3", "_examples", "_notes")},
            "sources": F.when(F.col("_names").isNull(), F.col("sources")).otherwise(sources),
        }
    )

    def synonym(i: int) -> Column:
        return F.transform(F.col(f"_syn{i}"), lambda t: expression_designation(t, F.col(f"_attrs{i}"), F.lower(F.col(f"SYNONYM{i}STATUS"))))

    synonyms = [synonym(i) for i in (1, 2, 3)]
    symbol = F.when(F.col("SYMBOLE").isNotNull(), F.array(symbol_designation(F.col("_symbol")))).otherwise(F.slice(F.array(symbol_designation(F.col("_symbol"))), 1, 0))
    terms = F.concat(F.array(expression_designation(F.col("_term"), F.col("_attrs"), F.lit("preferred"))), *synonyms, symbol)
    dated = lambda kind: F.struct(F.lit(kind).alias("type"), F.col("_date").alias("date"))
    error = F.when(F.col("_known").isNull(), F.lit("unknown language")).when(F.col("STATUS").isNull(), "no status").when(F.col("PUBLICATIONDATE").isNotNull() & F.col("_date").isNull(), "impossible date")
    return rows.select(
        "_ord",
        F.col("IEVREF").alias("code"),
        "language",
        sheet_status(F.col("STATUS")).alias("entry_status"),
        classification(F.col("SYNONYM1STATUS")).alias("classification"),
        "domain",
        terms.alias("terms"),
        F.col("_definition").alias("definition"),
        F.col("_notes").alias("notes"),
        F.col("_examples").alias("examples"),
        F.when(F.col("_date").isNotNull(), F.array(dated("accepted"), dated("amended"))).alias("dates"),
        F.col("_date").alias("review_date"),
        F.col("_date").alias("review_decision_date"),
        F.lit("published").alias("review_decision_event"),
        F.col("SOURCE").alias("source_cell"),
        "sources",
        superseded(F.col("REPLACES")).alias("related"),
        error.alias("error"),
    )


def concepts(rows: DataFrame) -> DataFrame:
    """One row per code: languages in order of first appearance, status, relations, domain references.

    The first row of a (code, language) wins; the first non-empty entry status is the
    concept's; relations of all rows are the concept's, unique by (type, id) in order of
    appearance, with the broader section behind them.  References and figures of all rows,
    where the rows have them, are the concept's too, each once with its first words.
    """
    unique = first_wins(rows.withColumn("_first", F.col("_ord")), ["code", "language"], "_ord") if "_first" not in rows.columns else rows
    linked = [c for c in ("references", "figures") if c in unique.columns]
    entry = F.struct("_ord", "language", *linked, F.struct(*[c for c in unique.columns if c not in ("_ord", "_first", "code", "language", "related", *linked)]).alias("value"))
    status = F.min_by("entry_status", F.when(F.length("entry_status") > 0, F.col("_ord")))
    relation = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_ord", F.coalesce("related", F.expr("array()").cast("array<struct<type:string,source:string,id:string>>")).alias("r")))), lambda x: x["r"]))
    nested = unique.groupBy("code").agg(F.array_sort(F.collect_list(entry)).alias("_entries"), status.alias("status"), relation.alias("_related"), F.min("_ord").alias("_ord"))
    broader = F.when(section_code(F.col("code")).isNotNull(), F.array(F.struct(F.lit("broader").alias("type"), F.lit("IEV").alias("source"), section_uri(section_code(F.col("code"))).alias("id"))))
    return nested.select(
        "_ord",
        "code",
        "status",
        domain_references(F.col("code")).alias("domains"),
        F.concat(F.array_distinct("_related"), F.coalesce(broader, F.slice("_related", 1, 0))).alias("related"),
        *[first_of(F.flatten(F.transform("_entries", lambda e: e[c])), k).alias(c) for c, k in (("references", "code"), ("figures", "entity_id")) if c in linked],
        F.transform("_entries", lambda e: e["language"]).alias("languages"),
        F.map_from_entries(F.transform("_entries", lambda e: F.struct(e["language"], e["value"]))).alias("localized"),
    )


def with_tags(nested: DataFrame, sections: DataFrame) -> DataFrame:
    """Concepts with ``tags``: the titles of their area and section, as far as there are any."""
    tags = F.array_compact(F.array("area_title", "section_title"))
    return with_titles(nested, "code", sections).withColumn("tags", tags).drop("area_title", "section_title")


def section_children(rows: DataFrame) -> DataFrame:
    """``section_code, code``: the codes of each section, each once.

    Rows, not lists: a section of any size is as many rows.  ``with_narrower`` makes the list
    that a section's document holds.
    """
    return rows.select(section_code(F.col("code")).alias("section_code"), "code").where("section_code is not null").distinct()


def with_narrower(tree: DataFrame, children: DataFrame) -> DataFrame:
    """Hierarchy concepts with the codes of ``section_children`` as narrower ones of their section, in string order."""
    below = children.groupBy(section_uri(F.col("section_code")).alias("_id")).agg(F.sort_array(F.collect_list("code")).alias("_codes"))
    narrower = F.transform("_codes", lambda c: F.struct(F.lit("narrower").alias("type"), F.struct(F.lit("IEV").alias("source"), c.alias("id")).alias("ref")))
    joined = tree.join(below, F.col("concept_id") == F.col("_id"), "left")
    return joined.withColumn("related", F.when(F.col("_codes").isNull(), F.col("related")).otherwise(F.concat("related", narrower))).drop("_id", "_codes")


def source_rows(rows: DataFrame) -> DataFrame:
    """``_ord, pos, source, id``: the works that localized concepts cite."""
    each = rows.select("_ord", F.posexplode("sources").alias("pos", "_s"))
    return each.select("_ord", "pos", F.col("_s.origin.ref.source").alias("source"), F.col("_s.origin.ref.id").alias("id"))


def references(rows: DataFrame, text: str) -> DataFrame:
    """``code, language, ref_code, shown``: concepts mentioned in converted texts, each once per row, the first mention's words kept."""
    hits = rows.select("code", "language", F.posexplode(mentions(F.col(text))).alias("_pos", "_m")).select("code", "language", "_pos", F.col("_m.code").alias("ref_code"), F.col("_m.shown").alias("shown"))
    return hits.groupBy("code", "language", "ref_code").agg(F.min_by("shown", "_pos").alias("shown"))


def with_references(rows: DataFrame) -> DataFrame:
    """Localized concepts with ``references`` and ``figures`` of their texts, and mentions in place of figures in these."""
    texts = [F.when(F.col("definition").isNotNull(), F.array("definition")), F.col("examples"), F.col("notes")]
    every = F.concat(*[F.coalesce(t, F.array().cast("array<string>")) for t in texts])
    shown = lambda t: F.when(t.contains("image::"), with_mentions(t)).otherwise(t)
    # two steps: in one, Spark takes the new definition for the old one inside the functions of arrays
    found = rows.withColumns({"references": first_of(F.flatten(F.transform(every, mentions)), "code"), "figures": row_figures(*texts)})
    return found.withColumns({"definition": shown(F.col("definition")), "examples": F.transform("examples", shown), "notes": F.transform("notes", shown)})


class Exported:
    """What an export makes; each table is planned when first asked for, and computed when written or read."""

    def __init__(self, every: DataFrame, sections: DataFrame, include_areas: bool, links: DataFrame | None):
        self._every, self._sections, self._include_areas, self._links = every, sections, include_areas, links

    @cached_property
    def _drawn(self) -> DataFrame:
        return self._every.where("error is null")

    @cached_property
    def _hits(self) -> DataFrame:
        return figure_hits(self._drawn)

    @cached_property
    def localized(self) -> DataFrame:
        return with_references(self._drawn)

    @cached_property
    def quarantine(self) -> DataFrame:
        return self._every.where("error is not null")

    @cached_property
    def concepts(self) -> DataFrame:
        return with_tags(concepts(self.localized.drop("error")), self._sections)

    @cached_property
    def section_children(self) -> DataFrame:
        return section_children(self._drawn)

    @cached_property
    def _tree(self) -> DataFrame:
        tree = hierarchy_concepts(self._sections)
        return tree if self._include_areas else tree.where("false")

    @cached_property
    def hierarchy(self) -> DataFrame:
        return with_narrower(self._tree, self.section_children)

    @cached_property
    def figures(self) -> DataFrame:
        return figure_entities(self._hits)

    @cached_property
    def figure_references(self) -> DataFrame:
        return figure_references(self._hits)

    @cached_property
    def bibliography(self) -> DataFrame:
        return bibliography(source_rows(self._drawn), self._links)

    @cached_property
    def register(self) -> DataFrame:
        return section_tree(self._sections)

    @cached_property
    def stats(self) -> DataFrame:
        return counted(self.concepts, self._tree, self.figures)


def export(
    sheet: DataFrame, sections: DataFrame, languages: DataFrame, *, only_concepts: str | None = None, only_languages: str | None = None, include_areas: bool = True,
    strict: bool = False, links: DataFrame | None = None,
) -> Exported:
    """The whole pipeline from sheet rows; filters act on rows, the hierarchy is always whole.

    Rows that can't be exported are set aside with their ``error``.  ``strict`` takes no
    three-letter languages and stops at the first such row instead.  ``links`` (``reference,
    link``) is an optional table for the bibliography.
    """
    chosen = first_wins(filtered(sheet, only_concepts, only_languages), ["IEVREF", "LANGUAGE"])
    every = localized(chosen, sections, languages, link_names(chosen, sheet, languages), strict)
    if strict:
        stop = F.raise_error(F.concat(F.lit("row "), F.col("_ord").cast("string"), F.lit(", "), F.coalesce("code", F.lit("no code")), F.lit(": "), F.col("error")))
        every = every.withColumn("error", F.when(F.col("error").isNotNull(), stop.cast("string")))
    return Exported(every, sections, include_areas, links)


def counted(nested: DataFrame, tree: DataFrame, figures: DataFrame) -> DataFrame:
    """One row: ``concept_count, localized_count, figure_count``; areas and sections count as concepts of one localization."""
    of = lambda df, concepts, texts, figs: df.select(concepts.cast("long").alias("c"), texts.cast("long").alias("l"), figs.cast("long").alias("f"))
    one, none = F.lit(1), F.lit(0)
    every = of(nested, one, F.size("languages"), none).unionByName(of(tree, one, one, none)).unionByName(of(figures, none, none, one))
    total = lambda c: F.coalesce(F.sum(c), none.cast("long"))
    return every.agg(total("c").alias("concept_count"), total("l").alias("localized_count"), total("f").alias("figure_count"))


__all__ = ["Exported", "area_code", "cell_sources", "citation_rows", "clean", "concepts", "export", "localized", "references", "section_children"]
