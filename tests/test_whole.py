"""Whole jobs: what an export, a query or a source must not leave out."""

import json

import pytest

from glossweave.functions import labels
from glossweave.operators import export as ex
from glossweave.operators import nested
from glossweave.operators.sheet import COLUMNS, as_sheet, first_wins
from glossweave.plans import core
from glossweave.sinks import files
from glossweave.sources import snapshots


def exported(spark, *rows, **options):
    cells = [(i, *[{"STATUS": "Standard", **r}.get(c) for c in COLUMNS]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(cells, "n int, " + ", ".join(f"{c} string" for c in COLUMNS))
    sections = spark.createDataFrame([("103", "Functions", "103-01", "General")], "area_code string, area_title string, section_code string, section_title string")
    return ex.export(as_sheet(df, "n"), sections, labels.language_dimension(spark), **options)


def test_sources_are_exported(spark, tmp_path):
    cell = "IEC 62302:2007, 3.2, modified – new <i>f</i>; IAEA 4"
    made = exported(
        spark,
        {"IEVREF": "103-01-01", "LANGUAGE": "en", "TERM": "a", "SOURCE": cell},
        {"IEVREF": "103-01-01", "LANGUAGE": "fr", "TERM": "b", "SOURCE": cell},
        {"IEVREF": "103-01-02", "LANGUAGE": "en", "TERM": "c", "SOURCE": " "},
        {"IEVREF": "103-01-03", "LANGUAGE": "en", "TERM": "d"},
    )
    got = {(r.code, r.language): r.sources for r in made.localized.collect()}
    assert len(got) == 4 and got["103-01-02", "eng"] is None and got["103-01-03", "eng"] is None
    assert got["103-01-01", "eng"] == got["103-01-01", "fra"]
    one, two = got["103-01-01", "eng"]
    assert (one.type, one.status, one.modification) == ("authoritative", "modified", "new <i>f</i>")
    assert (one.origin.ref[:], one.origin.locality[:], one.origin.original) == (("IEC", "62302:2007"), ("clause", "3.2"), "IEC 62302:2007, 3.2, modified – new stem:[f]")
    assert (two.type, two.status, two.origin.ref[:]) == ("authoritative", "identical", ("IAEA", "4"))
    files.write_concepts(made.concepts, str(tmp_path))
    text = (tmp_path / "concepts" / "concept-103-01-01.yaml").read_text()
    assert text.count("authoritative") == 4 and text.count("reference_from") >= 2
    assert "authoritative" not in (tmp_path / "concepts" / "concept-103-01-02.yaml").read_text()


def test_figures_and_references_are_exported(spark, tmp_path):
    macro = "image::/assets/images/parts/103/a.gif[Figure 1 – W]"
    link = "<a href=IEV 103-01-02>IEV 103-01-02</a>"
    made = exported(
        spark,
        {"IEVREF": "103-01-01", "LANGUAGE": "en", "TERM": "a", "DEFINITION": f"See {macro} and {link}<p>Note 1 to entry: <a href=IEV 103-01-09>named</a> {macro}"},
        {"IEVREF": "103-01-01", "LANGUAGE": "fr", "TERM": "b", "DEFINITION": f"Voir {link} et <a href=IEV 103-01-08>IEV 103-01-08</a>"},
        {"IEVREF": "103-01-02", "LANGUAGE": "en", "TERM": "<b>set</b>"},
        only_languages="en,fr",
    )
    c = made.concepts.where("code = '103-01-01'").first()
    urn = "{{urn:iec:std:iec:60050-103-01-0"
    assert c.localized["eng"].definition == "See {{fig:fig-a, Figure 1 - W}} and " + urn + "2, *set*}}"
    assert c.localized["eng"].notes == [urn + "9, named}} {{fig:fig-a, Figure 1 - W}}"]
    assert c.localized["fra"].definition == "Voir " + urn + "2, *set*}} et " + urn + "8, IEV 103-01-08}}"
    assert [r[:] for r in c.references] == [("103-01-02", "*set*"), ("103-01-09", "named"), ("103-01-08", "IEV 103-01-08")]
    assert [r[:] for r in c.figures] == [("fig-a", "Figure 1")] == [(r.figure_id, r.display) for r in made.figure_references.collect()]
    assert {r.definition for r in made.localized.collect()} == {c.localized["eng"].definition, c.localized["fra"].definition, None}
    assert made.figures.first().caption == {"eng": "W"}
    files.write_concepts(made.concepts, str(tmp_path))
    text = (tmp_path / "concepts" / "concept-103-01-01.yaml").read_text()
    assert "image::" not in text and "entity_id" in text and "references" in text


def test_pages_have_every_language(spark, tmp_path):
    cells = [("103-01-01", lang, f"term {lang}", f"a < b {lang}") for lang in (*labels.PAGE_LANGUAGES.values(), "xx", "lat")]
    cells += [("103-01-02", lang, f"term {lang}", "text") for lang in labels.PAGE_LANGUAGES] + [("103-01-03", "deu", "kurz", None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cells)], "export_id long, ievref string, language_code string, term string, definition string")
    df.write.parquet(str(tmp_path / "iev_export.parquet"))
    got = {(r.code, r.language): (r.terms, r.definition) for r in core.page_rows(spark, str(tmp_path)).collect()}
    every = set(labels.PAGE_LANGUAGES.values())
    assert set(got) == {(c, lang) for c in ("103-01-01", "103-01-02") for lang in every} | {("103-01-03", "deu")} and got["103-01-03", "deu"] == ("kurz", None)
    assert all(got["103-01-01", lang][0] == f"term {lang}" for lang in every) and got["103-01-02", "jpn"] == ("term ja", "text")


def test_deep_bodies_are_whole():
    n = 200_000
    deep = "[" * n + "1" + "]" * n
    body = '{"id": "x", "domains": [{"concept_id": "d", "ref_type": "domain"}], "more": %s, "localized_concepts": [{"language_code": "eng", "terms": [{"designation": "t", "extra": %s}]}]}' % (deep, deep)
    rows = list(nested.visit(1, body))
    assert [(r[0], r[6]) for r in rows] == [("record", "x"), ("domain", "d"), ("localized", "eng"), ("term", "t")]
    assert deep in rows[0][7] and rows[3][7] == '{"designation": "t", "extra": %s}' % deep
    assert list(nested.visit(1, body[:-1])) == [] and list(nested.visit(1, body + "x")) == [] and list(nested.visit(1, body.replace("1]", "1,]", 1))) == []
    for text in ('{"a": [1, -2.5e3, "x\\u00e9", null, true], "b": {}, "c": [], "d": {"e": [[], {}]}}', "[ ]", " 7 "):
        assert nested.deep_loads(text) == json.loads(text)


def test_deep_terms_keep_their_fields(spark):
    deep = "[" * 20_000 + "]" * 20_000
    df = spark.createDataFrame([(1, '{"localized_concepts": [{"terms": [{"extra": %s, "designation": "t"}]}]}' % deep)], "record_id long, body string")
    assert [r.designation for r in nested.flat(nested.tagged_rows(df), "term").collect()] == ["t"]


def test_every_definition_is_kept(tmp_path):
    entry = {"eng": {"terms": [{"designation": "t"}], "definition": [{"content": "one"}, "two", None]}, "fra": {"terms": [{"designation": "u"}], "definition": []}}
    assert [r[5] for r in snapshots.languages_of(0, "1", entry)] == ["one\n\ntwo", None]


def test_definitions_with_markup_are_converted(spark, tmp_path):
    texts = {"plain": "plain", "see <a href=IEV 102-01-10>set</a>": "see {{urn:iec:std:iec:60050-102-01-10, set}}", "<b>a</b> &amp; b": "*a* & b", "x < 5 V": "x < 5 V"}
    df = spark.createDataFrame([(i, "103-01-01", t) for i, t in enumerate([*texts, None])], "export_id long, ievref string, definition string")
    df.write.parquet(str(tmp_path / "iev_export.parquet"))
    got = {r.export_id: r.markup for r in core.markup_convert_all(spark, str(tmp_path)).collect()}
    assert got == {i: f"*103-01-01* stem:[x]~1~^2^\n{t}\n" for i, t in enumerate(texts.values())}


@pytest.mark.parametrize("name", ["first_wins_pk", "p4_found", "concept_nest"])
def test_rows_of_a_key_are_cut_before_they_move(spark, data, name):
    import __spark_entry__ as e

    p = e.queries()[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in p
    before = p[p.index("Exchange hashpartitioning", p.index("Final")) :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_equal_rows_and_ties_of_order(spark):
    rows = [("a", 1, "y", None), ("a", 1, "x", "z"), ("a", 1, "x", "z"), ("b", None, "late", None), ("b", 7, "first", "u"), (None, 2, "n", "n"), (None, 1, "m", None)]
    df = spark.createDataFrame(rows, "k string, _ord long, t string, u string")
    got = {tuple(r) for r in first_wins(df, ["k"]).collect()}
    assert got == {("a", 1, "x", "z"), ("b", 7, "first", "u"), (None, 1, "m", None)}
    assert first_wins(df.limit(0), ["k"]).count() == 0


def test_a_strict_export_stops(spark):
    two = {"IEVREF": "103-01-01", "LANGUAGE": "en", "TERM": "a"}
    assert exported(spark, two, strict=True).concepts.count() == 1
    for bad, why in (("eng", "unknown language"), ("whatever", "unknown language"), ("xy", "unknown language")):
        with pytest.raises(Exception, match=why):
            exported(spark, two, {**two, "LANGUAGE": bad}, strict=True).concepts.collect()
    with pytest.raises(Exception, match="no status"):
        exported(spark, two, {**two, "LANGUAGE": "fr", "STATUS": None}, strict=True).bibliography.collect()
    aside = exported(spark, two, *[{**two, "LANGUAGE": x} for x in ("eng", "qqq", "xy", "nl BE", None)])
    assert {r.language for r in aside.quarantine.collect()} == {"qqq", "xy", None} and set(aside.concepts.first().languages) == {"eng", "nld"}


def test_works_of_rows_set_aside_are_not_listed(spark):
    made = exported(spark, {"IEVREF": "103-01-01", "LANGUAGE": "en", "TERM": "a", "SOURCE": "IAEA 4"}, {"IEVREF": "103-01-02", "LANGUAGE": "xy", "TERM": "b", "SOURCE": "ISO 9000"})
    assert [r.id for r in made.bibliography.collect()] == ["iaea_4"]


def test_documents_hold_tags_and_narrower_concepts(spark, tmp_path):
    made = exported(spark, {"IEVREF": "103-01-02", "LANGUAGE": "en", "TERM": "a"}, {"IEVREF": "103-01-01", "LANGUAGE": "en", "TERM": "b", "SOURCE": "IAEA 4"})
    files.write_concepts(made.concepts, str(tmp_path), packed=True)
    body = json.loads(spark.read.parquet(str(tmp_path / "concepts")).where("name = 'concept-103-01-01.yaml'").first().body)
    assert body["concept"]["data"]["tags"] == ["Functions", "General"] and body["localized"][0]["id"] == "103-01-01-eng"
    assert body["localized"][0]["data"]["sources"][0]["origin"]["ref"] == {"source": "IAEA", "id": "4"}
    section = made.hierarchy.where("kind = 'section'").first()
    assert [(r.type, r.ref.id) for r in section.related] == [("broader", "area-103"), ("narrower", "103-01-01"), ("narrower", "103-01-02")]
    assert [tuple(r) for r in made.section_children.orderBy("code").collect()] == [("103-01", "103-01-01"), ("103-01", "103-01-02")]
    files.write_concepts(made.concepts, str(tmp_path / "each"))
    assert "General" in (tmp_path / "each" / "concepts" / "concept-103-01-01.yaml").read_text()


def test_termbase_side_has_designations_without_markers_and_earlier_dates(spark):
    from glossweave.cli import termbase_side
    from glossweave.operators.reconcile import reconcile

    term = lambda d: {"type": "expression", "designation": d, "normative_status": None, "gender": None, "plurality": None, "usage_info": None}
    row = {"_ord": 0, "code": "103-01-01", "language": "deu", "lang_no": 0, "terms": [term("Gleichheit, f"), term("Gleiche")], "entry_status": "Standard", "date_accepted": "2001-01-01", "date_amended": "2001-01-01"}
    rows = spark.createDataFrame([row, {**row, "code": "103-01-02", "_ord": 1, "terms": [], "date_amended": "2002-02-02"}], snapshots.RECORD)
    old = termbase_side(rows)
    assert {r.code: r.designations for r in old.collect()} == {"103-01-01": ["Gleichheit", "Gleiche"], "103-01-02": []}
    got = {r.code: [(d.type, d.date) for d in r.dates] for r in reconcile(old, old.where("code = '103-01-01'"), "2026-07-10", snapshots.concept_dates(rows)).collect()}
    assert got == {"103-01-01": [("accepted", "2001-01-01")], "103-01-02": [("accepted", "2001-01-01"), ("amended", "2002-02-02"), ("retired", "2026-07-10")]}
