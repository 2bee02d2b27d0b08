"""Relational operators, reconciliation, citations, figures, plans."""

import random

import pytest
from pyspark.sql import functions as F

from glossweave.functions import citation_rules as cite
from glossweave.functions import codes, labels, text
from glossweave.operators import export as ex
from glossweave.operators import figures as fig
from glossweave.operators import hierarchy as hier
from glossweave.operators import lookup
from glossweave.operators import reconcile as rec
from glossweave.operators.bibliography import bibliography
from glossweave.operators.sheet import COLUMNS, as_sheet, filtered, first_wins
from glossweave.parsers.supersession import superseded
from glossweave.plans import core
from glossweave.session import table

DAY = "2026-07-10"


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def many(spark, f, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in rows.select("i", f(F.col("v"))).orderBy("i").collect()]


def test_codes(spark):
    assert many(spark, codes.area_code, ["103-01-02", "103", "103-", "1-2-3-4", None]) == ["103", "103", "103", "1", None]
    assert many(spark, codes.section_code, ["103-01-02", "103-01", "103", "103-", None]) == ["103-01", "103-01", None, None, None]
    assert many(spark, codes.concept_number, ["103-01-02", "103-01", None]) == ["02", None, None]
    assert many(spark, codes.section_of, ["103-01-02", "x", None]) == ["103-01", "", None]
    assert many(spark, codes.complete_date, ["2022", "2022-04", "2022-04-15", "", None, "2022-13", "soon"]) == ["2022-01-01T00:00:00+00:00", "2022-04-01T00:00:00+00:00", "2022-04-15T00:00:00+00:00", "", None, None, None]
    assert many(spark, codes.numeric_order, ["103-01", "x-2", "9"]) == [[103, 1], [0, 2], [9]]


def test_text(spark):
    assert many(spark, text.sanitize, ["﻿ é x‑y  \n\x00", "", None]) == ["é x-y", "", None]
    assert many(spark, text.basic_entities, ["&amp;lt; &#39;", None]) == ["&lt; '", None]
    assert many(spark, text.comparable, ["<b>Hello</b>  World", None, "“x”", "„x‟"]) == ["hello world", "", "“x”", '"x"']
    assert many(spark, text.shorten, ["x" * 200, "x" * 201, None, ""]) == ["x" * 200, "x" * 200 + "...", "", ""]
    assert many(spark, text.split_synonyms, ["a<br>b<p>", "<p>a", "", None, "<p>"]) == [["a", "b"], ["", "a"], [], [], []]
    assert many(spark, text.without_leading_number, ["1: In a", "2  x", ": y", "z 1"]) == ["In a", "x", "y", "z 1"]
    assert many(spark, superseded, ["IEV 731-03-24:1991", "731-03-24 : 1991-10", "731-03-24:1991-10-01", " ", "NOT IEV 731-03:1991", None]) == [[("supersedes", "IEV", "731-03-24")]] * 3 + [None] * 3


def test_sanitize_twice_is_once(spark):
    tricky = ["  a‑b ", "é", "\x00x", "﻿"]
    once = many(spark, text.sanitize, tricky)
    assert many(spark, text.sanitize, once) == once


def test_labels(spark):
    assert many(spark, labels.termbase_status, ["Standard", "Draft", "Not Valid", "x", None]) == ["valid", "draft", "notValid", "valid", "valid"]
    assert many(spark, labels.classification, ["认可的", "首选的", "Preferred", "", None]) == ["admitted", "preferred", "preferred", None, None]
    assert many(spark, labels.designation_status, ["obsoleto", "x", None]) == ["deprecated", "x", None]
    assert many(spark, labels.anchor, ["ISO/IEC 2382:2015", "a  b"]) == ["iso_iec_2382_2015", "a_b"]
    assert many(spark, labels.reference_type, ["IEV", "ITU-T", "BIPM", "ISO", None]) == ["vocabulary", "recommendation", "brochure", "standard", "standard"]
    langs = labels.language_dimension(spark)
    rows = spark.createDataFrame([("en",), ("de",), ("nl BE",), ("eng",), ("xy",), (None,)], "l string")
    assert [r.o for r in labels.three_letter(rows, "l", langs, "o").collect()] == ["eng", "deu", "nld", "eng", "xy", None]
    assert langs.where("alpha2 = 'de'").first().alpha3 == "deu"


@pytest.mark.parametrize(
    "field, parts",
    [
        ("702-09-44 MOD, 723-07-47, voir 723-10-91", ["702-09-44 MOD", "723-07-47", "voir 723-10-91"]),
        ("IEC 62303:2008, 3.1, modified and IEC 62302:2007, 3.2; IAEA 4", ["IEC 62303:2008, 3.1, modified", "IEC 62302:2007, 3.2", "IAEA 4"]),
        ("CEI 62303:2008, 3.1, modifiée et CEI 62302:2007, 3.2; AIEA 4", ["CEI 62303:2008, 3.1, modifiée", "CEI 62302:2007, 3.2", "AIEA 4"]),
        ("702-01-02 MOD,ITU-R Rec. 431 MOD", ["702-01-02 MOD", "ITU-R Rec. 431 MOD"]),
        ("161-06-01 MOD. ITU RR 139 MOD", ["161-06-01 MOD", "ITU RR 139 MOD"]),
        ("725-12-50, ITU RR 11", ["725-12-50", "ITU RR 11"]),
        ("705-02-01, 702-02-07", ["705-02-01", "702-02-07"]),
        ("", []),
        (None, None),
    ],
)
def test_citation_split(spark, field, parts):
    assert many(spark, cite.split_field, [field]) == [parts]


REFERENCES = {
    "SI Brochure, 9th edition, 2019, 2.3.1": ("BIPM", "SI Brochure"),
    "JCGM VIM": ("JCGM", "VIM"),
    "IEC 60050-121, 151-12-05": ("IEC", "60050-121"),
    "AIEA 4": ("IAEA", "4"),
    "IEC IEEE 60780-323:2016": ("IEC/IEEE", "60780-323:2016"),
    "CISPR 16-1:2003": ("IEC CISPR", "16-1:2003"),
    "ITU RR 139": ("ITU-R", "RR"),
    "IEC 50(845)": ("IEC", "60050-50"),
    "ISO/TS 14812:2022, 3.1": ("ISO/TS", "14812:2022"),
    "ISO/IEC 2382:2015": ("ISO/IEC", "2382:2015"),
    "ISO/IEC/IEEE 24765:2010": ("ISO/IEC/IEEE", "24765:2010"),
    "ISO 140/4": ("ISO", "140-4"),
    "Guide ISO/IEC 2 (14.1)": ("ISO/IEC Guide", "2"),
    "ITU-T Recommendation F.791 (11/2015)": ("ITU-T Recommendation", "F.791 (11/2015)"),
    "UIT-T F.791:2015": ("ITU-T Recommendation", "F.791"),
    "ITU-R Rec. 592 MOD": ("ITU-R Recommendation", "592"),
    "ISO 669: 2000 3.1.16": ("ISO", "669: 2000"),
    "CEI 62303:2008, 3.1, modifiée": ("IEC", "62303:2008"),
    "VEI 702-09-44": ("IEV", None),
    "221 04 03": ("IEV", None),
    "IEV part 151": ("IEC", "60050-151"),
    "own words, modified": ("own words", None),
}


def test_references(spark):
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(REFERENCES)], "i int, c string")
    named = cite.with_reference(rows.withColumn("s", cite.one_spelling(F.col("c"))), "s").withColumn("p", cite.publisher_of(F.col("reference")))
    assert {r.c: (r.p.source, r.p.id) for r in named.collect()} == REFERENCES


def test_relationship(spark):
    got = many(spark, cite.relationship_of, ["≠ x", "≈ x", "see x", "IEC 1 MOD", "IEC 1, modified – new words", "x", "from x"])
    assert [r.status for r in got] == ["not_equal", "similar", "related", "modified", "modified", "identical", "identical"]
    assert got[4].modification == "new words" and got[3].modification is None


def sheet_rows(spark, rows):
    return as_sheet(spark.createDataFrame(rows), "n")


def test_first_wins_any_order(spark):
    rows = [(k, v, o) for o, (k, v) in enumerate([("a", "1"), ("b", "2"), ("a", "3"), (None, "4"), ("b", None), (None, "5")])]
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v string, _ord int").repartition(3)
        assert {(r.k, r.v) for r in first_wins(df, ["k"]).collect()} == {("a", "1"), ("b", "2"), (None, "4")}
    assert first_wins(df.limit(0), ["k"]).count() == 0


def test_sheet_columns_and_filters(spark):
    df = spark.createDataFrame([(1, "103-01-01", "en", "t"), (2, "104-01-01", "nl BE", None)], "n int, IEVREF string, language string, other string")
    s = as_sheet(df, "n")
    assert s.columns == ["_ord", *COLUMNS] and s.where("TERM is null").count() == 2
    assert filtered(s, "103%", None).count() == 1 and filtered(s, None, "en,nl BE").count() == 2 and filtered(s).count() == 2


def small_sections(spark):
    return spark.createDataFrame([("103", "Functions", "103-01", "General"), ("103", "Functions", "103-02", None), ("736", "Empty", None, None)], "area_code string, area_title string, section_code string, section_title string")


def test_hierarchy(spark):
    s = small_sections(spark)
    tree = {r.concept_id: r for r in hier.hierarchy_concepts(s).collect()}
    assert set(tree) == {"area-103", "area-736", "section-103-01", "section-103-02"}
    assert [x.ref.id for x in tree["area-103"].related] == ["section-103-01", "section-103-02"] and tree["area-736"].related is None
    assert tree["section-103-01"].related[0].ref.id == "area-103" and tree["section-103-01"].tags == ["Functions", "General"] and tree["section-103-02"].tags == ["Functions"]
    got = hier.domain_title(hier.with_titles(spark.createDataFrame([("103-01-09",), ("103-99-01",), ("999-01-01",), ("103",)], "code string"), "code", s)).collect()
    assert {r.code: r.domain for r in got} == {"103-01-09": "General", "103-99-01": "Functions", "999-01-01": None, "103": "Functions"}
    assert hier.area_for_section(s, "103-01").first().area_title == "Functions" and hier.find_section(s, "x").count() == 0
    assert [r.area_code for r in hier.section_tree(s).collect()] == ["103", "736"]
    fresh = spark.createDataFrame([("9", "n", ["z"]), ("1", "m", [])], "area_code string, area_title string, sections array<string>")
    cached = spark.createDataFrame([("1", "old", ["kept"])], "area_code string, area_title string, sections array<string>")
    assert {r.area_code: r.sections for r in hier.merge_areas(cached, fresh).collect()} == {"9": ["z"], "1": ["kept"]}


def test_export(spark):
    rows = [
        {"n": 1, "IEVREF": "103-01-01", "LANGUAGE": "en", "TERM": "function", "TERMATTRIBUTE": "f pl", "SYNONYM1": "map<br>image", "SYNONYM1STATUS": "Preferred", "SYMBOLE": "<i>f</i>", "DEFINITION": "See image::/assets/images/parts/103/a.gif[Figure 1 – W] x<p>Note 1 to entry: 1: n", "SOURCE": "IEC 62302:2007, 3.2; IAEA 4", "PUBLICATIONDATE": "2022-04", "STATUS": "Standard", "REPLACES": "881-01-23:1983"},
        {"n": 2, "IEVREF": "103-01-01", "LANGUAGE": "ko", "TERM": "함수", "STATUS": "Standard", "SOURCE": "IEC 62302:2007, 3.2"},
        {"n": 3, "IEVREF": "103-01-01", "LANGUAGE": "en", "TERM": "second", "STATUS": "Standard"},
        {"n": 4, "IEVREF": "103-01-02", "LANGUAGE": "ko", "TERM": ".....", "STATUS": None},
        {"n": 5, "IEVREF": "103-01-03", "LANGUAGE": "xx", "TERM": "t", "STATUS": "Standard"},
    ]
    names = ["n", *COLUMNS]
    df = spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], "n int, " + ", ".join(f"{c} string" for c in COLUMNS))
    made = ex.export(as_sheet(df, "n"), small_sections(spark), labels.language_dimension(spark))
    assert {(r.code, r.error) for r in made.quarantine.collect()} == {("103-01-02", "no status"), ("103-01-03", "unknown language")}
    c = made.concepts.first()
    assert (c.code, c.status, c.languages) == ("103-01-01", "valid", ["eng", "kor"])
    assert [(d.concept_id, d.ref_type) for d in c.domains] == [("area-103", "domain"), ("section-103-01", "section")]
    assert [(r.type, r.id) for r in c.related] == [("supersedes", "881-01-23"), ("broader", "section-103-01")]
    eng = c.localized["eng"]
    assert [(t.type, t.designation, t.normative_status) for t in eng.terms] == [("expression", "function", "preferred"), ("expression", "map", "preferred"), ("expression", "image", "preferred"), ("symbol", "stem:[f]", None)]
    assert eng.terms[0].grammar_info[0].gender == ["f"] and eng.terms[0].grammar_info[0].number == ["plural"]
    assert eng.notes == ["n"] and eng.domain == "General" and eng.review_date == "2022-04-01T00:00:00+00:00"
    assert [r.id for r in made.bibliography.collect()] == ["iaea_4", "iec_62302_2007"]
    f = made.figures.first()
    assert (f.figure_id, f.identifier, f.caption) == ("fig-a", "Figure 1", {"eng": "W"})
    assert made.stats.first().asDict() == {"concept_count": 5, "localized_count": 6, "figure_count": 1}  # with one area and three sections
    assert c.tags == ["Functions", "General"] and {r.concept_id: [x.ref.id for x in r.related or [] if x.type == "narrower"] for r in made.hierarchy.collect()}["section-103-01"] == ["103-01-01"]
    shown = lookup.get(made.concepts, "103-01-01", "en", labels.language_dimension(spark))
    assert shown == "function" and lookup.get(made.concepts, "103-01-01", "xxx", labels.language_dimension(spark)) is None and lookup.get(made.concepts, "9", "en", labels.language_dimension(spark)) is None
    with pytest.raises(lookup.NotFound):
        lookup.fetch_concept(made.concepts, "9")


def test_figures(spark):
    texts = {
        "See image::/assets/images/parts/103/b.png[Figure  3   - C c].": "See {{fig:fig-b, Figure 3 - C c}}.",
        "image::/assets/images/parts/103/a.gif[]": "{{fig:fig-a}}",
        "image::/assets/images/parts/103/a.gif[Figure 5]x": "{{fig:fig-a, Figure 5}}x",
        "image::/assets/images/parts/103/a.gif[words]": "{{fig:fig-a, words}}",
        "image::/assets/images/parts/103-01/a.gif[]": "image::/assets/images/parts/103-01/a.gif[]",
        "none": "none",
    }
    assert many(spark, fig.with_mentions, list(texts)) == list(texts.values())
    macro = "image::/assets/images/parts/103/a.gif[%s]"
    rows = spark.createDataFrame([("c1", "eng", 1, macro % "Figure 1 - W" + macro % "Figure 1 - V", [macro % ""], None), ("c1", "fra", 2, macro % "Figure 1 - F", [], []), ("c2", "", 3, macro % "x", [], []), ("c2", "eng", 4, None, [], [])], "code string, language string, _ord long, definition string, examples array<string>, notes array<string>")
    hits = fig.figure_hits(rows)
    f = fig.figure_entities(hits).collect()
    assert len(f) == 1 and f[0].caption == {"eng": "W", "fra": "F"} and len(f[0].images) == 1 and f[0].images[0].format == "gif"
    assert [(r.code, r.figure_id, r.display) for r in fig.figure_references(hits).collect()] == [("c1", "fig-a", "Figure 1")]
    assert fig.figure_entities(fig.figure_hits(rows.limit(0))).count() == 0


def test_bibliography_links(spark):
    rows = spark.createDataFrame([(1, 0, "IEC", "1:2000"), (2, 0, "IEC", "1:2000"), (3, 0, "IEV", None), (4, 0, " ", "x"), (5, 0, None, "y")], "_ord long, pos int, source string, id string")
    links = spark.createDataFrame([("IEC 1:2000", "http://x.example")], "reference string, link string")
    assert [r[:] for r in bibliography(rows, links).collect()] == [("iec_1_2000", "IEC 1:2000", "http://x.example", "standard"), ("iev", "IEV", None, "vocabulary")]


def side(spark, rows):
    names = "code string, language string, _ord long, status string, designations array<string>, definition string, notes array<string>, examples array<string>"
    return spark.createDataFrame([(c, l, i, s, [t], d, n, e) for i, (c, l, s, t, d, n, e) in enumerate(rows)], names)


BASE = ("1-1-1", "eng", "valid", "term", "text", ["n"], ["e"])


def fields(spark, old, new):
    got = rec.change_rows(rec.reconcile(side(spark, old), side(spark, new), DAY), DAY)
    return {(r.field, r.language, r.old_value, r.new_value) for r in got.collect()}


def test_diff(spark):
    assert fields(spark, [BASE], [BASE]) == set()
    new = ("1-1-1", "eng", "draft", "Other", "new text", ["n", "m"], [])
    assert fields(spark, [BASE], [new]) == {("status", None, "valid", "draft"), ("designation", "eng", "term", "Other"), ("definition", "eng", "text", "new text"), ("notes", "eng", "n", "n | m"), ("examples", "eng", "e", "")}
    assert fields(spark, [("1-1-1", "eng", "valid", "t", "hello world", [], [])], [("1-1-1", "eng", "valid", "t", "<b>Hello</b>  World", [], [])]) == set()
    fra = ("1-1-1", "fra", "valid", "t", "d", [], [])
    assert fields(spark, [BASE], [BASE, fra]) == {("language_added", "fra", None, "present")}
    assert fields(spark, [BASE, fra], [BASE]) == set()


def test_merge(spark):
    deu = ("1-1-1", "deu", "valid", "wort", "sinn", [], [])
    old = [BASE, deu, ("2-2-2", "eng", "valid", "gone", "g", [], [])]
    new = [("1-1-1", "eng", "valid", "term", "other", ["n"], ["e"]), ("3-3-3", "eng", "valid", "new", "n", [], [])]
    got = {r.code: r for r in rec.reconcile(side(spark, old), side(spark, new), DAY).collect()}
    both = {x.language: x for x in got["1-1-1"].localized}
    assert got["1-1-1"].origin == "both" and both["eng"].definition == "other" and both["eng"].notes == ["n"]
    assert [(d.type, d.date) for d in got["1-1-1"].dates] == [("amended", DAY)]
    assert both["deu"].examples == [rec.STALE_NOTICE % ("eng:definition", DAY)] and both["eng"].examples == ["e"]
    assert (got["2-2-2"].origin, got["2-2-2"].status) == ("termbase_only", "retired") and got["2-2-2"].changes[0].old_value == "retired"
    assert (got["3-3-3"].origin, got["3-3-3"].changes, got["3-3-3"].dates) == ("live_only", [], [])
    df = rec.reconcile(side(spark, old), side(spark, new), DAY)
    assert rec.stats(df).first()[:] == (3, 1, 1, 1, 2)
    changes = rec.change_rows(df, DAY)
    assert {(r.tally, r.value): r.n_changes for r in rec.summary(changes).collect()} == {("total", None): 2, ("field", "definition"): 1, ("field", "status"): 1, ("language", "eng"): 1, ("language", None): 1, ("section", "1-1"): 1, ("section", "2-2"): 1}
    assert [r.code for r in rec.codes_of_origin(df, "live_only").collect()] == ["3-3-3"]
    assert rec.reconcile(side(spark, []), side(spark, []), DAY).count() == 0


def test_a_side_has_no_changes_against_itself(spark, data):
    old, new = core.sides(spark, data)
    for s in (old, new):
        same = rec.reconcile(s, s.repartition(5), DAY)
        assert rec.stats(same).first().changed == 0 and same.count() == s.select("code").distinct().count()
    both = rec.reconcile(old, new, DAY)
    assert both.count() == old.select("code").union(new.select("code")).distinct().count()


def test_preferred_term(spark):
    t = spark.createDataFrame([(1, 1, "a", "admitted"), (1, 2, "b", "preferred"), (2, 1, "c", None), (2, 2, "d", "admitted")], "l10n_id long, term_no int, designation string, normative_status string")
    assert {r.l10n_id: r.designation for r in lookup.designations(t, ["l10n_id"]).collect()} == {1: "b", 2: "c"}


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and df.columns[0] == "code"
    assert set(e.oracle_sql()) <= set(e.queries())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, data):
    p = plan(core.filter_in_language(spark, data))
    assert "PushedFilters: [In(language_code" in p and "Exchange" not in p
    assert "definition" not in p.split("ReadSchema")[1]
    p = plan(core.area_section_lookup(spark, data))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    for name in ("reconcile_stats", "flagship", "figures_merge", "bibliography_distinct"):
        p = plan(core.QUERIES[name](spark, data))
        assert "Cartesian" not in p and "NestedLoop" not in p, name


def test_queries_match_their_sql(spark, data):
    from oracle_check import compare, connect

    from glossweave.plans import problems

    duck = connect(data)
    failed = []
    for name, q in {**core.QUERIES, **problems.QUERIES}.items():
        said, ok = compare(spark, duck, name, q, {**core.ORACLE, **problems.ORACLE}.get(name), data)
        if not ok:
            failed.append(said)
    assert not failed, failed[:3]
