"""Literals of the text parsers."""

import pytest

from glossweave.markup import adoc, math, pages
from glossweave.markup.tree import parse, serialise
from glossweave.parsers import attributes, clauses, definition, markers


@pytest.mark.parametrize(
    "cell, expected",
    [
        ("f", ("f", "singular", None)),
        ("(m)", ("m", "singular", None)),
        ("[n]", ("n", "singular", None)),
        ("f pl", ("f", "plural", None)),
        ("(pl)", (None, "plural", None)),
        ("adj", (None, None, "adj")),
        ("名詞", (None, None, "noun")),
        ("형용사", (None, None, "adj")),
        ("Adjektiv", (None, None, "adj")),
        ("", (None, None, None)),
        (None, (None, None, None)),
        ("mf", (None, None, None)),
    ],
)
def test_attribute_grammar(cell, expected):
    a = attributes.parse(cell)
    assert (a.gender, a.number, a.part_of_speech) == expected


def test_attribute_rest():
    assert attributes.parse("m, <traction>").usage_info == "traction"
    assert attributes.parse("＜ 通信 ＞").usage_info == "通信"
    assert attributes.parse("<a ＞").usage_info is None
    assert attributes.parse("&lt;<i>x</i>&gt;").usage_info == "x"
    assert attributes.parse("noun US").geographical_area == "US"
    assert attributes.parse("US\nx").geographical_area == "US"
    assert attributes.parse("Präfix").prefix == "Präfix"


@pytest.mark.parametrize(
    "term, designation, genders, numbers",
    [
        ("Gleichheit, f", "Gleichheit", ["feminine"], []),
        ("једнакост, ж јд", "једнакост", ["feminine"], ["singular"]),
        ("скуп, м јд", "скуп", ["masculine"], ["singular"]),
        ("LED-Package, f, n, m", "LED-Package", ["masculine", "neuter", "feminine"], []),
        ("x, m/f", "x", ["masculine", "feminine"], []),
        ("données, f pl", "données", ["feminine"], ["plural"]),
        ("stem:[n]-dimensionaler Vektorraum, m", "stem:[n]-dimensionaler Vektorraum", ["masculine"], []),
        ("Gleichheit, f\n", "Gleichheit", ["feminine"], []),
        ("equality, defined as relation", "equality, defined as relation", [], []),
        ("", "", [], []),
        (None, None, [], []),
    ],
)
def test_markers(term, designation, genders, numbers):
    m = markers.parse(term)
    assert (m.designation, m.genders, m.numbers) == (designation, genders, numbers)


def test_marker_brackets():
    m = markers.parse("Orientierung (einer Kurve) f")
    assert (m.designation, m.usage_info) == ("Orientierung", "einer Kurve")
    m = markers.parse("field &lt;physics&gt;, noun")
    assert (m.designation, m.domain, m.part_of_speech) == ("field", "physics", "noun")
    m = markers.parse("vector <see IEV 102-03-04>, 접두사")
    assert (m.designation, m.related_refs, m.is_prefix) == ("vector", ["102-03-04"], True)
    assert [x.designation for x in markers.parse_lines("a, f\n\nb, n")] == ["a", "b"] and markers.parse_lines(None) == []


@pytest.mark.parametrize(
    "cell, expected",
    [
        ("text<p>Note 1 to entry: one<p>Note 2 to entry: two", ("text", [], ["one", "two"])),
        ("text<p>EXAMPLE an example", ("text", ["an example"], [])),
        ("text<p><NOTE/>1 – one<p><NOTE/>2 – two", ("text", [], ["one", "two"])),
        ("text<p>NOTE 1 - one<p>NOTE 2 - two", ("text", [], ["1 - one", "2 - two"])),
        ("texte<p>Note 1 à l'article: une", ("texte", [], ["une"])),
        ("texte<p>Note 1 à l’article: une", ("texte<p>Note 1 à l’article: une", [], [])),
        ("Note 1 to entry: Example: of x", (None, [], ["Example: of x"])),
        ("EXAMPLE Example: x", (None, ["", "x"], [])),
        ("", (None, [], [])),
        (None, (None, [], [])),
    ],
)
def test_definition(cell, expected):
    assert definition.split(cell) == expected


@pytest.mark.parametrize(
    "citation, expected",
    [
        ("IEC 62302:2007, 3.2, modified – math", "3.2"),
        ("ITU RR 139", "139"),
        ("JCGM VIM 2.1", "2.1"),
        ("ISO 80000-10:2009, item 10-2.b,", "item 10-2.b"),
        ("IEC 80000-13:2008, 13-9", "13-9"),
        ("702-09-44 MOD", "702-09-44"),
        ("see figure 466-6", None),
        ("IEC 60050", None),
        (None, None),
    ],
)
def test_clause(citation, expected):
    assert clauses.clause(citation) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ('See <a href="IEV121-02-02">121-02-02</a>', "See {{urn:iec:std:iec:60050-121-02-02, 121-02-02}}"),
        ("See <a href=IEV121-02-03>No end tag", "See {{urn:iec:std:iec:60050-121-02-03, No end tag}}"),
        ("See <a href=IEV 102-01-10>IEV 102-01-10</a>", "See {{urn:iec:std:iec:60050-102-01-10, IEV 102-01-10}}"),
        ('<a href="103-05-02">adjective</a>', "{{urn:iec:std:iec:60050-103-05-02, adjective}}"),
        ("<i>f</i>(<i>t</i>)", "stem:[f](stem:[t])"),
        ("<i>a longer phrase</i>", "_a longer phrase_"),
        ("x<sup>2</sup><sub></sub>", "x^2^"),
        ("<b>important</b>", "*important*"),
        ("line1<br>line2", "line1\nline2"),
        ("<ul><li>a<li>b</ul>", "* a\n* b"),
        ('<font style="x sans-serif">c</font><font>d</font>', "`c`d"),
        ('<a href="http://x.example">y</a><!-- no -->', "http://x.example[y]"),
        ('<simg type="negative"/$file/103-01-02en.gif>', "image::/assets/images/parts/103/103-01-02en.gif[]"),
        ('<simg t="n"/$file/a.gif><p><b> Figure  1  –  Shape </b></p>', "image::/assets/images/parts/103/a.gif[Figure 1 - Shape ]"),
        ("x < 5 V, y > 3", "x < 5 V, y > 3"),
        ("no tag", "no tag"),
        (None, None),
    ],
)
def test_markup(html, expected):
    assert adoc.convert(html, "103") == expected


def test_named_reference():
    assert adoc.convert("<a href=IEV 102-01-10>IEV 102-01-10</a>", "103", {"102-01-10": "set"}.get) == "{{urn:iec:std:iec:60050-102-01-10, set}}"


def test_paragraphs_and_content():
    for typed in ("Hello<br>world", "Hello<p>world", "Hello\\nworld", "Hello\\n\\n\\nworld", "Hello<br/>world", "Hello<br />world"):
        assert adoc.paragraphs(typed) == "Hello\n\nworld"
    assert adoc.content("<!-- c -->a &alpha; b", "1") == "a stem:[alpha] b"
    assert adoc.content("<b>a</b> &alpha;", "1") == "*a* α"
    assert adoc.content("a &alpha; b", "1") == "a stem:[alpha] b"
    assert adoc.content(None, "1") == "" and adoc.content("", "1") == ""


def test_formulas():
    assert math.asciimath("<math><mfrac><mn>1</mn><mi>x</mi></mfrac></math>") == "(1)/(x)"
    assert math.asciimath("<math><msubsup><mo>∫</mo><mn>0</mn><mn>1</mn></msubsup></math>") == "int_(0)^(1)"
    assert math.asciimath("<math><mtable></mtable></math>") == ""
    assert math.formulas("a <math><mi>x</mi></math> b") == "a stem:[x] b"
    assert math.formulas("a <math><mtable/></math>b") == "a b"
    assert math.formulas("<i>x</i><sub>1</sub>&beta;") in ("stem:[x]~1~stem:[beta]", "stem:[x]~1~β")
    assert math.formulas(None) is None and math.formulas("plain") == "plain"


def test_tree_keeps_what_it_cannot_place():
    assert serialise(parse("<u>a</u>").children[0]) == "<u>a</u>"
    assert parse("</p>a<p>b<p>c").text == "abc"


PAGE = """<html><body><table><tr><td>menu</td></tr></table><table>
<tr><td></td><td></td><td><b>103-01-02</b></td></tr>
<tr><td><div align="center"><font color="#800080">en</font></div></td><td></td><td><b>functional</b>, noun</td></tr>
<tr><td></td><td></td><td>function of a <i>f</i></td></tr>
<tr><td><hr></td></tr>
<tr><td><div align="center"><font color="#800080">de</font></div></td><td></td><td>Funktional, n</td></tr>
<tr><td><div align="center"><font color="#800080">nl</font></div></td><td><font color="#800080">BE</font></td><td><b>x</b></td></tr>
<tr><td><div align="center"><font color="#800080">nl</font></div></td><td><font color="#800080">nl</font></td><td><b>y</b></td></tr>
<tr><td></td><td></td><td><img src="ecblank.gif"></td></tr>
</table></body></html>"""


def test_page():
    got = {e["language"]: e for e in pages.parse_page(PAGE, "103-01-02")}
    assert got["eng"] == {"language": "eng", "terms": ["functional"], "areas": [None], "definition": "function of a stem:[f]"}
    assert got["deu"]["terms"] == ["Funktional, n"] and got["deu"]["definition"] is None
    assert got["nld"]["terms"] == ["x", "y"] and got["nld"]["areas"] == ["be", "nl"]
    assert pages.parse_page(PAGE, "999-99-99") is None and pages.parse_page(None, "1") is None and pages.parse_page("", "1") is None
    assert pages.area_links('<a href="x?part=103"> A  b </a><a href="part=103">c</a><a href="part=9"> </a>') == [("103", "A b")]
    assert pages.section_cells("<td>Section 103-01: One</td><td>Section 103-01: Two</td><td>x</td>") == [("103-01", "One")]


@pytest.mark.parametrize(
    "text",
    ["<b>" * 20_000 + "x", "<table><tr><td>" * 5_000 + "x", "<math>" + "<mrow>" * 5_000 + "x", "<" * 30_000, ", f" * 20_000, "\n" * 50_000, "<ul><li>" * 4_000, "(" * 20_000, "Note 1 to entry: " * 3_000, "a&" * 20_000],
    ids=["bold", "tables", "formula", "open", "markers", "lines", "lists", "brackets", "notes", "ampersands"],
)
def test_very_long_and_deep_cells_are_read(text):
    assert adoc.content(text, "103") is not None and markers.parse(text).designation is not None
    assert attributes.parse(text) is not None and definition.split(text) is not None
    assert parse(text).name == "#root"


def test_end_tags_beyond_the_depth_close_nothing_above():
    from glossweave.markup.tree import DEEPEST

    deep = "<i>" + "<b>" * (2 * DEEPEST) + "x" + "</b>" * (2 * DEEPEST) + "y</i>z"
    i, z = parse(deep).children
    assert i.children[-1] == "y" and z == "z" and parse(deep).text == "xyz"
