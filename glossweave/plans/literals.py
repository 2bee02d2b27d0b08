"""Queries over fixed inputs, each checked against outputs that are written down here and come from no table of the library."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossweave.functions import citation_rules as cite
from glossweave.functions import labels, text
from glossweave.markup import adoc
from glossweave.parsers.attributes import attributes
from glossweave.parsers.clauses import clause_of
from glossweave.parsers.definition import definition_parts
from glossweave.parsers.markers import markers
from glossweave.parsers.supersession import superseded

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _value(x) -> str:
    return "CAST(NULL AS VARCHAR)" if x is None else "'" + x.replace("'", "''") + "'"


def literal(rows: list[tuple], names: str):
    """Registers a function of the input column ``given`` under its own name; the SQL is the table itself."""

    def add(f):
        def run(spark, d):
            given = spark.createDataFrame([(g,) for g in dict.fromkeys(r[0] for r in rows)], "given string")
            return f(given)

        QUERIES[f.__name__] = run
        listed = ", ".join("(" + ", ".join(map(_value, r)) + ")" for r in rows)
        ORACLE[f.__name__] = f"SELECT * FROM (VALUES {listed}) t(given, {names})"
        return f

    return add


def _joined(c):
    return F.array_join(c, "|")


# Inputs and outputs that any engine of these operators must agree on.


@literal(
    [
        ("702-01-02 MOD,ITU-R Rec. 431 MOD", "702-01-02 MOD|ITU-R Rec. 431 MOD"),
        ("161-06-01 MOD. ITU RR 139 MOD", "161-06-01 MOD|ITU RR 139 MOD"),
        ("725-12-50, ITU RR 11", "725-12-50|ITU RR 11"),
        ("705-02-01, 702-02-07", "705-02-01|702-02-07"),
        ("702-09-44 MOD, 723-07-47, voir 723-10-91", "702-09-44 MOD|723-07-47|voir 723-10-91"),
        ("IEC 62303:2008, 3.1, modified and IEC 62302:2007, 3.2; IAEA 4", "IEC 62303:2008, 3.1, modified|IEC 62302:2007, 3.2|IAEA 4"),
        ("CEI 62303:2008, 3.1, modifiée et CEI 62302:2007, 3.2; AIEA 4", "CEI 62303:2008, 3.1, modifiée|CEI 62302:2007, 3.2|AIEA 4"),
    ],
    "parts",
)
def literal_source_split(given):
    return given.select("given", _joined(cite.split_field(F.col("given"))).alias("parts"))


@literal(
    [
        ("IEC 62302:2007", "IEC", "62302:2007"), ("IEC 60050-121", "IEC", "60050-121"), ("IEC 60050-121:2003", "IEC", "60050-121:2003"), ("ISO 1087-1:2000", "ISO", "1087-1:2000"),
        ("ISO 9000", "ISO", "9000"), ("ISO/IEC 2382:2015", "ISO/IEC", "2382:2015"), ("ISO/IEC Guide 2", "ISO/IEC Guide", "2"), ("ISO/IEC/IEEE 24765:2010", "ISO/IEC/IEEE", "24765:2010"),
        ("ISO/TS 14812:2022", "ISO/TS", "14812:2022"), ("ISO/TR 9593-4:1992", "ISO/TR", "9593-4:1992"), ("IEC/IEEE 80005-1:2019", "IEC/IEEE", "80005-1:2019"),
        ("IEC CISPR 16-1:2003", "IEC CISPR", "16-1:2003"), ("IEC Guide 115", "IEC Guide", "115"), ("IAEA 4", "IAEA", "4"), ("IEV", "IEV", None), ("JCGM VIM", "JCGM", "VIM"),
        ("ITU-T Recommendation F.791 (11/2015)", "ITU-T Recommendation", "F.791 (11/2015)"), ("ITU-T Recommendation F.791", "ITU-T Recommendation", "F.791"),
        ("ITU-R Recommendation 592", "ITU-R Recommendation", "592"), ("ITU-R RR", "ITU-R", "RR"),
    ],
    "source, id",
)
def literal_source_ref(given):
    return given.select("given", cite.publisher_of(F.col("given")).alias("p")).select("given", "p.source", "p.id")


@literal(
    [
        ("IEC 62302:2007, 3.2, modified – math", "3.2"), ("ITU RR 139", "139"), ("JCGM VIM 2.1", "2.1"), ("ISO 80000-10:2009, item 10-2.b,", "item 10-2.b"),
        ("IEC 80000-13:2008, 13-9", "13-9"), ("702-09-44 MOD", "702-09-44"), ("see figure 466-6", None), ("IEC 60050", None),
    ],
    "clause",
)
def literal_source_clause(given):
    return given.select("given", clause_of(F.col("given")).alias("clause"))


@literal(
    [
        ("IEC 62302:2007, 3.2, modified – new text", "modified", "new text"), ("702-09-44 MOD", "modified", None), ("CEI 62303:2008, 3.1, modifié – note ajoutée", "modified", "note ajoutée"),
        ("IAEA 4", "identical", None),
    ],
    "status, modification",
)
def literal_source_relationship(given):
    return given.select("given", cite.relationship_of(F.col("given")).alias("r")).select("given", "r.status", "r.modification")


@literal(
    [
        ("731-03-24:1991-10-01", "731-03-24"), ("731-03-24:1991-10", "731-03-24"), ("731-03-24:1991", "731-03-24"), ("IEV 731-03-24:1991", "731-03-24"), ("731-03-24 : 1991", "731-03-24"),
        (" ", None), ("NOT IEV 731-03:1991", None),
    ],
    "ref",
)
def literal_supersession(given):
    return given.select("given", F.get(superseded(F.col("given")), F.lit(0))["id"].alias("ref"))


@literal(
    [
        ("Gleichheit, f", "Gleichheit", "feminine", "", None, None, None), ("једнакост, ж јд", "једнакост", "feminine", "singular", None, None, None), ("скуп, м јд", "скуп", "masculine", "singular", None, None, None),
        ("LED-Package, f, n, m", "LED-Package", "masculine|neuter|feminine", "", None, None, None), ("x, m/f", "x", "masculine|feminine", "", None, None, None), ("données, f pl", "données", "feminine", "plural", None, None, None),
        ("stem:[n]-dimensionaler Vektorraum, m", "stem:[n]-dimensionaler Vektorraum", "masculine", "", None, None, None), ("equality, defined as relation", "equality, defined as relation", "", "", None, None, None),
        ("Orientierung (einer Kurve) f", "Orientierung", "feminine", "", None, "einer Kurve", None), ("field &lt;physics&gt;, noun", "field", "", "", "physics", None, "noun"),
    ],
    "designation, genders, numbers, domain, usage_info, part_of_speech",
)
def literal_markers(given):
    m = given.select("given", markers(F.col("given")).alias("m"))
    return m.select("given", "m.designation", _joined("m.genders").alias("genders"), _joined("m.numbers").alias("numbers"), "m.domain", "m.usage_info", "m.part_of_speech")


@literal(
    [
        ("f", "f", "singular", None, None, None, None), ("(m)", "m", "singular", None, None, None, None), ("[n]", "n", "singular", None, None, None, None), ("f pl", "f", "plural", None, None, None, None),
        ("(pl)", None, "plural", None, None, None, None), ("adj", None, None, "adj", None, None, None), ("名詞", None, None, "noun", None, None, None), ("형용사", None, None, "adj", None, None, None),
        ("Adjektiv", None, None, "adj", None, None, None), ("mf", None, None, None, None, None, None), ("m, <traction>", "m", "singular", None, "traction", None, None), ("＜ 通信 ＞", None, None, None, "通信", None, None),
        ("noun US", None, None, "noun", None, "US", None), ("Präfix", None, None, None, None, None, "Präfix"),
    ],
    "gender, number, part_of_speech, usage_info, geographical_area, prefix",
)
def literal_attributes(given):
    return given.select("given", attributes(F.col("given")).alias("a")).select("given", "a.gender", "a.number", "a.part_of_speech", "a.usage_info", "a.geographical_area", "a.prefix")


@literal(
    [
        ("text<p>Note 1 to entry: one<p>Note 2 to entry: two", "text", "", "one|two"), ("text<p>EXAMPLE an example", "text", "an example", ""), ("text<p><NOTE/>1 – one<p><NOTE/>2 – two", "text", "", "one|two"),
        ("text<p>NOTE 1 - one<p>NOTE 2 - two", "text", "", "1 - one|2 - two"), ("texte<p>Note 1 à l'article: une", "texte", "", "une"), ("texte<p>Note 1 à l’article: une", "texte<p>Note 1 à l’article: une", "", ""),
        ("Note 1 to entry: Example: of x", None, "", "Example: of x"), ("EXAMPLE Example: x", None, "|x", ""),
    ],
    "definition, examples, notes",
)
def literal_definition(given):
    p = given.select("given", definition_parts(F.col("given")).alias("p"))
    return p.select("given", "p.definition", _joined("p.examples").alias("examples"), _joined("p.notes").alias("notes"))


@literal(
    [
        ('See <a href="IEV121-02-02">121-02-02</a>', "See {{urn:iec:std:iec:60050-121-02-02, 121-02-02}}"), ("See <a href=IEV121-02-03>No end tag", "See {{urn:iec:std:iec:60050-121-02-03, No end tag}}"),
        ("See <a href=IEV 102-01-10>IEV 102-01-10</a>", "See {{urn:iec:std:iec:60050-102-01-10, IEV 102-01-10}}"), ("<i>f</i>(<i>t</i>)", "stem:[f](stem:[t])"), ("<i>a longer phrase</i>", "_a longer phrase_"),
        ("x<sup>2</sup><sub></sub>", "x^2^"), ("<b>important</b>", "*important*"), ("line1<br>line2", "line1\nline2"), ("<ul><li>a<li>b</ul>", "* a\n* b"),
        ('<font style="x sans-serif">c</font><font>d</font>', "`c`d"), ('<a href="http://x.example">y</a><!-- no -->', "http://x.example[y]"),
        ('<simg type="negative"/$file/103-01-02en.gif>', "image::/assets/images/parts/103/103-01-02en.gif[]"), ('<simg t="n"/$file/a.gif><p><b> Figure  1  –  Shape </b></p>', "image::/assets/images/parts/103/a.gif[Figure 1 - Shape ]"),
        ("x < 5 V, y > 3", "x < 5 V, y > 3"), ("no tag", "no tag"),
    ],
    "markup",
)
def literal_markup(given):
    return given.select("given", adoc.markup_of(F.col("given"), F.lit("103")).alias("markup"))


@literal(
    [("&Omega;", "Ω"), ("a&nbsp;b", "a b"), ("&#8211;", "–"), ("&#x2264;", "≤"), ("&lt;b&gt; &amp; &quot;c&quot;", '<b> & "c"'), ("&eacute;t&eacute;", "été"), ("&unknown; &", "&unknown; &"), ("plain", "plain")],
    "decoded",
)
def literal_entities(given):
    return given.select("given", text.decode_entities(F.col("given")).alias("decoded"))


@literal(
    [
        ("Standard", "valid", "valid", "standard"), ("standard", "valid", "valid", "standard"), ("Published", None, "valid", "published"), ("Effective", None, "valid", "effective"), ("Draft", None, "draft", "draft"),
        ("Not Valid", None, "notValid", "not valid"), ("Superseded", None, "superseded", "superseded"), ("Retired", None, "retired", "retired"), ("认可的", None, "valid", "admitted"), ("допустимый", None, "valid", "admitted"),
        ("admitido", None, "valid", "admitted"), ("首选的", None, "valid", "preferred"), ("suositettava", None, "valid", "preferred"), ("рекомендуемый", None, "valid", "preferred"), ("preferente", None, "valid", "preferred"),
        ("", None, "valid", None),
    ],
    "sheet_status, termbase_status, classification",
)
def literal_status(given):
    c = F.col("given")
    return given.select("given", labels.sheet_status(c).alias("sheet_status"), labels.termbase_status(c).alias("termbase_status"), labels.classification(c).alias("classification"))
