"""Citations and the entries they mean."""

import pytest

from glossweave.llm import canonical_list as C
from glossweave.llm import citation_words as W
from glossweave.operators.packed import citations
from glossweave.session import table

ENTRIES = [
    (1, "IEC", None, None, "International Electrotechnical Vocabulary", "Vocabulaire Électrotechnique International", "IEV"),
    (2, "IEC", "66269", 1985, "Bushings and accessories for sealed laboratories", "Traversées et accessoires pour laboratoires scellés", "IEC 66269:1985"),
    (3, "IEC", "66269", 1993, "Bushings and accessories for sealed laboratories", None, "IEC 66269:1993"),
    (4, "IEC", "66889-1", 2016, "Couplers, general terms for marine harbour cranes", None, "IEC 66889-1:2016"),
    (5, "ISO/IEC", "97975", 1996, "Filters in portable storage yards", "Filtres dans les parcs de stockage portatifs", "ISO/IEC 97975:1996"),
    (6, "ITU-T", "K.1962", 2000, "Cables for swing bridges", None, "ITU-T Recommendation K.1962 (2000)"),
    (7, "IEC/TR", "68179", 2022, None, None, "IEC/TR 68179:2022"),
    (8, "ISO/TS", "96015", 1988, "Filters for portable storage yards", None, "ISO/TS 96015:1988"),
    (9, "CISPR", "93-1", 2018, "Relays for marine signal boxes", None, "CISPR 93-1:2018"),
    (10, "IEC", "66889", 2010, "Meters in cold stores", None, "IEC 66889:2010"),
]


@pytest.fixture(scope="module")
def refs():
    return C.ReferenceList(ENTRIES, PAIRS, W.WORDING)


PAIRS = [(n, a) for n, many in W.ALIASES.items() for a in many]


@pytest.mark.parametrize(
    "citation, ref",
    [
        ("IEC 66269:1985, 3.2", 2), ("CEI 66269 (1993)", 3), ("I.E.C. 66 269 ed. 1985 MOD", 2), ("ＩＥＣ-６６２６９：1993", 3), ("IEC Publ. 66269-1985", 2), ("IEC 6626g", 0),
        ("IEC 66269", 0), ("IEC 66269:1999", 0), ("МЭК 66889–1 : 2016", 4), ("IEC 66889-1-2016, 2.21", 4), ("Iec 66889-l, modified", 4), ("IEC 66889-2:2016", 0), ("IEC 66889, 1.2", 10), ("IEC 66889-2010", 10),
        ("ISO/IEC 97975", 5), ("IEC/ISO97975:1996", 5), ("ISO 97975", 0), ("iso-cei 97975", 5), ("ISO/IEC 979750", 0), ("ISO/IEC 97O75", 0),
        ("ITU-T Rec. K.1962:2000", 6), ("Recommandation UIT-T  K.1962 (2000), 6.25", 6), ("ITUT K.1963", 0), ("IEC Technical Report 68179", 7), ("IEC 68179", 0), ("IEC-TR 68179: 2022", 7),
        ("CISPR 93-1", 9), ("CEI CISPR 93-1:2018 (99.1)", 9), ("C.I.S.P.R. 93-1", 9),
        ("iev 932-04-10", 1), ("918-05-115, modifié", 1), ("International Electrotechnical Vocabulary MOD", 1), ("vocabulaire électrotechnique international", 1), ("IEV", 1), ("see VEI, modified", 1), ("IEVA", 0),
        ("see Couplers, general terms for marine harbour cranes", 4), ("COUPLRES, GENEARL TERMS FOR MARINE HARBOUR CRANSE, modified – x", 4), ("couplers, general terms for marine harbour cranes (2016)", 4), ("Couplers, general terms for marine harbour cranes (2017)", 0),
        ("Bushings and accessories for sealed laboratories", 0), ("Bushnigs and accessories for sealed laboratories (1993)", 3), ("Filters in portable storage yards", 5), ("Filters for portable storage yards", 8), ("Filtesr in portable storage yadrs", 5), ("Filters ni portable storage yards", 5),
        ("Filters in portable mining hoists", 0), ("working group decision", 0), ("private communication", 0), ("", 0), (None, 0), ("?", 0), ("x" * 50_000, 0), ("IEC " * 5_000, 0),
    ],
)
def test_answers(refs, citation, ref):
    assert C.decide(refs.candidates(citation))[0] == [ref]


@pytest.mark.parametrize(
    "citation, meant",
    [
        ("IEC 66889-1:2016 adapted using ISO/IEC 97975:1996", [4, 5]), ("see 918-01-02 and IEC 66889", [10]), ("IEC 66889:2010 (IEV)", [1, 10]),
        ("Cables for swing bridges, IEC 66889-1", [4, 6]), ("IEC 66889 with IEC 66269:1999", [10]), ("ISO/IEC 66889", [0]),
    ],
)
def test_every_mention_counts_and_the_longest_wins(refs, citation, meant):
    assert C.decide(refs.candidates(citation))[0] == meant


def test_short_titles_are_compared():
    refs = C.ReferenceList([(1, "X", "7", None, "Quality management systems", None, "X 7"), (2, "X", "8", None, "Quality management", None, "X 8"), (3, "X", "9", None, "Thermodynamics", None, "X 9")])
    for citation, ref in [("Qualty managment systems", 1), ("Qualty managment", 2), ("Termodynamics", 3), ("Quality of life", 0), ("systems", 0)]:
        assert C.decide(refs.candidates(citation))[0] == [ref], citation


def test_a_title_of_several_works_is_ambiguous():
    refs = C.ReferenceList([(1, "X", "7", 1990, "Bridges and tunnels", None, "X 7"), (2, "X", "8", 2001, "Bridges and tunnels", None, "X 8"), (3, "X", "9", None, "Roads", None, "X 9")])
    assert C.decide(refs.candidates("Bridges and tunnels")) == ([0], 1.0, "ambiguous")
    assert C.decide(refs.candidates("Bridges and tunnles"))[0::2] == ([0], "ambiguous")
    assert C.decide(refs.candidates("Bridges and tunnels (2001)"))[0] == [2] and C.decide(refs.candidates("X 9 and Bridges and tunnels"))[0] == [3]


def test_publishers_that_no_one_typed_in():
    """Names, order of names and numbers come from the list and the aliases alone."""
    refs = C.ReferenceList(
        [(1, "DIN/VDE", "0100-7", 2002, None, None, "DIN VDE 0100-7:2002"), (2, "ГОСТ", "Р 51321", None, "Устройства распределения", None, "ГОСТ Р 51321"), (3, "JIS", "C 8201", None, None, None, "JIS C 8201"), (4, None, "RFC 2119", None, None, None, "RFC 2119")],
        [("JIS", "Japanese Industrial Standard"), ("VDE", "Verband Deutscher Elektrotechniker"), (None, "x"), ("JIS", None)],
        C.Wording(fillers=("Norm",)),
    )
    cases = [
        ("DIN VDE 0100-7", 1), ("VDE-DIN 0100-7:2002", 1), ("DIN Verband Deutscher Elektrotechniker Norm 0100-7", 1), ("DIN 0100-7", 0), ("DIN/VDE 0100", 0), ("гост р 51321", 2),
        ("Устройства распределенния", 2), ("japanese industrial standard C-8201", 0), ("Japanese Industrial Standard C8201, 4.1", 3), ("see RFC 2119", 4), ("ARFC 2119", 0),
    ]
    for citation, ref in cases:
        assert C.decide(refs.candidates(citation))[0] == [ref], citation


def test_near_words_brute_force():
    import random

    r = random.Random(3)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(1, 12))) for _ in range(400)]
    index = C.WordIndex(words)
    for w in words[:150]:
        i = r.randrange(len(w))
        for typed in (w, w[:i] + w[i + 1 :], w[:i] + "x" + w[i:], w[:i] + w[i + 1 : i + 2] + w[i : i + 1] + w[i + 2 :]):
            want = {v: x for v in index.words if (x := C.likeness(typed, v)) and C.WordIndex.pairs(typed) & C.WordIndex.pairs(v)}
            assert index.near(typed) == want


def found(rows, refs):
    return C.found(rows, refs, W.aliases(rows.sparkSession), W.WORDING)


def publications(spark, entries=ENTRIES):
    return spark.createDataFrame(entries, "ref_id long, publisher string, doc_number string, edition_year int, title_en string, title_fr string, canonical string")


def export(spark, sources):
    return spark.createDataFrame([(i, s, 5) for i, s in enumerate(sources)], "export_id long, source string, ref_id int")


def test_rows(spark):
    rows = export(spark, ["IEC 66269:1985; own words|918-01-02 ; IEC 66269:1985, 4.1", None, " ", "own words\nmore words"])
    got = {tuple(r) for r in found(rows, publications(spark)).collect()}
    assert got == {(0, 2), (0, 0), (0, 1), (3, 0)}
    assert {tuple(r) for r in found(rows, publications(spark, [])).collect()} == {(0, 0), (3, 0)}
    assert found(rows.limit(0), publications(spark)).count() == 0


@pytest.mark.parametrize("block", [200, 12])
def test_blocks_give_the_same(spark, data, monkeypatch, block):
    extra = ["IEC 66269:1985 adapted using ISO 9000:2015", "see 918-01-02 with IEC 66889-1", None, " ", "x", "Filters in portable storge yards"]
    rows = table(spark, data, "iev_export").select("export_id", "source").unionByName(export(spark, extra).select("export_id", "source"))
    refs = table(spark, data, "publications").unionByName(publications(spark))
    columns = ["export_id", "pos", "value_text", "ref_id", "certainty", "found_by"]
    whole = C.resolve_citations(rows, refs, W.aliases(spark), W.WORDING).select(columns)
    want = sorted(map(tuple, whole.collect()))
    monkeypatch.setattr(C, "BLOCK_ENTRIES", block)
    monkeypatch.setattr(C, "TASK_BYTES", 8000)
    assert sorted(map(tuple, C.resolve_citations(rows, refs, W.aliases(spark), W.WORDING).collect())) == want


def test_every_citation_is_answered(spark, data):
    rows = table(spark, data, "iev_export")
    got = C.resolve_citations(rows, table(spark, data, "publications"), W.aliases(spark), W.WORDING)
    assert got.select("export_id", "pos", "value_text").distinct().count() == citations(rows).distinct().count()
    assert C.resolve_citations(rows, table(spark, data, "publications")).where("ref_id > 0").count() > 0


def test_likeness_brute_force():
    from functools import lru_cache

    @lru_cache(None)
    def d(a, b):
        if not a or not b:
            return len(a) + len(b)
        best = min(d(a[:-1], b) + 1, d(a, b[:-1]) + 1, d(a[:-1], b[:-1]) + (a[-1] != b[-1]))
        if len(a) > 1 and len(b) > 1 and a[-1] == b[-2] and a[-2] == b[-1]:
            best = min(best, d(a[:-2], b[:-2]) + 1)
        return best

    import random

    r = random.Random(1)
    for _ in range(200):
        a, b = ("".join(r.choice("abc") for _ in range(r.randint(1, 6))) for _ in "ab")
        want = 1 - d(a, b) / max(len(a), len(b))
        assert C.likeness(a, b) == pytest.approx(want if d(a, b) <= C.edits(max(len(a), len(b))) else 0)
