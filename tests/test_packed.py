"""Packed fields."""

import pytest
from hypothesis import given
from hypothesis import strategies as st

from collections import Counter

from glossweave.operators.packed import FieldParser, Grammar, citations, count_starts, learned_starts, split_packed

SEEN = ["IEC 1:2000", "iec 7, 3.1", "ISO 2 (a; b)", "ISO 9", "IEV 918-01-02", "IEV 918-05-02 MOD", "I.E.V. 918-01-02", "918-05-03", "911-01-04", "911-01-05, modified – note 1, 2 and 3 added",
        "Internat. Electrotechn. Comm. 5, definition 3.1", "Internat. Electrotechn. Comm. 6", "see IEC 2", "see ISO 3", "voir IEC 2", "voir IEC 3"]


def learnt(values):
    begins, inside = Counter(), Counter()
    for v in values:
        count_starts(v, FieldParser(Grammar(starts=frozenset())), begins, inside)
    return frozenset(k for k, n in begins.items() if k and n >= 2 and n >= inside[k])


P = FieldParser(Grammar(starts=learnt(SEEN)))


def values(s):
    return [i.value for i in P.parse(s)]


@pytest.mark.parametrize(
    "field, expected",
    [
        ("IEC 67622, 13.1", ["IEC 67622, 13.1"]),
        ("IEV 918-01-43, I.E.V. 918-05-27, Iec 66688-4-2014, 2.21", ["IEV 918-01-43", "I.E.V. 918-05-27", "Iec 66688-4-2014, 2.21"]),
        ("IEC 1:2000 and ISO 2 et 918-01-02 und IEC65533", ["IEC 1:2000", "ISO 2", "918-01-02", "IEC65533"]),
        ("iev 911-02-36, and Internat. Electrotechn. Comm. 64777:2010 (18.31)", ["iev 911-02-36", "Internat. Electrotechn. Comm. 64777:2010 (18.31)"]),
        ('"IEC 1; note added"; “a, b”|«\xa0c\xa0»', ["IEC 1; note added", "a, b", "c"]),
        ('"x ""<i>L</i>"" y";z', ['x "<i>L</i>" y', "z"]),
        ('IEC 1, modified – math element "<i>L;</i>" added', ['IEC 1, modified – math element "<i>L;</i>" added']),
        ("IEC 1 (first; second) ;; ISO/IEC 2", ["IEC 1 (first; second)", "ISO/IEC 2"]),
        ("a<br>b<br/>c\nd • e & f &amp; g、h；i / j", list("abcdefghij")),
        ("Couplers, general terms for x and y", ["Couplers, general terms for x and y"]),
        ("IEC 1 – the words A, B and C left out", ["IEC 1 – the words A, B and C left out"]),
        ("  ; ;\n| ", []),
        ("", []),
        (None, []),
        ("see IEC 1, voir IEC 2", ["see IEC 1", "voir IEC 2"]),
    ],
)
def test_split(field, expected):
    assert values(field) == expected


def test_malformed_quotes_fall_back():
    got = list(P.parse('"IEC 1; IEC 2; "ISO 3"'))
    assert [(i.value, i.error) for i in got] == [('"IEC 1', "unclosed_quote"), ("IEC 2", None), ("ISO 3", None)]
    got = list(P.parse('"IEC 1; ISO 2'))
    assert [(i.value, i.error) for i in got] == [('"IEC 1', "unclosed_quote"), ("ISO 2", None)]
    got = list(P.parse("IEC 1 (a; ISO 2"))
    assert [(i.value, i.error) for i in got] == [("IEC 1 (a", "unclosed_bracket"), ("ISO 2", None)]
    assert values("a (b (c; d) e; f") == ["a (b (c; d) e", "f"]


@given(st.text(alphabet='ab "“”«»();|,\n&<br>/1', max_size=60))
def test_nothing_is_lost(s):
    items = list(P.parse(s))
    assert [i.pos for i in items] == list(range(1, len(items) + 1))
    assert all(i.value == i.value.strip() and i.value for i in items)
    kept = "".join(i.value for i in items)
    assert kept.count("a") == s.count("a") and kept.count("1") == s.count("1")


@given(st.lists(st.text(alphabet="abc123 .:", min_size=1, max_size=12).filter(lambda x: x.strip()), min_size=1, max_size=6), st.sampled_from(["; ", "\n", " | ", "<br>"]))
def test_round_trip_of_quoted_values(items, separator):
    clean = [x.strip() for x in items]
    assert values(separator.join(f'"{x}"' for x in clean)) == clean


def test_rows(spark):
    df = spark.createDataFrame([(1, "a; b", "x", 9), (1, "a; b", "x", 9), (2, None, "y", 9), (3, " ", "z", 9), (4, "c; " * 20_000, "w", 9)], "export_id long, source string, value_text string, pos int")
    got = citations(df)
    assert got.where("export_id = 1").count() == 4 and got.where("export_id in (2, 3)").count() == 0 and got.where("export_id = 4").count() == 20_000
    assert split_packed(df.limit(0), "source", ["export_id"]).count() == 0


def test_long_and_deep_fields():
    assert values("(" * 100_000) == ["(" * 100_000] and values("(" * 50_000 + ")" * 50_000 + ";x")[-1] == "x"
    assert len(values("“" * 100_000)) == 1 and len(values('"' * 100_001)) <= 2
    assert len(values("a; " * 100_000)) == 100_000 and values(" " * 200_000) == [] and len(values("," * 50_000 + "IEC 1")) == 1


def test_what_begins_a_value_is_learnt_from_the_column(spark):
    rows = ["red oak", "red ash; white elm", "white fir", "old, grey and tall pine", "red yew, white box and red fig; tall, grey bay", None, " ", "white oak, bark grey"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(rows)], "k int, v string")
    starts = learned_starts(df, "v")
    assert {"red", "white"} <= starts and not {"grey", "tall", "oak", "bark"} & starts
    assert starts == learned_starts(df.repartition(3), "v") == learnt(rows)
    got = [r.value_text for r in split_packed(df, "v", ["k"]).where("k in (4, 7)").orderBy("k", "pos").collect()]
    assert got == ["red yew", "white box", "red fig", "tall, grey bay", "white oak, bark grey"]
    assert learned_starts(df.limit(0), "v") == frozenset()
    every = split_packed(df, "v", ["k"], Grammar()).where("k = 3").orderBy("pos").collect()
    assert [r.value_text for r in every] == ["old", "grey", "tall pine"]
