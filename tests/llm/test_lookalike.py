"""Look-alike texts against brute force."""

import itertools
from collections import Counter

import pytest

from glossweave.llm import lookalike as L
from glossweave.session import table


@pytest.fixture(scope="module")
def tables(spark):
    return L.tables(spark)


SAME = [
    ("câble", "câble"), ("résiѕtance", "résistance"), ("ｒｅｌａｉｓ", "relais"), ("a b", "a b"), ("a　b", "a b"), ("so­ft", "soft"), ("​x﻿", "x"), ("per͏x", "perx"),
    ("Ω", "Ω"), ("Å", "Å"), ("µm", "μm"), ("eﬃcient", "efficient"), ("a‐b", "a-b"), ("a－b", "a-b"), ("ﾀﾞｲｵｰﾄﾞ", "ダイオード"), ("⼒矩", "力矩"), ("北", "北"), ("ﻻ", "لا"),
    ("함수", "함수"), ("ΙΙ", "II"), ("Α8", "A8"), ("пoтoк", "поток"), ("ІІ", "II"), ("m", "ⅿ"),
]
APART = [
    ("Cable", "cable"), ("résistance", "resistance"), ("4 m²", "4 m2"), ("half-wave", "half wave"), ("modern", "modem"), ("l", "1"), ("I", "l"), ("0", "O"), ("7 Å", "7 A"), ("ヂ", "チ"), ("a", "b"), ("a b", "ab"), ("ß", "B"), ("ł", "l"), ("x₂", "x2"), ("각가", "가까"),
]


@pytest.mark.parametrize("a, b", SAME)
def test_same(tables, a, b):
    assert L.skeleton_of(a, *tables) == L.skeleton_of(b, *tables)


@pytest.mark.parametrize("a, b", APART)
def test_apart(tables, a, b):
    assert L.skeleton_of(a, *tables) != L.skeleton_of(b, *tables)


def test_skeleton_of_a_skeleton(tables):
    for a, b in SAME + APART:
        for x in (a, b):
            once = L.skeleton_of(x, *tables)
            assert L.skeleton_of(once, *tables) == once


def pairs(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "i long, g string, t string, id_a string")
    return [(r.g, r.id_a, r.id_b) for r in L.lookalike_pairs(df, "i", ["g"], "t").collect()]


def test_pairs_brute_force(spark, tables):
    texts = [x for ab in SAME[:12] + APART for x in ab] + [None, "", "​", "x" * 20_000, "х" + "x" * 19_999]
    rows = [(i, "eng" if i % 7 else "fra", t) for i, t in enumerate(texts * 2)]
    want = {
        (g, a, b)
        for (a, g, s), (b, h, t) in itertools.combinations(rows, 2)
        if g == h and s is not None and t is not None and s != t and L.skeleton_of(s, *tables) == L.skeleton_of(t, *tables)
    }
    got = pairs(spark, rows)
    assert set(got) == want and len(got) == len(want) and want


def test_edges(spark):
    assert pairs(spark, []) == []
    assert pairs(spark, [(1, None, "a"), (2, None, "а"), (3, "g", None)]) == []
    assert pairs(spark, [(1, "g", "a"), (1, "g", "а"), (2, "g", "a")]) == [("g", 1, 2)]
    copies = [(i, "g", "a") for i in range(400)] + [(1000, "g", "а")]
    assert len(pairs(spark, copies)) == 400


def test_classes_brute_force(spark, tables):
    texts = [x for ab in SAME[:12] + APART for x in ab] + [None, "", "​"]
    rows = [(i, "eng" if i % 7 else None, t) for i, t in enumerate(texts * 2)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "i long, g string, t string, skeleton string")
    got = {r.i: r for r in L.classes(df.drop("skeleton"), "i", ["g"], "t").collect()}
    assert len(got) == len(rows)
    for i, g, t in rows:
        same = [u for _, h, u in rows if h == g and t is not None and u is not None and L.skeleton_of(u, *tables) == L.skeleton_of(t, *tables)]
        assert got[i].n_links == sum(u != t for u in same) and got[i].n_spellings == len(set(same)), t
        assert got[i].plain == any(u == got[i].skeleton for u in same)


def test_classes_have_every_row_and_the_links_of_the_pairs(spark, data):
    localized, terms = table(spark, data, "localized_concepts"), table(spark, data, "terms")
    got = L.all_classes(localized, terms)
    assert got.count() == localized.count() + terms.count()
    links = {(r.field_name, r.id): r.n_links for r in got.where("n_links > 0").collect()}
    ends = Counter()
    for r in L.found(localized, terms).collect():
        ends.update([(r.field_name, r.id_a), (r.field_name, r.id_b)])
    # rows without a language have a class of their own, but no pairs
    unknown = {(r.field_name, r.id) for r in got.where("language_code is null").collect()}
    assert {k: n for k, n in links.items() if k not in unknown} == dict(ends)


def test_the_skeleton_is_computed_once(spark, data):
    L.found(table(spark, data, "localized_concepts"), table(spark, data, "terms"))
    df = L.found(table(spark, data, "localized_concepts"), table(spark, data, "terms"))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("ReusedExchange") >= 2


def test_found(spark, data):
    got = L.found(table(spark, data, "localized_concepts"), table(spark, data, "terms"))
    rows = got.collect()
    assert rows and len(set(rows)) == len(rows) and all(r.id_a < r.id_b for r in rows) and {r.field_name for r in rows} == {"term", "designation"}
    p = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in p and "NestedLoop" not in p
