"""Nested records as flat tables."""

import json

from glossweave.operators.nested import PAYLOAD, child_objects, flat, read_flat, table_sizes, tagged_rows, visit, write_tables
from glossweave.session import table

CONCEPT = {
    "id": "1-1-1",
    "tags": "one",
    "domains": {"concept_id": "area-1", "ref_type": "domain"},
    "related": [{"type": "supersedes", "ref": {"source": "IEV", "id": "2-2-2"}}],
    "data": {
        "domains": None,
        "localized_concepts": {
            "eng": {"language_code": "eng", "definition": [{"content": "d"}], "terms": [{"designation": "a"}, {"designation": None}, {"designation": "c"}], "notes": ["n"], "sources": {"origin": {"ref": {"id": "62"}}}},
            "fra": {"language_code": "fra", "terms": {"designation": "x"}},
            "deu": {"language_code": "deu", "terms": None},
        },
    },
}


def rows(spark, bodies):
    return spark.createDataFrame([(i, b, "x") for i, b in enumerate(bodies)], "record_id long, body string, pos string")


def test_children(spark):
    got = {tuple(r) for r in child_objects(rows(spark, [json.dumps(CONCEPT)])).collect()}
    assert got == {
        (0, "domain", "", 1, "area-1"),
        (0, "localized", "eng", 0, "eng"), (0, "localized", "fra", 0, "fra"), (0, "localized", "deu", 0, "deu"),
        (0, "term", "eng", 1, "a"), (0, "term", "eng", 2, ""), (0, "term", "eng", 3, "c"), (0, "term", "fra", 1, "x"),
    }


def test_list_of_localizations_and_repeats(spark):
    body = json.dumps({"localized_concepts": [{"language_code": "eng", "terms": [{"designation": "a"}]}]})
    assert child_objects(rows(spark, [body, body])).count() == 4


def test_bodies_without_rows(spark):
    whole = json.dumps(CONCEPT)
    bad = [None, "", "  ", whole[:-1], whole[: len(whole) // 2], "[1]", "7", '"x"', "[" * 100_000]
    assert child_objects(rows(spark, bad)).count() == 0
    assert child_objects(rows(spark, [])).count() == 0


def test_unexpected_kinds_count_as_absent():
    odd = {"domains": "x", "localized_concepts": {"eng": 5, "fra": {"language_code": None, "terms": ["t", 3, {"designation": 7}]}}, "related": [None]}
    assert [(r[0], r[4], r[5], r[6]) for r in visit(1, json.dumps(odd)) if r[0] != "record"] == [("localized", "fra", 0, "fra"), ("term", "fra", 1, "7")]


def test_links_and_payload(spark, tmp_path):
    bodies = rows(spark, [json.dumps(CONCEPT)])
    every = tagged_rows(bodies)
    parents = {r.pk: r.parent_pk for r in every.collect()}
    assert all(p is None or p in parents for p in parents.values()) and parents["0/l1/t2"] == "0/l1" and parents["0/l1"] == "0"
    assert flat(every, "term").orderBy("pk").select("designation").first()[0] == "a"
    write_tables(bodies, str(tmp_path / "t"))
    for tag in PAYLOAD:
        assert read_flat(spark, str(tmp_path / "t"), tag).count() == every.where(f"tag = '{tag}'").count()
    assert read_flat(spark, str(tmp_path / "t"), "source").first().origin.ref.id == "62"


def test_payload_round_trip(spark, data):
    stored = table(spark, data, "concept_yaml").limit(50).collect()
    for r in stored:
        for t in visit(r.record_id, r.body):
            json.loads(t[-1])


def test_plan_is_one_pass(spark, data):
    plan = child_objects(table(spark, data, "concept_yaml"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1


def test_children_on_both_levels_keep_keys_of_their_own(spark, tmp_path):
    one = {"domains": {"concept_id": "a"}, "related": [{"ref": {"id": "r"}}], "localized_concepts": {"eng": {"language_code": "eng", "terms": [{"designation": "x"}], "notes": "n"}}}
    both = json.dumps({**one, "data": {**one, "domains": [{"concept_id": "b"}]}})
    got = list(visit(1, both))
    keys = [(r[0], r[1]) for r in got]
    assert len(set(keys)) == len(keys) and [r[6] for r in got if r[0] == "domain"] == ["a", "b"]
    parents = {r[1] for r in got}
    assert all(r[2] in parents for r in got if r[2] is not None) and {r[2] for r in got if r[0] == "term"} == {"1/l1", "1/l2"}
    sizes = {r.tag: (r.n_rows, r.n_records, r.n_orphans) for r in table_sizes(rows(spark, [both, json.dumps(CONCEPT), None]), str(tmp_path / "t")).collect()}
    assert sizes["domain"] == (3, 2, 0) and sizes["term"] == (6, 2, 0) and sizes["record"] == (2, 2, 0) and sizes["source"] == (1, 1, 0)


def test_keys_are_unique(spark, data):
    every = tagged_rows(table(spark, data, "concept_yaml"))
    assert every.count() == every.select("tag", "pk").distinct().count()
