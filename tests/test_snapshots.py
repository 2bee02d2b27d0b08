"""Snapshot changes against a brute-force version, and their edge cases."""

import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glossweave.operators.snapshots import instant, label, prose, snapshot_changes, termbase_changes
from glossweave.session import table

SCHEMA = "snapshot_no int, code string, language_code string, definition string, entry_status string, date_amended string, loaded_at timestamp, change_kind string"
T0 = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def row(no, code, d="d", s="s", a=None, lang="eng", at=0):
    return (no, code, lang, d, s, a, None if at is None else T0 + dt.timedelta(seconds=at))


def found(spark, rows):
    return {(r.snapshot_no, r.code, r.language_code, r.change_kind, tuple(r.changed_fields)) for r in termbase_changes(frame(spark, rows)).collect()}


def test_kinds_and_gaps(spark):
    rows = [row(1, "a"), row(1, "b"), row(1, "c"), row(4, "a"), row(4, "b", d="e"), row(4, "d"), row(9, "b", d="e", s="t", a="2020-01-01"), row(9, "d")]
    assert found(spark, rows) == {
        (4, "b", "eng", "changed", ("definition",)),
        (4, "c", "eng", "removed", ()),
        (4, "d", "eng", "added", ()),
        (9, "a", "eng", "removed", ()),
        (9, "b", "eng", "changed", ("entry_status", "date_amended")),
    }


def test_more_deliveries_than_fit_the_driver(spark, monkeypatch):
    from glossweave.operators import snapshots

    rows = [row(n, "a", d=str(n // 2)) for n in range(6)] + [row(3, "b")]
    want = found(spark, rows)
    monkeypatch.setattr(snapshots, "small_rows", lambda df: None)
    assert found(spark, rows) == want and len(want) == 4


def test_not_a_change(spark):
    pairs = [
        ("A <b>bold</b> text", "a bold  text "), ('say "x"', "say “x”"), ("« x »", '"x"'), ("so­ft​", "soft"), ("it's", "it’s"), (None, ""), ("a\tb\nc", "a b c"),
    ]
    for old, new in pairs:
        assert found(spark, [row(1, "a", d=old), row(2, "a", d=new)]) == set(), (old, new)
    for old, new in [("a b", "ab"), ("x < 5 V, y > 3", "x 3"), ("a", "á"), ("a.", "a"), (None, "a")]:
        assert len(found(spark, [row(1, "a", d=old), row(2, "a", d=new)])) == 1, (old, new)


def test_normalisers(spark):
    one = spark.range(1)
    same = ["2020-06-18", "2020-06-18T00:00:00Z", "2020-06-18T00:00:00+00:00", "2020-06-18 00:00:00+00:00", "2020-06-17T19:00:00-05:00", "2020-06-18T00:00:00.000+00:00", " 2020-06-18T00:00:00 "]
    got = [one.select(instant(F.lit(x))).first()[0] for x in same]
    assert len(set(got)) == 1 and got[0] is not None
    assert one.select(instant(F.lit("soon")), instant(F.lit("")), instant(F.lit(None))).first()[:] == ("soon", None, None)
    assert one.select(label(F.lit("  STANDARD ")), prose(F.lit(" "))).first()[:] == ("standard", None)


def test_last_loaded_row_counts(spark):
    rows = [row(1, "a"), row(2, "a", d="old", at=1), row(2, "a", d="d", at=5), row(2, "a", d="none", at=None), row(2, "a", d="d", at=5)]
    assert found(spark, rows) == set()
    tie = [row(1, "a"), row(2, "a", d="p", at=1), row(2, "a", d="q", at=1)]
    assert found(spark, tie) == found(spark, tie[::-1])


def test_nulls_empty_and_long(spark):
    assert found(spark, []) == set()
    assert found(spark, [row(None, "a"), row(1, "a")]) == set()
    assert found(spark, [row(1, None), row(2, "b")]) == {(2, None, "eng", "removed", ()), (2, "b", "eng", "added", ())}
    long = "word " * 100_000
    assert found(spark, [row(1, "a", d=long), row(2, "a", d=long.upper())]) == set()
    assert len(found(spark, [row(1, "a", d=long), row(2, "a", d=long + "x")])) == 1


def brute(rows):
    best = {}
    for no, code, lang, d, s, a, at in rows:
        key = (no, code, lang)
        if key not in best or at > best[key][1]:
            best[key] = ((d, s, a), at)
    numbers = sorted({k[0] for k in best})
    out = set()
    for p, q in zip(numbers, numbers[1:]):
        old = {k[1:]: v[0] for k, v in best.items() if k[0] == p}
        new = {k[1:]: v[0] for k, v in best.items() if k[0] == q}
        out |= {(q, *k, "added") for k in new.keys() - old.keys()} | {(q, *k, "removed") for k in old.keys() - new.keys()}
        out |= {(q, *k, "changed") for k in old.keys() & new.keys() if old[k] != new[k]}
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000))
def test_brute_force(spark, seed):
    r = random.Random(seed)
    rows = [row(r.choice([1, 3, 4]), r.choice("abcd"), d=r.choice(["x", "y"]), s=r.choice(["p", "q"]), lang=r.choice(["eng", "fra"]), at=i) for i in range(60)]
    r.shuffle(rows)
    assert {x[:4] for x in found(spark, rows)} == brute(rows)


def test_one_snapshot_has_no_changes(spark, data):
    assert termbase_changes(table(spark, data, "termbase").where("snapshot_no = 1")).count() == 0


def test_plan_joins_only_the_list_of_deliveries_and_shuffles_rows_twice(spark, data):
    plan = termbase_changes(table(spark, data, "termbase"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == plan.count("BroadcastHashJoin [snapshot_no") == 1
    assert plan.count("Exchange hashpartitioning") == 2 and "Python" not in plan


def test_other_tables(spark):
    df = spark.createDataFrame([(1, "k", 1.5, 0), (2, "k", 2.5, 0)], "s int, k string, v double, n int")
    got = snapshot_changes(df, snapshot="s", keys=["k"], fields={"v": lambda c: c.cast("string")}, version="n").collect()
    assert [(r.s, r.k, r.change_kind, r.changed_fields) for r in got] == [(2, "k", "changed", ["v"])]
