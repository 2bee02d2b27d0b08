"""Mixed sources: shares, caps, and independence of order and slots."""

from collections import Counter, defaultdict

import pytest

pytest.importorskip("public_tokenizers")

from glossweave.llm import mixing as M  # noqa: E402
from glossweave.session import table  # noqa: E402


def docs(spark, rows):
    return spark.createDataFrame([(i, s, t, "x") for i, (s, t) in enumerate(rows)], "doc_id long, source string, text string, copy_no string")


def targets(spark, rows):
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int")


def pages(n, source):
    return [(source, "word " * (1 + i % 7)) for i in range(n)]


def test_shares_and_caps(spark):
    d = docs(spark, pages(400, "a") + pages(100, "b") + pages(10, "c") + [("z", "other")] * 50 + [(None, "w"), ("a", None), ("a", "")])
    t = targets(spark, [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.1, 4), ("gone", 0.1, 9)])
    rows, shares = M.mix(d, t)
    got, s = rows.collect(), {r.source: r for r in shares.collect()}
    assert set(s) == {"a", "b", "c", "gone"} and s["gone"].tokens_taken == 0
    copies = Counter((r.source, r.doc_id) for r in got)
    assert max(n for (src, _), n in copies.items() if src == "c") == 4 and max(n for (src, _), n in copies.items() if src == "a") == 1
    sizes = defaultdict(int)
    for r in got:
        sizes[r.source] += r.n_tokens
    total = sum(sizes.values())
    for src, share in (("a", 0.5), ("b", 0.3), ("c", 0.1)):
        assert sizes[src] == s[src].tokens_taken and abs(sizes[src] - s[src].budget) <= 4
        assert sizes[src] / total == pytest.approx(s[src].reached_share) and abs(s[src].reached_share - share / 0.9) < 0.02
        assert s[src].share_of_delivered == pytest.approx(share / 0.9)
    assert {r.copy_no for r in got if r.source == "c"} == {1, 2, 3, 4}


def test_prefix_sums_brute_force(spark, data):
    d, t = table(spark, data, "documents"), table(spark, data, "mix_targets")
    p = M.sized_pages(d, t, 7)
    per = M.budgets(p, t)
    for bits in (0, 4):
        at = M.placed(p, per, bits).collect()
        by = defaultdict(list)
        for r in at:
            by[r.source].append(r)
        for rows in by.values():
            total = 0
            for r in sorted(rows, key=lambda r: (r.key, r.doc_id)):
                assert r.before == total
                total += r.n_tokens


def test_slots_and_order_make_no_difference(spark, data, monkeypatch):
    d, t = table(spark, data, "documents"), table(spark, data, "mix_targets")
    want = M.mix(d, t)[0]
    monkeypatch.setattr(M, "PAGES_PER_SLOT", 5)
    got = M.mix(d.repartition(7).orderBy("n_chars"), t)[0]
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
    assert M.mix(d, t, seed=8)[0].exceptAll(want).count() > 0


def test_asked_total_beyond_the_caps(spark):
    rows, shares = M.mix(docs(spark, pages(20, "a")), targets(spark, [("a", 0.5, 3), ("b", 0.5, 1)]), total_tokens=10**9)
    s = {r.source: r for r in shares.collect()}
    assert s["a"].tokens_taken == 3 * s["a"].tokens_available and s["a"].reached_share == 1.0 and rows.count() == 60


def test_edges(spark):
    none = docs(spark, [])
    t = targets(spark, [("a", 0.5, 1), ("a", 0.5, 2), (None, 0.1, 1), ("n", None, None)])
    rows, shares = M.mix(none, t)
    assert rows.count() == 0 and {(r.source, r.tokens_taken, r.reached_share) for r in shares.collect()} == {("a", 0, 0.0), ("n", 0, 0.0)}
    rows, shares = M.mix(docs(spark, pages(5, "a")), targets(spark, []))
    assert rows.count() == 0 and shares.count() == 0
    rows, _ = M.mix(docs(spark, pages(5, "a")), t)
    assert rows.count() == 10
