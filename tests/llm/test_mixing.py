"""Source mixing: its laws, and the curriculum against numeric integration."""

from collections import Counter, defaultdict

import pytest

from carelake.llm import mixing
from carelake.llm.queries import QUERIES
from carelake.llm.queries_mixing import MOST, schedule


def plain_targets(sizes, weights, most):
    """Excess is reshared by weight until none is above its cap."""
    total, fixed = sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        weight = sum(weights[i] for i in free)
        share = {i: (total - sum(fixed.values())) * weights[i] / weight for i in free}
        above = [i for i in free if share[i] > most * sizes[i]]
        if not above:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        fixed |= {i: most * sizes[i] for i in above}


def test_targets():
    cases = [([100, 200, 300], [1, 2, 3]), ([1000, 10, 10], [1, 2, 3]), ([0, 50, 7], [1, 1, 5]), ([5], [2]), ([1, 1, 1000], [9, 9, 1])]
    for sizes, weights in cases:
        assert mixing.targets(sizes, weights, 3.0) == pytest.approx(plain_targets(sizes, weights, 3.0))
    assert mixing.targets([], [], 3.0) == []


def test_query_keeps_its_laws(spark, small):
    frame = QUERIES["op1_mix"](spark, small)
    rows = frame.collect()
    assert [r["first_position"] for r in rows if r["taken"]] == sorted(r["first_position"] for r in rows if r["taken"])
    names = sorted({r["source"] for r in rows})
    sizes = [sum(r["size"] for r in rows if r["source"] == n) for n in names]
    want = plain_targets(sizes, [1 + i % 3 for i in range(len(names))], MOST)
    for name, size, target in zip(names, sizes, want):
        own = [r for r in rows if r["source"] == name]
        assert {r["source_size"] for r in own} == {size} and own[0]["target"] == pytest.approx(target)
        middling = sorted(r["size"] for r in own)[len(own) // 2]
        assert abs(sum(r["taken"] for r in own) - target) <= max(middling, 0.05 * target)
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    again = QUERIES["op1_mix"](spark, small).collect()
    assert Counter(rows) == Counter(again)


def test_positions_follow_the_schedules(spark, docs_of):
    docs = docs_of([(i, "w " * (1 + i % 7), "ab"[i % 2]) for i in range(4000)])
    knots = {"a": [(0.0, 3.0), (0.4, 1.0), (1.0, 0.0)], "b": [(0.0, 0.0), (0.5, 0.0), (1.0, 4.0)]}
    plan = mixing.curriculum(docs, lambda i, name: knots[name]).collect()
    for name, points in knots.items():
        taken = sorted((p, r["_size"]) for r in plan if r["_source"] == name for p in r["_positions"] or [])
        total = sum(s for _, s in taken)
        for t in (0.1, 0.3, 0.45, 0.7, 0.9):
            steps = 20_000
            weight = lambda x: next(w + (x - a) / (b - a) * (w1 - w) for (a, w), (b, w1) in zip(points, points[1:]) if x <= b)
            area = sum(weight((i + 0.5) / steps * t) for i in range(steps)) * t / steps
            assert sum(s for p, s in taken if p <= t) / total == pytest.approx(area / mixing.integral(points), abs=0.01)


ODD = [(1, None, None), (1, None, None), (2, "", "z"), (3, "a b c", "é"), (3, "a b c", "é"), (None, "x y", None), (4, "w " * 90_000, "b"), (5, "p q", "b")]


def test_odd_rows(docs_of):
    docs = docs_of(ODD).selectExpr("*", "1 AS _size", "2 AS taken", "3 AS _md5")
    plan = mixing.curriculum(docs, schedule).collect()
    assert Counter((r["_id"], r["_source"], r["_size"]) for r in plan) == Counter((d, s, len((t or "").split())) for d, t, s in ODD)
    by_source = defaultdict(set)
    for r in plan:
        by_source[r["_source"]].add((r["_source_size"], r["_target"]))
        assert (r["_copies"] == 0) == (not r["_positions"]) and (r["_positions"] is None or len(r["_positions"]) == r["_copies"])
    assert all(len(v) == 1 for v in by_source.values()) and by_source["z"] == {(0, 0.0)}
    mixed = mixing.mixed(docs, schedule)
    assert mixed.columns == docs.columns
    taken = Counter()
    for r in plan:
        taken[(r["_id"], r["_size"])] += r["_copies"]
    assert Counter((r["doc_id"], len((r["text"] or "").split())) for r in mixed.collect()) == +taken
    assert mixing.curriculum(docs_of([]), schedule).count() == mixing.mixed(docs_of([]), schedule).count() == 0


def test_mixed_keeps_rows_that_differ_in_other_columns(docs_of):
    twins = docs_of([(1, "a b c", "web")] * 4 + [(1, None, "web"), (1, "", "web")] + [(i, "w " * i, "web") for i in range(2, 9)])
    apart = "timestamp_micros(CASE WHEN n < 2 THEN n ELSE 0 END) AS at"
    odd = twins.selectExpr("*", "row_number() OVER (PARTITION BY doc_id, text ORDER BY doc_id) - 1 AS n").selectExpr("* EXCEPT (n)", apart, "CASE WHEN n = 2 THEN 'x' END AS left", "CASE WHEN n = 3 THEN 'x' END AS right")
    always = lambda place, name: [(0.0, 1.0), (1.0, 1.0)]
    got = mixing.mixed(odd, always, 1.0).collect()  # one source, each document with words once
    assert Counter(map(tuple, got)) == Counter(tuple(r) for r in odd.collect() if (r["text"] or "").split())


def test_odd_schedules_are_refused():
    for knots in ([(0.1, 1.0), (1.0, 1.0)], [(0.0, 1.0), (0.0, 2.0), (1.0, 1.0)], [(0.0, -1.0), (1.0, 1.0)]):
        with pytest.raises(ValueError):
            mixing.integral(knots)
