import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from admitta.llm.packing import Histogram, Packing, assign, best_fit, dominating_set, lower_bound, pack, plan_containers, report
from admitta.llm.tokens import VOCABULARY, encoder


def loads(p: Packing):
    out = defaultdict(int)
    items = Counter()
    for size, at, per, first, n in p.slots:
        for c in range(first, first + n):
            out[c] += size * per
            items[size] += per
    return out, items


def optimum(sizes, capacity):
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        tried = set()
        for b in range(len(bins)):
            if bins[b] + sizes[i] <= capacity and bins[b] not in tried:
                tried.add(bins[b])
                bins[b] += sizes[i]
                go(i + 1, bins)
                bins[b] -= sizes[i]
        bins.append(sizes[i])
        go(i + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9), st.integers(20, 30))
def test_packing_is_valid_and_reduction_keeps_the_optimum(sizes, capacity):
    counts = Counter(sizes)
    p = pack(dict(counts), capacity)
    load, items = loads(p)
    assert items == counts and len(load) == p.containers
    assert all(v <= capacity for v in load.values())
    room = {c: r for r, ranges in p.room.items() for first, n in ranges for c in range(first, first + n)}
    assert room == {c: capacity - v for c, v in load.items()}
    best = optimum(sizes, capacity) if sizes else 0
    assert lower_bound(counts, capacity) <= best <= p.containers
    rest = Histogram(dict(counts))
    fixed = 0
    from admitta.llm.packing import reduce_dominated

    for _, times in reduce_dominated(rest, capacity):
        fixed += times
    left = [s for s, n in rest.count.items() for _ in range(n)]
    assert fixed + (optimum(left, capacity) if left else 0) == best


def test_batched_best_fit_equals_item_by_item():
    rng = random.Random(1)
    for _ in range(40):
        sizes = [rng.randint(1, 40) for _ in range(rng.randint(0, 60))]
        p = Packing(50)
        best_fit(Histogram(dict(Counter(sizes))), p)
        rooms: list[int] = []
        for s in sorted(sizes, reverse=True):
            able = [r for r in rooms if r >= s]
            if able:
                rooms.remove(min(able))
                rooms.append(min(able) - s)
            else:
                rooms.append(50 - s)
        assert sorted(rooms) == sorted(r for r, ranges in p.room.items() for _, n in ranges for _ in range(n))


def test_dominating_sets():
    assert dominating_set(Histogram({9: 1, 5: 1}), 9, 10) == (9,)
    assert dominating_set(Histogram({6: 1, 4: 1, 3: 2}), 6, 10) == (6, 4)
    assert dominating_set(Histogram({5: 1, 4: 1, 3: 1, 1: 5}), 5, 10) is None


DOCS = [(1, "un text scurt", "s"), (2, "un text scurt", "s"), (2, "un text scurt", "s"), (3, None, "s"), (4, "", "s"), (5, "cuvinte " * 3000, "s"), (6, "x" * 30_000, None), (None, "fără cheie", "s")]


def test_every_piece_has_one_container(spark):
    docs = spark.createDataFrame([(*d, 1, "c") for d in DOCS], "doc_id long, text string, source string, n_tokens int, container_id string")
    budgets = spark.createDataFrame([(1, "a", 64), (2, "b", 1000), (3, "c", None), (4, "d", 0), (None, "e", 5)], "budget_id int, budget_name string, capacity_tokens int")
    plan = plan_containers(docs, budgets)
    rows = assign(plan).collect()
    encode = encoder(VOCABULARY).encode_ordinary
    for budget, capacity in ((1, 64), (2, 1000)):
        mine = [r for r in rows if r.budget_id == budget]
        got = Counter()
        for r in mine:
            got[r.doc_id] += r.n_tokens
        want = Counter()
        for d, t, _ in DOCS:
            want[d] += len(encode(t)) if t else 0
        assert got == want
        load = defaultdict(int)
        for r in mine:
            if r.container_id is None:
                assert r.n_tokens == 0
            else:
                load[r.container_id] += r.n_tokens
        assert all(load[r.container_id] + r.unused_tokens == capacity for r in mine if r.container_id is not None)
        listed = {r.budget_id: r for r in report(plan, spark).collect()}
        assert listed[budget].containers == len(load)
    assert {r.budget_id for r in rows} == {1, 2}


@pytest.mark.parametrize("table", ["documents", "budgets"])
def test_empty_tables(spark, table):
    docs = spark.createDataFrame(DOCS if table != "documents" else [], "doc_id long, text string, source string")
    budgets = spark.createDataFrame([(1, "a", 64)] if table != "budgets" else [], "budget_id int, budget_name string, capacity_tokens int")
    assert assign(plan_containers(docs, budgets)).count() == 0


def test_hot_size_is_spread(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'un text scurt' AS text", "'s' AS source")
    budgets = spark.createDataFrame([(1, "a", 10)], "budget_id int, budget_name string, capacity_tokens int")
    import admitta.llm.packing as packing

    old, packing.CELL_ROWS = packing.CELL_ROWS, 100
    try:
        load = Counter(r.container_id for r in assign(plan_containers(docs, budgets)).collect())
    finally:
        packing.CELL_ROWS = old
    n = len(encoder(VOCABULARY).encode_ordinary("un text scurt"))
    assert set(load.values()) <= {10 // n, 3000 % (10 // n)} and sum(load.values()) == 3000


def test_large_capacities_and_many_budgets(spark):
    """Capacities beyond 2^20 tokens and hundreds of budgets keep every piece in a container of its own budget."""
    docs = spark.createDataFrame([(i, "cuvinte de proba " * (1 + i % 9), "s") for i in range(30)], "doc_id long, text string, source string")
    budgets = [(i, "b", 40 + i) for i in range(300)] + [(1000, "b", 1 << 21), (1001, "b", 2**31 - 1)]
    load: dict[tuple[int, int], int] = defaultdict(int)
    rows = assign(plan_containers(docs, spark.createDataFrame(budgets, "budget_id int, budget_name string, capacity_tokens int"))).collect()
    for r in rows:
        load[r.budget_id, r.container_id] += r.n_tokens
    capacity = {b: c for b, _, c in budgets}
    assert {b for b, _ in load} == set(capacity)
    assert all(load[r.budget_id, r.container_id] + r.unused_tokens == capacity[r.budget_id] for r in rows)
