import random

import pytest

import admitta.llm.mixing as mixing

from admitta.llm.mixing import draw, plan_mix, shares

TARGETS = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 5), (None, 0.3, 1), ("d", 0.0, 1), ("e", 0.1, 0)]


def frames(spark, docs, targets=TARGETS):
    d = spark.createDataFrame([(*x, 7) for x in docs], "doc_id long, source string, text string, n_tokens int")
    return d, spark.createDataFrame(targets, "source string, target_share double, max_repeats int")


def many():
    i = 0
    for source, n in (("a", 400), ("b", 200), ("c", 60), ("z", 50)):
        for k in range(n):
            i += 1
            yield i, source, "cuvinte de proba " * (1 + (k * 7) % 40)
    yield 10_001, "a", None
    yield 10_002, "b", ""
    yield None, None, "x"


def test_shares_are_met_and_caps_hold(spark):
    docs, targets = frames(spark, list(many()))
    mix = plan_mix(docs, targets)
    used = draw(mix).collect()
    caps = {"a": 1, "b": 2, "c": 5}
    assert all(1 <= r.use_count <= caps[r.source] for r in used)
    assert len({r.doc_id for r in used}) == len(used) and not {10_001, 10_002} & {r.doc_id for r in used}
    for r in shares(mix).collect():
        assert abs(r.actual_share - r.target_share) < 0.01
        assert r.tokens_used == sum(u.n_tokens * u.use_count for u in used if u.source == r.source)
    assert {(r.doc_id, r.use_count) for r in draw(mix).collect()} == {(r.doc_id, r.use_count) for r in used}


def test_largest_total_uses_some_source_to_its_cap(spark):
    docs, targets = frames(spark, list(many()))
    mix = plan_mix(docs, targets)
    assert any(abs(e - m) < 1e-9 for s, _, m in mix.targets for e in [mix.copies[s]])


def test_too_large_a_total_stops_at_the_caps(spark):
    docs, targets = frames(spark, list(many()))
    mix = plan_mix(docs, targets, total_tokens=10**9)
    assert {r.source: r.use_count for r in draw(mix).collect()} == {"a": 1, "b": 2, "c": 5}


@pytest.mark.parametrize("docs", [[], [(1, "z", "x")], [(1, "a", "")]])
def test_nothing_to_draw(spark, docs):
    d, targets = frames(spark, docs)
    mix = plan_mix(d, targets)
    assert draw(mix).count() == 0
    assert [r.actual_share for r in shares(mix).collect()] == [0.0] * 3


def test_no_targets_and_missing_source(spark):
    d, targets = frames(spark, [(1, "a", "x y z"), (2, "b", "x y z")])
    assert draw(plan_mix(d, targets.where("false"))).count() == 0
    got = {r.source: r.tokens_used for r in shares(plan_mix(d, targets)).collect()}
    assert got["c"] == 0 and got["a"] > 0


def test_few_documents_meet_the_shares(spark):
    """A share worth less than three documents still comes close, as the offset is chosen."""
    rnd = random.Random(7)
    docs = [(i, "abc"[i % 3], "cuvinte de proba " * rnd.randint(1, 60)) for i in range(600)]
    targets = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 5)]
    d, t = frames(spark, docs, targets)
    for r in shares(plan_mix(d, t, total_tokens=3000)).collect():
        assert abs(r.share_error) < 0.02 and abs(r.actual_share - r.target_share - r.share_error) < 1e-12


def test_histogram_and_documents_agree(spark, monkeypatch):
    """What an offset gives, read off the sizes, is what the documents sum up to; cells of few rows change nothing."""
    docs, targets = frames(spark, list(many()))
    mix = plan_mix(docs, targets)
    whole = {(r.source, r.n_tokens, r.use_count): 0 for r in draw(mix).collect()}
    monkeypatch.setattr(mixing, "CELL_ROWS", 20)
    tokens = {}
    for r in draw(mix).collect():
        assert (r.source, r.n_tokens, r.use_count) in whole
        tokens[r.source] = tokens.get(r.source, 0) + r.n_tokens * r.use_count
    assert tokens == {r.source: r.tokens_used for r in shares(mix).collect() if r.tokens_used}
