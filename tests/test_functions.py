"""Literals of the rules as DataFrame tests, and properties of the similarities."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from admitta.functions import identity, parse, text
from admitta.functions.fuzzy import common_subsequence, indel_ratio, indel_ratios, partial_ratio, partial_ratios, token_set_ratios


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    ("fn", "value", "want"),
    [
        (text.match_form, "Ştiinţe,  ale Naturii și (mediului)", "stiinte ale naturii si mediului"), (text.match_form, None, ""), (text.slug, "Informatică (în engleză) 2026/2027", "informatica"), (text.slug, "Științe ale Mediului", "stiinte-ale-mediului"),
        (lambda c: text.expand_abbreviations(text.match_form(c)), "Calc. Eng.", "calculatoare engleza"), (text.display_name, "CALCULATOARE [nou]  (detalii)", "Calculatoare"), (text.display_name, None, "Unknown"), (text.display_name, "a ,b", "a,b"),
        (text.composed, " Știinţe ", "Științe"), (text.is_title, "Ingineria Sistemelor", True), (text.is_title, "Ingineria sistemelor", False), (text.unbroken, "Tehno-\nlogie\nnouă", "Tehnologie nouă"), (text.markup_text, "<li>a&nbsp;<b>b</b>\n c</li>", "a b c"),
        (text.truth_form, "Științe-Agrare ", "stiinte agrare"), (identity.canonical_url, " HTTP://Ex.RO:80/a/?utm_x=1&b=2&a=1&c=&referrer=q#f", "http://ex.ro/a?a=1&b=2"), (identity.canonical_url, "ex.ro:8080/", "https://ex.ro:8080"),
        (parse.count_of, "10 (2 rrom)", 10), (parse.count_of, "-", None), (parse.count_of, "9" * 30, None), (parse.count_or_zero, "12.7", 12), (parse.count_or_zero, "x", 0), (parse.grade, "9,50", 9.5), (parse.grade, "11", None),
        (parse.item_name, "Drept, 50 locuri; zi", "Drept"), (parse.item_name, "Limbi, literaturi", "Limbi, literaturi"), (parse.without_counts, "Drept - 16 locuri", "Drept"), (parse.domain_label, "Domeniul: Științe", "Științe"),
        (parse.study_level, "Licenta", "Bachelor"), (parse.study_level, "Licență", "Unknown"), (parse.study_level, None, "Unknown"), (parse.page_level, "studii de licență și master", "Master"), (text.repair_encoding, "Ä\u0083 Ã®", "ă î"), (text.repair_encoding, "Ä bad", "Ä bad"), (text.repair_encoding, "ă Ä", "ă Ä"),
    ],
)
def test_expressions(spark, fn, value, want):
    assert one(spark, value, fn) == want


def test_spots_and_courses(spark):
    assert tuple(one(spark, "12 locuri la buget și 5 locuri cu taxă", parse.list_spots)) == (12, 5)
    assert tuple(one(spark, "7 loc cu taxă", parse.list_spots)) == (None, 7)
    html = '<script type="application/ld+json">{"hasCourse": [{"name": "Drept"}, {"x": 1}]}</script><script type="application/ld+json">broken</script>'
    assert one(spark, html, parse.course_names) == ["Drept"]
    assert one(spark, "https://a.ro/x/y.html", lambda c: identity.resolve_link(c, F.lit("z.pdf"))) == "https://a.ro/x/z.pdf"


words = st.text("abcd ", max_size=14)


def token_set_ratio(a, b):
    """The definition, one pair at a time."""
    x, y = set(a.split()), set(b.split())
    both, only_x, only_y = sorted(x & y), sorted(x - y), sorted(y - x)
    if not x or not y:
        return 0.0
    if both and (not only_x or not only_y):
        return 100.0
    shared, left, right = " ".join(both), " ".join([*both, *only_x]), " ".join([*both, *only_y])
    best = indel_ratio(left, right)
    return max(best, indel_ratio(shared, left), indel_ratio(shared, right)) if both else best


@given(words, words)
def test_similarities(a, b):
    assert 0 <= indel_ratio(a, b) <= 100 and indel_ratio(a, a) == 100
    assert token_set_ratio(a, b) == token_set_ratio(b, a)
    assert 0 <= partial_ratio(a, b) <= 100 and abs(partial_ratio(a, b) - partial_ratio(b, a)) < 1e-9
    if a and b and a in b:
        assert partial_ratio(a, b) == 100
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert common_subsequence(a, b) == table[-1][-1]


def test_ratios_of_many_pairs():
    rnd = random.Random(2)
    some = lambda: "".join(rnd.choice("abc \0ș") for _ in range(rnd.choice((0, 1, 5, 30, 63, 64, 65, 90))))
    pairs = [(some(), some()) for _ in range(600)] + [("x", "x"), ("", "")]
    a, b = [x for x, _ in pairs], [y for _, y in pairs]
    for many, one_pair in ((indel_ratios, indel_ratio), (partial_ratios, partial_ratio), (token_set_ratios, token_set_ratio)):
        assert np.allclose(many(a, b), [one_pair(x, y) for x, y in pairs], atol=1e-9)
        assert len(many([], [])) == 0


def test_similarity_corner_cases():
    assert token_set_ratios([""], [""])[0] == 0 and token_set_ratios(["a b"], ["b a c"])[0] == 100 and indel_ratio("", "") == 100 and partial_ratio("", "x") == 0


@pytest.mark.parametrize("name", ["DREPT (ÎN LIMBA ENGLEZĂ)", "ȘTIINȚE POLITICO-ADMINISTRATIVE", "GRAFICĂ 3D / D'ARTA", "Drept (în limba engleză)", "INFORMATICĂ \u2003 (ZI)"])
def test_display_name_of_capitals(spark, name):
    flat = " ".join(name.split())
    assert one(spark, name, text.display_name) == (flat.title() if flat.isupper() else flat)
