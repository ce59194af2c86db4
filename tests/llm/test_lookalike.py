import unicodedata

import pytest

from admitta.llm.lookalike import Classes, close, consistent, consistent_values, rules

CORPUS = "Programe oferite în știință țară ăâîșțĂÂÎȘȚ ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 -"


def form(*texts):
    counts = {}
    for c in CORPUS * 50 + "".join(texts):
        counts[c] = counts.get(c, 0) + 1
    inside, across = rules(counts)
    return [consistent(t, tuple(inside.items()), tuple(across.items()), across) for t in texts]


@pytest.mark.parametrize(
    ("odd", "plain"),
    [
        ("Ｐｒｏｇｒａｍｅ", "Programe"), ("Programе оfеritе", "Programe oferite"), ("s﻿tadioane​", "stadioane"), ("a b c　d", "a b c d"), ("Geograﬁa", "Geografia"), ("şi ţară Şcoală", "și țară Școală"),
        (unicodedata.normalize("NFD", "știință în țară"), "știință în țară"), ("şi ţară", "și țară"), ("cod non‐UE", "cod non-UE"), ("２５ locuri", "25 locuri"), ("ΟRΝITOLOGIE", "ORNITOLOGIE"), ("Β 20 Τ 22", "B 20 T 22"),
    ],
)
def test_rewritten(odd, plain):
    assert form(odd) == [plain]


@pytest.mark.parametrize("text", ["(Українська мова)", "русский язык", "λόγος", "a – b „c”", "repeated  blanks ", "Zoologie teoretica", "", "x" * 200_000])
def test_left_alone(text):
    assert form(text) == [text]


def test_decomposed_foreign_word_is_composed_only():
    assert form(unicodedata.normalize("NFD", "(ελληνική) Українська")) == ["(ελληνική) Українська"]


def test_classes_are_transitive_and_closed():
    c = Classes()
    for a, b in (("а", "a"), ("ă", "ă"), ("ӑ", "ӑ")):
        c.join(a, b)
    assert c.find("ӑ") != c.find("ă")
    close(c)
    assert c.find("ӑ") == c.find("ă") == c.find("ӑ")


def test_values_of_a_table(program):
    rows = [{"uid": "1", "name": "Programe оferite"}, {"uid": "1", "name": "Programe оferite"}, {"uid": "2", "name": "Programe oferite", "spots_raw": "x​y"}, {"uid": "3"}, {"uid": None, "name": ""}, {"uid": "4", "name": "a" * 100_000 + " "}]
    out = {(r.uid, r.field_name): (r.consistent, r.was_consistent) for r in consistent_values(program(*rows), "uid", ["name", "spots_raw"]).collect()}
    assert out[("1", "name")] == ("Programe oferite", False)
    assert out[("2", "name")] == ("Programe oferite", True)
    assert out[("2", "spots_raw")] == ("xy", False)
    assert out[(None, "name")] == ("", True)
    assert out[("4", "name")] == ("a" * 100_000 + " ", False)
    assert len(out) == 5
    assert consistent_values(program(), "uid", ["name"]).count() == 0


@pytest.mark.parametrize(("odd", "plain"), [("Prօgramս", "Programu"), ("ᎪᏴCDrept", "ABCDrept"), ("ᴏferite", "oferite")])
def test_other_alphabets(odd, plain):
    assert form(odd) == [plain]


def test_armenian_words_stay():
    assert form("Հայերեն") == ["Հայերեն"]


def test_closure_of_any_depth():
    """A chain in which every round of the closure joins one more pair."""
    c = Classes()
    c.join("a0", "b0")
    for k in range(1, 60):
        c.join(f"a{k}", f"{chr(0x4E00 + k)}")
        c.join(f"b{k}", f"{chr(0x5E00 + k)}")
        c.parent.setdefault(f"{chr(0x4E00 + k)}x", f"{chr(0x4E00 + k)}x")
    for k in range(1, 60):
        s, t = chr(0x4E00 + k), chr(0x5E00 + k)
        c.join(f"{s}{s}", chr(0x4E00 + k + 1))
        c.join(f"{t}{t}", chr(0x5E00 + k + 1))
    c.join(chr(0x4E01), chr(0x5E01))
    close(c)
    assert c.find(chr(0x4E00 + 60)) == c.find(chr(0x5E00 + 60))


def test_rewritings_without_end_are_refused():
    with pytest.raises(ValueError, match="without end"):
        consistent("a", (("a", "b"), ("b", "a")), (), {})
