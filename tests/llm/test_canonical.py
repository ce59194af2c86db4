import random

import pytest

from admitta.llm.canonical import ALLOWED, REORDERED, catalog_words, map_names, records_of, reference_strings, similar_words, unmatched

CATALOG = [(1, "Numismatică și balneologie", "Numismatics and Spa Medicine"), (2, "Acvacultură experimentală", "Experimental Fish Farming"), (3, "Topografie", "Land Surveying"), (4, "Scenografie și meteorologie", "Stage Design and Meteorology"), (5, None, None)]


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame([(*c, "d", 1) for c in CATALOG], "catalog_id int, name string, name_en string, domain string, target int")


def mapped(spark, catalog, *names):
    rows = spark.createDataFrame([(i, n, "clash") for i, n in enumerate(names)], "firecrawl_id long, name string, words string")
    programs = spark.createDataFrame([], "uid string, name string")
    records = records_of(rows, programs)
    got = map_names(records, catalog)
    hits = {int(r.record_key): r.catalog_id for r in got.collect()}
    assert unmatched(records, got).count() == len({*range(len(names))} - set(hits))
    return [hits.get(i) for i in range(len(names))]


def test_forms_of_a_name(spark, catalog):
    names = ["Numismatica si balneologie", "BALNEOLOGIE + NUMISMATICĂ (IF)", "Studii de Numsimatică & balnelogie 2026", "numism. și balneol.", "Spa Medicine and Numismatics *", "Programul de studii acvacultura - experimenatla", "Land Surveyng", "Тороgrаfіе"]
    assert mapped(spark, catalog, *names) == [1, 1, 1, 1, 1, 2, 3, 3]


def test_other_programmes_and_no_names(spark, catalog):
    names = ["Numismatică", "Acvacultură aplicată", "Topografie și balneologie", "oceanografie și meteorologie", "", None, "?", "n/a", "2026", "Gemologie", "x" * 100_000, "Topografie topografie"]
    # "oceanografie" is two edits from a word of entry 4, and no entry has it as its own
    assert mapped(spark, catalog, *names) == [None] * 3 + [4] + [None] * 8


def test_repeated_rows_and_empty_tables(spark, catalog):
    assert mapped(spark, catalog, "Topografie", "Topografie") == [3, 3]
    assert mapped(spark, catalog) == []
    assert mapped(spark, catalog.where("false"), "Topografie") == [None]


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _letters(a, b):
    gap = [a.count(c) - b.count(c) for c in "abcdefghijklmnopqrstuvwxyz"]
    return max(sum(g for g in gap if g > 0), -sum(g for g in gap if g < 0))


def test_segment_join_finds_what_brute_force_finds(spark, catalog):
    refs = reference_strings(catalog_words(catalog))
    listed = [tuple(r) for r in refs.select("ref", "target", "lang", "short").collect()]
    rng, words = random.Random(4), set()
    for ref, *_ in listed:
        for _ in range(2):
            w = list(ref)
            for _ in range(rng.randint(0, 3)):
                i = rng.randrange(len(w) + 1)
                kind = rng.random()
                if kind < 0.3:
                    w.insert(i, rng.choice("aeinrst"))
                elif kind < 0.6 and len(w) > 1:
                    w.pop(min(i, len(w) - 1))
                elif i + 1 < len(w):
                    w[i], w[i + 1] = w[i + 1], w[i]
            words.add("".join(w))
    words = sorted(x for x in words if x)
    frame = spark.createDataFrame([(w, s) for w in words for s in (False, True)], "word string, short boolean")
    got = {(r.word, r.short, r.lang, r.target): r.edits for r in similar_words(frame, refs).collect()}
    want: dict = {}
    for w in words:
        for ref, target, lang, short in listed:
            e, n = _edits(w, ref), len(ref)
            k = next(k for least, k in ALLOWED if n >= least)
            if e <= k or any(n >= least and e <= most and _letters(w, ref) <= m for least, most, m in REORDERED):
                key = (w, short, lang, target)
                want[key] = min(e, want.get(key, 99))
    least: dict = {}
    for (w, s, lang, _), e in want.items():
        least[(w, s, lang)] = min(e, least.get((w, s, lang), 99))
    assert got == {k: e for k, e in want.items() if e == least[k[:3]]}


def test_names_of_many_choices(spark, catalog, monkeypatch):
    """Names compared with each entry of their length mean the same as those whose choices are written out."""
    import admitta.llm.canonical as canonical

    names = ["Numismatica si balneologie", "Studii de Numsimatică & balnelogie 2026", "Spa Medicine and Numismatics *", "Acvacultură aplicată", "Land Surveyng", "Topografie topografie"]
    want = mapped(spark, catalog, *names)
    monkeypatch.setattr(canonical, "MOST_CHOICES", 0)
    assert mapped(spark, catalog, *names) == want == [1, 1, 1, None, 3, None]
