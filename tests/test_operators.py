"""Rules, extraction, matching and fusion on hand-made rows."""

from __future__ import annotations

import datetime as dt
import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from admitta.functions import fuzzy
from admitta.operators import boilerplate, fuse, grades, html, match, pdf, publish, rank, snapshots, validate
from admitta.operators.ranking import salted_rank
from admitta.sources import files, web

NAMES = [
    ("Ingineria Sistemelor", "PASS", 60), ("Calculatoare si Tehnologia Informatiei", "PASS", 50), ("Drept", "PASS", 50), ("Management", "PASS", 50), ("Psihologie", "PASS", 65), ("Limba si Literatura Romana", "PASS", 50), ("Științe Politice", "PASS", 60),
    ("Secretariat", "FAIL", 0), ("Meniu Principal", "FAIL", 0), ("aaaaa", "FAIL", 20), ("123456", "FAIL", 10), ("Programul de la ora 10", "QUARANTINE", 30), ("Automatica", "QUARANTINE", 30), (None, "FAIL", 0), ("x" * 151, "FAIL", 0), ("aaabbb", "FAIL", 5),
]


def test_names(spark):
    df = spark.createDataFrame([(i, n) for i, (n, *_) in enumerate(NAMES)], "i int, n string")
    got = {r.i: (r.c.status, r.c.score) for r in df.select("i", validate.name_check(F.col("n")).alias("c")).collect()}
    assert [got[i] for i in range(len(NAMES))] == [(s, p) for _, s, p in NAMES]


def test_ranking(spark):
    rows = [(1, "Cifra de Scolarizare 2026"), (2, "Cifra 2025"), (3, "Ghid Admitere"), (4, "Grile Exam"), (5, "Rezultate Admitere 2026"), (6, None)]
    q = spark.createDataFrame([(i, "f", f"http://u/{i}.pdf", None, t) for i, t in rows], "input_pos int, faculty_slug string, pdf_url string, url string, link_text string")
    spots = {r.input_pos: (r.stage_a_score, r.place) for r in rank.ranked_queue(q, 2026).collect()}
    assert spots == {1: (25.0, 1), 2: (20.0, 2), 5: (0.0, 3), 3: (-10.0, 4), 4: (-10.0, 5)}
    assert {r.input_pos: r.stage_a_score for r in rank.ranked_queue(q, 2026, "RESULTS").collect()}[5] == 25.0
    assert {r.input_pos for r in rank.best_papers(q, 2026, 2).collect()} == {1, 2}


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        (("Calculatoare", "Licenta", None), ("Calculatoare", "Master", None), None), (("Calculatoare (în limba engleză)", "Licenta", None), ("Calc. Eng.", "Licenta", None), 0.8),
        (("Mecanica", "Licenta", "Mecanic"), ("Mecanica", "Licenta", "Mecanic"), 1.0), (("Mecanica", "Licenta", "Mecanic"), ("Mecanica", "Licenta", "Civil"), 0.8),
    ],
)
def test_pair_scores(spark, a, b, want):
    p = spark.createDataFrame([("f", "1", *a)], "s string, pid string, name string, level string, domain string")
    r = spark.createDataFrame([("f", "9", *b)], "s string, rid string, program_name string, level string, domain string")
    best = match.best_rows(p, r, ["s"]).first()
    assert (round(best.score, 6), best.status, best.accepted) == ((0.0, "no_match", False) if want is None else (want, "match", True))
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    pair = p.select(match.comparable(F.col("name")).alias("a"), low("level").alias("la"), low("domain").alias("da")).crossJoin(r.select(match.comparable(F.col("program_name")).alias("b"), low("level").alias("lb"), low("domain").alias("db")))
    assert round(match.pair_scores(pair).first().score, 6) == (want or 0.0)


def test_best_rows_against_all_pairs(spark, monkeypatch):
    """Blocks and pruning change nothing: the best two rows are those of scoring every pair."""
    monkeypatch.setattr(match, "BLOCK", 3)
    rnd = random.Random(5)
    words = ["calculatoare", "drept", "penal", "mecanica", "eng", "auto", "limba", "romana", "x", "studii " * 12]
    name = lambda: rnd.choice([None, "", *(" ".join(rnd.sample(words, rnd.randint(1, 4))) for _ in range(6))])
    some = lambda *v: rnd.choice(v)
    ps = [(some("f", "f", "g", None), f"p{i}", name(), some("Licenta", "Master", None), some("Drept", "drept civil", None), "clash") for i in range(40)]
    rs = [(some("f", "f", "h", None), f"r{i % 25}", name(), some("licenta", "master", None), some("drept", None), 1) for i in range(30)]
    p = spark.createDataFrame(ps, "s string, pid string, name string, level string, domain string, item string")
    r = spark.createDataFrame(rs, "s string, rid string, program_name string, level string, domain string, q int")
    got = {x.pid: (round(x.score, 9), x.rid, x.status) for x in match.best_rows(p, r, ["s"]).collect()}
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    left = p.select("s", "pid", match.comparable(F.col("name")).alias("a"), low("level").alias("la"), low("domain").alias("da"))
    right = r.select("s", "rid", match.comparable(F.col("program_name")).alias("b"), low("level").alias("lb"), low("domain").alias("db")).dropDuplicates()
    scored: dict[str, list] = {x[1]: [] for x in ps}
    for x in match.pair_scores(left.join(right, "s")).where(f"score > {match.KEPT}").collect():
        scored[x.pid].append((-x.score, x.rid))
    for pid, found in scored.items():
        best = {}
        for minus, rid in sorted(found):
            best.setdefault((rid, minus), None)
        top = sorted((m, rid) for rid, m in best)[:2]
        if not top:
            assert got[pid] == (0.0, None, "no_match")
            continue
        status = "low_confidence" if -top[0][0] < 0.5 else "ambiguous" if len(top) > 1 and round(top[1][0] - top[0][0], 9) < 0.15 else "match"
        assert got[pid] == (round(-top[0][0], 9), top[0][1], status)
    none = match.best_rows(p.where("false"), r, ["s"])
    assert none.count() == 0 and match.best_rows(p, r.where("false"), ["s"]).where("status = 'no_match'").count() == 40


def _names(rnd, number, words, share=0.15, most=12):
    odd = ["", " ", "x", "drept penal " * 6, "q" * 300, "a\0b", "\u00a0drept  penal", "\U0001d400rept"]
    return [rnd.choice(odd) if rnd.random() < share else " ".join(rnd.choices(words, k=rnd.randint(1, most))) for _ in range(number)]


def test_bounds_hold():
    rnd = random.Random(3)
    a, b = (_names(rnd, 40, ["calculatoare", "drept", "penal", "in", "eng", "auto", "romanica", "x"]) for _ in range(2))
    i, j = (x.ravel() for x in np.meshgrid(np.arange(40), np.arange(40), indexing="ij"))
    pairs = [a[k] for k in i], [b[k] for k in j]
    sets, stretches = fuzzy.token_set_ratios(*pairs) / 100, fuzzy.partial_ratios(*pairs) / 100
    assert np.allclose(stretches * 100, [fuzzy.partial_ratio(x, y) for x, y in zip(*pairs)])
    bounds = fuzzy.Bounds(a, b)
    count, length = (np.concatenate(x) for x in zip(*(bounds.shared(k) for k in range(40))))
    assert (np.concatenate([bounds.least(k, *bounds.shared(k)) for k in range(40)]) <= sets + 1e-9).all()
    *closer, common = bounds.by_subsequences(i, j, count, length)
    for most, value in ((bounds.by_bags(i, j, count, length), (sets, stretches)), (closer, (sets, stretches)), ([bounds.by_ends(i, j, common)], [stretches])):
        assert all((x >= y - 1e-9).all() for x, y in zip(most, value))


@pytest.mark.parametrize(("share", "most", "part"), [(0.15, 12, 20), (0.0, 7, 40)])
def test_best_two_of_a_large_faculty_compares_few_pairs(monkeypatch, share, most, part):
    """The best two rows are those of all pairs, of which only a small part is compared."""
    rnd = random.Random(4)
    words = ["".join(rnd.choices("abcdefghilmnoprstuvz", weights=[9, 1, 5, 4, 10, 1, 1, 1, 9, 5, 3, 6, 5, 3, 7, 4, 6, 5, 1, 1], k=rnd.randint(4, 13))) for _ in range(80)]
    level, domain = (lambda: rnd.choice(["licenta", "master", "l", ""])), (lambda: rnd.choice(["drept", "arte", ""]))
    queries = [{"a": x, "la": level(), "da": domain()} for x in _names(rnd, 60, words, share, most)]
    rows = [{"b": x, "lb": level(), "db": domain(), "rid": f"r{rnd.random()}"} for x in _names(rnd, 600, words, share, most)]
    rows = [r | {"last_rid": r["rid"] + "z" * rnd.randint(0, 1)} for r in rows]
    compared, ratios = [0], match.partial_ratios
    monkeypatch.setattr(match, "partial_ratios", lambda a, b: compared.__setitem__(0, compared[0] + len(a)) or ratios(a, b))
    got = sorted((i, round(x["score"], 9), x["rid"]) for i, x in match.best_two(queries, rows))
    want = []
    for i, q in enumerate(queries):
        a, b = [q["a"]] * len(rows), [r["b"] for r in rows]
        names = np.maximum(fuzzy.token_set_ratios(a, b), ratios(a, b)) / 100
        listed = []
        for name, r in zip(names, rows):
            conflict, same = match._level_parts(q["la"], r["lb"])
            alike = bool(q["da"] and r["db"]) and fuzzy.partial_ratio(q["da"], r["db"]) > match.DOMAIN_ALIKE
            score = 0.0 if conflict or name < match.LEAST_NAME else min(match.NAME * name + match.LEVEL * same + match.DOMAIN * alike, 1.0)
            listed += [(-score, rid) for rid in {r["rid"], r["last_rid"]} if score > match.KEPT]
        want += [(i, round(-s, 9), rid) for s, rid in sorted(listed)[:2]]
    assert got == sorted(want)
    assert compared[0] < len(queries) * len(rows) / part


def test_best_rows_in_any_blocks(spark, monkeypatch):
    rnd = random.Random(6)
    p, r = (_names(rnd, n, ["calculatoare", "drept", "penal", "in", "auto"]) for n in (25, 40))
    p = spark.createDataFrame([("f", str(i), x, "licenta", None) for i, x in enumerate(p)], "s string, pid string, name string, level string, domain string")
    r = spark.createDataFrame([("f", str(i), x, rnd.choice(["l", "master", None]), None) for i, x in enumerate(r)], "s string, rid string, program_name string, level string, domain string")
    found = []
    for sizes in ((match.QUERIES, match.ROWS, match.TOGETHER), (4, 3, 1)):
        for name, value in zip(("QUERIES", "ROWS", "TOGETHER"), sizes):
            monkeypatch.setattr(match, name, value)
        found.append(sorted(match.best_rows(p, r, ["s"]).collect()))
    assert len(found[0]) == 25 and found[0] == found[1]


def test_grade_matches(spark):
    p = spark.createDataFrame([("f", "1", "Drept penal"), ("f", "2", "Biologie"), ("f", "3", None), (None, "4", "Drept penal")], "s string, pid string, name string")
    g = spark.createDataFrame([("f", "Penal, drept", 7.0, 2), ("f", "Drept penal", 8.0, 1), ("f", None, 5.0, 0), ("f", "", 6.0, 3)], "s string, grade_key string, min_grade double, key_pos int")
    assert [(r.pid, r.grade_key, r.min_grade) for r in match.grade_matches(p, g, ["s"]).collect()] == [("1", "Drept penal", 8.0)]


def test_arbitration_does_not_depend_on_order(spark):
    rows = [("p", "u1", 1, 1, 50.0, 0.9, 100, 1, None, "n", None), ("p", "u2", 2, 1, 90.0, 0.9, 150, 2, 3, "n", "raw")]
    schema = "uid string, pdf_url string, pdf_rank int, row_idx int, content_score double, match_score double, spots_budget int, spots_tax int, page int, source_name string, raw_row string"
    for order in itertools.permutations(rows):
        df = spark.createDataFrame(order, schema)
        assert fuse.arbitrate(df, ["uid"]).first().spots_budget == 150
        assert [e.value.budget for e in fuse.collect_evidence(df, ["uid"]).first().spots_evidence] == [100, 150]
    got = spark.range(1).select(fuse.likelihood(F.lit(1.0), F.lit(0.8)).alias("a"), fuse.likelihood(F.lit(90.0), F.lit(0.5)).alias("b")).first()
    assert (got.a, got.b) == (0.92, 0.74)


PAGE = """<html><nav><ul><li><a href='/x'>Home</a></li></ul></nav><div id='main_content'><h1>Admitere</h1><ul>
<li>Domeniul: Științe</li><li>Drept european, 50 locuri la buget și 20 locuri cu taxă; nou</li><li>Inginerie software avansată</li><li>Calendar admitere</li><li>Tel: 12 locuri buget</li><li><a href='/y'>Master</a></li></ul>
<table><tr><th>Specializare</th><th>Taxă</th><th>Buget</th></tr><tr><td>DOMENIUL X</td><td>1</td></tr><tr><td>Biologie: biolog</td><td>3</td><td>*7</td></tr><tr><td>din care alte</td><td>1</td><td>1</td></tr></table>
<a href='docs/Cifra.PDF'>Cifra 2026</a> <a href='r.pdf'>Rezultate 2026</a></div></html>"""


def test_page(spark):
    pages = spark.createDataFrame([("1", "https://a.ro/admitere/licenta", "f", PAGE), ("2", "https://a.ro/m", "f", None), ("3", "https://a.ro/n", "f", "")], "page_id string, url string, faculty_slug string, html string")
    got = {r.name: (r.spots_budget, r.spots_tax, r.source_type, r.level, r.spots_raw) for r in html.programmes(pages).collect()}
    assert got == {
        "Drept european": (50, 20, "html_text_parsed", "Licenta", "Drept european [Domain: Științe]"), "Inginerie software avansată": (None, None, "html_list_mixed", "Licenta", "Inginerie software avansată [Domain: Științe]"),
        "Biologie": (7, 3, "html_table_parsed", "Licenta", "Table: Biologie: biolog | B:7 T:3 [Domain: DOMENIUL X]"),
    }
    nodes = html.dom_nodes(pages)
    assert [r.pdf_url for r in html.pdf_links(nodes).orderBy("input_pos").collect()] == ["https://a.ro/admitere/docs/Cifra.PDF", "https://a.ro/admitere/r.pdf"]
    assert [r.score for r in html.grade_links(nodes).collect()] == [15, 5]


def test_deep_and_broken_pages():
    """Tags nested thousands deep, never closed or closed without a beginning end no job."""
    deep = html.page_nodes("<main>" + "<div>" * 5000 + "<ul><li>Drept <b>penal</b></li></ul>")
    assert [(n["tag"], n["text"], n["in_list"]) for n in deep] == [("li", "Drept penal", True)]
    assert [n["text"] for n in html.page_nodes("</div></li><li>a<li>b</ul><td>c")] == ["a", "b c", "c"]
    assert html.page_nodes(None) == html.page_nodes("") == html.page_nodes("< <!-- <li>x") == []


def test_papers(spark):
    pages = [
        ("u", 1, "Specializarea: Ingineria si Protectia Mediului Locuri buget: 10 Locuri taxa: 5", None), ("u", 2, "Specializarea: Tehno-\nlogia Informatiei\nLocuri buget: 20 Locuri taxă: 10", None),
        ("u", 3, "Cibernetica 30 locuri buget si 15 locuri taxa\nInformatica 50 locuri buget, 20 locuri taxa\nTotal general 1 loc buget 1 loc taxa", None), ("v", 1, "Studii de master", [[["x"], ["Program", "Buget", "Taxa"], ["Drept penal", "5 (1)", "-"], ["Total", "1", "1"]]]),
    ]
    df = spark.createDataFrame(pages, web.PAGES)
    got = {(r.pdf_url, r.program_name, r.spots_budget, r.spots_tax, r.page) for r in pdf.rows_of_papers(df).collect()}
    assert got == {("u", "Ingineria si Protectia Mediului", 10, 5, 1), ("u", "Tehnologia Informatiei", 20, 10, 2), ("u", "Cibernetica", 30, 15, 3), ("u", "Informatica", 50, 20, 3), ("v", "Drept penal", 5, None, 1)}
    strict = {r.program_name for r in pdf.text_rows(df, strict=True).collect()}
    assert "Informatica" not in strict


def test_grades(spark):
    cells = [("u", "file", 0, 0, ["Nr", "Program de studii", "Medie concurs"]), ("u", "file", 0, 1, ["1", "x", "9,5"]), ("u", "file", 0, 2, ["2", "Drept penal", "4.0"]), ("u", "file", 0, 3, ["3", "", "8"]), ("u", "file", 0, 4, ["4", "", "7.5"]), ("u", "file", 0, 5, ["5"])]
    df = spark.createDataFrame(cells, "pdf_url string, context string, table_no int, row_no int, cells array<string>")
    rows = grades.table_grades(df)
    assert sorted((r.program_name, r.grade) for r in rows.collect()) == [("Drept penal", 4.0), ("Drept penal", 7.5), ("Drept penal", 8.0), ("file", 9.5)]
    assert [(r.program_name, r.min_grade) for r in grades.lowest_grades(rows, ["program_name"]).collect()] == [("Drept penal", 7.5)]


def test_boilerplate(spark):
    pages = spark.createDataFrame([("g", i, f" Antet \npagina {i}\n\nSubsol") for i in range(3)] + [("h", 0, "Antet")], "g string, p int, t string")
    lines = boilerplate.page_lines(pages, "g", "p", "t")
    rep = boilerplate.repeated_lines(lines)
    assert {(r.g, r.line) for r in rep.collect()} == {("g", "Antet"), ("g", "Subsol")}
    assert {(r.g, r.p): r.text for r in boilerplate.without_repeated(lines, rep).collect()} == {("g", 0): "pagina 0", ("g", 1): "pagina 1", ("g", 2): "pagina 2", ("h", 0): "Antet"}


def test_retrieval(spark, program):
    row = publish.retrieval_text(program({"uid": "1234567890ab", "name": "Calculatoare (în limba engleză)", "faculty_slug": "ace", "level": "Licenta", "spots_budget": 5}), 2026, "uni").first()
    assert row.program_id == "uni_ace_12345678" and row.language == "en" and {"computer science", "international"} <= set(row.keywords) and row.text_for_embedding.startswith("[FACTS]")


def _snap(uid, run, h, at=1, **v):
    return (uid, run, dt.datetime(2026, 1, at), h, v.get("name"), None, None, None, v.get("b"), None, "clash")


def _diff(spark, rows, runs):
    s = spark.createDataFrame(rows, "uid string, run_id string, scraped_at timestamp, content_hash string, name string, level string, duration_years string, admission_year int, spots_budget int, spots_tax int, k string")
    m = spark.createDataFrame([(r, st, dt.datetime(2026, 1, d)) for r, st, d in runs], "run_id string, status string, started_at timestamp")
    return sorted((r.run_id, r.uid, r.change_kind) for r in snapshots.diff_snapshots(s, m).collect())


def test_snapshots(spark):
    runs = [("z", "success", 1), ("y", "failed", 2), ("a", "success", 3), ("m", "success", 5)]
    rows = [
        _snap("AA", "z", "H1"), _snap("aa ", "a", "sha256:h1"), _snap("aa", "m", None, name="n"), _snap("bb", "z", "h"), _snap("bb", "a", "h2", 1), _snap("bb", "a", "h", 2), _snap("bb", "a", "h", 2), _snap("cc", "y", "h"), _snap("cc", "m", ""),
        _snap("dd", "z", None, name="n", b=1), _snap("dd", "a", "h", name="n", b=1), _snap("dd", "m", "", name="n", b=None), _snap(None, "a", "h"), _snap(" ", "a", "h"), _snap("ee", "nowhere", "h"), _snap("Q?", "a", None),
    ]
    assert _diff(spark, rows, runs) == [("a", "q?", "added"), ("m", "aa", "changed"), ("m", "bb", "removed"), ("m", "cc", "added"), ("m", "dd", "changed"), ("m", "q?", "removed")]
    assert _diff(spark, rows, runs[:2]) == [] and _diff(spark, [], runs) == [] and _diff(spark, rows, []) == []


def test_index_is_kept_and_swapped(spark, monkeypatch):
    """Runs fed one by one, the index found again each time, give what one pass gives, and each run is read once."""
    runs = [f"r{i}" for i in (3, 1, 2, 0)]
    rnd = random.Random(1)
    rows = [_snap(f"u{u}", run, f"h{rnd.randint(0, 1)}", name="n", b=k) for k, run in enumerate(runs) for u in range(40) if rnd.random() < 0.8]
    schema = "uid string, run_id string, scraped_at timestamp, content_hash string, name string, level string, duration_years string, admission_year int, spots_budget int, spots_tax int, k string"
    s = spark.createDataFrame(rows, schema)
    m = spark.createDataFrame([(r, "success", dt.datetime(2026, 1, 1 + k)) for k, r in enumerate(runs)], "run_id string, status string, started_at timestamp")
    want = sorted(tuple(r) for r in snapshots.diff_snapshots(s, m).collect())
    read, got = [], []
    take_in = snapshots.SnapshotIndex.take_in
    monkeypatch.setattr(snapshots.SnapshotIndex, "take_in", lambda self, df, due: (read.extend(due), take_in(self, df, due))[1])
    for n in range(1, 5):
        index = snapshots.SnapshotIndex.open(spark, "kept")
        got += [tuple(r) for r in index.advance(s.where(F.col("run_id") == runs[n - 1]), runs[:n]).collect()]
        assert index.runs == [runs[n - 1]]
    assert sorted(got) == want and read == runs
    # a broken advance left the next index behind: it is dropped and the step done again
    broken = snapshots.SnapshotIndex.open(spark, "kept")
    take_in(broken, s.withColumn("run_id", F.lit("r9")), ["r9"])
    again = snapshots.SnapshotIndex.open(spark, "kept")
    assert sorted(again.runs) == ["r0", "r9"]
    assert again.advance(s.where("false"), [*runs, "r9"]).count() == len([r for r in rows if r[1] == "r0"]) and again.runs == ["r9"]
    again.drop()
    assert snapshots.SnapshotIndex.open(spark, "kept").runs == []


def test_filter_of_changed_keys(spark, monkeypatch):
    """A filter that is full lets every row pass and changes nothing."""
    rows = [_snap(f"u{u}", run, f"{run}{u % 3}", name=f"{run}{u}", b=u) for run in "ab" for u in range(50)] + [_snap("u1", "b", "later", at=2, name="last")]
    s = spark.createDataFrame(rows, "uid string, run_id string, scraped_at timestamp, content_hash string, name string, level string, duration_years string, admission_year int, spots_budget int, spots_tax int, k string")
    m = spark.createDataFrame([("a", "success", dt.datetime(2026, 1, 1)), ("b", "success", dt.datetime(2026, 1, 2))], "run_id string, status string, started_at timestamp")
    changes = snapshots.diff_snapshots(s, m)
    want = {(f"u{u}", f"a{u}", "last" if u == 1 else f"b{u}") for u in range(50)}
    assert {(r.uid, r.old.name, r.new.name) for r in snapshots.changed_values(changes, s).collect()} == want
    monkeypatch.setattr(snapshots, "MOST_BITS", 64)
    words, bits = snapshots.key_filter(changes.withColumn("h", F.xxhash64("uid")), "h")
    assert bits == 1 << 16 and words.count() <= bits // 64
    assert {(r.uid, r.old.name, r.new.name) for r in snapshots.changed_values(changes, s).collect()} == want


def test_salted_rank(spark):
    df = spark.range(500).selectExpr("id", "IF(id % 3 = 0, 'hot', NULL) AS g", "id % 7 AS c")
    got = {}
    for r in salted_rank(df, ["g"], ["c"], ["id"]).collect():
        got.setdefault(r.g, []).append((r.rank0, r.c, r.id))
    for rows in got.values():
        assert [x[0] for x in sorted(rows)] == list(range(len(rows))) and sorted(rows, key=lambda x: (x[1], x[2])) == sorted(rows)


def test_files(spark, tmp_path, program):
    folder = tmp_path / "raw" / "ace" / "programs"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps({"uid": "1", "entity_type": "program", "name": "Drept"}, indent=1), encoding="utf-8")
    (folder / "b.json").write_text("{broken", encoding="utf-8")
    assert [r.uid for r in files.programs_of(spark, str(tmp_path)).collect()] == ["1"]
    assert [r.faculty_slug for r in files.run_faculties(spark, str(tmp_path)).collect()] == ["ace"]
    publish.write_csv(publish.flat(program({"uid": "1", "name": "Științe", "spots_budget": 3})), str(tmp_path / "csv"))
    assert [(r.name, r.spots_budget) for r in files.exported_csv(spark, str(tmp_path / "csv")).collect()] == [("Științe", "3")]
    (tmp_path / "s.html").write_text("<!-- Source: https://a.ro/x -->\n<p>t</p>", encoding="utf-8")
    assert files.snapshots(spark, str(tmp_path / "*.html")).first().url == "https://a.ro/x"
    assert files.latest_file(spark, str(tmp_path / "*.html")).endswith("s.html")
    (tmp_path / "c.yaml").write_text("faculties:\n - {slug: ace, name: A, urls: [u]}\n")
    assert files.config(spark, str(tmp_path / "c.yaml")).first().slug == "ace" and files.config(spark, str(tmp_path / "no.yaml")).count() == 0


def test_fetching():
    answers = {"https://a/1": [web.Answer(503), web.Answer(200, b"x", "application/pdf")], "https://a/2": [web.Answer(404)] * 9, "https://b/1": [web.Answer(200, b"<p>", "text/html")]}
    waits: list[float] = []
    fetch = web.PoliteFetcher(lambda u: answers[u].pop(0), wait=waits.append, wanted="pdf", breaker=2, polite=None)
    assert [fetch(u)["status"] for u in ("https://a/1", "https://b/1", "https://a/2", "https://a/2", "https://a/2")] == ["downloaded", "failed", "failed", "failed", "circuit_open"]
    assert waits == [1.0]


def test_politeness_and_headers():
    waits: list[float] = []
    seen: list[str] = []

    def get(url, headers):
        seen.append(headers["User-Agent"])
        return web.Answer(200, b"x", "text/html")

    fetch = web.PoliteFetcher(get, wait=waits.append, headers=[{"User-Agent": "a"}, {"User-Agent": "b"}], chance=random.Random(1))
    assert {fetch(f"https://a/{i}")["status"] for i in range(20)} == {"downloaded"}
    assert len(waits) == 20 and all(1 <= w <= 3 for w in waits) and set(seen) == {"a", "b"}


def test_rendered_pages():
    class Fake:
        closed = False

        def html(self, url):
            if "bad" in url:
                raise OSError
            return f"<p>{url}</p>"

        def close(self):
            self.closed = True

    started = []
    fetch = web.RenderedFetcher(lambda: started.append(Fake()) or started[-1])
    assert [fetch(u)["status"] for u in ("https://a/1", "https://bad", "https://a/2")] == ["rendered", "failed", "rendered"]
    fetch.close()
    assert len(started) == 1 and started[0].closed and fetch.browser is None


def test_unreadable_papers(spark):
    def extract(content):
        if content == b"bad":
            raise ValueError("no paper")
        return [("text", [[["a"]]])]

    df = spark.createDataFrame([("u", bytearray(b"ok")), ("v", bytearray(b"bad")), ("w", None)], "pdf_url string, content binary")
    got = {(r.pdf_url, r.page_no, r.text, r.error) for r in web.paper_pages(df, extract).collect()}
    assert got == {("u", 1, "text", None), ("v", None, None, "ValueError: no paper")}


def test_adapters(spark):
    from admitta.sources import adapters

    @adapters.register("example")
    class Example(adapters.PageAdapter):
        name = "Example"

        def faculties(self, spark):
            return spark.createDataFrame([(0, "f", "F", ["https://a.ro/m"])], "pos int, slug string, name string, urls array<string>")

    a = adapters.adapter("example")
    assert isinstance(a, adapters.Adapter) and (a.slug, a.name) == ("example", "Example") and "example" in adapters.registered()
    pages = spark.createDataFrame([("1", "https://a.ro/admitere/licenta", "f", PAGE)], "page_id string, url string, faculty_slug string, html string")
    assert a.programmes(pages).count() == 3 and a.papers(pages).count() == 2 and [r.score for r in a.grade_papers(pages).collect()] == [15, 5]
    lines = spark.createDataFrame([("g", i, 0, "Antet") for i in range(3)] + [("g", 0, 1, "x")], "g string, p int, pos int, line string")
    assert {r.text for r in a.without_boilerplate(lines).collect()} == {"x"}
    queue = spark.createDataFrame([(1, "f", "http://u", None, "Cifra 2026")], "input_pos int, faculty_slug string, pdf_url string, url string, link_text string")
    assert a.ranked(queue, 2026).first().stage_a_score == 25.0
    with pytest.raises(KeyError, match="no adapter"):
        adapters.adapter("nowhere")
    with pytest.raises(ValueError, match="already"):
        adapters.register("example")(Example)


def test_csv_keeps_blanks_and_line_ends(spark, tmp_path):
    rows = [(" a ", None), ('say "x", y', ""), ("two\nlines", "z\\")]
    publish.write_csv(spark.createDataFrame(rows, "a string, b string"), str(tmp_path / "c"), one_file=True)
    assert sorted((r.a, r.b) for r in files.exported_csv(spark, str(tmp_path / "c")).fillna("").collect()) == sorted((a, b or "") for a, b in rows)


def test_failures_in_a_row_over_cells(spark):
    """Cells of any width, keys and times that are null among them, give what a loop over the events gives."""
    from admitta.streaming import breaker

    rnd = random.Random(3)
    rows = [(i, rnd.choice(["hot", "hot", "hot", "b", None]), rnd.choice([None, *range(50)]), rnd.random() < 0.3) for i in range(400)]
    df = spark.createDataFrame([(i, k, t, ok, 1) for i, k, t, ok in rows], "i int, key string, t int, ok boolean, n int")
    want, open_now = {}, {}
    for i, k, t, ok in sorted(rows, key=lambda r: (r[2] is not None, r[2], r[0])):
        open_now[k] = 0 if ok else open_now.get(k, 0) + 1
        want[i] = open_now[k]
    for width in (1, 7, 1000):
        got = breaker.failures_in_a_row(df, "key", ["t", "i"], "ok", F.floor(F.col("t") / width))
        assert {r.i: r.failures for r in got.collect()} == want and got.columns == [*df.columns, "failures"]
    assert breaker.failures_in_a_row(df.where("false"), "key", ["t", "i"], "ok", F.col("t")).count() == 0


def test_containment_against_all_pairs(spark):
    from admitta.operators import coverage

    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("ab -") for _ in range(rnd.choice((0, 1, 2, 5, 6, 7, 12))))
    left, right = [(i, rnd.choice([None, word()])) for i in range(120)], [(rnd.choice([None, word()]),) for _ in range(60)]
    t = spark.createDataFrame(left, "key int, name string")
    o = spark.createDataFrame(right, "name string")
    form = lambda n: (n or "").replace("-", " ").strip(" ")
    want = {k for k, n in left if form(n) and any(form(m) and (form(n) in form(m) or form(m) in form(n)) for (m,) in right)}
    assert {r.key for r in coverage.containment_hits(t, o).collect()} == want
    assert coverage.containment_hits(t.where("false"), o).count() == 0 and coverage.containment_hits(t, o.where("false")).count() == 0


def test_ranked_queue_over_stretches(spark, monkeypatch):
    q = spark.createDataFrame([(i, "f" if i % 3 else None, f"http://u/{i}", None, ["Cifra 2026", "Ghid", "Cifra"][i % 3]) for i in range(90)], "input_pos int, faculty_slug string, pdf_url string, url string, link_text string")
    want = {r.input_pos: r.place for r in rank.ranked_queue(q, 2026).collect()}
    monkeypatch.setattr(rank, "STRETCH", 4)
    assert {r.input_pos: r.place for r in rank.ranked_queue(q, 2026).collect()} == want
    assert {r.input_pos for r in rank.best_papers(q, 2026, 5).collect()} == {i for i, p in want.items() if p <= 5}


def test_queue_is_merged_batch_by_batch(spark, tmp_path):
    from admitta.streaming import queue

    path = str(tmp_path / "state")
    q = spark.createDataFrame([(1, "u", None, "queued", None), (2, "v", None, "queued", None)], "input_pos int, pdf_url string, url string, status string, local_path string")
    queue.start(spark, q, path)
    results = spark.createDataFrame([("u", 1, "failed", None), ("u", 2, "downloaded", "a.pdf")], "address string, seq int, status string, local_path string")
    results.write.parquet(str(tmp_path / "in" / "1"))
    read = lambda: spark.readStream.schema(results.schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    run = lambda progress: queue.merged(read(), path).option("checkpointLocation", str(tmp_path / progress)).trigger(availableNow=True).start().awaitTermination()
    run("a")
    state = lambda: {r.input_pos: (r.status, r.local_path) for r in queue.current(spark, path).collect()}
    assert state() == {1: ("downloaded", "a.pdf"), 2: ("queued", None)}
    spark.createDataFrame([("v", 3, "failed", None)], results.schema).write.parquet(str(tmp_path / "in" / "2"))
    run("a")
    assert state() == {1: ("downloaded", "a.pdf"), 2: ("failed", None)}


def test_small_helpers(spark):
    from admitta.operators import coverage

    f = spark.createDataFrame([(2, "b", "B"), (1, "a", None)], "pos int, slug string, name string")
    assert [r.slug for r in coverage.first_listed(f, "pos", 1).collect()] == ["a"] and coverage.first_listed(f, "pos", None).count() == 2
    p = spark.createDataFrame([("1", "b"), ("2", "c"), ("3", None)], "uid string, faculty_slug string")
    assert {r.uid: r.faculty_name for r in fuse.with_faculty_name(p, f).collect()} == {"1": "B", "2": "C", "3": None}
    assert coverage.counts(spark.createDataFrame([("x",), ("x",), ("y",)], "file string")).first().asDict() == {"files": 2, "records": 3}
    e = publish.error_rows(spark.createDataFrame([("f", "u", "ERROR", None, "x" * 300), ("f", "v", "OK", None, None), ("f", None, None, "m", None)], "faculty_slug string, url string, status string, message string, content string"), "2026-01-01")
    assert sorted((r.url or "", r.error, len(r.raw or "")) for r in e.collect()) == [("", "m", 0), ("u", "ERROR", 100)]
    pages = spark.createDataFrame([("f", "u", dt.datetime(2026, 1, 1, 8), "a"), ("f", "u", dt.datetime(2026, 1, 1, 9), "b"), ("f", None, None, "c")], "faculty_slug string, url string, at timestamp, html string")
    assert publish.snapshot_rows(pages).count() == 2 and [(r.html, r.file_name[:6]) for r in publish.snapshot_rows(pages, True).collect()] == [("b", "090000")]


def test_web_source(spark):
    spark.dataSource.register(web.web_source(lambda url: web.Answer(200 if "a" in url else 404, url.encode(), "text/html")))
    got = {r.url: (r.status, r.code) for r in spark.read.format("web").option("urls", "http://a,http://b").load().collect()}
    assert got == {"http://a": ("downloaded", 200), "http://b": ("failed", 404)}
    assert spark.read.format("web").load().count() == 0


def test_package_is_shipped(spark):
    import zipfile

    from pyspark import SparkFiles

    from admitta.session import ship_package

    ship_package(spark)
    names = set(zipfile.ZipFile(SparkFiles.get("admitta.zip")).namelist())
    assert {"admitta/__init__.py", "admitta/operators/match.py"} <= names
    assert spark.createDataFrame([("a b", "b a")], "x string, y string").select(match.token_set("x", "y").alias("r")).first().r == 100
