import pytest
from pyspark.sql import functions as F

from admitta.llm.entities import candidate_keys, match_programmes, rule_confidence, shared_parts, subject_words

URL, RECTOR = "https://x.example/a.pdf", "https://r.example/b.pdf"
NAME = "Monitorizarea vehiculelor teatrale în solarii militare"


@pytest.fixture(scope="module")
def queue(spark):
    rows = [(1, "Jur_X", URL, URL, "c"), (2, "jur-x", None, URL, "c"), (3, "rectorat", RECTOR, None, None), (4, None, None, None, None)]
    return spark.createDataFrame(rows, "input_pos int, faculty_slug string, pdf_url string, url string, fac string")


def pairs(spark, program, queue, records, rows):
    made = spark.createDataFrame([(u, i, n, lv, 3, "clash") for u, i, n, lv in rows], "pdf_url string, row_idx int, program_name string, level string, spots_budget int, lvl string")
    return {(r.uid, r.row_idx) for r in match_programmes(program(*records), made, queue).collect()}


def rec(uid, name=NAME, pid="p", level="Licenta", slug="jur-x", **more):
    return {"uid": uid, "name": name, "program_id": pid, "level": level, "faculty_slug": slug, "language": "Romanian"} | more


def test_variants_of_a_row(spark, program, queue):
    names = [
        NAME.upper(), "Monitorizarea vehiculelor teatrale in solarii mil", "19. Monit. vehic. teatr. în solarii milit.", "În solarii militare: monitorizarea vehiculelor teatrale", "Monitorizarea vehiculelor în solarii militare - teatrale",
        "Monitorizarea teatrale in solarii militare", "Monitorizarea vehi-\nculelor teatrale în solarii militare", "Monitorizarea vehciulelor tetrale in solarii militare - 16 locuri",
    ]
    rows = [(URL, i, n, None) for i, n in enumerate(names)]
    assert pairs(spark, program, queue, [rec("1")], rows) == {("1", i) for i in range(len(names))}


def test_level_language_and_other_subjects(spark, program, queue):
    records = [rec("l"), rec("m", pid="q", level="Masterat"), rec("e", NAME + " (in English)", "r", language="English"), rec("o", NAME.replace("vehiculelor", "pădurilor").replace("militare", "alpine"), "s")]
    rows = [(URL, 1, NAME, "L"), (URL, 2, NAME, "Ciclul II"), (URL, 3, NAME + " (EN)", "Licență"), (URL, 4, NAME.replace("militare", "rurale").replace("teatrale", "optice"), "L"), (URL, 5, NAME, "D")]
    assert pairs(spark, program, queue, records, rows) == {("l", 1), ("m", 2), ("e", 3)}


def test_shared_ids_faculties_and_noise(spark, program, queue):
    records = [rec("1"), rec("2", "Monitorizarea vehiculelor teatrale"), rec("3", NAME, None), rec("4", NAME, "z", slug="ist-y"), rec("5", "Calendar admitere 2026", None), rec("6", None, "k"), {"uid": "7"}, {"name": NAME}, rec("1")]
    rows = [(URL, 1, NAME, "L"), (URL, 1, NAME, "L"), (RECTOR, 2, NAME, None), (URL, 3, "TOTAL", None), (URL, 4, "Calendar admitere 2026", None), (URL, 5, None, None), (None, 6, NAME, None), (URL, None, NAME, None), ("https://nobody", 7, NAME, None), (URL, 8, "", None), (URL, 9, "x" * 50_000, None)]
    assert pairs(spark, program, queue, records, rows) == {("1", 1), ("2", 1), ("3", 1), ("1", 2), ("2", 2), ("3", 2), ("4", 2)}


def test_empty_tables_and_confidence(spark, program, queue):
    assert pairs(spark, program, queue, [], [(URL, 1, NAME, "L")]) == set()
    assert pairs(spark, program, queue, [rec("1")], []) == set()
    made = spark.createDataFrame([(URL, 1, NAME, "L")], "pdf_url string, row_idx int, program_name string, level string")
    row = match_programmes(program(rec("1"), rec("2")), made, queue).first()
    assert 0.5 < row.confidence < 1


def test_rules_weaken_and_confidence_falls(spark, program, queue):
    """Each row comes out under the strongest rule that joins it, and no rule is surer than a stronger one."""
    other = NAME.replace("vehiculelor", "pădurilor").replace("teatrale", "optice").replace("solarii", "lacuri")
    records = [rec(str(i)) for i in range(6)] + [rec("o", other, "q", level="Unknown", language=None)] + [rec(f"e{i}", NAME + " (in English)", "r", "Master", language="English") for i in range(3)]
    rows = [(URL, 1, NAME + " (EN)", "M"), (URL, 2, NAME, "L"), (URL, 3, NAME + " (EN)", None), (URL, 4, other, None), (URL, 5, NAME.replace("vehiculelor", "vehiculele"), "L"), (URL, 6, "Monit. veh. teat. în sol. milit.", "L")]
    made = spark.createDataFrame(rows, "pdf_url string, row_idx int, program_name string, level string")
    found = match_programmes(program(*records), made, queue).collect()
    assert {r.row_idx: r.rule for r in found} == {1: 0, 2: 1, 3: 2, 4: 3, 5: 4, 6: 5}
    by_rule = {r.rule: r.confidence for r in found}
    assert sorted(by_rule.values(), reverse=True) == [by_rule[k] for k in sorted(by_rule)]
    assert {r.row_idx: {x.uid for x in found if x.row_idx == r.row_idx} for r in found} == {1: {"e0", "e1", "e2"}, 2: set("012345"), 3: {"e0", "e1", "e2"}, 4: {"o"}, 5: set("012345"), 6: set("012345")}


def test_confidence_of_the_rest_each_rule_meets(spark):
    pairs = [(0, "a", "a")] * 8 + [(1, "a", "a")] * 2 + [(1, "a", "b")] * 2 + [(3, "a", "a")] * 50
    pooled = 61 / 64
    got = {r.rule: (r.joined_pairs, r.right_pairs, round(r.confidence, 4)) for r in rule_confidence(spark.createDataFrame(pairs, "rule int, pid string, program_id string")).collect()}
    first, second = round((8 + 4 * pooled) / 12, 4), round((2 + 4 * pooled) / 8, 4)
    assert got == {0: (8, 8, first), 1: (4, 2, second), 2: (0, 0, second), 3: (50, 50, second), 4: (0, 0, second), 5: (0, 0, second)}
    assert {r.confidence for r in rule_confidence(spark.createDataFrame([], "rule int, pid string, program_id string")).collect()} == {0.5}


def test_keys_of_long_names_grow_with_their_words(spark):
    long = " ".join(chr(97 + i // 26) + chr(97 + i % 26) + "zz" + "q" * (i % 7) for i in range(300))
    df = spark.createDataFrame([(long,), (NAME,)], "name string").select(F.size(candidate_keys(shared_parts(subject_words(F.col("name"))), subject_words(F.col("name")), True)).alias("n"))
    assert [r.n for r in df.collect()][0] < 2000


def test_long_names_meet(spark, program, queue):
    """Names of more words than have triples meet each other and shorter ones, by the check."""
    words = [chr(97 + i) * 4 + chr(98 + i) * 4 for i in range(15)]
    long = " ".join(words)
    rows = [(URL, 1, long.replace("bbbbcccc", "bbbbcccx").replace("eeeeffff", "eeeefff"), "L"), (URL, 2, " ".join(words[:14]), "L"), (URL, 3, " ".join(words[:12]), "L")]
    assert pairs(spark, program, queue, [rec("1", long)], rows) == {("1", 1), ("1", 2)}
