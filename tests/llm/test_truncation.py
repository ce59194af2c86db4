import numpy as np
import pytest

from admitta.llm.truncation import examine, report, tail

SENTENCES = ["Candidații depun dosarul complet la secretariat, în zilele lucrătoare.", "Taxa de procesare nu se restituie.", "Rezultatele finale vor fi afișate la avizier.", "Media de admitere se calculează cu două zecimale."]


def corpus(n=60):
    return [(i, "s", " ".join(SENTENCES[(i + k) % 4] for k in range(3)) + ("\nSecretariatul facultății" if i % 3 == 0 else "")) for i in range(n)]


def cut(spark, *texts, source="t"):
    rows = corpus() + [(1000 + i, source, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, source string, text string, token string, chars int")
    out = {r.doc_id: r.truncated for r in examine(df).collect()}
    assert len(out) == len(rows) and not any(out[i] for i in range(60))
    return [out[1000 + i] for i in range(len(texts))]


def test_cut_texts(spark):
    texts = ["Taxa de procesare nu se rest", "Rezultatele finale vor fi afișate la", "Candidații depun dosarul complet…»", "Media de admitere [...]", "Rezultatele finale (continuare)", "Taxa de proces�", "Text cu <stro", "Candidații depun,", "Motto: «Învățăm", "Program | Nivel | Locuri\nDrept | Master | 3\nBiologie | Ma"]
    assert cut(spark, *texts) == [True] * len(texts)


def test_whole_texts(spark):
    texts = ["Taxa de procesare nu se restituie.", "Orar", "", None, "   ", "Taxa de procesare nu se restituie.\n\nSecretariatul facultății", "Rezultatele finale vor fi afișate la avizier.</p>&nbsp;", "Program | Nivel\nDrept | Master", "Telefon: 0000 258", "x" * 100_000, "Anexe: cerere etc."]
    assert cut(spark, *texts) == [False] * len(texts)


def test_limit_of_a_source(spark):
    full = " ".join(f"Numele {i} este frumos și lung." for i in range(40))
    texts = [(full[i:])[:200] for i in range(0, 60, 3)]
    assert cut(spark, *texts) == [not t.endswith(".") for t in texts]


def test_copies_empty_table_and_report(spark):
    assert cut(spark, "Taxa de procesare nu se rest", "Taxa de procesare nu se rest") == [True, True]
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert examine(none).count() == 0
    df = spark.createDataFrame([*corpus(), (999, "s", "Taxa de procesare nu se rest"), (None, None, "x [...]")], "doc_id long, source string, text string")
    got = {r.source: (r.documents, r.truncated, round(r.share, 4)) for r in report(examine(df)).collect()}
    assert got == {"s": (61, 1, round(1 / 61, 4)), None: (1, 1, 1.0)}


@pytest.mark.parametrize(("text", "state"), [("Gata.", "whole"), ("Vă așteptăm…", "marked"), ("fără punct", "loose"), ("a [ … ]", "cut"), ("... citește mai mult", "cut"), ("lista (a, b", "cut")])
def test_states(text, state):
    assert tail(text)["state"] == state


@pytest.mark.parametrize("copies", [5, 50])
def test_copies_of_a_cut_text(spark, copies):
    texts = ["Taxa de procesare nu se rest", "Anunț important.\nRezultatele finale vor fi afișate la", "Media de admitere se calculează cu două…"]
    got = cut(spark, *[t for t in texts for _ in range(copies)])
    assert [got[i * copies : (i + 1) * copies] for i in range(3)] == [[True] * copies] * 3


def test_stray_fragment_in_copies(spark):
    fragment = ["Text cu rest rupt."] * 5
    assert cut(spark, *fragment, "Taxa de procesare nu se rest") == [False] * 5 + [True]


def test_closing_line_of_different_texts(spark):
    texts = [f"Anunțul {w} al comisiei.\nCu stimă, Secretar" for w in ("unu", "doi", "trei", "patru", "cinci")]
    assert cut(spark, *texts) == [False] * 5


@pytest.mark.parametrize("times", [1, 12])
def test_half_words_in_a_growing_corpus(spark, times):
    """Fragments beside broken characters and in addresses grow with the corpus, and so do words that hardly ever stand alone."""
    filler = ["Media %d a fost publicată.", "Medicina %d cere un dosar. Dosarul nu se restituie.", "Dosarul %d are rest�nțe.", "Vezi https://med.rest.example/d%d acum.", "Scrieți la rest@med.example, camera %d."]
    rows = [(i, "s", filler[i % 5] % i) for i in range(60 * times)]
    texts = ["Dosarul nu se rest", "Comisia cere med"]
    rows += [(100_000 + i, "t", t) for i, t in enumerate(texts)]
    found = {r.doc_id for r in examine(spark.createDataFrame(rows, "doc_id long, source string, text string")).where("truncated").collect()}
    assert found == {100_000, 100_001}


def test_words_that_stand_alone_are_whole(spark):
    rows = [(i, "s", f"Proba {i} are media finală. Taxa pro {i} se plătește.") for i in range(200)] + [(1000, "t", "Se plătește taxa pro")]
    assert not examine(spark.createDataFrame(rows, "doc_id long, source string, text string")).where("evidence = 'half word'").count()


def test_share_of_a_word_standing_alone(spark):
    rows = [(i, "s", f"Contestația {i} se depune. Contestația se judecă.") for i in range(1200)] + [(5000 + i, "s", f"Cuvântul con {i} rămâne.") for i in range(4)]
    rows += [(9000, "t", "Comisia judecă con")]
    assert [r.evidence for r in examine(spark.createDataFrame(rows, "doc_id long, source string, text string")).where("doc_id = 9000").collect()] == ["half word"]


@pytest.mark.parametrize(
    ("text", "state", "token"),
    [
        ("Taxa nu se rest" + "<br/>&nbsp;\n" * 1500, "loose", "rest"), ("Taxa nu se restituie." + "</p>\n" * 5000, "whole", None), ("departaj&#82", "cut", None), ("dipl\\u02", "cut", None), ("text <a href='https://x.example/" + "y" * 300, "cut", None),
        ("un <b\n>doi trei", "loose", "trei"), ("a " * 5000 + "rest", "loose", "rest"), ("&#39;", "whole", None), ("Anunț… citește mai mult »", "cut", None), ("Preț 3 < 5 lei", "loose", "lei"),
    ],
)
def test_ends_behind_markup_and_in_long_lines(text, state, token):
    found = tail(text)
    assert (found["state"], found["token"]) == (state, token)


def test_context_reaches_over_a_tag_of_two_lines():
    assert tail("unu <b\nclass='x'>doi trei")["c3"] == "unu doi trei"
    assert tail("zero\nunu doi")["c3"] == "^ unu doi"


def test_long_words_are_in_the_trie(spark):
    word = "abcdefghij" * 12
    rows = [(i, "s", f"Cuvântul {word} numărul {i} este lung.") for i in range(5)] + [(100, "t", f"Aici este {word[:100]}")]
    assert [r.evidence for r in examine(spark.createDataFrame(rows, "doc_id long, source string, text string")).where("truncated").collect()] == ["half word"]


def test_counts_against_a_plain_loop():
    """Words and contexts of all texts, counted one token at a time."""
    import random

    from admitta.llm.truncation import ENDS, FILTER_BITS, TokenCounter, slot, tokens_of

    rnd = random.Random(4)
    texts = [(" ".join(rnd.choice(["Unu", "doi", "2,5", "trei.", "patru\n", "(cinci", "-", "șase"]) for _ in range(rnd.randint(0, 30))), rnd.randint(1, 3)) for _ in range(80)]
    wanted = np.zeros(FILTER_BITS, dtype=bool)
    for key in ("doi", "^ doi", "unu doi", "^ unu doi", "0", "șase", "doi șase", "unu doi șase"):
        wanted[slot(key)] = True
    want: dict = {}
    for text, copies in texts:
        tokens, a, b = tokens_of(text), "^", "^"
        for i, t in enumerate(tokens[:-1]):
            if t in ENDS:
                a = b = "^"
            elif t[0].isalnum():
                w, ended = "0" if t[0].isdigit() else t, tokens[i + 1] in ENDS
                keys = [("context", k) for k in (w, f"{b} {w}", f"{a} {b} {w}") if wanted[slot(k)]] + ([("word", w)] if w != "0" else [])
                for k in keys:
                    n = want.setdefault(k, [0, 0, 0])
                    n[ended] += 1
                    n[2] += copies
                a, b = b, w
    got: dict = {}
    counter = TokenCounter(wanted)
    for part in (texts[:30], texts[30:]):
        for kind, keys, went, ended, n in counter.count([(tokens_of(t), c) for t, c in part]):
            for row in zip(keys, went, ended, n):
                have = got.setdefault((kind, row[0]), [0, 0, 0])
                for k in range(3):
                    have[k] += int(row[k + 1])
    assert got == want
