from datetime import datetime

from admitta.llm.survivor import surviving_fields, surviving_records


def _row(program_id, uid, **more):
    return {"program_id": program_id, "uid": uid, "source_type": "html", "scraped_at": datetime(2026, 1, 1)} | more


def found(df):
    return {(r.program_id, r.field_name): (r.uid, r.value) for r in df.collect()}


def test_trust_then_recency_then_key(program):
    rows = [
        _row("a", "1", accuracy_confidence=0.9, spots_budget=10), _row("a", "2", accuracy_confidence=95.0, spots_budget=20), _row("a", "3", source_type="jsonld", spots_budget=30),
        _row("b", "1", spots_budget=1, scraped_at=datetime(2026, 1, 1)), _row("b", "2", spots_budget=2, scraped_at=datetime(2026, 2, 1)), _row("b", "2", spots_budget=2, scraped_at=datetime(2026, 2, 1)),
        _row("c", "2", spots_tax=5), _row("c", "1", spots_tax=6),
    ]
    assert found(surviving_fields(program(*rows))) == {("a", "spots_budget"): ("2", 20), ("b", "spots_budget"): ("2", 2), ("c", "spots_tax"): ("1", 6)}


def test_unusable_values_and_odd_confidence(program):
    rows = [
        _row("a", "1", spots_budget=999, accuracy_confidence=1.0), _row("a", "2", spots_budget=-1), _row("a", "3", spots_budget=0, accuracy_confidence=float("nan"), source_type="PDF-only "),
        _row("a", "4", spots_budget=7, accuracy_confidence=500.0), _row("b", "1", spots_budget=3), _row(None, "1", spots_budget=3), _row("d", None, spots_budget=3), _row("e", "1"), _row("e", "2"),
    ]
    assert found(surviving_fields(program(*rows))) == {("a", "spots_budget"): ("3", 0)}


def test_golden_record_and_empty_table(program):
    rows = [_row("a", "1", accuracy_confidence=0.9, spots_tax=4, name="x"), _row("a", "2", accuracy_confidence=0.2, spots_budget=8)]
    out = surviving_records(program(*rows)).collect()
    assert [(r.uid, r.spots_budget, r.spots_budget_uid, r.spots_tax, r.spots_tax_uid) for r in out] == [("1", 8, "2", 4, "1")]
    assert surviving_fields(program()).count() == 0
    assert surviving_records(program()).count() == 0


def test_all_null_rows(program):
    assert surviving_fields(program({}, {})).count() == 0
