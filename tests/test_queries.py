"""Every core query with SQL against that SQL, on the smallest tables."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

from admitta.plans import catalog
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows(spark, con, name):
    assert compare(catalog.queries()[name](spark, FOLDER), con, catalog.oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert set(catalog.oracle_sql()) == set(catalog.queries())


def test_core_without_a_library_of_the_subpackage(tmp_path):
    """The core's queries are there when a library that only training data needs is missing."""
    (tmp_path / "regex.py").write_text("raise ImportError('blocked')")
    root = str(Path(__file__).resolve().parents[1])
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    env = os.environ | {"PYTHONPATH": os.pathsep.join((str(tmp_path), root))}
    out = subprocess.run([sys.executable, "-c", code], env=env, cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert [int(n) for n in out] == [len(catalog.queries()), len(catalog.oracle_sql())]


def test_rows_of_shared_papers_meet_each_faculty(spark, tmp_path):
    from pyspark.sql import functions as F

    t = {n: spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("programs", "pdf_rows", "pdf_queue")}
    t["pdf_queue"] = t["pdf_queue"].unionByName(t["pdf_queue"].withColumn("faculty_slug", F.concat("faculty_slug", F.lit("-b"))))
    t["programs"] = t["programs"].unionByName(t["programs"].withColumn("faculty_slug", F.concat("faculty_slug", F.lit("-b"))))
    for n, df in t.items():
        df.write.parquet(f"{tmp_path}/{n}.parquet")
    for name in ("j1_fuzzy_match", "j5_grade_match"):
        query = catalog.queries()[name]
        once = query(spark, FOLDER).count()
        assert once and query(spark, str(tmp_path)).count() == 2 * once


def test_encoding_of_all_names(spark, tmp_path):
    names = {"a": "Informatică", "b": "Științe", "c": "Drept", "d": "Право", "e": None}
    spark.createDataFrame(list(names.items()), "uid string, name string").write.parquet(f"{tmp_path}/programs.parquet")
    got = {r.uid: (r.as_stored, r.repaired) for r in catalog.queries()["sc17_encoding"](spark, str(tmp_path)).collect()}
    wrong = {k: n and n.encode().decode("latin-1") for k, n in names.items()} | {"a": "Informatică"}
    assert got == {k: (n, wrong[k]) for k, n in names.items()}
