from __future__ import annotations

import os
import re

import duckdb
import pytest
from starloom.llm import licenses
from starloom.llm.oracles import ORACLES
from starloom.llm.queries import QUERIES
from tests.conftest import plan_of
from tests.llm.conftest import folder


def with_duckdb(sf_dir):
    con = duckdb.connect()
    path = f"{sf_dir}/documents.parquet"
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con.sql(ORACLES["op6_licenses"])


def same_as_sql(spark, sf_dir):
    got, want = QUERIES["op6_licenses"](spark, sf_dir), with_duckdb(sf_dir)
    assert got.columns == want.columns
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want.fetchall()))


def test_query(spark, sf_dir):
    same_as_sql(spark, sf_dir)


def test_native(spark, sf_dir):
    assert not re.search("Python|Arrow|Pandas", plan_of(QUERIES["op6_licenses"](spark, sf_dir)))


CASES = [
    "MIT License, mit-license; MIT LICENSE",
    "the gnu general\npublic  license and the apache license",
    "mit licenses, smit license, mit. license",
    "mit license license mit mit license",
    licenses.NOTICES["mit-notice"],
    licenses.NOTICES["gpl-notice"].replace("GNU", "").replace("Foundation", "Fdn") + " more words follow here",
    licenses.NOTICES["bsd-notice"].replace("source and binary", "s b").replace("permitted", "p").replace("met", "m"),
    "all\nrights\nreserved",
    "rights all of them reserved",
    "licensed cc by nc 4 only",
    "éà license 12mit license",
    "",
    None,
]


def test_cases_against_sql(spark, tmp_path, messy):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    same_as_sql(spark, folder(tmp_path, documents=docs))
    same_as_sql(spark, folder(tmp_path, documents=messy.select("doc_id", "text")))


def test_places(spark):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert (got[0]["n_base"], got[0]["first_word"], got[0]["last_word"], got[0]["n_words"]) == (3, 0, 4, 6)
    assert got[1]["base_labels"] == "apache,gpl" and got[1]["first_word"] == 2
    assert got[2]["n_base"] == 1 and got[2]["base_labels"] == "mit"  # only "mit. license"
    assert (got[3]["n_base"], got[3]["first_word"], got[3]["last_word"]) == (2, 0, 4)
    assert got[4]["labels"] == "mit-notice" and got[4]["score"] == 1.0
    assert "gpl-notice" in got[5]["labels"] and 0.8 <= got[5]["score"]
    assert got[7]["labels"] == "" and got[8]["labels"] == "all-rights-reserved"
    assert got[11]["labels"] == got[12]["labels"] == "" and got[12]["n_words"] == 0 and got[12]["score"] == 0.0


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_join_finds_all_that_comparing_everything_finds(spark, threshold):
    notices = {"a": "one two three four five", "b": "four five six", "c": "one", "d": "seven eight nine ten eleven twelve"}
    words = "one two three four five six seven eight nine ten eleven twelve other".split()
    lines = [" ".join(w for b, w in enumerate(words) if (i * 2654435761 >> b) & 1) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    for row in licenses.scan(docs, notices, {}, threshold).collect():
        line = set(lines[row["doc_id"]].split())
        shares = {k: len(set(t.split()) & line) / len(t.split()) for k, t in notices.items()}
        held = {k: s for k, s in shares.items() if s >= threshold - 1e-9}
        assert row["labels"] == ",".join(sorted(held)) and row["score"] == max(held.values(), default=0.0)


def test_messy(messy, no_docs):
    assert licenses.scan(messy).count() == messy.count()
    assert licenses.scan(no_docs).count() == 0
