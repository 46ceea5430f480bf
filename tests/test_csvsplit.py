from __future__ import annotations

import csv
import io
import random

import pytest
from starloom.sources import files
from starloom.sources.csvsplit import csv_records


@pytest.fixture
def small_blocks(spark):
    """Every file is cut into blocks of a few hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("300", "1")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def written(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    return out.getvalue()


def messy_rows(seed, n=120):
    r = random.Random(seed)
    texts = ['plain', 'say "hi"', 'two\nlines', '"', '""\n"', "a,b", "# no comment", 'x\n\n\ny\n# still inside', "", "é\r\nü", "long " * 80 + "\n" + "text " * 90]
    return [[str(i), r.choice(texts), r.choice(texts)] for i in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_records_over_block_ends(spark, tmp_path, small_blocks, seed):
    rows = messy_rows(seed)
    text = written([["id", "a", "b"]]) + '# a "comment with one quote\n\n' + written(rows[:60]) + '# another "\n' + written(rows[60:])
    (tmp_path / "f.csv").write_text(text, newline="")
    (tmp_path / "g.csv").write_text(written([["id", "a", "b"], ["g", "1", "2"]]), newline="")
    found = csv_records(spark, [str(tmp_path)])
    assert found.select("file", "block").distinct().count() > 20
    got = [r["record"] for r in found.orderBy("file", "block", "number").collect()]
    want = [written([row])[:-1] for row in [["id", "a", "b"], *rows, ["id", "a", "b"], ["g", "1", "2"]]]
    assert got == want


@pytest.mark.parametrize("seed", [7, 8])
def test_same_rows_as_in_one_task(spark, tmp_path, small_blocks, seed):
    rows = [[a, b.replace("\r", ""), c.replace("\r", "")] for a, b, c in messy_rows(seed)]
    (tmp_path / "f.csv").write_text(written([["id", "a", "b"], *rows]), newline="")
    got = files.read_csv_inferred(spark, str(tmp_path), null_tokens=[""])
    assert dict(got.dtypes)["id"] == "bigint"
    plain = spark.read.csv(str(tmp_path), header=True, multiLine=True, escape='"', emptyValue="", nullValue="")
    assert sorted((str(r[0]), r[1] or "", r[2] or "") for r in got.collect()) == sorted((r[0], r[1] or "", r[2] or "") for r in plain.collect())
    assert got.count() == 120


def test_wrong_numbers_of_fields_stop(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b\n1,2\n3\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|too few|record"):
        files.read_csv_inferred(spark, str(tmp_path)).collect()


def test_header_names():
    assert files._header_names('a,"b c",,A\r') == ["a", "b c", "_c2", "A3"] or files._header_names('a,"b c",,A\r') == ["a0", "b c", "_c2", "A3"]
