from __future__ import annotations

import datetime as dt
import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.session import clear_staged, scratch_path, stage
from starloom.sources import bronze, catalogs, control, files, jsonrecords, tables
from starloom.streaming import landing


def test_csv_inference(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "# made by hand\nid,mag,name,flag,day,empty,word\n1,NULL,null,true,2026-01-02,,x\n# note\n2,1.5,a,false,NULL,null,1\n3,,,null,2026-01-03,NULL,2\n"
    )
    df = files.read_csv_inferred(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes) == {"id": "bigint", "mag": "double", "name": "string", "flag": "boolean", "day": "date", "empty": "string", "word": "string"}
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, None, None, True, dt.date(2026, 1, 2), None, "x"),
        (2, 1.5, "a", False, None, None, "1"),
        (3, None, None, None, dt.date(2026, 1, 3), None, "2"),
    ]


def test_csv_without_records(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n")
    with pytest.raises(ValueError, match="no records"):
        files.read_csv_inferred(spark, str(tmp_path / "t.csv"))


def test_parquet_tree_skips_other_files(spark, tmp_path):
    root = str(tmp_path / "raw")
    spark.range(3).write.parquet(f"{root}/a/x")
    spark.range(4).withColumn("more", F.lit(1)).write.parquet(f"{root}/b")
    spark.range(5).write.json(f"{root}/ps")
    df = files.read_parquet_tree(spark, root)
    assert df.count() == 7 and set(df.columns) == {"id", "more"}


def test_parquet_columns_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).withColumn("month", F.lit("01")).write.partitionBy("month").parquet(path)
    assert files.read_parquet(spark, path).columns == ["id", "month"]
    assert files.read_parquet(spark, path, []).columns == ["id", "month"]
    assert files.read_parquet(spark, path, ["id"]).columns == ["id"]


def test_inventory_of_odd_names(spark, tmp_path):
    (tmp_path / "a b.bin").write_bytes(b"x" * 10)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "100%20.bin").write_bytes(b"y" * 5000)
    found = files.file_inventory(spark, str(tmp_path), "*.bin").collect()
    assert {(r.path.rsplit("/", 1)[1], r.length, r.sha256) for r in found} == {
        ("a b.bin", 10, hashlib.sha256(b"x" * 10).hexdigest()),
        ("100%20.bin", 5000, hashlib.sha256(b"y" * 5000).hexdigest()),
    }


def test_csv_quotes_line_breaks_and_column_order(spark, tmp_path):
    (tmp_path / "1.csv").write_text('a,b\n"say ""hi"", now",5\n"two\nlines",6\n')
    (tmp_path / "2 x.csv").write_text('# note\nb,a\n7,"x,y"\n')
    rows = files.read_csv_inferred(spark, str(tmp_path)).select("a", "b").collect()
    assert sorted(map(tuple, rows)) == [('say "hi", now', 5), ("two\nlines", 6), ("x,y", 7)]


@pytest.mark.parametrize("row", ["1,2,3,4", "1,2"])
def test_csv_with_ragged_rows_is_refused(spark, tmp_path, row):
    (tmp_path / "t.csv").write_text(f"a,b,c\n1,2,3\n{row}\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        files.read_csv_inferred(spark, str(tmp_path / "t.csv"))


def test_files_are_conformed_before_they_are_put_together(spark, tmp_path):
    target = catalogs.flat_schema("k bigint, v double, w string")
    spark.createDataFrame([(1, 1.5)], "k int, v float").write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([(2, 2.5, True)], "k bigint, v double, more boolean").coalesce(1).write.parquet(f"{tmp_path}/b")
    part = next((tmp_path / "b").glob("part-*"))
    part.rename(tmp_path / "b" / "object [1]")
    (tmp_path / "empty").write_bytes(b"")
    spark.range(1).write.json(f"{tmp_path}/c")
    got = bronze.conform_files(spark, str(tmp_path), target)
    assert sorted(map(tuple, got.collect())) == [(1, 1.5, None), (2, 2.5, None)]
    with pytest.raises(ValueError, match="differ in type"):
        files.read_parquet_tree(spark, str(tmp_path))
    (tmp_path / "b" / "no parquet").write_bytes(b"something else")
    with pytest.raises(Exception, match="(?i)parquet"):
        bronze.conform_files(spark, str(tmp_path), target)


RECORD = catalogs.flat_schema("name string, mass double, n int")


def test_json_records(spark):
    texts = [
        ("ok", '[{"name":"a","mass":null,"n":2},{"name":null,"mass":1.5}]'),
        ("none", "[]"),
        ("ill", '[{"name":"b","mass":"heavy","n":1}]'),
        ("cut", '[{"name":"c"'),
    ]
    df = spark.createDataFrame(texts, "catalog string, body string")
    parsed = jsonrecords.parse_records(df, "body", RECORD, keep=("catalog",))
    got = [(r.catalog, r.name, r.mass, r.n) for r in parsed.filter(F.col(jsonrecords.CORRUPT).isNull()).collect()]
    assert sorted(got) == [("ok", "", 1.5, 0), ("ok", "a", 0.0, 2)]
    bad = parsed.filter(F.col(jsonrecords.CORRUPT).isNotNull()).collect()
    assert {r.catalog: r[jsonrecords.CORRUPT] for r in bad} == dict(texts[2:])
    nulls = jsonrecords.parse_records(df, "body", RECORD, zero_for_null=False).filter("name = 'a'").first()
    assert nulls.mass is None
    assert {r.catalog for r in jsonrecords.reject_catalogs_with_errors(parsed, "catalog").collect()} == {"ok"}


def test_first_link(spark):
    bodies = ['{"strain":[{"url":"u1"},{"url":"u2"}]}', '{"strain":[]}', "{}"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert [r[0] for r in df.select(jsonrecords.first_link("body")).collect()] == ["u1", None, None]


def test_load_config_and_bronze(spark, tmp_path):
    root = str(tmp_path)
    parts = [{"partition_key": k, "partition_value": f"current_{k}"} for k in ("year", "month", "day")]
    config = [{"table_name": "stars", "source": "raw/stars", "dest": "bronze", "format": "Parquet", "partitions": parts}]
    (tmp_path / "config.json").write_text(json.dumps(config, indent=2))
    loads = bronze.read_load_config(spark, f"{root}/config.json")
    spark.createDataFrame([(1, 2.5)], "source_id int, ra double").write.parquet(f"{root}/raw/stars/deep")
    for _ in range(2):
        paths = bronze.load_all(spark, root, loads, {"stars": catalogs.STAR_BRONZE}, dt.date(2026, 1, 2))
    assert (tmp_path / "bronze/stars/year=2026/month=01/day=02").is_dir()
    df = files.read_parquet(spark, paths["stars"])
    assert len(df.columns) == 160 and df.count() == 2  # appended twice
    csv = bronze.TableLoad("c", "raw/c.csv", "bronze", "csv", (("year", "2020"),))
    (tmp_path / "raw" / "c.csv").write_text("a,b\n1,null\n")
    assert spark.read.parquet(bronze.load_table(spark, root, csv)).dtypes == [("a", "bigint"), ("b", "string"), ("year", "int")]
    with pytest.raises(ValueError, match="not supported"):
        bronze.load_table(spark, root, bronze.TableLoad("t", "raw", "bronze", "xml"))


@pytest.fixture
def table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t")
    name = f"t.x{scratch_path(spark, 'n')[-8:]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_table_create_and_evolve(spark, table):
    df = spark.createDataFrame([(1, "a", 5)], "k int, v string, p int")
    tables.sync_table(df, table, ["p"], ["k"])
    assert spark.table(table).count() == 0
    wider = spark.createDataFrame([(1, "a", 2.0, 5)], "k int, V string, extra double, p int")
    tables.sync_table(wider, table, ["p"])
    assert [c.lower() for c in spark.table(table).columns] == ["k", "v", "extra", "p"]
    tables.sync_table(df.drop("v"), table, ["p"])
    assert len(spark.table(table).columns) == 4


def test_overwrite_only_touches_given_partitions(spark, table):
    first = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "k int, p int")
    tables.sync_table(first, table, ["p"], ["k"])
    tables.overwrite_partitions(first, table)
    tables.overwrite_partitions(spark.createDataFrame([(5, 9)], "p int, k int"), table)
    assert sorted(map(tuple, spark.table(table).collect())) == [(3, 6), (9, 5)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_values_that_do_not_fit_are_refused(spark, table):
    first = spark.createDataFrame([(1, 1)], "p int, v int")
    tables.sync_table(first, table, ["p"])
    tables.overwrite_partitions(first, table)
    with pytest.raises(Exception, match="cannot cast 1.7"):
        tables.overwrite_partitions(spark.createDataFrame([(1, 1.7)], "p int, v double"), table)
    assert spark.table(table).collect()[0].v == 1


def test_purge_on_a_table_made_elsewhere(spark, table):
    """Partition columns come from the catalogue; null partitions are emptied too."""
    rows = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, None, 0), (4, "it's", 0)], "k int, p string, q int")
    rows.write.partitionBy("p", "q").saveAsTable(table)
    moved = spark.createDataFrame([(1, "z", 0), (3, "z", 0), (4, "z", 0)], "k int, p string, q int")
    tables.overwrite_partitions(moved, table, purge_key="k")
    assert sorted((r.k, r.p) for r in spark.table(table).collect()) == [(1, "z"), (2, "b"), (3, "z"), (4, "z")]
    assert len(spark.sql(f"SHOW PARTITIONS {table}").collect()) == 2


def test_a_table_without_partitions_is_replaced(spark, table):
    spark.createDataFrame([(1,)], "k int").write.saveAsTable(table)
    tables.overwrite_partitions(spark.createDataFrame([(2,)], "k int"), table, purge_key="k")
    assert [r.k for r in spark.table(table).collect()] == [2]


def test_purge_removes_moved_rows(spark, table):
    first = spark.createDataFrame([(1, 5), (2, 5), (3, 6), (4, 7)], "k int, p int")
    tables.sync_table(first, table, ["p"])
    tables.overwrite_partitions(first, table)
    tables.overwrite_partitions(spark.createDataFrame([(1, 8), (3, 8)], "k int, p int"), table, purge_key="k")
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, 8), (2, 5), (3, 8), (4, 7)]
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()} == {"p=5", "p=7", "p=8"}


def test_clustered_write_is_sorted(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 2 AS p", "999 - id AS k").repartition(8)
    tables.clustered(df, ["p"], ["k"]).write.partitionBy("p").parquet(str(tmp_path / "t"))
    for f in (tmp_path / "t").rglob("*.parquet"):
        import pyarrow.parquet as pq

        keys = pq.ParquetFile(f).read().column("k").to_pylist()
        assert keys == sorted(keys)
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 2


def test_control_table(spark, table):
    control.create_control_table(spark, table, [("main_source", dt.date(2026, 4, 2), "silver")])
    control.create_control_table(spark, table, [("ignored", None, "silver")])
    found = control.lookup(spark, table, "silver", "main_source")
    assert found["genesis"] == dt.date(2026, 4, 2) and found["current"] is None
    assert control.lookup(spark, table, "gold", "main_source") == {}
    assert control.lookup(spark, "t.absent", "gold", "x") == {}
    control.advance(spark, table, "silver", "main_source", dt.date(2026, 5, 1))
    control.advance(spark, table, "gold", "facts", dt.date(2026, 5, 2))
    again = control.lookup(spark, table, "silver", "main_source")
    assert again["id"] == found["id"] and again["current"] == dt.date(2026, 5, 1) and again["genesis"] == dt.date(2026, 4, 2)
    state = control.with_target_date(control.current_state(spark.table(table)))
    assert {r.pipeline: r.target_date for r in state.collect()} == {"main_source": "2026-05-01", "facts": "2026-05-02"}
    rows = spark.createDataFrame([("20260430",), ("20260501",)], "fct_dt string")
    assert control.since(rows, "2026-05-01").count() == 1


MESSAGE = catalogs.flat_schema("n int, s string")


def message(catalog, h, *numbers):
    return json.dumps({"catalog": catalog, "data": [{"n": n, "s": f"v{n}"} for n in numbers], "hash": h})


def write_file(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_landing_is_exactly_once(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    write_file(source, "a.txt", message("ps", "h1", 1, 2), message("ps", "h1", 1, 2), '{"catalog": "ps", brok')
    write_file(source, "b.txt", message("ps", "h2", 3), '{"other": 1}')
    landing.land_messages(spark, str(source), root, MESSAGE, max_files=1)

    def state():
        rows = sorted((r.catalog, r.hash, r.n) for r in landing.landed_records(spark, root, MESSAGE).collect())
        return rows, sorted(r[0] for r in landing.dead_letters(spark, root).collect())

    want = [("ps", "h1", 1), ("ps", "h1", 2), ("ps", "h2", 3)]
    dead = sorted(['{"catalog": "ps", brok', '{"other": 1}'])
    assert state() == (want, dead)
    landing.land_messages(spark, str(source), root, MESSAGE)  # nothing new
    assert state() == (want, dead)
    write_file(source, "c.txt", message("ps", "h1", 1, 2), message("k", "h3", 4))
    landing.land_messages(spark, str(source), root, MESSAGE)
    assert state() == (want_sorted := sorted([*want, ("k", "h3", 4)]), dead) and want_sorted


def test_landing_as_json(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    write_file(source, "a.txt", message("ps", "h1", 1, 2))
    landing.land_messages(spark, str(source), root, MESSAGE, record_format="json")
    rows = landing.landed_records(spark, root, MESSAGE, "json").collect()
    assert sorted((r.catalog, r.hash, r.n, r.s) for r in rows) == [("ps", "h1", 1, "v1"), ("ps", "h1", 2, "v2")]
    assert list((tmp_path / "out" / "landed").rglob("catalog=ps/*.json"))


def test_landing_of_malformed_lines_only(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    write_file(source, "a.txt", "no message")
    landing.land_messages(spark, str(source), root, MESSAGE)
    assert landing.landed_records(spark, root, MESSAGE).count() == 0
    assert [r[0] for r in landing.dead_letters(spark, root).collect()] == ["no message"]


def test_landing_survives_a_lost_commit(spark, tmp_path):
    """The last micro-batch is run again when its commit is missing, with the same result."""
    source, root = tmp_path / "in", tmp_path / "out"
    write_file(source, "a.txt", message("ps", "h1", 1))
    landing.land_messages(spark, str(source), str(root), MESSAGE)
    write_file(source, "b.txt", message("ps", "h2", 2))
    landing.land_messages(spark, str(source), str(root), MESSAGE)
    for f in (root / "checkpoint" / "commits").glob("*1*"):
        f.unlink()
    landing.land_messages(spark, str(source), str(root), MESSAGE)
    assert sorted(r.hash for r in landing.landed_records(spark, str(root), MESSAGE).collect()) == ["h1", "h2"]


def test_stage_round_trip(spark):
    df = spark.range(5).selectExpr("id", "array(id) AS a", "struct(id, 'x' AS y) AS s")
    assert sorted(map(str, stage(df, "t").collect())) == sorted(map(str, df.collect()))


def test_shared_dir_is_the_configured_one(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


class FakeConf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class FakeSession:
    def __init__(self, master, app):
        self.conf = FakeConf({})
        self.sparkContext = type("C", (), {"master": master, "applicationId": app, "getConf": lambda _: FakeConf({})})()


def test_shared_dir_without_setting():
    local = FakeSession("local[2]", "app-1")
    assert scratch_path(local, "a").rsplit("/", 1)[0] == scratch_path(local, "b").rsplit("/", 1)[0]
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(FakeSession("spark://host:7077", "app-2"), "a")


def test_catalog_columns(spark):
    assert len(catalogs.SPECTROSCOPY) == 56 and len(catalogs.PLANETS) == 19 and len(catalogs.STAR_EXTRACT) == 15
    df = spark.range(1).select(*(F.lit(1).alias(c) for c in [*catalogs.SPECTROSCOPY, "more"]))
    assert catalogs.spectroscopy_catalog(df).columns == catalogs.SPECTROSCOPY


def test_catalogues_with_equal_records_are_both_landed(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.txt").write_text('{"catalog":"ps","data":[{"n":1}],"hash":"h1"}\n{"catalog":"zz","data":[{"n":1}],"hash":"h1"}\n')
    landing.land_messages(spark, str(source), root, MESSAGE)
    (source / "b.txt").write_text('{"catalog":"ps","data":[{"n":1}],"hash":"h1"}\n{"catalog":"yy","data":[{"n":1}],"hash":"h1"}\n')
    landing.land_messages(spark, str(source), root, MESSAGE)
    assert sorted(r.catalog for r in landing.landed_records(spark, root, MESSAGE).collect()) == ["ps", "yy", "zz"]


def test_compacted_ledger_still_knows_every_message(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for i in range(3):
        (source / f"{i}.txt").write_text(f'{{"catalog":"ps","data":[{{"n":{i}}}],"hash":"h{i}"}}\n')
    landing.land_messages(spark, str(source), str(root), MESSAGE, max_files=1)
    landing.compact_ledger(spark, str(root), folders=2)
    assert len(list((root / "ledger").glob("upto=*"))) == 1 and not list((root / "hashes").glob("batch_id=*"))
    for i in range(4):
        (source / f"again{i}.txt").write_text(f'{{"catalog":"ps","data":[{{"n":{i}}}],"hash":"h{i}"}}\n')
    landing.land_messages(spark, str(source), str(root), MESSAGE, max_bytes=100)
    landing.compact_ledger(spark, str(root), folders=1)
    landing.land_messages(spark, str(source), str(root), MESSAGE)
    assert sorted(r.n for r in landing.landed_records(spark, str(root), MESSAGE).collect()) == [0, 1, 2, 3]


def test_advance_needs_a_readable_table(spark):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        control.advance(spark, "no_such_database.control", "silver", "a", dt.date(2026, 1, 1))
    assert control.lookup(spark, "no_such_database.control", "silver", "a") == {}


def test_writes_return_their_counts(spark, tmp_path):
    df = spark.range(7)
    assert bronze.write_by_date(df, f"{tmp_path}/t", {"year": "2026"}, {"top": F.max("id")}) == {"n_records": 7, "top": 6}


def test_staged_tables_can_be_cleared(spark):
    path = stage(spark.range(3), "short-lived").inputFiles()[0].removeprefix("file://")
    assert Path(path).exists()
    assert clear_staged(spark) >= 1
    assert not Path(path).exists() and clear_staged(spark) == 0
