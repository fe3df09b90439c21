from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql.types import StructType

from tidemark.schemas import SALES
from tidemark.sources.listing import list_objects, open_folder
from tidemark.sources.readers import csv_rejects, inventory, read_csv, read_outbox, read_topic, reject_counts
from tidemark.sources.writers import create_table, write_csv, write_records
from tidemark.workspace import Folder, fresh_folder, passing_folders, shared_folder, written


def test_two_column_csv(spark, tmp_path):
    numbers = "".join(f"{i},{i + 1}\n" for i in range(20))
    (tmp_path / "data.txt").write_text("a,b\n" + numbers)
    df = read_csv(spark, str(tmp_path / "data.txt"), None)
    assert df.dtypes == [("a", "int"), ("b", "int")]
    assert df.selectExpr("sum(a)", "sum(b)").first() == (190, 210)


def test_csv_with_schema(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "Transaction ID;Customer ID;Category;Item;Price Per Unit;Quantity;Total Spent;Payment Method;Location;"
        "Transaction Date\n"
        'T1;7;"a;b";;2.5;x;;;web;2024-01-02\n'
    )
    row = read_csv(spark, str(tmp_path / "s.csv"), SALES, delimiter=";").first()
    assert (row.transaction_id, row.category, row.item, row.quantity) == ("T1", "a;b", None, None)
    assert str(row.transaction_date) == "2024-01-02"


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Customer ID,More,Transaction ID\n7,x,T1\n")
    schema = StructType([f for f in SALES.fields if f.name in ("transaction_id", "customer_id")])
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "a.csv"), schema).collect()] == [("T1", 7)]
    with pytest.raises(ValueError, match="category"):
        read_csv(spark, str(tmp_path / "a.csv"), SALES)


def test_csv_keeps_every_character(spark):
    path = fresh_folder(spark, "csv")
    rows = [(' a "b"', "x,y", "line\nbreak"), ("", None, "„é“"), ("\\", '"', "\\\"")]
    df = spark.createDataFrame(rows, "quote_text string, author string, tags string")
    write_records(df.select("tags", "quote_text", "author"), path)
    back = read_csv(spark, path, df.schema, multi_line=True, keep_empty=True)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_csv_rejects(spark, tmp_path):
    schema = StructType.fromDDL("day date, amount double, name string, units int")
    (tmp_path / "s.csv").write_text(
        'Name;Amount;Units;More;Day\n"a;""b""";1.5;2;x;2024-01-02\nb;much;;x;2024-02-31\nc;;2.5;x;\nd;"NaN";9999999999;"y";2024-01-03\ne;1\nf;1;2;x;2024-01-04;7\n')
    found = csv_rejects(spark, str(tmp_path / "s.csv"), schema, delimiter=";").collect()
    assert sorted(((r.record[0], r.column_name, r.text) for r in found), key=str) == sorted([
        ("b", "amount", "much"), ("b", "day", "2024-02-31"), ("c", "units", "2.5"), ("d", "units", "9999999999"),
        ("e", None, None), ("f", None, None)], key=str)
    assert {r.record for r in found if r.column_name == "units"} == {"c;;2.5;x;", 'd;"NaN";9999999999;"y";2024-01-03'}
    rows = read_csv(spark, str(tmp_path / "s.csv"), schema, delimiter=";")
    assert [(r.name, r.amount, r.units) for r in rows.collect()][1:3] == [("b", None, None), ("c", None, None)]
    counts = {r.column_name: r.n for r in reject_counts(csv_rejects(spark, str(tmp_path / "s.csv"), schema, ";")).collect()}
    assert counts == {"amount": 1, "day": 1, "units": 2, None: 2}


def test_csv_rejects_of_clashing_columns(spark, tmp_path):
    (tmp_path / "c.csv").write_text("record,cell,_corrupt_record,n\nx,1,y,z\nx,2,y,3\n")
    schema = StructType.fromDDL("cell int, n int")
    found = csv_rejects(spark, str(tmp_path / "c.csv"), schema).collect()
    assert [tuple(r) for r in found] == [("x,1,y,z", "n", "z")]


def test_inventory(spark, tmp_path):
    for name in ("a.parquet", "b.txt"):
        (tmp_path / name).write_bytes(b"12345")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "c.txt").write_bytes(b"1")
    found = inventory(spark, str(tmp_path))
    assert sorted((r.path.rsplit("/", 1)[1], r.length) for r in found.collect()) == [
        ("a.parquet", 5), ("b.txt", 5), ("c.txt", 1)
    ]
    assert "content" not in found.columns
    assert inventory(spark, str(tmp_path), "*.txt").count() == 2


def test_listing_by_tasks(spark, tmp_path, monkeypatch):
    for i in range(1000):
        folder = tmp_path / f"a{i % 10}" / f"b={i} ü%"
        folder.mkdir(parents=True)
        (folder / "x.parquet").write_bytes(b"1" * (i % 7))
    (tmp_path / "_top.txt").write_bytes(b"22")
    (tmp_path / "empty").mkdir()
    collected = []
    take = type(spark.range(1)).collect

    def collect(df):
        collected.extend(take(df))
        return collected
    monkeypatch.setattr(type(spark.range(1)), "collect", collect)
    found = list_objects(spark, str(tmp_path))
    monkeypatch.undo()
    assert not any(".parquet" in str(r) for r in collected)   # no name of an object reached the driver
    rows = {r.path: r for r in found.collect()}
    assert {p: r.length for p, r in rows.items()} == {str(p): p.stat().st_size for p in tmp_path.rglob("*") if p.is_file()}
    assert all(r.modificationTime is not None for r in rows.values())
    assert list_objects(spark, f"file:{tmp_path}", "*.txt").collect()[0].path == f"file:{tmp_path}/_top.txt"
    assert list_objects(spark, str(tmp_path / "missing")).count() == list_objects(spark, str(tmp_path / "empty")).count() == 0


def test_names_of_stores():
    assert open_folder("file:///tmp/x")[1] == open_folder("file:/tmp/x")[1] == open_folder("/tmp/x")[1] == "/tmp/x"


def test_outbox_by_format(spark):
    path = fresh_folder(spark, "outbox")
    spark.range(3).write.parquet(path)
    assert read_outbox(spark, {"path": path}, "parquet").count() == 3


def test_topic_is_a_stream_of_text(spark):
    path = fresh_folder(spark, "topic")
    spark.sql("SELECT CAST('x' AS binary) AS value").write.parquet(path)
    stream = read_topic(spark, {"path": path}, "parquet", "value binary")
    assert stream.isStreaming and stream.dtypes == [("value", "string")]


def test_create_table_twice(spark):
    for _ in range(2):
        create_table(
            spark, "user_logins", "username STRING, event_type STRING, event_time TIMESTAMP, event_date DATE",
            "event_date", fresh_folder(spark, "table"),
        )
    spark.sql("INSERT INTO user_logins VALUES ('a', 'login', TIMESTAMP'2024-01-01 00:00:00', DATE'2024-01-01')")
    assert spark.table("user_logins").count() == 1
    spark.sql("DROP TABLE user_logins")


class Session:
    """A session with the given master and settings, nothing else."""

    def __init__(self, master, **settings):
        self.master, self.folder = master, None
        self.conf = SimpleNamespace(get=lambda key, default: settings.get(key.replace(".", "_"), default))
        self.sparkContext = self

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_follows_the_setting(spark):
    assert shared_folder(Session("spark://host", spark_checkpoint_dir="/shared/")) == "/shared"
    with pytest.raises(ValueError):
        shared_folder(Session("spark://host"))
    local = Session("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.folder
    assert Folder(spark, shared_folder(spark)).has() or written(spark.range(1), fresh_folder(spark, "t")).count() == 1


def test_written_table_is_the_same(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, NULL) AS t(n, s)")
    assert sorted(written(df, fresh_folder(spark, "t")).collect()) == sorted(df.collect())
    assert written(df.where("false"), fresh_folder(spark, "t")).count() == 0


def test_folder(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    folder = Folder(spark, str(tmp_path))
    assert folder.names() == ["x"] and folder.has("x/y") and folder.names("none") == []
    folder.remove("x")
    assert not folder.has("x")


def test_write_csv_replaces(spark):
    path = fresh_folder(spark, "csv")
    for n in (3, 2):
        write_csv(spark.range(n), path)
    assert read_csv(spark, path).count() == 2


def test_passing_folders_are_removed(spark):
    kept = fresh_folder(spark, "kept")
    with passing_folders(spark):
        passing = fresh_folder(spark, "passing")
        result = written(written(spark.range(3), passing), kept)
    assert Folder(spark, kept).has() and not Folder(spark, passing).has()
    assert result.count() == 3
