from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import rows
from martloom.sources import files, jdbc
from pyspark.sql.types import DecimalType, IntegerType, StringType, StructField, StructType, TimestampType

SCHEMA = StructType(
    [
        StructField("operation_id", StringType()),
        StructField("account", IntegerType()),
        StructField("amount", DecimalType(5, 3)),
        StructField("at", TimestampType()),
    ]
)


def test_rejected_lines_are_kept(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a;1;1.500;2022-10-01 10:00:00\nb;x;1.5;2022-10-01 10:00:00\nc;1;1.5\nd;1;1.5;2022-10-01 10:00:00;9\ne;;2.000;2022-10-01 10:00:00\n")
    good, rejected = files.load_with_rejects(spark, str(path), SCHEMA)
    assert good.schema.fieldNames() == SCHEMA.fieldNames()
    assert rows(good, "operation_id", "account", "amount") == [("a", 1, Decimal("1.500")), ("e", None, Decimal("2.000"))]
    assert good.count() == 2 and good.select("operation_id").count() == 2
    assert [r["line"][0] for r in rejected.orderBy("line").collect()] == ["b", "c", "d"]


def test_rejects_keep_field_names_with_signs_and_blanks(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("1;x\nno;y\n")
    names = ["sum: net", "a`b.c"]
    schema = StructType([StructField(names[0], IntegerType()), StructField(names[1], StringType())])
    good, rejected = files.load_with_rejects(spark, str(path), schema)
    assert good.columns == names and [tuple(r) for r in good.collect()] == [(1, "x")]
    assert [r["line"] for r in rejected.collect()] == ["no;y"]


def test_increment_without_status_and_with_repeats(spark, tmp_path):
    folder = tmp_path / "2021-01-01"
    folder.mkdir()
    (folder / "log.csv").write_text(
        "id,uniq_id,date_time,city_id,item_id,payment_amount\n1,a,2021-01-01 00:00:00,1,5,10.50\n2,a,2021-01-01 01:00:00,1,6,11\n3,b,2021-01-01 00:00:00,,7,1\n"
    )
    got = files.ingest_increment(spark, str(tmp_path) + "/{ds}", "2021-01-01")
    assert "id" not in got.columns
    assert rows(got, "uniq_id", "item_id", "city_id", "status") == [("a", 5, 1, "shipped"), ("b", 7, None, "shipped")]


def test_increment_with_status_and_other_column_order(spark, tmp_path):
    folder = tmp_path / "2021-01-02"
    folder.mkdir()
    (folder / "log.csv").write_text("status,id,uniq_id,date_time,item_id\nrefunded,1,a,2021-01-02 00:00:00,5\n")
    got = files.ingest_increment(spark, str(tmp_path) + "/{ds}", dt.date(2021, 1, 2))
    assert rows(got, "uniq_id", "status", "item_id") == [("a", "refunded", 5)]


def test_csv_with_nullable_integers(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text("group_id,user_id_from\n1,\n2,7\n")
    assert rows(files.read_csv(spark, str(path), "group_id int, user_id_from long")) == [(1, None), (2, 7)]


def test_extract_round_trip_and_preview(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    target = files.write_csv_extract(df, str(tmp_path), "transactions", "2022-10-01")
    assert target.endswith("/transactions_2022-10-01")
    assert rows(files.read_csv(spark, target, "k int, v string", sep=";", header=False)) == [(1, "a"), (2, None)]
    assert files.preview(spark.range(100)).count() == 10


def test_dated_parquet_is_replaced_by_day(spark, tmp_path):
    path = str(tmp_path / "mart")
    for day in ("2022-01-01", "2022-01-02", "2022-01-01"):
        files.write_dated(spark.range(3), path, day)
    assert files.read_parquet(spark, path).count() == 6
    files.append_staging(spark.range(2), str(tmp_path / "stg"))
    files.append_staging(spark.range(2), str(tmp_path / "stg"))
    assert files.read_parquet(spark, str(tmp_path / "stg"), "id long").count() == 4


def test_document_pages(spark, tmp_path):
    (tmp_path / "p1.json").write_text('[{"_id":"a","n":1.50},{"_id":"b"}]\n[]\n')
    got = files.read_document_pages(spark, str(tmp_path / "p1.json"))
    assert [r["object_value"] for r in got.orderBy("arrival").collect()] == ['{"_id":"a","n":1.5}', '{"_id":"b"}']


def test_day_predicates_cover_the_day_once(spark):
    parts = jdbc.day_predicates("ts", "2022-10-01", 4)
    assert len(parts) == 4
    seconds = spark.range(-10, 86410).selectExpr("timestamp_seconds(1664582400 + id) as ts")
    hits = [seconds.where(p).count() for p in parts]
    assert hits == [21600] * 4
    assert jdbc.day_rows(seconds, "ts", "2022-10-01").count() == 86400


def test_header_lookup_sorts_no_lines(spark, tmp_path, monkeypatch):
    """The headers of the files are found without sorting the lines, and those of different files stay apart."""
    for i in range(3):
        (tmp_path / f"f{i}.csv").write_text(f"id,c{i % 2}\n" + "".join(f"{n},x{n}\n" for n in range(50)))
    frame = type(spark.range(1))
    plans, collect = [], frame.collect
    monkeypatch.setattr(frame, "collect", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df))
    got = files.read_named_csv(spark, str(tmp_path), {"id": "int"})
    assert plans and not any(" Sort [file" in p for p in plans)
    assert sorted(got.columns) == ["c0", "c1", "id"] and got.count() == 150 and got.where("c1 is null").count() == 100
