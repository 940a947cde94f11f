import datetime as dt

import pytest

from ledgerweb.functions import clock
from ledgerweb.operators import ingest
from ledgerweb.schema import CONTRACT
from ledgerweb.sources import readers, writers
from pyspark.sql import functions as F


def test_contract_keeps_the_label(spark):
    raw = spark.createDataFrame(
        [("C1", "M1", 10.0, 7200, 1), ("C2", "M1", 5.5, 0, 0)],
        "nameOrig string, nameDest string, amount double, step long, isFraud int")
    rows = ingest.to_contract(raw).orderBy("sender").collect()
    assert ingest.to_contract(raw).columns == CONTRACT
    assert [(r["sender"], r["amount"], r["is_fraud"]) for r in rows] == [("C1", 10.0, 1), ("C2", 5.5, 0)]
    assert rows[0]["ts"] - rows[1]["ts"] == dt.timedelta(hours=2)
    hours = ingest.to_contract(raw.drop("isFraud"), unit_seconds=3600).orderBy("sender").collect()
    assert [r["is_fraud"] for r in hours] == [0, 0]
    assert hours[0]["ts"] - hours[1]["ts"] == dt.timedelta(hours=7200)


def test_missing_columns_are_named(spark):
    with pytest.raises(readers.MissingColumns) as error:
        readers.require_columns(spark.createDataFrame([("a",)], "sender string"))
    assert error.value.missing == ["amount", "receiver"]


def test_clean(spark):
    ts = dt.datetime(2024, 1, 1, 23, 59)
    rows = [("a", "b", 1.0, ts), ("a", "b", 1.0, ts), (None, "b", 1.0, ts), ("a", "b", None, ts), ("a", "b", 1.0, None)]
    df = spark.createDataFrame(rows, "sender string, receiver string, amount double, ts timestamp")
    kept = ingest.clean(df).collect()
    assert len(kept) == 1 and kept[0]["transaction_date"] == dt.date(2024, 1, 1)


def test_validate(spark):
    rows = [("a", "b", "5", "P2M"), (" ", "b", "5", "P2P"), ("a", None, "5", "P2P"), ("a", "b", "x", "P2P"),
            ("a", "b", "0", "P2P"), ("a", "b", "5", "Refund"), ("a", "b", "5", None)]
    df = spark.createDataFrame(rows, "sender string, receiver string, amount string, type string")
    valid, rejected = ingest.validate(ingest.coerce_upload(df))
    assert sorted(r["type"] for r in valid.collect()) == ["P2M", "P2P"]
    assert sorted(r["reason"] for r in rejected.collect()) == sorted(
        ["sender missing", "receiver missing", "amount missing", "amount below minimum", "unknown type"])


def test_coerce_defaults(spark):
    df = spark.createDataFrame([("a", "b", 1.0)], "sender string, receiver string, amount double")
    row = ingest.coerce_upload(df).first()
    assert (row["ts"], row["type"], row["is_fraud"]) == (None, "P2P", 0)
    assert ingest.coerce_upload(df, now_if_missing=True).first()["ts"] is not None


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "sample")
    writers.export_csv(readers.sample_rows(spark), path)
    back = readers.read_upload(spark, path)
    assert dict(back.dtypes)["amount"] == "double"
    rows = ingest.coerce_upload(back).orderBy("sender").collect()
    assert [(r["sender"], r["receiver"], r["amount"], r["type"]) for r in rows][:2] == [
        ("C1001", "M2001", 250.0, "P2M"), ("C1002", "M2002", 12500.0, "P2M")]
    assert all(r["ts"] is not None for r in rows)
    assert dict(readers.read_csv(spark, path, infer=True).dtypes)["amount"] == "double"


def test_columns_are_matched_by_name(spark, tmp_path):
    path = str(tmp_path / "reordered.csv")
    with open(path, "w") as file:
        file.write("amount,note,receiver,sender\n12.5,hi,b,a\n")
    row = readers.read_upload(spark, path).first()
    assert (row["sender"], row["receiver"], row["amount"], row["note"]) == ("a", "b", 12.5, "hi")


def test_tables(spark, tmp_path):
    df = spark.range(3)
    writers.write_table(df, str(tmp_path / "t"))
    writers.write_table(df.withColumn("x", F.lit("new")), str(tmp_path / "t"))
    assert readers.read_table(spark, str(tmp_path / "t")).columns == ["id", "x"]
    writers.write_table(df, "stored_ids")
    assert readers.read_table(spark, "stored_ids").count() == 3
    assert "stored_ids" in [r["tableName"] for r in readers.list_tables(spark).collect()]


def test_clock(spark):
    df = spark.sql("SELECT DATE'2024-02-28' AS d, TIMESTAMP'2024-02-28 10:00:05' AS ts")
    row = df.select(
        clock.iso(clock.combine("d", F.lit("09:30"))).alias("a"), clock.iso(clock.shift_days("ts", F.lit(2))).alias("b"),
        clock.wall_clock("ts").alias("c"), clock.iso(clock.combine("d", F.lit("soon"))).alias("e")).first()
    assert tuple(row) == ("2024-02-28T09:30:00", "2024-03-01T10:00:05", "10:00:05", None)
