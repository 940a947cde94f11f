"""Reading transaction tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweb.schema import REQUIRED_UPLOAD_COLUMNS, TRANSACTIONS, UPLOAD

EXPORT_MAPPING = {"sender": "nameOrig", "receiver": "nameDest", "amount": "amount"}


class MissingColumns(ValueError):
    def __init__(self, missing: Iterable[str]):
        self.missing = sorted(missing)
        super().__init__(f"missing columns: {', '.join(self.missing)}")


def require_columns(df: DataFrame, required: Iterable[str] = REQUIRED_UPLOAD_COLUMNS) -> DataFrame:
    """Refuse a table without the required columns before any job runs."""
    missing = set(required) - set(df.columns)
    if missing:
        raise MissingColumns(missing)
    return df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = False) -> DataFrame:
    """CSV with a header. Columns are matched by header name, so their order and number may vary.

    With a schema, only its columns are typed and the ones the file lacks stay absent; without
    one every column is text. `infer=True` costs one more pass over the files.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if infer:
        return reader.option("inferSchema", True).csv(path)
    raw = reader.csv(path)
    if schema is None:
        return raw
    types = {f.name: f.dataType for f in schema.fields}
    return raw.select(*[
        F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in raw.columns
    ])


def read_lines(spark: SparkSession, path: str, schema: T.StructType, line: str) -> DataFrame:
    """As `read_csv` with a schema, and the whole text of each line that has more or fewer fields than the header, else NULL, as `line`."""
    names = spark.read.option("header", True).csv(path).schema
    fields = T.StructType([*[T.StructField(f.name, T.StringType()) for f in names.fields], T.StructField(line, T.StringType())])
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", line).schema(fields).csv(path)
    types = {f.name: f.dataType for f in schema.fields}
    return raw.select(*[F.col(f"`{f.name}`").try_cast(types.get(f.name, T.StringType())).alias(f.name) for f in fields.fields])


def read_upload(spark: SparkSession, path: str, line: str | None = None) -> DataFrame:
    """An uploaded transaction file: required columns checked, known columns typed.

    With a name for `line`, lines that don't fit the header keep their text under it, and `ingest.validate` rejects them.
    """
    return require_columns(read_lines(spark, path, UPLOAD, line) if line else read_csv(spark, path, UPLOAD))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a Parquet folder where the name is a path."""
    return spark.read.parquet(name) if "/" in name else spark.read.table(name)


def list_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")


def transactions_from_rows(spark: SparkSession, rows: Iterable[Mapping]) -> DataFrame:
    """A few literal rows under the transaction contract; keys a row lacks become NULL."""
    names = TRANSACTIONS.fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], TRANSACTIONS)


def sample_rows(spark: SparkSession) -> DataFrame:
    """The template a user may download (fixed values)."""
    rows = [
        ("C1001", "M2001", 250.0, "P2M"),
        ("C1002", "M2002", 12500.0, "P2M"),
        ("C1003", "C1001", 800.0, "P2P"),
        ("C1004", "M2001", 50000.0, "P2M"),
        ("C1005", "C1003", 999.99, "P2P"),
    ]
    df = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)],
        "minutes_ago_5 int, sender string, receiver string, amount double, type string",
    )
    ago = F.make_dt_interval(F.lit(0), F.lit(0), F.col("minutes_ago_5") * 5)
    return df.select(
        "sender", "receiver", "amount",
        F.date_format(F.current_timestamp() - ago, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), "type",
    )
