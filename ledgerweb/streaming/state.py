"""Tables that grow batch by batch and are read in part: versions under their batch, each dealt into buckets of accounts.

A batch stores the rows it changes. Every few batches a table is stored whole, in as many buckets as keep each at a bounded number of rows, and the
batches that follow use the same. Who asks for some accounts reads their buckets alone, in every version: the bucket is a partition of the files, so
others are not opened. The newest version of a key holds.

Folders are `<table>/batch_id=<n>/buckets=<count>/bucket=<b>` for changes and `whole_<table>/...` for whole tables. Counts are powers of two
up to 65,536; a table of more than that many times `rows_per_bucket` rows has larger buckets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = {"ends": ["id", "other", "is_out"], "scores": ["id"], "members": ["component", "id"], "summary": ["part"]}
DEALT_BY = {"ends": "id", "scores": "id", "members": "component"}
MOST_BUCKETS = 1 << 16
ROWS_PER_BUCKET = 100_000


def bucket_of(key: str, buckets: int = MOST_BUCKETS) -> Column:
    """As counts are powers of two, the bucket of fewer follows from that of more."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


# --- folders -----------------------------------------------------------------------------------

def _children(spark: SparkSession, folder: str, name: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.removeprefix(f"{name}=")) for n in names if n.startswith(f"{name}="))


def versions(spark: SparkSession, folder: str) -> list[int]:
    return _children(spark, folder, "batch_id")


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# --- writing -----------------------------------------------------------------------------------

def store(rows: DataFrame, out_dir: str, table: str, batch_id: int, buckets: int, whole: bool = False) -> None:
    """Write a version; one that is there already, from a batch that failed, is replaced."""
    spark, version = rows.sparkSession, f"{out_dir}/{'whole_' if whole else ''}{table}/batch_id={batch_id}"
    delete(spark, version)
    path = f"{version}/buckets={buckets}"
    if table not in DEALT_BY or buckets == 1:
        rows.write.parquet(f"{path}/bucket=0")
        return
    # The hint avoids a file per task and bucket, and cuts the bucket of an account that has very many rows.
    rows.withColumn("bucket", bucket_of(DEALT_BY[table], buckets)).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
    if not _children(spark, path, "bucket"):
        rows.limit(0).write.parquet(f"{path}/bucket=0")


def buckets_at(spark: SparkSession, out_dir: str, table: str, before: int | None = None) -> int:
    """How many buckets the last whole table has; one before there is any."""
    whole = f"{out_dir}/whole_{table}"
    past = [n for n in versions(spark, whole) if before is None or n < before]
    return _children(spark, f"{whole}/batch_id={past[-1]}", "buckets")[0] if past else 1


# --- reading -----------------------------------------------------------------------------------

def touched_buckets(ids: DataFrame) -> list[int]:
    """The buckets of the accounts in a frame of one column: 65,536 numbers at most."""
    return [r[0] for r in ids.select(bucket_of(ids.columns[0])).distinct().collect()]


def read(spark: SparkSession, out_dir: str, table: str, before: int | None = None, touched: list[int] | None = None) -> DataFrame | None:
    """All versions of the rows in the given buckets, or in all, as they stood before a batch, with their `batch_id`; None before the first."""
    def past(folder: str) -> list[int]:
        return [n for n in versions(spark, folder) if before is None or n < before]

    changes, whole = f"{out_dir}/{table}", f"{out_dir}/whole_{table}"
    start = max(past(whole), default=None)
    folders = [] if start is None else [(whole, start)]
    folders += [(changes, n) for n in past(changes) if start is None or n > start]
    if not folders:
        return None
    counts, parts = set(), []
    for root in dict.fromkeys(f for f, _ in folders):
        own = [n for f, n in folders if f == root]
        counts |= {c for n in own for c in _children(spark, f"{root}/batch_id={n}", "buckets")}
        parts.append(spark.read.option("basePath", root).parquet(*[f"{root}/batch_id={n}" for n in own]))
    rows = reduce(DataFrame.unionByName, parts)
    if touched is not None:
        asked = [(F.col("buckets") == c) & F.col("bucket").isin(sorted({t % c for t in touched})) for c in sorted(counts)]
        rows = rows.filter(reduce(lambda a, b: a | b, asked) if touched else F.lit(False))
    return rows.drop("buckets", "bucket")


def current(rows: DataFrame, table: str) -> DataFrame:
    """The newest version of each key."""
    keys = KEYS[table]
    rest = [c for c in rows.columns if c not in (*keys, "batch_id")]
    if not rest:
        return rows.select(*keys).distinct()
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("v")).select(*keys, "v.*")


def table(spark: SparkSession, out_dir: str, name: str, before: int | None = None) -> DataFrame | None:
    """A whole table as it stood before batch `before`, or now."""
    rows = read(spark, out_dir, name, before)
    return None if rows is None else current(rows, name)


def lookup(spark: SparkSession, out_dir: str, name: str, ids: DataFrame, before: int | None = None) -> DataFrame | None:
    """The rows of the accounts in `ids`, a frame of the one column that the table is dealt by; only their buckets are read."""
    rows = read(spark, out_dir, name, before, touched_buckets(ids))
    return None if rows is None else current(rows.join(ids, DEALT_BY[name], "left_semi"), name)


# --- compaction --------------------------------------------------------------------------------

def fitting(rows: int, rows_per_bucket: int) -> int:
    """The power of two that gives buckets of at most `rows_per_bucket` rows on the mean."""
    return min(MOST_BUCKETS, 1 << max(0, (max(rows, 1) - 1) // rows_per_bucket).bit_length())


def drop_superfluous(spark: SparkSession, out_dir: str, name: str, batch_id: int) -> None:
    """Drop what the whole tables before the one of `batch_id` have made superfluous.

    The last whole tables but one stay, so that a batch which is repeated finds the state before it.
    """
    whole = f"{out_dir}/whole_{name}"
    earlier = [n for n in versions(spark, whole) if n < batch_id]
    if earlier:
        for folder in (f"{out_dir}/{name}", whole):
            for n in versions(spark, folder):
                if n < earlier[-1] or (n == earlier[-1] and folder != whole):
                    delete(spark, f"{folder}/batch_id={n}")
