"""Writers of stored tables.

A load replaces whole date partitions through dynamic partition overwrite: new files are staged, and the commit
moves them folder by folder. A run that fails before its commit changes nothing; one that fails in the commit
leaves some days old and some new, and the same load again completes it.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F



def overwrite_dates(df: DataFrame, path: str, date_col: str = "orderDate", rebalance: bool = True) -> None:
    """Replace the partitions of the dates in ``df``. Rows without a date form one partition, so a table of
    several loads keeps its undated rows apart with ``overwrite_load``.

    The rebalance hint gives each day few, evenly sized files; a day that holds much of the data is
    split over several tasks. Rows that lie by date already need none, and are not shuffled.
    """
    rows = df.hint("rebalance", F.col(date_col)) if rebalance else df
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path)


def fingerprint_metrics(columns) -> list[Column]:
    """Aggregates behind ``load_fingerprint``: the sum of the rows' hashes, in three parts that stay within 64 bits."""
    h = F.xxhash64(*columns)
    parts = {"high": F.shiftright(h, 40), "middle": F.shiftright(h, 20).bitwiseAND(F.lit(0xFFFFF)), "low": h.bitwiseAND(F.lit(0xFFFFF))}
    return [F.count("*").alias("n"), *[F.sum(part.cast("long")).alias(name) for name, part in parts.items()]]


def load_fingerprint(found) -> str:
    """A key of the rows themselves, the same for the same rows in any order, from their ``fingerprint_metrics``."""
    high, middle, low = (found[name] or 0 for name in ("high", "middle", "low"))
    return f"load_{found['n']}_{(high << 40) + (middle << 20) + low}"


def overwrite_load(df: DataFrame, path: str, load_id: str) -> DataFrame:
    """Replace the rows that one load wrote to ``path``; other loads keep theirs. Returns the stored rows.

    The rows are one partition, so they are written as they come. A load without rows leaves none of an earlier run of
    the same load.
    """
    spark, df = df.sparkSession, df.withColumn("load_id", F.lit(load_id))
    if df.isEmpty():
        clear_partitions(spark, path, "load_id", spark.range(1).select(F.lit(load_id)))
        return spark.createDataFrame([], df.schema)
    overwrite_dates(df, path, "load_id", rebalance=False)
    return spark.read.schema(df.schema).parquet(path).where(F.col("load_id") == load_id)


def _existing(spark, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def table_exists(spark, path: str) -> bool:
    files, location = _existing(spark, path)
    return files.exists(location)


def partition_dates(spark, path: str, date_col: str) -> list[dt.date]:
    """Dates of a stored table in order, from the names of its folders; no file is opened."""
    files, location = _existing(spark, path)
    found = [str(f.getPath().getName()) for f in files.listStatus(location) if f.isDirectory()] if files.exists(location) else []
    values = [name.split("=", 1)[1] for name in found if name.startswith(f"{date_col}=")]
    return sorted(dt.date.fromisoformat(v) for v in values if not v.startswith("__"))


def read_dates(spark, path: str, date_col: str, dates) -> DataFrame:
    """Rows of some dates of a stored table; only their folders are listed and opened."""
    root = path.rstrip("/")
    folders = [f"{root}/{date_col}={day.isoformat()}" for day in dates]
    return spark.read.option("basePath", root).parquet(*folders).withColumn(date_col, F.col(date_col).cast("date"))


def clear_partitions(spark, path: str, column: str, values: DataFrame) -> int:
    """Drop the partitions of the given values; returns how many were there.

    Values come to the driver one partition of ``values`` at a time; each is the name of one folder.
    """
    cleared = 0
    for (value,) in values.toLocalIterator():
        files, location = _existing(spark, f"{path.rstrip('/')}/{column}={value}")
        if files.exists(location):
            files.delete(location, True)
            cleared += 1
    return cleared


def _files_of(spark, path: str, column: str, values) -> dict[str, set]:
    """Value -> names of the files in its folder, for the values that have a folder."""
    found = {}
    for value in values:
        files, location = _existing(spark, f"{path}/{column}={value}")
        if files.exists(location):
            found[value] = {f.getPath().getName() for f in files.listStatus(location)}
    return found


def overwrite_aggregates(aggregates: dict[str, DataFrame], root: str, dates: DataFrame, date_col: str = "orderdate") -> None:
    """Replace the loaded dates in every aggregate table.

    Dynamic overwrite keeps a partition that gets no new rows, so after the write the loaded dates that an aggregate
    no longer has are dropped: those whose folder holds the files of before. New files have new names.
    """
    days = [str(day) for (day,) in dates.toLocalIterator()]
    for name, df in aggregates.items():
        path = f"{root.rstrip('/')}/{name}"
        before = _files_of(df.sparkSession, path, date_col, days)
        overwrite_dates(df, path, date_col)
        after = _files_of(df.sparkSession, path, date_col, before)
        gone = [(day,) for day in before if after.get(day) == before[day]]
        if gone:
            clear_partitions(df.sparkSession, path, date_col, df.sparkSession.createDataFrame(gone, "day string"))


def merge_snapshot(existing: DataFrame, incoming: DataFrame, keys, period_col: str) -> DataFrame:
    """Rows of the touched periods after an upsert: incoming rows, and the old ones they do not replace."""
    touched = incoming.select(period_col).distinct()
    kept = existing.join(touched, period_col, "left_semi")
    kept = kept.join(incoming, [kept[k].eqNullSafe(incoming[k]) for k in keys], "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def upsert_snapshot(incoming: DataFrame, path: str, keys, period_col: str, created_at=None) -> None:
    """Insert or replace snapshot rows by key, rewriting only the touched periods. One writer at a time."""
    spark = incoming.sparkSession
    stamped = incoming.withColumn("created_at", F.lit(created_at) if created_at is not None else F.current_timestamp())
    if table_exists(spark, path):
        existing = spark.read.schema(stamped.schema).parquet(path)
        stamped = merge_snapshot(existing, stamped, keys, period_col)
    overwrite_dates(stamped, path, period_col)


def jdbc_options(batch: int = 1000, writers: int = 16) -> dict[str, str]:
    return {"batchsize": str(batch), "numPartitions": str(writers)}


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, batch: int = 1000, writers: int = 16) -> None:
    """Append over JDBC with several connections."""
    (df.write.format("jdbc").option("url", url).option("dbtable", table)
     .options(**properties).options(**jdbc_options(batch, writers)).mode("append").save())


def export_chunked(df: DataFrame, path: str, order, max_rows: int = 1_000_000) -> None:
    """Sorted CSV export in files of at most max_rows rows; file names follow the sort order."""
    df.orderBy(*order).write.mode("overwrite").option("header", True).option(
        "maxRecordsPerFile", max_rows).csv(path)


def append_tracking(events: DataFrame, path: str) -> None:
    """Append (recipient, report_date, event) rows to the tracking log."""
    events.select("recipient", "report_date", "event").write.mode("append").parquet(path)
