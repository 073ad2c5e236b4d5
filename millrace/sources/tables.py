"""Stored tables: each write is a version of its own, a view names the one in use."""

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names the versions a view reads, for `drop_superseded`.
_VERSIONS = "millrace.versions"
# A table whose largest bucket has more than so many times the bytes of the average one, and more than
# so many bytes, is registered without buckets: one task would read that bucket alone.
BUCKET_SKEW, BUCKET_BYTES = 4, 64 << 20


@dataclass(frozen=True)
class Layout:
    """How a table lies in storage: folders per value, or `buckets` files by hash of a key."""

    partition_by: tuple = ()
    bucket_by: str | None = None
    buckets: int = 0


@dataclass
class Written:
    """What was counted while tables were written: {table: {metric: value}}, `rows` always."""

    metrics: dict = field(default_factory=dict)

    def rows(self, table: str) -> int:
        return self.metrics[table]["rows"]


def store_version(
    df: DataFrame, table: str, root: str, layout: Layout = Layout(), written: Written | None = None, **metrics
) -> str:
    """Write the rows as a new table beside `layer.name` and return its name; nothing refers to it yet.

    With `written`, rows and `metrics` are counted by the tasks that write, in the write's last stage,
    where a repeated task counts once: no scan of the stored table is needed for them.
    """
    spark = df.sparkSession
    layer, name = table.split(".")
    version = uuid.uuid4().hex
    path = f"{root.rstrip('/')}/{layer}/{name}/{version}"
    stored = f"{layer}.{name}__{version}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    bucketed = bool(layout.bucket_by and layout.buckets)
    if bucketed:
        # By the key, so that a bucket is one file; a hot key's rows are split over tasks at run time.
        df = df.hint("rebalance", layout.buckets, F.col(layout.bucket_by))
    seen = None
    if written is not None:
        seen = Observation(f"{table}-{version}")
        df = df.observe(seen, F.count("*").alias("rows"), *[c.alias(n) for n, c in metrics.items()])
    if bucketed:
        writer = df.write.bucketBy(layout.buckets, layout.bucket_by).sortBy(layout.bucket_by)
        writer.format("parquet").option("path", path).saveAsTable(stored)
        if _one_bucket_stands_out(spark, path, layout.buckets):
            # The files are plain parquet as well: read without buckets, they are split by size.
            spark.sql(f"DROP TABLE {stored}")
            _register(df, stored, path, ())
    else:
        df.write.partitionBy(*layout.partition_by).parquet(path)
        _register(df, stored, path, layout.partition_by)
    if seen is not None:
        written.metrics[table] = seen.get
    return stored


def _register(df: DataFrame, stored: str, path: str, partition_by) -> None:
    """A catalog entry with the rows' own columns, so that no rows are no failure."""
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    parted = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {stored} ({columns}) USING parquet {parted} LOCATION '{path}'")
    if partition_by:
        spark.catalog.recoverPartitions(stored)


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files, files.listStatus(folder) if files.exists(folder) else []


def _one_bucket_stands_out(spark: SparkSession, path: str, buckets: int) -> bool:
    sizes: dict[str, int] = {}
    for status in _files(spark, path)[1]:
        if found := re.search(r"_(\d{5})(?:\.c\d+)?\.", status.getPath().getName()):
            sizes[found[1]] = sizes.get(found[1], 0) + status.getLen()
    largest, total = max(sizes.values(), default=0), sum(sizes.values())
    return largest > BUCKET_BYTES and largest * buckets > BUCKET_SKEW * total


def point(spark: SparkSession, view: str, select: str, versions, **properties) -> DataFrame:
    """Let the view read the given versions from now on, in one change of one catalog entry.

    A reader sees the old rows or the new ones, with the columns that belong to them; a failure before
    leaves the old ones.
    """
    if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
        # A table of that name that was not made here.
        spark.sql(f"DROP TABLE {view}")
    held = ", ".join(f"'{k}' = '{v}'" for k, v in {_VERSIONS: ",".join(versions), **properties}.items())
    spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ({held}) AS {select}")
    return spark.table(view)


def publish(
    df: DataFrame,
    table: str,
    root: str,
    partition_by=(),
    bucket_by: str | None = None,
    buckets: int = 0,
    written: Written | None = None,
    **metrics,
) -> DataFrame:
    """Replace `layer.name` with the rows of `df`.

    The rows go to a new version first, with its own columns, partitions and buckets; then the view
    `layer.name` moves to it. `drop_superseded` removes the versions that earlier runs have left.
    """
    layout = Layout(tuple(partition_by), bucket_by, buckets)
    stored = store_version(df, table, root, layout, written, **metrics)
    return point(df.sparkSession, table, f"SELECT * FROM {stored}", [stored])


def properties_of(spark: SparkSession, view: str) -> dict:
    """The properties `point` has given a view: a handful of names."""
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}


def versions_of(spark: SparkSession, view: str) -> list:
    """The versions a published view reads."""
    return properties_of(spark, view).get(_VERSIONS, "").split(",")


def drop_superseded(spark: SparkSession, table: str, root: str, view: str | None = None) -> list:
    """Drop the versions of a table that its view does not read; returns the names of their folders.

    `view` is the view that reads them, if it has another name. For whoever owns the storage to call once no
    reader of an earlier run is left. Folders that a failed write has left go as well.
    """
    layer, name = table.split(".")
    used = {v.split("__")[-1] for v in versions_of(spark, view or table)}
    for row in spark.sql(f"SHOW TABLES IN {layer} LIKE '{name}__*'").collect():
        if row["tableName"].split("__")[-1] not in used:
            spark.sql(f"DROP TABLE {layer}.{row['tableName']}")
    files, found = _files(spark, f"{root.rstrip('/')}/{layer}/{name}")
    old = [s.getPath() for s in found if s.getPath().getName() not in used]
    for path in old:
        files.delete(path, True)
    return [path.getName() for path in old]


_INVENTORY = T.StructType(
    [
        T.StructField("table", T.StringType(), False),
        T.StructField("position", T.IntegerType(), False),
        T.StructField("column", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
    ]
)


def column_inventory(spark: SparkSession, tables: dict) -> DataFrame:
    """One row per column of the named DataFrames. Reads schemas only, starts no job."""
    rows = [
        (name, i, field.name, field.dataType.simpleString())
        for name, df in tables.items()
        for i, field in enumerate(df.schema)
    ]
    return spark.createDataFrame(rows, _INVENTORY)


def inventory_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """(table, column, change, old_type, new_type): columns added, lost, retyped or moved between two inventories."""
    old = before.select("table", "column", F.col("type").alias("old_type"), F.col("position").alias("old_position"))
    new = now.select("table", "column", F.col("type").alias("new_type"), F.col("position").alias("new_position"))
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "lost")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
        .when(F.col("old_position") != F.col("new_position"), "moved")
    )
    both = old.join(new, ["table", "column"], "full").withColumn("change", change)
    return both.where(F.col("change").isNotNull()).select("table", "column", "change", "old_type", "new_type")
