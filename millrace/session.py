"""Session settings and the shared folder for intermediate tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Skewed join keys and partition sizes are settled at run time by AQE.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when an aggregation on that key then needs a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}
PARTITIONS = (
    "spark.sql.shuffle.partitions",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
)


def build_session(master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName("millrace")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    require_partitions(spark)
    return spark


def require_partitions(spark: SparkSession) -> None:
    """A cluster session has to say how many shuffle partitions it starts from.

    Spark's default of 200 is hundreds of GB each at 100 TB, and AQE splits skewed ones only.
    """
    chosen = any(spark.conf.get(name, None) not in (None, "200") for name in PARTITIONS)
    if not chosen and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set one of {', '.join(PARTITIONS)}: about 200 MB of shuffled data each")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor sees, from `spark.checkpoint.dir`.

    A local session without one gets a temporary folder; on a cluster that is refused,
    since a machine-local folder is lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder all executors share")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back.

    For results with several consumers, or whose row positions must not change on a
    retry. Later readers still prune columns, and a lost executor costs no recomputation.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
