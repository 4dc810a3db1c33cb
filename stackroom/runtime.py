"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stackroom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may go without one.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stackroom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder.

    They are computed once, keep their values when an executor is lost, and have a known size for the plans
    that read them.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialised_by(df: DataFrame, key: str) -> DataFrame:
    """The rows as a table in the shared folder whose files are dealt by a key.

    Groupings by the key, also together with other tables, read the rows where they lie instead of shuffling them again.
    """
    spark = df.sparkSession
    name = f"stackroom_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", scratch_path(spark, "table")).saveAsTable(name, format="parquet")
    table = spark.table(name)
    # The name was needed to read the files with their order; the files stay.
    spark.sql(f"DROP TABLE {name}")
    return table
