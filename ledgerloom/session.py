"""Session set-up and table access shared by all queries."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ledgerloom", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the engine is written for: UTC, AQE with skew handling, Arrow."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; columns are pruned and filters pushed by the scan itself."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share. The session's own setting wins; a temporary folder serves local tests only."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = context._jsc.sc().getCheckpointDir().getOrElse(None)  # set earlier by code
    if not named:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="ledgerloom-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` once as a table in the shared checkpoint folder and go on from there, so that lost executors cost nothing.

    A written table is compressed, read by columns, and has a size that later joins can be planned by.
    """
    spark = df.sparkSession
    place = f"{checkpoint_dir(spark)}/ledgerloom/{uuid.uuid4().hex}"
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)
